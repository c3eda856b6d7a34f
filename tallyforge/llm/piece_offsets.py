"""SentencePiece ids whose pieces know their bytes in the original text.

A text is normalised by the longest prefix that the model's compiled character map holds at each place, and every
normalised byte remembers where in the source its own piece of text began. No piece of the vocabulary holds a space mark
after another character, so a long normalised text may be cut before any run of marks: the blocks on both sides encode as
they would in the whole text. Pieces are as many normalised bytes as their names, or one byte each, so their running sum
looks up in the alignment which bytes of the source each of them covers.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import map_slices, texts_of
from tallyforge.llm.unit_encoder import vocabulary

SCHEMA = "doc_id bigint, n_tokens bigint, ids binary, starts array<int>, ends array<int>, decoded string"
MARK = "▁"
MARK_BYTES = MARK.encode()
#: Normalised characters that the library gets at a time, and as many more as it takes to the next safe cut.
BLOCK = 1 << 18
_SAFE = re.compile(f"(?<=[^{MARK}]){MARK}")


class CharacterMap:
    """The compiled map of a model: a double-array trie over source bytes, and the zero-ended texts its values point at.

    A unit of the trie holds its label in the low byte, a leaf flag in bit 8, and the offset of its children above bit 10,
    times 256 if bit 9 is set; a leaf's value is in the unit at its offset.
    """

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little") if compiled else 0
        self._trie = np.frombuffer(compiled, "<u4", size // 4, 4).tolist() if size else []
        self._texts = compiled[4 + size :]
        self._known: dict[bytes, tuple[int, bytes] | None] = {}

    def __bool__(self) -> bool:
        return bool(self._trie)

    @staticmethod
    def _children(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def longest_prefix(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """How many bytes from `at` on the longest entry there has, and what stands for them; None without an entry."""
        best, place = None, self._children(self._trie[0])
        for i in range(at, len(data)):
            place ^= data[i]
            unit = self._trie[place]
            if unit & 0x800000FF != data[i]:
                break
            place ^= self._children(unit)
            if unit & 0x100:
                best = i + 1 - at, self._trie[place] & 0x7FFFFFFF
        return best and (best[0], self._texts[best[1] : self._texts.index(0, best[1])])


@dataclass(frozen=True)
class Normaliser:
    characters: CharacterMap
    dummy_prefix: bool = True
    trim: bool = False
    escape: bool = True

    def pairs(self, source: bytes) -> list[tuple[int, bytes]]:
        """(length in the source, normalised bytes) of each step through the text."""
        steps, at = [], 0
        while at < len(source):
            found = self.characters.longest_prefix(source, at)
            if found is None:
                first = source[at]
                length = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                found = length, source[at : at + length]
            steps.append(found)
            at += found[0]
        return steps

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes, and for its end, the source byte that it goes back to."""
        source = text.encode()
        if self.characters or self.trim:
            return self._stepwise(source)
        if not source:
            return "", np.zeros(1, np.int32)
        prefix = self.dummy_prefix * " "
        marked = (prefix + text).replace(" ", MARK) if self.escape else prefix + text
        wide = len(MARK_BYTES) if self.escape else 1
        repeats = np.where(np.frombuffer(source, np.uint8) == 0x20, wide, 1)
        aligned = np.repeat(np.arange(len(source), dtype=np.int32), repeats)
        return marked, np.concatenate([np.zeros(self.dummy_prefix * wide, np.int32), aligned, np.int32([len(source)])])

    def _stepwise(self, source: bytes) -> tuple[str, np.ndarray]:
        steps = self.pairs(source) if self.characters else [(1, source[i : i + 1]) for i in range(len(source))]
        places = np.cumsum([0, *[length for length, _ in steps]]).tolist()
        space = MARK_BYTES if self.escape else b" "
        first, last = 0, len(steps)
        if self.trim:
            while first < last and not steps[first][1].strip(b" "):
                first += 1
        if first == last:
            return "", np.zeros(1, np.int32)
        parts, begins = [], []
        if self.dummy_prefix:
            parts, begins = [space], [places[first]] * len(space)
        after_space = self.trim
        for place, (_, made) in zip(places[first:last], steps[first:last]):
            if self.trim and after_space:
                made = made.lstrip(b" ")
            if made:
                parts.append(made.replace(b" ", space))
                begins += [place] * len(parts[-1])
                after_space = made.endswith(b" ")
        out, end = b"".join(parts), places[last]
        while self.trim and out.endswith(space):
            out = out[: -len(space)]
            end = begins[len(out)]
        return out.decode(errors="replace"), np.array([*begins[: len(out)], end], np.int32)


def blocks(normalised: str, size: int = BLOCK) -> list[str]:
    """The text in pieces that encode apart as they do together; each begins with a mark."""
    found, start = [], 0
    while len(normalised) - start > size and (cut := _SAFE.search(normalised, start + size)):
        found.append(normalised[start : cut.start()])
        start = cut.start()
    return [*found, normalised[start:]] if normalised else []


class PieceEncoder:
    """Ids of texts with their begin and end ids, spans of the pieces, and the text that ids decode to."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        self._library = SentencePieceProcessor(model_file=path)
        model = sentencepiece_model_pb2.ModelProto.FromString(self._library.serialized_model_proto())
        kinds, spec = sentencepiece_model_pb2.ModelProto.SentencePiece, model.normalizer_spec
        if not model.trainer_spec.byte_fallback or model.trainer_spec.treat_whitespace_as_suffix or any(p.type == kinds.USER_DEFINED for p in model.pieces):
            raise ValueError("a model with byte fallback, space marks in front and no pieces of the user's own is needed")
        if any(MARK in p.piece.lstrip(MARK) for p in model.pieces):
            raise ValueError("a piece of the model crosses words")
        self.normalise = Normaliser(CharacterMap(spec.precompiled_charsmap), spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces)
        self._bytes = [
            bytes([int(p.piece[3:5], 16)]) if p.type == kinds.BYTE else b"" if p.type == kinds.CONTROL else p.piece.encode() for p in model.pieces
        ]
        self._lengths = np.array([len(b) for b in self._bytes], np.int64)
        self._begin, self._end = (np.array([i], "<u4") for i in (self._library.bos_id(), self._library.eos_id()))
        # The library is handed normalised text, without its first mark, which it puts there itself.
        spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces = b"", True, False, True
        self._normalised = SentencePieceProcessor(model_proto=model.SerializeToString())
        self._mark = [self._library.piece_to_id(MARK)]

    def ids(self, normalised: str) -> np.ndarray:
        """Ids of a normalised text, which begins with a mark or is empty. A lone mark would be an empty text to the library."""
        parts = [self._mark if b == MARK else self._normalised.encode(b[1:]) for b in blocks(normalised)]
        return np.array([i for part in parts for i in part], "<u4")

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, starts, ends) per text. Begin and end ids cover the empty spans at both ends of the text.

        A byte piece covers the source bytes that its one byte goes back to: itself, if the map left its character alone.
        """
        out = []
        for text in texts:
            normalised, aligned = self.normalise(text)
            ids = self.ids(normalised)
            stops = np.cumsum(self._lengths[ids])
            starts, ends = aligned[np.concatenate([[0], stops[:-1]])[: len(ids)]], aligned[stops]
            size = aligned[-1:]
            out.append((np.concatenate([self._begin, ids, self._end]), np.concatenate([size * 0, starts, size]), np.concatenate([size * 0, ends, size])))
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The pieces' bytes in a row, marks as spaces, without the space that encoding put in front; as the library's decode."""
        return self._library.decode(ids.tolist())


@lru_cache(maxsize=1)
def piece_encoder(path: str) -> PieceEncoder:
    """One per Python worker."""
    return PieceEncoder(path)


def piece_offsets(documents: DataFrame, model: str = "piece_bpe_32k.model") -> DataFrame:
    """Rows of SCHEMA: ids as little-endian unsigned 32-bit numbers, begin and end ids included; each piece's first byte
    and the byte after its last in the UTF-8 of the text; and the text that the ids decode to.

    A null text is an empty one: only begin and end ids. Null doc_ids, ties and repeated rows need no rule, every row is
    one row of the result; other columns are ignored; an empty table gives no rows. A very long text is encoded whole in
    the task that read it, a few numbers per byte; offsets are 32-bit, as a Spark text is at most 2 GB.
    """

    def encode(part: pa.RecordBatch) -> pa.RecordBatch:
        encoder = piece_encoder(vocabulary(model))
        found = encoder.encode(texts_of(part))
        spans = [pa.array([f[k] for f in found], pa.list_(pa.int32())) for k in (1, 2)]
        return pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                pa.array([len(f[0]) for f in found], pa.int64()),
                pa.array([f[0].astype("<u4").tobytes() for f in found], pa.binary()),
                *spans,
                pa.array([encoder.decode(f[0]) for f in found], pa.string()),
            ],
            [f.split()[0] for f in SCHEMA.split(", ")],
        )

    return map_slices(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), encode, SCHEMA)
