"""Ids of whole texts by a byte-level BPE file of the tokenizers library, one encoding per distinct unit.

The pre-tokeniser's pattern never lets a token hold a blank after a non-blank, nor a mark after a letter or digit, so a
text may be cut before every space or newline that follows a non-blank, and before every full stop or comma that follows
a letter or digit: units on both sides encode as they would in the whole text. Special tokens hold none of these, so they
stay inside a unit and are what the library makes of them. Natural text repeats some units and holds many only once, so
each worker keeps those that it meets a second time, and only others go to the library, many as one text.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable
from functools import lru_cache

import numpy as np

#: Units that a worker keeps, of about 210 bytes each; when full, it starts anew. Bounds memory only, ids are the same.
MOST_UNITS = 250_000
#: Marks of units met once, a byte each; when half of them are set, they start anew.
MARKS = 1 << 22
#: A unit longer than this is encoded each time that it occurs.
LONGEST_KEPT = 64
#: Units sent to the library at a time.
ENCODED_AT_ONCE = 512
#: A long text is taken apart in blocks of about so many characters.
BLOCK = 1 << 20
_UNSAFE_BLANK = re.compile(r"[ \n](?<=\s[ \n])")
_UNSAFE_MARK = re.compile(r"[.,](?<=[\W_][.,])")
_SAFE = re.compile(r"(?<=\S)[ \n]")
_CUT = "\x00"


def units(text: str) -> list[str]:
    """The text in pieces; joined they are the text, and each begins at a safe cut. Odd blanks or marks leave fewer cuts."""
    if not text:
        return []
    if _CUT in text or _UNSAFE_BLANK.search(text):
        pieces, start = [], 0
        for m in _SAFE.finditer(text):
            if m.start() > start:
                pieces.append(text[start : m.start()])
                start = m.start()
        return [*pieces, text[start:]]
    cut = text.replace(" ", "\x00 ").replace("\n", "\x00\n")
    if text[0] not in ".," and not _UNSAFE_MARK.search(text):
        cut = cut.replace(".", "\x00.").replace(",", "\x00,")
    return cut.lstrip(_CUT).split(_CUT)


def blocks(text: str, size: int = BLOCK) -> list[str]:
    """The text in blocks that may be encoded apart, as long as it takes to find a safe cut after `size` characters."""
    found, start = [], 0
    while len(text) - start > size and (cut := _SAFE.search(text, start + size)):
        found.append(text[start : cut.start()])
        start = cut.start()
    return [*found, text[start:]]


class UnitEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._known: dict[str, bytes] = {}
        self._met, self._marked = bytearray(MARKS), 0
        added = {t.content for t in self._tokenizer.get_added_tokens_decoder().values()}
        vocabulary = self._tokenizer.get_vocab()
        #: Bytes of each id: a byte is one character in the file, but for added tokens.
        self._bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self._bytes[i] = len(token.encode()) if token in added else len(token)

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _ids_joined(self, part: list[str]) -> list[bytes]:
        """Units that begin with a blank and end without one, in one call: where they meet is a safe cut.

        The bytes of the ids tell which belong to which unit.
        """
        raw = self._ids(["".join(part)])[0]
        ends = np.cumsum(self._bytes[np.frombuffer(raw, "<u4")])
        wanted = np.cumsum([len(unit.encode()) for unit in part])
        at = np.searchsorted(ends, wanted)
        if not len(ends) or ends[-1] != wanted[-1] or (ends[at] != wanted).any():
            return self._ids(part)
        cuts = (4 * (at + 1)).tolist()
        return [raw[start:end] for start, end in zip([0, *cuts], cuts)]

    def _learn(self, new: Iterable[str]) -> dict[str, bytes]:
        found: dict[str, bytes] = {}
        joined, apart = [], []
        for unit in new:
            (joined if unit[0] in " \n" and not unit[-1].isspace() else apart).append(unit)
        for units_, encoded in ((joined, self._ids_joined), (apart, self._ids)):
            for start in range(0, len(units_), ENCODED_AT_ONCE):
                part = units_[start : start + ENCODED_AT_ONCE]
                found.update(zip(part, encoded(part)))
        return found

    def _settle(self, new: Iterable[str]) -> None:
        """Of the units just encoded, those stay that were met before."""
        known, met = self._known, self._met
        for unit in new:
            place = hash(unit) % MARKS
            if not met[place]:
                met[place] = 1
                self._marked += 1
                del known[unit]
            elif len(unit) > LONGEST_KEPT:
                del known[unit]
        if len(known) > MOST_UNITS:
            known.clear()
        if self._marked > MARKS // 2:
            self._met, self._marked = bytearray(MARKS), 0

    def encode(self, texts: list[str]) -> list[bytes]:
        if any(len(text) > BLOCK for text in texts):
            return [b"".join([self._encode([block])[0] for block in blocks(text)]) for text in texts]
        return self._encode(texts)

    def _encode(self, texts: list[str]) -> list[bytes]:
        cut, known = [units(text) for text in texts], self._known
        found = self._learn(set().union(*cut).difference(known))
        known.update(found)
        out = [b"".join(map(known.__getitem__, pieces)) for pieces in cut]
        self._settle(found)
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> UnitEncoder:
    """One per Python worker and file."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return UnitEncoder(path)


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
