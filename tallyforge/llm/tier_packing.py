"""Hierarchical packing: documents are cut into windows of several lengths, each tier is packed, gaps of long windows are
filled from shorter tiers, and finished windows are dealt to step groups of even load.

Every id gets into exactly one piece. A document longer than the longest window gives whole windows of its own; what is
left of it goes to the shortest tier that holds it. A gap is filled by the longest waiting remainder that fits, else by
cutting the shortest waiting one that doesn't, so windows end up full. What is left over at the end of a task, less than
one window, is cut at powers of two.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tallyforge.llm.common import slices, texts_of
from tallyforge.llm.unit_encoder import encoder, vocabulary

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint,"
    " window int, step_group bigint"
)
FULL = SCHEMA + ", ids binary"
#: The sequence's number within its task takes the lower bits of sequence_id.
TASK_BITS = 36


@dataclass(frozen=True)
class Packing:
    """`waiting`: remainders a task holds before it packs them, each shorter than the longest tier."""

    tiers: tuple[int, ...] = (1024, 512, 256)
    end_id: int = 0
    waiting: int = 4096
    group_windows: int = 64
    tokenizer: str = "byte_bpe_50k.json"


@dataclass(order=True)
class Rest:
    """Part of a document that waits for a window: length first, so that lists of them are sorted by it."""

    length: int
    order: int
    doc: object = field(compare=False)
    start: int = field(compare=False)


@dataclass
class Window:
    size: int
    pieces: list[tuple[object, int, int]] = field(default_factory=list)
    filled: int = 0

    def put(self, rest: Rest, length: int) -> None:
        self.pieces.append((rest.doc, rest.start, length))
        self.filled += length


def fill(window: Window, own: list[Rest], shorter: list[list[Rest]]) -> None:
    """Close the window's gap. First whole remainders, of the longest shorter tier that has one that fits; then a cut one."""
    while gap := window.size - window.filled:
        for waiting in [*shorter, own]:
            if at := bisect_right(waiting, gap, key=lambda r: r.length):
                rest = waiting.pop(at - 1)
                window.put(rest, rest.length)
                break
        else:
            cut = next(waiting for waiting in [*reversed(shorter), own] if waiting)
            rest = cut.pop(0)
            window.put(rest, gap)
            insort(cut, Rest(rest.length - gap, rest.order, rest.doc, rest.start + gap))


def pack(rests: list[Rest], tiers: tuple[int, ...]) -> tuple[list[Window], list[Rest]]:
    """Full windows of all tiers from the remainders, and what is left: less than one window of the shortest tier each."""
    by_tier: list[list[Rest]] = [[] for _ in tiers]
    for rest in sorted(rests):
        by_tier[max(i for i, size in enumerate(tiers) if rest.length <= size)].append(rest)
    windows = []
    for i, size in enumerate(tiers):
        while by_tier[i]:
            rest = by_tier[i].pop()
            if rest.length < size and too_little(by_tier[i:], size - rest.length):
                by_tier[i].append(rest)
                break
            window = Window(size)
            window.put(rest, rest.length)
            fill(window, by_tier[i], by_tier[i + 1 :])
            windows.append(window)
        if i + 1 < len(tiers):  # what cannot fill this tier is cut to the next one's length
            for rest in by_tier[i]:
                while rest.length > tiers[i + 1]:
                    windows.append(Window(tiers[i + 1], [(rest.doc, rest.start, tiers[i + 1])], tiers[i + 1]))
                    rest = Rest(rest.length - tiers[i + 1], rest.order, rest.doc, rest.start + tiers[i + 1])
                insort(by_tier[i + 1], rest)
            by_tier[i] = []
    return windows, by_tier[-1]


def too_little(lists: list[list[Rest]], gap: int) -> bool:
    """Whether all that waits cannot close the gap."""
    total = 0
    for waiting in lists:
        for rest in waiting:
            total += rest.length
            if total >= gap:
                return False
    return True


def last_windows(rests: list[Rest]) -> list[Window]:
    """The rest cut so that every window's length is a power of two: nothing is padded."""
    total, windows, waiting = sum(r.length for r in rests), [], sorted(rests, reverse=True)
    for bit in reversed(range(total.bit_length())):
        if total >> bit & 1:
            window = Window(1 << bit)
            while window.filled < window.size:
                rest = waiting.pop(0)
                length = min(rest.length, window.size - window.filled)
                window.put(rest, length)
                if rest.length > length:
                    waiting.insert(0, Rest(rest.length - length, rest.order, rest.doc, rest.start + length))
            windows.append(window)
    return windows


def grouped(windows: list[Window], group_windows: int) -> list[int]:
    """A step group for each window: groups get the heaviest windows first, always the group with the least work so far."""
    longest = max((w.size for w in windows), default=1)
    groups = max(1, round(sum(w.size for w in windows) / (group_windows * longest)))
    heap, chosen = [(0, 0, g) for g in range(groups)], [0] * len(windows)
    for i in sorted(range(len(windows)), key=lambda i: -windows[i].size):
        tokens, work, group = heapq.heappop(heap)
        chosen[i] = group
        heapq.heappush(heap, (tokens + windows[i].size, work + windows[i].size ** 2, group))
    return chosen


@dataclass
class Document:
    """Ids of a document from id `first` on; `tokens` is how many it has in all."""

    doc_id: int | None
    ids: bytes
    first: int
    tokens: int


class Packer:
    """The state of one task: waiting remainders, windows not yet given out, and the numbers of sequences and groups."""

    def __init__(self, packing: Packing, task: int):
        self.packing, self.order = packing, 0
        self.rests: list[Rest] = []
        self.windows: list[Window] = []
        self.sequence = self.group = task << TASK_BITS

    def add(self, doc_id: int | None, ids: bytes) -> None:
        longest, tokens = self.packing.tiers[0], len(ids) // 4
        whole = tokens // longest * longest
        doc = Document(doc_id, ids, 0, tokens)
        self.windows += [Window(longest, [(doc, at, longest)], longest) for at in range(0, whole, longest)]
        if tokens > whole:
            rest = Document(doc_id, ids[4 * whole :], whole, tokens)
            self.rests.append(Rest(tokens - whole, self.order, rest, whole))
            self.order += 1

    def rows(self, last: bool = False) -> list[tuple]:
        """Rows of finished windows, once enough has gathered or `last` is set."""
        most = self.packing.waiting
        if not last and len(self.rests) < most and len(self.windows) < most:
            return []
        packed, self.rests = pack(self.rests, self.packing.tiers)
        windows, self.windows = self.windows + packed, []
        if last:
            windows += last_windows(self.rests)
        rows, groups = [], grouped(windows, self.packing.group_windows)
        for window, group in zip(windows, groups):
            offset = 0
            for doc, start, length in window.pieces:
                ids = doc.ids[4 * (start - doc.first) : 4 * (start - doc.first + length)]
                row = (doc.doc_id, start, length, zlib.crc32(ids), doc.tokens, self.sequence, offset)
                rows.append((*row, window.size, self.group + group, ids))
                offset += length
            self.sequence += 1
        self.group += max(groups, default=-1) + 1
        return rows


def tier_packing(documents: DataFrame, packing: Packing = Packing(), with_ids: bool = False) -> DataFrame:
    """One row per piece. Sequences are as long as their `window`; all are full.

    Each task packs the rows that it reads, holding at most `waiting` remainders at a time, so nothing is shuffled and
    memory does not grow with the input. A null text is an empty one: its only id is the end id. Repeated rows and null
    doc_ids are packed like any other row; other columns are ignored; an empty table gives no rows. `with_ids` adds the
    ids of each piece, little-endian unsigned 32-bit.
    """
    schema = FULL if with_ids else SCHEMA
    kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64()] + [pa.binary()] * with_ids
    names = [f.split()[0] for f in schema.split(", ")]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))[: len(names)]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(packing, TaskContext.get().partitionId())
        encode, end = encoder(vocabulary(packing.tokenizer)).encode, np.array([packing.end_id], "<u4").tobytes()
        for part in slices(batches, 256):
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), encode(texts_of(part))):
                packer.add(doc_id, ids + end)
            if rows := packer.rows():
                yield batch(rows)
        if rows := packer.rows(last=True):
            yield batch(rows)

    return documents.select("doc_id", "text").mapInArrow(run, schema)
