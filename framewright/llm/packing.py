"""Hierarchical packing of documents into windows of several context sizes.

Every document's ids are cut into full windows of the longest tier and a tail;
the tail is routed to the shortest tier that holds it. Long windows go first:
each starts with a tail of its own tier, and its gap is filled with the largest
tails of the shorter tiers that fit; what still stays open is filled with the
beginning of a shorter tail, whose rest is routed again. When the shorter tiers
are used up, open windows are filled by cutting tails of their own tier. So a
task leaves one open window at its end, whatever its input is; that window is cut into
the tiers it fills and one padded rest.

Tiers are powers of two, so a full window of any tier carries no padding.
Sequences get a step group: groups of one tier hold the same number of windows,
so that every step works on the same number of tokens.

A task packs the rows of its own partition in bounded groups and carries the open
rest along: no shuffle, bounded memory.

Defined cases: null text counts as empty, its document has the end id only; a null
doc_id is kept as null; repeated rows are packed once each; other columns are ignored.
"""

from __future__ import annotations

import bisect
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from framewright.llm import common
from framewright.llm.tokens import token_ids

TIERS = (1024, 512, 256)
GROUP_TOKENS = 2_000_000  # ids packed together, a bound on memory
STEP_TOKENS = 8192
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long"


class TierPool:
    """Tails that wait, by tier; taken by best fit."""

    def __init__(self, tiers: tuple[int, ...]):
        self.tiers = tiers
        self.waiting: dict[int, list[tuple[int, int, int]]] = {t: [] for t in tiers}  # sorted (length, doc, start)

    def add(self, length: int, doc: int, start: int) -> None:
        tier = min(t for t in self.tiers if t >= length)
        bisect.insort(self.waiting[tier], (length, doc, start))

    def best(self, room: int, below: int) -> tuple[int, int, int] | None:
        """The longest waiting tail of the tiers shorter than `below` that fits."""
        found = None
        for tier in self.tiers:
            if tier < below and (held := self.waiting[tier]):
                at = bisect.bisect_right(held, (room, 1 << 62, 0)) - 1
                if at >= 0 and (found is None or held[at][0] > found[1][at_found][0]):
                    found, at_found = (tier, held), at
        return found[1].pop(at_found) if found else None

    def longest(self, upto: int) -> tuple[int, int, int] | None:
        for tier in self.tiers:
            if tier <= upto and self.waiting[tier]:
                return self.waiting[tier].pop()
        return None


def pack(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> tuple[list[tuple[int, list[tuple[int, int, int]]]], list[tuple[int, int, int]]]:
    """Windows (tier, [(doc, start, length)]) that are full, and the pieces of the one that is not."""
    windows, pool, top = [], TierPool(tiers), tiers[0]
    for doc, n in enumerate(lengths):
        full = n - n % top
        windows += [(top, [(doc, at, top)]) for at in range(0, full, top)]
        if n > full:
            pool.add(n - full, doc, full)
    for tier in tiers:
        while pool.waiting[tier]:
            length, doc, start = pool.waiting[tier].pop()
            window, room = [(doc, start, length)], tier - length
            while room:
                piece = pool.best(room, tier)
                if piece is None:
                    piece = pool.longest(tier)  # longer than the gap, or of this tier: cut
                    if piece is None:
                        return windows, window
                length, doc, start = piece
                if length > room:
                    pool.add(length - room, doc, start + room)
                    length = room
                window.append((doc, start, length))
                room -= length
            windows.append((tier, window))
    return windows, []


def cut_rest(rest: list[tuple[int, int, int]], tiers: tuple[int, ...]) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """The last open window, as full windows of the tiers and one rest (tier: the longest, which it is padded to)."""
    windows, total = [], sum(p[2] for p in rest)
    for tier in tiers:
        while total >= tier:
            window, room = [], tier
            while room:
                doc, start, length = rest.pop(0)
                if length > room:
                    rest.insert(0, (doc, start + room, length - room))
                    length = room
                window.append((doc, start, length))
                room -= length
            windows.append((tier, window))
            total -= tier
    return [*windows, (tiers[0], rest)] if rest else windows


def _packer(vocabulary: str, end_id: int, tiers: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 40
        encode, end = token_ids(vocabulary), struct.pack("<I", end_id)
        counts = dict.fromkeys(tiers, 0)
        group: list[tuple[int | None, int, int, bytes]] = []  # doc_id, ids before, all ids, ids
        sequence, held = first, 0

        def flush(last: bool):
            nonlocal group, sequence, held
            windows, rest = pack([len(g[3]) // 4 for g in group], tiers)
            if last:
                windows, rest = windows + cut_rest(rest, tiers), []
            rows = []
            for tier, window in windows:
                offset = 0
                step = first + (tiers.index(tier) << 32) + counts[tier] // max(1, STEP_TOKENS // tier)
                counts[tier] += 1
                for doc, start, length in window:
                    key, before, total, ids = group[doc]
                    rows.append((key, before + start, length, zlib.crc32(memoryview(ids)[4 * start:4 * (start + length)]), total, sequence, offset, tier, step))
                    offset += length
                sequence += 1
            group = [(group[d][0], group[d][1] + s, group[d][2], group[d][3][4 * s:4 * (s + n)]) for d, s, n in rest]
            held = sum(len(g[3]) // 4 for g in group)
            types = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
            names = [x.split()[0] for x in PIECES.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names) if rows else None

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py()) + end
                group.append((key, 0, len(ids) // 4, ids))
                held += len(ids) // 4
                if held >= GROUP_TOKENS and (out := flush(False)) is not None:
                    yield out
        if group and (out := flush(True)) is not None:
            yield out

    return run


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int = 0, tiers: tuple[int, ...] = TIERS) -> DataFrame:
    """A row per piece of `docs` (doc_id, text): where it lies in its document and in its sequence."""
    if list(tiers) != sorted(tiers, reverse=True) or any(t & (t - 1) for t in tiers):
        raise ValueError("tiers must be powers of two, longest first")
    common.ship(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_packer(vocabulary, end_id, tuple(tiers)), PIECES)
