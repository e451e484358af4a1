"""Repeated passages of documents, found by a hash-compared suffix sort, and their removal.

A byte is removed if a 50-byte string that covers it also starts in a document
with a smaller id. Every 50-byte window is filed under its anchor, the 22-byte gram in it
with the lowest hash (leftmost of equals), so equal windows have equal anchors at
equal offsets; windows in a row with one anchor form a run, about one for 15 bytes.

1. Tasks cut their rows into blocks of some MB and write each block's distinct texts
   to a file in the shared folder. Later steps read blocks from there.
2. A block sends its anchors' hashes, shortened and packed, by bucket; a bucket finds the anchors that
   several blocks have, and tells those blocks. An anchor that many blocks have is called hot.
3. A block sends the runs of repeated anchors with their bytes, equal runs once;
   what repeats inside the block is settled there. Runs of hot anchors go to parts of a bucket first, which settle
   equal runs among some blocks each, so that a passage of a third of all documents never meets in one task. What is left
   goes to buckets of all hot anchors by 36 bytes, the anchor and those that follow or precede it: so one short
   phrase in different contexts doesn't meet in one task either (one of 36 bytes or more in different contexts does).
4. A bucket settles equal runs, drops windows whose hash no other document's window has, and sorts the others,
   suffixes cut at 50 bytes, by merge sort; two suffixes are
   compared by their longest common prefix, which binary search finds on prefix
   polynomial hashes, and the byte behind it. Neighbours with a common prefix of 50
   are verified byte by byte. The smallest id of each class keeps the passage.
5. Blocks remove the spans they are told.

Nothing but blocks and a row per block is written; anchors and runs go through one shuffle each. A block sends at most a row to
each bucket, so there are (bytes / block_bytes) * (bytes / bucket_bytes) rows at most, each of some runs as long as a block has
more runs than there are buckets; for tens of TB take larger blocks and buckets (about 15 bytes of memory for a byte of either).

Defined cases: null and empty texts have no bytes; ids that are null rank last and never
make another text lose a passage; rows with the same id don't remove each other's text; empty tables give
empty results; a removal that splits a character leaves its bytes to the replacement character
in texts (digests are of the bytes); other columns are ignored, but for those to be carried.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm import common

WIDTH, GRAM = 50, 22
REACH = WIDTH - GRAM + 1  # grams in a window
NEAR = (REACH - 1) // 2  # bytes that every window has behind its anchor, or in front of it
BLOCK_BYTES = (1_500_000, 16_000_000)  # at least and at most; between them, two blocks for three shuffle partitions
SLICE_BYTES = 200_000  # of a block that are hashed at a time
WORDS_BYTES = 1 << 18  # of texts from which runs borrow strings when they are packed
ANCHOR_BYTES = 32_000_000  # of text whose anchors one bucket compares
BUCKET_BYTES = 8_000_000  # of text whose runs one bucket sorts
SORTED_TOGETHER = 100_000  # windows that a bucket sorts at a time
HOT_BLOCKS = 64  # an anchor of more blocks is hot
POSITION_BITS = 24  # of a gram's place beside its hash; longer data is taken in slices
SHORT_BITS = 27  # of an anchor's hash inside its bucket; a chance match only sends a run too many
LAST = (1 << 63) - 1
_B = 0x9E3779B97F4A7C15
_MASK = 0xFFFFFFFFFFFFFFFF
_ODD = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB], dtype=np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _ODD[0]
    h = (h ^ (h >> np.uint64(27))) * _ODD[1]
    return h ^ (h >> np.uint64(31))


class PrefixHashes:
    """Polynomial hash of any substring, from hashes of the prefixes (modulo 2**64)."""

    def __init__(self, data: np.ndarray):
        self.data = data
        power = np.full(len(data), _B, np.uint64)
        np.cumprod(power, out=power)
        power *= data.astype(np.uint64) + np.uint64(1)
        self.total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(power, out=self.total[1:])
        self.inverse = np.full(len(data) + 1, pow(_B, -1, 1 << 64), np.uint64)
        np.cumprod(self.inverse, out=self.inverse)

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return _mix((self.total[start + length] - self.total[start]) * self.inverse[start])

    def common_prefix(self, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
        """Longest common prefix of the suffixes at a and b, up to `limit`, by binary search."""
        found = np.full(len(a), limit, np.int64)
        open_ = np.flatnonzero(self.of(a, limit) != self.of(b, limit))  # equal ones need no search
        a, b = a[open_], b[open_]
        low, high = np.zeros(len(a), np.int64), np.full(len(a), limit - 1, np.int64)
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self.of(a, middle) == self.of(b, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        found[open_] = low
        return found

    def less(self, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
        """Whether the suffix at a (cut at `limit`) sorts before that at b."""
        n = self.common_prefix(a, b, limit)
        at = np.minimum(n, limit - 1)
        return (n < limit) & (self.data[a + at] < self.data[b + at])


def merge_sort(hashes: PrefixHashes, suffixes: np.ndarray, segment: np.ndarray, limit: int) -> np.ndarray:
    """Order of `suffixes` within their segments (equal numbers in a row), by bottom-up merge sort of all segments at once.

    A merge places each element by binary search in the other run: as many hash comparisons as the logarithm of the run.
    """
    n = len(suffixes)
    order = np.arange(n)
    first = np.flatnonzero(np.diff(segment, prepend=segment[:1] - 1)) if n else order
    size = np.diff(np.append(first, n))
    begin, end = np.repeat(first, size), np.repeat(first + size, size)
    width = 1
    while (size > width).any():
        at = np.arange(n)
        run = begin + (at - begin) // width * width
        left = (run - begin) // width % 2 == 0
        other0 = np.where(left, run + width, run - width)
        live = (end - begin > width) & (other0 < end)
        x = at[live]
        low, high = other0[x], np.minimum(other0[x] + width, end[x])
        start, is_left = low.copy(), left[x]
        mine = suffixes[order[x]]
        while (open_ := low < high).any():
            w = np.flatnonzero(open_)
            middle = (low[w] + high[w]) // 2
            theirs = suffixes[order[middle]]
            # before a left element go lesser ones, before a right element also equal ones
            goes = np.where(is_left[w], hashes.less(theirs, mine[w], limit), ~hashes.less(mine[w], theirs, limit))
            low[w], high[w] = np.where(goes, middle + 1, low[w]), np.where(goes, high[w], middle)
        target = np.where(is_left, x + (low - start), x - width + (low - start))
        placed = order.copy()
        placed[target] = order[x]
        order = placed
        width *= 2
    return order


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    out, most = np.ones(len(a), bool), 20_000
    for lo in range(0, len(a), most):
        part = slice(lo, lo + most)
        i = np.minimum(np.arange(int(length[part].max()))[None, :], length[part][:, None] - 1)
        out[part] = (data[a[part][:, None] + i] == data[b[part][:, None] + i]).all(1)
    return out


def leftmost_least(gram: np.ndarray) -> np.ndarray:
    """For every window, the place of its gram with the lowest hash; at most 2**POSITION_BITS grams."""
    n = len(gram) - REACH + 1
    best = (gram & np.uint64(_MASK << POSITION_BITS & _MASK)) | np.arange(len(gram), dtype=np.uint64)
    reach = 1
    while reach * 2 <= REACH:
        best = np.minimum(best[:-reach], best[reach:])
        reach *= 2
    best = np.minimum(best[:n], best[REACH - reach:REACH - reach + n])
    return (best & np.uint64((1 << POSITION_BITS) - 1)).astype(np.int64)


class Runs:
    """Runs of windows with one anchor, of several texts laid one after the other, with a byte behind each.

    start, count (of windows), anchor, text, key (hash of the anchor), content (hash of the run's bytes). Long data is hashed in
    slices; a run is cut where a slice ends.
    """

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data, n = data, len(data)
        step = min(SLICE_BYTES, (1 << POSITION_BITS) - REACH)
        parts = [self._slice(data[lo:lo + step + WIDTH - 1], lo, bounds) for lo in range(0, n - WIDTH + 1, step)]
        none = np.zeros(0, np.int64)
        parts.append((none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)))
        self.start, self.count, self.anchor, self.text, self.key, self.content = (np.concatenate(x) for x in zip(*parts))

    @staticmethod
    def _slice(data: np.ndarray, lo: int, bounds: np.ndarray) -> tuple:
        hashes, n = PrefixHashes(data), len(data) - WIDTH + 1
        gram = hashes.of(np.arange(len(data) - GRAM + 1), GRAM)
        chosen = leftmost_least(gram)
        first, last = np.searchsorted(bounds, (lo, lo + n), side="right")
        edges = np.clip(bounds[first - 1:last + 1], lo, lo + n)
        text = np.repeat(np.arange(first - 1, first - 1 + len(edges) - 1), np.diff(edges))
        at = np.flatnonzero(np.arange(lo + WIDTH, lo + WIDTH + n) < bounds[text + 1])
        chosen, text = chosen[at], text[at]
        new = np.flatnonzero((np.diff(chosen, prepend=-1) != 0) | (np.diff(text, prepend=-1) != 0))
        count = np.diff(np.append(new, len(at)))
        return at[new] + lo, count, chosen[new] + lo, text[new], gram[chosen[new]], hashes.of(at[new], count + WIDTH - 1)

    @cached_property
    def hashes(self) -> PrefixHashes:
        """Of all the data."""
        return PrefixHashes(self.data)


def planes(values: np.ndarray) -> bytes:
    """First bytes of all values, then second ones, and so on: zeros lie together."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def from_planes(data: bytes, dtype: str) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def pack_ints(values: np.ndarray) -> bytes:
    """Ascending numbers below 2**32."""
    return zstandard.compress(planes(np.diff(values, prepend=np.zeros(1, values.dtype)).astype("<u4")), 1)


def unpack_ints(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(zstandard.decompress(data), "<u4"), dtype=np.uint64)


_borrowed = [b""]  # text like that of the runs, whose strings packed runs borrow


def _borrow(words: bytes) -> None:
    _borrowed[0] = words


def _borrowing(step, words: bytes):
    """A step whose runs are packed, and were, with these words."""

    def run(rows: pa.Table) -> pa.Table:
        _borrow(words)
        return step(rows)

    return run


@lru_cache(maxsize=1)  # a coder keeps its tables
def _coders(words: bytes) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    known = zstandard.ZstdCompressionDict(words, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if words else None
    return zstandard.ZstdCompressor(level=9, dict_data=known), zstandard.ZstdDecompressor(dict_data=known)


def pack_runs(start: np.ndarray, count: np.ndarray, shift: np.ndarray, owner: np.ndarray, data: np.ndarray) -> bytes:
    """Runs in ascending order of start; shift: the anchor's place in the run; data: their bytes one after the other."""
    steps = np.diff(start, prepend=0).astype("<u4")
    parts = (len(start).to_bytes(4, "little"), planes(steps), count.astype("u1").tobytes(), shift.astype("u1").tobytes(), planes(np.diff(owner, prepend=0).astype("<i8")), data.tobytes())
    return _coders(_borrowed[0])[0].compress(b"".join(parts))


def unpack_runs(packed: bytes) -> tuple[np.ndarray, ...]:
    raw = _coders(_borrowed[0])[1].decompress(packed)
    n, at = int.from_bytes(raw[:4], "little"), 4
    start = np.cumsum(from_planes(raw[at:at + 4 * n], "<u4"), dtype=np.int64)
    count, shift = (np.frombuffer(raw, "u1", n, at + k * n).astype(np.int64) for k in (4, 5))
    owner = np.cumsum(from_planes(raw[at + 6 * n:at + 14 * n], "<i8"))
    return start, count, shift, owner, np.frombuffer(raw, np.uint8, offset=at + 14 * n)


def pack_spans(start: np.ndarray, end: np.ndarray) -> bytes:
    """Ascending spans that don't touch."""
    return pack_ints(np.column_stack((start, end)).ravel())


def unpack_spans(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    edges = unpack_ints(packed).astype(np.int64).reshape(-1, 2)
    return edges[:, 0], edges[:, 1]


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals (touching ones join)."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.append(True, start[1:] > end[:-1]))
    return start[new], end[np.append(new[1:] - 1, len(end) - 1)]


class Block:
    """Distinct texts and, for each, its documents: ids and carried values."""

    def __init__(self, texts: list[bytes], ids: list[list[int | None]], carried: list[list[tuple]] | None = None):
        self.texts, self.ids, self.carried = texts, ids, carried or [[()] * len(own) for own in ids]
        # a byte between texts, so that their spans never touch
        self.bounds = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts]))).astype(np.int64)
        self.data = np.frombuffer(b"".join(t + b"\0" for t in texts), np.uint8)
        self.least = np.array([min(LAST if i is None else i for i in own) for own in ids], np.int64)

    def write(self, folder: str, name: int) -> None:
        import pickle

        fs, path = common.filesystem(folder)
        with fs.open_output_stream(f"{path}/block-{name}", compression=None) as out:
            out.write(zstandard.compress(pickle.dumps((self.texts, self.ids, self.carried)), 9))

    @classmethod
    def read(cls, folder: str, name: int) -> "Block":
        import pickle

        fs, path = common.filesystem(folder)
        with fs.open_input_stream(f"{path}/block-{name}", compression=None) as source:
            return cls(*pickle.loads(zstandard.decompress(source.read())))


def bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    return ((key >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def short(key: np.ndarray) -> np.ndarray:
    return key & np.uint64((1 << SHORT_BITS) - 1)


BLOCKS = "block long"
ANCHORS = "bucket long, block long, keys binary, hot binary"
#: Of a bucket (negative: spans of a block) and a part of it.
SENT = "bucket long, part long, block long, payload binary"
_ARROW = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}


def _table(rows: list[dict], ddl: str) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=pa.schema([(c.split()[0], _ARROW[c.split()[1]]) for c in ddl.split(", ")]))


def _split(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(key, places of it) of each distinct key, places in ascending order."""
    order = np.argsort(keys, kind="stable")
    present, first = np.unique(keys[order], return_index=True)
    yield from zip(present.tolist(), np.split(order, first[1:]))


def _make_blocks(folder: str, block_bytes: int):
    """Writes block files; a row for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        fs, path = common.filesystem(folder)
        fs.create_dir(path, recursive=True)
        held: dict[bytes, tuple[list, list]] = {}
        size = number = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size, number
            name = (context.taskAttemptId() << 24) + number  # a retried task's blocks have other names
            Block(list(held), [x[0] for x in held.values()], [x[1] for x in held.values()]).write(folder, name)
            held, size, number = {}, 0, number + 1
            return pa.RecordBatch.from_arrays([pa.array([name], pa.int64())], ["block"])

        for batch in batches:
            carried = zip(*(c.to_pylist() for c in batch.columns[2:])) if batch.num_columns > 2 else [()] * batch.num_rows
            for key, text, values in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), carried):
                text = text.as_py() or b""
                if text not in held:
                    size += len(text)
                ids, own = held.setdefault(text, ([], []))
                ids.append(key)
                own.append(values)
                size += 16
                if size >= block_bytes:
                    yield flush()
        if held:
            yield flush()

    return run


def _send_anchors(folder: str, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                block = Block.read(folder, name)
                keys = np.unique(Runs(block.data, block.bounds).key)
                rows = [{"bucket": b, "block": name, "keys": pack_ints(np.unique(short(keys[own])))} for b, own in _split(bucket_of(keys, buckets))]
                yield from _table(rows, ANCHORS).to_batches()

    return run


def _repeated(hot_blocks: int):
    """Of one bucket: the keys that several blocks have, for each of those blocks, and which of them are hot."""

    def run(rows: pa.Table) -> pa.Table:
        names = rows.column("block").to_pylist()
        arrays = [unpack_ints(k) for k in rows.column("keys").to_pylist()]
        keys = np.concatenate(arrays)
        source = np.repeat(np.arange(len(arrays)), [len(a) for a in arrays])
        order = np.argsort(keys, kind="stable")
        keys, source = keys[order], source[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        size = np.diff(np.append(first, len(keys)))
        blocks = np.repeat(size, size)
        keys, source, blocks = keys[blocks > 1], source[blocks > 1], blocks[blocks > 1]
        bucket, out = rows.column("bucket")[0].as_py(), []
        for i, own in _split(source):
            hot = keys[own][blocks[own] > hot_blocks]
            out.append({"bucket": bucket, "block": names[i], "keys": pack_ints(keys[own]), "hot": pack_ints(hot) if len(hot) else None})
        return _table(out, ANCHORS)

    return run


def _part_of(block: int, parts: int) -> int:
    return 1 + zlib.crc32(block.to_bytes(8, "little")) % parts


def _send_runs(folder: str, anchor_buckets: int, buckets: int, parts: int):
    """Of one block: runs with repeated anchors, by bucket (from `buckets` on the hot ones, in parts), and the spans that are settled inside."""

    def run(rows: pa.Table) -> pa.Table:
        name = rows.column("block")[0].as_py()
        told, told_hot = {}, {}
        for b, k, h in zip(*(rows.column(c).to_pylist() for c in ("bucket", "keys", "hot"))):
            if k is not None:
                told[b] = unpack_ints(k)
                if h is not None:
                    told_hot[b] = unpack_ints(h)
        block = Block.read(folder, name)
        runs = Runs(block.data, block.bounds)
        # repeated elsewhere, or in several texts here
        keep, hot, short_key = np.zeros(len(runs.key), bool), np.zeros(len(runs.key), bool), short(runs.key)
        for b, own in _split(bucket_of(runs.key, anchor_buckets)):
            if b in told:
                keep[own] = np.isin(short_key[own], told[b])
                if b in told_hot:
                    hot[own] = np.isin(short_key[own], told_hot[b])
        order = np.lexsort((runs.text, runs.key))
        k, t = runs.key[order], runs.text[order]
        groups = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
        if not len(k):
            return _table([], SENT)
        differ = np.minimum.reduceat(t, groups) != np.maximum.reduceat(t, groups)
        keep[order] |= np.repeat(differ, np.diff(np.append(groups, len(k))))
        start, count, key, hot = runs.start[keep], runs.count[keep], runs.key[keep], hot[keep]
        if not len(start):
            return _table([], SENT)
        length, owner, shift = count + WIDTH - 1, block.least[runs.text[keep]], runs.anchor[keep] - start
        # equal runs: only those of the smallest id go on
        covered = _covered_runs(block.data, runs.content[keep], start, length, owner)
        out = []
        if covered.any():
            out.append({"bucket": -1, "part": name, "block": name, "payload": pack_spans(*merged(start[covered], start[covered] + length[covered]))})
        go = np.flatnonzero(~covered)
        for b, places in _split(bucket_of(key[go], buckets) + buckets * hot[go]):
            own = go[places]
            payload = pack_runs(start[own], count[own], shift[own], owner[own], _gathered(block.data, start[own], length[own]))
            out.append({"bucket": b, "part": _part_of(name, parts) if b >= buckets else 0, "block": name, "payload": payload})
        return _table(out, SENT)

    return run


def _gathered(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The bytes of the runs, one after the other."""
    total = np.concatenate(([0], np.cumsum(length)))
    return data[np.repeat(start - total[:-1], length) + np.arange(total[-1])]


class SentRuns:
    """The runs that some blocks have sent, one after the other."""

    def __init__(self, rows: pa.Table):
        self.names = rows.column("block").to_pylist()
        parts = [unpack_runs(p) for p in rows.column("payload").to_pylist()]
        self.start, self.count, self.shift, self.owner, self.data = (np.concatenate(x) for x in zip(*parts))
        self.source = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
        self.length = self.count + WIDTH - 1
        self.base = np.cumsum(self.length) - self.length
        # hashed in portions
        self.content, self.key = np.zeros(len(self.base), np.uint64), np.zeros(len(self.base), np.uint64)
        for i, j in _portions(np.arange(len(self.base)), self.length, SLICE_BYTES):
            at = self.base[i:j] - self.base[i]
            hashes = PrefixHashes(self.data[self.base[i]:self.base[j - 1] + self.length[j - 1]])
            self.content[i:j] = hashes.of(at, self.length[i:j])
            self.key[i:j] = hashes.of(at + self.shift[i:j], GRAM)
        self.covered = _covered_runs(self.data, self.content, self.base, self.length, self.owner)

    def spans(self, record: np.ndarray, begin: np.ndarray, end: np.ndarray) -> Iterator[dict]:
        """A row for each block of the spans in its runs."""
        for i, own in _split(self.source[record]):
            yield {"bucket": -1, "part": self.names[i], "block": self.names[i], "payload": pack_spans(*merged(begin[own], end[own]))}

    def by_context(self, own: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Cuts runs in two, by the side of the anchor on which all windows have `NEAR` bytes more: (run, windows before, windows, hash of anchor and these bytes)."""
        # a window has its anchor `shift` less its number in: the first ones have bytes in front of it
        first = np.clip(self.shift[own] - NEAR, 0, self.count[own])
        for skip, count, at in ((np.zeros_like(first), first, self.shift[own] - NEAR), (first, self.count[own] - first, self.shift[own])):
            some = np.flatnonzero(count)
            runs, context = own[some], np.zeros(len(some), np.uint64)
            for i, j in _portions(np.arange(len(runs)), self.length[runs], SLICE_BYTES):
                base = np.cumsum(self.length[runs[i:j]]) - self.length[runs[i:j]]
                hashes = PrefixHashes(_gathered(self.data, self.base[runs[i:j]], self.length[runs[i:j]]))
                context[i:j] = hashes.of(base + at[some[i:j]], GRAM + NEAR)
            yield runs, skip[some], count[some], context

    def settled(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Equal runs: all but those of the smallest id are lost whole."""
        lost = np.flatnonzero(self.covered)
        return lost, self.start[lost], self.start[lost] + self.length[lost]


def _sort_runs(buckets: int):
    def run(rows: pa.Table) -> pa.Table:
        return _sorted_runs(rows, buckets)

    return run


def _sorted_runs(rows: pa.Table, buckets: int) -> pa.Table:
    """Of one bucket: for each block, the spans of windows that a document with a smaller id has too.

    Of a part of a bucket of hot anchors: only equal runs are settled, and what is left goes on, dealt by context. Spans pass.
    """
    bucket, part = rows.column("bucket")[0].as_py(), rows.column("part")[0].as_py()
    if bucket < 0:
        return rows.select([c.split()[0] for c in SENT.split(", ")])
    runs = SentRuns(rows)
    if part:
        out = list(runs.spans(*runs.settled()))
        for own, skip, count, context in runs.by_context(np.flatnonzero(~runs.covered)):
            goes = bucket_of(context, buckets)
            for place, places in _split(runs.source[own] * buckets + goes):
                i, n, k = own[places], count[places], skip[places]
                payload = pack_runs(runs.start[i] + k, n, runs.shift[i] - k, runs.owner[i], _gathered(runs.data, runs.base[i] + k, n + WIDTH - 1))
                out.append({"bucket": buckets + place % buckets, "part": 0, "block": runs.names[place // buckets], "payload": payload})
        return _table(out, SENT)
    spans = [runs.settled()]
    # runs whose anchor belongs to one document only can't match
    left = np.flatnonzero(~runs.covered)
    order = left[np.argsort(runs.key[left], kind="stable")]
    group = np.flatnonzero(np.append(True, runs.key[order][1:] != runs.key[order][:-1]))
    sizes = np.diff(np.append(group, len(order)))
    several = np.repeat(np.minimum.reduceat(runs.owner[order], group) != np.maximum.reduceat(runs.owner[order], group), sizes)
    number = np.repeat(np.arange(len(group)), sizes)[several]
    use = order[several]
    for first, last in _portions(number, runs.count[use], SORTED_TOGETHER):
        own = use[first:last]
        hashes = PrefixHashes(_gathered(runs.data, runs.base[own], runs.length[own]))
        base = np.cumsum(runs.length[own]) - runs.length[own]
        run, step = _lost_windows(hashes, number[first:last], runs.count[own], runs.owner[own], runs.shift[own], base)
        begin = runs.start[own[run]] + step
        spans.append((own[run], begin, begin + WIDTH))
    return _table(list(runs.spans(*(np.concatenate(x) for x in zip(*spans)))), SENT)


def _covered_runs(data: np.ndarray, content: np.ndarray, start: np.ndarray, length: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Whether an equal run has a smaller owner; equal hashes are verified byte by byte."""
    order = np.lexsort((owner, length, content))
    c, n = content[order], length[order]
    head = np.append(True, (c[1:] != c[:-1]) | (n[1:] != n[:-1]))
    lead = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    later = owner[order] > owner[lead]
    i, j = order[later], lead[later]
    out = np.zeros(len(start), bool)
    out[i] = same_bytes(data, start[i], start[j], length[i])
    return out


def _portions(number: np.ndarray, windows: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Cuts the runs between numbers, about `most` windows together."""
    if not len(number):
        return
    edges = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
    total = np.concatenate(([0], np.cumsum(windows)))[edges]
    cuts = edges[np.flatnonzero(np.append(True, np.diff(total // most) > 0))]
    yield from zip(cuts.tolist(), [*cuts[1:].tolist(), len(number)])


def _lost_windows(hashes: PrefixHashes, number, count, owner, shift, base) -> tuple[np.ndarray, np.ndarray]:
    """Sorts the windows of some anchors' runs; (run, window in it) where a smaller id has the window too."""
    # windows, filed by anchor and offset: only those of one file can be equal
    run = np.repeat(np.arange(len(count)), count)
    step = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
    file = number[run] * WIDTH + (shift[run] - step + WIDTH) % WIDTH
    # equal windows have equal hashes: others, and those of one document only, are out
    content = hashes.of(base[run] + step, WIDTH)
    order = np.argsort(content, kind="stable")
    group = np.flatnonzero(np.append(True, content[order][1:] != content[order][:-1]))
    own = owner[run][order]
    several = np.repeat(np.minimum.reduceat(own, group) != np.maximum.reduceat(own, group), np.diff(np.append(group, len(order))))
    stay = order[several]
    if not len(stay):
        return run[:0], step[:0]
    stay = stay[np.argsort(file[stay], kind="stable")]
    run, step, file = run[stay], step[stay], file[stay]
    suffix = base[run] + step
    order = merge_sort(hashes, suffix, file, WIDTH)
    run, step, suffix = run[order], step[order], suffix[order]
    near = np.flatnonzero(file[1:] == file[:-1])  # files are in the same order
    equal = np.zeros(len(suffix), bool)
    equal[near + 1] = hashes.common_prefix(suffix[near], suffix[near + 1], WIDTH) == WIDTH
    i = np.flatnonzero(equal)
    equal[i] = same_bytes(hashes.data, suffix[i - 1], suffix[i], np.full(len(i), WIDTH))
    classes = np.flatnonzero(~equal)
    least = np.repeat(np.minimum.reduceat(owner[run], classes), np.diff(np.append(classes, len(run))))
    lost = owner[run] > least
    return run[lost], step[lost]


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _apply(folder: str, carry: tuple[str, ...] | None, schema: str):
    def run(rows: pa.Table) -> pa.Table:
        block = Block.read(folder, rows.column("block")[0].as_py())
        spans = [unpack_spans(p) for p in rows.column("payload").to_pylist() if p is not None]
        s, e = (np.concatenate(x) for x in zip(*spans)) if spans else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        of = dict(_split(np.searchsorted(block.bounds, s, side="right") - 1)) if len(s) else {}
        out = []
        for t, (raw, ids, carried) in enumerate(zip(block.texts, block.ids, block.carried)):
            begin, end = merged(s[of[t]] - block.bounds[t], e[of[t]] - block.bounds[t]) if t in of else (s[:0], e[:0])
            edges = [0, *np.column_stack((begin, end)).ravel().tolist(), len(raw)]
            kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
            for key, values in zip(ids, carried):
                result = (int((end - begin).sum()), len(begin), kept)
                if len(raw) >= WIDTH and (LAST if key is None else key) > block.least[t]:
                    result = (len(raw), 1, b"")  # a copy of a smaller id's text in this block
                row = {"doc_id": key, "n_bytes": len(raw), "n_removed": result[0], "n_spans": result[1], "kept_sha256": hashlib.sha256(result[2]).hexdigest()}
                if carry is not None:
                    row |= {"kept_text": result[2].decode("utf-8", "replace"), **dict(zip(carry, values))}
                out.append(row)
        return _table(out, schema)

    return run


def remove_repeats(
    docs: DataFrame, carry: tuple[str, ...] | None = None, block_bytes: int | None = None, bucket_bytes: int = BUCKET_BYTES, hot_blocks: int = HOT_BLOCKS
) -> DataFrame:
    """What is left of every row of `docs` (doc_id, text), and how much was removed; carry: also kept_text, and these columns as strings."""
    spark = docs.sparkSession
    common.ship(spark)
    docs = docs.select("doc_id", "text", *[F.col(c).cast("string").alias(c) for c in carry or ()])
    total = docs.agg(F.sum(common.utf8_bytes(F.col("text")))).first()[0] or 0
    block_bytes = block_bytes or min(max(2 * total // (3 * common.shuffle_partitions(spark)), BLOCK_BYTES[0]), BLOCK_BYTES[1])
    folder = f"{common.shared_dir(spark)}/blocks"
    blocks = common.checkpoint(docs.mapInArrow(_make_blocks(folder, block_bytes), BLOCKS))
    anchor_buckets, buckets = (max(common.shuffle_partitions(spark), math.ceil(total / each)) for each in (max(ANCHOR_BYTES, bucket_bytes), bucket_bytes))
    parts = max(12, math.ceil(total / (hot_blocks * block_bytes)))
    words = b"".join(r[0].encode() for r in docs.filter("text <> ''").select(F.substring("text", 1, 2000)).limit(256).collect())[:WORDS_BYTES]
    # a row stands for a block, whatever its size: the number of tasks is given
    tasks = 2 * common.shuffle_partitions(spark)
    anchors = blocks.repartition(tasks).mapInArrow(_send_anchors(folder, anchor_buckets), ANCHORS)
    repeated = anchors.groupBy("bucket").applyInArrow(_repeated(hot_blocks), ANCHORS)
    plain = blocks.selectExpr("cast(null as long) as bucket", "block", "cast(null as binary) as keys", "cast(null as binary) as hot")
    sent = plain.unionByName(repeated).repartition(tasks, "block").groupBy("block").applyInArrow(_borrowing(_send_runs(folder, anchor_buckets, buckets, parts), words), SENT)
    sort = _borrowing(_sort_runs(buckets), words)
    spans = sent.groupBy("bucket", "part").applyInArrow(sort, SENT).groupBy("bucket", "part").applyInArrow(sort, SENT)
    told = blocks.selectExpr("block", "cast(null as binary) as payload").unionByName(spans.select("block", "payload"))
    schema = RESULT + "".join(f", {c} string" for c in ("kept_text", *carry)) if carry is not None else RESULT
    return told.repartition(tasks, "block").groupBy("block").applyInArrow(_apply(folder, carry, schema), schema)
