"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

Vectors become whole numbers; candidates are put in order by label and by their place on a Hilbert curve through
the cells of their leading principal axes, and written to Parquet files of one label: a row group is a block, and the file's metadata
holds its blocks' zone maps (the least and the largest value of every dimension). A table has the zone map of each file.

A task has some anchors, and for each the bounds of its score with any vector of a zone: the interval product of the anchor and
the zone. It first reads, in the order of their upper bounds, the blocks of an anchor's label until no block left can hold one of its
positives; then, for the windows that the positives' scores set, the blocks of other labels whose interval meets a window above its worst negative so far.
Scores are exact: products of doubles while all sums stay below 2^53, else of Python integers.

Nothing is broadcast but the axes (256 x 256 at most). A task holds the zone maps of files, `FILE_BLOCKS` x `BLOCK` vectors each, and one block. How much is skipped
depends on the data: zones of vectors in random directions overlap, and then an anchor's task reads most blocks, once for all its anchors.

Defined cases: rows with a null id or label, with a vector that is null, empty or has null or non-finite components, or a component
so large that scores of such vectors could pass 2^62 (of 64 dimensions: from 1,048,576 on) take no part; vectors meet those of their own length only; rows that share an id count as one, the first by label and vector;
ties go to the smaller id; an anchor without positives, and a window without negatives, have no rows; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm import common, embed

AXES, BITS = 6, 8  # of the Hilbert curve
BLOCK, FILE_BLOCKS = 512, 32
ANCHORS = 1024  # of one task at once
POSITIVES = NEGATIVES = 5
LOW, HIGH = 80, 100  # percent of the positive's score
SCALE, LARGEST = 256, 2.0**62  # of a vector's product with itself
EXACT = float(1 << 53)
FILES = "path string, label long, size int, low array<long>, high array<long>"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of cells (rows of coordinates below 2^bits).

    Each bit, from the highest on, undoes the rotation and reflection of the
    sub-cube that the point lies in; then the coordinates, in Gray code, are interleaved.
    """
    x = cells.T.astype(np.int64).copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        bit, below = 1 << level, (1 << level) - 1
        for axis in range(n):
            on = (x[axis] & bit) != 0
            swap = np.where(on, 0, (x[0] ^ x[axis]) & below)
            x[0] ^= np.where(on, below, swap)
            x[axis] ^= swap
    for axis in range(1, n):
        x[axis] ^= x[axis - 1]
    flip = np.zeros(x.shape[1], dtype=np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> level) & 1, (1 << level) - 1, 0)
    x ^= flip
    out = np.zeros(x.shape[1], dtype=np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in range(n):
            out = (out << 1) | ((x[axis] >> level) & 1)
    return out


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, size, v): the rows that take part, with their labels changed and components as whole numbers."""
    v = F.col("embedding")
    largest = F.sqrt(F.lit(LARGEST) / F.size(v))  # so that any score fits in a long
    fits = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * SCALE) < largest)), F.lit(False)) & (F.size(v) > 0)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = vectors.select("vec_id", F.col("label").cast("long").alias("label"), v.cast("array<double>").alias("embedding"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).filter(fits)
    rows = rows.select("vec_id", label.alias("label"), F.transform(v, lambda x: F.floor(x * SCALE).cast("long")).alias("v"))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("x")).select("vec_id", "x.label", F.size("x.v").alias("size"), "x.v")


def _place(bases: dict[int, np.ndarray]):
    """Adds the place on the curve of the directions of the vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch.column(2))
            for size in np.unique(sizes).tolist():
                own = batch.filter(pa.array(sizes == size))
                x = np.asarray(own.column(3).flatten(), dtype=np.float64).reshape(len(own), -1)
                length = np.sqrt((x * x).sum(1, keepdims=True))
                place = (x / np.where(length > 0, length, 1)) @ (bases[size] if size in bases else np.eye(size)[:, :AXES])
                cells = np.clip(np.floor((place + 1) / 2 * (1 << BITS)), 0, (1 << BITS) - 1)
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(hilbert_index(cells.astype(np.int64), BITS))], [*own.schema.names, "place"])

    return run


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), dtype=np.int64).reshape(len(column), -1)


def _write(folder: str):
    """Writes runs of the order as Parquet files, a row group a block; a row with its zone map for each file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().taskAttemptId() << 24  # a retried task's files have other names
        fs, root = common.filesystem(folder)
        fs.create_dir(root, recursive=True)
        held: list[pa.RecordBatch] = []

        def file() -> pa.RecordBatch:
            nonlocal number
            number += 1
            rows = pa.Table.from_batches(held).combine_chunks()
            v, size = _matrix(rows.column("v")), rows.column("size")[0].as_py()
            cuts = range(0, len(v), BLOCK)
            low, high = (np.array([f(v[a:a + BLOCK], axis=0) for a in cuts]) for f in (np.min, np.max))
            narrow = pa.int32() if abs(v).max() < 1 << 31 else pa.int64()
            body = pa.table({"vec_id": rows.column("vec_id"), "v": pa.FixedSizeListArray.from_arrays(pa.array(v.ravel()).cast(narrow), size)})
            body = body.replace_schema_metadata({"low": low.astype("<i8").tobytes(), "high": high.astype("<i8").tobytes()})
            path = f"{root}/blocks-{number}.parquet"
            with fs.open_output_stream(path) as out:
                pq.write_table(body, out, row_group_size=BLOCK, compression="zstd")
            row = (path, rows.column("label")[0].as_py(), size, low.min(0).tolist(), high.max(0).tolist())
            held.clear()
            types = [pa.string(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], [c.split()[0] for c in FILES.split(", ")])

        for batch in batches:
            label, size = np.asarray(batch.column(1)), np.asarray(batch.column(2))
            edges = [0, *(1 + np.flatnonzero((label[1:] != label[:-1]) | (size[1:] != size[:-1]))).tolist(), batch.num_rows]
            for first, last in zip(edges[:-1], edges[1:]):
                if held and (held[0].column(1)[0].as_py(), held[0].column(2)[0].as_py()) != (label[first], size[first]):
                    yield file()
                while first < last:
                    part = batch.slice(first, min(last - first, BLOCK * FILE_BLOCKS - sum(h.num_rows for h in held)))
                    held.append(part)
                    first += part.num_rows
                    if sum(h.num_rows for h in held) == BLOCK * FILE_BLOCKS:
                        yield file()
        if held:
            yield file()

    return run


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of the rows of two integer matrices."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(object) @ b.astype(object).T


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest score that each row of `a` may have with any vector of each zone."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return _product(up, low) + _product(down, high), _product(up, high) + _product(down, low)


class Best:
    """The best of each row's windows so far. A window takes scores from its floor (at last that of its k-th best) to its top."""

    def __init__(self, floors: np.ndarray, tops: np.ndarray, k: int):
        self.floors, self.tops, self.k = floors, tops, k
        self.held: dict[tuple[int, int], list[tuple[int, int]]] = {}  # (-score, id), in order

    def wanted(self, least: np.ndarray, most: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Whether rows may find any in a zone whose scores lie between these bounds."""
        return ((least[:, None] <= self.tops[rows]) & (most[:, None] >= self.floors[rows])).any(1)

    def take(self, ids: np.ndarray, scores: np.ndarray, rows: np.ndarray) -> None:
        for w in range(self.floors.shape[1]):
            ok = (scores >= self.floors[rows, w][:, None]) & (scores <= self.tops[rows, w][:, None])
            for x in np.flatnonzero(ok.any(1)).tolist():
                key = (int(rows[x]), w)
                own = zip((-scores[x][ok[x]]).tolist(), ids[ok[x]].tolist())
                held = heapq.nsmallest(self.k, [*self.held.get(key, ()), *own])
                self.held[key] = held
                if len(held) == self.k:
                    self.floors[key] = -held[-1][0]


class Zones:
    """The files' zone maps of one length of vectors, and the blocks of a file on demand."""

    def __init__(self, files: list[dict], fs):
        self.fs, self.paths = fs, [f["path"] for f in files]
        self.labels = np.array([f["label"] for f in files], dtype=np.int64)
        self.low, self.high = (np.array([f[c] for f in files], dtype=np.int64) for c in ("low", "high"))
        self.blocks_read = 0

    def search(self, anchors: np.ndarray, which: np.ndarray, best: Best, skip: np.ndarray) -> None:
        """Reads the blocks of the files `which` that any of the anchors wants; an anchor never meets its own id (`skip`)."""
        least, most = bounds(anchors, self.low[which], self.high[which])
        every = np.arange(len(anchors))
        for at in np.argsort(-most.max(0).astype(np.float64), kind="stable").tolist():
            some = every[best.wanted(least[:, at], most[:, at], every)]
            if not len(some):
                continue
            with self.fs.open_input_file(self.paths[which[at]]) as source:
                file = pq.ParquetFile(source)
                zones = [np.frombuffer(file.schema_arrow.metadata[c], dtype="<i8").reshape(-1, anchors.shape[1]) for c in (b"low", b"high")]
                b_least, b_most = bounds(anchors[some], *zones)
                for block in np.argsort(-b_most.max(0).astype(np.float64), kind="stable").tolist():
                    rows = some[best.wanted(b_least[:, block], b_most[:, block], some)]
                    if len(rows):
                        self.blocks_read += 1
                        body = file.read_row_group(block)
                        ids, v = np.asarray(body.column("vec_id")), _matrix(body.column("v"))
                        others = ~np.isin(ids, skip)
                        best.take(ids[others], _product(anchors[rows], v[others]), rows)
                        for x in np.flatnonzero(~others).tolist():  # an anchor, which others than itself may take
                            own = rows[skip[rows] != ids[x]]
                            best.take(ids[x:x + 1], _product(anchors[own], v[x:x + 1]), own)


def mine(label: int, ids: np.ndarray, anchors: np.ndarray, zones: Zones) -> Iterator[tuple]:
    """Rows of `RESULT` for anchors of one label and length."""
    n, ends = len(ids), np.iinfo(np.int64)
    same = Best(np.full((n, 1), ends.min), np.full((n, 1), ends.max), POSITIVES)
    zones.search(anchors, np.flatnonzero(zones.labels == label), same, ids)
    floors, tops = np.ones((n, POSITIVES), np.int64), np.zeros((n, POSITIVES), np.int64)  # windows that take none
    for (r, _), held in same.held.items():
        for w, (minus, _) in enumerate(held):
            floors[r, w], tops[r, w] = -(LOW * minus // HIGH), -minus  # the least whole number of the window
    other = Best(floors, tops, NEGATIVES)
    zones.search(anchors, np.flatnonzero(zones.labels != label), other, np.array([], dtype=np.int64))
    for (r, w), held in other.held.items():
        minus, positive = same.held[r, 0][w]
        for rank, (m, negative) in enumerate(held, 1):
            yield int(ids[r]), positive, rank, negative, -minus, -m


def _mine(files_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        zones: dict[int, Zones] = {}
        fs, path = common.filesystem(files_path)

        def zones_of(size: int) -> Zones:
            if size not in zones:
                rows = pq.read_table(path, filesystem=fs, filters=[("size", "=", size)]).to_pylist()
                zones[size] = Zones(sorted(rows, key=lambda f: f["path"]), fs)
            return zones[size]

        def done() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            label, size = np.asarray(rows.column("label")), np.asarray(rows.column("size"))
            for s, l in sorted(set(zip(size.tolist(), label.tolist()))):
                own = rows.filter(pa.array((size == s) & (label == l)))
                out = list(mine(l, np.asarray(own.column("vec_id")), _matrix(own.column("v")), zones_of(s)))
                columns = zip(*out) if out else [[]] * 6
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [c.split()[0] for c in RESULT.split(", ")])

        for batch in batches:
            for first in range(0, batch.num_rows, ANCHORS):
                held.append(batch.slice(first, ANCHORS))
                if sum(h.num_rows for h in held) >= ANCHORS:
                    yield from done()
        if held:
            yield from done()

    return run


def hard_negatives(vectors: DataFrame, every: int = 100) -> DataFrame:
    """`RESULT` for the anchors of `vectors` (vec_id, embedding, label): rows whose id is divisible by `every`."""
    spark = vectors.sparkSession
    common.ship(spark)
    rows = common.checkpoint(whole_vectors(vectors))
    lengths = rows.groupBy("size").count().orderBy(F.desc("count"), "size").limit(embed.MOST_LENGTHS).collect()
    plain = rows.filter(F.exists("v", lambda x: x != 0)).select(F.col("v").cast("array<double>").alias("embedding"))
    bases = {r["size"]: embed.principal_axes(plain, r["size"], AXES) for r in lengths}
    placed = rows.select("vec_id", "label", "size", "v").mapInArrow(_place(bases), "vec_id long, label long, size int, v array<long>, place long")
    placed = common.checkpoint(placed)
    order = ("size", "label", "place", "vec_id")
    tasks = common.shuffle_partitions(spark)
    ordered = placed.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    files = common.checkpoint(ordered.mapInArrow(_write(f"{common.shared_dir(spark)}/blocks"), FILES))
    anchors = placed.filter(F.col("vec_id") % every == 0).repartitionByRange(2 * tasks, *order)
    return anchors.select("vec_id", "label", "size", "v").mapInArrow(_mine(files._checkpoint_path), RESULT)
