"""Embedding near-duplicates: epsilon grid order join.

Vectors are scaled to length 1, so that a cosine threshold is a distance epsilon.
They are projected on the leading principal axes of all vectors of their length (from one pass of
sums), and put in grid order: by label, then by their cells along the axes, a fraction of epsilon wide.
Blocks are intervals of that order, and files in the shared folder. Two blocks are joined only where
their boxes on the axes come within epsilon: a task reads both, halves the two intervals and
joins the halves recursively; halves that are provably apart, by their boxes on the axes or by
their balls in the whole space, are skipped. Small intervals are compared by cosine in double precision.

How much is skipped depends on the data: of 5,000 vectors in random directions of a 64-dimensional space about half of the
comparisons, and more the more vectors there are; of vectors in groups nearly all. What moves between
tasks are pairs of block numbers; a pair of blocks is two reads of some 100 KB.

Equal vectors of a label are one class from the start; a class counts for all its
members. A block pair gives counts per class and a spanning forest of its links, not the pairs.

Defined cases: rows with a null label, and vectors that are null, empty, zero, or with null or non-finite components, link with
nothing; vectors are compared with those of their own length only; rows with a null id link with nothing; rows that share an id count as one
vector per distinct value; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.llm import common, graph

SORT_AXES, BOX_AXES, LEAF = 6, 16, 32
CELLS = 2  # of the grid in an epsilon
BLOCK = 2048
MOMENT = 256
MOST_LENGTHS = 8  # lengths of vectors, the most frequent ones, that get axes of their own; others use the first components


def can_link() -> Column:
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length."""
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def principal_axes(classes: DataFrame, size: int, axes: int) -> np.ndarray:
    """Leading eigenvectors of the second-moment matrix of the vectors of one length, in the space of their first MOMENT
    components; a MOMENT x MOMENT sum at most reaches the driver."""
    part = min(size, MOMENT)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((part, part))
        for batch in batches:
            x = _unit(_matrix(batch.column(0)))[:, :part]
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(range(part * part), pa.int32()), pa.array(total.ravel())], ["at", "value"])

    own = classes.filter(F.size("embedding") == size).select("embedding")
    rows = own.mapInArrow(sums, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    matrix = np.zeros(part * part)
    for r in rows:
        matrix[r["at"]] = r["value"]
    _, basis = np.linalg.eigh(matrix.reshape(part, part))
    return np.vstack((basis[:, ::-1][:, :axes], np.zeros((size - part, min(axes, part)))))


def _axes(bases: dict[int, np.ndarray], size: int) -> np.ndarray:
    return bases[size] if size in bases else np.eye(size)[:, :BOX_AXES]


PLACED = "label long, size int, embedding array<double>, node long, copies long, cell int, cells binary"


def _place(bases: dict[int, np.ndarray], width: float):
    """Adds the cell on the leading axis, and a key that sorts by all cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch.column(1))
            for size in np.unique(sizes).tolist():
                own = batch.filter(pa.array(sizes == size))
                cells = np.floor(_unit(_matrix(own.column(2))) @ _axes(bases, size)[:, :SORT_AXES] / width).astype(np.int32)
                keys = [c.tobytes() for c in (cells + (1 << 20)).astype(">i4")]
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(cells[:, 0]), pa.array(keys)], [*own.schema.names, "cell", "cells"])

    return run


BLOCKS = "block long, label long, size int, low array<double>, high array<double>, low_cell int, high_cell int"


def _write_block(folder: str, name: int, ids: np.ndarray, copies: np.ndarray, x: np.ndarray) -> None:
    narrow = x.astype("<f4")
    vectors = narrow if (narrow == x).all() else x.astype("<f8")
    fs, path = common.filesystem(folder)
    fs.create_dir(path, recursive=True)
    with fs.open_output_stream(f"{path}/block-{name}", compression=None) as out:
        np.savez(out, ids=ids, copies=copies, vectors=vectors)


def read_block(folder: str, name: int) -> dict[str, np.ndarray]:
    fs, path = common.filesystem(folder)
    with fs.open_input_file(f"{path}/block-{name}") as source:
        found = dict(np.load(io.BytesIO(source.read())))
    return found | {"vectors": found["vectors"].astype(np.float64)}


def _cut(folder: str, block_rows: int, bases: dict[int, np.ndarray]):
    """Writes intervals of the order as block files; a row for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().taskAttemptId() << 24  # a retried task's blocks have other names
        held: list[pa.RecordBatch] = []
        types = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.int32(), pa.int32()]

        def block() -> pa.RecordBatch:
            nonlocal number, held
            number += 1
            rows = pa.Table.from_batches(held).combine_chunks()
            column = lambda c: rows.column(c).combine_chunks()
            size, x = column("size")[0].as_py(), _matrix(column("embedding"))
            _write_block(folder, number, np.asarray(column("node")), np.asarray(column("copies")), x)
            place, cell = _unit(x) @ _axes(bases, size), column("cell")
            row = (number, column("label")[0].as_py(), size, place.min(0).tolist(), place.max(0).tolist(), cell[0].as_py(), cell[-1].as_py())
            held = []
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], [c.split()[0] for c in BLOCKS.split(", ")])

        for batch in batches:
            label, size = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            edges = [0, *(1 + np.flatnonzero((label[1:] != label[:-1]) | (size[1:] != size[:-1]))).tolist(), batch.num_rows]
            for first, last in zip(edges[:-1], edges[1:]):
                if held and (held[0].column(0)[0].as_py(), held[0].column(1)[0].as_py()) != (label[first], size[first]):
                    yield block()
                while first < last:
                    part = batch.slice(first, min(last - first, block_rows - sum(h.num_rows for h in held)))
                    held.append(part)
                    first += part.num_rows
                    if sum(h.num_rows for h in held) == block_rows:
                        yield block()
        if held:
            yield block()

    return run


class Side:
    """An interval of the grid order; boxes and balls of its sub-intervals are computed once."""

    def __init__(self, vectors: np.ndarray, axes: np.ndarray, width: float):
        self.x, self.norm = vectors, np.sqrt((vectors * vectors).sum(1))
        self.unit = _unit(vectors)
        self.place = self.unit @ axes
        self.known: dict[tuple[int, int], tuple] = {}
        # the first axis on which a row's cell is another than the row's before
        cells = np.floor(self.place[:, :SORT_AXES] / width)
        moved = cells[1:] != cells[:-1]
        self.change = np.append(0, np.where(moved.any(1), moved.argmax(1), SORT_AXES))

    def halves(self, first: int, last: int) -> list[tuple[int, int]]:
        """Cut near the middle where cells change on the axis that comes first; small intervals stay."""
        if last - first <= LEAF:
            return [(first, last)]
        middle, quarter = (first + last + 1) // 2, (last - first) // 4
        change = self.change[first + quarter:last - quarter]
        at = np.flatnonzero(change == change.min()) + first + quarter
        cut = int(at[np.abs(at - middle).argmin()])
        return [(first, cut), (cut, last)]

    def bounds(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Lowest and highest places on the axes; centre and radius."""
        if (first, last) not in self.known:
            place, x = self.place[first:last], self.unit[first:last]
            centre = x.mean(0)
            self.known[first, last] = place.min(0), place.max(0), centre, float(np.sqrt(((x - centre) ** 2).sum(1).max()))
        return self.known[first, last]


class IntervalJoin:
    """Recursive join of two intervals of the grid order (b None: of one with itself)."""

    def __init__(self, a: np.ndarray, b: np.ndarray | None, axes: np.ndarray, threshold: float, epsilon: float):
        self.own, self.threshold, self.reach = b is None, threshold, epsilon * (1 + 1e-9)
        self.a = Side(a, axes, epsilon / CELLS)
        self.b = self.a if b is None else Side(b, axes, epsilon / CELLS)
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, int), np.zeros(0, int))]
        self.compared = 0  # pairs of vectors
        self.join(0, len(a), 0, len(self.b.x))

    def apart(self, a0: int, a1: int, b0: int, b1: int) -> bool:
        low, high, centre, radius = self.a.bounds(a0, a1)
        low_b, high_b, centre_b, radius_b = self.b.bounds(b0, b1)
        gap = np.maximum(0, np.maximum(low - high_b, low_b - high))
        if gap @ gap > self.reach**2:
            return True
        between = centre - centre_b
        return between @ between > (self.reach + (radius + radius_b) * (1 + 1e-9)) ** 2

    def join(self, a0: int, a1: int, b0: int, b1: int) -> None:
        if a1 <= a0 or b1 <= b0 or (self.own and b1 <= a0) or self.apart(a0, a1, b0, b1):
            return
        if a1 - a0 <= LEAF and b1 - b0 <= LEAF:
            self.compared += (a1 - a0) * (b1 - b0)
            cosine = (self.a.x[a0:a1] @ self.b.x[b0:b1].T) / (self.a.norm[a0:a1, None] * self.b.norm[None, b0:b1])
            i, j = np.nonzero(cosine >= self.threshold)
            i, j = i + a0, j + b0
            if self.own:
                i, j = i[i < j], j[i < j]
            self.pairs.append((i, j))
            return
        for s, t in self.a.halves(a0, a1):
            for u, v in self.b.halves(b0, b1):
                self.join(s, t, u, v)


def _forest(i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """Of links i-j, those of a spanning forest."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    out = []
    for a, b in zip(i.tolist(), j.tolist()):
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
            out.append((a, b))
    return out


def _join_blocks(folder: str, bases: dict[int, np.ndarray], threshold: float, epsilon: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, *names in zip(*(batch.column(c).to_pylist() for c in ("size", "a_block", "b_block"))):
                a, b = (read_block(folder, names[0]), read_block(folder, names[1])) if names[0] != names[1] else (read_block(folder, names[0]), None)
                found = IntervalJoin(a["vectors"], None if b is None else b["vectors"], _axes(bases, size), threshold, epsilon)
                i, j = (np.concatenate(x) for x in zip(*found.pairs))
                if not len(i):
                    continue
                b = b or a
                near = np.bincount(i, b["copies"][j], len(a["ids"])), np.bincount(j, a["copies"][i], len(b["ids"]))
                tree = _forest(a["ids"][i], b["ids"][j])
                nodes = np.concatenate([a["ids"][near[0] > 0], b["ids"][near[1] > 0], [t[0] for t in tree]]).astype(np.int64)
                count = np.concatenate([near[0][near[0] > 0], near[1][near[1] > 0], np.zeros(len(tree))]).astype(np.int64)
                other = [None] * (len(nodes) - len(tree)) + [int(t[1]) for t in tree]
                yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(count), pa.array(other, pa.int64())], ["node", "links", "other"])

    return run


def near_blocks(blocks: DataFrame, epsilon: float) -> DataFrame:
    """(size, a_block, b_block) of the blocks whose boxes come within epsilon: met by label, length and leading cells."""
    facts = ["block", "low", "high"]
    cells = lambda more: F.explode(F.sequence(F.col("low_cell") - more, F.col("high_cell") + more)).alias("cell")
    a = blocks.select("label", "size", *[F.col(c).alias(f"a_{c}") for c in facts], cells(CELLS))
    b = blocks.select("label", "size", *[F.col(c).alias(f"b_{c}") for c in facts], cells(0))
    gaps = F.zip_with(F.zip_with("a_low", "b_high", lambda x, y: x - y), F.zip_with("b_low", "a_high", lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0)))
    square = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g)
    return a.join(b, ["label", "size", "cell"]).filter("a_block <= b_block").filter(square <= epsilon**2 * (1 + 1e-9)).select("size", "a_block", "b_block").distinct()


def near_vectors(vectors: DataFrame, threshold: float = 0.98, block_rows: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of `vectors` (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    common.ship(spark)
    vectors = vectors.select("vec_id", F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    epsilon = math.sqrt(2 - 2 * threshold)
    # +0.0 and -0.0 are one value
    plain = vectors.filter(can_link()).withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0.0)))
    classes = plain.groupBy("label", "embedding").agg(F.min("vec_id").alias("node"), F.countDistinct("vec_id").alias("copies"))
    classes = common.checkpoint(classes)
    lengths = classes.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), "size").limit(MOST_LENGTHS).collect()
    if not lengths:
        return vectors.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    bases = {r["size"]: principal_axes(classes, r["size"], BOX_AXES) for r in lengths}
    placed = classes.select("label", F.size("embedding").alias("size"), "embedding", "node", "copies").mapInArrow(_place(bases, epsilon / CELLS), PLACED)
    order = ("label", "size", "cells", "node")
    ordered = placed.repartitionByRange(common.shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    folder = f"{common.shared_dir(spark)}/blocks"
    blocks = common.checkpoint(ordered.mapInArrow(_cut(folder, block_rows, bases), BLOCKS))
    # a row stands for two blocks: the number of tasks is given
    met = near_blocks(blocks, epsilon).repartition(2 * common.shuffle_partitions(spark), "a_block", "b_block")
    found = common.checkpoint(met.mapInArrow(_join_blocks(folder, bases, threshold, epsilon), "node long, links long, other long"))
    with common.temporary_tables():
        joined = graph.components(found.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
        if joined is not None:
            common.keep(joined)
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    state = classes.join(counts, "node", "left")
    if joined is not None:
        state = state.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    else:
        state = state.withColumn("component", F.col("node"))
    state = state.select(F.xxhash64("label", "embedding").alias("key"), F.col("label").alias("l"), F.col("embedding").alias("e"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.col("component").alias("component_id"))
    linked = plain.join(state, (F.xxhash64("label", "embedding") == F.col("key")) & (F.col("label") == F.col("l")) & (F.col("embedding") == F.col("e"))).select("vec_id", "n_links", "component_id")
    alone = vectors.filter(~can_link()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
