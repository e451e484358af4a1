"""Feature statistics per episode and over the dataset.

A partial row has the accumulators of all dimensions of a feature: count, a pivot (the first value), sums of the distances from it and
of their squares, least and largest values. Partials of one key merge in any order, in tasks before a shuffle and after it;
no row stands for a dimension. A column that is constant has a deviation of exactly 0, whatever its value.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.sources.scratch import ship

ARRAYS = ("pivot", "sum", "sum_sq", "min", "max")
PARTIAL = "episode_index long, feature string, count long, " + ", ".join(f"{a} array<double>" for a in ARRAYS)
HELD = 4096  # accumulators that a task holds before it sends them on
Accumulator = tuple  # (count, *ARRAYS)


def stats_features(stats_rows: DataFrame) -> list[str]:
    """The features that the first row (by episode) of statistics names, of rows (row: VARIANT with episode_index and stats)."""
    first = stats_rows.select(F.variant_get("row", "$.episode_index", "long").alias("episode"), F.map_keys(F.variant_get("row", "$.stats", "map<string,variant>")).alias("names"))
    found = first.orderBy("episode").limit(1).first()
    return sorted(found["names"]) if found else []


def _values(column: pa.Array, name: str) -> np.ndarray:
    """A row for each frame: scalars have one dimension, nested lists of one shape are laid out in their order."""
    n = len(column)
    while pa.types.is_list(column.type) or pa.types.is_large_list(column.type) or pa.types.is_fixed_size_list(column.type):
        if column.null_count:
            raise ValueError(f"null in {name}")
        sizes = np.asarray(column.value_lengths())
        if len(sizes) and (sizes != sizes[0]).any():
            raise ValueError(f"lengths differ in {name}")
        column = column.flatten()
    if column.null_count:
        raise ValueError(f"null in {name}")
    return np.asarray(column.to_numpy(zero_copy_only=False), dtype=np.float64).reshape(n, -1)


def merge(a: Accumulator, b: Accumulator) -> Accumulator:
    (n, p, s, q, low, high), (m, p_b, s_b, q_b, low_b, high_b) = a, b
    if len(p) != len(p_b):
        raise ValueError("lengths differ between frames of one feature")
    d = p_b - p
    return n + m, p, s + s_b + m * d, q + q_b + 2 * d * s_b + m * d * d, np.minimum(low, low_b), np.maximum(high, high_b)


def _sent(held: dict[tuple, Accumulator]) -> pa.RecordBatch:
    keys, rows = list(held), list(held.values())
    columns = [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.string()), pa.array([r[0] for r in rows], pa.int64())]
    columns += [pa.array([r[i].tolist() for r in rows], pa.list_(pa.float64())) for i in range(1, 1 + len(ARRAYS))]
    held.clear()
    return pa.RecordBatch.from_arrays(columns, ["episode_index", "feature", "count", *ARRAYS])


def _accumulate(features: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Accumulator] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            episodes = np.asarray(batch.column(0))
            order = np.argsort(episodes, kind="stable")
            episodes = episodes[order]
            starts = np.flatnonzero(np.diff(episodes, prepend=episodes[0] - 1))
            counts = np.diff(starts, append=len(episodes))
            for i, feature in enumerate(features, 1):
                x = _values(batch.column(i), feature)[order]
                pivot = x[starts]
                away = x - np.repeat(pivot, counts, axis=0)
                parts = [np.add.reduceat(away, starts), np.add.reduceat(away * away, starts), np.minimum.reduceat(x, starts), np.maximum.reduceat(x, starts)]
                for k, (episode, n) in enumerate(zip(episodes[starts].tolist(), counts.tolist())):
                    own = (n, pivot[k], *(p[k] for p in parts))
                    held[episode, feature] = merge(held[episode, feature], own) if (episode, feature) in held else own
            if len(held) >= HELD:
                yield _sent(held)
        if held:
            yield _sent(held)

    return run


def _fold(by_episode: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Accumulator] = {}
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(3)] + [[np.array(x, dtype=np.float64) for x in batch.column(i).to_pylist()] for i in range(3, 3 + len(ARRAYS))]
            for episode, feature, *own in zip(*columns):
                key = (episode if by_episode else None, feature)
                held[key] = merge(held[key], tuple(own)) if key in held else tuple(own)
            if len(held) > HELD:
                last = list(held)[-1]  # rows come in order: only the last key goes on
                rest = held.pop(last)
                yield _sent(held)
                held[last] = rest
        if held:
            yield _sent(held)

    return run


def accumulators(frames: DataFrame, features: list[str]) -> DataFrame:
    """`PARTIAL`, one row per episode and feature; nulls, and vectors of different lengths, are errors."""
    ship(frames.sparkSession)
    partial = frames.select(F.col("episode_index").cast("long"), *[F.col(f"`{f}`").alias(f"f{i}") for i, f in enumerate(features)]).mapInArrow(_accumulate(features), PARTIAL)
    dealt = partial.repartition("episode_index", "feature").sortWithinPartitions("episode_index", "feature")
    return dealt.mapInArrow(_fold(True), PARTIAL)


def _over(f, *arrays: str) -> Column:
    """A function of the elements of arrays at one place."""
    return F.transform(F.arrays_zip(*arrays), lambda x: f(*[x[a] for a in arrays]))


def finished(partials: DataFrame) -> DataFrame:
    """min, max, mean and (population) std of each dimension, as arrays."""
    n = F.col("count")
    mean = _over(lambda p, s: p + s / n, "pivot", "sum")
    std = _over(lambda s, q: F.sqrt(F.greatest(q / n - (s / n) * (s / n), F.lit(0.0))), "sum", "sum_sq")
    return partials.select("episode_index", "feature", "count", "min", "max", mean.alias("mean"), std.alias("std"))


def episode_stats(frames: DataFrame, features: list[str]) -> DataFrame:
    """(episode_index, feature, count, min, max, mean, std) of every episode."""
    return finished(accumulators(frames, features))


def global_stats(partials: DataFrame) -> DataFrame:
    """(feature, count, min, max, mean, std) over all episodes of `accumulators`: folded in tasks, then by feature."""
    within = partials.mapInArrow(_fold(False), PARTIAL)
    return finished(within.repartition("feature").sortWithinPartitions("feature").mapInArrow(_fold(False), PARTIAL)).drop("episode_index")


def stats_rows(stats: DataFrame) -> DataFrame:
    """(episode_index, stats): one map of features for each episode, as the statistics files hold them."""
    one = F.struct("min", "max", "mean", "std", F.array("count").alias("count"))
    return stats.groupBy("episode_index").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("feature", one.alias("value"))))).alias("stats"))


def quantized_normals(frames: DataFrame, feature: str, epsilon: float = 1e-6) -> "F.Column":
    """Unit vector, [-1, 1] mapped to 0..255, truncated."""
    norm = F.greatest(F.sqrt(F.aggregate(F.transform(feature, lambda x: x.cast("double")), F.lit(0.0), lambda s, x: s + x * x)), F.lit(epsilon))
    return F.transform(feature, lambda x: F.least(F.greatest((x.cast("double") / norm * 0.5 + 0.5) * 255, F.lit(0.0)), F.lit(255.0)).cast("int"))
