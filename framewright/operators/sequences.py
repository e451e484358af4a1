"""Frame sequences: stride, batches, windows, blending, media plans."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.functions import exprs
from framewright.sources.scratch import ship


def stride_of(rate: Column, target: float) -> Column:
    """Half-even rounding, 1 at least; a target of -1 keeps every frame."""
    return F.lit(1).cast("long") if target == -1 else F.greatest(F.bround(rate / target), F.lit(1)).cast("long")


def frame_stride_sample(frames: DataFrame, rate: Column, target: float, most: int) -> DataFrame:
    kept = frames.withColumn("stride", stride_of(rate, target)).filter("frame_index % stride = 0").withColumn("sample", F.expr("frame_index DIV stride"))
    return (kept if most < 0 else kept.filter(F.col("sample") < most)).select("episode_index", "frame_index", "stride", "sample")


def bounded_batches(frames: DataFrame, size: int) -> DataFrame:
    return frames.withColumn("batch", F.expr(f"frame_index DIV {size}")).groupBy("episode_index", "batch").agg(F.count("*").alias("frames"), F.min("frame_index").alias("first_frame"), F.max("frame_index").alias("last_frame"))


def window_numbers(i: Column, n: Column, size: int, step: int) -> Column:
    """Windows start at 0, step, ...; the last is clipped. Those that hold frame i of n."""
    count = F.when(n <= size, F.lit(1)).otherwise(F.ceil((n - size) / step) + 1).cast("long")
    low = F.greatest(F.lit(0), F.ceil((i - size + 1) / step)).cast("long")
    return F.sequence(low, F.greatest(low, F.least(F.floor(i / step).cast("long"), count - 1)))


def sliding_windows(frames: DataFrame, size: int, step: int) -> DataFrame:
    """Frames and the windows that hold them: computed, not joined."""
    lengths = frames.groupBy("episode_index").agg(F.count("*").alias("n"))
    return frames.join(lengths, "episode_index").select("episode_index", "frame_index", F.explode(window_numbers(F.col("frame_index"), F.col("n"), size, step)).alias("window"))


def window_frames(frames: DataFrame, feature: str, size: int, step: int) -> DataFrame:
    """(episode_index, window, frame_index, vector): what each window sees of a frame's vector."""
    vector = F.col(feature).cast("array<double>").alias("vector")
    return frames.select("episode_index", "frame_index", vector).join(sliding_windows(frames, size, step), ["episode_index", "frame_index"])


def _blend(size: int, step: int):
    over = size - step

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: tuple | None = None  # (episode, frame, blended so far): its windows may go on in the next batch

        def made(episodes, frames, rows) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(episodes, pa.int64()), pa.array(frames, pa.int64()), pa.array(list(rows), pa.list_(pa.float64()))], ["episode_index", "frame_index", "blended"])

        for batch in batches:
            if not batch.num_rows:
                continue
            episode, frame, window = (np.asarray(batch.column(i)) for i in range(3))
            sizes = np.asarray(batch.column(3).value_lengths())
            if (sizes != sizes[0]).any():
                raise ValueError("lengths of vectors differ")
            x = np.asarray(batch.column(3).flatten(), dtype=np.float64).reshape(len(episode), -1)
            first = np.append(True, (episode[1:] != episode[:-1]) | (frame[1:] != frame[:-1]))
            starts, group = np.flatnonzero(first), np.cumsum(first) - 1
            place = frame - window * step
            weight = np.where(place < over, 1 - (place + 1) / float(over + 1), 0.0)[:, None]
            turn = np.arange(len(episode)) - starts[group]
            blended = x[starts]
            if open_ is not None and open_[:2] == (episode[0], frame[0]):
                blended[0] = open_[2] * weight[0] + x[0] * (1 - weight[0])
            elif open_ is not None:
                yield made([open_[0]], [open_[1]], [open_[2]])
            for k in range(1, int(turn.max()) + 1):  # the k-th windows of all frames at once
                at = np.flatnonzero(turn == k)
                blended[group[at]] = blended[group[at]] * weight[at] + x[at] * (1 - weight[at])
            if len(starts) > 1:
                yield made(episode[starts[:-1]], frame[starts[:-1]], blended[:-1])
            open_ = (episode[-1], frame[-1], blended[-1])
        if open_ is not None:
            yield made([open_[0]], [open_[1]], [open_[2]])

    return run


def overlap_blend(seen: DataFrame, size: int, step: int) -> DataFrame:
    """(episode_index, frame_index, blended): whole vectors, blended through the windows that hold a frame, in window order.

    seen: (episode_index, window, frame_index, vector), a row for each window and frame. In the overlap the earlier result fades out
    linearly. Rows are dealt by frame, so that a long episode isn't one task's, and scanned in order: a task holds one frame's result across batches.
    """
    ship(seen.sparkSession)
    rows = seen.select(F.col("episode_index").cast("long"), F.col("frame_index").cast("long"), F.col("window").cast("long"), "vector")
    ordered = rows.repartition("episode_index", "frame_index").sortWithinPartitions("episode_index", "frame_index", "window")
    return ordered.mapInArrow(_blend(size, step), "episode_index long, frame_index long, blended array<double>")


def media_plan(media: DataFrame, longest: int, target: float, size: int = 14, step: int = 10, batch: int = 16, seconds: int = 20) -> DataFrame:
    """Per medium: scaled size, padding to multiples of 64 and its offset, stride, kept frames, batches and windows (and its subset, where there is one)."""
    side = F.greatest("width", "height")
    scale = F.when(side > longest, longest / side).otherwise(1.0)
    plan = media.select("media_id", *[c for c in media.columns if c == "subset"], F.bround(F.col("width") * scale).cast("long").alias("out_width"), F.bround(F.col("height") * scale).cast("long").alias("out_height"), exprs.rate(F.col("avg_frame_rate")).alias("rate"))
    up = lambda c: (F.ceil(F.col(c) / 64) * 64).cast("long")
    plan = plan.withColumn("pad_x", F.floor((up("out_width") - F.col("out_width")) / 2)).withColumn("pad_y", F.floor((up("out_height") - F.col("out_height")) / 2))
    plan = plan.withColumn("stride", stride_of(F.col("rate"), target)).withColumn("kept_frames", F.ceil(F.col("rate") * seconds / F.col("stride")).cast("long"))
    windows = F.when(F.col("kept_frames") <= size, F.lit(1)).otherwise(F.ceil((F.col("kept_frames") - size) / step) + 1).cast("long")
    return plan.withColumn("batches", F.ceil(F.col("kept_frames") / batch).cast("long")).withColumn("windows", windows).drop("rate")


def media_totals(plan: DataFrame, group: str) -> DataFrame:
    """Sums of a media plan over each `group` and over all media (group null)."""
    sums = ("kept_frames", "batches", "windows")
    return plan.rollup(group).agg(F.count("*").alias("media"), *[F.sum(c).alias(c) for c in sums])
