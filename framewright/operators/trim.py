"""Trimming padded tails: specs, audits, trim, renumbering, report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewright.functions.ranks import exclusive_sums

#: Episodes of a chunk directory; also the width of a prefix-sum block.
CHUNK = 1000


def trim_specs(padding: DataFrame) -> DataFrame:
    """Per episode with missing frames: the largest number missing, the cameras, and whether their frame counts conflict."""
    return (
        padding.filter("tail_missing_count > 0").groupBy("episode_index")
        .agg(
            F.max("tail_missing_count").alias("trim_count"), F.min("frame_count").alias("original_length"),
            F.array_join(F.sort_array(F.collect_set("camera")), ",").alias("padded_cameras"),
            (F.min("frame_count") != F.max("frame_count")).alias("conflict"),
        )
    )


def trim_spec_issues(padding: DataFrame) -> DataFrame:
    """(episode_index, issue): episodes whose cameras disagree on the number of frames; and where no episode has missing frames at all, one row for that."""
    specs = trim_specs(padding)
    conflicts = specs.filter("conflict").select("episode_index", F.lit("frame counts differ").alias("issue"))
    none = specs.agg(F.count("*").alias("n")).filter("n = 0").select(F.lit(None).cast("long").alias("episode_index"), F.lit("no specs").alias("issue"))
    return conflicts.unionByName(none)


def checked_specs(padding: DataFrame) -> DataFrame:
    """`trim_specs`; an error where `trim_spec_issues` has a row."""
    issue = trim_spec_issues(padding).orderBy("episode_index").limit(1).first()
    if issue is not None:
        raise ValueError(issue["issue"] if issue["episode_index"] is None else f"{issue['issue']} in episode {issue['episode_index']}")
    return trim_specs(padding)


def missing_episodes(specs: DataFrame, episodes: DataFrame) -> DataFrame:
    return specs.join(episodes, "episode_index", "left_anti").select("episode_index", "trim_count", "original_length")


def length_audit(specs: DataFrame, episodes: DataFrame, frames: DataFrame, media: DataFrame) -> DataFrame:
    """One row per spec and measured length (metadata, table, each medium): to trim, trimmed, or an error."""
    rows = frames.groupBy("episode_index").agg(F.count("*").alias("found"))
    measured = (
        episodes.select("episode_index", F.lit("metadata").alias("what"), F.col("length").alias("found"))
        .unionByName(rows.select("episode_index", F.lit("table").alias("what"), "found"))
        .unionByName(media.select("episode_index", F.col("media_key").alias("what"), F.col("frames").alias("found")))
    )
    final = F.col("original_length") - F.col("trim_count")
    state = F.when(F.col("found").isNull(), "absent").when(F.col("found") == F.col("original_length"), "to_trim").when(F.col("found") == final, "trimmed").otherwise("error")
    return specs.join(measured, "episode_index", "left").select("episode_index", "what", "found", "original_length", final.alias("final_length"), state.alias("state"))


def padded_camera_coverage(padding: DataFrame, media: DataFrame) -> DataFrame:
    """Padded cameras without a medium of that camera."""
    have = media.select("episode_index", F.col("media_key").alias("camera"))
    return padding.filter("tail_missing_count > 0").select("episode_index", "camera").join(have, ["episode_index", "camera"], "left_anti")


def _final_lengths(frames: DataFrame, specs: DataFrame) -> DataFrame:
    """(episode_index, final_length): an episode of neither its original nor its final length is an error."""
    lengths = frames.groupBy("episode_index").agg(F.count("*").alias("rows_found"))
    small = specs.select("episode_index", "trim_count", "original_length")
    final = F.col("original_length") - F.col("trim_count")
    fits = F.col("trim_count").isNull() | F.col("rows_found").isin(F.col("original_length"), final)
    error = F.raise_error(F.concat(F.lit("unexpected length of episode "), F.col("episode_index").cast("string"))).cast("long")
    return lengths.join(small, "episode_index", "left").select("episode_index", F.when(fits, F.coalesce(final, F.col("rows_found"))).otherwise(error).alias("final_length"))


def tail_trim(frames: DataFrame, specs: DataFrame, dropped: bool = False) -> DataFrame:
    """Frames before the final length (or, with `dropped`, those after). Trimmed episodes pass unchanged; an episode of
    another length than expected raises."""
    keep = F.col("frame_index") < F.col("final_length")
    return frames.join(_final_lengths(frames, specs), "episode_index").filter(~keep if dropped else keep).select(*frames.columns)


def trim_and_reindex(frames: DataFrame, specs: DataFrame) -> DataFrame:
    """(episode_index, frame_index, index) of the frames that are left: final lengths and starts are known before the frames are read."""
    final = _final_lengths(frames, specs)
    starts = exclusive_sums(final, "episode_index", "final_length", "start", CHUNK).select("episode_index", "final_length", "start")
    left = frames.select("episode_index", "frame_index").join(starts, "episode_index").filter("frame_index < final_length")
    return left.select("episode_index", "frame_index", (F.col("start") + F.col("frame_index")).alias("index"))


def global_reindex(frames: DataFrame) -> DataFrame:
    """(episode_index, frame_index, index): frames numbered through all episodes in order."""
    lengths = frames.groupBy("episode_index").agg(F.count("*").alias("length"))
    starts = exclusive_sums(lengths, "episode_index", "length", "start", CHUNK).select("episode_index", "start")
    return frames.join(starts, "episode_index").select("episode_index", "frame_index", (F.col("start") + F.col("frame_index")).alias("index"))


def frame_index_audit(frames: DataFrame) -> DataFrame:
    """Per episode: frames, and those whose index isn't their place."""
    place = F.row_number().over(Window.partitionBy("episode_index").orderBy("frame_index")) - 1
    return frames.withColumn("place", place).groupBy("episode_index").agg(F.count("*").alias("frames"), F.count_if(F.col("frame_index") != F.col("place")).alias("misplaced"))


def pure_tail_audit(padding: DataFrame) -> DataFrame:
    """Whether the missing indices are exactly the last frames, in order."""
    n, m = F.col("frame_count"), F.col("tail_missing_count")
    expected = F.when(m > 0, F.sequence(n - m, n - 1)).otherwise(F.array().cast("array<long>"))
    return padding.select("episode_index", "camera", F.coalesce(F.col("missing_frame_indices") == expected, F.lit(False)).alias("pure_tail"))


def trim_report(frames: DataFrame, specs: DataFrame, media: DataFrame) -> DataFrame:
    """One row: affected episodes, trimmed ones, media to trim, frames to delete, episode files to rewrite."""
    rows = frames.groupBy("episode_index").agg(F.count("*").alias("found"))
    e = specs.join(rows, "episode_index", "left").withColumn("final", F.col("original_length") - F.col("trim_count"))
    per_episode = e.agg(
        F.count("*").alias("affected_episodes"), F.count_if(F.col("found") == F.col("final")).alias("already_trimmed"),
        F.sum(F.greatest(F.col("found") - F.col("final"), F.lit(0))).alias("frames_to_delete"), F.count_if(F.col("found") > F.col("final")).alias("rewritten_files"))
    videos = specs.join(media, "episode_index").agg(F.count_if(F.col("frames") == F.col("original_length")).alias("media_to_trim"))
    return per_episode.join(videos)


def media_frame_counts(frames: DataFrame, group: list[str]) -> DataFrame:
    """Frames per medium, and whether they are numbered without a gap from 0."""
    n = F.count("*")
    return frames.groupBy(*group).agg(
        n.alias("frames"), F.min("frame_index").alias("first_frame"), F.max("frame_index").alias("last_frame"),
        ((F.min("frame_index") == 0) & (F.max("frame_index") == n - 1) & (F.countDistinct("frame_index") == n)).alias("contiguous"))
