"""Annotation tasks: table, selection, completion, sharding, limits, batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewright.functions import exprs
from framewright.functions.ranks import grouped_rank

ORDER = ["subset", "chunk", "input_camera", "episode"]


def task_table(catalog: DataFrame) -> DataFrame:
    """Tasks of a media catalog: output camera, paths, stable key. Rows without an episode number fall out."""
    c = F.col
    out = exprs.output_camera(c("input_camera"))
    return catalog.filter(exprs.episode_number(c("episode")).isNotNull()).select(
        "subset", "chunk", "input_camera", "episode", out.alias("output_camera"), exprs.episode_number(c("episode")).alias("episode_index"),
        exprs.media_path(c("subset"), "videos", c("chunk"), c("input_camera"), c("episode"), ".mp4").alias("input_path"),
        exprs.media_path(c("subset"), "videos", c("chunk"), out, c("episode"), ".mp4").alias("output_path"),
        exprs.media_path(c("subset"), "meta/normals", c("chunk"), out, c("episode"), ".json").alias("metadata_path"),
        exprs.task_key(c("chunk"), c("episode"), c("input_camera"), c("subset")).alias("task_key"),
    )


def select_tasks(tasks: DataFrame, subsets=(), chunks=(), cameras=(), first: int | None = None, last: int | None = None, episodes=()) -> DataFrame:
    """Conjunction of the given selections; an empty one selects everything. Episodes by number or name."""
    if episodes:
        tasks = tasks.filter(F.col("episode").isin(*[exprs.episode_selector(e) for e in episodes]))
    if subsets:
        tasks = tasks.filter(F.col("subset").isin(*subsets) | F.substring_index("subset", "/", -1).isin(*subsets))
    if chunks:
        tasks = tasks.filter(F.col("chunk").isin(*[f"chunk-{n:03d}" for n in chunks]))
    if cameras:
        tasks = tasks.filter(F.arrays_overlap(exprs.camera_names(F.col("input_camera")), F.array(*[F.lit(c) for c in cameras])))
    number = exprs.episode_number(F.col("episode"))
    if first is not None:
        tasks = tasks.filter(number >= first)
    return tasks if last is None else tasks.filter(number <= last)


def resolve_requests(requests: DataFrame, tasks: DataFrame) -> DataFrame:
    """One row per request and task: an equi-join on subset and chunk (on the subset where no chunks are named), the camera as a residual.

    Requests whose chunks are malformed resolve to nothing: `selectors.request_issues` names them.
    """
    named = requests.filter(~exprs.no_chunks(F.col("chunks"))).select("request_id", "subset", F.col("camera").alias("wanted"), F.explode(exprs.chunk_numbers(F.col("chunks"))).alias("n"))
    by_chunk = named.select("request_id", "subset", "wanted", F.format_string("chunk-%03d", "n").alias("chunk")).join(tasks, ["subset", "chunk"])
    whole = requests.filter(exprs.no_chunks(F.col("chunks"))).select("request_id", "subset", F.col("camera").alias("wanted")).join(tasks, "subset")
    found = by_chunk.select("request_id", "wanted", *ORDER).unionByName(whole.select("request_id", "wanted", *ORDER))
    return found.filter(F.array_contains(exprs.camera_names(F.col("input_camera")), F.col("wanted"))).select("request_id", *ORDER)


#: Numbers are read as text, so that a malformed one is a null later on and not an error here.
SIDECAR = (
    "status string, method string, commit string, config_fingerprint string, task struct<input_size_bytes: string>, "
    "output_video struct<width: string, height: string, frames: string, size_bytes: string>, settings map<string, string>"
)


def legacy_match(sidecar: Column, config: dict) -> Column:
    """Whether a sidecar without a fingerprint says the same: method, commit, settings, and the output's size."""
    same = (sidecar["method"] == config["method"]) & (sidecar["commit"] == config["commit"])
    for key, value in config["settings"].items():
        if key.startswith("output_"):
            same = same & (sidecar["output_video"][key.removeprefix("output_")].try_cast("long") == value)
        else:
            same = same & (F.try_element_at(sidecar["settings"], F.lit(key)) == str(value))
    return same


def completion_status(tasks: DataFrame, sidecars: DataFrame, outputs: DataFrame, config: dict) -> DataFrame:
    """Adds complete and quarantined to tasks.

    Complete: the output (doc_id, output_bytes, is_mp4) is there and an MP4, and the sidecar (doc_id, payload as JSON text, quarantined)
    says complete, width, height and frames above 0, the sizes of output and input as they are (where it names them), and this
    configuration: by fingerprint, or by comparison where it has none. A malformed, cut off or missing field means incomplete.
    """
    said = sidecars.select("doc_id", "quarantined", F.from_json("payload", SIDECAR).alias("sidecar"))
    s = F.col("sidecar")
    video = s["output_video"]
    positive = [video[f].try_cast("long") > 0 for f in ("width", "height", "frames")]
    fits = lambda recorded, actual: recorded.isNull() | (recorded.try_cast("long") == F.col(actual))
    fingerprint = s["config_fingerprint"]
    complete = (
        F.col("is_mp4") & (s["status"] == "complete") & positive[0] & positive[1] & positive[2]
        & fits(video["size_bytes"], "output_bytes") & fits(s["task"]["input_size_bytes"], "input_size_bytes")
        & F.when(fingerprint.isNotNull(), fingerprint == exprs.config_fingerprint(config)).otherwise(legacy_match(s, config))
    )
    met = tasks.join(said, "doc_id", "left").join(outputs.select("doc_id", "output_bytes", "is_mp4"), "doc_id", "left")
    return met.select(*tasks.columns, F.coalesce(complete, F.lit(False)).alias("complete"), F.coalesce("quarantined", F.lit(False)).alias("quarantined"))


def pending_tasks(status: DataFrame, overwrite: bool = False) -> DataFrame:
    rows = status if overwrite else status.filter("not complete")
    return rows.filter("not quarantined")


def auto_resolve(status: DataFrame) -> DataFrame:
    """Events for quarantined tasks that are complete by now."""
    return status.filter("quarantined and complete").select("doc_id", F.lit("resolved").alias("event"))


def stable_shards(tasks: DataFrame, shards: int) -> DataFrame:
    """Position in the full order, modulo the number of shards: the same whatever is complete."""
    return grouped_rank(tasks, ORDER[:3], "episode", "position").withColumn("shard", F.col("position") % shards)


def plan_counts(status: DataFrame, shards: int) -> DataFrame:
    """Per shard and in all (shard null): discovered, pending (quarantined still count), quarantined."""
    sharded = stable_shards(status, shards)
    return sharded.rollup("shard").agg(
        F.count("*").alias("discovered"), F.count_if(~F.col("complete")).alias("pending"), F.count_if(F.col("quarantined") & ~F.col("complete")).alias("quarantined"))


def per_shard_limit(status: DataFrame, shards: int, limit: int | None, per_process: int = 0, dry_run: bool = False) -> DataFrame:
    """The first pending tasks of every shard, in order: `limit` of them, of which one process takes `per_process` (0: all), but for a dry run."""
    pending = pending_tasks(stable_shards(status, shards))
    place = F.row_number().over(Window.partitionBy("shard").orderBy("position"))
    most = min([n for n in (limit, per_process if per_process and not dry_run else None) if n is not None], default=None)
    placed = pending.withColumn("place", place)
    return (placed if most is None else placed.filter(F.col("place") <= most)).select("shard", "place", *ORDER)


def pack_batches(tasks: DataFrame, size: int) -> DataFrame:
    """Batches of up to `size` episodes of a subset, chunk and camera, in name order."""
    place = F.row_number().over(Window.partitionBy(*ORDER[:3]).orderBy("episode")) - 1
    return tasks.withColumn("batch", F.floor(place / size))


def shard_summary(batches: DataFrame) -> DataFrame:
    group = [*ORDER[:3], "batch"]
    out = batches.groupBy(*group).agg(F.count("*").alias("episodes"), F.min("episode").alias("first_episode"), F.max("episode").alias("last_episode"), F.sum("input_size_bytes").alias("size_bytes"))
    number = lambda c: F.substring_index(c, "_", -1)
    return out.withColumn("file", F.concat(F.lit("episodes-"), number("first_episode"), F.lit("-"), number("last_episode"), F.lit(".tar")))


def preview(rows: DataFrame, order: list[str], k: int) -> DataFrame:
    """The first k rows of a report, each with the number of the rest."""
    return rows.orderBy(*order).limit(k).join(rows.agg(F.greatest(F.count("*") - k, F.lit(0)).alias("more")))


def orphan_parts(manifest: DataFrame, tasks: DataFrame) -> DataFrame:
    """Partial files (.{episode}.*.part.mp4) per task: number and bytes."""
    part = F.regexp_extract("path", r"/\.(episode_[0-9]+)\..*\.part(?:\.mp4)?$", 1)
    parts = manifest.withColumn("episode", part).filter("episode <> ''").withColumn("camera_dir", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1))
    keyed = tasks.select("subset", "chunk", "episode", exprs.output_camera(F.col("input_camera")).alias("camera_dir"), "doc_id")
    return parts.join(keyed, ["subset", "chunk", "camera_dir", "episode"]).groupBy("doc_id").agg(F.count("*").alias("parts"), F.sum("bytes").alias("part_bytes"))


def run_summary(sharded: DataFrame) -> DataFrame:
    """Per shard: succeeded, skipped, locked and failed tasks of a run, and what is pending after it (quarantined ones count)."""
    o = F.col("outcome")
    done = F.col("complete") | F.coalesce(o.isin("complete", "skipped"), F.lit(False))
    return sharded.groupBy("shard").agg(
        F.count_if(o == "complete").alias("succeeded"), *[F.count_if(o == k).alias(k) for k in ("skipped", "locked", "failed")], F.count_if(~done).alias("still_pending"))
