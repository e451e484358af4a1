"""Recorded-episode tables derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.functions import exprs

CAMERAS = (("observation.images.depth_01", 3), ("observation.images.depth_02", 2))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("episode_index"), F.col("turn").alias("frame_index"), "role", "text")


def episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames(spark, sf_dir).groupBy("episode_index").agg(F.count("*").alias("length"))


def episode_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value): episode rows as JSON texts, with keys and nested values that nobody asks for."""
    e = F.col("episode_index").cast("string")
    note = F.when(F.col("episode_index") % 3 == 0, "null").otherwise(F.concat(F.lit('"ça '), e, F.lit('"')))
    extra = F.concat(F.lit('{"gains":[0.5,null,{"k":'), e, F.lit("}],\"note\":"), note, F.lit("}"))
    return episodes(spark, sf_dir).select(F.concat(F.lit('{"episode_index":'), e, F.lit(',"extra":'), extra, F.lit(',"length":'), F.col("length").cast("string"), F.lit(',"tasks":["pick","place"]}')).alias("value"))


def subset_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(subset, episode_index, length): episodes dealt over the subsets."""
    return episodes(spark, sf_dir).select(F.concat(F.lit("src"), (F.col("episode_index") % 20).cast("string")).alias("subset"), "episode_index", "length")


def descriptors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(subset, document): a descriptor for each source of documents; some are of another version, incomplete or cut off."""
    n = F.substring_index("source", "src", -1).cast("int")
    image = lambda k: F.when(n % k == 0, F.lit(f'"observation.images.depth_0{k}":{{"dtype":"image","shape":[36,64]}},')).otherwise("")
    features = F.concat(F.lit('{'), image(2), image(3), F.lit('"observation.images.rgb_01":{"dtype":"video"},"observation.state":{"dtype":"float32"}}'))
    version = F.when(n % 9 == 5, "v2.0").otherwise("v2.1")
    document = F.concat(
        F.lit('{"codebase_version":"'), version, F.lit('","robot":{"joints":[1,2,null],"name":"'), F.col("source"), F.lit('"},"note":null,"total_frames":0,"chunks_size":'), F.when(n % 11 == 8, 0).otherwise(n + 10).cast("string"),
        F.lit(',"data_path":"data/chunk-{episode_chunk:03d}/episode_{episode_index:06d}.parquet","features":'), F.when(n % 7 == 6, "null").otherwise(features), F.lit(',"fps":15}'))
    sources = _table(spark, sf_dir, "documents").filter("source is not null").select("source").distinct()
    return sources.select(F.col("source").alias("subset"), F.when(n % 13 == 1, F.substring(document, 1, 40)).otherwise(document).alias("document"))


def statframes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`vecframes` with scalars, a constant and nested values."""
    i = F.col("frame_index")
    v = F.col("observation_state")
    return vecframes(spark, sf_dir).select(
        "episode_index", "frame_index", "observation_state", (i / 10.0).alias("timestamp"), (i % 7 == 6).alias("next.done"), F.array(F.lit(0.1), F.lit(64.1)).alias("constant"),
        F.array(F.array(v[0], v[1]), F.array(v[2], v[3])).alias("nested"), F.lit("x").alias("note"))


def stats_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value): statistics of an earlier run as JSON texts; the first episode's row names the features."""
    e = F.col("episode_index")
    named = '{"constant":{},"nested":{},"next.done":{},"observation_state":{},"timestamp":{}}'
    first = _table(spark, sf_dir, "embeddings").filter("label is not null").select(F.col("label").alias("episode_index")).distinct()
    return first.select(F.concat(F.lit('{"episode_index":'), e.cast("string"), F.lit(',"stats":'), F.when(e == 0, named).otherwise('{"frame_index":{}}'), F.lit("}")).alias("value"))


def padding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per episode and depth camera, with the indices of the frames missing at the tail."""
    cameras = F.explode(F.array(*[F.struct(F.lit(c).alias("camera"), F.lit(m).alias("m")) for c, m in CAMERAS])).alias("c")
    rows = episodes(spark, sf_dir).select("episode_index", "length", cameras)
    missing = F.least(F.col("episode_index") % F.col("c.m"), F.col("length") - 1)
    rows = rows.select("episode_index", F.col("c.camera").alias("camera"), F.col("length").alias("frame_count"), missing.alias("tail_missing_count"))
    tail = F.sequence(F.col("frame_count") - F.col("tail_missing_count"), F.col("frame_count") - 1)
    return rows.withColumn("missing_frame_indices", F.when(F.col("tail_missing_count") > 0, tail).otherwise(F.array().cast("array<long>")))


def media_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = padding(spark, sf_dir)
    trims = p.groupBy("episode_index").agg(F.max("tail_missing_count").alias("trim_count"))
    e = F.col("episode_index")
    count = F.when(e % 5 == 0, F.col("frame_count") - F.col("trim_count")).when(e % 11 == 0, F.col("frame_count") + 1).otherwise(F.col("frame_count"))
    return p.join(trims, "episode_index").filter(~((e % 17 == 0) & (F.col("camera") == CAMERAS[1][0]))).select("episode_index", F.col("camera").alias("media_key"), count.alias("frames"))


def vecframes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as an episode per label; frames in vec_id order."""
    from framewright.functions.ranks import ranked

    v = _table(spark, sf_dir, "embeddings").select(F.col("label").alias("episode_index"), "vec_id", F.col("embedding").alias("observation_state"))
    return ranked(v, ["episode_index"], "vec_id", "frame_index").select("episode_index", "frame_index", "observation_state")


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    camera = F.when(F.col("lang") == "en", "01").when(F.col("lang") == "fr", "02").when(F.col("lang") == "de", "03").otherwise("04")
    return _table(spark, sf_dir, "documents").select(
        "doc_id", F.col("source").alias("subset"), F.format_string("chunk-%03d", F.expr("doc_id DIV 100")).alias("chunk"),
        F.concat(F.lit("observation.images.rgb_"), camera).alias("input_camera"), F.format_string("episode_%06d", "doc_id").alias("episode"),
        F.col("n_chars").alias("input_size_bytes"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Selection requests; some name chunks that descend, some none."""
    k = F.col("s_suppkey")
    low = (k % 6).cast("string")
    chunks = F.concat((k % 4).cast("string"), F.lit(","), low, F.lit("-"), (k % 6 + 2).cast("string"))
    return _table(spark, sf_dir, "supplier").select(
        k.alias("request_id"), F.concat(F.lit("src"), (k % 25).cast("string")).alias("subset"),
        F.when(k % 17 == 3, "7-5").when(k % 19 == 4, "").otherwise(chunks).alias("chunks"),
        F.when(k % 3 == 0, "01").when(k % 3 == 1, "rgb_02").otherwise("observation.images.rgb_03").alias("camera"),
    )


def _grouped(subset: Column) -> Column:
    """Every other subset lies in a directory of its own."""
    return F.when(F.substring_index(subset, "src", -1).cast("int") % 2 == 1, F.concat(F.lit("group/"), subset)).otherwise(subset)


def plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Download requests: a subset, and lists of modalities and chunks, where given; some are invalid."""
    k = F.col("s_suppkey")
    low = (k % 6).cast("string")
    modalities = (
        F.when(k % 11 == 7, "a b").when(k % 7 == 1, "metadata,parquet").when(k % 7 == 2, "rgb_01, metadata,rgb_01").when(k % 7 == 3, "images/observation.images.depth_01")
        .when(k % 7 == 4, "all").when(k % 7 == 5, "videos").when(k % 7 == 6, "all,data")
    )
    chunks = F.concat((k % 4).cast("string"), F.lit(","), low, F.lit("-"), (k % 6 + 2).cast("string"))
    return _table(spark, sf_dir, "supplier").select(
        k.alias("request_id"), _grouped(F.concat(F.lit("src"), (k % 25).cast("string"))).alias("subset"), modalities.alias("modalities"),
        F.when(k % 13 == 5, "9-2").when(k % 3 != 0, chunks).alias("chunks"))


def tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, subset, path, bytes): the files of a collection, with videos everywhere and depth images, tables and metadata here and there."""
    d = F.col("doc_id")
    paths = F.array(
        F.concat_ws("/", "subset", F.lit("videos"), "chunk", "input_camera", F.concat("episode", F.lit(".mp4"))),
        F.when(d % 3 == 0, F.concat_ws("/", "subset", F.lit("images"), "chunk", F.lit("observation.images.depth_01"), "episode", F.lit("frame_000000.png"))),
        F.when(d % 2 == 0, F.concat_ws("/", "subset", F.lit("data"), "chunk", F.concat("episode", F.lit(".parquet")))),
        F.when(d % 4 == 1, F.concat_ws("/", "subset", F.lit("meta"), F.lit("stats"), F.concat("episode", F.lit(".json")))),
    )
    rows = tasks(spark, sf_dir).withColumn("subset", _grouped(F.col("subset")))
    return rows.select("doc_id", "subset", F.explode(paths).alias("path"), F.col("input_size_bytes").alias("bytes")).filter("path is not null")


#: What a complete sidecar must say.
CONFIG = {
    "method": "normals", "commit": "c0ffee",
    "settings": {
        "target_fps": 12, "process_length": -1, "max_res": 1024, "window_size": 14, "time_step_size": 10, "decode_chunk_size": 7, "seed": 42, "cpu_offload": "none", "crf": 18,
        "pixel_format": "yuv420p", "output_width": 64, "output_height": 36,
    },
}


def sidecars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, payload, quarantined): completion sidecars as JSON text; some are absent, failed, stale, legacy, malformed or cut off."""
    labels, docs = _table(spark, sf_dir, "labels"), _table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    d, n = F.col("doc_id"), F.col("n_chars")
    settings = {k: F.when(d % 36 == 18, 15).otherwise(v) if k == "window_size" else F.lit(v) for k, v in CONFIG["settings"].items() if not k.startswith("output_")}
    width = F.when(d % 28 == 13, "abc").when(d % 16 == 9, "0").when(d % 24 == 6, "128").otherwise("64")
    payload = F.to_json(F.struct(
        F.when(F.col("quality") == 1, "complete").otherwise("failed").alias("status"),
        F.when(d % 18 == 12, "other").otherwise(CONFIG["method"]).alias("method"), F.when(d % 30 == 24, "old").otherwise(CONFIG["commit"]).alias("commit"),
        F.when(d % 3 == 1, exprs.config_fingerprint(CONFIG)).when(d % 3 == 2, "stale").alias("config_fingerprint"),
        F.struct(F.when(d % 14 != 7, n + F.when(d % 10 == 0, 1).otherwise(0)).alias("input_size_bytes")).alias("task"),
        F.struct(width.alias("width"), F.lit(36).alias("height"), F.when(d % 22 == 1, 0).otherwise(10).alias("frames"), F.when(d % 12 != 0, 2 * n + F.when(d % 26 == 1, 1).otherwise(0)).alias("size_bytes")).alias("output_video"),
        F.struct(*[c.alias(k) for k, c in settings.items()]).alias("settings"),
    ))
    cut = F.when(d % 46 == 31, F.substring(payload, 1, 60)).otherwise(payload)
    return labels.join(docs, "doc_id").select("doc_id", cut.alias("payload"), (F.col("toxic") == 1).alias("quarantined"))


def outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, output_bytes, is_mp4): the output files that are there."""
    d = F.col("doc_id")
    return _table(spark, sf_dir, "documents").filter(d % 20 != 19).select("doc_id", (2 * F.col("n_chars")).alias("output_bytes"), (d % 34 != 1).alias("is_mp4"))


def outcomes(status: DataFrame) -> DataFrame:
    """`status` with the outcome of a run over the tasks that were pending."""
    d = F.col("doc_id")
    outcome = F.when(d % 11 == 5, "locked").when(d % 7 == 2, "failed").when(d % 13 == 4, "skipped").otherwise("complete")
    return status.withColumn("outcome", F.when(~F.col("complete") & ~F.col("quarantined"), outcome))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.when(F.col("event_type") == "error", "process_crash").when(F.col("event_type") == "signup", "python_failure").otherwise("resolved")
    return _table(spark, sf_dir, "events").filter(F.col("event_type").isin("error", "signup", "purchase")).select("event_id", "ts", F.col("user_id").alias("task"), event.alias("event"))


def heartbeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select(F.col("user_id").alias("task"), "ts", F.col("event_id").alias("beat_id"))


def media(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    return _table(spark, sf_dir, "part").select(
        k.alias("media_id"), F.col("p_brand").alias("subset"), (F.col("p_size") * 64).alias("width"), (F.col("p_size") * 36).alias("height"), frame_rate(k).alias("avg_frame_rate"))


def frame_rate(k) -> "F.Column":
    return F.when(k % 4 == 0, "10/1").when(k % 4 == 1, "15/1").when(k % 4 == 2, "30/1").otherwise("60/1")
