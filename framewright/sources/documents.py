"""JSON documents whose keys aren't all known: episode rows and dataset descriptors.

Rows are VARIANT columns: keys that nobody asks for, nested values and nulls are carried through a rewrite. Within a
nested object keys come out in alphabetical order, and numbers in their shortest form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.sources.media import scan_headers

VERSION = "v2.1"
#: What is read of a descriptor; its other keys stay in the document.
INFO = "codebase_version string, chunks_size long, data_path string, video_path string, features map<string, struct<dtype: string>>, total_frames long, total_images long"


def scan_json_rows(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines as one VARIANT column `row`; blank lines are skipped, a malformed line is an error."""
    return spark.read.option("singleVariantColumn", "row").option("mode", "FAILFAST").json(path)


def with_keys(row: Column, **values: Column) -> Column:
    """An object (VARIANT, or a map of VARIANTs) as a map of VARIANTs with other values for some keys; keys that it has stay in their places."""
    names = F.array(*map(F.lit, values))
    new = F.map_from_arrays(names, F.array(*[v.cast("variant") for v in values.values()]))
    rows = row.cast("map<string,variant>")
    return F.map_concat(F.transform_values(rows, lambda k, v: F.when(k.isin(*values), F.try_element_at(new, k)).otherwise(v)), F.map_filter(new, lambda k, _: ~F.map_contains_key(rows, k)))


def write_json_rows(rows: DataFrame, column: str, path: str) -> None:
    """One JSON line for each object of a column (VARIANT, or a map of VARIANTs); null values of its keys are kept."""
    rows.select(F.to_json(column).alias("value")).write.text(path)


def scan_descriptors(spark: SparkSession, root: str) -> DataFrame:
    """(subset, document, info) of each `{subset}/meta/info.json` below `root`; info is null where the document is no JSON object."""
    found = scan_headers(spark, root, "/meta/info.json", header=-1)
    text = F.col("header").cast("string")
    return found.select(F.regexp_extract("path", r"^(.*)/meta/info\.json$", 1).alias("subset"), text.alias("document"), _info(text).alias("info"))


def _info(document: Column) -> Column:
    return F.when(F.try_parse_json(document).isNotNull(), F.from_json(document, INFO))


def descriptor_files(descriptors: DataFrame) -> DataFrame:
    """(path, content) of the descriptors (subset, document), for `write_media`."""
    return descriptors.select(F.concat("subset", F.lit("/meta/info.json")).alias("path"), F.encode("document", "UTF-8").alias("content"))


def descriptor_issues(descriptors: DataFrame, version: str = VERSION) -> DataFrame:
    """(subset, issue) of the descriptors that can't be used; the first of their faults."""
    i = F.col("info")
    issue = (
        F.when(i.isNull(), "no JSON object").when(i["codebase_version"].isNull() | (i["codebase_version"] != version), F.concat(F.lit("version "), F.coalesce(i["codebase_version"], F.lit("absent"))))
        .when(i["features"].isNull(), "no features").when(i["chunks_size"].isNull() | (i["chunks_size"] < 1), "no chunk size").when(i["data_path"].isNull(), "no data path")
    )
    return descriptors.select("subset", issue.alias("issue")).filter("issue is not null")


def usable_descriptors(descriptors: DataFrame) -> DataFrame:
    return descriptors.join(descriptor_issues(descriptors), "subset", "left_anti")


def feature_table(descriptors: DataFrame) -> DataFrame:
    """(subset, feature, dtype) of every feature that a descriptor names."""
    return descriptors.select("subset", F.explode("info.features").alias("feature", "value")).select("subset", "feature", F.col("value.dtype").alias("dtype"))


def dataset_totals(episodes: DataFrame, descriptors: DataFrame) -> DataFrame:
    """Per described subset: episodes, frames, and images (frames times features of images), from episodes (subset, length)."""
    counts = episodes.groupBy("subset").agg(F.count("*").alias("episodes"), F.sum("length").alias("frames"))
    images = feature_table(descriptors).groupBy("subset").agg(F.count_if(F.col("dtype") == "image").alias("images"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return descriptors.select("subset").join(counts, "subset", "left").join(images, "subset", "left").select(
        "subset", zero("episodes").alias("total_episodes"), zero("frames").alias("total_frames"), (zero("frames") * zero("images")).alias("total_images"))


def with_totals(descriptors: DataFrame, totals: DataFrame) -> DataFrame:
    """Descriptors with their totals in the document; other keys stay, those at the top in their order."""
    names = ("total_frames", "total_images")
    met = descriptors.select("subset", "document").join(totals.select("subset", *names), "subset", "left")
    merged = F.to_json(with_keys(F.from_json("document", "map<string,variant>"), **{n: F.col(n) for n in names}))
    document = F.when(F.col("total_frames").isNull(), F.col("document")).otherwise(merged)
    return met.select("subset", document.alias("document")).withColumn("info", _info(F.col("document")))


def template_path(template: Column, values: dict[str, Column]) -> Column:
    """A path template with the numbers put in: `{name}` and `{name:03d}`, for each name of `values`."""
    out = template
    for name, value in values.items():
        out = F.replace(out, F.lit(f"{{{name}}}"), value.cast("string"))
        width = F.regexp_extract(template, rf"\{{{name}:0([0-9]+)d\}}", 1)
        padded = F.format_string("%s%s", F.repeat(F.lit("0"), F.coalesce(width.try_cast("int"), F.lit(0)) - F.length(value.cast("string"))), value.cast("string"))
        out = F.replace(out, F.concat(F.lit(f"{{{name}:0"), width, F.lit("d}")), padded)
    return out


def episode_files(episodes: DataFrame, descriptors: DataFrame) -> DataFrame:
    """(subset, episode_index, episode_chunk, path) of the frame files of episodes (subset, episode_index), by their subset's descriptor."""
    chunk = F.expr("episode_index DIV info.chunks_size")
    met = episodes.join(usable_descriptors(descriptors).select("subset", "info"), "subset").withColumn("episode_chunk", chunk)
    path = template_path(F.col("info.data_path"), {"episode_chunk": F.col("episode_chunk"), "episode_index": F.col("episode_index")})
    return met.select("subset", "episode_index", "episode_chunk", F.concat_ws("/", "subset", path).alias("path"))
