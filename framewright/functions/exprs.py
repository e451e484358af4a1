"""Column expressions: names, paths, keys, selectors."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F


def episode_number(name: Column) -> Column:
    """Number behind episode_; null where there is none."""
    return F.when(name.rlike("^episode_[0-9]+$"), F.regexp_extract(name, "([0-9]+)$", 1).try_cast("long"))


def output_camera(camera: Column) -> Column:
    return F.regexp_replace(camera, r"^(.*?)rgb_", "$1normal_")


def media_path(subset: Column, kind: str, chunk: Column, camera: Column, episode: Column, ending: str) -> Column:
    return F.concat_ws("/", subset, F.lit(kind), chunk, camera, F.concat(episode, F.lit(ending)))


def task_key(chunk: Column, episode: Column, camera: Column, subset: Column) -> Column:
    """sha256 of the canonical JSON of a task (fields in alphabetical order)."""
    return F.sha2(F.to_json(F.struct(chunk.alias("chunk"), episode.alias("episode"), camera.alias("input_camera"), subset.alias("subset"))), 256)


def config_fingerprint(config: dict) -> str:
    """sha256 of the canonical JSON of a configuration (keys in order, no spaces)."""
    return hashlib.sha256(json.dumps(config, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def chunk_numbers(text: Column) -> Column:
    """0,2,5-7,chunk-009 -> [0, 2, 5, 6, 7, 9]; null if an item is malformed or descends."""
    items = F.filter(F.transform(F.split(text, ","), lambda x: F.regexp_replace(F.trim(x), "^chunk-", "")), lambda x: x != "")
    good = F.forall(items, lambda x: x.rlike("^[0-9]+(-[0-9]+)?$") & (F.substring_index(x, "-", 1).try_cast("int") <= F.substring_index(x, "-", -1).try_cast("int")))
    spread = F.transform(items, lambda x: F.sequence(F.substring_index(x, "-", 1).try_cast("int"), F.substring_index(x, "-", -1).try_cast("int")))
    return F.when(good & (F.size(items) > 0), F.array_sort(F.array_distinct(F.flatten(spread))))


def no_chunks(text: Column) -> Column:
    """Whether a chunk expression is null or empty: all chunks are meant."""
    return F.coalesce(F.trim(text), F.lit("")) == ""


def episode_selector(value: str) -> str:
    """12 or episode_000012 -> the episode's name; ValueError for others."""
    if value.startswith("episode_"):
        return value
    if not (value.isascii() and value.isdigit()):
        raise ValueError(f"invalid episode selector: {value}")
    return f"episode_{int(value):06d}"


def camera_names(camera: Column) -> Column:
    """Names a camera answers to: in full, its last dotted part, its number."""
    last = F.substring_index(camera, ".", -1)
    return F.array(camera, last, F.substring_index(last, "_", -1))


def rate(text: Column) -> Column:
    """num/den as a double."""
    return F.substring_index(text, "/", 1).try_cast("double") / F.substring_index(text, "/", -1).try_cast("double")


def selector_items(text: Column) -> Column:
    """Comma list -> distinct trimmed items, first kept; null if one is unsafe, empty, or `all` isn't alone."""
    items = F.transform(F.split(text, ","), lambda x: F.trim(x))
    safe = F.forall(items, lambda x: x.rlike(r"^[A-Za-z0-9][A-Za-z0-9._-]*(/[A-Za-z0-9][A-Za-z0-9._-]*)*$"))
    return F.when(safe & (~F.array_contains(items, "all") | (F.size(F.array_distinct(items)) == 1)), F.array_distinct(items))


def modality(text: Column) -> Column:
    """Path pattern of a modality; null for an unknown one."""
    return (
        F.when(text.isin("metadata", "meta"), "meta").when(text.isin("parquet", "data"), "data").when(text.isin("videos", "images"), text)
        .when(text.rlike("^(rgb|depth|normal)_[A-Za-z0-9._-]+$"), F.concat(F.lit("videos/observation.images."), text))
        .when(text.rlike("^observation\\.images\\.[A-Za-z0-9._-]+$"), F.concat(F.lit("videos/"), text))
        .when(text.rlike("^(images|videos)/[A-Za-z0-9][A-Za-z0-9._-]*$"), text)
    )


def glob_regex(pattern: Column) -> Column:
    """Anchored regular expression: `/**` at the end is any file below, `*` stays in a segment."""
    plain = F.regexp_replace(pattern, r"([.+()\[\]{}^$|\\])", r"\\$1")
    below = F.regexp_replace(plain, r"/\*\*$", "/\u0001")
    return F.concat(F.lit("^"), F.replace(F.replace(below, F.lit("*"), F.lit("[^/]*")), F.lit("\u0001"), F.lit(".+")), F.lit("$"))
