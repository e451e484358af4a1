"""Subset discovery, layouts, download patterns, and checks of requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewright.functions import exprs

MARKERS = ("data", "images", "meta", "videos")
DEPTH = 4


def subset_discovery(files: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Topmost directories of the paths, `depth` deep at most, that hold a marker directory."""
    parts = F.split("path", "/")
    heads = files.select(F.explode(F.sequence(F.lit(1), F.least(F.size(parts) - 2, F.lit(depth)))).alias("n"), parts.alias("parts")).filter("n >= 1")
    marked = heads.filter(F.get("parts", F.col("n")).isin(*MARKERS)).select(F.array_join(F.slice("parts", F.lit(1), F.col("n")), "/").alias("subset")).distinct()
    above = F.transform(F.sequence(F.lit(1), F.size(F.split("subset", "/"))), lambda i: F.array_join(F.slice(F.split("subset", "/"), F.lit(1), i), "/"))
    below = marked.select("subset", F.explode(above).alias("upper")).filter("upper <> subset").join(marked.select(F.col("subset").alias("upper")), "upper", "left_semi")
    return marked.join(below.select("subset"), "subset", "left_anti")


def subset_layout(files: DataFrame) -> DataFrame:
    """Sorted chunk numbers of each subset and root; empty for roots without chunk directories."""
    parts = F.split(F.expr("substring(path, length(subset) + 2)"), "/")
    number = F.regexp_extract(F.get(parts, F.lit(1)), r"^chunk-([0-9]+)$", 1)
    rooted = files.filter(F.size(parts) > 1).select("subset", F.get(parts, F.lit(0)).alias("root"), F.when((number != "") & (F.size(parts) > 2), number.try_cast("int")).alias("chunk"))
    return rooted.groupBy("subset", "root").agg(F.array_join(F.sort_array(F.collect_set("chunk")), ",").alias("chunks"))


def marked_roots(files: DataFrame, marker: str, least: int = 0, most: int = 2) -> DataFrame:
    """Directories `least` to `most` deep that hold the directory `marker`, also below each other ('.' is the top)."""
    parts = F.split("path", "/")
    heads = files.select(parts.alias("parts"), F.explode(F.sequence(F.lit(least), F.lit(most))).alias("n"))
    held = heads.filter((F.get("parts", F.col("n")) == marker) & (F.size("parts") > F.col("n") + 1))
    return held.select(F.when(F.col("n") == 0, ".").otherwise(F.array_join(F.slice("parts", F.lit(1), F.col("n")), "/")).alias("subset")).distinct()


def parsed_requests(requests: DataFrame) -> DataFrame:
    """Requests (request_id, subset, modalities, chunks: comma lists, null or empty for none) with their parts as arrays.

    paths: modalities as paths, in order, the first of equals; none for `all`. wanted: chunk numbers. An invalid one is named in `invalid`.
    """
    given = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    items = F.transform(F.split("modalities", ","), lambda x: F.trim(x))
    paths = F.transform(items, exprs.modality)
    everything = F.array_contains(items, "all")
    out = requests.withColumns({
        "paths": F.when(given("modalities") & ~everything, F.array_distinct(paths)),
        "wanted": F.when(given("chunks"), exprs.chunk_numbers(F.col("chunks"))),
        "invalid": F.when(given("modalities") & everything & (F.size(F.array_distinct(items)) > 1), "all beside other modalities")
        .when(given("modalities") & ~everything & F.exists(paths, lambda x: x.isNull()), "invalid modality")
        .when(given("chunks") & exprs.chunk_numbers(F.col("chunks")).isNull(), "invalid chunks"),
    })
    return out


def _chunk(n: Column) -> Column:
    return F.format_string("chunk-%03d", n)


def _first_of_equals(rows: DataFrame) -> DataFrame:
    """(request_id, subset, position, pattern) in the order of `at`; repeated patterns count once."""
    once = rows.groupBy("request_id", "subset", "pattern").agg(F.min("at").alias("at"))
    order = Window.partitionBy("request_id", "subset").orderBy("at")
    return once.select("request_id", "subset", (F.row_number().over(order) - 1).cast("long").alias("position"), "pattern")


def pattern_plan(layout: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Patterns (request_id, subset, position, pattern) and issues (request_id, subset, issue) of parsed requests against the layout.

    A request without parts takes the subset whole; one with chunks only takes them of every root, and roots without chunks whole;
    a modality takes its root, its directory in every chunk, or in the chunks given. A request with an issue must not be carried out.
    """
    have = layout.select("subset", "root", F.when(F.col("chunks") != "", F.transform(F.split("chunks", ","), lambda x: x.cast("int"))).alias("available"))
    good = requests.filter("invalid is null")
    below = lambda *parts: F.concat_ws("/", *parts, F.lit("**"))
    at = lambda i, j: F.array(i, j)
    head = ("request_id", "subset")
    roots = have.groupBy("subset").agg(F.array_sort(F.collect_set("root")).alias("roots"), F.array_distinct(F.flatten(F.collect_list("available"))).alias("anywhere"))
    known = good.join(roots, "subset", "left")
    whole = known.filter("roots is not null and paths is null and wanted is null").select(*head, at(F.lit(0), F.lit(0)).alias("at"), below("subset").alias("pattern"))
    # chunks only
    chunked = good.filter("paths is null and wanted is not null").join(have, "subset").join(roots.select("subset", "roots"), "subset")
    each = F.when(F.col("available").isNull(), F.array(F.lit(None).cast("int"))).otherwise(F.filter("wanted", lambda n: F.array_contains("available", n)))
    chunked = chunked.select(*head, "root", F.array_position("roots", F.col("root")).cast("int").alias("i"), F.posexplode(each).alias("j", "n"))
    chunked = chunked.select(*head, at(F.col("i"), F.col("j")).alias("at"), F.when(F.col("n").isNull(), below("subset", "root")).otherwise(below("subset", "root", _chunk(F.col("n")))).alias("pattern"))
    nowhere = known.filter("roots is not null and paths is null and wanted is not null").select(*head, F.explode(F.array_except("wanted", F.coalesce("anywhere", F.array().cast("array<int>")))).alias("n"))
    # modalities
    each_path = known.filter("roots is not null and paths is not null").select(*head, "wanted", F.posexplode("paths").alias("i", "path"))
    each_path = each_path.withColumn("root", F.substring_index("path", "/", 1)).withColumn("nested", F.when(F.col("path").contains("/"), F.substring_index("path", "/", -1)))
    met = each_path.join(have.withColumn("there", F.lit(True)), ["subset", "root"], "left")
    numbers = F.when(F.col("available").isNull() | F.col("wanted").isNull(), F.array(F.lit(None).cast("int"))).otherwise(F.col("wanted"))
    met = met.select(*head, "i", "path", "root", "nested", "there", "available", F.posexplode(numbers).alias("j", "n"))
    absent = F.col("n").isNotNull() & ~F.array_contains("available", F.col("n"))
    issue = (
        F.when(F.col("there").isNull(), F.concat(F.lit("no root "), "root")).when(F.col("nested").isNotNull() & F.col("available").isNull(), F.concat(F.lit("not chunked: "), "path"))
        .when(absent, F.concat(F.lit("missing chunk "), F.col("n").cast("string"), F.lit(" in "), F.col("root")))
    )
    met = met.withColumn("issue", issue)
    pattern = (
        F.when(F.col("n").isNotNull(), below("subset", "root", _chunk(F.col("n")), "nested"))
        .when(F.col("nested").isNotNull() & F.col("available").isNotNull(), below("subset", "root", F.lit("chunk-*"), "nested")).otherwise(below("subset", "root"))
    )
    by_path = met.filter("issue is null").select(*head, at(F.col("i"), F.col("j")).alias("at"), pattern.alias("pattern"))
    issues = (
        requests.filter("invalid is not null").select(*head, F.col("invalid").alias("issue"))
        .unionByName(known.filter("roots is null").select(*head, F.lit("unknown subset").alias("issue")))
        .unionByName(nowhere.select(*head, F.concat(F.lit("missing chunk "), F.col("n").cast("string")).alias("issue")))
        .unionByName(met.filter("issue is not null").select(*head, "issue"))
    )
    return _first_of_equals(whole.unionByName(chunked).unionByName(by_path)), issues.distinct()


def unverified_plan(requests: DataFrame) -> DataFrame:
    """Patterns of parsed requests without a layout (a dry run): nothing is checked, and only `meta` counts as without chunks."""
    below = lambda *parts: F.concat_ws("/", *parts, F.lit("**"))
    good = requests.filter("invalid is null")
    none = F.array(F.lit(None).cast("int"))
    bare = good.filter("paths is null").withColumn("n", F.explode(F.when(F.col("wanted").isNull(), none).otherwise(F.concat(F.array(F.lit(-1)), "wanted"))))
    pattern = F.when(F.col("n").isNull(), below("subset")).when(F.col("n") < 0, below("subset", F.lit("meta"))).otherwise(below("subset", F.lit("*"), _chunk(F.col("n"))))
    bare = bare.select("request_id", "subset", F.array(F.lit(0), F.col("n")).alias("at"), pattern.alias("pattern"))
    each = good.filter("paths is not null").select("request_id", "subset", "wanted", F.posexplode("paths").alias("i", "path"))
    each = each.withColumn("root", F.substring_index("path", "/", 1)).withColumn("nested", F.when(F.col("path").contains("/"), F.substring_index("path", "/", -1)))
    each = each.withColumn("n", F.explode(F.when(F.col("wanted").isNull() | (F.col("root") == "meta"), none).otherwise(F.col("wanted"))))
    pattern = F.when(F.col("n").isNull(), below("subset", "root")).otherwise(below("subset", "root", _chunk(F.col("n")), "nested"))
    return _first_of_equals(bare.unionByName(each.select("request_id", "subset", F.array("i", "n").alias("at"), pattern.alias("pattern"))))


def _keys_of_file() -> Column:
    """The directories above a file, as patterns name them: subset, root, chunk and camera literal, or the root or the chunk as a wildcard."""
    parts = F.split(F.expr("substring(path, length(subset) + 2)"), "/")
    part = lambda i: F.get(parts, F.lit(i))
    is_chunk = part(1).rlike("^chunk-[^/]*$")
    deep = lambda n, *of: F.when(F.size(parts) > n, F.concat_ws("/", "subset", *of))
    keys = F.array(
        deep(0), deep(1, part(0)), deep(2, part(0), part(1)), deep(3, part(0), part(1), part(2)), deep(2, F.lit("*"), part(1)),
        F.when(is_chunk, deep(3, part(0), F.lit("chunk-*"), part(2))),
    )
    return F.filter(keys, lambda k: k.isNotNull())


_KEYED = r"^[^*/]+(/[^*/]+){0,2}$|^[*]/[^*/]+$|^[^*/]+/chunk-[*]/[^*/]+$"


def _matches(files: DataFrame, patterns: DataFrame) -> DataFrame:
    """(path, pattern): patterns that name a directory meet the files by an equi-join on it; regular expressions are left for the others."""
    keyed = patterns.withColumn("key", F.when(F.col("pattern").endswith("/**"), F.expr("substring(pattern, 1, length(pattern) - 3)")))
    rest = F.when(F.col("key") == F.col("subset"), F.lit("")).otherwise(F.expr("substring(key, length(subset) + 2)"))
    keyed = keyed.withColumn("by_key", F.coalesce((rest == "") | rest.rlike(_KEYED), F.lit(False)))
    rows = files.select("subset", "path")
    by_key = rows.withColumn("key", F.explode(_keys_of_file())).join(keyed.filter("by_key").select("subset", "key", "pattern"), ["subset", "key"])
    others = keyed.filter("not by_key").select("subset", "pattern", exprs.glob_regex(F.col("pattern")).alias("rx"))
    return by_key.select("path", "pattern").unionByName(rows.join(others, "subset").filter("path rlike rx").select("path", "pattern"))


def pattern_filter(files: DataFrame, patterns: DataFrame) -> DataFrame:
    """Files (subset, path) that some pattern (subset, pattern) matches."""
    return _matches(files, patterns.select("subset", "pattern").distinct()).select("path").distinct()


def pattern_coverage(files: DataFrame, patterns: DataFrame) -> DataFrame:
    """Patterns that match no file."""
    wanted = patterns.select("subset", "pattern").distinct()
    return wanted.select("pattern").join(_matches(files, wanted).select("pattern").distinct(), "pattern", "left_anti")


def unknown_selectors(requests: DataFrame, tasks: DataFrame) -> DataFrame:
    return requests.select("subset").distinct().join(tasks.select("subset").distinct(), "subset", "left_anti")


def request_issues(requests: DataFrame) -> DataFrame:
    """(request_id, issue) of requests whose chunk expression is malformed; one without chunks wants all of them."""
    return requests.filter(exprs.no_chunks(F.col("chunks")) == False).filter(exprs.chunk_numbers(F.col("chunks")).isNull()).select("request_id", F.lit("invalid chunks").alias("issue"))  # noqa: E712


def nested_modality_check(requests: DataFrame, tasks: DataFrame) -> DataFrame:
    """Requests whose camera is missing in a selected chunk, or in the subset's first chunk where none is selected."""
    have = tasks.select("subset", "chunk", F.explode(exprs.camera_names(F.col("input_camera"))).alias("camera")).distinct()
    some = requests.filter(~exprs.no_chunks(F.col("chunks"))).select("request_id", "subset", "camera", F.explode(exprs.chunk_numbers(F.col("chunks"))).alias("n"))
    want = some.select("request_id", "subset", "camera", _chunk(F.col("n")).alias("chunk"))
    first = tasks.groupBy("subset").agg(F.min("chunk").alias("chunk"))
    rest = requests.filter(exprs.no_chunks(F.col("chunks"))).join(first, "subset").select("request_id", "subset", "camera", "chunk")
    return want.unionByName(rest).join(have, ["subset", "chunk", "camera"], "left_anti")


def chunk_except(requests: DataFrame, layout: DataFrame) -> DataFrame:
    """(subset, root, chunk): requested chunks that a root lacks; root null: that every root of the subset lacks."""
    want = requests.select("subset", F.explode(exprs.chunk_numbers(F.col("chunks"))).alias("chunk")).distinct()
    have = layout.filter("chunks <> ''").select("subset", "root", F.explode(F.split("chunks", ",")).alias("chunk")).withColumn("chunk", F.col("chunk").cast("int"))
    anywhere = want.exceptAll(have.select("subset", "chunk").distinct()).select("subset", F.lit(None).cast("string").alias("root"), "chunk")
    each = have.select("subset", "root").distinct().join(want, "subset").select("subset", "root", "chunk").exceptAll(have.select("subset", "root", "chunk"))
    return anywhere.unionByName(each)
