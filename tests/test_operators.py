"""Literal cases and invariants."""

import pytest
from pyspark.sql import functions as F

from framewright.functions import exprs
from framewright.functions.ranks import grouped_rank, ranked
from framewright.operators import ledger, selectors, sequences, tasks, trim
from framewright.sources import bindings

DIR = "/root/testdata/sf0.001"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_chunk_ranges(spark):
    assert one(spark, exprs.chunk_numbers(F.lit("0,2,5-7,chunk-009"))) == [0, 2, 5, 6, 7, 9]
    assert one(spark, exprs.chunk_numbers(F.lit("7-5"))) is None
    assert one(spark, exprs.chunk_numbers(F.lit("a"))) is None


@pytest.mark.parametrize("text", ["../arm", "/kitchen/arm", "kitchen\\arm", "b/?", "", "all,arm"])
def test_unsafe_selectors(spark, text):
    assert one(spark, exprs.selector_items(F.lit(text))) is None


def test_selectors_keep_order(spark):
    assert one(spark, exprs.selector_items(F.lit("b, a,b"))) == ["b", "a"]


def test_modalities(spark):
    for text, path in {"parquet": "data", "metadata": "meta", "rgb_01": "videos/observation.images.rgb_01", "observation.images.normal_02": "videos/observation.images.normal_02"}.items():
        assert one(spark, exprs.modality(F.lit(text))) == path


def test_large_episode_numbers(spark):
    assert one(spark, exprs.episode_number(F.lit("episode_1234567"))) == 1234567
    assert one(spark, exprs.episode_number(F.lit("episode_x"))) is None


def test_discovery_of_leaf_roots(spark):
    paths = ["kitchen/arm/data/chunk-000/a", "kitchen/arm/meta/info.json", "lab/rover/videos/chunk-001/c/e", "lab/rover/data/x/meta/y", "NOTES"]
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    assert sorted(r["subset"] for r in selectors.subset_discovery(files).collect()) == ["kitchen/arm", "lab/rover"]


def test_glob(spark):
    rows = [("data/chunk-001/x.parquet", "*/chunk-001/**", True), ("a/b/chunk-001/x", "*/chunk-001/**", False), ("meta/a/b", "meta/**", True), ("metaX/a", "meta/**", False)]
    df = spark.createDataFrame(rows, "path string, pattern string, hit boolean").withColumn("rx", exprs.glob_regex(F.col("pattern")))
    assert df.filter("(path rlike rx) <> hit").count() == 0


def test_shards_ignore_completion(spark):
    base = [(i, "s", "chunk-000", "rgb", f"episode_{i:06d}") for i in range(5)]
    df = spark.createDataFrame(base, "doc_id long, subset string, chunk string, input_camera string, episode string")
    done = df.withColumn("complete", F.col("doc_id").isin(0, 3)).withColumn("quarantined", F.lit(False))
    picked = tasks.per_shard_limit(done, 2, 10).filter("shard = 0").orderBy("place").collect()
    assert [r["episode"] for r in picked] == ["episode_000002", "episode_000004"]
    assert {r["shard"]: r["pending"] for r in tasks.plan_counts(done, 2).collect()}[None] == 3


def test_crashes_quarantine_and_resolve(spark):
    events = ["process_crash"] * 3 + ["resolved", "process_crash", "python_failure", "process_crash", "resolved", "python_failure", "process_crash"]
    df = spark.createDataFrame([(i, i, 1, e) for i, e in enumerate(events)], "event_id long, ts long, task long, event string")
    rows = ledger.crash_quarantine(df, 3).orderBy("event_id").collect()
    assert [r["status"] for r in rows] == ["retrying", "retrying", "quarantined", "resolved", "retrying", "quarantined", "retrying", "resolved", "quarantined", "quarantined"]
    assert [r["attempts"] for r in rows] == [1, 2, 3, 3, 1, 1, 2, 2, 2, 3]


def test_batches_and_geometry(spark):
    frames = spark.createDataFrame([(1, i) for i in range(5)], "episode_index long, frame_index long")
    assert sorted((r["batch"], r["frames"]) for r in sequences.bounded_batches(frames, 2).collect()) == [(0, 2), (1, 2), (2, 1)]
    media = spark.createDataFrame([(1, 1280, 720, "30/1")], "media_id long, width int, height int, avg_frame_rate string")
    row = sequences.media_plan(media, 1024, 12).first()
    assert (row["out_width"], row["out_height"]) == (1024, 576)


def test_trim_is_idempotent_and_dense(spark):
    frames, specs = bindings.frames(spark, DIR), trim.trim_specs(bindings.padding(spark, DIR))
    once = trim.tail_trim(frames, specs)
    assert trim.tail_trim(once, specs).count() == once.count()
    assert once.count() + trim.tail_trim(frames, specs, dropped=True).count() == frames.count()
    index = trim.global_reindex(once).agg(F.min("index"), F.max("index"), F.countDistinct("index"), F.count("*")).first()
    assert index[0] == 0 and index[1] + 1 == index[2] == index[3]


def test_wrong_length_raises(spark):
    frames = spark.createDataFrame([(1, i) for i in range(4)], "episode_index long, frame_index long")
    specs = spark.createDataFrame([(1, 1, 9)], "episode_index long, trim_count long, original_length long")
    with pytest.raises(Exception, match="unexpected length"):
        trim.tail_trim(frames, specs).collect()


def test_ranks_match_a_plain_window(spark):
    df = spark.range(0, 1000).withColumn("g", F.col("id") % 7).withColumn("order", F.col("id") * 977 % 100003 * 50)
    sql = "select *, row_number() over (partition by g order by `order`) - 1 as want from {df}"
    assert ranked(spark.sql(sql, df=df), ["g"], "order", "got").filter("got <> want").count() == 0
    assert grouped_rank(spark.sql("select *, row_number() over (order by g, `order`) - 1 as want from {df}", df=df), ["g"], "order", "got").filter("got <> want").count() == 0


def test_roots_with_a_marker(spark):
    paths = ["videos/chunk-000/c/e.mp4", "arm/videos/chunk-000/c/e.mp4", "lab/rover/videos/x", "a/b/c/videos/x", "arm/images/chunk-000/x", "images/x", "lab/videos"]
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    assert sorted(r[0] for r in selectors.marked_roots(files, "videos").collect()) == [".", "arm", "lab/rover"]
    assert [r[0] for r in selectors.marked_roots(files, "images", least=1).collect()] == ["arm"]


def plan(spark, layout, modalities, chunks, checked=True):
    rows = selectors.parsed_requests(spark.createDataFrame([(1, "arm", modalities, chunks)], "request_id long, subset string, modalities string, chunks string"))
    if not checked:
        return [r["pattern"] for r in selectors.unverified_plan(rows).orderBy("position").collect()]
    table = spark.createDataFrame([("arm", root, c) for root, c in layout.items()], "subset string, root string, chunks string")
    patterns, issues = selectors.pattern_plan(table, rows)
    return [r["pattern"] for r in patterns.orderBy("position").collect()], sorted(r["issue"] for r in issues.collect())


def test_pattern_plans(spark):
    layout = {"data": "0,1", "meta": "", "videos": "1,2"}
    assert plan(spark, layout, None, " ") == (["arm/**"], [])
    assert plan(spark, layout, "all", None) == (["arm/**"], [])
    assert plan(spark, layout, None, "1") == (["arm/data/chunk-001/**", "arm/meta/**", "arm/videos/chunk-001/**"], [])
    assert plan(spark, layout, None, "2,7")[1] == ["missing chunk 7"]
    assert plan(spark, layout, "rgb_01,metadata,rgb_01,data", None) == (["arm/videos/chunk-*/observation.images.rgb_01/**", "arm/meta/**", "arm/data/**"], [])
    assert plan(spark, layout, "rgb_01", "2-1") == ([], ["invalid chunks"])
    assert plan(spark, layout, "rgb_01,parquet", "1-2") == (["arm/videos/chunk-001/observation.images.rgb_01/**", "arm/videos/chunk-002/observation.images.rgb_01/**", "arm/data/chunk-001/**"], ["missing chunk 2 in data"])
    assert plan(spark, {"videos": ""}, "rgb_01,images", None) == ([], ["no root images", "not chunked: videos/observation.images.rgb_01"])
    assert plan(spark, {}, "rgb_01", None) == ([], ["unknown subset"])
    assert plan(spark, layout, "data,all", None) == ([], ["all beside other modalities"])
    assert plan(spark, None, None, "1,3", False) == ["arm/meta/**", "arm/*/chunk-001/**", "arm/*/chunk-003/**"]
    assert plan(spark, None, "rgb_01,meta", "3", False) == ["arm/videos/chunk-003/observation.images.rgb_01/**", "arm/meta/**"]


def test_patterns_of_every_form(spark):
    paths = ["arm/data/chunk-001/x.parquet", "arm/meta/info.json", "arm/videos/chunk-001/cam/e.mp4", "arm/videos/chunk-002/dog/e.mp4", "arm/notes.txt"]
    forms = {"arm/**": 5, "arm/data/**": 1, "arm/*/chunk-001/**": 2, "arm/videos/chunk-*/cam/**": 1, "arm/videos/chunk-002/**": 1, "arm/videos/chunk-001/cam/e.mp4": 1, "arm/*.txt": 1, "arm/videos/chunk-*/c*/**": 1, "arm/v/**": 0, "arm/videos/chunk-001/ca/**": 0}
    files = spark.createDataFrame([("arm", p) for p in paths], "subset string, path string")
    for form, hits in forms.items():
        assert selectors.pattern_filter(files, spark.createDataFrame([("arm", form)], "subset string, pattern string")).count() == hits, form
    patterns = spark.createDataFrame([("arm", form) for form in forms], "subset string, pattern string")
    assert sorted(r[0] for r in selectors.pattern_coverage(files, patterns).collect()) == sorted(f for f, n in forms.items() if n == 0)


def test_episode_selectors():
    assert [exprs.episode_selector(x) for x in ("12", "episode_7")] == ["episode_000012", "episode_7"]
    with pytest.raises(ValueError):
        exprs.episode_selector("x1")


def test_requests_with_malformed_or_no_chunks(spark):
    catalog = spark.createDataFrame([("s", f"chunk-00{k}", f"observation.images.rgb_0{k}", f"episode_00000{k}") for k in (1, 2)], "subset string, chunk string, input_camera string, episode string")
    rows = spark.createDataFrame([(1, "s", None, "01"), (2, "s", "3-1", "01"), (3, "s", "2", "rgb_02"), (4, "s", "", "02")], "request_id long, subset string, chunks string, camera string")
    assert sorted((r["request_id"], r["episode"]) for r in tasks.resolve_requests(rows, catalog).collect()) == [(1, "episode_000001"), (3, "episode_000002"), (4, "episode_000002")]
    assert [r["request_id"] for r in selectors.request_issues(rows).collect()] == [2]
    assert [(r["request_id"], r["chunk"]) for r in selectors.nested_modality_check(rows, catalog).collect()] == [(4, "chunk-001")]


def test_completion_of_every_kind(spark):
    import json

    config = bindings.CONFIG
    base = {"status": "complete", "method": "normals", "commit": "c0ffee", "config_fingerprint": exprs.config_fingerprint(config), "task": {"input_size_bytes": 5}, "output_video": {"width": 64, "height": 36, "frames": 3, "size_bytes": 9}}
    legacy = {**{k: v for k, v in base.items() if k != "config_fingerprint"}, "settings": {k: v for k, v in config["settings"].items() if not k.startswith("output_")}}
    video = lambda **x: {**base, "output_video": {**base["output_video"], **x}}
    cases = [
        (base, True), (legacy, True), ({**legacy, "commit": "x"}, False), ({**legacy, "settings": {**legacy["settings"], "crf": 19}}, False), ({**legacy, "settings": None}, False),
        ({**legacy, "output_video": {**base["output_video"], "width": 32}}, False), ({**base, "config_fingerprint": "x"}, False), ({**base, "status": "failed"}, False), ({**base, "task": None}, True),
        ({**base, "task": {"input_size_bytes": 6}}, False), ({**base, "task": {"input_size_bytes": "?"}}, False), (video(width=0), False), (video(frames="many"), False), (video(size_bytes=None), True), (video(size_bytes=8), False),
        (video(height="36"), True), ({k: v for k, v in base.items() if k != "output_video"}, False),
    ]
    texts = [json.dumps(c) for c, _ in cases] + ["{\"status\": \"comp", "", None, json.dumps(base), json.dumps(base)]
    want = [w for _, w in cases] + [False] * 5
    n = len(texts)
    rows = spark.createDataFrame([(i, 5) for i in range(n + 1)], "doc_id long, input_size_bytes long")
    sidecars = spark.createDataFrame([(i, t, False) for i, t in enumerate(texts)], "doc_id long, payload string, quarantined boolean")
    files = spark.createDataFrame([(i, 9, i != n - 1) for i in range(n + 1) if i != n - 2], "doc_id long, output_bytes long, is_mp4 boolean")
    got = {r["doc_id"]: r["complete"] for r in tasks.completion_status(rows, sidecars, files, config).collect()}
    assert got == {**dict(enumerate(want)), n: False}


def test_failures_stop_the_job_where_asked(spark):
    from framewright.operators import publish

    def bad(pdf):
        raise KeyError("x")

    frames = spark.createDataFrame([(1, 0)], "episode_index long, frame_index long")
    row = publish.map_episodes_resilient(frames, "episode_index", bad, 2).first()
    assert (row["status"], row["attempt"], row["error_type"]) == ("failed", 2, "KeyError") and "KeyError" in row["traceback"] and row["wall_seconds"] >= 0
    with pytest.raises(Exception, match="KeyError"):
        publish.map_episodes_resilient(frames, "episode_index", bad, 2, continue_on_error=False).collect()


def test_limit_of_a_process(spark):
    base = [(i, "s", "chunk-000", "rgb", f"episode_{i:06d}") for i in range(12)]
    df = spark.createDataFrame(base, "doc_id long, subset string, chunk string, input_camera string, episode string")
    pending = df.withColumn("complete", F.col("doc_id") == 2).withColumn("quarantined", F.col("doc_id") == 4)
    taken = lambda *a, **k: sorted((r["shard"], r["episode"][-2:]) for r in tasks.per_shard_limit(pending, 2, *a, **k).collect())
    assert taken(4, per_process=2) == [(0, "00"), (0, "06"), (1, "01"), (1, "03")]
    assert taken(1, per_process=2) == [(0, "00"), (1, "01")]
    assert len(taken(4, per_process=2, dry_run=True)) == 8 and len(taken(None)) == 10 and len(taken(None, per_process=3)) == 6


def test_no_specs_and_conflicts(spark):
    schema = "episode_index long, camera string, frame_count long, tail_missing_count long, missing_frame_indices array<long>"
    none = spark.createDataFrame([(1, "a", 5, 0, []), (2, "a", 6, 0, [])], schema)
    assert [tuple(r) for r in trim.trim_spec_issues(none).collect()] == [(None, "no specs")]
    with pytest.raises(ValueError, match="no specs"):
        trim.checked_specs(none)
    bad = spark.createDataFrame([(1, "a", 5, 1, [4]), (1, "b", 6, 1, [5]), (2, "a", 6, 0, []), (2, "b", 7, 1, [6])], schema)
    assert [tuple(r) for r in trim.trim_spec_issues(bad).collect()] == [(1, "frame counts differ")]
    with pytest.raises(ValueError, match="episode 1"):
        trim.checked_specs(bad)
    assert trim.checked_specs(bad.filter("camera = 'b'")).count() == 2


def test_null_group_keys_have_ranks(spark):
    rows = [("b", None, i) for i in range(5)] + [("a", "x", i) for i in range(4)] + [(None, "y", i) for i in range(3)]
    df = spark.createDataFrame(rows, "g string, h string, k int")
    got = {(r["g"], r["h"], r["k"]): r["n"] for r in grouped_rank(df, ["g", "h"], "k", "n").collect()}
    want = sorted(rows, key=lambda r: ((r[0] is not None, r[0] or ""), (r[1] is not None, r[1] or ""), r[2]))
    assert got == {r: i for i, r in enumerate(want)}


def test_run_scope(spark):
    import hashlib

    want = hashlib.sha256("\0".join(["/data", "", "é", "1024"]).encode()).hexdigest()[:16]
    assert one(spark, ledger.run_scope(F.lit("/data"), F.lit(None), F.lit("é"), F.lit(1024))) == want
