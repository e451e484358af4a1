"""Statistics of all features, blending, durable attempts, and streams in event time."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.operators import attempts, ledger, sequences, stats
from framewright.sources import documents, versions
from framewright.sources.scratch import new_folder
from framewright.streaming import jobs

BASE = 1_700_000_000  # seconds: a watermark begins at 0

# statistics

FRAMES = "episode_index long, v array<double>, s float, b boolean, n array<array<int>>, c array<double>"


def frame_rows():
    rng = np.random.default_rng(3)
    return [(e, rng.normal(size=3).tolist(), float(i), bool(i % 2), [[i, e], [1, 2]], [0.1, 1e9 + 0.1]) for e in (1, 2, 5) for i in range(40 + e)]


def test_statistics_of_every_feature(spark, capfd):
    rows = frame_rows()
    df = spark.createDataFrame(rows, FRAMES).repartition(7)
    names = ["v", "s", "b", "n", "c"]
    got = {(r["episode_index"], r["feature"]): r for r in stats.episode_stats(df, names).collect()}
    assert len(got) == 15
    parts = stats.accumulators(df, names)
    total = {r["feature"]: r for r in stats.global_stats(parts).collect()}
    for i, name in enumerate(names, 1):
        for e in (1, 2, 5, None):
            x = np.array([np.ravel(r[i]) for r in rows if e is None or r[0] == e], dtype=float)
            r = total[name] if e is None else got[e, name]
            assert r["count"] == len(x)
            for c, want in (("min", x.min(0)), ("max", x.max(0)), ("mean", x.mean(0)), ("std", x.std(0))):
                np.testing.assert_allclose(r[c], want, rtol=1e-12, atol=1e-12 if name != "c" else 1e-5)
    assert total["c"]["std"] == [0.0, 0.0] and got[1, "c"]["std"] == [0.0, 0.0] and total["c"]["mean"] == [0.1, 1e9 + 0.1]
    parts.explain()
    plan = capfd.readouterr().out
    assert "Generate" not in plan and "explode" not in plan
    (row,) = stats.stats_rows(stats.episode_stats(df, names)).filter("episode_index = 2").collect()
    assert sorted(row["stats"]) == sorted(names) and row["stats"]["s"]["count"] == [42]


def test_more_episodes_than_a_task_holds(spark, monkeypatch):
    monkeypatch.setattr(stats, "HELD", 3)
    df = spark.createDataFrame([(i % 50, float(i)) for i in range(500)], "episode_index long, x double").repartition(5)
    got = stats.episode_stats(df, ["x"]).collect()
    assert len(got) == 50 and all(r["count"] == 10 and r["mean"] == [225.0 + r["episode_index"]] for r in got)


def test_nan_null_and_ragged_features(spark):
    df = spark.createDataFrame([(1, [1.0, float("nan")]), (1, [3.0, 2.0])], "episode_index long, v array<double>")
    (row,) = stats.episode_stats(df, ["v"]).collect()
    assert (row["min"][0], row["max"][0]) == (1.0, 3.0) and all(np.isnan(row[c][1]) for c in ("min", "max", "mean", "std"))
    for bad, message in (([(1, None)], "null in v"), ([(1, [None])], "null in v"), ([(1, [1.0]), (1, [1.0, 2.0])], "lengths differ")):
        with pytest.raises(Exception, match=message):
            stats.episode_stats(spark.createDataFrame(bad, "episode_index long, v array<double>").coalesce(1), ["v"]).collect()
    assert stats.episode_stats(df.limit(0), ["v"]).collect() == [] and stats.global_stats(stats.accumulators(df.limit(0), ["v"])).collect() == []


def test_features_come_from_the_first_row(spark, tmp_path):
    (tmp_path / "s.jsonl").write_text('{"episode_index":4,"stats":{"z":{}}}\n{"episode_index":2,"stats":{"b.c":{"min":[1]},"a":{}}}\n')
    assert stats.stats_features(documents.scan_json_rows(spark, f"file://{tmp_path}/s.jsonl")) == ["a", "b.c"]
    (tmp_path / "none.jsonl").write_text("")
    assert stats.stats_features(documents.scan_json_rows(spark, f"file://{tmp_path}/none.jsonl")) == []


# blending


def plain_blend(seen, size, step):
    over, out = size - step, {}
    for e, w, i, v in sorted(seen, key=lambda r: (r[0], r[2], r[1])):
        place = i - w * step
        weight = 1 - (place + 1) / (over + 1) if place < over else 0.0
        before = out.get((e, i))
        out[e, i] = list(v) if before is None else [a * weight + b * (1 - weight) for a, b in zip(before, v)]
    return out


@pytest.mark.parametrize("size,step,batch", [(14, 10, 3), (7, 2, 1), (7, 2, 1000), (3, 3, 5)])
def test_blending_whole_vectors(spark, size, step, batch):
    rng = np.random.default_rng(1)
    frames = [(e, i, rng.normal(size=5).tolist()) for e, n in ((1, 1), (2, 33), (9, 80)) for i in range(n)]
    df = spark.createDataFrame(frames, "episode_index long, frame_index long, v array<float>")
    seen = sequences.window_frames(df, "v", size, step).withColumn("vector", F.transform("vector", lambda x: x * (F.col("window") + 1)))
    limit = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = {(r["episode_index"], r["frame_index"]): list(r["blended"]) for r in sequences.overlap_blend(seen, size, step).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", limit)
    want = plain_blend([(r["episode_index"], r["window"], r["frame_index"], r["vector"]) for r in seen.collect()], size, step)
    assert got.keys() == want.keys() and len(got) == 114
    for k in want:
        np.testing.assert_allclose(got[k], want[k], rtol=1e-12, atol=1e-12)
    assert sequences.overlap_blend(seen.limit(0), size, step).collect() == []


# attempts


def test_attempts_outlive_crashes(spark):
    log, seen = new_folder(spark), []
    frames = spark.createDataFrame([(e, i) for e in range(8) for i in range(3)], "episode_index long, frame_index long")

    def fn(pdf):
        e = int(pdf["episode_index"].iloc[0])
        if e == 5:
            os._exit(1)  # the worker dies
        if e == 6:
            raise KeyError("x")
        return len(pdf), float(e)

    rows = {r["episode_index"]: r for r in attempts.map_episodes_durably(frames, "episode_index", fn, 3, log).collect()}
    assert {e: r["status"] for e, r in rows.items()} == {**dict.fromkeys(range(8), "complete"), 5: "quarantined", 6: "failed"}
    assert (rows[5]["attempt"], rows[5]["crashes"]) == (3, 3) and (rows[6]["attempt"], rows[6]["error_type"]) == (3, "KeyError") and "KeyError" in rows[6]["traceback"]
    assert all(rows[e]["count"] == 3 and rows[e]["value"] == e for e in rows if e not in (5, 6))
    events = attempts.read_log(spark, log).count()

    def never(pdf):
        seen.append(1)
        raise AssertionError("settled episodes aren't done again")

    again = attempts.map_episodes_durably(frames, "episode_index", never, 3, log)
    assert again.count() == 8 and attempts.read_log(spark, log).count() == events
    more = attempts.map_episodes_durably(frames.unionByName(spark.createDataFrame([(70, 0)], frames.schema)), "episode_index", lambda pdf: (1, 1.0), 3, log)
    assert more.filter("episode_index = 70 and status = 'complete'").count() == 1


def test_a_log_with_a_torn_line(spark):
    log = new_folder(spark)
    folder = log[len("file://"):]
    os.makedirs(folder)
    with open(f"{folder}/a.json", "w") as out:
        out.write('{"episode_index": 1, "event": "started", "time": 1.0}\n{"episode_index": 1, "event": "star')
    (row,) = attempts.attempt_states(attempts.read_log(spark, log), 3).collect()
    assert (row["status"], row["crashes"], row["attempt"]) == ("pending", 1, 1)


# streams


def fed(spark, table, path, which, order):
    table.filter(which).coalesce(1).write.mode("append").parquet(f"{path}/{order}")


def events_table(spark):
    hour = 3600
    rows = [(0, 0, 1, "process_crash"), (1, 10, 1, "process_crash"), (2, hour // 2, 1, "resolved"), (3, hour, 1, "process_crash"), (4, hour + 5, 2, "python_failure"), (5, 20, 1, "process_crash"), (6, 3 * hour, 2, "resolved"), (7, hour + 1, 1, "process_crash"), (8, 9 * hour, 3, "process_crash")]
    return spark.createDataFrame(rows, "event_id long, s long, task long, event string").select("event_id", F.timestamp_seconds(F.col("s") + BASE).alias("ts"), "task", "event")


def test_late_events_and_a_restart_as_in_batch(spark):
    """Three files, one at a time: 0-4; a late 5 (its order is before 2) and 6; after a restart 7, late too, and 8."""
    table, path, out, checkpoint = events_table(spark), new_folder(spark), new_folder(spark), new_folder(spark)

    def drain():
        stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")
        return jobs.drained(jobs.quarantine_stream(stream, 2, "2 hours"), out, checkpoint)

    fed(spark, table, path, "event_id <= 4", 0)
    fed(spark, table, path, "event_id in (5, 6)", 1)
    drain()
    fed(spark, table, path, "event_id > 6", 2)
    got = sorted(map(tuple, drain().collect()))
    passed = table.filter("event_id <> 8")
    assert got == sorted(map(tuple, ledger.crash_quarantine(passed, 2).collect()))


def test_leases_expire_strictly_after_their_time(spark):
    ttl = 900
    beats = [(1, 0), (1, 900), (1, 1801), (1, 1900), (2, 0), (2, 901), (3, 5), (1, 8000), (4, 9000)]
    table = spark.createDataFrame([(t, s, i) for i, (t, s) in enumerate(beats)], "task long, s long, beat_id long").select("task", F.timestamp_seconds(F.col("s") + BASE).alias("ts"), "beat_id")
    now = F.timestamp_seconds(F.lit(BASE + 9000 - 600))
    want = sorted(map(tuple, ledger.expired_leases(table, ttl, now).collect()))
    assert [(t, n) for t, n, _ in want] == [(1, 2), (1, 2), (2, 1), (2, 1), (3, 1)]
    path = new_folder(spark)
    for k, which in enumerate(("beat_id in (0, 1, 2, 6)", "beat_id in (3, 4, 5)", "beat_id = 7", "beat_id = 8")):
        fed(spark, table, path, which, k)
    for files_ in (1, 100):
        stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files_).parquet(f"{path}/*")
        got = jobs.drained(jobs.lease_stream(stream, ttl, "10 minutes"), new_folder(spark), new_folder(spark))
        assert sorted(map(tuple, got.collect())) == want, files_
    off = spark.readStream.schema(table.schema).parquet(f"{path}/*")
    assert jobs.drained(jobs.lease_stream(off, 0), new_folder(spark), new_folder(spark)).collect() == [] and ledger.expired_leases(table, 0).collect() == []


def test_a_replayed_batch_counts_once(spark):
    table = versions.VersionedTable(spark, new_folder(spark))
    rows = spark.createDataFrame([(i % 3, i) for i in range(20)], "task long, beat_id long")
    jobs.merge_counts(rows, 0, table, ["task"])
    jobs.merge_counts(rows, 0, table, ["task"])
    assert {r["task"]: r["outputs"] for r in table.read().collect()} == {0: 7, 1: 7, 2: 6}
    jobs.merge_counts(rows.filter("task = 1"), 1, table, ["task"])
    jobs.merge_counts(rows.limit(0), 2, table, ["task"])
    jobs.merge_counts(rows, 1, table, ["task"])
    assert {r["task"]: r["outputs"] for r in table.read().collect()} == {0: 7, 1: 14, 2: 6}


def test_counts_go_on_after_a_restart(spark):
    table, path, checkpoint = versions.VersionedTable(spark, new_folder(spark)), new_folder(spark), new_folder(spark)
    beats = spark.createDataFrame([(i % 2, i, i) for i in range(30)], "task long, s long, beat_id long").select("task", F.timestamp_seconds(F.col("s") + BASE).alias("ts"), "beat_id")
    for k, which in enumerate(("beat_id < 10", "beat_id < 20")):  # ten arrive again
        fed(spark, beats, path, which, k)
        jobs.count_outputs(spark.readStream.schema(beats.schema).parquet(f"{path}/*"), table, checkpoint, ["task"])
    assert {r["task"]: r["outputs"] for r in table.read().collect()} == {0: 10, 1: 10}
