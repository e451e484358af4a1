"""Queries that must do their whole job."""

import pandas as pd
from pyspark.sql import functions as F

from framewright.operators import ledger, tasks
from framewright.plans.queries import QUERIES
from framewright.sources import archives, bindings
from framewright.sources.scratch import new_folder
from framewright.streaming import jobs, processors

DIR = "/root/testdata/sf0.001"


def test_signatures_of_all_cameras(spark):
    paths = {r["path"] for r in QUERIES["media_signature"](spark, DIR).collect()}
    assert paths == {r["path"] for r in bindings.tree(spark, DIR).filter("path like '%.mp4'").collect()}
    assert {p.split("/")[-2] for p in paths} >= {f"observation.images.rgb_0{k}" for k in (1, 2, 3, 4)}


def test_a_shard_gives_all_tasks_below_its_limit(spark):
    status = QUERIES["completion_status"](spark, "/root/testdata/sf0.01")
    waiting = {r["shard"]: r["count"] for r in tasks.stable_shards(status, 4).filter("not complete and not quarantined").groupBy("shard").count().collect()}
    got = {r["shard"]: r["count"] for r in QUERIES["per_shard_limit"](spark, "/root/testdata/sf0.01").groupBy("shard").count().collect()}
    assert got == {shard: min(n, 50) for shard, n in waiting.items()} and max(got.values()) == 50


def test_a_drained_log_gives_all_its_events(spark):
    streamed = QUERIES["stream_quarantine"](spark, DIR).collect()
    assert sorted(map(tuple, streamed)) == sorted(map(tuple, QUERIES["crash_quarantine"](spark, DIR).collect()))
    assert len(streamed) == bindings.ledger(spark, DIR).count()


def test_leases_by_sessions_to_the_microsecond(spark, capfd):
    """Beats a microsecond within, at and behind the end of a lease, leases that end with the watermark and a millisecond before; no Python worker has a call for each beat."""
    beats = [(task, at) for task in range(3) for at in (0, 900_000_000 + task - 1)] + [(3, 9_000_000_000), (4, 7_500_000_000), (5, 7_499_999_000)]
    table = spark.createDataFrame([(t, us, i) for i, (t, us) in enumerate(beats)], "task long, us long, beat_id long").select("task", F.timestamp_micros(F.col("us") + 10**15).alias("ts"), "beat_id")
    path = new_folder(spark)
    table.coalesce(1).write.parquet(path)
    stream = jobs.lease_stream(spark.readStream.schema(table.schema).parquet(path), 900, "10 minutes")
    got = sorted(tuple(r) for r in jobs.drained(stream, new_folder(spark), new_folder(spark)).collect())
    assert [(task, n) for task, n, _ in got] == [(0, 2), (1, 2), (2, 1), (2, 1), (5, 1)]
    assert got == sorted(map(tuple, ledger.expired_leases(table, 900, F.timestamp_micros(F.lit(10**15 + 8_400_000_000))).collect()))
    capfd.readouterr()
    stream.explain()
    assert "TransformWithState" not in capfd.readouterr().out


class Held:
    """A state variable and a handle in one that count their calls."""

    def __init__(self):
        self.values, self.timers, self.calls = [], [], 0

    def appendValue(self, value):
        self.calls += 1
        self.values.append(value)

    def registerTimer(self, at):
        self.calls += 1
        self.timers.append(at)

    getValueState = getListState = lambda self, *_: self


def test_events_that_come_together_wait_as_one_value():
    fold, held = processors.CrashFold(3), Held()
    fold.init(held)
    rows = pd.DataFrame({"ts": pd.to_datetime(range(5_000_000, 5_001_000), unit="us"), "event_id": range(1000), "event": ["process_crash"] * 999 + [None]})
    assert list(fold.handleInputRows((1,), iter([rows]), None)) == []
    assert held.calls == 2 and held.timers == [5001]


def test_archives_are_dealt_by_members_and_bytes(spark):
    rows = spark.range(3000).select(F.concat(F.lit("a"), F.col("id") % 500).alias("archive"), F.col("id").cast("string").alias("member"))
    for members, payload_bytes, tasks_ in ((0, 0, 4), (50_000, 10, 50), (3000, 100 << 26, 100)):
        parts = archives.dealt(rows, members, payload_bytes).select("archive", F.spark_partition_id().alias("part"))
        assert parts.rdd.getNumPartitions() == tasks_
    assert parts.distinct().count() == 500
