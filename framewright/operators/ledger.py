"""Failure ledger: state folds, retries, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_task_state(events: DataFrame) -> DataFrame:
    last = F.max_by(F.struct("event", "event_id"), F.struct("ts", "event_id"))
    return events.groupBy("task").agg(last.alias("last"), F.count("*").alias("events")).select("task", "last.event", "last.event_id", "events")


def retry_schedule(events: DataFrame, most: int, base_seconds: int, linear: bool = True) -> DataFrame:
    """Attempts of a task's crashes and the wait before the next (linear, or always the same); the last attempt has none."""
    attempt = F.row_number().over(Window.partitionBy("task").orderBy("ts", "event_id"))
    crashes = events.filter("event = 'process_crash'").withColumn("attempt", attempt).filter(F.col("attempt") <= most)
    return crashes.select("task", "event_id", "attempt", F.when(F.col("attempt") < most, base_seconds * F.col("attempt") if linear else F.lit(base_seconds)).alias("wait_seconds"), (F.col("attempt") == most).alias("exhausted"))


def crash_quarantine(events: DataFrame, most: int) -> DataFrame:
    """State after every crash or failure: crashes count up, and start again only right after a resolved state;
    a Python failure quarantines at once and keeps the count."""
    order = Window.partitionBy("task").orderBy("ts", "event_id")
    crash = F.col("event") == "process_crash"
    reset = crash & (F.lag("event").over(order) == "resolved")
    parts = events.withColumn("part", F.sum(F.coalesce(reset, F.lit(False)).cast("int")).over(order))
    inside = Window.partitionBy("task", "part").orderBy("ts", "event_id")
    counted = parts.withColumn("attempts", F.sum(crash.cast("int")).over(inside))
    status = F.when(F.col("event") == "resolved", "resolved").when(F.col("event") == "python_failure", "quarantined").when(F.col("attempts") >= most, "quarantined").otherwise("retrying")
    return counted.select("task", "event_id", "event", F.col("attempts").cast("long").alias("attempts"), status.alias("status"))


def quarantined_now(states: DataFrame, events: DataFrame) -> DataFrame:
    """(task, failure_kind) of the tasks whose current state is quarantined."""
    last = states.join(events.select("event_id", "ts"), "event_id").groupBy("task").agg(F.max_by(F.struct("event", "status"), F.struct("ts", "event_id")).alias("last"))
    return last.filter("last.status = 'quarantined'").select("task", F.col("last.event").alias("failure_kind"))


def quarantine_summary(states: DataFrame, events: DataFrame, first: int = 50) -> DataFrame:
    """Quarantined tasks by the kind of failure (task null), and the first of them by name (tasks null)."""
    held = quarantined_now(states, events)
    kinds = held.groupBy("failure_kind").agg(F.count("*").alias("tasks")).select("failure_kind", "tasks", F.lit(None).cast("long").alias("task"))
    return kinds.unionByName(held.orderBy("task").limit(first).select("failure_kind", F.lit(None).cast("long").alias("tasks"), "task"))


def failure_counts(events: DataFrame, shards: int) -> DataFrame:
    kinds = ["process_crash", "python_failure", "resolved"]
    out = events.withColumn("shard", F.col("task") % shards).groupBy("shard").pivot("event", kinds).count()
    return out.select("shard", *[F.coalesce(k, F.lit(0)).alias(k) for k in kinds])


def expired_leases(beats: DataFrame, ttl_seconds: int, now: Column | None = None) -> DataFrame:
    """(task, beats, last_beat) of leases: runs of heartbeats that are followed by a silence strictly longer than the time to live.

    now: the last run of a task counts where that is its silence; without `now` all do. A time to live of 0 is none: no lease expires.
    """
    order = Window.partitionBy("task").orderBy("ts", "beat_id")
    seconds = lambda c: F.unix_micros(c.cast("timestamp"))
    ttl = ttl_seconds * 1_000_000
    gap = seconds(F.col("ts")) - seconds(F.lag("ts").over(order))
    marked = beats.withColumn("new", F.coalesce((gap > ttl).cast("int"), F.lit(1)))
    leases = marked.withColumn("session", F.sum("new").over(order)).groupBy("task", "session").agg(F.count("*").alias("beats"), F.max("ts").alias("last_beat"))
    if ttl_seconds == 0:
        leases = leases.filter(F.lit(False))
    if now is not None:
        leases = leases.filter(seconds(now) - seconds(F.col("last_beat")) > ttl)
    return leases.select("task", "beats", "last_beat")


def run_scope(*parameters: Column) -> Column:
    """Name of the ledger of runs with the same parameters: 16 hexadecimal digits over their texts, joined by NUL."""
    joined = F.concat_ws("\0", *[F.coalesce(p.cast("string"), F.lit("")) for p in parameters])
    return F.substring(F.sha2(joined, 256), 1, 16)
