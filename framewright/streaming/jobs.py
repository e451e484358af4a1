"""Structured Streaming twins of the ledger jobs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.sources.versions import VersionedTable, retried
from framewright.streaming import processors
from framewright.streaming.processors import CrashFold

register_pickle_by_value(processors)  # the worker that sets a processor up gets no files of the application

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def quarantine_stream(events: DataFrame, most: int, delay: str = "1 hour") -> DataFrame:
    """State after every event of a live log, in event time, whatever batch an event comes in and across restarts.

    An event is given out once the watermark (the latest event's time less `delay`) has passed it; one that comes later than that is dropped.
    What waits for a task are its events of the last `delay`. A row whose event is null only moves the watermark (`ended`).
    """
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    return timed.groupBy("task").transformWithStateInPandas(CrashFold(most), "task long, event_id long, event string, attempts long, status string", "Append", "EventTime")


def ended(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """A log that has ended, with a last row that lets the watermark pass all its events."""
    end = events.agg(F.max("ts").alias("ts"), F.max_by("task", "ts").alias("task")).filter("ts is not null")
    after = F.col("ts") + F.expr(f"INTERVAL {delay}") + F.expr("INTERVAL 1 second")
    return events.unionByName(end.select(F.lit(0).cast("long").alias("event_id"), after.alias("ts"), "task", F.lit(None).cast("string").alias("event")))


def lease_stream(beats: DataFrame, ttl_seconds: int, delay: str = "1 hour") -> DataFrame:
    """(task, beats, last_beat) of every lease that expires: its last beat is strictly older than the time to live. A later beat begins a new
    lease. A time to live of 0 is none: no lease expires.

    A lease is a session: a beat right at its end renews it. Watermarks are whole milliseconds, and a session may go once its end is reached; one
    more makes that strict: no lease goes early, and none more than two milliseconds late.
    """
    timed = beats.withColumn("ts", F.col("ts").cast("timestamp"))
    if ttl_seconds == 0:
        timed, ttl_seconds = timed.filter(F.lit(False)), 1
    timed = timed.withWatermark("ts", f"{delay} 1 millisecond")
    lease = F.session_window("ts", f"{ttl_seconds} seconds")
    return timed.groupBy(lease, "task").agg(F.count("*").alias("beats"), F.max("ts").alias("last_beat")).select("task", "beats", "last_beat")


def new_outputs_stream(arrivals: DataFrame, delay: str = "1 hour") -> DataFrame:
    """First arrival of every output within the watermark."""
    timed = arrivals.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    return timed.dropDuplicatesWithinWatermark(["beat_id"]).select("task", "beat_id", "ts")


BUCKETS = 64


def merge_counts(rows: DataFrame, batch: int, table: VersionedTable, keys: list[str], job: str = "counts") -> None:
    """Adds the numbers of a batch's rows by `keys` to the counts in `table`, once: the version that holds them remembers the batch.

    Counts lie in buckets of keys; only those that the batch has keys in are written again.
    """
    spark = rows.sparkSession
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
    new = rows.groupBy(*keys).agg(F.count("*").alias("outputs")).withColumn("bucket", bucket).persist()
    try:
        touched = [str(r["bucket"]) for r in new.select("bucket").distinct().collect()]  # BUCKETS at most

        def attempt() -> None:
            base = table.current()
            if base.properties.get(job, -1) >= batch:
                return
            before = table.read(base, touched) if base.folders else spark.createDataFrame([], new.schema)
            merged = before.select(*new.columns).union(new).groupBy(*keys, "bucket").agg(F.sum("outputs").alias("outputs"))
            table.replace(base, merged, "bucket", touched, properties={job: batch})

        retried(attempt)
    finally:
        new.unpersist()


def count_outputs(arrivals: DataFrame, table: VersionedTable, checkpoint: str, keys: list[str], delay: str = "1 hour", job: str = "counts") -> None:
    """Counts what has arrived of a stream into `table`, repeated arrivals once, and ends; the next call goes on where this one ended.

    Arrivals are remembered in the session's state store: for many within `delay`, set RocksDB.
    """
    stream = new_outputs_stream(arrivals, delay).withColumn("day", F.date_trunc("day", "ts"))
    query = (
        stream.writeStream.foreachBatch(lambda rows, batch: merge_counts(rows, batch, table, keys, job)).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


@contextmanager
def _rocksdb(spark: SparkSession) -> Iterator[None]:
    """State in RocksDB for the queries that start inside, as stateful processors need it."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def drained(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Runs what is available through a stream into a Parquet sink and reads it."""
    with _rocksdb(stream.sparkSession):
        query = stream.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
        query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
