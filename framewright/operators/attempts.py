"""User functions over episodes whose attempts outlive the job.

Every attempt leaves a line in a log in the shared folder before it begins and another when it ends. A run reads the log first: complete episodes aren't
done again, and an attempt that has a beginning without an end was a crash, of the Python worker, the executor or the whole job. An episode
with too many attempts is quarantined, the others go on.
"""

from __future__ import annotations

import json
import time
import traceback
import uuid
from collections.abc import Callable

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.operators.publish import RESULT, worker_state
from framewright.sources.scratch import filesystem, ship

EVENT = "episode_index long, event string, time double, count long, value double, error_type string, error string, traceback string, wall_seconds double"


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """The log's events; a line that a crash cut off is passed over."""
    system, path = filesystem(log)
    system.create_dir(path, recursive=True)
    return spark.read.schema(EVENT).option("mode", "DROPMALFORMED").json(log).filter("event is not null")


def attempt_states(events: DataFrame, most: int) -> DataFrame:
    """`RESULT` and `crashes` of every episode in the log: complete, failed, quarantined (given up after crashes), or pending."""
    e = F.col("event")
    last = F.struct("count", "value", "error_type", "error", "traceback", "wall_seconds", "time")
    states = events.groupBy("episode_index").agg(
        F.count_if(e == "started").alias("started"), F.count_if(e == "failed").alias("failures"), F.count_if(e == "complete").alias("completions"),
        F.min_by(F.when(e == "complete", last), F.when(e == "complete", F.col("time"))).alias("good"), F.max_by(F.when(e == "failed", last), F.when(e == "failed", F.col("time"))).alias("bad"))
    done, spent = F.col("completions") > 0, F.col("started") >= most
    crashes = F.greatest(F.col("started") - F.col("failures") - F.col("completions"), F.lit(0))
    status = F.when(done, "complete").when(spent & (crashes > 0), "quarantined").when(spent, "failed").otherwise("pending")
    end = F.coalesce("good", "bad")
    attempt = F.when(done, F.col("started") - F.col("completions") + 1).otherwise(F.col("started")).cast("int")
    kept = ("count", "value", "error_type", "error", "traceback", "wall_seconds")
    return states.select("episode_index", status.alias("status"), attempt.alias("attempt"), *[end[c].alias(c) for c in kept], crashes.alias("crashes"))


_OPEN: dict[str, object] = {}


def task_log(log: str, name: str):
    """The file that a task attempt writes its events to, open as long as its Python worker has no other; what is in it when the worker dies stays."""
    if name not in _OPEN:
        for other in list(_OPEN):
            _OPEN.pop(other).close()
        system, base = filesystem(log)
        _OPEN[name] = system.open_output_stream(f"{base}/{name}.json", compression=None)
    return _OPEN[name]


def _attempts(key: str, fn: Callable, setup: Callable | None, log: str, most: int):
    run_id = uuid.uuid4().hex

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        from pyspark import TaskContext

        from framewright.operators.attempts import task_log  # with the worker's own open file

        episode, before = int(pdf[key].iloc[0]), int(pdf["_started"].iloc[0])
        pdf = pdf.drop(columns="_started")
        out, done = task_log(log, f"{run_id}-{TaskContext.get().taskAttemptId()}"), 0

        def note(event: str, **more) -> None:
            out.write((json.dumps({"episode_index": episode, "event": event, "time": time.time(), **more}) + "\n").encode())
            out.flush()

        for _ in range(most - before):
            begun = time.monotonic()
            note("started")
            done += 1
            try:
                state = worker_state(run_id, setup)
                count, value = fn(pdf) if setup is None else fn(state, pdf)
                note("complete", count=int(count), value=float(value), wall_seconds=time.monotonic() - begun)
                break
            except Exception as e:  # noqa: BLE001  the user's function may raise anything
                note("failed", error_type=type(e).__name__, error=str(e), traceback=traceback.format_exc(), wall_seconds=time.monotonic() - begun)
        return pd.DataFrame({"attempts": [done]})

    return run


def map_episodes_durably(frames: DataFrame, key: str, fn: Callable[..., tuple[int, float]], most: int, log: str, setup: Callable[[], object] | None = None) -> DataFrame:
    """`fn` on every episode that the log doesn't settle, `most` attempts each over all runs; returns the states of all that it has.

    A job that a crash ends is started again with what is left, as long as its attempts get on. The log must be in a file system
    that shows what was flushed.
    """
    spark = frames.sparkSession
    ship(spark)
    spent = -1
    while True:
        events = read_log(spark, log)
        states = attempt_states(events, most)
        left = states.filter("status <> 'pending'").select(F.col("episode_index").alias(key))
        begun = events.filter("event = 'started'").groupBy(F.col("episode_index").alias(key)).agg(F.count("*").cast("int").alias("_started"))
        pending = frames.join(left, key, "left_anti").join(begun, key, "left").fillna({"_started": 0})
        if pending.isEmpty():
            break
        now = events.filter("event = 'started'").count()
        if now <= spent:
            raise RuntimeError("a run ended without an attempt")
        spent = now
        try:
            pending.groupBy(key).applyInPandas(_attempts(key, fn, setup, log, most), "attempts int").write.format("noop").mode("overwrite").save()
        except (PySparkException, Py4JJavaError) as failure:
            if read_log(spark, log).filter("event = 'started'").count() <= spent:
                raise RuntimeError("a run ended without an attempt") from failure
    return attempt_states(read_log(spark, log), most).select(*[c.split()[0] for c in RESULT.split(", ")], "crashes")
