"""Publishing staged outputs, and resilient user functions."""

from __future__ import annotations

import time
import traceback
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.sources.scratch import new_folder, ship
from framewright.sources.versions import VersionedTable, retried


def publish_conflicts(staged: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    return staged.join(target.select(*keys).distinct(), keys, "left_semi")


def publish_staged(staged: DataFrame, table: VersionedTable, keys: list[str], first: int = 20) -> DataFrame:
    """Adds staged rows to `table` only if it has none of their keys; returns the report: the first keys in conflict, and how many there are.

    The check is of the version that the new one follows: where another publisher comes between, rows are checked against its version again.
    """
    spark = staged.sparkSession
    folders: list = []

    def attempt() -> tuple[DataFrame, int]:
        base = table.current()
        kept = new_folder(spark)
        found = publish_conflicts(staged, table.read(base), keys) if base.folders else staged.limit(0)
        found.select(*keys).write.parquet(kept)
        conflicts = spark.read.schema(staged.select(*keys).schema).parquet(kept)
        number = conflicts.count()
        if not number:
            if not folders:
                folders.extend(table.stage(staged))
            table.commit(base, staged.schema, (*base.folders, *folders))
        return conflicts, number

    conflicts, number = retried(attempt)
    return conflicts.orderBy(*keys).limit(first).withColumn("conflicts", F.lit(number).cast("long"))


RESULT = "episode_index long, status string, attempt int, count long, value double, error_type string, error string, traceback string, wall_seconds double"
_STATES: dict[str, object] = {}


def worker_state(number: str, setup: Callable[[], object] | None) -> object:
    """What `setup` gave in this Python worker; it is called once for each number."""
    from framewright.operators.publish import _STATES  # the worker's own, not a copy for each task

    if setup is not None and number not in _STATES:
        _STATES[number] = setup()
    return _STATES.get(number)


def map_episodes_resilient(
    frames: DataFrame, key: str, fn: Callable[..., tuple[int, float]], attempts: int, setup: Callable[[], object] | None = None, continue_on_error: bool = True
) -> DataFrame:
    """`fn` on every episode, tried `attempts` times: a row with its result, attempt and time, or with the last error and its traceback.

    setup: called once in each Python worker; `fn` then gets its result and the episode. Unless `continue_on_error` is set, an episode
    that fails for good fails the job. A crash of the worker itself can't be caught here: `attempts.map_episodes_durably` counts those.
    """
    number = uuid.uuid4().hex
    columns = [c.split()[0] for c in RESULT.split(", ")]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        started, failure = time.monotonic(), None
        episode = int(pdf[key].iloc[0])
        for attempt in range(1, attempts + 1):
            try:
                state = worker_state(number, setup)
                count, value = fn(pdf) if setup is None else fn(state, pdf)
                row = (episode, "complete", attempt, int(count), float(value), None, None, None, time.monotonic() - started)
                return pd.DataFrame([row], columns=columns)
            except Exception as e:  # noqa: BLE001  the user's function may raise anything
                failure = (type(e).__name__, str(e), traceback.format_exc())
                if attempt == attempts and not continue_on_error:
                    raise
        return pd.DataFrame([(episode, "failed", attempts, None, None, *failure, time.monotonic() - started)], columns=columns)

    ship(frames.sparkSession)
    return frames.groupBy(key).applyInPandas(run, RESULT)


def map_batches_with_setup(rows: DataFrame, setup: Callable[[], object], fn: Callable[[object, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """`setup` once per task, then `fn` on Arrow batches of bounded size."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = setup()
        for pdf in batches:
            yield fn(state, pdf)

    return rows.mapInPandas(run, schema)
