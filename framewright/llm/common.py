"""Helpers shared by the operators: shared scratch folder, code shipping, sizes."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager, suppress
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.sources.scratch import filesystem, ship
from framewright.sources.scratch import new_folder as shared_dir

__all__ = ["checkpoint", "filesystem", "keep", "shared_dir", "ship", "shuffle_partitions", "table", "temporary_tables", "utf8_bytes"]

_TABLES: ContextVar[set[str] | None] = ContextVar("tables", default=None)


def checkpoint(df: DataFrame) -> DataFrame:
    """Write `df` as Parquet to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._checkpoint_path = path
    if (tables := _TABLES.get()) is not None:
        tables.add(path)
    return out


@contextmanager
def temporary_tables() -> Iterator[None]:
    """Tables that are checkpointed inside are removed at the end, but for those that `keep` names: what is built
    from them must be written by then."""
    tables: set[str] = set()
    token = _TABLES.set(tables)
    try:
        yield
    finally:
        _TABLES.reset(token)
        for path in tables:
            fs, name = filesystem(path)
            with suppress(FileNotFoundError):  # a write that failed left none; its error goes on
                fs.delete_dir(name)


def keep(df: DataFrame) -> DataFrame:
    """A checkpointed table that outlives `temporary_tables`."""
    (_TABLES.get() or set()).discard(df._checkpoint_path)
    return df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8_bytes(column) -> "F.Column":
    return F.octet_length(F.coalesce(column, F.lit("")))
