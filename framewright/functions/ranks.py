"""Ranks and prefix sums over a global order without a window over all rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewright.sources.scratch import new_folder

PIECE = 100_000


def ranked(df: DataFrame, keys: list[str], order: str, name: str) -> DataFrame:
    """0-based rank by an integer column within the groups of `keys`.

    A group is cut into ranges of the order column, so that a group with a third of
    all rows isn't one window partition: ranks within a piece, plus the sizes of the pieces before.
    """
    pieces = df.withColumn("_piece", F.expr(f"{order} DIV {PIECE}"))
    sizes = pieces.groupBy(*keys, "_piece").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = F.row_number().over(Window.partitionBy(*keys, "_piece").orderBy(order)) - 1
    return pieces.withColumn("_in", inside).join(starts, [*keys, "_piece"]).withColumn(name, F.col("_start") + F.col("_in")).drop("_piece", "_start", "_in")


def exclusive_sums(groups: DataFrame, key: str, value: str, name: str, width: int) -> DataFrame:
    """Exclusive prefix sum of `value` by the integer `key`, in two levels: blocks of `width` keys, then keys within a block.

    Only the blocks (one row for `width` keys) meet in one window.
    """
    cut = groups.withColumn("_block", F.expr(f"{key} DIV {width}"))
    blocks = cut.groupBy("_block").agg(F.sum(value).alias("_total"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("_block", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_block").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(value).over(within), F.lit(0))
    return cut.withColumn("_in", inside).join(starts, "_block").withColumn(name, F.col("_start") + F.col("_in")).drop("_block", "_start", "_in")


def grouped_rank(df: DataFrame, groups: list[str], order: str, name: str) -> DataFrame:
    """0-based rank in the order (groups, order): rows of the groups before, plus the rank inside the group.

    Groups are as many as a fraction of the rows: they are dealt by ranges, summed inside each range, and only the
    ranges (one row each) meet in one window. The ranges are written, so that all uses see the same ones. Null keys come first.
    """
    spark = df.sparkSession
    sizes = df.groupBy(*groups).agg(F.count("*").alias("_n"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = new_folder(spark)
    sizes.repartitionByRange(n, *groups).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    dealt = spark.read.parquet(path)
    totals = dealt.groupBy("_range").agg(F.sum("_n").alias("_total"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("_range", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("_range").orderBy(*groups).rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.withColumn("_in_range", F.coalesce(F.sum("_n").over(within), F.lit(0))).join(bases, "_range")
    starts = starts.select(*groups, (F.col("_base") + F.col("_in_range")).alias("_start"))
    inside = F.row_number().over(Window.partitionBy(*groups).orderBy(order)) - 1
    numbered = df.withColumn("_in", inside)
    starts = starts.select(*[F.col(g).alias(f"_of_{g}") for g in groups], "_start")
    same = reduce(and_, [F.col(g).eqNullSafe(F.col(f"_of_{g}")) for g in groups])  # a null key is a group
    return numbered.join(starts, same).withColumn(name, F.col("_start") + F.col("_in")).drop("_start", "_in", *[f"_of_{g}" for g in groups])
