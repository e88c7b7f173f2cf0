"""Rank of every row within its group, for groups too large for one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratalake.session import run_dir


def _kept(df: DataFrame, folder: str) -> DataFrame:
    """The rows, written once and read from there."""
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def rank_in_group(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """``rank() OVER (PARTITION BY group ORDER BY value DESC NULLS LAST)``, spread over tasks.

    A window by group sorts a whole group in one task. Here equal values are counted first, which
    combines before the shuffle however many rows share one. The counts are dealt out by ranges of
    group and value, so a large group spreads over many tasks by its values, and written with
    the number of their range. A value's rank is what earlier ranges hold of its group, carried
    over, and what its own range holds before it: windows over at most one row a range and
    group, and over the rows of one range. The ranks are joined to the rows, a hot value's
    rows being split.

    ``df`` is read once, into the shared folder; so are the counts. The result reads these tables,
    which stay for the caller to remove. NULL is a group like any other, and ranks behind all
    values; NaN ranks before all numbers.
    """
    folder = run_dir(df.sparkSession, "rank")
    rows = _kept(df, f"{folder}/rows")
    by_value = F.desc_nulls_last(value)
    counted = rows.groupBy(group, value).agg(F.count("*").alias("_n"))
    dealt = counted.repartitionByRange(F.col(group), by_value).withColumn("_range", F.spark_partition_id())
    ranges = _kept(dealt, f"{folder}/ranges")

    earlier = W.partitionBy(group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        ranges.groupBy(group, "_range")
        .agg(F.sum("_n").alias("_held"))
        .select(group, "_range", F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_before"))
    )
    first = W.partitionBy("_range", group).orderBy(by_value).rowsBetween(W.unboundedPreceding, -1)
    within = ranges.withColumn("_within", F.coalesce(F.sum("_n").over(first), F.lit(0)))
    placed = _join(within, offsets, [group, "_range"])
    rank = F.col("_before") + F.col("_within") + 1
    ranks = _kept(placed.select(group, value, rank.alias(name)), f"{folder}/ranks")
    return _join(rows, ranks, [group, value])


def _join(left: DataFrame, right: DataFrame, names: list[str]) -> DataFrame:
    """Inner join on the names, NULL being equal to NULL."""
    other = right.select(*[F.col(n).alias(f"_r_{n}") if n in names else F.col(n) for n in right.columns])
    on = reduce(lambda a, b: a & b, [left[n].eqNullSafe(other[f"_r_{n}"]) for n in names])
    return left.join(other, on).drop(*[f"_r_{n}" for n in names])
