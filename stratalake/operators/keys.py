"""Operators over tables identified by a key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str, loaded: str) -> DataFrame:
    """The last loaded row of each key.

    ``row_number() = 1`` plans as a group limit before the shuffle, so a key
    with many loads sends one row per input partition. The other columns break
    ties, which keeps the answer the same from run to run.
    """
    rest = [c for c in df.columns if c not in (key, loaded)]
    order = W.partitionBy(key).orderBy(F.desc(loaded), *rest)
    return df.withColumn("_nth", F.row_number().over(order)).where("_nth = 1").drop("_nth")


def replace_by_key(
    old: DataFrame, new: DataFrame, key: str, purge_missing: bool = False
) -> DataFrame:
    """Old rows whose key is not in ``new``, plus all of ``new``.

    A key that dropped out of ``new`` keeps its old row unless ``purge_missing``.
    The distinct combines map-side and leaves the keys partitioned as the anti
    join needs them.
    """
    if purge_missing:
        return new
    kept = old.join(new.select(key).distinct(), key, "left_anti")
    return kept.unionByName(new)


def newer_than(new: DataFrame, target: DataFrame, column: str, in_target: str | None = None) -> DataFrame:
    """Rows newer than anything in the target; all rows while the target is empty. The column
    may have another name there."""
    newest = target.agg(F.max(in_target or column)).scalar()
    return new.where(newest.isNull() | (F.col(column) > newest))


def stack_rows(first: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION ALL by column name."""
    for other in others:
        first = first.unionByName(other)
    return first
