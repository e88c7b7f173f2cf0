"""Grouped aggregates with several distinct counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def totals_and_distincts(df: DataFrame, key: str, totals: list[Column], **distinct: str) -> DataFrame:
    """Totals and distinct counts per key, each from its own columns.

    In one aggregate, Catalyst would send every row once per distinct count
    through the shuffle, with all sums beside it. Here totals combine map-side,
    and each distinct count shuffles two columns by key and value, which spreads
    a hot key over all tasks. The parts end up partitioned by key, so joining
    them moves nothing. Rows without a key are left out.
    """
    parts = [df.groupBy(key).agg(*totals)]
    for name, column in distinct.items():
        parts.append(df.groupBy(key).agg(F.count_distinct(column).alias(name)))
    return reduce(lambda left, right: left.join(right, key), parts)


def totals_and_distincts_of(
    keys: DataFrame, df: DataFrame, key: str, totals: list[Column], **distinct: str
) -> DataFrame:
    """The same for the keys asked for, with one shuffle of the rows for keys of few rows each.

    Rows meet their keys in a semi join, which moves each row once, if it does not lie in buckets;
    what follows finds them in place: the first row of each value is marked, and one
    aggregate counts the marks. AQE splits a key that is hot after all in the semi join, and
    the marks then spread it by key and value. Broadcast keys would leave the rows where they
    are, and each kind of mark would move them.
    """
    rows = df.join(keys.select(key).hint("merge"), key, "left_semi")
    marks = {}
    for name, column in distinct.items():
        nth = F.row_number().over(W.partitionBy(key, column).orderBy(column))
        marks[name] = F.count_if((F.col(f"_{name}") == 1) & F.col(column).isNotNull())
        rows = rows.withColumn(f"_{name}", nth)
    return rows.groupBy(key).agg(*totals, *[mark.alias(name) for name, mark in marks.items()])
