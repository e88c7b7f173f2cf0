"""Joins of rows that may crowd on one key with a table of one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

SPREAD = "_spread"


def spread_join(rows: DataFrame, per_key: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join on ``key`` so that AQE can split the partition of a hot key.

    AQE splits a skewed partition only where both sides of the join come straight
    from a shuffle. An aggregate by the key is already partitioned by it and would
    be joined in place, leaving all rows of a hot key to one task. Joining on the
    key and its hash gives the aggregate a shuffle, of one small row per key.

    The result keeps the hash as ``SPREAD``: grouping by it along with the key
    finds the rows in place.
    """
    kind = rows.schema[key].dataType
    if kind != per_key.schema[key].dataType:
        raise TypeError(f"cast {key} to one type on both sides")
    # Minus zero equals zero, but has other bits; adding zero makes them one.
    floating = isinstance(kind, (FloatType, DoubleType))
    hashed = F.xxhash64(F.col(key) + F.lit(0.0).cast(kind) if floating else F.col(key))
    return rows.withColumn(SPREAD, hashed).join(per_key.withColumn(SPREAD, hashed), [key, SPREAD], how)
