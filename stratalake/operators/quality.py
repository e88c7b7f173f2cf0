"""Data-quality checks. Each returns the failing rows: none means passed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions import seconds_between
from stratalake.operators.joins import SPREAD, spread_join


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where one of the columns is NULL."""
    missing = F.lit(False)
    for column in columns:
        missing = missing | F.col(column).isNull()
    return df.where(missing)


def unique(df: DataFrame, column: str) -> DataFrame:
    counts = df.where(F.col(column).isNotNull()).groupBy(column)
    return counts.agg(F.count("*").alias("n_records")).where("n_records > 1")


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Values outside the list with their row counts; NULL passes."""
    failing = df.where(~F.col(column).isin(*values))
    return failing.groupBy(column).agg(F.count("*").alias("n_records"))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose key, where there is one, is missing in the parent."""
    key = F.col(parent_column).cast(child.schema[column].dataType)
    keys = parent.select(key.alias(column)).distinct()
    return spread_join(child.where(F.col(column).isNotNull()), keys, column, "left_anti").drop(SPREAD)


def rows_where(df: DataFrame, failing: Column, *columns: str) -> DataFrame:
    """A test of one's own: the rows for which the failing condition holds."""
    return df.where(failing).select(*columns)


def freshness(
    df: DataFrame, column: str, now: Column, warn_hours: int = 24, error_hours: int = 48
) -> DataFrame:
    """One row: newest value, age in hours at ``now``, and the status.

    A table without any value is in error.
    """
    newest = df.agg(F.max(column).cast("timestamp_ntz").alias("newest"))
    seconds = seconds_between(F.col("newest"), F.col("checked_at"))
    aged = newest.withColumn("checked_at", now.cast("timestamp_ntz")).withColumn(
        "age_hours", seconds / 3600.0
    )
    status = (
        F.when(F.col("age_hours") <= warn_hours, "pass")
        .when(F.col("age_hours") <= error_hours, "warn")
        .otherwise("error")
    )
    return aged.withColumn("status", status)


def profile(df: DataFrame) -> DataFrame:
    """One row per column: position, declared type, NULLs, rows. One pass."""
    names = df.columns
    counted = df.agg(
        F.count("*").alias("row_count"),
        *[F.count_if(F.col(n).isNull()).alias(f"nulls_{i}") for i, n in enumerate(names)],
    )
    per_column = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(n).alias("column_name"),
                F.lit(t).alias("data_type"),
                F.col(f"nulls_{i}").alias("null_count"),
            )
            for i, (n, t) in enumerate(df.dtypes)
        ]
    )
    return counted.select("row_count", F.inline(per_column)).withColumn(
        "column_count", F.lit(len(names))
    )
