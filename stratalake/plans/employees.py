"""Employees: clean, impute, classify, and the checks run on the result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions import (
    band,
    exact_avg,
    exact_median,
    na_to_null,
    round2,
    strip,
    to_boolean,
    to_date_ts,
    to_number,
)

DATE_FORMAT = "M/d/yyyy"
BANDS = ("Rendah", "Menengah", "Tinggi")  # fixed values
PREVIEW = ["first_name", "salary", "kategori_gaji", "start_date", "start_year"]


def known(df: DataFrame) -> DataFrame:
    """With missing-value texts read as missing."""
    return df.select(*[na_to_null(F.col(c)).alias(c) for c in df.columns])


def employees_clean(df: DataFrame) -> DataFrame:
    """Typed columns; a missing salary becomes the median, a missing bonus 0.

    The median is one number found beforehand, so the cleaning itself needs no
    shuffle.
    """
    texts = known(df)
    typed = texts.withColumns(
        {
            "start_date": to_date_ts(F.col("start_date"), DATE_FORMAT),
            "salary": to_number(F.col("salary")),
            "bonus_percent": F.coalesce(to_number(F.col("bonus_percent")), F.lit(0.0)),
            "gender": F.upper(strip(F.col("gender"))),
            "senior_management": to_boolean(F.col("senior_management")),
        }
    )
    median = exact_median(typed, "salary")
    filled = typed.withColumns(
        {
            "salary": F.coalesce("salary", F.lit(median).cast("double")),
            "start_year": F.year("start_date"),
        }
    )
    return filled.withColumn("kategori_gaji", band(F.col("salary"), 50000, 100000, BANDS))


def _headcount(employees: DataFrame, key: str) -> DataFrame:
    return employees.groupBy(key).agg(
        F.count("*").alias("jumlah_employee"),
        round2(exact_avg(F.col("salary"))).alias("rata_rata_gaji"),
    )


def salary_band_summary(employees: DataFrame) -> DataFrame:
    return _headcount(employees, "kategori_gaji").orderBy(F.desc("rata_rata_gaji"), "kategori_gaji")


def team_summary(employees: DataFrame) -> DataFrame:
    return _headcount(employees, "team").orderBy(F.desc("jumlah_employee"), "team")


def employees_preview(employees: DataFrame, rows: int = 10) -> DataFrame:
    return employees.select(*PREVIEW).orderBy("first_name", "salary", "start_date").limit(rows)


def employees_count(employees: DataFrame) -> DataFrame:
    return employees.agg(F.count("*").alias("total_data"))
