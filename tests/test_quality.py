import datetime

import pytest
from pyspark.sql import functions as F

from stratalake.operators import quality
from stratalake.operators.keys import stack_rows

ts = datetime.datetime


@pytest.fixture(scope="module")
def ids(spark):
    return spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "id bigint")


def test_not_null(ids):
    assert quality.not_null(ids, "id").count() == 2
    assert quality.not_null(ids.dropna(), "id").isEmpty()


def test_unique_ignores_null(ids):
    assert [tuple(r) for r in quality.unique(ids, "id").collect()] == [(1, 2)]
    assert quality.unique(ids.dropDuplicates(), "id").isEmpty()


def test_starter_model_fails_not_null(spark):
    rows = stack_rows(spark.createDataFrame([(1,)], "id int"), spark.createDataFrame([(None,)], "id int"))
    assert quality.not_null(rows, "id").count() == 1
    assert quality.unique(rows, "id").isEmpty()
    assert quality.not_null(rows.where("id = 1"), "id").isEmpty()


def test_accepted_values(ids):
    assert [tuple(r) for r in quality.accepted_values(ids, "id", [2]).collect()] == [(1, 2)]
    assert quality.accepted_values(ids, "id", [1, 2]).isEmpty()


def test_relationships(spark, ids):
    parent = spark.createDataFrame([(2,), (2,), (3,), (None,)], "key bigint")
    failing = quality.relationships(ids, "id", parent, "key")
    assert [tuple(r) for r in failing.collect()] == [(1,), (1,)]
    assert quality.relationships(ids.where("id = 2"), "id", parent, "key").isEmpty()


def test_rows_where(ids):
    assert quality.rows_where(ids, F.col("id") > 1, "id").count() == 1


@pytest.mark.parametrize("hours, status", [(23, "pass"), (24, "pass"), (25, "warn"), (49, "error")])
def test_freshness(spark, hours, status):
    df = spark.createDataFrame([(ts(2020, 1, 1),), (ts(2019, 1, 1),)], "at timestamp_ntz")
    now = F.lit(ts(2020, 1, 1) + datetime.timedelta(hours=hours))
    row = quality.freshness(df, "at", now).first()
    assert (row["age_hours"], row["status"]) == (float(hours), status)


def test_freshness_of_an_empty_table(spark):
    df = spark.createDataFrame([], "at timestamp_ntz")
    assert quality.freshness(df, "at", F.lit(ts(2020, 1, 1))).first()["status"] == "error"


def test_profile(spark):
    df = spark.createDataFrame([("a", None), (None, None), ("b", 1.0)], "x string, y double")
    rows = [r.asDict() for r in quality.profile(df).orderBy("position").collect()]
    assert [(r["column_name"], r["data_type"], r["null_count"]) for r in rows] == [
        ("x", "string", 1), ("y", "double", 2),
    ]
    assert all(r["row_count"] == 3 and r["column_count"] == 2 for r in rows)
