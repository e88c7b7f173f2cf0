"""Findings of the last review: lost rows, wrong numbers, swapped columns."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stratalake.functions.columns import exact_sum, money
from stratalake.plans import flights
from stratalake.sources import adapters, files, tables

SF = "/root/testdata/sf0.001"


def test_views_keep_all_rows(spark):
    orders = adapters.view(spark, SF, "orders").count()
    for name in ("x_orders", "x_reviews"):
        assert adapters.view(spark, SF, name).count() == orders
    assert adapters.view(spark, SF, "x_orders").where("customer_id like 'none-%'").count() > 0
    assert adapters.view(spark, SF, "x_reviews").where("order_id like 'none-%'").count() > 0
    assert adapters.view(spark, SF, "x_category").where("product_category_name_english is null").count() == 1


def test_money_beyond_range_is_an_error(spark):
    for bad in (float("nan"), 1e16):
        rows = spark.createDataFrame([(1.0,), (bad,)], "v double")
        with pytest.raises(PySparkException, match="NaN or too large"):
            rows.agg(exact_sum(F.col("v"))).collect()
    rows = spark.createDataFrame([(1.5,), (None,)], "v double")
    assert rows.agg(money(exact_sum(F.col("v")))).first()[0] == 1.5


def test_nan_is_a_reading(spark):
    values = ", ".join(f"double('NaN') AS {name}" for name in flights.REQUIRED)
    assert flights.silver_flights(spark.sql(f"SELECT {values}")).count() == 1


def test_swapped_columns_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,city\n1,oslo\n2,rome\n")
    (tmp_path / "b.csv").write_text("city,id\nbern,3\n")
    with pytest.raises(Exception, match="does not conform to the schema"):
        files.read_csv(spark, str(tmp_path)).collect()


def test_stopped_swap_keeps_old_rows(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS mended LOCATION 'file:{tmp_path}/db'")
    try:
        old = spark.createDataFrame([("1", "a"), ("2", "b")], "k string, v string")
        tables.replace_table(spark, old, "mended.t")
        spark.sql("ALTER TABLE mended.t RENAME TO mended.t__backup")  # stopped here
        tables.upsert_table(spark, spark.createDataFrame([("2", "c")], "k string, v string"), "mended.t", "k")
        assert sorted(map(tuple, spark.table("mended.t").collect())) == [("1", "a"), ("2", "c")]
    finally:
        spark.sql("DROP DATABASE IF EXISTS mended CASCADE")
