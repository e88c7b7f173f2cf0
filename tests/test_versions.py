"""Tables in versions: stops at every step, readers in between, months that stay."""

import datetime
import os
import uuid

import pytest
from pyspark.sql import functions as F

from stratalake import catalog
from stratalake.sources import folders, schemas, tables

ts = datetime.datetime


@pytest.fixture
def database(spark, tmp_path):
    name = f"v_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


class Stopped(Exception):
    pass


def stop_after(monkeypatch, spark, count):
    """Let ``count`` statements through that change the catalog, then stop."""
    run, left = type(spark).sql, [count]

    def sql(self, text, *args, **kwargs):
        if text.startswith(("ALTER", "DROP TABLE", "CREATE TABLE")):
            if not left[0]:
                raise Stopped(text)
            left[0] -= 1
        return run(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", sql)


def test_swap_stopped_anywhere(spark, database, monkeypatch):
    table = f"{database}.t"
    old, new = spark.createDataFrame([(1, "a")], "k int, v string"), spark.createDataFrame([(2, "b")], "k int, v string")
    tables.replace_table(spark, old, table)
    for count in range(6):
        with monkeypatch.context() as patch:
            stop_after(patch, spark, count)
            try:
                tables.replace_table(spark, new, table)
                stopped = False
            except Stopped:
                stopped = True
        assert values(spark.table(table)) in ([(1, "a")], [(2, "b")])  # never neither
        tables.replace_table(spark, old, table)
        assert values(spark.table(table)) == [(1, "a")]
        if not stopped:
            break
    assert count > 1 and not stopped
    versions = folders.children(spark, tables.files_folder(spark, table))
    assert len(versions) == 2  # this one and the one before
    shown = spark.sql(f"SHOW TABLES IN {database}").where("NOT isTemporary").collect()
    assert [r["tableName"] for r in shown] == ["t"]


def test_write_stopped_half_way(spark, database, tmp_path):
    table = f"{database}.t"
    tables.replace_table(spark, spark.range(3), table)
    fails = spark.range(5).select(F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("stop"))).alias("id"))
    with pytest.raises(Exception, match="stop"):
        tables.replace_table(spark, fails, table)
    os.makedirs(f"{tmp_path}/t__files/left-over/_temporary")
    assert spark.table(table).count() == 3
    tables.replace_table(spark, spark.range(7), table)
    assert spark.table(table).count() == 7
    assert "left-over" not in folders.children(spark, f"{tmp_path}/t__files")


def test_a_reader_that_has_begun_ends_on_the_old_rows(spark, database):
    table = f"{database}.t"
    tables.replace_table(spark, spark.range(3), table)
    begun = spark.table(table)
    plan = begun.select("id")
    plan._jdf.queryExecution().executedPlan()
    tables.replace_table(spark, spark.range(9), table)
    assert plan.count() == 3 and spark.table(table).count() == 9


def test_new_columns(spark, database, monkeypatch):
    """A change of columns takes two steps; the next run ends what was stopped between them."""
    table = f"{database}.t"
    tables.replace_table(spark, spark.range(3), table)
    wide = spark.range(4).withColumn("v", F.lit("x"))
    for count in range(6):
        with monkeypatch.context() as patch:
            stop_after(patch, spark, count)
            try:
                tables.replace_table(spark, wide, table)
            except Stopped:
                pass
        tables.restore_table(spark, table)
        assert spark.table(table).count() in (3, 4)
    assert spark.table(table).columns == ["id", "v"]


def test_counts_come_from_the_write(spark, database):
    spec = schemas.DIM_SELLERS
    table = f"{database}.{spec.name}"
    rows = spark.range(40).selectExpr(
        "CAST(id % 7 AS STRING) AS seller_id", "id AS seller_zip_code_prefix", "'c' AS seller_city", "'s' AS seller_state"
    )
    tables.create_table(spark, table, spec)
    assert tables.append_rows(spark, rows, table, spec) == 40
    assert tuple(tables.append_audited(spark, rows, table, spec).first()) == (40, 80)
    assert tables.replace_table(spark, rows.limit(0), table, spec.sort_by) == 0


FACTS = "id string, v int, at timestamp_ntz"


def test_upsert_leaves_other_months_alone(spark, database):
    table = f"{database}.facts"
    rows = [(f"{m}-{i}", i, ts(2024, m, 1 + i)) for m in range(1, 5) for i in range(3)] + [("none", 0, None)]
    assert len(tables.upsert_months(spark, spark.createDataFrame(rows, FACTS), table, "id", "at")) == 5

    def files():
        found = spark.table(table).select("ym", F.col("_metadata.file_path").alias("f")).distinct().collect()
        return {m: {r["f"] for r in found if r["ym"] == m} for m in {r["ym"] for r in found}}

    before = files()
    # One row changes, one moves from March to April, one is new in a month of its own.
    change = [("1-0", 9, ts(2024, 1, 5)), ("3-1", 8, ts(2024, 4, 9)), ("new", 7, ts(2025, 1, 1))]
    for _ in range(2):
        touched = tables.upsert_months(spark, spark.createDataFrame(change, FACTS), table, "id", "at")
        assert set(touched) <= {"202401", "202403", "202404", "202501"}
        want = {r[0]: r for r in rows} | {r[0]: r for r in change}
        assert values(spark.table(table).drop("ym")) == sorted(want.values(), key=str)
        after = files()
        assert after["202402"] == before["202402"] and after["none"] == before["none"]
        assert not after["202401"] & before["202401"]
    assert tables.upsert_months(spark, spark.createDataFrame([], FACTS), table, "id", "at") == []
    # Only folders in use are left, and those of the last run's month before.
    tables.clean_table(spark, table)
    assert values(spark.table(table).drop("ym")) == sorted(want.values(), key=str)


def test_upsert_computes_new_rows_once(spark, database):
    seen = spark.sparkContext.accumulator(0)

    def count(v):
        seen.add(1)
        return v

    table, counted = f"{database}.facts", F.udf(count, "int")
    rows = spark.createDataFrame([(str(i), i, ts(2024, 1 + i % 3, 1)) for i in range(10)], FACTS)
    for n in (1, 2):
        tables.upsert_months(spark, rows.withColumn("v", counted("v")), table, "id", "at")
        assert seen.value == 10 * n
    assert spark.table(table).count() == 10


def test_upsert_empties_a_month(spark, database):
    table = f"{database}.facts"
    tables.upsert_months(spark, spark.createDataFrame([("a", 1, ts(2024, 1, 1))], FACTS), table, "id", "at")
    tables.upsert_months(spark, spark.createDataFrame([("a", 2, ts(2024, 2, 1))], FACTS), table, "id", "at")
    assert values(spark.table(table)) == [("a", 2, ts(2024, 2, 1), "202402")]
    assert values(spark.sql(f"SHOW PARTITIONS {table}")) == [("ym=202402",)]


def test_upsert_stopped_between_months(spark, database, monkeypatch):
    table = f"{database}.facts"
    rows = [(str(i), i, ts(2024, 1 + i % 4, 1)) for i in range(12)]
    change = [(str(i), 100 + i, ts(2024, 1 + (i + 1) % 4, 2)) for i in range(0, 12, 2)]
    want = sorted(({r[0]: r for r in rows} | {r[0]: r for r in change}).values(), key=str)
    for count in range(1, 8):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        tables.upsert_months(spark, spark.createDataFrame(rows, FACTS), table, "id", "at")
        with monkeypatch.context() as patch:
            stop_after(patch, spark, count)
            try:
                tables.upsert_months(spark, spark.createDataFrame(change, FACTS), table, "id", "at")
                stopped = False
            except Stopped:
                stopped = True
        tables.upsert_months(spark, spark.createDataFrame(change, FACTS), table, "id", "at")
        assert values(spark.table(table).drop("ym")) == want
        if not stopped:
            break
    assert not stopped


def test_buckets_grow_with_the_largest_table(spark, monkeypatch):
    assert tables.bucket_number() == tables.bucket_number(spark.range(0), spark.range(100)) == tables.FEWEST_BUCKETS
    monkeypatch.setattr(tables, "ROWS_PER_BUCKET", 10)
    assert tables.bucket_number(spark.range(100), spark.range(201)) == 21


def test_silver_facts_are_dealt_by_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "ROWS_PER_BUCKET", 100)
    spark.range(900).selectExpr(
        "id DIV 3 AS l_orderkey", "id AS l_partkey", "id % 7 AS l_suppkey", "CAST(id % 3 AS INT) AS l_linenumber",
        "1.0D AS l_quantity", "2.0D AS l_extendedprice", "0.0D AS l_discount", "0.0D AS l_tax", "'N' AS l_returnflag",
        "TIMESTAMP_NTZ '2000-01-01 00:00:00' AS l_shipdate",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    silver = catalog.SilverTables(catalog.Shop(spark, str(tmp_path)), "items")
    assert silver.table("items").count() == 900
    known = spark.sql(f"DESCRIBE TABLE EXTENDED {silver.database}.items")
    assert known.where("col_name = 'Num Buckets'").first()["data_type"] == "9"
    spark.sql(f"DROP DATABASE {silver.database} CASCADE")


def test_buckets_join_without_exchange(spark, database):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("a", "b"):
            rows = spark.range(100).selectExpr("CAST(id % 50 AS STRING) AS k", f"id AS {name}")
            tables.replace_table(spark, rows, f"{database}.{name}", ("k",), buckets=("k", 4))
            tables.replace_table(spark, rows, f"{database}.{name}", ("k",), buckets=("k", 4))
        a, b = spark.table(f"{database}.a"), spark.table(f"{database}.b")
        joined = a.join(b.groupBy("k").agg(F.count_distinct("b").alias("n")), "k")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
