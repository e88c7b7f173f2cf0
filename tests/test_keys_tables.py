import datetime
import uuid

import pytest
from pyspark.sql import functions as F

from stratalake.operators.keys import latest_per_key, newer_than, replace_by_key, stack_rows
from stratalake.sources import schemas, tables

ts = datetime.datetime


def frame(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def database(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_latest_per_key(spark):
    df = frame(spark, [("a", "x", 1), ("a", "y", 3), ("a", "z", 2), ("b", "q", 1), ("b", "p", 1)],
               "k string, city string, seq int")
    assert values(latest_per_key(df, "k", "seq")) == [("a", "y", 3), ("b", "p", 1)]


def test_replace_by_key_keeps_what_left_the_new_set(spark):
    old = frame(spark, [("1", "shipped"), ("2", "shipped")], "id string, status string")
    new = frame(spark, [("delivered", "2"), ("shipped", "3"), ("again", "3")], "status string, id string")
    # Order 1 was canceled since, so it is not in the new set: its old row stays.
    assert values(replace_by_key(old, new, "id")) == [
        ("1", "shipped"), ("2", "delivered"), ("3", "again"), ("3", "shipped"),
    ]
    assert values(replace_by_key(old, new, "id", purge_missing=True).select("id", "status")) == [
        ("2", "delivered"), ("3", "again"), ("3", "shipped"),
    ]


def test_newer_than(spark):
    new = frame(spark, [(1, ts(2020, 1, 1)), (2, ts(2020, 1, 2)), (3, None)], "id int, at timestamp_ntz")
    target = frame(spark, [(ts(2020, 1, 1),), (None,)], "at timestamp_ntz")
    assert values(newer_than(new, target, "at").select("id")) == [(2,)]
    assert newer_than(new, target.limit(0), "at").count() == 3


def test_starter_rows(spark):
    one, none = frame(spark, [(1,)], "id bigint"), frame(spark, [(None,)], "id bigint")
    stacked = stack_rows(one, none)
    assert values(stacked) == [(1,), (None,)]
    assert values(stacked.where("id = 1")) == [(1,)]


def test_replace_table_may_read_itself(spark, database):
    table = f"{database}.numbers"
    tables.replace_table(spark, spark.range(5).toDF("id"), table)
    for _ in range(2):
        doubled = spark.table(table).select((F.col("id") * 2).alias("id"))
        tables.replace_table(spark, doubled, table)
    assert values(spark.table(table)) == [(0,), (12,), (16,), (4,), (8,)]
    shown = spark.sql(f"SHOW TABLES IN {database}").where("NOT isTemporary").collect()
    names = [r["tableName"] for r in shown]
    assert names == ["numbers"]


def test_upsert_table(spark, database):
    table = f"{database}.fct"
    first = frame(spark, [("1", "a"), ("2", "b")], "id string, v string")
    tables.upsert_table(spark, first, table, "id")
    second = frame(spark, [("2", "c"), ("3", "d")], "id string, v string")
    for _ in range(2):  # a repeated run changes nothing
        tables.upsert_table(spark, second, table, "id")
        assert values(spark.table(table)) == [("1", "a"), ("2", "c"), ("3", "d")]
    tables.upsert_table(spark, second, table, "id", purge_missing=True)
    assert values(spark.table(table)) == [("2", "c"), ("3", "d")]


@pytest.mark.parametrize("name", sorted(schemas.TABLES))
def test_create_table_has_the_declared_columns(spark, database, name):
    spec = schemas.TABLES[name]
    table = tables.layer_table(name, database)
    for _ in range(2):
        tables.create_table(spark, table, spec)
    extra = [tables.MONTH] if spec.month_of else []
    assert spark.table(table).columns == spec.columns + extra


def test_append_and_audit(spark, database):
    spec = schemas.DIM_SELLERS
    table = tables.layer_table(spec.name, database)
    tables.create_table(spark, table, spec)
    rows = frame(spark, [("S", "c", 1, "a"), ("T", "d", 2, "b")],
                 "seller_state string, seller_city string, seller_zip_code_prefix int, seller_id string")
    tables.append_rows(spark, rows, table, spec)
    assert values(spark.table(table)) == [("a", 1, "c", "S"), ("b", 2, "d", "T")]
    assert tuple(tables.load_audit(rows, spark.table(table)).first()) == (2, 2)
    tables.append_rows(spark, rows, table, spec)
    assert tuple(tables.load_audit(rows, spark.table(table)).first()) == (2, 4)


def test_month_partitions(spark, database, tmp_path):
    spec = schemas.RAW_FLIGHTS
    table = tables.layer_table(spec.name, database)
    tables.create_table(spark, table, spec)
    at = [ts(2026, 8, 31, 23), ts(2026, 9, 1), ts(2026, 9, 2)]
    rows = spark.createDataFrame([(t, f"i{i}") for i, t in enumerate(at)], "event_time timestamp_ntz, icao24 string")
    for c in spec.columns[2:]:
        rows = rows.withColumn(c, F.lit(None))
    tables.append_rows(spark, rows, table, spec)
    assert sorted(p.name for p in (tmp_path / spec.name).iterdir() if p.is_dir()) == ["ym=202608", "ym=202609"]
    september = spark.table(table).where("ym = '202609'")
    assert september.count() == 2
    assert "PartitionFilters: [isnotnull(ym" in september._jdf.queryExecution().toString()


def test_layers_and_sources(spark, database):
    assert tables.layer_table("m", "gold") == "gold.m"
    assert tables.layer_table("m") == "default.m"
    tables.replace_table(spark, spark.range(1).toDF("order_id"), f"{database}.fact_reviews")
    assert tables.shop_source(spark, "fact_order_review", database).count() == 1


def test_view(spark):
    tables.as_view(spark.range(3).toDF("id"), "three_rows")
    assert spark.table("three_rows").count() == 3


def test_clustered_files_cover_narrow_ranges(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(8)
    tables.clustered(df, "k").write.parquet(str(tmp_path / "t"))
    files = spark.read.parquet(str(tmp_path / "t")).groupBy(F.input_file_name()).agg(
        F.min("k").alias("lo"), F.max("k").alias("hi")
    ).orderBy("lo").collect()
    assert all(a["hi"] < b["lo"] for a, b in zip(files, files[1:]))
