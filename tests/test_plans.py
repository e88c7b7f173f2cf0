"""What the physical plans have to look like."""

import re

import pytest
from pyspark.sql import functions as F

from stratalake.catalog import JOBS, Shop
from stratalake.operators.keys import latest_per_key
from stratalake.operators.reviews import review_totals
from stratalake.plans import shop_queries
from stratalake.session import prepare

SF = "/root/testdata/sf0.001"
LAZY = sorted(set(JOBS) - {
    "orders_load_audit", "sellers_replaced", "orders_by_month", "flight_ingest",
    *[name for name in JOBS if name.endswith("_from_csv")], "flight_quarantine",
})


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def shop(spark):
    return Shop(prepare(spark), SF)


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_product(shop, name):
    text = plan(JOBS[name](shop))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert operator not in text
    # A window over everything would gather all rows in one task.
    for spec in re.findall(r"Window \[.*?\], \[(.*?)\]", text):
        assert spec


def test_columns_and_filters_reach_the_scan(shop):
    text = plan(JOBS["category_top_sold"](shop))
    reads = re.findall(r"ReadSchema: struct<(.*?)>", text)
    assert "l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double" in reads
    assert "l_comment" not in text
    assert "PushedFilters: [IsNotNull(n_nationkey)]" in plan(JOBS["silver_flights"](shop))


def test_top_k_and_rank_limit_before_the_shuffle(shop):
    assert "TakeOrderedAndProject" in plan(JOBS["category_top_revenue"](shop))
    ranked = plan(JOBS["seller_rank_in_state"](shop))
    assert "rank(revenue" in ranked and "Partial" in ranked and "WindowGroupLimit" in ranked
    latest = plan(latest_per_key(shop.x("customer_loads"), "customer_id", "load_seq"))
    assert "WindowGroupLimit" in latest and "Partial" in latest


def test_order_facts_shuffle_each_table_by_order_only(spark, shop):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(shop.gold_orders())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
    keys = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", text)
    columns = [[re.sub(r"#\d+L?", "", k) for k in key.split(", ")] for key in keys]
    assert all(c[0] == "order_id" for c in columns)
    assert "Expand" not in text
    # Nothing moves between the joins and the grouping over them.
    top = text[: text.index("SortMergeJoin")]
    assert "Exchange" not in top


def test_hot_key_is_split_by_the_join(spark):
    """A third of the items under one order: the join reads its partition in parts."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "30000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    prepare(spark)
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        order = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
        items = spark.range(0, 60000, 1, 8).select(
            order.alias("order_id"),
            F.pmod(F.xxhash64("id"), F.lit(5000)).cast("string").alias("product_id"),
            (F.col("id") % 7).cast("string").alias("seller_id"),
            F.lit(1.25).alias("price"),
        )
        reviews = spark.range(0, 60000, 7, 8).select(
            F.col("id").cast("string").alias("review_id"), order.alias("order_id"), F.lit(4).alias("review_score")
        )
        products = spark.range(5000).select(
            F.col("id").cast("string").alias("product_id"),
            (F.col("id") % 10).cast("string").alias("product_category_name"),
        )
        df = shop_queries.category_worst_reviewed(reviews, items, products)
        rows = df.collect()
        text = plan(df)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    hot_items, hot_reviews = 20000, len(range(0, 60000, 21))
    others = sum(1 for i in range(0, 60000, 7) if i % 3)
    assert sum(r["total_reviews"] for r in rows) == hot_items * hot_reviews + others
    assert "skew=true" in text, text
    assert review_totals(reviews).count() == others + 1
