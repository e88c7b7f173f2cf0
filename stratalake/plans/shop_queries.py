"""Analytic queries over the typed shop tables.

Facts are summed per join key first and meet their dimension as one row per key:
the first aggregation combines map-side, so hot keys cost nothing extra, and
dimensions of any size join without being broadcast. Ties in a top-k are broken
by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratalake.functions import exact_sum, money, round2, sum_units, units
from stratalake.operators.grouping import totals_and_distincts
from stratalake.operators.joins import SPREAD, spread_join
from stratalake.operators.reviews import review_totals

TOP = 10
LATE, ON_TIME = "Terlambat", "Tepat Waktu"  # fixed values
CATEGORY = "product_category_name"


def _share(part: str, df: DataFrame):
    """Percent of the whole column.

    The total is a one-row aggregate over the same groups, so no window has to
    pull all groups into one task.
    """
    total = df.agg(F.sum(part).cast("double")).scalar()
    return round2(F.col(part).cast("double") * 100.0 / total)


def _sold_by_category(items: DataFrame, products: DataFrame) -> DataFrame:
    price = F.col("price")
    sold = items.groupBy("product_id").agg(
        F.count("*").alias("items"), F.count(price).alias("priced"), exact_sum(price).alias("revenue")
    )
    return (
        sold.join(products.select("product_id", CATEGORY), "product_id")
        .groupBy(CATEGORY)
        .agg(*[F.sum(c).alias(c) for c in ("items", "priced", "revenue")])
    )


def category_top_sold(items: DataFrame, products: DataFrame) -> DataFrame:
    return (
        _sold_by_category(items, products)
        .select(
            CATEGORY,
            F.col("items").alias("total_items_sold"),
            money(F.col("revenue")).alias("total_revenue"),
        )
        .orderBy(F.desc("total_items_sold"), CATEGORY)
        .limit(TOP)
    )


def category_top_revenue(items: DataFrame, products: DataFrame) -> DataFrame:
    revenue = money(F.col("revenue"))
    return (
        _sold_by_category(items, products)
        .select(
            CATEGORY,
            F.col("items").alias("total_items_sold"),
            revenue.alias("total_revenue"),
            round2(F.try_divide(revenue, F.col("priced"))).alias("avg_price_per_item"),
        )
        .orderBy(F.desc("total_revenue"), CATEGORY)
        .limit(TOP)
    )


def category_revenue_share(items: DataFrame, products: DataFrame) -> DataFrame:
    sold = _sold_by_category(items, products).select(CATEGORY, "revenue")
    return sold.select(
        CATEGORY,
        money(F.col("revenue")).alias("total_revenue"),
        _share("revenue", sold).alias("pct_of_total_revenue"),
    ).orderBy(F.desc("total_revenue"), CATEGORY)


def seller_top_revenue(items: DataFrame, sellers: DataFrame) -> DataFrame:
    revenue = exact_sum(F.col("price")).alias("revenue")
    sold = totals_and_distincts(items, "seller_id", [revenue], total_orders="order_id")
    return (
        sellers.select("seller_id", "seller_city", "seller_state")
        .join(sold, "seller_id")
        .groupBy("seller_id", "seller_city", "seller_state")
        .agg(
            F.max("total_orders").alias("total_orders"),
            money(F.sum("revenue")).alias("total_revenue"),
        )
        .orderBy(F.desc("total_revenue"), "seller_id")
        .limit(TOP)
    )


def _revenue_by_seller(items: DataFrame, sellers: DataFrame) -> DataFrame:
    sold = items.groupBy("seller_id").agg(exact_sum(F.col("price")).alias("revenue"))
    return (
        sellers.select("seller_id", "seller_state")
        .join(sold, "seller_id")
        .groupBy("seller_state", "seller_id")
        .agg(F.sum("revenue").alias("revenue"))
    )


def seller_rank_in_state(items: DataFrame, sellers: DataFrame, top: int = 3) -> DataFrame:
    # The rank filter plans as a group limit before the shuffle: a state that
    # holds most sellers sends only its leaders from each input partition.
    by_revenue = W.partitionBy("seller_state").orderBy(F.desc("revenue"))
    return (
        _revenue_by_seller(items, sellers)
        .withColumn("rank_in_state", F.rank().over(by_revenue))
        .where(F.col("rank_in_state") <= top)
        .select(
            "seller_state",
            "seller_id",
            money(F.col("revenue")).alias("total_revenue"),
            "rank_in_state",
        )
        .orderBy("seller_state", "rank_in_state", "seller_id")
    )


def seller_state_summary(items: DataFrame, sellers: DataFrame) -> DataFrame:
    # One row per state and seller, so counting rows counts distinct sellers.
    total = money(F.sum("revenue"))
    return (
        _revenue_by_seller(items, sellers)
        .groupBy("seller_state")
        .agg(
            F.count("seller_id").alias("total_sellers"),
            total.alias("total_revenue"),
            round2(total / F.count("seller_id")).alias("avg_revenue_per_seller"),
        )
        .orderBy(F.desc("total_revenue"), "seller_state")
    )


def review_score_distribution(reviews: DataFrame) -> DataFrame:
    counted = reviews.groupBy("review_score").agg(F.count("*").alias("total_reviews"))
    return counted.select(
        "review_score", "total_reviews", _share("total_reviews", counted).alias("pct_of_total")
    ).orderBy(F.desc("review_score"))


def category_worst_reviewed(
    reviews: DataFrame, items: DataFrame, products: DataFrame, at_least: int = 30
) -> DataFrame:
    scored = (
        spread_join(items.select("order_id", "product_id"), review_totals(reviews), "order_id")
        .groupBy("product_id")
        .agg(*[F.sum(c).alias(c) for c in ("reviews", "score_sum", "score_count")])
    )
    return (
        scored.join(products.select("product_id", CATEGORY), "product_id")
        .groupBy(CATEGORY)
        .agg(
            round2(F.try_divide(F.sum("score_sum"), F.sum("score_count"))).alias("avg_review_score"),
            F.sum("reviews").alias("total_reviews"),
        )
        .where(F.col("total_reviews") >= at_least)
        .orderBy("avg_review_score", CATEGORY)
        .limit(TOP)
    )


def delivery_vs_review(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    delivered = F.col("order_delivered_customer_date")
    late = delivered > F.col("order_estimated_delivery_date")
    return (
        orders.where(delivered.isNotNull())
        .select("order_id", F.when(late, LATE).otherwise(ON_TIME).alias("status_pengiriman"))
        .join(review_totals(reviews), "order_id")
        .groupBy("status_pengiriman")
        .agg(
            round2(F.try_divide(F.sum("score_sum"), F.sum("score_count"))).alias("avg_review_score"),
            F.sum("reviews").alias("total_orders"),
        )
    )


def seller_worst_reviewed(
    items: DataFrame, sellers: DataFrame, reviews: DataFrame, at_least: int = 20
) -> DataFrame:
    sums = ("score_sum", "score_count")
    # The join leaves rows partitioned by order, which serves the grouping by
    # seller and order; after it, counting rows counts distinct orders.
    scored = (
        spread_join(items.select("order_id", "seller_id"), review_totals(reviews), "order_id")
        .groupBy("seller_id", "order_id", SPREAD)
        .agg(*[F.sum(c).alias(c) for c in sums])
        .groupBy("seller_id")
        .agg(F.count("*").alias("total_orders"), *[F.sum(c).alias(c) for c in sums])
    )
    return (
        sellers.select("seller_id", "seller_state")
        .join(scored.where(F.col("total_orders") >= at_least), "seller_id")
        .groupBy("seller_id", "seller_state")
        .agg(
            F.max("total_orders").alias("total_orders"),
            round2(F.try_divide(F.sum("score_sum"), F.sum("score_count"))).alias("avg_review_score"),
        )
        .orderBy("avg_review_score", "seller_id")
        .limit(TOP)
    )


def product_top_sold(items: DataFrame, products: DataFrame, reviews: DataFrame) -> DataFrame:
    # An item counts once per review of its order, and once if there is none.
    times = F.coalesce("reviews", F.lit(1))
    sold = (
        spread_join(
            items.select("order_id", "product_id", "price"), review_totals(reviews), "order_id", "left"
        )
        .groupBy("product_id")
        .agg(
            F.sum(times).alias("sold"),
            sum_units(units(F.col("price")) * times).alias("revenue"),
            F.sum("score_sum").alias("score_sum"),
            F.sum("score_count").alias("score_count"),
        )
    )
    return (
        products.select("product_id", CATEGORY)
        .join(sold, "product_id")
        .groupBy("product_id", CATEGORY)
        .agg(
            F.sum("sold").alias("total_items_sold"),
            money(F.sum("revenue")).alias("total_revenue"),
            round2(F.try_divide(F.sum("score_sum"), F.sum("score_count"))).alias("avg_review_score"),
        )
        .orderBy(F.desc("total_items_sold"), "product_id")
        .limit(TOP)
    )


def monthly_revenue_trend(orders: DataFrame, items: DataFrame) -> DataFrame:
    sold = items.groupBy("order_id").agg(exact_sum(F.col("price")).alias("revenue"))
    month = F.trunc("order_purchase_timestamp", "MM").alias("order_month")
    revenue = money(F.sum("revenue"))
    return (
        orders.where(~F.col("order_status").isin("unavailable", "canceled"))
        .select("order_id", month)
        .join(sold, "order_id")
        .groupBy("order_month", "order_id")
        .agg(F.sum("revenue").alias("revenue"))
        .groupBy("order_month")
        .agg(
            F.count("*").alias("total_orders"),
            revenue.alias("total_revenue"),
            round2(revenue / F.count("*")).alias("avg_order_value"),
        )
        .orderBy("order_month")
    )
