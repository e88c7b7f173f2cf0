"""Gold layer: dimensions with metrics, and one fact row per order.

Facts are aggregated to the join key before each join. That combines map-side,
so a key that owns a large share of the rows arrives as one row per input
partition, and no join multiplies rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions import exact_sum, money, round2, safe_ratio
from stratalake.operators.grouping import totals_and_distincts, totals_and_distincts_of
from stratalake.operators.joins import spread_join
from stratalake.operators.reviews import review_totals

ORDER_COLUMNS = [
    "order_id",
    "customer_id",
    "order_status",
    "is_delivered",
    "is_canceled",
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_customer_date",
    "approval_hours",
]


def payment_totals(payments: DataFrame) -> DataFrame:
    """Per order: amount, and its payment types, of which there are a handful."""
    types = F.array_sort(F.collect_set("payment_type"))
    return payments.groupBy("order_id").agg(
        exact_sum(F.col("payment_value")).alias("paid"), types.alias("payment_types")
    )


def review_averages(reviews: DataFrame) -> DataFrame:
    average = F.try_divide("score_sum", "score_count")
    return review_totals(reviews).select(
        "order_id", average.alias("avg_score"), F.col("id_count").alias("review_count")
    )


def dim_customers(
    customers: DataFrame, orders: DataFrame, payments: DataFrame, reviews: DataFrame
) -> DataFrame:
    # The payment types are not asked for, so Catalyst prunes them.
    paid = payment_totals(payments).select("order_id", "paid")
    scored = review_averages(reviews).select("order_id", "avg_score")
    zero = F.lit(0)
    # The joins leave the rows partitioned by order, which also serves grouping
    # by customer and order: distinct orders become plain counts with no shuffle.
    per_order = (
        orders.join(paid, "order_id", "left")
        .join(scored, "order_id", "left")
        .groupBy("customer_id", "order_id")
        .agg(
            F.count("*").alias("rows"),
            F.bool_or("is_delivered").alias("delivered"),
            F.bool_or("is_canceled").alias("canceled"),
            F.sum(F.coalesce("paid", zero)).alias("paid"),
            F.sum(F.coalesce("avg_score", F.lit(0.0))).alias("score"),
            F.min("order_purchase_timestamp").alias("first_at"),
            F.max("order_purchase_timestamp").alias("last_at"),
        )
    )
    known = F.col("order_id").isNotNull()
    per_customer = per_order.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        F.count_if(F.col("delivered") & known).alias("delivered_orders"),
        F.count_if(F.col("canceled") & known).alias("canceled_orders"),
        F.sum("paid").alias("paid"),
        (F.sum("score") / F.sum("rows")).alias("avg_review_score"),
        F.min("first_at").alias("first_order_date"),
        F.max("last_at").alias("last_order_date"),
    )
    grain = ["customer_id", "customer_unique_id", "customer_city", "customer_state"]
    # A customer loaded twice stays one row: grouping finds the rows already
    # partitioned by customer.
    summary = (
        customers.select(*grain)
        .join(per_customer, "customer_id", "left")
        .groupBy(*grain)
        .agg(
            *[
                F.coalesce(F.max(c), zero).alias(c)
                for c in ("total_orders", "delivered_orders", "canceled_orders")
            ],
            money(F.sum("paid")).alias("total_revenue"),
            *[F.max(c).alias(c) for c in ("avg_review_score", "first_order_date", "last_order_date")],
        )
    )
    tenure = F.coalesce(F.datediff("last_order_date", "first_order_date"), zero)
    return summary.select(
        *grain,
        "total_orders",
        "delivered_orders",
        "canceled_orders",
        safe_ratio(F.col("delivered_orders"), F.col("total_orders")).alias("delivery_rate"),
        "total_revenue",
        "avg_review_score",
        "first_order_date",
        "last_order_date",
        tenure.alias("customer_tenure_days"),
    )


def sales_totals(items: DataFrame, key: str, **distinct: str) -> DataFrame:
    amounts = [
        money(exact_sum(F.col("price"))).alias("total_revenue"),
        money(exact_sum(F.col("freight_value"))).alias("total_freight"),
    ]
    return totals_and_distincts(items, key, amounts, **distinct)


def dim_products(products: DataFrame, items: DataFrame) -> DataFrame:
    sold = sales_totals(items, "product_id", total_orders="order_id", total_sellers="seller_id")
    return products.join(sold, "product_id", "left").select(
        *products.columns,
        F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
        F.coalesce("total_revenue", F.lit(0.0)).alias("total_revenue"),
        F.coalesce("total_freight", F.lit(0.0)).alias("total_freight"),
        F.coalesce("total_sellers", F.lit(0)).alias("total_sellers"),
    )


def dim_sellers(sellers: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    sold = sales_totals(items, "seller_id", total_orders="order_id", unique_products="product_id")
    # Each item meets one row of review totals, not each review.
    scored = (
        spread_join(items.select("order_id", "seller_id"), review_totals(reviews), "order_id")
        .groupBy("seller_id")
        .agg(
            round2(F.try_divide(F.sum("score_sum"), F.sum("score_count"))).alias("avg_customer_review"),
            F.sum("id_count").alias("total_reviews"),
        )
    )
    whole = ("total_orders", "unique_products", "total_reviews")
    metrics = (
        "total_orders", "total_revenue", "total_freight", "unique_products",
        "avg_customer_review", "total_reviews",
    )
    return (
        sellers.select("seller_id", "seller_city", "seller_state")
        .join(sold, "seller_id", "left")
        .join(scored, "seller_id", "left")
        .select(
            "seller_id",
            "seller_city",
            "seller_state",
            *[F.coalesce(c, F.lit(0 if c in whole else 0.0)).alias(c) for c in metrics],
        )
    )


def order_details(
    orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame
) -> DataFrame:
    """One row per order with item, payment and review totals, canceled ones included.

    Every join is on ``order_id`` between sides already aggregated by it.
    """
    price, freight = F.col("price"), F.col("freight_value")
    sold = totals_and_distincts_of(
        orders,
        items,
        "order_id",
        [
            money(exact_sum(price)).alias("total_price"),
            money(exact_sum(freight)).alias("total_freight"),
            money(exact_sum(price + freight)).alias("total_order_value"),
        ],
        item_count="order_item_id",
        unique_products="product_id",
        unique_sellers="seller_id",
    )
    joined = (
        orders.select(*ORDER_COLUMNS)
        .join(sold, "order_id", "left")
        .join(payment_totals(payments), "order_id", "left")
        .join(review_averages(reviews), "order_id", "left")
    )
    # An order loaded twice stays one row and counts its items twice. Grouping by
    # whole rows needs no shuffle after the joins, and hashes instead of sorting.
    loaded = joined.groupBy(*joined.columns).agg(F.count("*").alias("copies"))
    zero = F.lit(0)
    return loaded.select(
        *ORDER_COLUMNS,
        F.coalesce("item_count", zero).alias("item_count"),
        *[
            (F.col(c) * F.col("copies")).alias(c)
            for c in ("total_price", "total_freight", "total_order_value")
        ],
        F.coalesce("unique_products", zero).alias("unique_products"),
        F.coalesce("unique_sellers", zero).alias("unique_sellers"),
        F.coalesce(money(F.col("paid")), F.lit(0.0)).alias("total_payment"),
        F.coalesce(F.array_size("payment_types"), zero).cast("bigint").alias("payment_method_count"),
        "payment_types",
        F.coalesce("avg_score", F.lit(0.0)).alias("avg_review_score"),
        F.coalesce("review_count", zero).alias("review_count"),
    )


def fct_orders(
    orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame
) -> DataFrame:
    """``order_details`` of the orders that are not canceled."""
    return order_details(orders.where(~F.col("is_canceled")), items, payments, reviews)
