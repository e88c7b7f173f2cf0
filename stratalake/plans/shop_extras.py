"""Further models over the shop tables: intermediate tables, margins, rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions import exact_sum, money, round2
from stratalake.operators.ranking import rank_in_group
from stratalake.plans import gold


def int_order_details(
    orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame
) -> DataFrame:
    """Order details of every order, payment types as one text."""
    details = gold.order_details(orders, items, payments, reviews)
    return details.withColumn("payment_types", F.array_join("payment_types", ", "))


def int_customer_orders(customers: DataFrame, details: DataFrame) -> DataFrame:
    """Per customer: orders, value of the ordered items, first and last order."""
    value = F.col("total_order_value")
    per_order = details.groupBy("customer_id", "order_id").agg(
        exact_sum(value).alias("value"),
        F.min("order_purchase_timestamp").alias("first_at"),
        F.max("order_purchase_timestamp").alias("last_at"),
    )
    per_customer = per_order.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("value").alias("value"),
        F.min("first_at").alias("first_order_date"),
        F.max("last_at").alias("last_order_date"),
    )
    grain = ["customer_id", "customer_unique_id", "customer_city", "customer_state"]
    return (
        customers.select(*grain)
        .join(per_customer, "customer_id", "left")
        .groupBy(*grain)
        .agg(
            F.coalesce(F.max("total_orders"), F.lit(0)).alias("total_orders"),
            money(F.sum("value")).alias("total_revenue"),
            F.max("first_order_date").alias("first_order_date"),
            F.max("last_order_date").alias("last_order_date"),
        )
    )


def profit_margin(items: DataFrame) -> DataFrame:
    price = F.col("price")
    margin = F.when(price > 0, round2((price - F.col("freight_value")) / price)).otherwise(0.0)
    return items.withColumn("profit_margin", margin)


def priced_items(items: DataFrame) -> DataFrame:
    return items.where(F.col("price") > 0)


def category_performance(items: DataFrame, products: DataFrame) -> DataFrame:
    """Gold product metrics rolled up to the English category."""
    sold = gold.dim_products(products, items)
    revenue = money(exact_sum(F.col("total_revenue")))
    return sold.groupBy("product_category_english").agg(
        F.count("*").alias("products"),
        revenue.alias("total_revenue"),
        round2(revenue / F.count("*")).alias("revenue_per_product"),
    )


def customer_rank_in_state(customers: DataFrame) -> DataFrame:
    """Gold customers ranked by revenue within their state."""
    spent = customers.where(F.col("total_revenue").isNotNull())
    return rank_in_group(
        spent.select("customer_state", "customer_id", "total_revenue"),
        "customer_state",
        "total_revenue",
        "rank_in_state",
    )
