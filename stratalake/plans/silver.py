"""Silver layer: one cleaned table per raw table, map-side but for one lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions import clamp, initcap_words, non_negative, seconds_between


def dim_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        F.trim(initcap_words(F.col("customer_city"))).alias("customer_city"),
        F.upper(F.trim("customer_state")).alias("customer_state"),
    )


def dim_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.select(
        "seller_id",
        "seller_zip_code_prefix",
        F.trim(initcap_words(F.col("seller_city"))).alias("seller_city"),
        F.upper(F.trim("seller_state")).alias("seller_state"),
    )


def dim_products(products: DataFrame, categories: DataFrame) -> DataFrame:
    english = F.coalesce("product_category_name_english", F.lit("unknown"))
    return products.join(categories, "product_category_name", "left").select(
        "product_id",
        "product_category_name",
        english.alias("product_category_english"),
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )


def fact_orders(orders: DataFrame) -> DataFrame:
    status = F.col("order_status")
    seconds = seconds_between(F.col("order_purchase_timestamp"), F.col("order_approved_at"))
    return orders.select(
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        F.coalesce(status == "delivered", F.lit(False)).alias("is_delivered"),
        F.coalesce(status.isin("canceled", "unavailable"), F.lit(False)).alias("is_canceled"),
        (seconds / F.lit(3600.0)).alias("approval_hours"),
    )


def fact_order_items(items: DataFrame) -> DataFrame:
    return items.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        non_negative(F.col("price")).alias("price"),
        non_negative(F.col("freight_value")).alias("freight_value"),
    )


def fact_payments(payments: DataFrame) -> DataFrame:
    return payments.select(
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        non_negative(F.col("payment_value")).alias("payment_value"),
    )


def fact_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.select(
        "review_id",
        "order_id",
        clamp(F.col("review_score"), 1, 5).alias("review_score"),
        "review_comment_title",
        "review_comment_message",
        "review_creation_date",
        "review_answer_timestamp",
    )
