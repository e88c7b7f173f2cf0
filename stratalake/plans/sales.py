"""Normalised order tables flattened into the wide ``sales`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.sources.schemas import SALES


def sales_wide(
    orders: DataFrame, customers: DataFrame, order_items: DataFrame, products: DataFrame
) -> DataFrame:
    """One row per order item. Orders meet customers before the larger item table."""
    named = customers.select("customer_id", F.col("name").alias("customer_name"), "city")
    wide = (
        orders.join(named, "customer_id")
        .join(order_items, "order_id")
        .join(products, "product_id")
    )
    return wide.select(*[F.col(f.name).cast(f.dataType) for f in SALES.schema])
