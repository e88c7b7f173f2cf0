"""Declared schemas of the warehouse tables, with their sort keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class TableSpec:
    name: str
    ddl: str
    sort_by: tuple[str, ...]
    month_of: str | None = None  # the timestamp whose month partitions the table

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


DIM_CUSTOMERS = TableSpec(
    "dim_customers",
    "customer_id string, customer_unique_id string, customer_zip_code_prefix bigint, "
    "customer_city string, customer_state string",
    ("customer_id",),
)
DIM_SELLERS = TableSpec(
    "dim_sellers",
    "seller_id string, seller_zip_code_prefix bigint, seller_city string, seller_state string",
    ("seller_id",),
)
DIM_PRODUCTS = TableSpec(
    "dim_products",
    "product_id string, product_category_name string, product_weight_g bigint, "
    "product_length_cm bigint, product_height_cm bigint, product_width_cm bigint",
    ("product_id",),
)
DIM_CATEGORY = TableSpec(
    "dim_product_category",
    "product_category_name string, product_category_name_english string",
    ("product_category_name",),
)
FACT_ORDERS = TableSpec(
    "fact_orders",
    "order_id string, customer_id string, order_status string, "
    "order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, "
    "order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz, "
    "order_estimated_delivery_date timestamp_ntz",
    ("order_purchase_timestamp", "order_id"),
)
FACT_ORDER_ITEMS = TableSpec(
    "fact_order_items",
    "order_id string, order_item_id int, product_id string, seller_id string, "
    "shipping_limit_date timestamp_ntz, price double, freight_value double",
    ("order_id", "order_item_id"),
)
FACT_PAYMENTS = TableSpec(
    "fact_payments",
    "order_id string, payment_sequential int, payment_type string, "
    "payment_installments int, payment_value double",
    ("order_id", "payment_sequential"),
)
FACT_REVIEWS = TableSpec(
    "fact_reviews",
    "review_id string, order_id string, review_score int, review_comment_title string, "
    "review_comment_message string, review_creation_date timestamp_ntz, "
    "review_answer_timestamp timestamp_ntz",
    ("order_id", "review_id"),
)
RAW_FLIGHTS = TableSpec(
    "raw_flights",
    "event_time timestamp_ntz, icao24 string, callsign string, origin_country string, "
    "longitude double, latitude double, baro_altitude double, geo_altitude double, "
    "velocity double, heading double, vertical_rate double, on_ground int, "
    "ingested_at timestamp_ntz",
    ("event_time", "icao24"),
    month_of="event_time",
)
SALES = TableSpec(
    "sales",
    "order_id bigint, order_date date, customer_name string, city string, "
    "product_name string, price decimal(12,2), quantity bigint",
    ("order_date",),
)

TABLES = {
    spec.name: spec
    for spec in (
        DIM_CUSTOMERS, DIM_SELLERS, DIM_PRODUCTS, DIM_CATEGORY, FACT_ORDERS,
        FACT_ORDER_ITEMS, FACT_PAYMENTS, FACT_REVIEWS, RAW_FLIGHTS, SALES,
    )
}

# Logical source name -> warehouse table.
SHOP_SOURCES = {
    "dim_customer": "dim_customers",
    "dim_product": "dim_products",
    "dim_product_category": "dim_product_category",
    "dim_seller": "dim_sellers",
    "fact_order": "fact_orders",
    "fact_order_item": "fact_order_items",
    "fact_order_payment": "fact_payments",
    "fact_order_review": "fact_reviews",
}
