"""Whole runs: files to raw tables, raw to silver to gold, snapshots to summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratalake.operators.keys import latest_per_key
from stratalake.plans import employees, flights, gold, raw, silver
from stratalake.sources import schemas, tables
from stratalake.sources.files import PLACE, read_csv, snake_header, stream_whole_files
from stratalake.sources.quoted import read_quoted_csv
from stratalake.streaming.snapshots import ingest_bodies, ingested, rejected

# table -> (file name, job, whether quoted text may hold line breaks)
RAW_FILES = {
    schemas.DIM_CUSTOMERS: ("customers.csv", raw.customers, False),
    schemas.DIM_SELLERS: ("sellers.csv", raw.sellers, False),
    schemas.DIM_PRODUCTS: ("products.csv", raw.products, False),
    schemas.DIM_CATEGORY: ("categories.csv", raw.categories, False),
    schemas.FACT_ORDERS: ("orders.csv", raw.orders, False),
    schemas.FACT_ORDER_ITEMS: ("order_items.csv", raw.order_items, False),
    schemas.FACT_PAYMENTS: ("payments.csv", raw.payments, False),
    schemas.FACT_REVIEWS: ("reviews.csv", raw.reviews, True),
}


DIMENSIONS = (schemas.DIM_CUSTOMERS, schemas.DIM_SELLERS, schemas.DIM_PRODUCTS, schemas.DIM_CATEGORY)


def _databases(spark: SparkSession, *names: str) -> None:
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def run_raw(
    spark: SparkSession,
    folder: str,
    database: str = "default",
    append: bool = False,
    files: dict[str, str] | None = None,
) -> dict[str, int]:
    """Load every CSV of a folder into its table and return the table's row counts.

    A run replaces the tables; with ``append`` a repeated run adds the rows of facts
    again and replaces dimension rows by key, so that the last load of a key stays, and
    of several rows in one load the last line. ``files`` maps table names to other file
    names. Rows are counted as they are written.
    """
    _databases(spark, database)
    counts = {}
    for spec, (file, job, multi_line) in RAW_FILES.items():
        path = f"{folder}/{(files or {}).get(spec.name, file)}"
        table = tables.layer_table(spec.name, database)
        if append and spec in DIMENSIONS:
            rows = job(read_csv(spark, path, place=True))
            key = spec.sort_by[0]
            tables.upsert_table(spark, latest_per_key(rows, key, PLACE).drop(PLACE), table, key)
            counts[spec.name] = spark.table(table).count()
            continue
        rows = job(read_quoted_csv(spark, path) if multi_line else read_csv(spark, path))
        if append:
            tables.create_table(spark, table, spec)
            tables.append_rows(spark, rows, table, spec)
            counts[spec.name] = spark.table(table).count()
        else:
            counts[spec.name] = tables.replace_table(spark, rows, table, spec.sort_by)
    return counts


def run_layers(
    spark: SparkSession,
    database: str = "default",
    silver_db: str = "silver",
    gold_db: str = "gold",
    buckets: int | None = None,
) -> None:
    """Build seven silver and four gold tables from the raw ones.

    Tables are replaced, but for the fact table, which replaces orders by key.
    Gold reads the written silver tables, so no cleaning runs twice. With ``buckets``, a
    number as ``tables.bucket_number`` finds it, the silver facts are bucketed and sorted by
    order, and gold joins and groups by order without a shuffle.
    """
    _databases(spark, silver_db, gold_db)

    def source(name: str) -> DataFrame:
        return tables.shop_source(spark, name, database)

    def write(df: DataFrame, layer: str, name: str, *sort_by: str) -> DataFrame:
        table = tables.layer_table(f"{layer}_{name}", silver_db if layer == "silver" else gold_db)
        by_order = buckets and layer == "silver" and name.startswith("fact_")
        tables.replace_table(spark, df, table, sort_by, ("order_id", buckets) if by_order else None)
        return spark.table(table)

    customers = write(silver.dim_customers(source("dim_customer")), "silver", "dim_customers", "customer_id")
    sellers = write(silver.dim_sellers(source("dim_seller")), "silver", "dim_sellers", "seller_id")
    products = write(
        silver.dim_products(source("dim_product"), source("dim_product_category")),
        "silver", "dim_products", "product_id",
    )
    orders = write(silver.fact_orders(source("fact_order")), "silver", "fact_orders", "order_id")
    items = write(
        silver.fact_order_items(source("fact_order_item")),
        "silver", "fact_order_items", "order_id", "order_item_id",
    )
    payments = write(
        silver.fact_payments(source("fact_order_payment")),
        "silver", "fact_payments", "order_id", "payment_sequential",
    )
    reviews = write(silver.fact_reviews(source("fact_order_review")), "silver", "fact_reviews", "review_id")

    write(gold.dim_customers(customers, orders, payments, reviews), "gold", "dim_customers", "customer_id")
    write(gold.dim_products(products, items), "gold", "dim_products", "product_id")
    write(gold.dim_sellers(sellers, items, reviews), "gold", "dim_sellers", "seller_id")
    facts = tables.layer_table("gold_fct_orders", gold_db)
    tables.upsert_table(spark, gold.fct_orders(orders, items, payments, reviews), facts, "order_id")


def run_flights(spark: SparkSession, landing: str, table_path: str, checkpoint: str) -> DataFrame:
    """Append newly landed snapshots, then define the silver and gold views.

    ``raw_flights`` is the ingested table, ``flight_rejects`` lists what was no snapshot.
    """
    rejects = f"{table_path}_rejects"
    texts = stream_whole_files(spark, landing)
    ingest_bodies(texts, table_path, rejects, checkpoint).awaitTermination()
    tables.as_view(rejected(spark, rejects), "flight_rejects")
    tables.as_view(ingested(spark, table_path), "raw_flights")
    silver_rows = flights.silver_flights(spark.table("raw_flights"))
    tables.as_view(silver_rows, "silver_flights")
    tables.as_view(flights.gold_flight_summary(silver_rows), "gold_flight_summary")
    return spark.table("gold_flight_summary")


def run_employees(spark: SparkSession, path: str, database: str = "default") -> DataFrame:
    """Clean the staff file into the ``employees`` table and return it."""
    _databases(spark, database)
    table = tables.layer_table("employees", database)
    clean = employees.employees_clean(read_csv(spark, path, header=snake_header))
    tables.replace_table(spark, clean, table)
    return spark.table(table)
