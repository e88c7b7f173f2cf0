"""Every job bound to the test tables: name -> (spark, data folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators import quality
from stratalake.operators.keys import latest_per_key, newer_than, replace_by_key, stack_rows
from stratalake.plans import employees, flights, gold, raw, sales, shop_extras, shop_queries, silver
from stratalake.session import one_group_at_a_time, prepare, run_dir
from stratalake.sources import adapters, files, schemas, tables
from stratalake.sources.quoted import read_quoted_csv
from stratalake.streaming.snapshots import (
    REJECTS,
    append_rejects,
    append_states,
    ingest_bodies,
    ingested,
    rejected,
    snapshot_stream,
)

Query = Callable[[SparkSession, str], DataFrame]


class Shop:
    """Lazy views of one data folder: ``x.items`` typed, ``s.items`` silver."""

    SILVER = {
        "customers": silver.dim_customers,
        "sellers": silver.dim_sellers,
        "orders": silver.fact_orders,
        "orders_before": silver.fact_orders,
        "items": silver.fact_order_items,
        "payments": silver.fact_payments,
        "reviews": silver.fact_reviews,
    }

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def x(self, name: str) -> DataFrame:
        return adapters.view(self.spark, self.sf_dir, f"x_{name}")

    def messy(self, name: str) -> DataFrame:
        return adapters.view(self.spark, self.sf_dir, f"m_{name}")

    def base(self, name: str) -> DataFrame:
        return adapters.view(self.spark, self.sf_dir, name)

    def s(self, name: str) -> DataFrame:
        if name == "products":
            return silver.dim_products(self.x("products"), self.x("category"))
        return self.SILVER[name](self.x(name))

    def gold_orders(self, orders: str = "orders") -> DataFrame:
        facts = gold.fct_orders(self.s(orders), self.s("items"), self.s("payments"), self.s("reviews"))
        # The types as one text, which every engine can compare.
        return facts.withColumn("payment_types", F.array_join("payment_types", ","))

    def gold_customers(self) -> DataFrame:
        return gold.dim_customers(
            self.s("customers"), self.s("orders"), self.s("payments"), self.s("reviews")
        )

    def order_details(self) -> DataFrame:
        return shop_extras.int_order_details(
            self.s("orders"), self.s("items"), self.s("payments"), self.s("reviews")
        )

    def flights_with_gaps(self) -> DataFrame:
        """Flights of which some have no time and some no country."""
        found = self.x("flights")
        country = F.when(F.col("origin_country") != "NATION_3", F.col("origin_country"))
        time = F.when(F.col("callsign") != "error", F.col("event_time"))
        return found.withColumns({"origin_country": country, "event_time": time})

    def staff(self) -> DataFrame:
        return employees.employees_clean(self.x("employees"))

    def ids(self) -> DataFrame:
        """Customer ids, then the customer id of every order, NULL while it is in process."""
        waiting = F.col("o_orderstatus") == "P"
        return stack_rows(
            self.base("customer").select(F.col("c_custkey").alias("id")),
            self.base("orders").select(F.when(~waiting, F.col("o_custkey")).alias("id")),
        )


def _orders_load_audit(shop: Shop) -> DataFrame:
    """Appending the same load twice doubles the table, as the audit shows."""
    database = _scratch_database(shop.spark, "orders_load")
    table = tables.layer_table("fact_orders", database)
    orders = shop.x("orders")
    tables.create_table(shop.spark, table, schemas.FACT_ORDERS)
    tables.append_rows(shop.spark, orders, table, schemas.FACT_ORDERS)
    return tables.append_audited(shop.spark, orders, table, schemas.FACT_ORDERS)


def _sellers_replaced(shop: Shop) -> DataFrame:
    """A table replaced from its own rows: each run reads what it replaces."""
    table = tables.layer_table("dim_sellers", _scratch_database(shop.spark, "sellers"))
    tables.replace_table(shop.spark, shop.x("sellers"), table)
    upper = shop.spark.table(table).withColumn("seller_state", F.upper("seller_state"))
    tables.replace_table(shop.spark, upper, table)
    return shop.spark.table(table)


def _fct_orders_table_upsert(shop: Shop) -> DataFrame:
    """A fact table by month takes the facts of late orders; earlier months stay untouched."""
    table = tables.layer_table("gold_fct_orders", _scratch_database(shop.spark, "facts"))
    when = "order_purchase_timestamp"
    tables.upsert_months(shop.spark, shop.gold_orders("orders_before"), table, "order_id", when)
    late = shop.gold_orders().where(F.col(when) >= F.lit(LATE).cast("timestamp_ntz"))
    tables.upsert_months(shop.spark, late, table, "order_id", when)
    return shop.spark.table(table).drop(tables.MONTH)


#: From here on orders count as late in the upsert of the fact table.
LATE = "2000-07-01 00:00:00"


class SilverTables:
    """The named tables of silver, written when asked for, the facts bucketed and sorted by order,
    as ``run_layers`` does with ``buckets``, into as many buckets as the largest asks for."""

    DIMENSIONS = ("customers", "sellers", "products")
    SORTED = {"items": "order_item_id", "payments": "payment_sequential", "reviews": "review_id"}

    def __init__(self, shop: Shop, *names: str):
        self.shop = shop
        self.database = _scratch_database(shop.spark, "silver")
        self.buckets = tables.bucket_number(*[shop.s(name) for name in names if name not in self.DIMENSIONS])

    def table(self, name: str) -> DataFrame:
        table = tables.layer_table(name, self.database)
        rows = self.shop.s(name)
        if name in self.DIMENSIONS:
            tables.replace_table(self.shop.spark, rows, table, (rows.columns[0],))
        else:
            by = ("order_id", *([self.SORTED[name]] if name in self.SORTED else []))
            tables.replace_table(self.shop.spark, rows, table, by, ("order_id", self.buckets))
        return self.shop.spark.table(table)


def _gold_on_tables(model: Callable[..., DataFrame], *names: str) -> Callable[[Shop], DataFrame]:
    def job(shop: Shop) -> DataFrame:
        silver_tables = SilverTables(shop, *names)
        return model(*[silver_tables.table(name) for name in names])

    return job


def _fct_orders_on_tables(shop: Shop) -> DataFrame:
    facts = _gold_on_tables(gold.fct_orders, "orders", "items", "payments", "reviews")(shop)
    return facts.withColumn("payment_types", F.array_join("payment_types", ","))


def _newer_by_state(shop: Shop) -> DataFrame:
    """Orders newer than the last load, by the state that load left behind."""
    database = _scratch_database(shop.spark, "state")
    table, state = tables.layer_table("fact_orders", database), tables.layer_table("load_state", database)
    when = "order_purchase_timestamp"
    tables.create_table(shop.spark, table, schemas.FACT_ORDERS)
    tables.append_up_to(shop.spark, shop.x("orders_before"), table, schemas.FACT_ORDERS, when, state)
    newer = tables.newer_than_state(shop.s("orders"), table, when, state)
    return newer.select("order_id", "order_status", when)


def _orders_by_month(shop: Shop) -> DataFrame:
    path = run_dir(shop.spark, "orders_by_month")
    when = "order_purchase_timestamp"
    rows = shop.gold_orders().select("order_id", "order_status", when)
    months = tables.clustered(tables.with_month(rows, when), tables.MONTH, "order_id")
    months.write.partitionBy(tables.MONTH).parquet(path)
    schema = "order_id string, order_status string, order_purchase_timestamp timestamp_ntz, ym string"
    return shop.spark.read.schema(schema).parquet(path)


def _flight_ingest(shop: Shop) -> DataFrame:
    """Land the snapshots as files, ingest them twice, read the table."""
    base = run_dir(shop.spark, "flight_ingest")
    landing, table, checkpoint = f"{base}/landing", f"{base}/table", f"{base}/checkpoint"
    adapters.snapshot_json(shop.spark, shop.sf_dir).write.text(landing)
    for _ in range(2):
        append_states(snapshot_stream(shop.spark, landing), table, checkpoint).awaitTermination()
    schema = f"{schemas.RAW_FLIGHTS.ddl}, ym string"
    return shop.spark.read.schema(schema).parquet(table).drop("ingested_at")


def _flight_quarantine(shop: Shop) -> DataFrame:
    """Land the snapshots with broken lines between them, list what is no snapshot."""
    base = run_dir(shop.spark, "flight_quarantine")
    broken = shop.base("events").where("event_id % 31 = 0").selectExpr(
        """concat('{"time": ', CAST(event_id AS STRING)) AS value"""
    )
    adapters.snapshot_json(shop.spark, shop.sf_dir).unionByName(broken).write.text(f"{base}/landing")
    for _ in range(2):
        stream = snapshot_stream(shop.spark, f"{base}/landing")
        append_rejects(stream, f"{base}/rejects", f"{base}/checkpoint").awaitTermination()
    return shop.spark.read.schema(REJECTS).parquet(f"{base}/rejects").select("body")


def _ingest_bodies(shop: Shop, base: str) -> None:
    """Land hourly bodies over several lines, broken ones and files of one body a line; ingest
    them twice."""
    landing = f"{base}/landing"
    bodies = adapters.snapshot_json(shop.spark, shop.sf_dir)
    state = F.regexp_extract("value", r'"states":\[(.*)\]\}$', 1)
    hour = F.get_json_object("value", "$.time").cast("bigint") - F.get_json_object("value", "$.time").cast("bigint") % 3600
    # Hours of even number come printed, one body a file; the others a state a line.
    even = (hour / 3600 % 2 == 0) & (state != "")
    bodies.where(~even).write.text(landing)
    printed = F.concat(F.lit('{"time": '), F.col("time"), F.lit(',\n "states": [\n'), F.array_join("states", ",\n"), F.lit("\n]}"))
    hours = bodies.where(even).groupBy(hour.alias("time")).agg(F.collect_list(state).alias("states"))
    one_a_file = {"maxRecordsPerFile": 1}
    with one_group_at_a_time(shop.spark):
        hours.select(printed.alias("value")).write.mode("append").options(**one_a_file).text(landing)
    broken = shop.base("events").where("event_id % 311 = 0").selectExpr(
        """concat('{"time":\n ', CAST(event_id AS STRING)) AS value"""
    )
    broken.write.mode("append").options(**one_a_file).text(landing)
    for _ in range(2):
        texts = files.stream_whole_files(shop.spark, landing)
        ingest_bodies(texts, f"{base}/table", f"{base}/rejects", f"{base}/checkpoint").awaitTermination()


def _raw_flights(shop: Shop) -> DataFrame:
    base = run_dir(shop.spark, "raw_flights")
    _ingest_bodies(shop, base)
    return ingested(shop.spark, f"{base}/table")


def _body_quarantine(shop: Shop) -> DataFrame:
    base = run_dir(shop.spark, "raw_flights")
    _ingest_bodies(shop, base)
    return rejected(shop.spark, f"{base}/rejects").select(F.regexp_replace("body", r"\s+$", "").alias("body"))


def _csv_of(shop: Shop, rows: DataFrame, name: str, header=files.lower_header) -> DataFrame:
    """The rows written as CSV, white space included, and read again as text."""
    path = run_dir(shop.spark, name)
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.write.csv(path, header=True, quote='"', escape='"', **keep)
    return files.read_csv(shop.spark, path, header=header)


def _employees_from_csv(shop: Shop) -> DataFrame:
    """Staff from a file whose header is written for people."""
    rows = shop.x("employees")
    names = [c.replace("_", " ").title().replace("Percent", "%") for c in rows.columns]
    return employees.employees_clean(
        _csv_of(shop, rows.toDF(*names), "employees_csv", files.snake_header)
    )


def _reviews_csv(shop: Shop, name: str) -> str:
    """Reviews written as CSV with line breaks, commas and quotes."""
    path = run_dir(shop.spark, name)
    message = F.concat("review_comment_message", F.lit('\nsaid "no", twice'))
    texts = shop.x("reviews").withColumn("review_comment_message", message)
    stamps = {
        c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        for c in ("review_creation_date", "review_answer_timestamp")
    }
    texts.withColumns(stamps).write.csv(path, header=True, quote='"', escape='"')
    return path


def _reviews_from_csv(shop: Shop) -> DataFrame:
    """Read again, each file by one task, and typed."""
    return raw.reviews(files.read_csv(shop.spark, _reviews_csv(shop, "reviews_csv"), multi_line=True))


def _reviews_from_quoted_csv(shop: Shop) -> DataFrame:
    """Read again, each file by as many tasks as it has splits, and typed."""
    return raw.reviews(read_quoted_csv(shop.spark, _reviews_csv(shop, "reviews_quoted_csv")))


def _categories_from_csv(shop: Shop) -> DataFrame:
    path = run_dir(shop.spark, "categories_csv")
    shop.x("category").write.csv(path, header=True)
    return raw.categories(files.read_csv(shop.spark, path))


def _scratch_database(spark: SparkSession, name: str) -> str:
    """A database of its own in the shared folder."""
    location = run_dir(spark, name)
    database = location.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{location}'")
    return database


def _freshness(shop: Shop) -> DataFrame:
    orders = shop.x("orders")
    now = orders.agg(F.max("order_estimated_delivery_date")).scalar()
    return quality.freshness(orders, "order_purchase_timestamp", now)


def _freshness_after(hours: int) -> Callable[[Shop], DataFrame]:
    """Freshness so many hours after the newest order."""

    def job(shop: Shop) -> DataFrame:
        orders = shop.x("orders")
        newest = orders.agg(F.max("order_purchase_timestamp").alias("at"))
        now = newest.select(F.col("at") + F.expr(f"INTERVAL '{hours}' HOUR")).scalar()
        return quality.freshness(orders, "order_purchase_timestamp", now)

    return job


JOBS: dict[str, Callable[[Shop], DataFrame]] = {
    # raw layer, from text rows
    "raw_customers": lambda t: raw.customers(t.messy("customers")),
    "raw_sellers": lambda t: raw.sellers(t.messy("sellers")),
    "raw_products": lambda t: raw.products(t.messy("products")),
    "raw_orders": lambda t: raw.orders(t.messy("orders")),
    "raw_order_items": lambda t: raw.order_items(t.messy("items")),
    "raw_payments": lambda t: raw.payments(t.messy("payments")),
    "raw_reviews": lambda t: raw.reviews(t.messy("reviews")),
    # shop analytics
    "category_top_sold": lambda t: shop_queries.category_top_sold(t.x("items"), t.x("products")),
    "category_top_revenue": lambda t: shop_queries.category_top_revenue(t.x("items"), t.x("products")),
    "category_revenue_share": lambda t: shop_queries.category_revenue_share(t.x("items"), t.x("products")),
    "seller_top_revenue": lambda t: shop_queries.seller_top_revenue(t.x("items"), t.x("sellers")),
    "seller_rank_in_state": lambda t: shop_queries.seller_rank_in_state(t.x("items"), t.x("sellers")),
    "seller_state_summary": lambda t: shop_queries.seller_state_summary(t.x("items"), t.x("sellers")),
    "review_score_distribution": lambda t: shop_queries.review_score_distribution(t.x("reviews")),
    "category_worst_reviewed": lambda t: shop_queries.category_worst_reviewed(
        t.x("reviews"), t.x("items"), t.x("products")
    ),
    "delivery_vs_review": lambda t: shop_queries.delivery_vs_review(t.x("orders"), t.x("reviews")),
    "seller_worst_reviewed": lambda t: shop_queries.seller_worst_reviewed(
        t.x("items"), t.x("sellers"), t.x("reviews")
    ),
    "product_top_sold": lambda t: shop_queries.product_top_sold(
        t.x("items"), t.x("products"), t.x("reviews")
    ),
    "monthly_revenue_trend": lambda t: shop_queries.monthly_revenue_trend(t.x("orders"), t.x("items")),
    # silver and gold layers
    "silver_dim_customers": lambda t: t.s("customers"),
    "silver_dim_sellers": lambda t: t.s("sellers"),
    "silver_dim_products": lambda t: t.s("products"),
    "silver_fact_orders": lambda t: t.s("orders"),
    "silver_fact_order_items": lambda t: t.s("items"),
    "silver_fact_payments": lambda t: t.s("payments"),
    "silver_fact_reviews": lambda t: t.s("reviews"),
    "gold_dim_customers": lambda t: t.gold_customers(),
    "gold_dim_products": lambda t: gold.dim_products(t.s("products"), t.s("items")),
    "gold_dim_sellers": lambda t: gold.dim_sellers(t.s("sellers"), t.s("items"), t.s("reviews")),
    "gold_fct_orders": lambda t: t.gold_orders(),
    "gold_fct_orders_upsert": lambda t: replace_by_key(
        t.gold_orders("orders_before"), t.gold_orders(), "order_id"
    ),
    "newer_orders": lambda t: newer_than(
        t.s("orders"), t.s("orders_before"), "order_purchase_timestamp"
    ).select("order_id", "order_status", "order_purchase_timestamp"),
    "dim_latest_per_key": lambda t: latest_per_key(t.x("customer_loads"), "customer_id", "load_seq"),
    "int_order_details": lambda t: t.order_details(),
    "int_customer_orders": lambda t: shop_extras.int_customer_orders(t.s("customers"), t.order_details()),
    "profit_margin": lambda t: shop_extras.profit_margin(t.s("items")),
    "priced_items": lambda t: shop_extras.priced_items(t.x("items")),
    "category_performance": lambda t: shop_extras.category_performance(t.s("items"), t.s("products")),
    "customer_rank_in_state": lambda t: shop_extras.customer_rank_in_state(t.gold_customers()),
    # flights
    "flight_states": lambda t: flights.flight_states(adapters.snapshots(t.spark, t.sf_dir)),
    "flight_ingest": _flight_ingest,
    "flight_ingest_bodies": lambda t: _raw_flights(t).drop("ingested_at", "load"),
    "raw_flights_summary": lambda t: flights.gold_flight_summary(flights.silver_flights(_raw_flights(t))),
    "flight_body_quarantine": _body_quarantine,
    "silver_flights": lambda t: flights.silver_flights(t.x("flights")),
    "gold_flight_summary": lambda t: flights.gold_flight_summary(flights.silver_flights(t.x("flights"))),
    # employees, sales, starter models
    "employees_clean": lambda t: t.staff(),
    "employees_profile": lambda t: quality.profile(employees.known(t.x("employees"))),
    "salary_band_summary": lambda t: employees.salary_band_summary(t.staff()),
    "team_summary": lambda t: employees.team_summary(t.staff()),
    "employees_preview": lambda t: employees.employees_preview(t.staff()),
    "employees_count": lambda t: employees.employees_count(t.x("employees")),
    "sales_wide": lambda t: sales.sales_wide(
        t.x("staff_orders"), t.x("staff_customers"), t.x("staff_items"), t.x("staff_products")
    ),
    "starter_union": lambda t: t.ids(),
    "starter_filter": lambda t: t.ids().where("id = 1"),
    # data quality: the failing rows
    "dq_not_null": lambda t: quality.not_null(t.x("flights"), "baro_altitude"),
    "dq_unique": lambda t: quality.unique(t.x("items"), "order_id"),
    "dq_accepted_values": lambda t: quality.accepted_values(
        t.x("orders"), "order_status", ["delivered", "shipped", "canceled"]
    ),
    "dq_relationships": lambda t: quality.relationships(
        t.x("items"), "order_id", t.x("orders"), "order_id"
    ).select("order_id", "order_item_id"),
    "dq_review_score_range": lambda t: quality.rows_where(
        t.x("reviews"), ~F.col("review_score").between(1, 5), "review_id", "review_score"
    ),
    "dq_negative_revenue": lambda t: quality.rows_where(
        t.gold_customers(), F.col("total_revenue") < 0, "customer_id", "total_revenue"
    ),
    "dq_order_value": lambda t: quality.rows_where(
        t.gold_orders(), F.col("total_order_value") <= 0, "order_id", "total_order_value"
    ),
    "dq_order_customer": lambda t: quality.rows_where(
        t.gold_orders(), F.col("customer_id").isNull(), "order_id", "customer_id"
    ),
    # declared tests and rules of the shop, on input that has failing rows
    "dq_flights_not_null": lambda t: quality.not_null(
        t.flights_with_gaps(), "event_time", "icao24", "origin_country"
    ),
    "dq_summary_not_null": lambda t: quality.not_null(
        flights.gold_flight_summary(flights.silver_flights(t.flights_with_gaps())),
        "origin_country", "total_flights",
    ).select("origin_country", "total_flights"),
    "dq_starter_unique": lambda t: quality.unique(t.ids(), "id"),
    "dq_refunded_customers": lambda t: quality.rows_where(
        gold.dim_customers(
            t.s("customers"),
            t.s("orders"),
            t.s("payments").withColumn(
                "payment_value",
                F.when(F.col("payment_type") == "voucher", -F.col("payment_value")).otherwise(F.col("payment_value")),
            ),
            t.s("reviews"),
        ),
        F.col("total_revenue") < 0,
        "customer_id", "total_revenue",
    ),
    "dq_order_value_unclamped": lambda t: quality.rows_where(
        gold.fct_orders(t.s("orders"), t.x("items"), t.s("payments"), t.s("reviews")),
        F.col("total_order_value") <= 0,
        "order_id", "total_order_value",
    ),
    "dq_order_customer_missing": lambda t: quality.rows_where(
        gold.fct_orders(
            t.s("orders").withColumn(
                "customer_id", F.when(~F.col("customer_id").startswith("none-"), F.col("customer_id"))
            ),
            t.s("items"), t.s("payments"), t.s("reviews"),
        ),
        F.col("customer_id").isNull(),
        "order_id", "customer_id",
    ),
    "dq_starter_not_null": lambda t: quality.not_null(t.ids(), "id"),
    "dq_freshness": _freshness,
    "dq_freshness_pass": _freshness_after(24),
    "dq_freshness_warn": _freshness_after(30),
    "dq_relationships_reviews": lambda t: quality.relationships(
        t.x("reviews"), "order_id", t.x("orders"), "order_id"
    ).select("review_id", "order_id"),
    # tables and files: written to the shared folder, then read back
    "orders_load_audit": _orders_load_audit,
    "sellers_replaced": _sellers_replaced,
    "orders_by_month": _orders_by_month,
    "fct_orders_table_upsert": _fct_orders_table_upsert,
    "newer_orders_by_state": _newer_by_state,
    "gold_fct_orders_on_tables": _fct_orders_on_tables,
    "gold_dim_customers_on_tables": _gold_on_tables(
        gold.dim_customers, "customers", "orders", "payments", "reviews"
    ),
    "gold_dim_products_on_tables": _gold_on_tables(gold.dim_products, "products", "items"),
    "gold_dim_sellers_on_tables": _gold_on_tables(gold.dim_sellers, "sellers", "items", "reviews"),
    "reviews_from_csv": _reviews_from_csv,
    "reviews_from_quoted_csv": _reviews_from_quoted_csv,
    "categories_from_csv": _categories_from_csv,
    "customers_from_csv": lambda t: raw.customers(_csv_of(t, t.messy("customers"), "customers_csv")),
    "sellers_from_csv": lambda t: raw.sellers(_csv_of(t, t.messy("sellers"), "sellers_csv")),
    "products_from_csv": lambda t: raw.products(_csv_of(t, t.messy("products"), "products_csv")),
    "orders_from_csv": lambda t: raw.orders(_csv_of(t, t.messy("orders"), "orders_csv")),
    "order_items_from_csv": lambda t: raw.order_items(_csv_of(t, t.messy("items"), "items_csv")),
    "payments_from_csv": lambda t: raw.payments(_csv_of(t, t.messy("payments"), "payments_csv")),
    "employees_from_csv": _employees_from_csv,
    "flight_quarantine": _flight_quarantine,
}


def queries() -> dict[str, Query]:
    def bind(job: Callable[[Shop], DataFrame]) -> Query:
        return lambda spark, sf_dir: job(Shop(prepare(spark), sf_dir))

    return {name: bind(job) for name, job in JOBS.items()}
