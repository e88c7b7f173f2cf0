"""Views that give the test tables the shape of the shop, flight and staff tables.

The texts run unchanged in Spark and in DuckDB, so a query and its check start
from the same rows. ``x_`` views are typed; ``m_`` views are text with the dirt a
CSV brings: every row twice, padding, missing-value texts, unparsable values.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

_STATUS = """CASE WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'shipped'
    WHEN o_orderkey % 4 = 0 THEN 'canceled' WHEN o_orderkey % 4 = 1 THEN 'unavailable'
    ELSE 'processing' END"""

# As loaded before: nothing canceled or delivered yet.
_STATUS_BEFORE = """CASE WHEN o_orderstatus = 'F' OR o_orderstatus = 'O' THEN 'shipped'
    ELSE 'processing' END"""

# Some orders name a customer that does not exist.
_ORDERS = """SELECT CAST(o_orderkey AS STRING) AS order_id,
    CASE WHEN o_custkey % 50 = 0 THEN concat('none-', CAST(o_custkey AS STRING))
         ELSE CAST(o_custkey AS STRING) END AS customer_id,
    {status} AS order_status, o_orderdate AS order_purchase_timestamp,
    CASE WHEN o_orderkey % 10 = 0 THEN NULL
         ELSE o_orderdate + INTERVAL '1' MINUTE * CAST(o_orderkey % 4320 AS INT) END AS order_approved_at,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL '5' DAY END AS order_delivered_carrier_date,
    CASE WHEN o_orderstatus = 'F'
         THEN o_orderdate + INTERVAL '1' DAY * CAST(o_orderkey % 40 AS INT) END AS order_delivered_customer_date,
    o_orderdate + INTERVAL '20' DAY AS order_estimated_delivery_date
    FROM orders"""

TYPED = {
    "x_customers": """SELECT CAST(c_custkey AS STRING) AS customer_id,
        CAST(c_custkey % 1000 AS STRING) AS customer_unique_id,
        CAST(c_nationkey AS BIGINT) AS customer_zip_code_prefix,
        lower(replace(n_name, '_', '-x ')) AS customer_city, lower(r_name) AS customer_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "x_sellers": """SELECT CAST(s_suppkey AS STRING) AS seller_id,
        CAST(s_nationkey AS BIGINT) AS seller_zip_code_prefix,
        lower(replace(n_name, '_', '-x ')) AS seller_city, lower(r_name) AS seller_state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "x_products": """SELECT CAST(p_partkey AS STRING) AS product_id, lower(p_brand) AS product_category_name,
        CAST(p_size * 100 AS BIGINT) AS product_weight_g, CAST(p_size AS BIGINT) AS product_length_cm,
        CAST(p_size + 1 AS BIGINT) AS product_height_cm, CAST(p_size + 2 AS BIGINT) AS product_width_cm
        FROM part""",
    "x_category": """SELECT DISTINCT lower(p_brand) AS product_category_name,
        CASE WHEN p_brand <> 'Brand#2' THEN concat('en_', lower(p_brand)) END AS product_category_name_english
        FROM part""",
    "x_orders": _ORDERS.format(status=_STATUS),
    "x_orders_before": _ORDERS.format(status=_STATUS_BEFORE)
    + " WHERE o_orderdate < TIMESTAMP '2001-01-01 00:00:00'",
    "x_items": """SELECT CAST(l_orderkey AS STRING) AS order_id, l_linenumber AS order_item_id,
        CAST(l_partkey AS STRING) AS product_id, CAST(l_suppkey AS STRING) AS seller_id,
        l_shipdate AS shipping_limit_date,
        CASE WHEN l_orderkey % 97 = 0 THEN -l_extendedprice ELSE l_extendedprice END AS price,
        CASE WHEN l_orderkey % 89 = 0 THEN NULL ELSE l_extendedprice * l_tax END AS freight_value
        FROM lineitem""",
    "x_payments": """SELECT CAST(l_orderkey AS STRING) AS order_id, l_linenumber AS payment_sequential,
        CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto' ELSE 'voucher' END AS payment_type,
        CAST(l_quantity AS INT) % 12 AS payment_installments,
        l_extendedprice * (1 - l_discount) AS payment_value
        FROM lineitem""",
    "x_reviews": """SELECT concat('R', CAST(o_orderkey AS STRING)) AS review_id,
        CASE WHEN o_orderkey % 5 = 0 THEN concat('none-', CAST(o_orderkey AS STRING))
             ELSE CAST(o_orderkey AS STRING) END AS order_id, CAST(o_orderkey % 7 AS INT) AS review_score,
        '' AS review_comment_title, o_orderpriority AS review_comment_message,
        o_orderdate + INTERVAL '30' DAY AS review_creation_date,
        CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_orderdate + INTERVAL '32' DAY END AS review_answer_timestamp
        FROM orders""",
    "x_flights": """SELECT ts AS event_time, CAST(user_id AS STRING) AS icao24, event_type AS callsign,
        n_name AS origin_country, value AS longitude,
        CASE WHEN event_id % 17 = 0 THEN NULL ELSE value / 2 END AS latitude,
        CASE WHEN event_id % 10 = 0 THEN NULL ELSE value * 30 END AS baro_altitude,
        value * 31 AS geo_altitude, value AS velocity, CAST(user_id % 360 AS DOUBLE) AS heading,
        value - 10 AS vertical_rate, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS on_ground
        FROM events JOIN nation ON user_id % 25 = n_nationkey""",
    "x_employees": """SELECT c_name AS first_name,
        CASE WHEN c_custkey % 20 = 0 THEN 'n/a'
             ELSE CAST(CAST(c_acctbal * 15 AS DECIMAL(18,2)) AS STRING) END AS salary,
        CAST(CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_custkey % 15 END AS STRING) AS bonus_percent,
        CASE WHEN c_custkey % 2 = 0 THEN ' male' ELSE 'Female ' END AS gender,
        concat(CAST(1 + c_custkey % 12 AS STRING), '/', CAST(1 + c_custkey % 28 AS STRING), '/',
               CAST(1980 + c_custkey % 40 AS STRING)) AS start_date,
        CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(c_custkey % 3 = 0 AS STRING) END AS senior_management,
        c_mktsegment AS team
        FROM customer""",
    "x_customer_loads": """SELECT customer_id, customer_city, 1 AS load_seq FROM x_customers
        UNION ALL SELECT customer_id, concat('new ', customer_city), 2 FROM x_customers
        WHERE customer_state <> 'asia'""",
    "x_staff_orders": """SELECT o_orderkey AS order_id, o_custkey AS customer_id,
        CAST(o_orderdate AS DATE) AS order_date FROM orders""",
    "x_staff_customers": """SELECT c_custkey AS customer_id, c_name AS name, n_name AS city
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "x_staff_items": """SELECT l_orderkey AS order_id, l_partkey AS product_id,
        CAST(l_quantity AS INT) AS quantity FROM lineitem""",
    "x_staff_products": """SELECT p_partkey AS product_id, p_name AS product_name,
        CAST(p_retailprice AS DECIMAL(12,2)) AS price FROM part""",
}


def _twice(row: str, source: str, padded: str) -> str:
    """All rows, then all again with white space around one column of some."""
    again = row.replace("[", "CASE WHEN k % 7 = 0 THEN concat('  ', ").replace(
        "]", f", chr(9)) ELSE {padded} END"
    )
    once = row.replace("[", "").replace("]", "")
    return f"SELECT {once} FROM {source} UNION ALL SELECT {again} FROM {source}"


def _keyed(view: str, key: str, prefix: str = "") -> str:
    number = f"replace({key}, '{prefix}', '')" if prefix else key
    return f"(SELECT *, CAST({number} AS BIGINT) AS k FROM {view}) keyed"


MESSY = {
    "m_customers": _twice(
        """customer_id, customer_unique_id,
        CASE WHEN k % 11 = 0 THEN 'x' ELSE CAST(customer_zip_code_prefix AS STRING) END AS customer_zip_code_prefix,
        [customer_city] AS customer_city,
        CASE WHEN k % 5 = 0 THEN 'NA' ELSE customer_state END AS customer_state""",
        _keyed("x_customers", "customer_id"),
        "customer_city",
    ),
    "m_sellers": _twice(
        """seller_id, CAST(seller_zip_code_prefix AS STRING) AS seller_zip_code_prefix,
        CASE WHEN k % 5 = 0 THEN NULL ELSE seller_city END AS seller_city, [seller_state] AS seller_state""",
        _keyed("x_sellers", "seller_id"),
        "seller_state",
    ),
    "m_products": _twice(
        """CASE WHEN k % 31 = 0 THEN NULL ELSE product_id END AS product_id,
        [product_category_name] AS product_category_name,
        CASE WHEN k % 5 = 0 THEN NULL ELSE concat(CAST(product_weight_g AS STRING), '.7') END AS product_weight_g,
        CASE WHEN k % 3 = 0 THEN 'null' ELSE CAST(product_length_cm AS STRING) END AS product_length_cm,
        concat(CAST(product_height_cm AS STRING), 'e1') AS product_height_cm,
        concat(' ', CAST(product_width_cm AS STRING)) AS product_width_cm""",
        _keyed("x_products", "product_id"),
        "product_category_name",
    ),
    "m_orders": _twice(
        """CASE WHEN k % 41 = 0 THEN '' ELSE order_id END AS order_id, customer_id, [order_status] AS order_status,
        CASE WHEN k % 13 = 0 THEN 'not a date' ELSE CAST(order_purchase_timestamp AS STRING) END
            AS order_purchase_timestamp,
        CASE WHEN k % 17 = 0 THEN CAST(CAST(order_approved_at AS DATE) AS STRING)
             ELSE CAST(order_approved_at AS STRING) END AS order_approved_at,
        CAST(order_delivered_carrier_date AS STRING) AS order_delivered_carrier_date,
        CAST(order_delivered_customer_date AS STRING) AS order_delivered_customer_date,
        CAST(order_estimated_delivery_date AS STRING) AS order_estimated_delivery_date""",
        _keyed("x_orders", "order_id"),
        "order_status",
    ),
    "m_items": _twice(
        """order_id, CASE WHEN k % 19 = 0 THEN 'one' ELSE CAST(order_item_id AS STRING) END AS order_item_id,
        product_id, [seller_id] AS seller_id,
        CASE WHEN k % 13 = 0 THEN NULL ELSE CAST(shipping_limit_date AS STRING) END AS shipping_limit_date,
        CASE WHEN k % 23 = 0 THEN 'free' ELSE CAST(price AS STRING) END AS price,
        CAST(freight_value AS STRING) AS freight_value""",
        _keyed("x_items", "order_id"),
        "seller_id",
    ),
    "m_payments": _twice(
        """order_id, CAST(payment_sequential AS STRING) AS payment_sequential, [payment_type] AS payment_type,
        CASE WHEN k % 11 = 0 THEN '#N/A' ELSE CAST(payment_installments AS STRING) END AS payment_installments,
        CAST(payment_value AS STRING) AS payment_value""",
        _keyed("x_payments", "order_id"),
        "payment_type",
    ),
    "m_reviews": _twice(
        """CASE WHEN k % 43 = 0 THEN 'None' ELSE review_id END AS review_id, order_id,
        CASE WHEN k % 11 = 0 THEN '' ELSE CAST(review_score AS STRING) END AS review_score,
        review_comment_title,
        [review_comment_message] AS review_comment_message,
        CAST(review_creation_date AS STRING) AS review_creation_date,
        CAST(review_answer_timestamp AS STRING) AS review_answer_timestamp""",
        _keyed("x_reviews", "review_id", "R"),
        "review_comment_message",
    ),
}

VIEWS = {**TYPED, **MESSY}


def _reads(text: str) -> list[str]:
    """Names the text selects from."""
    found = set(re.findall(r"\b(?:FROM|JOIN) (\w+)", text))
    return [name for name in (*BASE_TABLES, *VIEWS) if name in found]


_schemas: dict[tuple[str, str], StructType] = {}


def base_table(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table; its footers are read once per session, not once per query."""
    at = (spark.sparkContext.applicationId, path)
    if at not in _schemas:
        _schemas[at] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[at]).parquet(path)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table or adapter view of one data folder."""
    if name in BASE_TABLES:
        return base_table(spark, f"{sf_dir}/{name}.parquet")
    text = VIEWS[name]
    parts = {n: view(spark, sf_dir, n) for n in _reads(text)}
    for n in parts:
        text = re.sub(rf"\b(FROM|JOIN) {n}\b", rf"\1 {{{n}}}", text)
    return spark.sql(text, **parts)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "events").join(
        view(spark, sf_dir, "nation"), F.expr("user_id % 25 = n_nationkey")
    )


_SECONDS = "CAST(CAST(ts - TIMESTAMP_NTZ '1970-01-01 00:00:00' AS INTERVAL SECOND) AS BIGINT)"

# The 17 places of a state array: every 19th event has no time, every 23rd no callsign.
_STATE = [
    "CAST(user_id AS STRING)",
    "CASE WHEN event_id % 23 <> 0 THEN concat(event_type, '  ') END",
    "n_name",
    None,
    f"CASE WHEN event_id % 19 <> 0 THEN {_SECONDS} END",
    "value",
    "CASE WHEN event_id % 17 <> 0 THEN value / 2 END",
    "CASE WHEN event_id % 10 <> 0 THEN value * 30 END",
    "event_type = 'error'",
    "value",
    "user_id % 360",
    "value - 10",
    None,
    "value * 31",
    None,
    "false",
    "0",
]
_QUOTED = (0, 1, 2)
_STATED = "event_id % 29 <> 0"


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights as snapshots of one state array each; every 29th has no states."""
    places = ", ".join(f"CAST({place or 'NULL'} AS STRING)" for place in _STATE)
    states = f"CASE WHEN {_STATED} THEN array(array({places})) END AS states"
    return _events(spark, sf_dir).selectExpr(f"{_SECONDS} AS time", states)


def snapshot_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same snapshots as JSON text, with numbers, booleans and nulls in the arrays."""

    def literal(i: int, place: str | None) -> str:
        text = f"CAST({place or 'NULL'} AS STRING)"
        if i in _QUOTED:
            text = f"concat('\"', {text}, '\"')"
        return f"coalesce({text}, 'null')"

    places = ", ',', ".join(literal(i, place) for i, place in enumerate(_STATE))
    full = f"""concat('{{"time":', {_SECONDS}, ',"states":[[', {places}, ']]}}')"""
    empty = f"""concat('{{"time":', {_SECONDS}, '}}')"""
    return _events(spark, sf_dir).selectExpr(f"CASE WHEN {_STATED} THEN {full} ELSE {empty} END AS value")
