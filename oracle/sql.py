"""The registered queries once more, as SQL for DuckDB.

Written from the definition of each result, not from the Spark plans: joins run
over single rows, where the plans join totals.
"""

from __future__ import annotations

import re

from stratalake.sources.adapters import VIEWS

# The texts a CSV reader treats as "missing".
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
_NA = "(" + ", ".join(f"'{t}'" for t in NA_TOKENS) + ")"


def _known(column: str) -> str:
    return f"CASE WHEN {column} NOT IN {_NA} THEN {column} END"


def _trimmed(column: str, missing: str | None = None) -> str:
    text = f"trim({column}, chr(9) || chr(10) || chr(13) || ' ')"
    return text if missing is None else f"coalesce({text}, '{missing}')"


def _number(column: str) -> str:
    return f"TRY_CAST(trim({column}) AS DOUBLE)"


def _whole(column: str, kind: str) -> str:
    return f"CAST(trunc(coalesce({_number(column)}, 0)) AS {kind})"


def _time(column: str) -> str:
    return f"CASE WHEN length({column}) = 19 THEN TRY_CAST({column} AS TIMESTAMP) END"


def _raw(view: str, columns: dict[str, str], where: str = "TRUE") -> str:
    names = ", ".join(f"{_known(c)} AS {c}" for c in columns)
    outputs = ", ".join(f"{e} AS {c}" for c, e in columns.items())
    return f"WITH rows_once AS (SELECT DISTINCT {names} FROM {view}), typed AS (SELECT {outputs} FROM rows_once) SELECT * FROM typed WHERE {where}"


def _round2(x: str) -> str:
    return f"(floor(({x}) * 100 + 0.5) / 100)"


def _money(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18,4))) AS DOUBLE)"


def _title(x: str) -> str:
    parts = f"regexp_extract_all(lower({x}), '[a-z0-9]+|[^a-z0-9]')"
    return f"array_to_string(list_transform({parts}, lambda w: upper(w[1]) || w[2:]), '')"


def _types(order: str = "order_id", separator: str = ",") -> str:
    return f"""SELECT {order}, string_agg(payment_type, '{separator}' ORDER BY payment_type) AS payment_types
        FROM (SELECT DISTINCT {order}, payment_type FROM s_payments) GROUP BY {order}"""


_WHOLE = "CAST({} AS BIGINT)".format
_AVG_SCORE = "CAST(sum(review_score) AS DOUBLE) / count(review_score)"

SILVER = {
    "s_customers": f"""SELECT customer_id, customer_unique_id, customer_zip_code_prefix,
        trim({_title('customer_city')}) AS customer_city, upper(trim(customer_state)) AS customer_state
        FROM x_customers""",
    "s_sellers": f"""SELECT seller_id, seller_zip_code_prefix, trim({_title('seller_city')}) AS seller_city,
        upper(trim(seller_state)) AS seller_state FROM x_sellers""",
    "s_products": """SELECT product_id, x_products.product_category_name,
        coalesce(product_category_name_english, 'unknown') AS product_category_english,
        product_weight_g, product_length_cm, product_height_cm, product_width_cm
        FROM x_products LEFT JOIN x_category USING (product_category_name)""",
    "s_items": """SELECT * REPLACE (greatest(coalesce(price, 0), 0) AS price,
        greatest(coalesce(freight_value, 0), 0) AS freight_value) FROM x_items""",
    "s_payments": "SELECT * REPLACE (greatest(coalesce(payment_value, 0), 0) AS payment_value) FROM x_payments",
    "s_reviews": """SELECT * REPLACE (CAST(greatest(least(review_score, 5), 1) AS INTEGER) AS review_score)
        FROM x_reviews""",
}


def _silver_orders(source: str) -> str:
    return f"""SELECT *, coalesce(order_status = 'delivered', FALSE) AS is_delivered,
        coalesce(order_status IN ('canceled', 'unavailable'), FALSE) AS is_canceled,
        date_diff('second', order_purchase_timestamp, order_approved_at) / 3600.0::DOUBLE AS approval_hours
        FROM {source}"""


SILVER["s_orders"] = _silver_orders("x_orders")
SILVER["s_orders_before"] = _silver_orders("x_orders_before")


def _gold_orders(source: str, where: str = "NOT is_canceled", separator: str = ",") -> str:
    return f"""SELECT o.order_id, customer_id, order_status, is_delivered, is_canceled, order_purchase_timestamp,
        order_approved_at, order_delivered_customer_date, approval_hours,
        coalesce(item_count, 0) AS item_count, total_price, total_freight, total_order_value,
        coalesce(unique_products, 0) AS unique_products, coalesce(unique_sellers, 0) AS unique_sellers,
        coalesce(total_payment, 0) AS total_payment, coalesce(payment_method_count, 0) AS payment_method_count,
        payment_types, coalesce(avg_review_score, 0) AS avg_review_score, coalesce(review_count, 0) AS review_count
        FROM {source} o
        LEFT JOIN (SELECT order_id, count(DISTINCT order_item_id) AS item_count,
            {_money('price')} AS total_price, {_money('freight_value')} AS total_freight,
            {_money('price + freight_value')} AS total_order_value,
            count(DISTINCT product_id) AS unique_products, count(DISTINCT seller_id) AS unique_sellers
            FROM s_items GROUP BY order_id) i ON i.order_id = o.order_id
        LEFT JOIN (SELECT order_id, {_money('payment_value')} AS total_payment,
            count(DISTINCT payment_type) AS payment_method_count FROM s_payments GROUP BY order_id) p
            ON p.order_id = o.order_id
        LEFT JOIN ({_types(separator=separator)}) t ON t.order_id = o.order_id
        LEFT JOIN (SELECT order_id, {_AVG_SCORE} AS avg_review_score, count(review_id) AS review_count
            FROM s_reviews GROUP BY order_id) r ON r.order_id = o.order_id
        WHERE {where}"""


GOLD = {
    "g_orders": _gold_orders("s_orders"),
    "g_orders_before": _gold_orders("s_orders_before"),
    "g_details": _gold_orders("s_orders", "TRUE", ", "),
    "g_customers": f"""SELECT customer_id, customer_unique_id, customer_city, customer_state,
        count(DISTINCT order_id) AS total_orders,
        count(DISTINCT order_id) FILTER (WHERE is_delivered) AS delivered_orders,
        count(DISTINCT order_id) FILTER (WHERE is_canceled) AS canceled_orders,
        CASE WHEN count(DISTINCT order_id) > 0 THEN {_round2('count(DISTINCT order_id) FILTER (WHERE is_delivered) / CAST(count(DISTINCT order_id) AS DOUBLE)')} ELSE 0 END AS delivery_rate,
        CAST(sum(total_payment) AS DOUBLE) AS total_revenue,
        sum(avg_review_score) / count(avg_review_score) AS avg_review_score,
        min(order_purchase_timestamp) AS first_order_date, max(order_purchase_timestamp) AS last_order_date,
        CAST(coalesce(date_diff('day', min(order_purchase_timestamp), max(order_purchase_timestamp)), 0) AS INTEGER)
            AS customer_tenure_days
        FROM s_customers LEFT JOIN (
            SELECT customer_id, o.order_id, is_delivered, is_canceled, order_purchase_timestamp,
            coalesce(paid, 0) AS total_payment, coalesce(score, 0) AS avg_review_score
            FROM s_orders o
            LEFT JOIN (SELECT order_id, sum(CAST(payment_value AS DECIMAL(18,4))) AS paid
                FROM s_payments GROUP BY order_id) p ON p.order_id = o.order_id
            LEFT JOIN (SELECT order_id, {_AVG_SCORE} AS score FROM s_reviews GROUP BY order_id) r
                ON r.order_id = o.order_id) d USING (customer_id)
        GROUP BY ALL""",
    "g_products": f"""SELECT s_products.*, coalesce(o, 0) AS total_orders, coalesce(v, 0) AS total_revenue,
        coalesce(f, 0) AS total_freight, coalesce(n, 0) AS total_sellers
        FROM s_products LEFT JOIN (SELECT product_id, count(DISTINCT order_id) AS o, {_money('price')} AS v,
            {_money('freight_value')} AS f, count(DISTINCT seller_id) AS n
            FROM s_items GROUP BY product_id) USING (product_id)""",
}

E_CLEAN = f"""SELECT first_name, coalesce(salary, mid) AS salary, bonus_percent, gender, start_date,
    senior_management, team, CAST(year(start_date) AS INTEGER) AS start_year,
    CASE WHEN coalesce(salary, mid) < 50000 THEN 'Rendah' WHEN coalesce(salary, mid) < 100000 THEN 'Menengah'
         ELSE 'Tinggi' END AS kategori_gaji
    FROM (SELECT first_name, {_number('salary')} AS salary, coalesce({_number('bonus_percent')}, 0) AS bonus_percent,
        upper(trim(gender)) AS gender, try_strptime(start_date, '%m/%d/%Y') AS start_date,
        TRY_CAST(senior_management AS BOOLEAN) AS senior_management, team FROM x_employees) typed,
    (SELECT (quantile_disc(s, 0.5) + coalesce(min(s) FILTER (WHERE over), quantile_disc(s, 0.5))) / 2 AS mid
     FROM (SELECT s, row_number() OVER (ORDER BY s) = (count(*) OVER ()) // 2 + 1 AS over
           FROM (SELECT {_number('salary')} AS s FROM x_employees) WHERE s IS NOT NULL)) middle"""

# Input with rows that fail the rules.
GOLD["u_payments"] = """SELECT * REPLACE (CASE WHEN payment_type = 'voucher' THEN -payment_value
    ELSE payment_value END AS payment_value) FROM s_payments"""
GOLD["u_customers"] = GOLD["g_customers"].replace("FROM s_payments", "FROM u_payments")
GOLD["u_values"] = GOLD["g_orders"].replace("FROM s_items", "FROM x_items")
GOLD["u_flights"] = """SELECT * REPLACE (CASE WHEN callsign <> 'error' THEN event_time END AS event_time,
    CASE WHEN origin_country <> 'NATION_3' THEN origin_country END AS origin_country) FROM x_flights"""

CHECK_VIEWS = {**VIEWS, **SILVER, **GOLD, "e_clean": E_CLEAN}


def with_views(query: str) -> str:
    """``query`` behind the definitions of the views it reads, in order of use."""
    needed: dict[str, str] = {}

    def add(text: str) -> None:
        for name in re.findall(r"\b(?:FROM|JOIN) (\w+)", text):
            if name in CHECK_VIEWS and name not in needed:
                add(CHECK_VIEWS[name])
                needed[name] = CHECK_VIEWS[name]

    add(query)
    views = [f"{name} AS ({text})" for name, text in needed.items()]
    first = re.match(r"\s*WITH\s+", query)
    body = query[first.end():] if first else query
    joint = ", " if first else " "
    return f"WITH {', '.join(views)}{joint}{body}" if views else query


_SOLD = "x_items JOIN x_products USING (product_id)"
_BY_SELLER = "x_items JOIN x_sellers USING (seller_id)"

QUERIES = {
    "raw_customers": _raw("m_customers", {
        **{c: _trimmed(c, "unknown") for c in ("customer_id", "customer_unique_id")},
        "customer_zip_code_prefix": _whole("customer_zip_code_prefix", "BIGINT"),
        **{c: _trimmed(c, "unknown") for c in ("customer_city", "customer_state")},
    }),
    "raw_sellers": _raw("m_sellers", {
        "seller_id": _trimmed("seller_id", "unknown"),
        "seller_zip_code_prefix": _whole("seller_zip_code_prefix", "BIGINT"),
        **{c: _trimmed(c, "unknown") for c in ("seller_city", "seller_state")},
    }),
    "raw_products": _raw("m_products", {
        "product_id": _trimmed("product_id"),
        "product_category_name": _trimmed("product_category_name", "unknown"),
        **{f"product_{c}": _whole(f"product_{c}", "BIGINT") for c in ("weight_g", "length_cm", "height_cm", "width_cm")},
    }, "product_id IS NOT NULL"),
    "raw_orders": _raw("m_orders", {
        **{c: _trimmed(c) for c in ("order_id", "customer_id", "order_status")},
        **{f"order_{c}": _time(f"order_{c}") for c in (
            "purchase_timestamp", "approved_at", "delivered_carrier_date", "delivered_customer_date",
            "estimated_delivery_date")},
    }, "order_id IS NOT NULL AND order_purchase_timestamp IS NOT NULL AND order_estimated_delivery_date IS NOT NULL"),
    "raw_order_items": _raw("m_items", {
        "order_id": _trimmed("order_id"), "order_item_id": _whole("order_item_id", "INTEGER"),
        "product_id": _trimmed("product_id"), "seller_id": _trimmed("seller_id"),
        "shipping_limit_date": _time("shipping_limit_date"),
        "price": f"coalesce({_number('price')}, 0)", "freight_value": f"coalesce({_number('freight_value')}, 0)",
    }, "shipping_limit_date IS NOT NULL"),
    "raw_payments": _raw("m_payments", {
        "order_id": _trimmed("order_id"), "payment_sequential": _whole("payment_sequential", "INTEGER"),
        "payment_type": _trimmed("payment_type"),
        "payment_installments": _whole("payment_installments", "INTEGER"),
        "payment_value": f"coalesce({_number('payment_value')}, 0)",
    }),
    "raw_reviews": _raw("m_reviews", {
        "review_id": _trimmed("review_id"), "order_id": _trimmed("order_id"),
        "review_score": _whole("review_score", "INTEGER"),
        **{c: _trimmed(c, "") for c in ("review_comment_title", "review_comment_message")},
        **{c: _time(c) for c in ("review_creation_date", "review_answer_timestamp")},
    }, "review_id IS NOT NULL AND order_id IS NOT NULL AND review_creation_date IS NOT NULL"),
    "category_top_sold": f"""SELECT product_category_name, count(*) AS total_items_sold,
        {_money('price')} AS total_revenue FROM {_SOLD} GROUP BY ALL
        ORDER BY total_items_sold DESC, product_category_name LIMIT 10""",
    "category_top_revenue": f"""SELECT product_category_name, count(*) AS total_items_sold,
        {_money('price')} AS total_revenue, {_round2(_money('price') + ' / count(price)')} AS avg_price_per_item
        FROM {_SOLD} GROUP BY ALL ORDER BY total_revenue DESC, product_category_name LIMIT 10""",
    "category_revenue_share": f"""SELECT product_category_name, {_money('price')} AS total_revenue,
        {_round2(_money('price') + ' * 100.0 / (SELECT ' + _money('price') + ' FROM ' + _SOLD + ')')}
        AS pct_of_total_revenue FROM {_SOLD} GROUP BY ALL""",
    "seller_top_revenue": f"""SELECT seller_id, seller_city, seller_state,
        count(DISTINCT order_id) AS total_orders, {_money('price')} AS total_revenue
        FROM {_BY_SELLER} GROUP BY ALL ORDER BY total_revenue DESC, seller_id LIMIT 10""",
    "seller_rank_in_state": f"""WITH revenue AS (SELECT seller_state, seller_id, {_money('price')} AS total_revenue
        FROM {_BY_SELLER} GROUP BY ALL)
        SELECT *, CAST(rank() OVER (PARTITION BY seller_state ORDER BY total_revenue DESC) AS INTEGER) AS rank_in_state
        FROM revenue QUALIFY rank_in_state <= 3""",
    "seller_state_summary": f"""SELECT seller_state, count(DISTINCT seller_id) AS total_sellers,
        {_money('price')} AS total_revenue,
        {_round2(_money('price') + ' / count(DISTINCT seller_id)')} AS avg_revenue_per_seller
        FROM {_BY_SELLER} GROUP BY ALL""",
    "review_score_distribution": f"""SELECT review_score, count(*) AS total_reviews,
        {_round2('CAST(count(*) AS DOUBLE) * 100.0 / CAST(sum(count(*)) OVER () AS DOUBLE)')} AS pct_of_total
        FROM x_reviews GROUP BY review_score""",
    "category_worst_reviewed": f"""SELECT product_category_name, {_round2(_AVG_SCORE)} AS avg_review_score,
        count(*) AS total_reviews
        FROM x_reviews JOIN x_items USING (order_id) JOIN x_products USING (product_id)
        GROUP BY product_category_name HAVING count(*) >= 30
        ORDER BY avg_review_score, product_category_name LIMIT 10""",
    "delivery_vs_review": f"""SELECT CASE WHEN order_delivered_customer_date > order_estimated_delivery_date
        THEN 'Terlambat' ELSE 'Tepat Waktu' END AS status_pengiriman,
        {_round2(_AVG_SCORE)} AS avg_review_score, count(*) AS total_orders
        FROM x_orders JOIN x_reviews USING (order_id)
        WHERE order_delivered_customer_date IS NOT NULL GROUP BY status_pengiriman""",
    "seller_worst_reviewed": f"""SELECT seller_id, seller_state, count(DISTINCT order_id) AS total_orders,
        {_round2(_AVG_SCORE)} AS avg_review_score
        FROM x_items JOIN x_sellers USING (seller_id) JOIN x_reviews USING (order_id)
        GROUP BY seller_id, seller_state HAVING count(DISTINCT order_id) >= 20
        ORDER BY avg_review_score, seller_id LIMIT 10""",
    "product_top_sold": f"""SELECT product_id, product_category_name, count(*) AS total_items_sold,
        {_money('price')} AS total_revenue, {_round2(_AVG_SCORE)} AS avg_review_score
        FROM x_items JOIN x_products USING (product_id) LEFT JOIN x_reviews USING (order_id)
        GROUP BY product_id, product_category_name ORDER BY total_items_sold DESC, product_id LIMIT 10""",
    "monthly_revenue_trend": f"""SELECT CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS order_month,
        count(DISTINCT order_id) AS total_orders, {_money('price')} AS total_revenue,
        {_round2(_money('price') + ' / count(DISTINCT order_id)')} AS avg_order_value
        FROM x_orders JOIN x_items USING (order_id)
        WHERE order_status NOT IN ('unavailable', 'canceled') GROUP BY order_month""",
    "silver_dim_customers": "SELECT * FROM s_customers",
    "silver_dim_sellers": "SELECT * FROM s_sellers",
    "silver_dim_products": "SELECT * FROM s_products",
    "silver_fact_orders": "SELECT * FROM s_orders",
    "silver_fact_order_items": "SELECT * FROM s_items",
    "silver_fact_payments": "SELECT * FROM s_payments",
    "silver_fact_reviews": "SELECT * FROM s_reviews",
    "gold_dim_customers": "SELECT * FROM g_customers",
    "gold_dim_products": "SELECT * FROM g_products",
    "gold_dim_sellers": f"""SELECT s_sellers.seller_id, seller_city, seller_state, coalesce(o, 0) AS total_orders,
        coalesce(v, 0) AS total_revenue, coalesce(f, 0) AS total_freight, coalesce(u, 0) AS unique_products,
        coalesce(a, 0) AS avg_customer_review, coalesce(n, 0) AS total_reviews
        FROM s_sellers
        LEFT JOIN (SELECT seller_id, count(DISTINCT order_id) AS o, {_money('price')} AS v,
            {_money('freight_value')} AS f, count(DISTINCT product_id) AS u
            FROM s_items GROUP BY seller_id) i USING (seller_id)
        LEFT JOIN (SELECT seller_id, {_round2(_AVG_SCORE)} AS a, count(review_id) AS n
            FROM s_reviews JOIN s_items USING (order_id) GROUP BY seller_id) r USING (seller_id)""",
    "gold_fct_orders": "SELECT * FROM g_orders",
    "gold_fct_orders_upsert": """SELECT * FROM g_orders UNION ALL
        SELECT * FROM g_orders_before WHERE order_id NOT IN (SELECT order_id FROM g_orders)""",
    "newer_orders": """SELECT order_id, order_status, order_purchase_timestamp FROM s_orders
        WHERE order_purchase_timestamp > (SELECT max(order_purchase_timestamp) FROM s_orders_before)""",
    "dim_latest_per_key": """SELECT customer_id, customer_city, load_seq FROM x_customer_loads
        QUALIFY load_seq = max(load_seq) OVER (PARTITION BY customer_id)""",
    "int_order_details": "SELECT * FROM g_details",
    "int_customer_orders": """SELECT customer_id, customer_unique_id, customer_city, customer_state,
        count(DISTINCT order_id) AS total_orders,
        CAST(sum(CAST(total_order_value AS DECIMAL(18,4))) AS DOUBLE) AS total_revenue,
        min(order_purchase_timestamp) AS first_order_date, max(order_purchase_timestamp) AS last_order_date
        FROM s_customers LEFT JOIN g_details USING (customer_id) GROUP BY ALL""",
    "profit_margin": f"""SELECT *, CASE WHEN price > 0 THEN {_round2('(price - freight_value) / price')} ELSE 0 END
        AS profit_margin FROM s_items""",
    "priced_items": "SELECT * FROM x_items WHERE price > 0",
    "category_performance": f"""SELECT product_category_english, count(*) AS products,
        {_money('total_revenue')} AS total_revenue, {_round2(_money('total_revenue') + ' / count(*)')} AS revenue_per_product
        FROM g_products GROUP BY product_category_english""",
    "customer_rank_in_state": """SELECT customer_state, customer_id, total_revenue,
        rank() OVER (PARTITION BY customer_state ORDER BY total_revenue DESC) AS rank_in_state
        FROM g_customers WHERE total_revenue IS NOT NULL""",
    "flight_states": """SELECT date_trunc('second', ts) AS event_time, CAST(user_id AS STRING) AS icao24,
        CASE WHEN event_id % 23 = 0 THEN '' ELSE event_type END AS callsign, n_name AS origin_country,
        value AS longitude, CASE WHEN event_id % 17 <> 0 THEN value / 2 END AS latitude,
        CASE WHEN event_id % 10 <> 0 THEN value * 30 END AS baro_altitude, value * 31 AS geo_altitude,
        value AS velocity, CAST(user_id % 360 AS DOUBLE) AS heading, value - 10 AS vertical_rate,
        CAST(event_type = 'error' AS INTEGER) AS on_ground
        FROM events JOIN nation ON user_id % 25 = n_nationkey
        WHERE event_id % 19 <> 0 AND event_id % 29 <> 0""",
    "silver_flights": """SELECT * FROM x_flights WHERE latitude IS NOT NULL AND longitude IS NOT NULL
        AND baro_altitude IS NOT NULL AND geo_altitude IS NOT NULL AND velocity IS NOT NULL
        AND heading IS NOT NULL AND vertical_rate IS NOT NULL""",
    "gold_flight_summary": f"""SELECT origin_country, count(*) AS total_flights,
        count(*) FILTER (WHERE on_ground = 0) AS airborne_flights,
        count(*) FILTER (WHERE on_ground = 1) AS grounded_flights,
        {_round2('count(*) FILTER (WHERE on_ground = 0) / CAST(count(*) AS DOUBLE) * 100')} AS airborne_percentage,
        {_round2('avg(velocity) * 3.6::DOUBLE')} AS avg_velocity_kmh,
        {_round2('avg(baro_altitude)')} AS avg_altitude
        FROM x_flights WHERE latitude IS NOT NULL AND baro_altitude IS NOT NULL GROUP BY origin_country""",
    "employees_clean": "SELECT * FROM e_clean",
    "employees_profile": " UNION ALL ".join(
        f"""SELECT {i} AS position, '{c}' AS column_name, 'string' AS data_type,
        count(*) FILTER (WHERE {c} IS NULL OR {c} IN {_NA}) AS null_count, count(*) AS row_count, 7 AS column_count FROM x_employees"""
        for i, c in enumerate(("first_name", "salary", "bonus_percent", "gender", "start_date",
                               "senior_management", "team"), 1)
    ),
    "salary_band_summary": f"""SELECT kategori_gaji, count(*) AS jumlah_employee,
        {_round2(_money('salary') + ' / count(salary)')} AS rata_rata_gaji FROM e_clean GROUP BY kategori_gaji""",
    "team_summary": f"""SELECT team, count(*) AS jumlah_employee,
        {_round2(_money('salary') + ' / count(salary)')} AS rata_rata_gaji FROM e_clean GROUP BY team""",
    "employees_preview": """SELECT first_name, salary, kategori_gaji, start_date, start_year FROM e_clean
        ORDER BY first_name, salary, start_date LIMIT 10""",
    "employees_count": "SELECT count(*) AS total_data FROM x_employees",
    "sales_wide": """SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date, c_name AS customer_name,
        n_name AS city, p_name AS product_name, CAST(p_retailprice AS DECIMAL(12,2)) AS price,
        CAST(l_quantity AS BIGINT) AS quantity
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey""",
    "starter_union": "SELECT c_custkey AS id FROM customer UNION ALL SELECT CASE WHEN o_orderstatus <> 'P' THEN o_custkey END FROM orders",
    "starter_filter": "SELECT c_custkey AS id FROM customer WHERE c_custkey = 1 UNION ALL SELECT o_custkey FROM orders WHERE o_orderstatus <> 'P' AND o_custkey = 1",
    "dq_not_null": "SELECT * FROM x_flights WHERE baro_altitude IS NULL",
    "dq_unique": "SELECT order_id, count(*) AS n_records FROM x_items GROUP BY order_id HAVING count(*) > 1",
    "dq_accepted_values": """SELECT order_status, count(*) AS n_records FROM x_orders
        WHERE order_status NOT IN ('delivered', 'shipped', 'canceled') GROUP BY order_status""",
    "dq_relationships": """SELECT order_id, order_item_id FROM x_items
        WHERE NOT EXISTS (SELECT 1 FROM x_orders WHERE x_orders.order_id = x_items.order_id)""",
    "dq_review_score_range": "SELECT review_id, review_score FROM x_reviews WHERE review_score NOT BETWEEN 1 AND 5",
    "dq_negative_revenue": "SELECT customer_id, total_revenue FROM g_customers WHERE total_revenue < 0",
    "dq_order_value": "SELECT order_id, total_order_value FROM g_orders WHERE total_order_value <= 0",
    "dq_order_customer": "SELECT order_id, customer_id FROM g_orders WHERE customer_id IS NULL",
    "dq_starter_not_null": "SELECT CAST(NULL AS BIGINT) AS id FROM orders WHERE o_orderstatus = 'P'",
    "dq_freshness": """SELECT max(order_purchase_timestamp) AS newest, max(order_estimated_delivery_date) AS checked_at,
        date_diff('second', max(order_purchase_timestamp), max(order_estimated_delivery_date)) / 3600.0::DOUBLE AS age_hours,
        'error' AS status FROM x_orders""",
    "orders_load_audit": """SELECT count(*) AS rows_loaded, 2 * count(*) AS rows_in_table FROM x_orders""",
    "sellers_replaced": "SELECT seller_id, seller_zip_code_prefix, seller_city, upper(seller_state) AS seller_state FROM x_sellers",
    "orders_by_month": """SELECT strftime(order_purchase_timestamp, '%Y%m') AS ym, order_id, order_status,
        order_purchase_timestamp FROM g_orders""",
    "reviews_from_csv": """SELECT review_id, order_id, review_score, review_comment_title,
        trim(review_comment_message) || chr(10) || 'said "no", twice' AS review_comment_message,
        review_creation_date, review_answer_timestamp FROM x_reviews""",
    "categories_from_csv": "SELECT product_category_name, product_category_name_english FROM x_category",
}
QUERIES |= {
    "dq_flights_not_null": "SELECT * FROM u_flights WHERE event_time IS NULL OR icao24 IS NULL OR origin_country IS NULL",
    "dq_summary_not_null": """SELECT origin_country, count(*) AS total_flights FROM u_flights
        WHERE latitude IS NOT NULL AND baro_altitude IS NOT NULL AND origin_country IS NULL GROUP BY origin_country""",
    "dq_starter_unique": f"""SELECT id, count(*) AS n_records FROM ({QUERIES['starter_union']}) ids
        WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1""",
    "dq_refunded_customers": "SELECT customer_id, total_revenue FROM u_customers WHERE total_revenue < 0",
    "dq_order_value_unclamped": "SELECT order_id, total_order_value FROM u_values WHERE total_order_value <= 0",
    "dq_order_customer_missing": """SELECT order_id, CAST(NULL AS STRING) AS customer_id FROM s_orders
        WHERE NOT is_canceled AND customer_id LIKE 'none-%'""",
    "flight_quarantine": """SELECT '{"time": ' || CAST(event_id AS STRING) AS body FROM events
        WHERE event_id % 31 = 0""",
    "employees_from_csv": QUERIES["employees_clean"],
    **{f"{name}_from_csv": QUERIES[f"raw_{name}"] for name in (
        "customers", "sellers", "products", "orders", "order_items", "payments")},
}
QUERIES |= {
    "fct_orders_table_upsert": """SELECT * FROM g_orders WHERE order_purchase_timestamp >= TIMESTAMP '2000-07-01 00:00:00'
        UNION ALL SELECT * FROM g_orders_before WHERE order_id NOT IN (SELECT order_id FROM g_orders
            WHERE order_purchase_timestamp >= TIMESTAMP '2000-07-01 00:00:00')""",
    "newer_orders_by_state": QUERIES["newer_orders"],
    "reviews_from_quoted_csv": QUERIES["reviews_from_csv"],
    **{f"{name}_on_tables": QUERIES[name] for name in (
        "gold_fct_orders", "gold_dim_customers", "gold_dim_products", "gold_dim_sellers")},
    "dq_relationships_reviews": """SELECT review_id, order_id FROM x_reviews
        WHERE NOT EXISTS (SELECT 1 FROM x_orders WHERE x_orders.order_id = x_reviews.order_id)""",
    **{f"dq_freshness_{status}": f"""SELECT max(order_purchase_timestamp) AS newest,
        max(order_purchase_timestamp) + INTERVAL '{hours}' HOUR AS checked_at, {hours}.0::DOUBLE AS age_hours,
        '{status}' AS status FROM x_orders""" for status, hours in (("pass", 24), ("warn", 30))},
    "raw_flights_summary": QUERIES["gold_flight_summary"].replace(
        "FROM x_flights WHERE", f"FROM ({QUERIES['flight_states']}) raw_flights WHERE"
    ),
    "flight_body_quarantine": """SELECT '{"time":' || chr(10) || ' ' || CAST(event_id AS STRING) AS body FROM events
        WHERE event_id % 311 = 0""",
}
QUERIES["flight_ingest"] = QUERIES["flight_ingest_bodies"] = QUERIES["flight_states"].replace(
    "FROM events", ", strftime(ts, '%Y%m') AS ym FROM events"
)


def oracle_sql() -> dict[str, str]:
    return {name: with_views(query) for name, query in QUERIES.items()}
