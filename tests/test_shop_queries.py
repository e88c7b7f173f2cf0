"""Queries over totals against the same queries over single joined rows.

One order, product and seller hold a third of the items, one order a third of
the reviews, and dimensions carry repeated keys.
"""

import random

import duckdb
import pytest

from stratalake.plans import shop_queries as q

rng = random.Random(11)


def hot(n):
    return "0" if rng.random() < 0.33 else str(rng.randrange(n))


ITEMS = [(hot(80), i, hot(30), hot(25), round(rng.uniform(-5, 500), 2) if i % 50 else None) for i in range(1500)]
REVIEWS = [(f"r{i}" if i % 9 else None, hot(90), rng.choice([0, 1, 2, 3, 4, 5, None])) for i in range(150)]
PRODUCTS = [(str(i % 32), f"c{i % 5}") for i in range(35)]
SELLERS = [(str(i), f"city{i % 4}", f"state{i % 3}") for i in range(27)] + [("1", "city1", "state1")]

QUERIES = {
    "category_top_sold": (lambda t: q.category_top_sold(t["items"], t["products"]), """
        SELECT product_category_name, count(*) AS total_items_sold, sum(price)::DOUBLE AS total_revenue
        FROM items JOIN products USING (product_id) GROUP BY ALL"""),
    "category_top_revenue": (lambda t: q.category_top_revenue(t["items"], t["products"]), """
        SELECT product_category_name, count(*) AS total_items_sold, sum(price)::DOUBLE AS total_revenue,
        floor(avg(price) * 100 + 0.5) / 100 AS avg_price_per_item
        FROM items JOIN products USING (product_id) GROUP BY ALL"""),
    "seller_top_revenue": (lambda t: q.seller_top_revenue(t["items"], t["sellers"]), """
        SELECT seller_id, seller_city, seller_state, count(DISTINCT order_id) AS total_orders,
        sum(price)::DOUBLE AS total_revenue FROM items JOIN sellers USING (seller_id) GROUP BY ALL
        ORDER BY total_revenue DESC, seller_id LIMIT 10"""),
    "seller_state_summary": (lambda t: q.seller_state_summary(t["items"], t["sellers"]), """
        SELECT seller_state, count(DISTINCT seller_id) AS total_sellers, sum(price)::DOUBLE AS total_revenue,
        floor(sum(price)::DOUBLE / count(DISTINCT seller_id) * 100 + 0.5) / 100 AS avg_revenue_per_seller
        FROM items JOIN sellers USING (seller_id) GROUP BY ALL"""),
    "seller_rank_in_state": (lambda t: q.seller_rank_in_state(t["items"], t["sellers"]), """
        SELECT seller_state, seller_id, sum(price)::DOUBLE AS total_revenue,
        rank() OVER (PARTITION BY seller_state ORDER BY sum(price) DESC) AS rank_in_state
        FROM items JOIN sellers USING (seller_id) GROUP BY seller_state, seller_id QUALIFY rank_in_state <= 3"""),
    "category_worst_reviewed": (
        lambda t: q.category_worst_reviewed(t["reviews"], t["items"], t["products"]), """
        SELECT product_category_name, floor(avg(review_score) * 100 + 0.5) / 100 AS avg_review_score,
        count(*) AS total_reviews FROM reviews JOIN items USING (order_id) JOIN products USING (product_id)
        GROUP BY ALL HAVING count(*) >= 30"""),
    "seller_worst_reviewed": (
        lambda t: q.seller_worst_reviewed(t["items"], t["sellers"], t["reviews"], 5), """
        SELECT seller_id, seller_state, count(DISTINCT order_id) AS total_orders,
        floor(avg(review_score) * 100 + 0.5) / 100 AS avg_review_score
        FROM items JOIN sellers USING (seller_id) JOIN reviews USING (order_id)
        GROUP BY ALL HAVING count(DISTINCT order_id) >= 5 ORDER BY avg_review_score, seller_id LIMIT 10"""),
    "product_top_sold": (lambda t: q.product_top_sold(t["items"], t["products"], t["reviews"]), """
        SELECT product_id, product_category_name, count(*) AS total_items_sold,
        sum(price)::DOUBLE AS total_revenue, floor(avg(review_score) * 100 + 0.5) / 100 AS avg_review_score
        FROM items JOIN products USING (product_id) LEFT JOIN reviews USING (order_id)
        GROUP BY ALL ORDER BY total_items_sold DESC, product_id LIMIT 10"""),
    "review_score_distribution": (lambda t: q.review_score_distribution(t["reviews"]), """
        SELECT review_score, count(*) AS total_reviews,
        floor(count(*) * 100.0::DOUBLE / sum(count(*)) OVER () * 100 + 0.5) / 100 AS pct_of_total
        FROM reviews GROUP BY ALL"""),
}


@pytest.fixture(scope="module")
def shop(spark):
    return {
        "items": spark.createDataFrame(
            ITEMS, "order_id string, order_item_id int, product_id string, seller_id string, price double"
        ).repartition(5),
        "reviews": spark.createDataFrame(REVIEWS, "review_id string, order_id string, review_score int"),
        "products": spark.createDataFrame(PRODUCTS, "product_id string, product_category_name string"),
        "sellers": spark.createDataFrame(SELLERS, "seller_id string, seller_city string, seller_state string"),
    }


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name, ddl, rows in (
        ("items", "order_id TEXT, order_item_id INT, product_id TEXT, seller_id TEXT, price DECIMAL(18,4)", ITEMS),
        ("reviews", "review_id TEXT, order_id TEXT, review_score INT", REVIEWS),
        ("products", "product_id TEXT, product_category_name TEXT", PRODUCTS),
        ("sellers", "seller_id TEXT, seller_city TEXT, seller_state TEXT", SELLERS),
    ):
        con.execute(f"CREATE TABLE {name} ({ddl})")
        con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[0]))})", rows)
    return con


def joined_broadly(spark, on):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20) if on else "-1")


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("name", QUERIES)
def test_totals_equal_single_rows(spark, shop, con, name, broadcast):
    build, sql = QUERIES[name]
    joined_broadly(spark, broadcast)
    try:
        df = build(shop)
        got = [r.asDict() for r in df.collect()]
    finally:
        joined_broadly(spark, True)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    want = [dict(zip(names, r)) for r in cursor.fetchall()]

    def key(r):
        return sorted((k, str(v)) for k, v in r.items())

    assert sorted(got, key=key) == sorted(want, key=key)
