"""Hand-computed cases for the silver and gold models."""

import datetime

import pytest
from pyspark.sql import functions as F

from stratalake.operators.grouping import totals_and_distincts, totals_and_distincts_of
from stratalake.plans import gold, shop_extras, silver

ts = datetime.datetime
DAY = ts(2018, 1, 1, 23, 0)


@pytest.fixture(scope="module")
def shop(spark):
    """Orders: 1 two types and two reviews, 2 without items, 3 canceled, 4 loaded twice."""
    def order(i, customer, status, bought=DAY, approved=None):
        return (i, customer, status, bought, approved, None, None, DAY)

    orders = [
        order("1", "a", "delivered", approved=ts(2018, 1, 2, 1, 30)),
        order("2", "a", "shipped", bought=ts(2018, 1, 2, 1, 0)),
        order("3", "b", "canceled"),
        order("4", "b", "delivered"),
        order("4", "b", "delivered"),
        order("5", "b", None),
    ]
    items = [
        ("1", 1, "p", "s", DAY, 10.0, 1.5), ("1", 2, "q", "s", DAY, -5.0, None),
        ("1", 2, "q", "t", DAY, 2.25, -1.0), ("4", 1, "p", "t", DAY, 7.0, 0.0),
        (None, 1, "p", "t", DAY, 1.0, 1.0),
    ]
    pays = [
        ("1", 1, "voucher", 1, 3.0), ("1", 2, "boleto", 1, 4.0), ("1", 3, "voucher", 1, -9.0),
        ("3", 1, "boleto", 1, 8.0), ("4", 1, None, 1, None),
    ]
    reviews = [("r1", "1", 9), ("r2", "1", 0), (None, "1", None), ("r4", "4", 4)]
    customers = [("a", "ua", 1, "mogi-guacu", " sp "), ("b", "ub", 2, "x", "rj"), ("c", "uc", 3, "y", "rj")]

    def make(rows, ddl):
        return spark.createDataFrame(rows, ddl)

    stamp = "timestamp_ntz"
    return {
        "orders": silver.fact_orders(make(
            orders,
            f"order_id string, customer_id string, order_status string, order_purchase_timestamp {stamp}, "
            f"order_approved_at {stamp}, order_delivered_carrier_date {stamp}, "
            f"order_delivered_customer_date {stamp}, order_estimated_delivery_date {stamp}")),
        "items": silver.fact_order_items(make(
            items, f"order_id string, order_item_id int, product_id string, seller_id string, "
            f"shipping_limit_date {stamp}, price double, freight_value double")),
        "payments": silver.fact_payments(make(
            pays, "order_id string, payment_sequential int, payment_type string, "
            "payment_installments int, payment_value double")),
        "reviews": silver.fact_reviews(make(
            [(*r, "", "", DAY, None) for r in reviews],
            "review_id string, order_id string, review_score int, review_comment_title string, "
            f"review_comment_message string, review_creation_date {stamp}, review_answer_timestamp {stamp}")),
        "customers": silver.dim_customers(make(
            customers, "customer_id string, customer_unique_id string, customer_zip_code_prefix bigint, "
            "customer_city string, customer_state string")),
        "sellers": make([("s", "S", "A"), ("t", "T", "B"), ("u", "U", "C")],
                        "seller_id string, seller_city string, seller_state string"),
        "products": make([("p", "k1", "e1", 1, 1, 1, 1), ("z", "k2", "e2", 1, 1, 1, 1)],
                         "product_id string, product_category_name string, product_category_english string, "
                         "product_weight_g bigint, product_length_cm bigint, product_height_cm bigint, "
                         "product_width_cm bigint"),
    }


def by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_silver_flags(shop):
    rows = [r.asDict() for r in shop["orders"].collect()]
    one = next(r for r in rows if r["order_id"] == "1")
    assert (one["is_delivered"], one["is_canceled"], one["approval_hours"]) == (True, False, 2.5)
    five = next(r for r in rows if r["order_id"] == "5")
    assert (five["is_delivered"], five["is_canceled"], five["approval_hours"]) == (False, False, None)


def test_fct_orders(shop):
    got = by(gold.fct_orders(shop["orders"], shop["items"], shop["payments"], shop["reviews"]), "order_id")
    assert sorted(got) == ["1", "2", "4", "5"]
    one = got["1"]
    assert (one["item_count"], one["unique_products"], one["unique_sellers"]) == (2, 2, 2)
    assert (one["total_price"], one["total_freight"], one["total_order_value"]) == (12.25, 1.5, 13.75)
    assert (one["total_payment"], one["payment_method_count"]) == (7.0, 2)
    assert one["payment_types"] == ["boleto", "voucher"]
    assert (one["avg_review_score"], one["review_count"]) == (3.0, 2)
    two = got["2"]
    assert (two["item_count"], two["total_price"], two["payment_types"]) == (0, None, None)
    assert (two["total_payment"], two["avg_review_score"], two["review_count"]) == (0.0, 0.0, 0)
    four = got["4"]  # the doubled order doubles its items, not its payments
    assert (four["item_count"], four["total_price"], four["total_payment"]) == (1, 14.0, 0.0)
    assert four["payment_types"] == [] and four["payment_method_count"] == 0


def test_dim_customers(shop):
    df = gold.dim_customers(shop["customers"], shop["orders"], shop["payments"], shop["reviews"])
    got = by(df, "customer_id")
    a, b, c = got["a"], got["b"], got["c"]
    assert a["customer_city"] == "Mogi-Guacu" and a["customer_state"] == "SP"
    assert (a["total_orders"], a["delivered_orders"], a["delivery_rate"]) == (2, 1, 0.5)
    assert (a["total_revenue"], a["avg_review_score"]) == (7.0, 1.5)  # a missing review counts as 0
    assert a["customer_tenure_days"] == 1  # two hours, one midnight
    assert (b["total_orders"], b["canceled_orders"], b["delivered_orders"]) == (3, 1, 1)
    assert (b["total_revenue"], b["avg_review_score"]) == (8.0, 2.0)
    assert (c["total_orders"], c["total_revenue"], c["first_order_date"]) == (0, None, None)
    assert (c["delivery_rate"], c["customer_tenure_days"], c["avg_review_score"]) == (0.0, 0, None)


def test_dim_products_and_sellers(shop):
    products = by(gold.dim_products(shop["products"], shop["items"]), "product_id")
    assert products["p"]["total_orders"] == 2 and products["p"]["total_sellers"] == 2
    assert products["p"]["total_revenue"] == 18.0 and products["p"]["total_freight"] == 2.5
    assert products["z"]["total_orders"] == 0 and products["z"]["total_revenue"] == 0.0
    sellers = by(gold.dim_sellers(shop["sellers"], shop["items"], shop["reviews"]), "seller_id")
    s, t, u = sellers["s"], sellers["t"], sellers["u"]
    # s sold two items of order 1, whose two scored reviews count once per item.
    assert (s["total_orders"], s["unique_products"], s["total_reviews"]) == (1, 2, 4)
    assert s["avg_customer_review"] == 3.0
    assert (t["total_orders"], t["total_reviews"], t["avg_customer_review"]) == (2, 3, 3.33)
    assert (u["total_orders"], u["total_reviews"], u["avg_customer_review"]) == (0, 0, 0.0)


def test_customer_loaded_twice_is_one_row(shop):
    twice = shop["customers"].unionAll(shop["customers"])
    df = gold.dim_customers(twice, shop["orders"], shop["payments"], shop["reviews"])
    got = by(df, "customer_id")
    assert df.count() == 3
    assert (got["a"]["total_orders"], got["a"]["total_revenue"], got["a"]["avg_review_score"]) == (2, 14.0, 1.5)


def test_int_models(shop):
    details = shop_extras.int_order_details(
        shop["orders"], shop["items"], shop["payments"], shop["reviews"]
    )
    rows = by(details, "order_id")
    assert rows["1"]["payment_types"] == "boleto, voucher" and "3" in rows
    per = by(shop_extras.int_customer_orders(shop["customers"], details), "customer_id")
    assert per["a"]["total_orders"] == 2 and per["a"]["total_revenue"] == 13.75
    assert per["c"]["total_revenue"] is None


def test_profit_margin(shop):
    rows = shop_extras.profit_margin(shop["items"]).collect()
    assert sorted(r["profit_margin"] for r in rows) == [0.0, 0.0, 0.85, 1.0, 1.0]


def test_unmatched_category(spark, shop):
    products = shop["products"].drop("product_category_english")
    names = spark.createDataFrame(
        [("k1", "one")], "product_category_name string, product_category_name_english string"
    )
    got = by(silver.dim_products(products, names), "product_id")
    assert got["p"]["product_category_english"] == "one"
    assert got["z"]["product_category_english"] == "unknown"


def test_totals_and_distincts_of_moves_rows_once(spark):
    rows = [(str(i % 5) if i % 11 else None, i % 3 if i % 4 else None, str(i % 7), float(i)) for i in range(200)]
    rows += [("hot", i % 30, None, 1.0) for i in range(300)]
    items = spark.createDataFrame(rows, "k string, a int, b string, v double")
    keys = spark.createDataFrame([("0",), ("0",), ("3",), ("hot",), (None,), ("none",)], "k string")
    parts = [F.sum("v").alias("v"), F.count("*").alias("n")], {"as_": "a", "bs": "b"}
    found = totals_and_distincts_of(keys, items, "k", parts[0], **parts[1])
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    want = totals_and_distincts(items, "k", parts[0], **parts[1]).where("k IN ('0', '3', 'hot')")
    assert found.schema.names == want.schema.names
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    assert ("hot", 300.0, 300, 30, 0) in map(tuple, found.collect())
