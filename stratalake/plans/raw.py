"""Raw layer: text rows from CSV files to typed dimension and fact rows.

Every job maps missing-value texts to NULL, drops repeated rows, and only then
trims, so rows that differ in white space alone stay apart. Rows without a
required key or date are dropped; customers and sellers keep ``unknown`` instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions import na_to_null, strip, to_int, to_number, to_ts
from stratalake.sources import schemas
from stratalake.sources.files import PLACE


def distinct_rows(df: DataFrame) -> DataFrame:
    """Each row once; with a place, at the last one it has."""
    texts = [c for c in df.columns if c != PLACE]
    known = df.select(*[na_to_null(F.col(c)).alias(c) for c in texts], *[PLACE] * (PLACE in df.columns))
    if PLACE not in df.columns:
        return known.dropDuplicates()
    return known.groupBy(*texts).agg(F.max(PLACE).alias(PLACE))


def _text(name: str, missing: str | None = None) -> Column:
    value = strip(F.col(name))
    return value if missing is None else F.coalesce(value, F.lit(missing))


def _money(name: str) -> Column:
    return F.coalesce(to_number(F.col(name)), F.lit(0.0))


def _typed(df: DataFrame, spec: schemas.TableSpec, **values: Column) -> DataFrame:
    """The table's columns in order: given expressions, else trimmed text."""
    return distinct_rows(df).select(
        *[values.get(c, _text(c)).alias(c) for c in spec.columns], *[PLACE] * (PLACE in df.columns)
    )


def customers(df: DataFrame) -> DataFrame:
    texts = ("customer_id", "customer_unique_id", "customer_city", "customer_state")
    return _typed(
        df,
        schemas.DIM_CUSTOMERS,
        customer_zip_code_prefix=to_int(F.col("customer_zip_code_prefix")),
        **{c: _text(c, "unknown") for c in texts},
    )


def sellers(df: DataFrame) -> DataFrame:
    return _typed(
        df,
        schemas.DIM_SELLERS,
        seller_zip_code_prefix=to_int(F.col("seller_zip_code_prefix")),
        **{c: _text(c, "unknown") for c in ("seller_id", "seller_city", "seller_state")},
    )


def products(df: DataFrame) -> DataFrame:
    measures = ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")
    typed = _typed(
        df,
        schemas.DIM_PRODUCTS,
        product_category_name=_text("product_category_name", "unknown"),
        **{c: to_int(F.col(c)) for c in measures},
    )
    return typed.dropna(subset=["product_id"])


def categories(df: DataFrame) -> DataFrame:
    return _typed(df, schemas.DIM_CATEGORY)


def orders(df: DataFrame) -> DataFrame:
    times = [c for c in schemas.FACT_ORDERS.columns if c.endswith(("_timestamp", "_at", "_date"))]
    typed = _typed(df, schemas.FACT_ORDERS, **{c: to_ts(F.col(c)) for c in times})
    required = ["order_id", "order_purchase_timestamp", "order_estimated_delivery_date"]
    return typed.dropna(subset=required)


def order_items(df: DataFrame) -> DataFrame:
    typed = _typed(
        df,
        schemas.FACT_ORDER_ITEMS,
        order_item_id=to_int(F.col("order_item_id"), "int"),
        shipping_limit_date=to_ts(F.col("shipping_limit_date")),
        price=_money("price"),
        freight_value=_money("freight_value"),
    )
    return typed.dropna(subset=["shipping_limit_date"])


def payments(df: DataFrame) -> DataFrame:
    return _typed(
        df,
        schemas.FACT_PAYMENTS,
        payment_sequential=to_int(F.col("payment_sequential"), "int"),
        payment_installments=to_int(F.col("payment_installments"), "int"),
        payment_value=_money("payment_value"),
    )


def reviews(df: DataFrame) -> DataFrame:
    typed = _typed(
        df,
        schemas.FACT_REVIEWS,
        review_score=to_int(F.col("review_score"), "int"),
        review_comment_title=_text("review_comment_title", ""),
        review_comment_message=_text("review_comment_message", ""),
        review_creation_date=to_ts(F.col("review_creation_date")),
        review_answer_timestamp=to_ts(F.col("review_answer_timestamp")),
    )
    return typed.dropna(subset=["review_id", "order_id", "review_creation_date"])
