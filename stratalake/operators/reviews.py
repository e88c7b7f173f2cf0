"""Reviews reduced to one row per order, for joins that would multiply rows.

An average over reviews joined to items needs, per order, only the sum and the
counts: weighting them by the joined rows gives the same result as joining every
review to every item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def review_totals(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        F.count("*").alias("reviews"),
        F.count("review_id").alias("id_count"),
        F.count("review_score").alias("score_count"),
        F.sum("review_score").alias("score_sum"),
    )
