"""Exact median without gathering the values in one task."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from stratalake.session import shared_dir

#: Values that the driver sorts itself, and rows of the sample that brackets the middle.
FEW, SAMPLE, SEED = 20_000, 20_000, 42


def exact_median(df: DataFrame, column: str) -> float | None:
    """The median of a numeric column, NULL and NaN left out.

    ``F.median`` merges every distinct value into one buffer of one task. Here the column is
    written once, and counted by that write. A seeded sample of it brackets the middle between two
    of its values; one pass counts the rows below, at, between and above the ends, and
    writes those between, which holds a few hundredths of the rows. If the middle is an end, that is
    the answer; else the search goes on in the part that holds it, which lacks the ends and so
    always has fewer different values. The sample decides only how large that part is.

    Values are compared, never subtracted, so there is no range in which it fails.
    """
    x = F.col("x")
    values = df.select(F.col(column).cast("double").alias("x")).where(x.isNotNull() & ~F.isnan(x))
    folder = f"{shared_dir(df.sparkSession)}/median-{uuid.uuid4().hex}"
    part, n = _written(values, f"{folder}/0")
    if not n:
        return None
    below, beyond, level = (n - 1) // 2, None, 0
    even = n % 2 == 0
    while n > FEW:
        low, high = _bracket(part, n, below)
        level += 1
        inner, counted = _split(part, low, high, f"{folder}/{level}")
        # Ranges in order: below low, low, between, high, above; those of the ends hold one value each.
        places = [("below", None), ("at_low", low), ("between", None), ("at_high", high), ("above", None)]
        for name, value in places:
            if below < counted[name]:
                break
            below -= counted[name]
        # The least value behind the part, should the second middle one lie there.
        behind = {
            "below": low,
            "at_low": _first(counted["least_between"], high if high > low else counted["least_above"], beyond),
            "between": high,
            "at_high": _first(counted["least_above"], beyond),
            "above": beyond,
        }[name]
        if value is not None:
            second = value if not even or below + 1 < counted[name] else behind
            return value if second == value else (value + second) / 2
        n, beyond = counted[name], behind
        if name == "between":
            part = inner
        else:
            level += 1
            part, n = _written(part.where(x < low if name == "below" else x > high), f"{folder}/{level}")
    some = sorted(row["x"] for row in part.collect())  # at most FEW
    first = some[below]
    second = first if not even else some[below + 1] if below + 1 < n else beyond
    return first if second == first else (first + second) / 2


def _first(*values: float | None) -> float | None:
    return next((v for v in values if v is not None), None)


def _written(values: DataFrame, path: str) -> tuple[DataFrame, int]:
    counted = Observation()
    values.observe(counted, F.count(F.lit(1)).alias("n")).write.parquet(path)
    return values.sparkSession.read.schema("x double").parquet(path), counted.get["n"]


def _bracket(part: DataFrame, n: int, below: int) -> tuple[float, float]:
    """Two values of the part that are likely to have the row with so many rows below between them."""
    some = sorted(row["x"] for row in part.sample(min(1.0, SAMPLE / n), seed=SEED).collect())
    if not some:
        some = [part.first()["x"]]
    middle, spread = (below + 0.5) / n * len(some), 4 * math.sqrt(len(some)) / 2
    last = len(some) - 1
    return some[min(max(int(middle - spread), 0), last)], some[min(max(math.ceil(middle + spread), 0), last)]


def _split(part: DataFrame, low: float, high: float, path: str) -> tuple[DataFrame, dict]:
    """The rows strictly between the ends, written, and the counts of all five ranges."""
    x = F.col("x")
    between, counted = (x > low) & (x < high), Observation()
    observed = part.observe(
        counted,
        F.count_if(x < low).alias("below"),
        F.count_if(x == low).alias("at_low"),
        F.count_if(between).alias("between"),
        F.count_if((x == high) & (x != low)).alias("at_high"),
        F.count_if(x > high).alias("above"),
        F.min(F.when(between, x)).alias("least_between"),
        F.min(F.when(x > high, x)).alias("least_above"),
    )
    observed.where(between).write.parquet(path)
    return part.sparkSession.read.schema("x double").parquet(path), counted.get
