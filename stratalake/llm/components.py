"""Connected components by alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import Scratch
from stratalake.operators.joins import spread_join


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        spread_join(both.where("v > u"), least, "u")
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges lead from the larger node ``u`` to the smaller ``v``, and still do after it."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return (
        spread_join(edges, least, "u")
        .select(F.explode(F.array(F.col("u"), F.col("v"))).alias("u"), F.col("m").alias("v"))
        .where("u <> v")
        .distinct()
    )


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows (node, root) of all nodes with an edge, except that the root of each
    component, its least node, has no row. ``edges`` has two columns of one ordered
    type; loops and repeated edges do no harm.

    Each round is a few equi-joins and aggregates that combine before the shuffle; a
    node with a third of all edges is split by the skew join. The number of rounds
    grows with the logarithm of the number of nodes. Each round is written to the
    shared folder, the one before is deleted.
    """
    a, b = (F.col(f"`{c}`") for c in edges.columns)
    now = scratch.keep(
        edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )
    mark = _mark(now)
    while mark[0]:
        after = scratch.keep(_small_star(_large_star(now)))
        scratch.drop(now)
        now, was, mark = after, mark, _mark(after)
        if mark == was:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
