"""Mixing sources to target weights by Poisson replication.

Each source is to hold a given share of the mix. A document of source ``s`` is
repeated as often as a Poisson variable with mean ``size * N * w(s) / n(s)`` says,
where ``N`` counts all documents, ``n(s)`` those of the source and ``w(s)`` is the
source's share. The variable comes from inverting the distribution at a uniform
number hashed from the document's key, so a rerun or a retried task repeats the same
documents as often. A mean above ``PART_MEAN`` is split into equal parts, each with
a number of its own: the sum of Poisson variables is a Poisson variable, and no part
needs a table longer than ``STEPS`` entries.

All work is done by Spark's own functions. The counts per source combine before the
shuffle; documents never meet by source, so a source with a third of all rows costs
no task more than another. The mix is then ordered by a hash over all partitions.

Defined results
* A null source is a source of its own. A null ``doc_id`` is replaced by the hash of
  the text as the document's key.
* Rows that agree in ``doc_id`` are repeated equally often.
* A source without a weight gets ``other``; a weight of zero drops it. Weights of
  sources without documents have no effect on the shares of the others.
* Without documents, or if all weights are zero, the mix is empty.
* Input columns named as a result column are replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import column, others, packed

PART_MEAN = 16.0
#: A Poisson variable of mean 16 is above this less often than once in 10^25.
STEPS = 80
#: Up to so many sources, their rates go to every task; beyond, they are joined by shuffle.
FEW_SOURCES = 10_000
RESULT = ["copy", "copies", "rate", "shuffle_key"]


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 hash."""
    digest = F.md5(F.concat_ws("/", *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def steps(mean: Column) -> Column:
    """P(X <= k) for k from 0 to STEPS, X a Poisson variable."""
    none = F.exp(-mean)
    start = F.struct(none.alias("p"), F.array(none).alias("sums"))

    def add(done: Column, k: Column) -> Column:
        p = done["p"] * mean / k
        return F.struct(
            p.alias("p"),
            F.concat(done["sums"], F.array(F.element_at(done["sums"], -1) + p)).alias("sums"),
        )

    whole = F.sequence(F.lit(1), F.lit(STEPS)).cast("array<double>")
    return F.aggregate(whole, start, add, lambda done: done["sums"])


def rates(
    docs: DataFrame, weights: dict[str | None, float] | None, other: float, size: float
) -> DataFrame:
    """One row per source: rate, number of parts, and the distribution of one part."""
    weight = F.lit(float(other))
    if weights is None:
        weight = F.lit(1.0)
    else:
        for name, value in weights.items():
            weight = F.when(column("source").eqNullSafe(F.lit(name)), float(value)).otherwise(weight)
    counts = docs.groupBy(column("source").alias("source")).agg(F.count("*").alias("n"))
    counts = counts.select("source", "n", weight.alias("weight"))
    total = counts.agg(F.sum("n").cast("double")).scalar()
    weighed = counts.agg(F.sum("weight")).scalar()
    rate = F.lit(float(size)) * total * F.col("weight") / weighed / F.col("n")
    return (
        counts.where("weight > 0")
        .select("source", rate.alias("rate"))
        .withColumn("parts", F.greatest(F.ceil(F.col("rate") / PART_MEAN), F.lit(1)).cast("int"))
        .withColumn("sums", steps(F.col("rate") / F.col("parts")))
    )


def mix(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    *,
    other: float = 0.0,
    size: float = 1.0,
    seed: int = 42,
) -> DataFrame:
    """The documents of the mix in random order, one row per copy.

    ``weights`` maps a source to its weight (none: all sources alike); ``size`` is the
    expected size of the mix as a share of the number of documents. Adds ``copy``
    (from 1), ``copies``, ``rate`` (the source's mean) and ``shuffle_key``, by which
    the rows are ordered over all partitions.
    """
    per_source = rates(docs, weights, other, size)
    known = per_source.select("source").limit(FEW_SOURCES + 1).count()
    if known <= FEW_SOURCES:
        per_source = F.broadcast(per_source)
    key = F.coalesce(
        column("doc_id").cast("string"),
        F.concat(F.lit("text "), F.md5(F.coalesce(column("text"), F.lit("")))),
    )
    rows = docs.select(packed(docs).alias("row"), key.alias("key"), column("source").alias("source"))
    seeded = F.lit(str(seed))
    draws = F.aggregate(
        F.sequence(F.lit(1), F.col("parts")),
        F.lit(0),
        lambda n, i: n
        + F.size(
            F.filter("sums", lambda s: s <= uniform(F.col("key"), seeded, i.cast("string")))
        ),
    )
    drawn = (
        rows.alias("d")
        .join(per_source.alias("r"), F.col("d.source").eqNullSafe(F.col("r.source")))
        .select("row", "key", "rate", draws.alias("copies"))
        .where("copies > 0")
        .select("*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    )
    order = F.md5(F.concat_ws("/", F.lit("order"), seeded, F.col("key"), F.col("copy").cast("string")))
    kept = [F.col("row")[c].alias(c) for c in others(docs, RESULT)]
    spread = drawn.select(*kept, "copy", "copies", "rate", order.alias("shuffle_key"))
    return spread.repartitionByRange("shuffle_key").sortWithinPartitions("shuffle_key")


SQL = """
WITH RECURSIVE n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
r AS (SELECT source, CAST(1.0 AS DOUBLE) * (SELECT CAST(sum(n) AS DOUBLE) FROM n)
        * CAST(1.0 AS DOUBLE) / (SELECT CAST(count(*) AS DOUBLE) FROM n) / n AS rate FROM n),
m AS (SELECT source, rate, greatest(CAST(ceil(rate / 16.0) AS INT), 1) AS parts FROM r),
p AS (SELECT source, rate / parts AS mean, 0 AS k, exp(-(rate / parts)) AS p, exp(-(rate / parts)) AS s FROM m
      UNION ALL SELECT source, mean, k + 1, p * mean / (k + 1), s + p * mean / (k + 1) FROM p WHERE k < 80),
t AS (SELECT source, list(s ORDER BY k) AS sums FROM p GROUP BY source),
d AS (SELECT d.*, m.rate, m.parts, t.sums,
        coalesce(CAST(d.doc_id AS VARCHAR), 'text ' || md5(coalesce(d.text, ''))) AS key
      FROM documents d JOIN m ON d.source IS NOT DISTINCT FROM m.source
      JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, CAST(list_sum(list_transform(range(1, parts + 1), lambda i: len(list_filter(sums, lambda x: x <=
        CAST(CAST('0x' || substr(md5(key || '/42/' || CAST(i AS VARCHAR)), 1, 13) AS BIGINT) AS DOUBLE)
        / 4503599627370496.0)))) AS INT) AS copies FROM d),
e AS (SELECT *, CAST(unnest(range(1, copies + 1)) AS INT) AS copy FROM c WHERE copies > 0)
SELECT doc_id, text, lang, source, n_chars, copy, copies, rate,
       md5('order/42/' || key || '/' || CAST(copy AS VARCHAR)) AS shuffle_key
FROM e
"""
