"""SimHash near-duplicates by covering locality-sensitive hashing.

A text's fingerprint has 64 bits, each the majority of that bit over the hashes of
its shingles. Two fingerprints are linked if they differ in at most ``radius`` bits.
To find all such pairs without comparing all rows, each bit position is given a
nonzero vector of ``radius + 1`` bits; for each nonzero vector ``m`` of that many bits
there is one table whose mask holds the positions with an odd product with ``m``. Any
``radius`` differing positions leave a nonzero ``m`` that is even with all of them,
so the pair agrees on that whole mask: no pair within the radius is missed.

Equal fingerprints are collapsed first. A bucket of more than ``BLOCK`` different
fingerprints is cut into blocks and each pair of blocks is one group, so a task
holds at most ``2 * BLOCK`` values at a time, whatever the bucket's size. A group
yields the links of a spanning forest (fewer than its members), not all its pairs,
which leaves the components as they are.

Defined results
* Null, empty and word-free texts have fingerprint zero, linked like any other.
* A text of fewer words than a shingle is one shingle.
* Rows that repeat a ``doc_id`` are nodes of their own with that id. A null ``doc_id``
  is kept as null; a component of null ids only has a null ``component_id``.
* Nothing else of the input is read, so extra columns cannot clash.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from stratalake.llm.common import Scratch, column, packed
from stratalake.llm.components import components

BITS = 64
SEED = 42
#: Fingerprints of one bucket that are compared at a time, and shingle hashes that
#: are counted at a time.
BLOCK = 2048
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int) -> int:
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        digest = xxhash.xxh64_intdigest
        ends = list(accumulate(len(w) + 1 for w in words))
        starts = [0, *ends]
        hashes = [digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[shingle - 1 :])]
    values = np.array(hashes, dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(values), CHUNK):
        part = values[at : at + CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(values), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, a hash of the text, and the fingerprint as a signed number."""

    @pandas_udf("long")
    def udf(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t if isinstance(t, str) else None, shingle) for t in texts], dtype="int64")

    return docs.select(
        column("doc_id").alias("doc_id"), F.xxhash64(column("text")).alias("text_hash"), udf(column("text")).alias("fp")
    )


def masks(radius: int) -> list[int]:
    """One mask per table, as signed numbers; every set of ``radius`` bits avoids one."""
    kinds = (1 << (radius + 1)) - 1
    vector = [1 + i % kinds for i in range(BITS)]
    found = [
        sum(1 << i for i in range(BITS) if (vector[i] & m).bit_count() % 2) for m in range(1, kinds + 1)
    ]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in found]


def forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect just those values that pairs within the radius connect."""
    left = np.unique(values)
    found: list[tuple[int, int]] = []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            seed = queue.pop()
            near = np.bitwise_count((left ^ seed).view(np.uint64)) <= radius
            if near.any():
                reached = left[near]
                left = left[~near]
                found += [(int(seed), int(x)) for x in reached]
                queue += list(reached)
    return found


def links(prints: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) between different fingerprints, enough for the components."""
    tables = F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key"))
        for t, m in enumerate(masks(radius))
    ])
    keyed = prints.select("fp", F.explode(tables).alias("k")).select("fp", "k.t", "k.key")
    sizes = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    pairs = (
        # Spark takes the exploded rows for as few as the fingerprints and would broadcast them.
        keyed.hint("merge")
        .join(sizes, ["t", "key"])
        .select("t", "key", "fp", blocks.alias("blocks"))
        .select("t", "key", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select("t", "key", "fp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )

    @pandas_udf("array<struct<a:long,b:long>>")
    def linked(groups: pd.Series) -> pd.Series:
        return pd.Series([[{"a": a, "b": b} for a, b in forest(np.asarray(g, dtype=np.int64), radius)] for g in groups])

    groups = pairs.groupBy("t", "key", "i", "j").agg(F.collect_list("fp").alias("fps")).where("size(fps) > 1")
    return groups.select(F.explode(linked("fps")).alias("e")).select("e.a", "e.b").distinct()


def near_duplicates(
    docs: DataFrame, scratch: Scratch, *, shingle: int = 4, radius: int = 4
) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id of each row, with text_hash and root:
    the hash of the row's text and the fingerprint that stands for the component."""
    rows = scratch.keep(fingerprints(docs, shingle))
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = components(links(rows.select("fp").distinct(), radius), scratch)
    rooted = least.join(found, least["fp"] == found["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = scratch.keep(rooted)
    # Written, so that the join deals both sides out anew and splits a large component.
    ids = scratch.keep(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    classes = rooted.join(ids, "root").select("fp", "root", "component_id")
    return rows.join(classes, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "text_hash",
        "root",
    )


def one_of_each(docs: DataFrame, scratch: Scratch, *, shingle: int = 4, radius: int = 4) -> DataFrame:
    """The documents of ``docs`` without near-duplicates: of each component the row of
    the least doc_id stays (null ids last), of several such the least text hash."""
    rows = near_duplicates(docs, scratch, shingle=shingle, radius=radius)
    first = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", F.coalesce("text_hash", F.lit(0)).alias("h"))
    kept = rows.groupBy("root").agg(F.min(first).alias("k")).select("k.doc_id", "k.h").distinct()
    held = docs.select(
        packed(docs).alias("row"),
        column("doc_id").alias("doc_id"),
        F.coalesce(F.xxhash64(column("text")), F.lit(0)).alias("h"),
    )
    same = F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("d.h") == F.col("k.h"))
    joined = held.alias("d").join(kept.alias("k"), same, "left_semi").dropDuplicates(["doc_id", "h"])
    return joined.select(*[F.col("row")[c].alias(c) for c in docs.columns])
