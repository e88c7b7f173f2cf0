"""Quality rules judged by an isolation forest over rule statistics.

Two fixed rules come first (too few words, too many words in repeated three-word
windows). What they leave is described by the statistics of the usual rules as logarithms
of shares (see ``stats``), and an isolation forest scores how soon random splits of these
isolate a document from others. The forest grows on a sample of at most ``SAMPLE``
labelled documents of the table, on those that pass the base rules; small trees
(``PER_TREE``) keep kinds of junk that occur several times from hiding one another. The
threshold is set on all labelled documents: the lowest multiple of ``1 / GRID`` at which at
least ``KEEP`` of the good ones that pass the base rules stay. Scores are counted per
multiple and document before they meet the labels, so that no text is moved and no id
crowds a task. Both are small models on the driver; the statistics of all documents
are computed and scored in one map without a shuffle, once for the threshold (ids and
scores alone) and once for the verdict.

Defined results
* Null and word-free texts have no words and fail the base rules.
* Without labelled good documents that pass the base rules there is no forest: what
  passes these stays.
* Labels with null id or quality, or of no document of the table, are not used. Of several
  labels of one document, the lowest counts. Repeated rows are judged alike, and each of them
  counts for the threshold; extra columns are passed on, those
  named as a result column are replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from stratalake.llm.common import column, others, packed
from stratalake.llm.isolation import Forest

#: Labelled documents the forest grows on, at most, by the order of a hash.
SAMPLE = 6000
TREES, PER_TREE, SEED = 300, 16, 42
#: Added to a share before the logarithm is taken.
LEAST = 0.01
#: Share of the good documents that must stay.
KEEP = 0.995
#: Steps of the threshold: so many counts at most come to the driver.
GRID = 1 << 16
LEAST_WORDS = 50
SYMBOL = re.compile(r"[#*$%&|<>]")
RESULT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"


@dataclass
class Stats:
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    features: list[float]

    @property
    def base_failed(self) -> bool:
        return self.n_words < LEAST_WORDS or 100 * self.n_repeat_words > 50 * self.n_words


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of three that occur at least twice in the text."""
    if len(words) < 3:
        return 0
    seen: dict[tuple[bytes, bytes, bytes], int] = {}
    windows = list(zip(words, words[1:], words[2:]))
    number = [seen.setdefault(w, len(seen)) for w in windows]
    if len(seen) == len(number):
        return 0
    which = np.array(number)
    again = np.bincount(which)[which] > 1
    inside = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        inside[shift : shift + len(again)] |= again
    return int(inside.sum())


def stats(text: str | None) -> Stats:
    text = text or ""
    words = text.encode().split()
    n = len(words)
    # Code points: all bytes but those that continue a character.
    joined = b"".join(words)
    word_chars = len(joined.decode())
    symbols = len(SYMBOL.findall(text))
    lines = [line for line in text.split("\n") if line.encode().split()]
    dup = len(lines) - len(set(lines))
    repeat = repeated_words(words)
    upper = sum(map(len, re.findall(r"[A-Z]+", text)))
    marks = sum(map(len, re.findall(r"[^\w\s]+", text)))
    per_char = 1.0 / max(word_chars, 1)
    shares = [
        word_chars / max(n, 1),
        symbols / max(n, 1),
        dup / max(len(lines), 1),
        repeat / max(n, 1),
        upper * per_char,
        marks * per_char,
    ]
    return Stats(n, word_chars, symbols, dup, repeat, [math.log(x + LEAST) for x in shares])


@dataclass
class Model:
    forest: Forest
    threshold: float

    def score(self, features: np.ndarray) -> np.ndarray:
        return self.forest.score(features)


def known_quality(labels: DataFrame) -> DataFrame:
    """doc_id and quality, one row per labelled document."""
    return (
        labels.where(column("doc_id").isNotNull() & column("quality").isNotNull())
        .groupBy(column("doc_id").alias("doc_id"))
        .agg(F.min(column("quality")).alias("quality"))
    )


def labelled_sample(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Text of at most SAMPLE of the documents that have a label."""
    texts = docs.select(column("doc_id").alias("doc_id"), column("text").alias("text"))
    present = texts.select("doc_id").distinct()
    chosen = known.join(present, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    return texts.join(F.broadcast(chosen.select("doc_id")), "doc_id")


def train(sample: DataFrame) -> Forest | None:
    """A forest of the sample's documents that pass the base rules.

    The sample's features come to the driver: at most SAMPLE rows, one per id.
    """

    @pandas_udf("base_failed boolean, features array<double>")
    def udf(texts: pd.Series) -> pd.DataFrame:
        found = [stats(t if isinstance(t, str) else None) for t in texts]
        return pd.DataFrame({"base_failed": [s.base_failed for s in found], "features": [s.features for s in found]})

    rows = sample.select("doc_id", udf("text").alias("s")).groupBy("doc_id").agg(F.min("s").alias("s")).orderBy("doc_id").collect()
    # Not a filter on the DataFrame, which would run the UDF on all rows before the join.
    passing = [r["s"]["features"] for r in rows if not r["s"]["base_failed"]]
    return Forest.grow(np.array(passing), TREES, PER_TREE, SEED) if passing else None


def calibrated(docs: DataFrame, known: DataFrame, forest: Forest) -> float | None:
    """The lowest multiple of 1 / GRID that keeps KEEP of all good documents; none: no good one."""

    @pandas_udf("long")
    def step(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = [stats(t if isinstance(t, str) else None) for t in texts]
            passing = [i for i, s in enumerate(found) if not s.base_failed]
            out = pd.Series([None] * len(found), dtype="Int64")
            if passing:
                scores = forest.score(np.array([found[i].features for i in passing]))
                out.iloc[passing] = np.ceil(scores * GRID).astype(np.int64)
            yield out

    scored = docs.select(column("doc_id").alias("doc_id"), step(column("text")).alias("step"))
    # Nulls, of documents that fail the base rules, are left out at the end: a filter on the step
    # would run the UDF a second time.
    counts = (
        scored.groupBy("doc_id", "step")
        .agg(F.count("*").alias("n"))
        .join(known.where("quality > 0"), "doc_id", "left_semi")
        .groupBy("step")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    counts = sorted((r for r in counts if r["step"] is not None), key=lambda r: r["step"])
    if not counts:
        return None
    upto = np.cumsum([r["n"] for r in counts])
    return counts[int(np.searchsorted(upto, KEEP * upto[-1]))]["step"] / GRID


def fitted(docs: DataFrame, labels: DataFrame) -> Model | None:
    known = known_quality(labels)
    forest = train(labelled_sample(docs, known))
    threshold = calibrated(docs, known, forest) if forest else None
    return None if threshold is None else Model(forest, threshold)


def judge(docs: DataFrame, model: Model | None) -> DataFrame:
    """The columns of ``docs`` with the statistics, ``score`` and ``kept``."""

    @pandas_udf(f"{STATS}, score double, kept boolean")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [stats(t if isinstance(t, str) else None) for t in texts]
            out = pd.DataFrame({name: [getattr(s, name) for s in found] for name in RESULT[:6]})
            if model is None or not found:
                out["score"] = pd.Series([None] * len(found), dtype="float64")
                out["kept"] = ~out["base_failed"].astype(bool)
            else:
                out["score"] = model.score(np.array([s.features for s in found]))
                out["kept"] = ~out["base_failed"] & (out["score"] <= model.threshold)
            yield out

    judged = docs.select(packed(docs).alias("row"), udf(column("text")).alias("judged"))
    return judged.select(
        *[F.col("row")[c].alias(c) for c in others(docs, RESULT)],
        *[F.col("judged")[c].alias(c) for c in RESULT],
    )


def apply_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(docs, fitted(docs, labels))
