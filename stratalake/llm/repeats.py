"""Repeated passages by hashes of sparse suffixes.

A passage is ``WORDS`` words or more that occur at least twice, in one text or in
several. Of all suffixes (a text from some word on) only those at minimisers are kept:
the place of the least hash of ``GRAM`` words in each window of ``WINDOW`` places. The
choice looks at the content alone, so each occurrence of a passage keeps a suffix at
the same place, and this lies early enough that ``PREFIX`` words of the passage follow.

1. No suffix is sorted and no neighbours are compared: that is replaced by grouping, as a
   run of equal suffixes may hold a third of all, and counts combine before the shuffle where
   a lag over sorted rows does not. Suffixes are grouped by the hash of their first
   ``PREFIX`` words, then by the hash of their surroundings (what lies within reach of a
   passage: ``WINDOW - 1`` words to the left, ``WORDS`` from the place on). Suffixes whose
   first hash is in no other place have nothing in common with others, and go.
2. A group of equal surroundings matches as far as these reach: all of it repeats.
3. Where one prefix has several surroundings, one suffix of each gives every stretch of
   ``WORDS`` words that has the place as its minimiser; these are grouped by their hashes.
   What is in one group repeats.

The first occurrence of a stretch, by doc_id, text hash and place, is kept; the others
may be cut. Equality is judged by two hashes of 64 bits with different bases.

Defined results
* Null, empty and short texts hold no passage.
* Rows that agree in doc_id and text are one occurrence when it comes to which is
  first: their text repeats, but none of them loses it to the other.
* A null doc_id sorts first. Text hashes tell rows apart that share an id only.
* In a text that overlaps itself (one word a thousand times), all but the beginning is a
  later occurrence.
* Extra columns are passed on; helper columns cannot clash with them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from stratalake.llm.common import WORD_PATTERN, Scratch, column, packed

WORDS = 50
GRAM = 8
WINDOW = 32
PREFIX = WORDS - WINDOW + 1
#: Bytes of text that are worked on at a time (or one longer text).
BYTES = 2_000_000
#: Fixed odd bases of the hashes.
BYTE_BASE, BASE, BASE_2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9
MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads a number over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & MASK, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Stretches:
    """Hashes of stretches of words, from sums over all words before a place."""

    def __init__(self, words: np.ndarray, base: int):
        up = powers(base, len(words))
        self.sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(words * up, dtype=np.uint64)])
        self.down = powers(pow(base, -1, 1 << 64), len(words) + 1)

    def hash(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[first]) * self.down[first])


class Texts:
    """The words of some texts, one after the other: hash, and first word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        """``data``: bytes of all texts; ``offsets``: where each begins, and the end."""
        space = (data == 32) | ((data >= 9) & (data <= 13))
        bound = np.zeros(len(data) + 1, dtype=bool)
        bound[offsets] = True
        begins = ~space
        begins[1:] &= space[:-1] | bound[1:-1]
        starts = np.flatnonzero(begins)
        owner = np.searchsorted(offsets, starts, side="right") - 1
        self.firsts = np.searchsorted(owner, np.arange(len(offsets)))
        self.owner = owner
        if len(starts):
            gaps = np.diff(np.append(starts, len(data)))
            place = np.arange(len(data)) - np.repeat(starts, gaps) if starts[0] == 0 else None
            if place is None:
                place = np.arange(len(data))
                place[starts[0] :] -= np.repeat(starts, gaps)
            inside = np.where(space, 0, data.astype(np.uint64) + np.uint64(1))
            inside = inside * powers(BYTE_BASE, int(place.max()) + 1)[place]
            self.words = mix(np.add.reduceat(inside, starts))
        else:
            self.words = np.empty(0, dtype=np.uint64)
        self.one, self.two = Stretches(self.words, BASE), Stretches(self.words, BASE_2)

    def minimisers(self) -> tuple[np.ndarray, np.ndarray]:
        """Places where a stretch of WORDS words can begin, and the minimiser of its first window."""
        n = len(self.words)
        if n < WORDS:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        ends = self.firsts[self.owner + 1]
        at = np.arange(n)
        grams = self.one.hash(at[: n - GRAM + 1], at[: n - GRAM + 1] + GRAM)
        starts = np.flatnonzero(at + WORDS <= ends)
        windows = np.lib.stride_tricks.sliding_window_view(grams, WINDOW)
        found = np.empty(len(starts), dtype=np.int64)
        for i in range(0, len(starts), 1 << 16):
            part = starts[i : i + (1 << 16)]
            low, high = part[0], part[-1] + 1
            found[i : i + (1 << 16)] = part + windows[low:high].argmin(axis=1)[part - low]
        return starts, found


def texts_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow array of texts; null is empty."""
    array = array.cast(pa.large_string()).fill_null("")
    _, where, data = array.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return data, offsets


def portions(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most BYTES together, or one text."""
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + BYTES, side="right")) - 1
        last = min(max(last, first + 1), len(offsets) - 1)
        yield first, last
        first = last


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _find_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = texts_of(batch.column("text"))
        for first, last in portions(offsets):
            low = offsets[first]
            texts = Texts(data[low : offsets[last]], offsets[first : last + 1] - low)
            at = np.unique(texts.minimisers()[1])
            if not len(at):
                continue
            owner = texts.owner[at]
            left = np.minimum(WINDOW - 1, at - texts.firsts[owner])
            right = np.minimum(WORDS, texts.firsts[owner + 1] - at)
            around = texts.two.hash(at - left, at + right)
            rows = pa.array(owner + first)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id").take(rows),
                "text_hash": batch.column("text_hash").take(rows),
                "place": pa.array((at - texts.firsts[owner]).astype(np.int32)),
                "left": pa.array(left.astype(np.int32)),
                "right": pa.array(right.astype(np.int32)),
                "prefix": signed(texts.one.hash(at, at + PREFIX)),
                "around": signed(around),
            })


def _find_stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stretches of WORDS words that have a wanted place as their minimiser."""
    for batch in batches:
        data, offsets = texts_of(batch.column("text"))
        wanted = batch.column("wanted")
        for first, last in portions(offsets):
            low = offsets[first]
            texts = Texts(data[low : offsets[last]], offsets[first : last + 1] - low)
            part = wanted.slice(first, last - first)
            flat = part.flatten()
            owner = np.repeat(np.arange(last - first), part.value_lengths().to_numpy(zero_copy_only=False))
            at = texts.firsts[owner] + flat.field("place").to_numpy()
            times = np.zeros(len(texts.words) + 1, dtype=np.int64)
            times[at] = flat.field("n").to_numpy()
            begins, chosen = texts.minimisers()
            begins, times = begins[times[chosen] > 0], times[chosen]
            times = times[times > 0]
            owner = texts.owner[begins]
            source = pa.array(owner + first)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id").take(source),
                "text_hash": batch.column("text_hash").take(source),
                "begin": pa.array((begins - texts.firsts[owner]).astype(np.int32)),
                "n": pa.array(times),
                "one": signed(texts.one.hash(begins, begins + WORDS)),
                "two": signed(texts.two.hash(begins, begins + WORDS)),
            })


def _schema(docs: DataFrame, *fields: tuple[str, type]) -> StructType:
    kind = next(f.dataType for f in docs.schema.fields if f.name.lower() == "doc_id")
    found = [StructField("doc_id", kind), StructField("text_hash", LongType())]
    return StructType([*found, *[StructField(name, t()) for name, t in fields]])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        column("doc_id").alias("doc_id"), F.xxhash64(column("text")).alias("text_hash"), column("text").alias("text")
    )


def _occurrence(place: str) -> Column:
    return F.struct("doc_id", "text_hash", F.col(place).alias("place"))


def _same_text(a: str, b: str) -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.text_hash") == F.col(f"{b}.text_hash"))


def covers(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, text_hash, begin, end (in words) and whether it is the first occurrence,
    for stretches that repeat; together they cover all that repeats."""
    texts = _texts(docs)
    integer, long = IntegerType, LongType
    suffixes = scratch.keep(
        texts.mapInArrow(
            _find_suffixes,
            _schema(docs, ("place", integer), ("left", integer), ("right", integer), ("prefix", long), ("around", long)),
        )
    )
    # Written, so that both join sides come straight from a shuffle and a hot prefix is split.
    again = scratch.keep(suffixes.groupBy("prefix").agg(F.count("*").alias("n")).where("n > 1").select("prefix"))
    run = scratch.keep(suffixes.join(again, "prefix", "left_semi"))
    scratch.drop(suffixes)
    equal = scratch.keep(
        run.groupBy("prefix", "around").agg(F.count("*").alias("n"), F.min(_occurrence("place")).alias("first"))
    )
    whole = (
        run.join(equal.where("n > 1").withColumnRenamed("n", "m"), ["prefix", "around"])
        .select(
            "doc_id",
            "text_hash",
            (F.col("place") - F.col("left")).alias("begin"),
            (F.col("place") + F.col("right")).alias("end"),
            (F.col("first") == _occurrence("place")).alias("is_first"),
        )
    )
    kinds = equal.groupBy("prefix").agg(F.count("*").alias("kinds"))
    several = scratch.keep(kinds.where("kinds > 1").select("prefix"))
    wanted = (
        equal.join(several, "prefix", "left_semi")
        .groupBy("first.doc_id", "first.text_hash")
        .agg(F.collect_list(F.struct(F.col("first.place").alias("place"), "n")).alias("wanted"))
    )
    asked = (
        texts.alias("t")
        .join(wanted.alias("w"), _same_text("t", "w"))
        .select("t.doc_id", "t.text_hash", "t.text", "w.wanted")
        .dropDuplicates(["doc_id", "text_hash"])
    )
    stretches = scratch.keep(
        asked.mapInArrow(_find_stretches, _schema(docs, ("begin", integer), ("n", long), ("one", long), ("two", long)))
    )
    key = ["one", "two"]
    repeated = scratch.keep(
        stretches.groupBy(*key)
        .agg(F.sum("n").alias("m"), F.min(_occurrence("begin")).alias("first"))
        .where("m > 1")
        .select(*key, "first")
    )
    part = stretches.join(repeated, key).select(
        "doc_id",
        "text_hash",
        "begin",
        (F.col("begin") + WORDS).alias("end"),
        (F.col("first") == _occurrence("begin")).alias("is_first"),
    )
    return whole.unionByName(part)


def joined(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Intervals that overlap or touch, made one."""
    order = np.argsort(begins, kind="stable")
    begins, ends = begins[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(begins), dtype=bool)
    new[1:] = begins[1:] > ends[:-1]
    first = np.flatnonzero(new)
    return begins[first], ends[np.append(first[1:], len(ends)) - 1] if len(first) else ends[:0]


def spans(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per text with repeats: doc_id, text_hash, and the arrays ``begins`` and ``ends``
    of what repeats and ``cut_begins`` and ``cut_ends`` of what does not occur first."""

    @pandas_udf("begins array<int>, ends array<int>, cut_begins array<int>, cut_ends array<int>")
    def merge(begins: pd.Series, ends: pd.Series, firsts: pd.Series) -> pd.DataFrame:
        out = []
        for b, e, f in zip(begins, ends, firsts):
            b, e, later = np.asarray(b), np.asarray(e), ~np.asarray(f, dtype=bool)
            out.append([x.tolist() for x in (*joined(b, e), *joined(b[later], e[later]))])
        return pd.DataFrame(out, columns=["begins", "ends", "cut_begins", "cut_ends"])

    # Rows that repeat an id and text give each of its covers again: once is enough, so a list
    # is bounded by one text, however many rows hold it.
    found = covers(docs, scratch).distinct().groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("begin", "end", "is_first")).alias("c")
    )
    merged = found.select("doc_id", "text_hash", merge("c.begin", "c.end", "c.is_first").alias("m"))
    return merged.select("doc_id", "text_hash", "m.*")


def find_repeats(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per repeated passage of a text: doc_id, text_hash, begin and end (in
    words, end excluded), n_words, and n_cut, the words of it that occurred before."""
    found = spans(docs, scratch)
    pairs = found.select(
        "doc_id",
        "text_hash",
        F.arrays_zip("cut_begins", "cut_ends").alias("cuts"),
        F.explode(F.arrays_zip("begins", "ends")).alias("s"),
    )
    cut = F.aggregate(
        "cuts",
        F.lit(0),
        lambda n, c: n
        + F.greatest(
            F.lit(0), F.least(c["cut_ends"], F.col("s.ends")) - F.greatest(c["cut_begins"], F.col("s.begins"))
        ),
    )
    return pairs.select(
        "doc_id",
        "text_hash",
        F.col("s.begins").alias("begin"),
        F.col("s.ends").alias("end"),
        (F.col("s.ends") - F.col("s.begins")).alias("n_words"),
        cut.alias("n_cut"),
    )


def cut_words(text: str, begins: list[int], ends: list[int]) -> str:
    """The text without some ranges of words and the white space behind them."""
    import re

    starts = [m.start() for m in re.finditer(WORD_PATTERN, text)] + [len(text)]
    out, kept = [], 0
    for begin, end in zip(begins, ends):
        out.append(text[kept : starts[begin]])
        kept = starts[end]
    return "".join([*out, text[kept:]])


def without_repeats(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of ``docs``, their texts without what occurred before."""

    @pandas_udf("string")
    def cut(texts: pd.Series, begins: pd.Series, ends: pd.Series) -> pd.Series:
        return pd.Series([cut_words(t, b, e) for t, b, e in zip(texts, begins, ends)], dtype=object)

    # Written before the filter, so that a task holds one Python worker: the filter would merge a
    # second time, and the join would cut in the task that merges.
    found = scratch.keep(spans(docs, scratch)).where("size(cut_begins) > 0")
    held = docs.select(packed(docs).alias("row"), column("doc_id").alias("doc_id"), F.xxhash64(column("text")).alias("text_hash"))
    both = held.alias("d").join(found.alias("s"), _same_text("d", "s"), "left")
    # Rows without repeats bypass Python.
    text = F.when(F.col("cut_begins").isNotNull(), F.col("new")).otherwise(F.col("row.text"))
    changed = both.select("row", "cut_begins", cut(
        F.when(F.col("cut_begins").isNotNull(), F.col("row.text")).otherwise(F.lit("")),
        F.coalesce("cut_begins", F.array().cast("array<int>")),
        F.coalesce("cut_ends", F.array().cast("array<int>")),
    ).alias("new"))
    return changed.select(
        *[text.alias(c) if c.lower() == "text" else F.col("row")[c].alias(c) for c in docs.columns]
    )
