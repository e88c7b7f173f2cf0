"""Ranked lexical search over hashed max-sketches.

Each document is folded into a sketch of ``WIDTH`` bytes: a term falls into one coordinate
by its hash, and the coordinate keeps the greatest frequency of its terms (255 stands for
all above). For one document the impact of a term, its saturated frequency, grows with the
frequency, so the impact at a coordinate bounds those of all its terms from above: the sketch
holds the coordinatewise maxima of the impacts, in a form that needs no corpus statistics.
``index`` writes the sketches once, next to the text they are checked against.

A search takes the items in blocks of at most ``ITEMS`` items and ``TERMS`` terms (an item of
more is a block of its own), so that a block's size does not depend on the tables. Each
batch of sketches becomes a matrix of impacts and is multiplied with the block's matrix of
weights: one product gives the upper bounds of all documents of the batch for all items.
For each item the documents are scored exactly by descending bound, until the next bound
falls below the score of the last of the ``top`` found so far in the task; that threshold
carries on from batch to batch. Bounds are single precision, raised by more than its error.
What the tasks found is ranked by a window, which keeps ``top`` rows an item before the shuffle.

Per block one pass counts, over all documents, how many hold each of the block's terms, and
one pass searches. No pass shuffles documents; a document's size is the only unbounded thing.

Score of a document: the sum over the item's different terms of
``w * ((10^9 * tf) div (1000 * tf + 8 * m))`` with ``w = floor(1000 * ln((2N+2) / (2df+1)))`` and
``m = 100 - 90 + ((90 * n * N) div L)``.

Defined results
* A term is a run of ASCII letters and digits and of all other characters beyond ASCII; only
  A-Z are lower-cased. Null and term-free documents take no part; null and term-free items
  have no rows.
* Only scores above 0 are listed. Equal scores rank by ascending doc_id, null ids last. Rows
  that repeat a document are documents of their own; rows that repeat an item are items of
  their own, each with all its ranks.
* Nothing else of the tables is read, so extra columns cannot clash.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import Scratch, column

WIDTH = 4096
ITEMS, TERMS = 256, 1 << 16
#: Characters of text, and documents, that a task searches at a time.
CHARS, ROWS = 1 << 22, 1024
#: Bounds are raised by this share: the error of a sum of WIDTH products in single
#: precision is below WIDTH * 2^-23 of it.
SLACK = 1e-3
MOST = 255

_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"
#: All ASCII but letters and digits becomes a space, A-Z become a-z.
FOLD = bytes(b if b >= 128 or b in _KEPT else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    return text.encode().translate(FOLD).split() if text else []


def place(term: bytes) -> int:
    return xxhash.xxh3_64_intdigest(term) % WIDTH


class Places(dict):
    """Coordinates of terms, remembered up to a bound."""

    def __missing__(self, term: bytes) -> int:
        if len(self) >= 1 << 18:
            self.clear()
        at = self[term] = place(term)
        return at


def sketch(counts: Counter, places: Places) -> bytes:
    """The greatest frequency at each coordinate."""
    folded = np.zeros(WIDTH, dtype=np.uint8)
    if counts:
        at = np.fromiter(map(places.__getitem__, counts), dtype=np.int64, count=len(counts))
        often = np.minimum(np.fromiter(counts.values(), dtype=np.int64, count=len(counts)), MOST)
        np.maximum.at(folded, at, often.astype(np.uint8))
    return folded.tobytes()


def index(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, n (terms with repeats), sketch and text of the documents that hold a term."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Places()
        for batch in batches:
            for part in pieces(batch, "text"):
                found = [terms(t) for t in part.column("text").to_pylist()]
                sizes = pa.array([len(x) for x in found], pa.int64())
                folded = pa.array([sketch(Counter(x), places) for x in found], pa.binary())
                rows = pa.RecordBatch.from_arrays([part.column(0), sizes, folded, part.column(1)], NAMES)
                yield rows.filter(pa.array([bool(x) for x in found], pa.bool_()))

    chosen = docs.select(column("doc_id").cast("long").alias("doc_id"), column("text").alias("text"))
    return scratch.keep(chosen.mapInArrow(fold, "doc_id long, n long, sketch binary, text string"))


NAMES = ["doc_id", "n", "sketch", "text"]


def pieces(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about CHARS of text and at most ROWS rows."""
    sizes = [len(t) if t is not None else 0 for t in batch.column(text).to_pylist()]
    begin = held = 0
    for at, size in enumerate(sizes):
        if at > begin and (held + size > CHARS or at - begin >= ROWS):
            yield batch.slice(begin, at - begin)
            begin, held = at, 0
        held += size
    if begin < len(sizes):
        yield batch.slice(begin)


class Block:
    """Some items: their ids, and the terms of each."""

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.items: list[list[bytes]] = []

    def add(self, item_id: int | None, found: list[bytes]) -> None:
        self.ids.append(item_id)
        self.items.append(found)

    def full(self, more: int) -> bool:
        """Whether an item of so many terms must go to the next block."""
        held = sum(map(len, self.items))
        return bool(self.items) and (len(self.items) >= ITEMS or held + more > TERMS)


def blocks(items: DataFrame) -> Iterator[Block]:
    """The items in blocks; the driver holds one block and one partition of items at a time."""
    block = Block()
    rows = items.select(column("item_id").cast("long").alias("item_id"), column("text").alias("text"))
    for row in rows.toLocalIterator():
        found = sorted(set(terms(row.text)))
        if not found:
            continue
        if block.full(len(found)):
            yield block
            block = Block()
        block.add(row.item_id, found)
    if block.items:
        yield block


def holders(indexed: DataFrame, wanted: list[bytes]) -> dict[bytes, int]:
    """How many documents hold each of the terms: each task counts the block's terms, no others."""
    numbers = {t: i for i, t in enumerate(wanted)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(numbers), dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                for term in numbers.keys() & set(terms(text.as_py())):
                    total[numbers[term]] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["term", "df"])

    rows = indexed.select("text").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {wanted[r.term]: r.df for r in rows.collect()}  # at most the block's terms


class Best:
    """The best documents of one item so far, the worst of them first."""

    def __init__(self, top: int):
        self.top = top
        self.heap: list[tuple[int, int, int]] = []

    @property
    def threshold(self) -> int:
        return self.heap[0][0] if len(self.heap) == self.top else 1

    def offer(self, score: int, doc_id: int | None) -> None:
        if score <= 0:
            return
        entry = (score, doc_id is not None, -doc_id if doc_id is not None else 0)
        if len(self.heap) < self.top:
            heapq.heappush(self.heap, entry)
        elif entry > self.heap[0]:
            heapq.heapreplace(self.heap, entry)


class Searcher:
    """One block of items with its weights, applied to batches of the index."""

    def __init__(self, block: Block, weights: list[list[int]], n_docs: int, n_terms: int, top: int):
        self.items = [list(zip(t, w)) for t, w in zip(block.items, weights)]
        self.vocabulary = frozenset(t for item in block.items for t in item)
        self.n_docs, self.n_terms, self.top = n_docs, n_terms, top

    def matrix(self) -> np.ndarray:
        """Weights of the items by coordinate; terms of one item that share one add up."""
        found = np.zeros((WIDTH, len(self.items)))
        for number, item in enumerate(self.items):
            for term, weight in item:
                found[place(term), number] += weight
        return found.astype(np.float32)

    def bounds(self, sketches: np.ndarray, m: np.ndarray, matrix: np.ndarray) -> np.ndarray:
        """Upper bounds by document and item."""
        tf = np.arange(MOST + 1, dtype=np.float64)
        tf[MOST] = 1e15  # any frequency from there on
        saturated = np.ceil(1e9 * tf / (1000 * tf + 8 * m[:, None])).astype(np.float32)
        impacts = np.take_along_axis(saturated, sketches, axis=1)
        return (impacts @ matrix) * np.float32(1 + SLACK) + np.float32(1)

    def search(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = self.matrix()
        used = np.flatnonzero(matrix.any(axis=1))
        matrix = np.ascontiguousarray(matrix[used])
        best = [Best(self.top) for _ in self.items]
        for batch in batches:
            for part in pieces(batch, "text"):
                self.part(part, used, matrix, best)
        rows = [
            (number, -negative if known else None, score)
            for number, b in enumerate(best)
            for score, known, negative in b.heap
        ]
        kinds = [pa.int64(), pa.int64(), pa.int64()]
        columns = zip(*rows) if rows else [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["item", "doc_id", "score"])

    def part(self, part: pa.RecordBatch, used: np.ndarray, matrix: np.ndarray, best: list[Best]) -> None:
        sketches = np.frombuffer(b"".join(part.column("sketch").to_pylist()), dtype=np.uint8).reshape(-1, WIDTH)
        ids, texts = part.column("doc_id").to_pylist(), part.column("text")
        m = [10 + 90 * n * self.n_docs // self.n_terms for n in part.column("n").to_pylist()]
        bounds = self.bounds(sketches[:, used], np.array(m, dtype=np.float64), matrix)
        read: dict[int, dict[bytes, int]] = {}
        for number, item in enumerate(self.items):
            mine, top = bounds[:, number], best[number]
            near = np.flatnonzero(mine >= top.threshold)
            for at in near[np.argsort(-mine[near], kind="stable")].tolist():
                if mine[at] < top.threshold:
                    break
                counts = read.get(at)
                if counts is None:
                    wanted = self.vocabulary
                    counts = read[at] = Counter(t for t in terms(texts[at].as_py()) if t in wanted)
                score, eight = 0, 8 * m[at]
                for term, weight in item:
                    tf = counts.get(term)
                    if tf:
                        score += weight * (1_000_000_000 * tf // (1000 * tf + eight))
                top.offer(score, ids[at])


def search(indexed: DataFrame, items: DataFrame, scratch: Scratch, *, top: int = 10) -> DataFrame:
    """item_id, rank, doc_id and score of each item's ``top`` best documents."""
    n_docs, n_terms = indexed.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    rank = F.row_number().over(
        Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").isNull(), F.col("doc_id"))
    )
    spark = indexed.sparkSession
    result = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    if not n_docs:
        return result
    for block in blocks(items):
        held = holders(indexed, sorted({t for item in block.items for t in item}))
        weights = [
            [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held.get(t, 0) + 1))) for t in item]
            for item in block.items
        ]
        searcher = Searcher(block, weights, n_docs, n_terms, top)
        found = indexed.mapInArrow(searcher.search, "item long, doc_id long, score long")
        ranked = found.withColumn("rank", rank).where(F.col("rank") <= top)
        numbered = spark.createDataFrame(list(enumerate(block.ids)), "item long, item_id long")
        rows = ranked.join(numbered, "item").select("item_id", "rank", "doc_id", "score")
        result = result.unionByName(scratch.keep(rows))
    return result


SQL = """
WITH found AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
    FROM documents WHERE text IS NOT NULL
), docs AS (SELECT r, doc_id, len(terms) AS n, terms FROM found WHERE len(terms) > 0
), total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM docs
), wanted AS (
    SELECT DISTINCT i, item_id, unnest(terms) AS term FROM (
        SELECT row_number() OVER () AS i, item_id,
            regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
        FROM benchmark)
), tf AS (
    SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM docs)
    WHERE term IN (SELECT term FROM wanted) GROUP BY r, term
), weight AS (
    SELECT term, floor(1000 * ln((2 * total.docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
    FROM tf, total GROUP BY term, total.docs
), scored AS (
    SELECT i, item_id, doc_id,
        sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * total.docs) // total.terms))))::BIGINT AS score
    FROM wanted JOIN tf USING (term) JOIN weight USING (term) JOIN docs USING (r), total
    GROUP BY i, item_id, r, doc_id
), ranked AS (
    SELECT item_id, doc_id, score,
        row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
