"""N-gram Jaccard join with adaptive multi-match prefixes.

A document's set holds its different shingles, as 64-bit hashes. Two sets of a and b elements
reach the similarity if they share at least ``o = ceil(p (a + b) / (100 + p))`` of them
(p percent). Under one order of all shingles, a set's l-prefix is its first ``a - o + l``
elements, and two similar sets share at least l elements of their l-prefixes, for every l.
A longer prefix costs more lookups but asks for more shared elements, which leaves fewer
pairs to verify. Each set chooses its own l (``lengthened``): the one of least estimated cost,
from the numbers of sets that hold the prefix's shingles. A pair is verified only if it shares
as many prefix elements as the lesser l of the two asks for.

1. Equal sets become one node. Only the different sets go on.
2. The order is by frequency, rare shingles first, so that shingles no other set holds fill
   the prefixes of most sets, which are then done. Counting all shingles would move several
   times the corpus; a quarter of all shingles, chosen by hash, comes first in the order, by
   its exact count over all sets, and the rest follows by hash. A prefix takes 15 percent
   and lies in that quarter, but for small sets, which list more shingles. Any common order
   gives whole results.
3. Sets are listed by prefix shingle. In a list of up to ``SHORT`` sets, pairs of fitting
   sizes are counted, at most ``SHORT / 2`` a row; those with enough shared elements are
   candidates. A longer list links its sets to one of them, which stands for all its pairs.
4. The components of these links are verified, each set sent to its component once: in a
   component's task, shared prefix elements are counted first, then whole sets are
   intersected where enough are shared. A component of more than ``BLOCK`` sets or ``HELD``
   elements is cut into blocks, each pair of blocks being one group. A group yields
   links of a spanning forest, not all its pairs; no pair is left unexamined but those
   already joined.

Defined results
* Null, empty and word-free texts have no shingles and are linked with nothing, not even with
  each other: each is a component of its own.
* A text of fewer words than a shingle is one shingle.
* Rows that repeat a ``doc_id`` are nodes of their own with that id. Null ids are kept; a
  component of null ids only has a null ``component_id``.
* Nothing else of the input is read, so extra columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import Scratch, column
from stratalake.llm.components import components

#: Shingles whose hash has these bits clear come first in the order.
SAMPLE_BITS = 3
#: Longest extension of a prefix, and what verifying a pair costs against reading a list entry.
MOST_EXTRA, VERIFY = 8, 32
#: Sets of a list whose pairs are counted one by one.
SHORT = 64
#: Sets and elements of a block.
BLOCK, HELD = 2048, 1 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 18:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


def shingle_set(text: str | None, shingle: int, hashes: WordHashes) -> np.ndarray:
    """Hashes of the different shingles, ascending."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, dtype=np.int64)
    n = min(shingle, len(words))
    each = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    found = np.full(len(words) - n + 1, n, dtype=np.uint64)
    for at in range(n):
        found = (found ^ (found >> np.uint64(29))) * _MIX + each[at : at + len(found)]
    found = (found ^ (found >> np.uint64(32))) * _MIX
    return np.unique((found ^ (found >> np.uint64(29))).view(np.int64))


def needed(n: int, percent: int) -> int:
    """Least number of shared elements with any set, for a set of n."""
    return -(-percent * n // 100)


def needed_as_smaller(n: int, percent: int) -> int:
    """The same with any set of n elements or more."""
    return -(-2 * percent * n // (100 + percent))


def most_extra(n: int, percent: int) -> int:
    return min(MOST_EXTRA, needed(n, percent))


def listed(elements: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The elements that can lie in a prefix: the sampled ones and, where these are too few,
    the first others; and the number of the sampled."""
    n = len(elements)
    chosen = (elements & SAMPLE_BITS) == 0
    sampled = elements[chosen]
    longest = min(n, n - needed(n, percent) + most_extra(n, percent)) if n else 0
    missing = max(longest - len(sampled), 0)
    return np.concatenate((sampled, elements[~chosen][:missing])), len(sampled)


def lengthened(n: int, sampled: int, held: np.ndarray, element: np.ndarray, percent: int) -> tuple | None:
    """A set's choice of l with its prefix: (l, elements, whether each is in the prefix against
    larger sets). ``element`` are its listed elements that another set holds, ``held`` by how
    many sets. None if it shares too few with others to be similar to any."""
    first = (element & SAMPLE_BITS) == 0
    order = np.lexsort((element[first], held[first]))
    ranked, rest = element[first][order], element[~first]
    ranked_held, rest_held = held[first][order], held[~first]
    alone = sampled - len(ranked)
    cost = np.concatenate(([0], np.cumsum(ranked_held - 1)))
    best = None
    for extra in range(1, most_extra(n, percent) + 1):
        length = n - needed(n, percent) + extra
        taken = min(max(length - alone, 0), len(ranked))
        beyond = length > sampled
        if taken + beyond * len(rest) < extra:
            return None  # not similar to any
        entries = int(cost[taken]) + beyond * int((rest_held - 1).sum())
        total = entries * (1 + VERIFY / extra)
        if best is None or total < best[0]:
            best = total, extra, taken, beyond
    _, extra, taken, beyond = best
    length = n - needed_as_smaller(n, percent) + extra
    inner = np.arange(taken) < length - alone
    if not beyond:
        return extra, ranked[:taken], inner
    return extra, np.concatenate((ranked[:taken], rest)), np.concatenate((inner, np.full(len(rest), length > sampled)))


def read_sets(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """doc_id, hash of the text, number of shingles, a key of the set, its listed elements."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sizes, keys, sampled, lists = [], [], [], []
            for text in batch.column(2):
                elements = shingle_set(text.as_py(), shingle, hashes)
                some, chosen = listed(elements, percent)
                sizes.append(len(elements))
                keys.append(xxhash.xxh3_128_digest(elements.tobytes()) if len(elements) else None)
                sampled.append(chosen)
                lists.append(some)
            offsets = np.cumsum([0, *map(len, lists)])
            flat = np.concatenate(lists) if lists else np.empty(0, dtype=np.int64)
            columns = [
                pa.array(sizes, pa.int64()),
                pa.array(keys, pa.binary()),
                pa.array(sampled, pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], names)

    names = ["doc_id", "text_hash", "n", "key", "sampled", "listed"]
    schema = "doc_id long, text_hash long, n long, key binary, sampled long, listed array<long>"
    return identified(docs).mapInArrow(scan, schema)


def identified(docs: DataFrame) -> DataFrame:
    text = column("text")
    return docs.select(column("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def prefixes(nodes: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """node, n, extra, elements and inner of the nodes that may be similar to another."""
    entries = nodes.select("node", F.explode("listed").alias("element"))
    # Written, so that the join deals both sides out anew and splits a hot element.
    held = scratch.keep(entries.groupBy("element").agg(F.count("*").alias("held")).where("held > 1"))
    first = F.col("element").bitwiseAND(F.lit(SAMPLE_BITS).cast("long")) == 0
    shared = (
        entries.join(held, "element")
        .groupBy("node")
        .agg(F.collect_list(F.struct("element", "held")).alias("shared"), F.count_if(first).alias("n_shared"))
    )
    # Sampled elements no other set holds come first of all; as many as a prefix leave nothing to match.
    room = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    some = nodes.select("node", "n", "sampled").join(shared, "node").where(F.col("sampled") - F.col("n_shared") < room)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for node, n, sampled, entries in zip(*(batch.column(c).to_pylist() for c in ("node", "n", "sampled", "shared"))):
                held = np.array([e["held"] for e in entries], dtype=np.int64)
                element = np.array([e["element"] for e in entries], dtype=np.int64)
                found = lengthened(n, sampled, held, element, percent)
                if found is not None:
                    rows.append((node, n, *found))
            columns = list(zip(*rows)) if rows else [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    names = ["node", "n", "extra", "elements", "inner"]
    found = some.mapInArrow(choose, "node long, n long, extra long, elements array<long>, inner array<boolean>")
    result = scratch.keep(found)
    scratch.drop(held)
    return result


def candidates(chosen: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """Links (a, b) whose components hold all similar pairs."""
    entry = F.explode(F.arrays_zip("elements", "inner")).alias("e")
    entries = chosen.select("node", "n", "extra", entry).select("node", "n", "extra", "e.elements", "e.inner")
    entries = entries.withColumnRenamed("elements", "element")
    lists = scratch.keep(
        entries.groupBy("element").agg(F.count("*").alias("held"), F.min("node").alias("hub")).where("held > 1")
    )
    known = entries.join(lists, "element")
    hubs = known.where(F.col("held") > SHORT).select(F.col("node").alias("a"), F.col("hub").alias("b"))
    short = known.where(F.col("held") <= SHORT).select("element", "node", "n", "extra", "inner")
    x, y = short.where("inner").alias("x"), short.alias("y")
    smaller = (F.col("x.n") < F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.node") < F.col("y.node")))
    fits = F.col("x.n") * 100 >= F.col("y.n") * percent
    pairs = (
        x.join(y, (F.col("x.element") == F.col("y.element")) & smaller & fits)
        .groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
        .agg(F.count("*").alias("shared"), F.least(F.first("x.extra"), F.first("y.extra")).alias("asked"))
        .where("shared >= asked")
        .select("a", "b")
    )
    return hubs.where("a <> b").unionByName(pairs)


class Group:
    """Sets of one component or of two of its blocks."""

    def __init__(self, rows: list[tuple[int, int, np.ndarray, np.ndarray]]):
        self.nodes = [r[0] for r in rows]
        self.extra = np.array([r[1] for r in rows])
        self.prefix, self.prefix_starts = self.ranked([r[2] for r in rows])
        self.whole, self.starts = self.ranked([r[3] for r in rows])
        self.n = np.diff(self.starts)

    @staticmethod
    def ranked(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        starts = np.cumsum([0, *map(len, sets)])
        return np.unique(np.concatenate(sets), return_inverse=True)[1], starts

    def shared(self, elements: np.ndarray, starts: np.ndarray, seed: int, which: np.ndarray) -> np.ndarray:
        """Elements that each of the sets shares with the seed."""
        inside = np.zeros(int(elements.max()) + 1, dtype=bool)
        inside[elements[starts[seed] : starts[seed + 1]]] = True
        if len(which) * 4 < len(starts):
            parts = [elements[starts[i] : starts[i + 1]] for i in which.tolist()]
            return np.array([np.count_nonzero(inside[p]) for p in parts], dtype=np.int64)
        total = np.concatenate(([0], np.cumsum(inside[elements])))
        return (total[starts[1:]] - total[starts[:-1]])[which]

    def links(self, percent: int) -> list[tuple[int, int]]:
        """Links that connect just the sets that similar pairs connect."""
        left = np.argsort(self.n, kind="stable")
        found: list[tuple[int, int]] = []
        while len(left):
            queue, left = [int(left[0])], left[1:]
            while queue and len(left):
                seed = queue.pop()
                n, size = self.n[left], self.n[seed]
                fits = left[(100 * np.minimum(n, size) >= percent * np.maximum(n, size))]
                if not len(fits):
                    continue
                asked = np.minimum(self.extra[fits], self.extra[seed])
                fits = fits[self.shared(self.prefix, self.prefix_starts, seed, fits) >= asked]
                if not len(fits):
                    continue
                common = self.shared(self.whole, self.starts, seed, fits)
                reached = fits[100 * common >= percent * (self.n[fits] + size - common)]
                if len(reached):
                    left = left[~np.isin(left, reached)]
                    found += [(self.nodes[seed], self.nodes[i]) for i in reached.tolist()]
                    queue += reached.tolist()
        return found


def verified(members: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of similar sets. ``members``: root, node, extra, elements, whole (bytes of the set)."""
    size = F.length("whole") / 8
    totals = members.groupBy("root").agg(F.count("*").alias("sets"), F.sum(size).alias("held"))
    blocks = F.greatest(F.ceil(F.col("sets") / BLOCK), F.ceil(F.col("held") / HELD)).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    kept = ["root", "node", "extra", "elements", "whole"]
    dealt = (
        members.join(totals.where("sets > 1").select("root", blocks.alias("blocks")), "root")
        .select(*kept, "blocks", own.alias("own"))
        .select(*kept, "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select(*kept, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )
    keys = ["root", "i", "j"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            found = []
            for *key, node, extra, elements, whole in zip(*(batch.column(c) for c in (*keys, *kept[1:]))):
                key = [k.as_py() for k in key]
                if key != now:
                    found += Group(rows).links(percent) if len(rows) > 1 else []
                    now, rows = key, []
                prefix = elements.values.to_numpy(zero_copy_only=False)
                rows.append((node.as_py(), extra.as_py(), prefix.copy(), np.frombuffer(whole.as_py(), dtype=np.int64)))
            yield linked(found)
        yield linked(Group(rows).links(percent) if len(rows) > 1 else [])

    sorted_groups = dealt.repartition(*keys).sortWithinPartitions(*keys)
    return sorted_groups.mapInArrow(scan, "a long, b long").distinct()


def linked(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def whole_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """node and the bytes of its set. ``wanted``: node and one document (doc_id, text_hash) that has it."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingle_set(t.as_py(), shingle, hashes).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["node", "whole"])

    d, w = identified(docs).alias("d"), wanted.alias("w")
    same = F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.text_hash") == F.col("w.text_hash"))
    texts = d.join(w, same).select("w.node", "d.text")
    found = texts.mapInArrow(scan, "node long, whole binary")
    return found.groupBy("node").agg(F.first("whole").alias("whole"))


def similar_groups(docs: DataFrame, scratch: Scratch, *, shingle: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles and component_id of each row: documents whose sets of shingles have a
    Jaccard similarity of at least ``percent`` are linked."""
    rows = scratch.keep(read_sets(docs, shingle, percent))
    one = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    sets = rows.where("n > 0").groupBy("key")
    nodes = scratch.keep(
        sets.agg(
            F.min("doc_id").alias("least"),
            F.min(one).alias("one"),
            *[F.first(c).alias(c) for c in ("n", "sampled", "listed")],
        ).withColumn("node", F.monotonically_increasing_id())
    )
    chosen = prefixes(nodes, scratch, percent)
    grouped = components(candidates(chosen, scratch, percent), scratch)
    roots = grouped.select("root").distinct()
    grouped = scratch.keep(grouped.unionByName(roots.select(F.col("root").alias("node"), "root")))
    wanted = nodes.select("node", "one.doc_id", "one.text_hash").join(grouped.select("node"), "node", "left_semi")
    members = (
        grouped.join(chosen.select("node", "extra", "elements"), "node")
        .join(whole_sets(docs, wanted, shingle), "node")
    )
    found = components(verified(scratch.keep(members), percent), scratch)
    n, f = nodes.alias("n"), found.alias("f")
    rooted = scratch.keep(
        n.join(f, F.col("n.node") == F.col("f.node"), "left").select(
            "n.key", "n.least", F.coalesce("f.root", "n.node").alias("root")
        )
    )
    ids = scratch.keep(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    classes = scratch.keep(rooted.join(ids, "root").select("key", "component_id"))
    r, c = rows.select("doc_id", "n", "key").alias("r"), classes.alias("c")
    return r.join(c, F.col("r.key") == F.col("c.key"), "left").select(
        "r.doc_id",
        F.col("r.n").alias("n_shingles"),
        F.when(F.col("r.key").isNull(), F.col("r.doc_id")).otherwise(F.col("c.component_id")).alias("component_id"),
    )
