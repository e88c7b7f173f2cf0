"""Runs of repeating words, found with a suffix automaton and link-cut access.

Words are appended one by one to a suffix automaton. Its suffix-link tree is held as a
link-cut forest whose preferred paths are the segments of states that last occurred at the
same place: appending word ``i`` accesses the new state, which recolours all segments on
its path to the root with ``i``. A segment whose states last ended at ``p``, the longest of
them of ``L`` words and the shortest of more than ``S``, yields the period ``q = i - p`` if
``S < q <= L``: the ``q`` words before ``i`` stand twice in a row, and as they did not occur in
between, no smaller period cuts them. ``L`` is the longest common suffix at ``p`` and ``i``,
so the run starts at word ``p - L + 1``; it grows to the right as long as the next words
yield the same period and start. A text of n words costs O(n log n) amortised steps.

Only stretches that can hold a reported run enter the automaton: a run of at least ``LEAST``
words and two periods is covered by windows of ``LEAST // 2`` words that occur again in it,
so what no such window covers is no part of a run, and a run lies whole in one stretch of
covered words. The test is repeated within each stretch until it leaves all of it.

Each text is one task's work for a few milliseconds: no shuffle, memory for one text at a time.

Defined results
* Null, empty and word-free texts have no words and no runs; the four columns of the longest
  run are null, the digests are those of empty text.
* Of runs of one length the first, then the one of the smaller period is the longest.
* Repeated rows are judged alike; extra columns are passed on, those named as a result
  column are replaced.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from stratalake.llm.common import column, others, packed

#: Fewest words of a reported run.
LEAST = 12
RESULT = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]

Run = tuple[int, int, int]


class LastEnds:
    """A suffix automaton whose link tree is a link-cut forest of equal last ends.

    Lists are indexed by state; 0 stands for no state, 1 is the root. ``up`` is the parent in
    the splay tree of a segment or, at the root of one, the state below which the segment
    hangs; ``left`` holds the shorter states of a segment, ``right`` the longer ones. ``end``
    is the segment's last end, kept at its splay root only.
    """

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}, {}]
        self.link = [0, 0]
        self.size = [0, 0]
        self.up = [0, 0]
        self.left = [0, 0]
        self.right = [0, 0]
        self.end = [-1, -1]
        self.last = 1
        self.n = 0

    def state(self, size: int, link: int, following: dict[int, int], up: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.size.append(size)
        self.up.append(up)
        self.left.append(0)
        self.right.append(0)
        self.end.append(-1)
        return len(self.size) - 1

    def splay(self, x: int) -> None:
        """Make ``x`` the root of its segment's tree."""
        up, left, right = self.up, self.left, self.right
        while True:
            p = up[x]
            if not p:
                return
            if left[p] == x:
                x_left = True
            elif right[p] == x:
                x_left = False
            else:
                return
            g = up[p]
            if g and (left[g] == p or right[g] == p):
                p_left = left[g] == p
                self.turn(p if p_left == x_left else x)
            self.turn(x)

    def turn(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        p = up[x]
        g = up[p]
        if left[p] == x:
            moved = right[x]
            left[p] = moved
            right[x] = p
        else:
            moved = left[x]
            right[p] = moved
            left[x] = p
        if moved:
            up[moved] = p
        up[p] = x
        up[x] = g
        if g and left[g] == p:
            left[g] = x
        elif g and right[g] == p:
            right[g] = x
        else:
            self.end[x] = self.end[p]

    def split(self, old: int, size: int) -> int:
        """A state for the strings of ``old`` up to ``size`` words, just above it in its segment."""
        self.splay(old)
        new = self.state(size, self.link[old], self.next[old].copy(), old)
        above = self.left[old]
        if above:
            self.left[new] = above
            self.up[above] = new
        self.left[old] = new
        self.link[old] = new
        return new

    def append(self, word: int) -> list[tuple[int, int, int]]:
        """Add a word; the segments (last end, most words, words of the next) on its path."""
        following, link, size = self.next, self.link, self.size
        p = self.last
        new = self.last = self.state(size[p] + 1, 0, {}, 0)
        while p and word not in following[p]:
            following[p][word] = new
            p = link[p]
        above = 1
        if p:
            above = following[p][word]
            if size[above] != size[p] + 1:
                old = above
                above = self.split(old, size[p] + 1)
                while p and following[p].get(word) == old:
                    following[p][word] = above
                    p = link[p]
        link[new] = self.up[new] = above
        return self.access(new)

    def access(self, new: int) -> list[tuple[int, int, int]]:
        up, left, right, end, size = self.up, self.left, self.right, self.end, self.size
        found = []
        x, below, segment = up[new], new, None
        while x:
            self.splay(x)
            if segment is not None:
                found.append((*segment, size[x]))
            segment = (end[x], size[x])
            longer = right[x]
            if longer:
                end[longer] = end[x]
            right[x] = below
            below, x = x, up[x]
        end[below] = self.n
        self.n += 1
        # Segments were met from the longest; the root's empty string closes the last one.
        if segment is not None and segment[1]:
            found.append((*segment, 0))
        return found


def runs_of(words: np.ndarray, least: int = LEAST) -> list[Run]:
    """(start, length, period) of the runs of at least ``least`` words and two periods."""
    ends = LastEnds()
    growing: dict[int, list[int]] = {}
    found: list[Run] = []

    def close(period: int, start: int, last: int) -> None:
        if last - start + 1 >= max(least, 2 * period):
            found.append((start, last - start + 1, period))

    for i, word in enumerate(words.tolist()):
        for last, most, fewer in ends.append(word):
            period = i - last
            if fewer < period <= most:
                start = last - most + 1
                run = growing.get(period)
                if run is not None and run[0] == start and run[1] == i - 1:
                    run[1] = i
                else:
                    if run is not None:
                        close(period, *run)
                    growing[period] = [start, i]
    for period, run in growing.items():
        close(period, *run)
    return sorted(found, key=lambda r: (r[0], r[2]))


def stretches(words: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """Stretches [begin, end) that windows of ``least // 2`` words cover which occur at least
    twice in the same stretch."""
    window = max(least // 2, 1)
    waiting, found = [(0, len(words))], []
    while waiting:
        begin, end = waiting.pop()
        n = end - begin - window + 1
        if end - begin < least:
            continue
        some = words[begin:end].astype(np.uint64)
        hashes = np.zeros(n, dtype=np.uint64)
        for shift in range(window):
            hashes = hashes * np.uint64(0x9E3779B97F4A7C15) + some[shift : shift + n]
            hashes ^= hashes >> np.uint64(29)
        order = np.argsort(hashes, kind="stable")
        equal = hashes[order[1:]] == hashes[order[:-1]]
        if not equal.any():
            continue
        again = np.zeros(n + 1, dtype=np.int64)
        again[order[1:][equal]] = 1
        again[order[:-1][equal]] = 1
        edges = np.zeros(end - begin + 1, dtype=np.int64)
        edges[: n + 1] += again
        edges[window:] -= again[: len(edges) - window]
        covered = np.cumsum(edges)[:-1] > 0
        steps = np.flatnonzero(np.diff(np.concatenate(([0], covered.view(np.int8), [0]))))
        parts = [(begin + a, begin + b) for a, b in steps.reshape(-1, 2).tolist()]
        if parts == [(begin, end)]:
            found.append((begin, end))
        else:
            waiting += parts
    return sorted(found)


def find(words: list[bytes], least: int = LEAST) -> list[Run]:
    """Runs of a text by start, then period."""
    numbers: dict[bytes, int] = {}
    which = [numbers.setdefault(w, len(numbers)) for w in words]
    if len(which) - len(numbers) < least // 2:
        return []
    array = np.array(which, dtype=np.int64)
    return [
        (begin + start, length, period)
        for begin, end in stretches(array, least)
        for start, length, period in runs_of(array[begin:end], least)
    ]


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words that no run repeats: each run keeps its first period."""
    kept, at = [], 0
    for start, length, period in sorted(runs, key=lambda r: r[0] + r[2]):
        begin, end = start + period, start + length
        if end > at:
            kept += words[at:begin]  # nothing where the cuts overlap
            at = max(at, begin, end)
    return b" ".join(kept + words[at:])


def judged(words: list[bytes], least: int = LEAST) -> tuple:
    runs = find(words, least)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    digests = (hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs)).hexdigest())
    if not runs:
        return (0, None, None, None, None, *digests)
    start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2]))
    return (len(runs), start, length, period, 1000 * length // period, *digests)


def periodic_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """One text in ten, by the checksum of its id, goes on by repeating some of its words
    from a place on; a text without id stays as it is."""
    n = len(words)
    if doc_id is None or not n:
        return words
    checksum = zlib.crc32(str(doc_id).encode())
    if checksum % 10:
        return words
    g = checksum // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    block = words[a : a + p]
    return words[:a] + (block * ((n - a) // p + 1))[: n - a]


def find_runs(
    docs: DataFrame, *, least: int = LEAST, change: Callable[[int | None, list[bytes]], list[bytes]] | None = None
) -> DataFrame:
    """The columns of ``docs`` but ``text``, with ``RESULT``. ``change`` may rewrite the words
    of a text by its ``doc_id`` before they are searched."""
    rest = [c for c in others(docs, [*RESULT, "text"])]
    kinds = [StructField(c, StringType() if c.endswith("sha256") else LongType()) for c in RESULT]
    kept = docs.select(*[column(c) for c in rest])
    chosen = docs.select(packed(kept).alias("rest"), column("doc_id").alias("id"), column("text").alias("text"))
    schema = StructType([StructField("rest", kept_type(kept)), *kinds])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(1), batch.column(2)):
                text = text.as_py()
                words = text.encode().split() if text else []
                if change is not None:
                    words = change(doc_id.as_py(), words)
                rows.append(judged(words, least))
            results = list(zip(*rows)) if rows else [()] * len(kinds)
            columns = [
                pa.array(values, pa.string() if isinstance(k.dataType, StringType) else pa.int64())
                for k, values in zip(kinds, results)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["rest", *RESULT])

    found = chosen.mapInArrow(scan, schema)
    return found.select(*[F.col("rest")[c].alias(c) for c in rest], *RESULT)


def kept_type(df: DataFrame) -> StructType:
    return StructType([StructField(f.name, f.dataType) for f in df.schema.fields])
