"""SentencePiece encoding and decoding by a batched Viterbi search in numpy.

The units of a batch of texts are sorted into groups of one length and made unique;
all units of a group advance together. For each piece length, rolling hashes of all
substrings of the group are looked up in the sorted hashes of the pieces of that
length, and hits are compared character by character, so a hash collision cannot
give a wrong piece. Scores and backpointers of a place are vectors over the units;
a strict maximum over starts, earliest first, follows the tie rule (see ``pieces``).

Each row is encoded for itself and no row needs a shuffle. A task holds the units and
pieces of at most ``CHARS`` characters (or one longer text) at a time, beside the batch
of texts that Spark hands it.

Defined results
* Null gives null pieces, a null count and null for the round trip; an empty text
  gives no pieces.
* The round trip fails just where a text holds U+2581, which the format reads as a
  space.
* Repeated rows are encoded alike; of the input only the named columns are passed on.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from stratalake.llm.common import column, others
from stratalake.llm.pieces import SPACE, Vocabulary

CHARS = 1_000_000
#: Characters of one group that advance together.
CELLS = 1 << 18
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Leading bits of a hash by which substrings that are no piece are passed over.
FILTER = 18
RESULT = ["pieces", "n_pieces", "round_trip"]


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype="<u4")


def row_hashes(chars: np.ndarray) -> np.ndarray:
    """A hash of each column of a (length, n) array."""
    hashes = np.zeros(chars.shape[1], dtype=np.uint64)
    for row in chars:
        hashes = hashes * BASE + row
    return hashes


class Pieces:
    """The pieces of one length, sorted by hash."""

    def __init__(self, texts: list[str], scores: list[float], ids: list[int], length: int):
        chars = np.ascontiguousarray(codes("".join(texts)).reshape(-1, length).T)
        keys = row_hashes(chars)
        order = np.argsort(keys)
        self.keys, self.chars = keys[order], chars[:, order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces have one hash; choose another BASE")
        self.scores, self.ids = np.array(scores)[order], np.array(ids, dtype=np.int32)[order]
        self.maybe = np.zeros(1 << FILTER, dtype=bool)
        self.maybe[self.keys >> np.uint64(64 - FILTER)] = True

    def find(self, hashes: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, column and number of the piece of each substring that is one, by start."""
        starts, columns = np.nonzero(self.maybe[hashes >> np.uint64(64 - FILTER)])
        probes = hashes[starts, columns]
        at = np.minimum(np.searchsorted(self.keys, probes), len(self.keys) - 1)
        same = self.keys[at] == probes
        starts, columns, at = starts[same], columns[same], at[same]
        same = np.ones(len(at), dtype=bool)
        for i, row in enumerate(self.chars):
            same &= chars[starts + i, columns] == row[at]
        return starts[same], columns[same], at[same]


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def __reduce__(self):
        return Encoder, (self.vocabulary,)

    @cached_property
    def tables(self) -> dict[int, Pieces]:
        v, by_length = self.vocabulary, {}
        for piece in zip(v.texts, v.scores, v.ids):
            by_length.setdefault(len(piece[0]), []).append(piece)
        return {n: Pieces(*map(list, zip(*found)), n) for n, found in by_length.items()}

    def group(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of units of one length, given as the columns of ``chars``: all pieces
        in a row, and the number of each unit's. An unknown character is -1 - code."""
        length, n = chars.shape
        longest = min(length, max(self.tables))
        hits, hashes = {}, np.zeros((length, n), dtype=np.uint64)
        for size in range(1, longest + 1):
            hashes = hashes[: length - size + 1] * BASE + chars[size - 1 :]
            if size in self.tables:
                starts, columns, at = self.tables[size].find(hashes, chars)
                cuts = np.searchsorted(starts, np.arange(length - size + 2))
                hits[size] = columns, self.tables[size].scores[at], self.tables[size].ids[at], cuts
        best = np.full((length + 1, n), -np.inf)
        best[0] = 0.0
        size_of = np.zeros((length + 1, n), dtype=np.int32)
        piece_of = np.zeros((length + 1, n), dtype=np.int64)
        for end in range(1, length + 1):
            for size in range(min(end, longest), 0, -1):
                if size not in hits:
                    continue
                columns, scores, ids, cuts = hits[size]
                here = slice(cuts[end - size], cuts[end - size + 1])
                if here.start == here.stop:
                    continue
                columns = columns[here]
                total = best[end - size, columns] + scores[here]
                better = total > best[end, columns]
                columns = columns[better]
                best[end, columns] = total[better]
                size_of[end, columns] = size
                piece_of[end, columns] = ids[here][better]
            # A character that is no piece is tried last: its start is the latest.
            known = np.zeros(n, dtype=bool)
            if 1 in hits:
                columns, _, _, cuts = hits[1]
                known[columns[cuts[end - 1] : cuts[end]]] = True
            total = best[end - 1] + self.vocabulary.unknown
            better = ~known & (total > best[end])
            best[end, better] = total[better]
            size_of[end, better] = 1
            piece_of[end, better] = -1 - chars[end - 1, better].astype(np.int64)
        return self.trace(size_of, piece_of)

    @staticmethod
    def trace(size_of: np.ndarray, piece_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Follows the backpointers of all units from their ends."""
        n = size_of.shape[1]
        ends, alive = np.full(n, len(size_of) - 1), np.arange(n)
        taken = []
        while len(alive):
            at = ends[alive]
            taken.append((alive, piece_of[at, alive]))
            ends[alive] = at - size_of[at, alive]
            alive = alive[ends[alive] > 0]
        counts = np.zeros(n, dtype=np.int64)
        for columns, _ in taken:
            counts[columns] += 1
        flat = np.zeros(counts.sum(), dtype=np.int64)
        place = np.cumsum(counts)
        for columns, found in taken:
            place[columns] -= 1
            flat[place[columns]] = found
        return flat, counts

    def with_bytes(self, flat: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters that are no piece become byte pieces."""
        unknown = flat < 0
        if not unknown.any():
            return flat, counts
        kinds, which = np.unique(flat[unknown], return_inverse=True)
        spelled = [[self.vocabulary.byte_ids[b] for b in chr(-1 - int(k)).encode()] for k in kinds]
        sizes = np.ones(len(flat), dtype=np.int64)
        sizes[unknown] = np.array([len(s) for s in spelled])[which]
        firsts = np.cumsum(sizes) - sizes
        out = np.repeat(flat, sizes)
        for kind, ids in enumerate(spelled):
            at = firsts[unknown][which == kind]
            for i, piece in enumerate(ids):
                out[at + i] = piece
        owner = np.repeat(np.arange(len(counts)), counts)
        return out, np.bincount(owner, weights=sizes, minlength=len(counts)).astype(np.int64)

    def unique(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces and counts of the different columns, and which column is which."""
        _, first, which = np.unique(row_hashes(chars), return_index=True, return_inverse=True)
        rare = chars[:, first]
        if not (rare[:, which] == chars).all():  # two units with one hash
            rare, which = np.unique(chars, axis=1, return_inverse=True)
            which = which.reshape(-1)
        step = max(1, CELLS // len(chars))
        parts = [self.group(np.ascontiguousarray(rare[:, i : i + step])) for i in range(0, rare.shape[1], step)]
        flat, counts = (np.concatenate(x) for x in zip(*parts))
        return *self.with_bytes(flat, counts), which

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The pieces of each text; the units of all texts are encoded together."""
        spaced = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
        lengths = np.array([len(t) for t in spaced])
        chars = codes("".join(spaced))
        if not len(chars):
            return [np.empty(0, dtype=np.int32) for _ in texts]
        space = chars == ord(SPACE)
        first = space.copy()
        first[1:] &= ~space[:-1]
        first[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, len(chars)))
        offsets, counts = np.zeros(len(starts), dtype=np.int64), np.zeros(len(starts), dtype=np.int64)
        pool, filled = [], 0
        order = np.argsort(sizes, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1):
            length = sizes[part[0]]
            flat, n, which = self.unique(chars[starts[part] + np.arange(length)[:, None]])
            offsets[part], counts[part] = (filled + np.cumsum(n) - n)[which], n[which]
            pool.append(flat.astype(np.int32))
            filled += len(flat)
        pieces = np.concatenate(pool)[np.repeat(offsets - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())]
        owner = np.searchsorted(np.cumsum(lengths), starts, side="right")
        per_text = np.bincount(owner, weights=counts, minlength=len(texts)).astype(np.int64)
        return np.split(pieces, np.cumsum(per_text)[:-1])

    def decode(self, pieces: np.ndarray) -> str:
        by_id = self.vocabulary.by_id
        text = b"".join([by_id[i] for i in pieces]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def portions(texts: Iterable[str | None]) -> Iterator[list[str | None]]:
    """The texts in order, cut where ``CHARS`` would be passed; what is no text is None."""
    part, held = [], 0
    for text in texts:
        text = text if isinstance(text, str) else None
        size = len(text or "")
        if part and held + size > CHARS:
            yield part
            part, held = [], 0
        part.append(text)
        held += size
    if part:
        yield part


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The columns of ``docs`` but ``text``, with pieces (ids), n_pieces and round_trip."""
    encoder = Encoder(vocabulary)

    @pandas_udf("pieces array<int>, round_trip boolean")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in portions(batch):
                coded = iter(encoder.encode([t for t in part if t is not None]))
                pieces = [None if t is None else next(coded) for t in part]
                same = [None if t is None else encoder.decode(p) == t for t, p in zip(part, pieces)]
                yield pd.DataFrame({
                    "pieces": pd.Series(pieces, dtype=object),
                    "round_trip": pd.Series(same, dtype=object),
                })

    kept = others(docs, [*RESULT, "text"])
    # Without the text, which would wait for its pieces beside the Python worker. The
    # constant keeps the struct whole where no column is left.
    row = F.struct(*[column(c).alias(f"c{i}") for i, c in enumerate(kept)], F.lit(0).alias("none"))
    coded = docs.select(row.alias("row"), udf(column("text")).alias("coded"))
    pieces = F.col("coded.pieces")
    return coded.select(
        *[F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(kept)],
        pieces.alias("pieces"),
        F.when(pieces.isNotNull(), F.size(pieces).cast("long")).alias("n_pieces"),
        F.col("coded.round_trip").alias("round_trip"),
    )


def decode(coded: DataFrame, vocabulary: Vocabulary, pieces: str = "pieces") -> DataFrame:
    """Adds ``text``, what the pieces spell (null for null)."""
    encoder = Encoder(vocabulary)

    @pandas_udf("string")
    def udf(batch: pd.Series) -> pd.Series:
        return batch.map(lambda p: None if p is None else encoder.decode(p))

    return coded.withColumn("text", udf(column(pieces)))
