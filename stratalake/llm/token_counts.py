"""Token counts by a count-only Viterbi search.

An Aho-Corasick automaton finds all pieces in a unit (see ``pieces``) in one pass, by
end and from the longest to the shortest, which is the order in which the tokenizer
tries them. Each place carries the best score of a path to it and the number of
pieces on that path; no pieces are kept. A character that is no piece counts as many
tokens as it has bytes.

Units repeat, so a worker remembers the counts of the first ``REMEMBERED`` short units
it meets and counts others anew; this changes no result. No row needs a shuffle.

Defined results
* Null counts null, an empty text 0.
* Repeated rows are counted alike; extra columns are passed on, one named ``n_tokens``
  is replaced.
"""

from __future__ import annotations

import re
from functools import cached_property

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.functions import pandas_udf

from stratalake.llm.common import column, others
from stratalake.llm.pieces import SPACE, Vocabulary

REMEMBERED = 400_000
SHORT = 32
LOW = float("-inf")
#: Scores closer than this may be a tie.
MARGIN = 1e-6


def automaton_of(pieces: list[tuple[str, float]]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for text, score in pieces:
        automaton.add_word(text, (len(text), score))
    automaton.make_automaton()
    return automaton


class Counter:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.known: dict[str, int] = {}

    def __reduce__(self):
        return Counter, (self.vocabulary,)

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        """All pieces that can lie on a best path: one that scores less than a path
        through its own characters never does, at no place and in no tie."""
        v = self.vocabulary
        pieces = list(zip(v.texts, v.scores))
        every = automaton_of(pieces)
        return automaton_of([p for p in pieces if self.best(every, p[0])[0] <= p[1] + MARGIN])

    @cached_property
    def unit_pattern(self) -> re.Pattern:
        """Units, cut once more at characters that occur in no piece: any path costs the same there."""
        chars = "".join(re.escape(c) for c in sorted(self.alphabet - {SPACE}))
        return re.compile(f"{SPACE}*[{chars}]+|{SPACE}+|[^{chars}{SPACE}]")

    @cached_property
    def alphabet(self) -> frozenset[str]:
        return frozenset("".join(self.vocabulary.texts))

    @cached_property
    def never_alone(self) -> frozenset[str]:
        """Characters of pieces that are no piece themselves."""
        return self.alphabet - frozenset(self.vocabulary.texts)

    def unit(self, text: str) -> int:
        """Pieces on the best path through one unit."""
        if len(text) == 1 and text not in self.alphabet:
            return len(text.encode())
        if not self.never_alone.isdisjoint(text):
            return self.with_unknown(text)
        return self.best(self.automaton, text)[1]

    @staticmethod
    def best(automaton: ahocorasick.Automaton, text: str) -> tuple[float, int]:
        """Score and pieces of the best path, if each character is a piece."""
        best, count = [0.0] + [LOW] * len(text), [0] * (len(text) + 1)
        for last, (size, score) in automaton.iter(text):
            end = last + 1
            total = best[end - size] + score
            if total > best[end]:
                best[end], count[end] = total, count[end - size] + 1
        return best[-1], count[-1]

    def with_unknown(self, text: str) -> int:
        """The same where a character of the unit may have to fall back to its bytes;
        that is tried last, as its start is the latest."""
        best, count = [0.0] + [LOW] * len(text), [0] * (len(text) + 1)
        matches: list[list[tuple[int, float]]] = [[] for _ in best]
        for last, match in self.automaton.iter(text):
            matches[last + 1].append(match)
        for end, char in enumerate(text, 1):
            paths = [(size, score, 1) for size, score in matches[end]]
            if char in self.never_alone:
                paths.append((1, self.vocabulary.unknown, len(char.encode())))
            for size, score, pieces in paths:
                total = best[end - size] + score
                if total > best[end]:
                    best[end], count[end] = total, count[end - size] + pieces
        return count[-1]

    def text(self, text: str) -> int:
        if not text:
            return 0
        known, total = self.known, 0
        for unit in self.unit_pattern.findall(SPACE + text.replace(" ", SPACE)):
            n = known.get(unit)
            if n is None:
                n = self.unit(unit)
                if len(unit) <= SHORT and len(known) < REMEMBERED:
                    known[unit] = n
            total += n
        return total


def count_tokens(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The columns of ``docs`` but ``text``, with ``n_tokens``."""
    counter = Counter(vocabulary)

    @pandas_udf("long")
    def udf(texts: pd.Series) -> pd.Series:
        return pd.Series([counter.text(t) if isinstance(t, str) else None for t in texts], dtype="Int64")

    kept = [column(c) for c in others(docs, ["n_tokens", "text"])]
    return docs.select(*kept, udf(column("text")).alias("n_tokens"))
