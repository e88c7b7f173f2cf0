import random
from itertools import combinations

import numpy as np
import pytest

from stratalake.llm import jaccard
from stratalake.llm.common import Scratch, table

UPPER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def brute(rows, percent=85, shingle=4):
    sets = []
    for _, text in rows:
        words = (text or "").encode().translate(UPPER).split()
        n = min(shingle, len(words))
        sets.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if common and 100 * common >= percent * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted((str(d), len(sets[i]), str(least.get(find(i)))) for i, (d, _) in enumerate(rows))


def edited(words, times):
    words = list(words)
    for _ in range(times):
        words[random.randrange(len(words))] = f"e{random.randrange(10**6)}"
    return words


def corpus(seed):
    random.seed(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    line = random.choices(vocabulary, k=12)  # a frequent line
    out = []
    for _ in range(40):
        own = random.choices(vocabulary, k=random.randint(1, 200))
        out.append(line + own if random.random() < 0.4 else own)
    for _ in range(25):
        base = random.choice(out[:40])
        out += [edited(base, random.choice([1, 1, 2, 3, 6])) for _ in range(random.randint(1, 6))]
    hot = random.choices(vocabulary, k=150)  # near copies at and around the threshold
    out += [edited(hot, random.choice([0, 1, 2, 3, 4, 5, 6])) for _ in range(150)]
    out += [random.choices(vocabulary[:3], k=random.randint(1, 8)) for _ in range(80)]
    out += [out[0], out[0], out[41]]
    texts = [random.choice([" ", "\n", "  "]).join(w) for w in out]
    return texts + ["", None, " \n", texts[3].upper(), "one", "ONE", "one two three", "É é", "É é"]


def found(spark, rows, scratch=None, **options):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, node string, `KEY` int")
    result = jaccard.similar_groups(docs.repartition(5), scratch or Scratch(spark, "t"), **options)
    assert result.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in result.collect())


@pytest.mark.parametrize("seed, short, block, held", [(2, 4, 2048, 1 << 20), (3, 8, 16, 2000)])
def test_against_brute_force(spark, monkeypatch, seed, short, block, held):
    """Also with lists and components beyond the bounds of one group."""
    monkeypatch.setattr(jaccard, "SHORT", short)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "HELD", held)
    rows = list(enumerate(corpus(seed), 5))
    rows += [(None, rows[50][1]), (None, None), (7, rows[2][1])]
    assert found(spark, rows) == brute(rows)


def test_other_thresholds(spark):
    rows = list(enumerate(corpus(4)))
    for percent, shingle in ((60, 2),):
        assert found(spark, rows, percent=percent, shingle=shingle) == brute(rows, percent, shingle)


def test_odd_tables(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None), (2, ""), (None, " ")]) == [("1", 0, "1"), ("2", 0, "2"), ("None", 0, "None")]
    long = " ".join(f"v{i % 90_000}" for i in range(300_000))
    rows = [(1, long), (2, long + " end"), (3, long), (4, "short one")]
    assert [r[2] for r in found(spark, rows)] == ["1", "1", "1", "4"]


def test_repeated_rows_hold_a_third(spark):
    texts = corpus(6)
    rows = list(enumerate(texts)) + [(3, texts[3])] * (len(texts) // 2)
    assert found(spark, rows) == brute(rows)


def test_prefixes_share_enough():
    """Similar sets share as many prefix elements as the lesser choice asks for."""
    random.seed(7)
    hashes = jaccard.WordHashes()
    texts = [t for t in corpus(8) if t]
    sets = [jaccard.shingle_set(t, 4, hashes) for t in texts]
    sets = [s for s in {s.tobytes(): s for s in sets}.values() if len(s)]
    lists = [jaccard.listed(s, 85) for s in sets]
    count = {}
    for some, _ in lists:
        for e in some.tolist():
            count[e] = count.get(e, 0) + 1
    chosen = []
    for s, (some, sampled) in zip(sets, lists):
        element = np.array([e for e in some.tolist() if count[e] > 1], dtype=np.int64)
        held = np.array([count[e] for e in element.tolist()], dtype=np.int64)
        chosen.append(jaccard.lengthened(len(s), sampled, held, element, 85))
    similar = extras = 0
    for (s, x), (t, y) in combinations(zip(sets, chosen), 2):
        if len(s) > len(t):
            s, t, x, y = t, s, y, x
        common = len(np.intersect1d(s, t))
        if 100 * common >= 85 * (len(s) + len(t) - common):
            similar += 1
            inner = set(x[1][x[2]].tolist())
            assert len(inner & set(y[1].tolist())) >= min(x[0], y[0])
            extras += min(x[0], y[0]) > 1
    assert similar > 100 and extras > 10


def test_query_on_whole_table(spark):
    from stratalake.llm import queries

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    got = queries.queries()["op13_similar_sets"](spark, sf).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute(rows)
