import random
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import functions as F

from stratalake.llm import repeats, simhash
from stratalake.llm.common import Scratch


def texts(n=60):
    random.seed(11)
    vocabulary = [f"w{i}" for i in range(400)]
    out = [" ".join(random.choices(vocabulary, k=random.randint(1, 300))) for _ in range(n)]
    for text in out[:20]:
        some = text.split(" ")
        if len(some) > 60:
            some[random.randrange(len(some))] = "changed"
            out.append(" ".join(some))
    passage = " ".join(random.choices(vocabulary, k=60))
    short = " ".join(random.choices(vocabulary, k=49))
    for i in range(0, 30, 3):
        out.append(f"{out[i]}\n{passage} {out[i + 1]} {short} end{i}")
    return out + ["", None, " \n ", "one two", "ONE two", "x " * 400, out[3], out[3]]


def brute_fingerprint(text):
    words = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()).split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, fp string, `_h` int")


def test_masks_cover():
    masks = [m % (1 << 64) for m in simhash.masks(4)]
    assert len(masks) == 31
    random.seed(1)
    for _ in range(3000):
        bits = sum(1 << b for b in random.sample(range(64), 4))
        assert any(not m & bits for m in masks)


def test_groups(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(texts())] + [(None, None, None, None), (5, texts()[5], "x", 1)]
    prints = [brute_fingerprint(t) for _, t, _, _ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 4:
            root[find(i)] = find(j)
    least = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            least[find(i)] = min(least.get(find(i), row[0]), row[0])
    want = sorted((str(r[0]), f"{p:016x}", least[find(i)]) for i, (r, p) in enumerate(zip(rows, prints)))
    found = simhash.near_duplicates(table(spark, rows), Scratch(spark, "t")).collect()
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in found) == want
    kept = simhash.one_of_each(table(spark, rows), Scratch(spark, "t"))
    assert kept.columns == ["doc_id", "text", "fp", "_h"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values()))
    assert simhash.near_duplicates(table(spark, []), Scratch(spark, "t")).count() == 0
    assert simhash.one_of_each(table(spark, []), Scratch(spark, "t")).count() == 0


def test_large_bucket_is_split(spark, monkeypatch):
    """Blocks of a bucket give the same components as the whole."""
    random.seed(2)
    values = [random.getrandbits(63) for _ in range(6)]
    near = sorted({v ^ 1 << random.randrange(63) ^ 1 << random.randrange(63) for v in values for _ in range(60)})
    prints = spark.createDataFrame([(v,) for v in near], "fp long")
    whole = {(min(a, b), max(a, b)) for a, b in simhash.forest(np.array(near), 4)}
    monkeypatch.setattr(simhash, "BLOCK", 16)
    links = [(r.a, r.b) for r in simhash.links(prints, 4).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in links)
    from stratalake.llm.components import components

    def roots(pairs):
        df = spark.createDataFrame(sorted(pairs), "a long, b long")
        return {r.node: r.root for r in components(df, Scratch(spark, "t")).collect()}

    assert roots(links) == roots(whole)


def brute_spans(rows):
    """Words in stretches of 50 that occur again, and those that occurred before."""
    where = {}
    for doc, text in sorted({(d, t) for d, t in rows if t}, key=lambda r: r[0]):
        w = text.split()
        for i in range(len(w) - 49):
            where.setdefault(tuple(w[i : i + 50]), []).append((doc, i))
    marks = {}
    for places in where.values():
        if len(places) > 1:
            for doc, i in places:
                again, cut = marks.setdefault(doc, (set(), set()))
                again.update(range(i, i + 50))
                if (doc, i) != min(places):
                    cut.update(range(i, i + 50))
    return marks


def test_repeats(spark):
    rows = [(i, t) for i, t in enumerate(texts())]
    docs = table(spark, [(i, t, "x", 1) for i, t in rows])
    marks = brute_spans(rows)
    again = {}
    for r in repeats.find_repeats(docs, Scratch(spark, "t")).collect():
        words, n = again.setdefault(r.doc_id, (set(), []))
        words.update(range(r.begin, r.end))
        n.append(r.n_cut)
    assert {d: (w, sum(n)) for d, (w, n) in again.items()} == {d: (a, len(c)) for d, (a, c) in marks.items()}
    cut = {r.doc_id: r.text for r in repeats.without_repeats(docs, Scratch(spark, "t")).collect()}
    assert len(cut) == len(rows)
    for doc, text in rows:
        gone = marks.get(doc, (set(), set()))[1]
        if not gone:
            assert cut[doc] == text
        else:
            assert cut[doc].split() == [w for i, w in enumerate(text.split()) if i not in gone]
    left = brute_spans(list(cut.items()))
    assert not any(c for _, c in left.values())


def test_repeats_of_odd_tables(spark):
    long = " ".join(f"v{i}" for i in range(120))
    docs = table(spark, [(None, long, "a", 1), (1, long, "b", 2), (1, long, "b", 2), (2, None, None, None), (3, "", "", 0)])
    found = repeats.find_repeats(docs, Scratch(spark, "t")).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_cut) for r in found) == [("1", 120, 120), ("None", 120, 0)]
    kept = repeats.without_repeats(docs, Scratch(spark, "t")).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept if r.fp) == [("1", ""), ("1", ""), ("None", long)]
    assert repeats.find_repeats(docs.limit(0), Scratch(spark, "t")).count() == 0
    assert repeats.without_repeats(docs.where(F.lit(False)), Scratch(spark, "t")).count() == 0


def test_joins_with_a_hot_root_are_split(spark):
    """A component that holds most fingerprints: its joins read both sides from a shuffle or a table."""
    from stratalake.llm import components

    edges = spark.range(1, 3000).selectExpr("id AS u", "CAST(0 AS BIGINT) AS v")
    plan = components._large_star(edges)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(u" in plan and "_spread" in plan
    found = components.components(edges, Scratch(spark, "t"))
    assert found.count() == 2999 and found.select("root").distinct().count() == 1


def test_exploded_fingerprints_are_not_broadcast(spark):
    """Each fingerprint becomes 31 rows, which Spark's size of the table leaves out."""
    prints = Scratch(spark, "t").keep(spark.range(2000).select(F.xxhash64("id").alias("fp")))
    plan = simhash.links(prints, 4)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
