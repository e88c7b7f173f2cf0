import math
import random

import pytest
from pyspark.sql import functions as F

from stratalake.llm import ann, mixing, quality_rules, url_filter
from stratalake.llm.common import Scratch
from stratalake.llm.queries import RULES, oracle_sql, queries
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"


def test_mix_equals_sql(spark):
    message, rows = compare(spark, duck(SF), queries()["op10_mix"], oracle_sql()["op10_mix"], SF)
    assert message is None and rows > 100


def test_mix_of_odd_tables(spark):
    rows = [(i, f"t{i}", "a" if i % 3 else None, 1, "x") for i in range(600)] + [(None, None, "b", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copy int, `row` string")
    weights = {"a": 1.0, None: 3.0}
    found = mixing.mix(docs, weights, size=4.0)
    assert [c for c in found.columns if c not in mixing.RESULT] == ["doc_id", "text", "source", "row"]
    got = found.collect()
    assert {r.source for r in got} == {"a", None}
    n = {s: sum(r.source == s for r in got) for s in ("a", None)}
    total = 4 * len(rows)
    assert abs(n["a"] - total / 4) < 5 * math.sqrt(total / 4) and abs(n[None] - 3 * total / 4) < 5 * math.sqrt(total)
    assert [r.shuffle_key for r in got] == sorted(r.shuffle_key for r in got)
    assert got == mixing.mix(docs, weights, size=4.0).collect()
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mix(docs, {}, other=0.0).count() == 0
    high = mixing.mix(docs.where("doc_id < 40"), {"a": 1.0}, size=50.0).groupBy("doc_id").count()
    assert abs(high.agg(F.avg("count")).first()[0] - 50 * 40 / 26) < 5


def test_url_rules_and_model(spark):
    hosts = ["a.example.com", "example.com", "www.example.com", "b.example.net", "example.org", "COM"]
    rows = [(i, f"https://{h}/{lang}/{i}?q#f", 1) for i, (h, lang) in enumerate((h, x) for h in hosts for x in ("en", "fr", "es", "de"))]
    rows += [(90, None, 1), (91, "no scheme", 1), (92, "x://example.com", 1), (92, "x://example.com", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host int")
    found = {r.page_id: r for r in url_filter.filter_urls(pages, RULES).collect()}
    assert {(r.host, r.path.split("/")[1]): r.rule for r in found.values() if r.page_id < 90 and r.rule} == {
        **{(h, lang): "com/" for h in ("a.example.com", "example.com", "www.example.com", "com") for lang in ("fr", "es", "de")},
        ("a.example.com", "en"): "example.com/en/", ("example.com", "en"): "example.com/en/",
        ("www.example.com", "en"): "www.example.com/en/", ("com", "en"): "com/",
        ("b.example.net", "fr"): "net/fr/", ("b.example.net", "es"): "net/es/",
    }
    verdict = {r.text: r.verdict for r in RULES}
    assert all(r.verdict == verdict[r.rule] for r in found.values() if r.rule)
    assert {(r.host, r.path, r.rule) for r in found.values() if r.page_id in (90, 91)} == {("", "", None)}
    assert (found[92].host, found[92].path, found[92].rule) == ("example.com", "", None)
    assert {r.verdict for r in found.values()} == {"allow", "block"}
    assert {r.verdict for r in url_filter.filter_urls(pages, []).collect()} == {"allow"}
    assert url_filter.filter_urls(pages.limit(0), RULES).count() == 0


def test_url_model_on_held_out_urls(spark):
    random.seed(4)
    made = [("shop" if i % 2 else "news", random.randrange(10**6), float(i % 2)) for i in range(400)]
    rows = spark.createDataFrame([(f"{k}{n}.test", f"/{k}/{n}", y) for k, n, y in made], "host string, path string, label double")
    pages = spark.createDataFrame([(i, f"http://{k}{n + 1}.test/{k}/{n + 1}") for i, (k, n, _) in enumerate(made)], "page_id long, url string")
    judged = {r.page_id: r.verdict for r in url_filter.filter_urls(pages, [], rows).collect()}
    right = sum((judged[i] == "block") == bool(y) for i, (_, _, y) in enumerate(made))
    assert right >= 0.95 * len(made)


@pytest.mark.parametrize("text", ["", None, "a b c a b c a b c", "one two\none two\n\n x\nx", "é ß 中 " * 30, "a a a a"])
def test_statistics(text):
    words = [w for w in (text or "").replace("\n", " ").split(" ") if w]
    grams = list(zip(words, words[1:], words[2:]))
    again = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.strip()]
    s = quality_rules.stats(text)
    assert (s.n_words, s.word_chars, s.n_repeat_words) == (len(words), sum(map(len, words)), len(again))
    assert s.n_dup_lines == len(lines) - len(set(lines))


def test_quality_on_labels(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    judged = queries()["op7_quality"](spark, sf).join(labels, "doc_id").where("not base_failed")
    kept = {r.quality: r.kept for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert kept[1] > 0.98 and kept[0] < 0.5
    docs = spark.createDataFrame([(1, None, 5), (1, None, 5), (None, "w " * 80, 6)], "doc_id long, text string, kept int")
    assert [r.kept for r in quality_rules.apply_rules(docs, labels.limit(0)).collect()] == [False, False, False]
    assert quality_rules.apply_rules(docs.limit(0), labels).count() == 0


def test_nearest_against_brute_force(spark):
    random.seed(8)
    vectors = [[random.gauss(0, 1) for _ in range(8)] for _ in range(150)]
    rows = [(i, v, 0) for i, v in enumerate(vectors)] + [(200 + i, vectors[3], 0) for i in range(30)]
    odd = [(500, None, 0), (600, [0.0] * 8, 0), (700, [None] * 8, 0), (800, [float("nan")] * 8, 0), (None, vectors[0], 0), (900, [1.0], 0)]
    table = spark.createDataFrame([*rows, *odd, rows[0]], "vec_id long, embedding array<float>, node int")
    found = ann.nearest(table, Scratch(spark, "t"), every=50).collect()
    stored = {r.vec_id: r.embedding for r in table.where("vec_id < 300").collect()}
    stored[900] = [1.0] + [0.0] * 7  # a shorter vector counts as if zeros followed it
    want = []
    for q in (0, 50, 100, 200, 900):
        near = sorted((math.sqrt(sum((x - y) ** 2 for x, y in zip(stored[q], v))), i) for i, v in stored.items() if i != q)
        want += [(q, k, i) for k, (_, i) in enumerate(near[:10], 1)]
    got = sorted((r.query_id, r.rank, r.vec_id) for r in found)
    assert len(got) == len(want) and len(set(got) & set(want)) >= 0.95 * len(want)
    assert got[30:40] == want[30:40]  # equal vectors, ties by id
    assert ann.nearest(table.limit(0), Scratch(spark, "t")).count() == 0
    two = ann.nearest(spark.createDataFrame([(0, [1.0, 2.0]), (7, [1.0, 3.0])], "vec_id long, embedding array<float>"), Scratch(spark, "t"))
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in two.collect()] == [(0, 1, 7, 1.0)]
