import math

import numpy as np
import pytest

from stratalake.llm import quality_rules
from stratalake.llm.isolation import Forest, usual_path

SF = "/root/testdata/sf0.01"


def walked(forest, row):
    """Score of one row, tree by tree, step by step."""
    total = 0.0
    for feature, cut, left, right, length in forest.trees:
        at = 0
        while feature[at] >= 0:
            at = left[at] if row[feature[at]] < cut[at] else right[at]
        total += length[at]
    return 2.0 ** -(total / len(forest.trees) / forest.usual)


def test_scores_against_single_walks():
    rows = np.random.default_rng(2).standard_normal((200, 6))
    rows[:5] += 9.0
    forest = Forest.grow(rows, 50, 16, 1)
    assert np.allclose(forest.score(rows), [walked(forest, r) for r in rows], rtol=1e-12)
    assert forest.usual == usual_path(16) and forest.score(rows[:5]).min() > np.median(forest.score(rows))


def test_threshold_covers_labels_beyond_the_sample(spark, monkeypatch):
    """The forest grows on 100 documents; threshold and verdicts against plain Python over all."""
    monkeypatch.setattr(quality_rules, "SAMPLE", 100)
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    known = quality_rules.known_quality(labels)
    sample = quality_rules.labelled_sample(docs, known)
    assert sample.select("doc_id").distinct().count() == 100
    forest = quality_rules.train(sample)
    quality = {r.doc_id: r.quality for r in known.collect()}
    every = [(r.doc_id, quality_rules.stats(r.text)) for r in docs.select("doc_id", "text").collect()]
    score = {i: walked(forest, s.features) for i, s in every if not s.base_failed}
    good = [score[i] for i, s in every if not s.base_failed and quality.get(i, 0) > 0]
    assert len(good) > 200
    need = quality_rules.KEEP * len(good)
    steps = sorted(math.ceil(x * quality_rules.GRID) for x in good)
    want = next(x for n, x in enumerate(steps, 1) if n >= need) / quality_rules.GRID
    assert quality_rules.calibrated(docs, known, forest) == want
    judged = quality_rules.apply_rules(docs, labels).collect()
    assert {r.doc_id: r.kept for r in judged} == {i: i in score and score[i] <= want for i, _ in every}


def test_labels_of_other_documents_leave_the_sample_whole(spark, monkeypatch):
    monkeypatch.setattr(quality_rules, "SAMPLE", 5)
    docs = spark.createDataFrame([(i, "t") for i in range(3)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(500)], "doc_id long, quality int")
    assert quality_rules.labelled_sample(docs, quality_rules.known_quality(labels)).count() == 3


@pytest.mark.parametrize("quality", [0, None])
def test_without_good_labels_the_base_rules_decide(spark, quality):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(1, words), (1, words), (2, "few words"), (None, words), (3, None), (4, "long " * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, quality) for i in (1, 2, 3, 4)], "doc_id long, quality int")
    judged = quality_rules.apply_rules(docs, labels).collect()
    assert sorted((r.doc_id or 0, r.kept) for r in judged) == [(0, True), (1, True), (1, True), (2, False), (3, False), (4, False)]


def test_a_repeated_row_holds_a_third_and_counts_each_time(spark):
    words = [" ".join(f"w{i}x{k}" for k in range(60 + i)) for i in range(40)]
    rows = [(i, w) for i, w in enumerate(words)] + [(7, words[7])] * 20
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(40)] + [(7, 1)], "doc_id long, quality int")
    model = quality_rules.fitted(docs, labels)
    judged = quality_rules.apply_rules(docs, labels).collect()
    assert len(judged) == len(rows) and sum(r.kept for r in judged) >= quality_rules.KEEP * len(rows)
    assert all(r.kept == (r.score <= model.threshold) for r in judged)
