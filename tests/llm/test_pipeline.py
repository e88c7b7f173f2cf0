import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

import corpus_pipeline
from stratalake.llm import pieces, sentencepiece_codec
from stratalake.llm.common import Scratch, table
from stratalake.llm.queries import TOKENIZER
from tests.llm.test_near_copies import brute_fingerprint, brute_spans

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs, kept = table(spark, SF, "documents"), []
    columns = docs.columns
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        kept.append(docs)
    good, single, cut, mixed, coded = kept
    assert all(df.columns == columns for df in kept[:-1])
    assert good.where("size(split(trim(text), '\\\\s+')) < 50").count() == 0
    prints = [brute_fingerprint(r.text) for r in single.collect()]
    assert all((a ^ b).bit_count() > 4 for i, a in enumerate(prints) for b in prints[:i])
    assert cut.count() == single.count()
    rows = [(r.doc_id, r.text) for r in cut.collect()]
    assert not any(c for _, c in brute_spans(rows).values())
    assert all(r.n_chars == len(r.text) for r in cut.collect())
    assert {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in cut.collect()}
    texts = sorted((r.doc_id, r.text) for r in mixed.collect())
    back = sentencepiece_codec.decode(coded, pieces.load(TOKENIZER)).collect()
    assert sorted((r.doc_id, r.text) for r in back) == texts


CLASH = "score double, rate string, copy int, copies int, shuffle_key int, n_words string, kept int, whole_row int, `key` int"


def odd_rows(spark):
    """Documents with nulls, blanks and repeats, and columns named as the operators' own."""
    some = table(spark, SF, "documents").where("doc_id < 60")
    texts = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in some.collect()]
    rows = [*texts, *texts[:9], (None, texts[3][1], None, None, None), (901, None, "en", "a", 0), (902, "", None, "a", 0)]
    rows += [(903, " \n ", "en", None, 3), (None, None, None, None, None)]
    extra = (0.5, "r", 7, 8, 9, "w", 1, 2, 3)
    return spark.createDataFrame(
        [(*r, *extra) for r in rows], f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}"
    )


def test_stages_keep_clashing_columns(spark, tmp_path):
    docs = odd_rows(spark)
    columns, kinds = docs.columns, dict(docs.dtypes)
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        rows = docs.collect()
        assert rows
        if number < 4:
            assert docs.columns == columns and dict(docs.dtypes) == kinds
            assert {tuple(r)[5:] for r in rows} == {(0.5, "r", 7, 8, 9, "w", 1, 2, 3)}
            assert all(r.text and r.text.split() for r in rows) or number > 1
        if number == 1:  # repeats, and the copy without an id, are gone
            assert len({r.text for r in rows}) == len(rows) == len({r.doc_id for r in rows})


def test_stages_of_an_empty_table(spark):
    docs = odd_rows(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_stages_hand_python_small_batches(spark):
    """12 MB of texts in one partition reach a worker in several batches, after any stage's call."""

    @pandas_udf("long")
    def held(texts: pd.Series) -> pd.Series:
        return pd.Series([sum(map(len, texts))] * len(texts))

    docs = odd_rows(spark).limit(0)
    large = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("x"), 4000).alias("text"))
    for _, stage in corpus_pipeline.STAGES:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        stage(spark, docs, SF)
        assert large.select(held("text").alias("n")).agg(F.max("n")).first()[0] < 5_000_000


def python_steps(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("ArrowEvalPython") + plan.count("MapInArrow")


def test_cutting_repeats_takes_one_worker_a_task(spark, monkeypatch):
    """No table that is written on the way, nor the result, has two Python steps behind it."""
    docs, found, keep = odd_rows(spark), [], Scratch.keep
    monkeypatch.setattr(Scratch, "keep", lambda self, df: found.append(python_steps(df)) or keep(self, df))
    cut = corpus_pipeline.cut_repeats(spark, docs, SF)
    assert python_steps(cut) == 1 and max(found) == 1
    assert cut.count() == docs.count()
