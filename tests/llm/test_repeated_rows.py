from pyspark.sql import functions as F

from stratalake.llm import repeats
from stratalake.llm.common import Scratch


def test_repeated_rows_give_their_covers_once(spark, monkeypatch):
    """A third of the table is one row: the list of its covers does not grow with its copies."""
    hot = " ".join(f"h{i}" for i in range(80))
    rows = [(0, hot)] * 200 + [(i, " ".join(f"w{i}x{j}" for j in range(60)) + " " + hot) for i in range(1, 5)]
    rows += [(i, f"short {i}") for i in range(5, 401)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    longest = []

    def merged(df, *columns):
        if "c" in df.columns:
            longest.append(df.agg(F.max(F.size("c"))).first()[0])
        return select(df, *columns)

    select = type(docs).select
    monkeypatch.setattr(type(docs), "select", merged)
    found = repeats.find_repeats(docs, Scratch(spark, "t"))
    monkeypatch.undo()
    assert {(r.doc_id, r.n_words) for r in found.collect()} == {(i, 80) for i in range(5)}
    assert longest and max(longest) <= 80
