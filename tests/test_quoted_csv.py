"""Quoted line breaks across splits, against the reader that takes a file in one task."""

import random

import pytest

from stratalake.sources.files import read_csv
from stratalake.sources.quoted import lines_of, read_quoted_csv, records_of


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def small_splits(spark):
    """Splits of a few thousand bytes."""
    settings = {"spark.sql.files.maxPartitionBytes": "2500", "spark.sql.files.openCostInBytes": "1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def table(seed, n=150):
    random.seed(seed)
    values = ["", "plain", "two words", 'a ""quoted"" word', "line\nbreak", "\n", "a,b", '""', "é\n\n,\n", "x" * 700, "tail \n" * 60]
    lines = ["Id, Title ,message"]
    for i in range(n):
        cells = [str(i)]
        for _ in range(2):
            v = random.choice(values)
            bare = v and not set(v) & set('",\n') and random.random() < 0.5
            cells.append(v if bare else f'"{v}"')
        lines.append(",".join(cells))
    return "\n".join(lines)


@pytest.mark.parametrize("seed, end", [(1, "\n"), (2, "\n\n")])
def test_equals_the_reader_of_whole_files(spark, tmp_path, small_splits, seed, end):
    (tmp_path / "in").mkdir()
    for part in range(3):
        (tmp_path / "in" / f"{part}.csv").write_text(table(10 * seed + part) + end)
    found = read_quoted_csv(spark, str(tmp_path / "in"))
    want = read_csv(spark, str(tmp_path / "in"), multi_line=True)
    assert found.columns == want.columns == ["id", "title", "message"]
    assert found.count() == want.count() == 450
    assert rows(found) == rows(want)


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_splits):
    path = tmp_path / "one.csv"
    path.write_text(table(5))
    lines = lines_of(spark, str(path))
    assert lines.rdd.getNumPartitions() > 5
    folder = str(tmp_path / "lines")
    lines.write.parquet(folder)
    records = records_of(spark.read.parquet(folder))
    assert sorted(r["number"] for r in records.collect()) == list(range(1, 152))
    assert read_csv(spark, str(path), multi_line=True).rdd.getNumPartitions() == 1


def test_windows_line_ends(spark, tmp_path):
    path = tmp_path / "w.csv"
    path.write_bytes(b'id,text\r\n1,"a"\r\n2,"b ""c"""\r\n')
    assert rows(read_quoted_csv(spark, str(path))) == [("1", "a"), ("2", 'b "c"')]


def test_headers(spark, tmp_path):
    with pytest.raises(Exception, match="no header"):
        (tmp_path / "empty.csv").write_text("")
        read_quoted_csv(spark, str(tmp_path / "empty.csv"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text('id,"the\ntext"\n1,x\n')
    assert rows(read_quoted_csv(spark, str(tmp_path / "in"))) == [("1", "x")]
    (tmp_path / "in" / "b.csv").write_text("text,id\ny,2\n")
    with pytest.raises(ValueError, match="does not conform to the schema"):
        read_quoted_csv(spark, str(tmp_path / "in"))
    (tmp_path / "only.csv").write_text("id,text\n")
    assert rows(read_quoted_csv(spark, str(tmp_path / "only.csv"))) == []
