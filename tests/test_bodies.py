"""Whole-body snapshots: any layout of JSON, rejects, layout of the table, repeated batches."""

import json
from contextlib import ExitStack

from pyspark.sql import functions as F

from stratalake.sources import files
from stratalake.sources.files import read_whole_files, snapshots_in, stream_whole_files
from stratalake.streaming import snapshots
from tests.test_flights import state


def write(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


def body(time, *names, **options):
    return json.dumps({"time": time, "states": [state(n) for n in names]}, **options)


def ingest(spark, base, per_batch=1000):
    texts = stream_whole_files(spark, f"{base}/in", per_batch)
    snapshots.ingest_bodies(texts, f"{base}/t", f"{base}/r", f"{base}/c").awaitTermination()
    return snapshots.ingested(spark, f"{base}/t"), snapshots.rejected(spark, f"{base}/r")


def test_layouts(spark, tmp_path):
    cases = {
        "pretty": (body(1, "a", "b", indent=2), [True]),
        "line": (body(1, "a"), [True]),
        "lines": (body(1, "a") + "\n\n" + body(2, "b") + "\r\n<busy>\n", [False, True, True]),
        "two printed": (body(1, "a", indent=1) + "\n" + body(2, "b", indent=1), [False]),
        "trailing": (body(1, "a") + " x", [False]),
        "half": (body(1, "a", indent=1)[:-5], [False]),
        "wrong type": ('{"time": 3, "states": "none"}', [False]),
        "page": ("<html>\nbusy\n</html>", [False]),
        "no states": ('{\n"time": 4\n}', [True]),
        "blank": (" \n\n", []),
        "empty": ("", []),
    }
    for name, (text, _) in cases.items():
        write(tmp_path / "in", f"{name}.json", text)
    found = {}
    for row in snapshots_in(read_whole_files(spark, f"{tmp_path}/in")).collect():
        name = row["file"].rsplit("/", 1)[1].replace("%20", " ").removesuffix(".json")
        found.setdefault(name, []).append(row["is_snapshot"])
    assert {n: sorted(v) for n, v in found.items()} == {n: v for n, (_, v) in cases.items() if v}
    table, rejects = ingest(spark, tmp_path)
    assert sorted(r["icao24"] for r in table.collect()) == ["a", "a", "a", "b", "b"]
    bodies = {r["body"] for r in rejects.collect()}
    assert cases["half"][0] in bodies and cases["page"][0] in bodies and len(bodies) == 6


def test_only_new_files_are_added(spark, tmp_path):
    write(tmp_path / "in", "1.json", body(1, "a", "b", indent=1))
    for _ in range(2):
        table, rejects = ingest(spark, tmp_path)
        assert table.count() == 2 and rejects.count() == 0
    write(tmp_path / "in", "2.json", body(2, "a", indent=3))
    write(tmp_path / "in", "3.json", "{")
    table, rejects = ingest(spark, tmp_path)
    assert table.count() == 3 and [r["body"] for r in rejects.collect()] == ["{"]
    assert table.where("ingested_at IS NULL").isEmpty()


def test_a_repeated_batch_adds_nothing(spark, tmp_path, monkeypatch):
    """The stream stops after the table's folder is written and before the batch is done."""
    write(tmp_path / "in", "1.json", body(1, "a", "b"))
    write(tmp_path / "in", "2.json", "broken")
    size = F.size
    with monkeypatch.context() as patch:

        def stop(name):
            raise RuntimeError("stopped")

        patch.setattr(snapshots.F, "size", stop)  # first used for the rejects
        try:
            ingest(spark, tmp_path)
            raise AssertionError("not stopped")
        except AssertionError:
            raise
        except Exception as error:  # noqa: BLE001
            assert "stopped" in str(error)
    assert F.size is size
    assert snapshots.ingested(spark, f"{tmp_path}/t").count() == 2  # already there
    table, rejects = ingest(spark, tmp_path)
    assert table.count() == 2 and rejects.count() == 1


def test_months_are_sorted_and_files_few(spark, tmp_path):
    moments = [1_790_000_000 + i * 86_400 for i in range(60)]
    states = [state(f"x{i % 7}", seen=t) for i, t in enumerate(moments) for _ in range(3)]
    for part in range(6):
        write(tmp_path / "in", f"{part}.json", json.dumps({"time": 1, "states": states[part::6]}, indent=1))
    table, _ = ingest(spark, tmp_path)
    by_file = {}
    for r in table.select("ym", "event_time", "icao24", F.col("_metadata.file_path").alias("f")).collect():
        by_file.setdefault((r["ym"], r["f"]), []).append((r["event_time"], r["icao24"]))
    assert sum(map(len, by_file.values())) == 180
    assert all(rows == sorted(rows) for rows in by_file.values())
    for month in {m for m, _ in by_file}:
        ranges = sorted((rows[0][0], rows[-1][0]) for (m, _), rows in by_file.items() if m == month)
        assert len(ranges) <= 8 and all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    assert "PartitionFilters: [isnotnull(ym" in table.where("ym = '202610'")._jdf.queryExecution().toString()


def test_a_backlog_of_small_files_is_one_batch(spark, tmp_path):
    for i in range(1100):
        write(tmp_path / "in", f"{i}.json", body(i, f"n{i}") if i % 2 else '{"time":\n 1')
    texts = stream_whole_files(spark, f"{tmp_path}/in")
    query = snapshots.ingest_bodies(texts, f"{tmp_path}/t", f"{tmp_path}/r", f"{tmp_path}/c")
    query.awaitTermination()
    assert snapshots.ingested(spark, f"{tmp_path}/t").count() == snapshots.rejected(spark, f"{tmp_path}/r").count() == 550
    assert [p.name for p in (tmp_path / "c" / "commits").iterdir() if p.name.isdigit()] == ["0"]


def test_large_files_of_a_body_a_line_are_read_by_many_tasks(spark, tmp_path, monkeypatch):
    """The same bodies as of whole files, whatever comes first in a file, and no task holds the file."""
    cases = {
        "lines": "\n".join(body(i, f"n{i}") for i in range(2000)) + "\n{\n",
        "broken first": "<busy>\n \n" + body(1, "a") + "\n\n" + body(2, "b") + "\r\n",
        "half first": body(1, "a")[:-3] + "\n" + body(2, "b"),
        "white first": "\t\n\r\n" + body(1, "a", indent=1) + "\n" + body(2, "b"),
        "nested": '{"time": 1, "other":\n' + body(2, "b") + "\n}",
        "white and nested": '\r\n{"time": 1, "other":\n' + body(2, "b") + "\n}",
        "array [1]": "[\n" + body(1, "a") + "\n]",
        "pretty": body(3, "a", "b", indent=1),
        "page": "<html>\nbusy\n</html>\n",
        "one": body(4, "a") + "\n",
    }
    for name, text in cases.items():
        write(tmp_path / "in", f"{name}.json", text)
    landed = spark.read.format("binaryFile").load(f"{tmp_path}/in").select("path", "length").collect()
    want = snapshots_in(read_whole_files(spark, f"{tmp_path}/in")).collect()
    monkeypatch.setattr(files, "LARGE_FILE", 10)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        with ExitStack() as held:
            found = files.landed_bodies(spark, landed, held)
            rows = found.withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(map(repr, map(tuple, want))) == sorted(repr(tuple(r)[:-1]) for r in rows)
    assert len({r["task"] for r in rows if r["file"].endswith("/lines.json")}) > 4
    assert any("array%20" in r["file"] for r in rows)
