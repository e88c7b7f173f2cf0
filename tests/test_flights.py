import datetime
import json

from stratalake.plans import flights
from stratalake.sources.files import read_snapshots
from stratalake.streaming.snapshots import append_rejects, append_states, snapshot_stream

ts = datetime.datetime


def state(icao, callsign="GA1 ", seen=1_790_000_000, ground=False, latitude=1.5):
    return [icao, callsign, "Indonesia", seen, seen, 106.5, latitude, 1000, ground, 200.25, 90.0, 0,
            None, 1010.5, None, False, 0]


def land(folder, name, payload):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps(payload) + "\n")


def test_states(spark, tmp_path):
    land(tmp_path / "in", "a.json", {"time": 1, "states": [
        state("a"), state("b", callsign=None, ground=True), state("c", seen=None), state("d", latitude=None),
    ]})
    land(tmp_path / "in", "b.json", {"time": 1, "states": []})
    land(tmp_path / "in", "c.json", {"time": 1, "states": None})
    land(tmp_path / "in", "d.json", {"time": 1})
    raw = flights.flight_states(read_snapshots(spark, str(tmp_path / "in")))
    rows = {r["icao24"]: r for r in raw.collect()}
    assert sorted(rows) == ["a", "b", "d"]
    assert tuple(rows["a"]) == (
        ts(2026, 9, 21, 14, 13, 20), "a", "GA1", "Indonesia", 106.5, 1.5, 1000.0, 1010.5, 200.25, 90.0, 0.0, 0,
    )
    assert (rows["b"]["callsign"], rows["b"]["on_ground"]) == ("", 1)
    silver = flights.silver_flights(flights.stamped(raw))
    assert silver.count() == 2 and len(silver.columns) == 13
    summary = flights.gold_flight_summary(silver).first()
    assert tuple(summary) == ("Indonesia", 2, 1, 1, 50.0, 720.9, 1000.0)


def test_short_state(spark, tmp_path):
    land(tmp_path / "in", "a.json", {"states": [state("a")[:9]]})
    row = flights.flight_states(read_snapshots(spark, str(tmp_path / "in"))).first()
    assert row["geo_altitude"] is None and row["on_ground"] == 0


def ingest(spark, base, per_batch=1000):
    stream = snapshot_stream(spark, f"{base}/in", per_batch)
    append_states(stream, f"{base}/table", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/table")


def test_hourly_ingest_adds_only_new_files(spark, tmp_path):
    land(tmp_path / "in", "h1.json", {"time": 1, "states": [state("a"), state("b")]})
    assert ingest(spark, tmp_path).count() == 2
    assert ingest(spark, tmp_path).count() == 2
    # The next full snapshot repeats a state; both rows stay.
    land(tmp_path / "in", "h2.json", {"time": 2, "states": [state("a"), state("c", seen=1_793_000_000)]})
    table = ingest(spark, tmp_path)
    assert sorted((r["icao24"], r["ym"]) for r in table.collect()) == [
        ("a", 202609), ("a", 202609), ("b", 202609), ("c", 202610),
    ]
    assert table.where("ingested_at IS NULL").isEmpty()


def test_one_or_many_batches_give_the_same_rows(spark, tmp_path):
    results = []
    for name, per_batch in (("one", 1000), ("many", 1)):
        base = tmp_path / name
        base.mkdir()
        for i in range(4):
            land(base / "in", f"h{i}.json", {"time": i, "states": [state(f"{i}-{j}") for j in range(3)]})
        rows = ingest(spark, base, per_batch).drop("ingested_at").collect()
        results.append(sorted(tuple(r) for r in rows))
    assert results[0] == results[1] and len(results[0]) == 12


def test_what_is_no_snapshot_is_kept(spark, tmp_path):
    land(tmp_path / "in", "good.json", {"time": 1, "states": [state("a")]})
    pretty = json.dumps({"time": 2, "states": [state("b")]}, indent=1)
    (tmp_path / "in" / "pretty.json").write_text(pretty + "\n")
    (tmp_path / "in" / "page.json").write_text("<html>busy</html>\n")
    (tmp_path / "in" / "text.json").write_text('{"time": 3, "states": "none"}\n')
    assert ingest(spark, tmp_path).count() == 1
    for _ in range(2):
        stream = snapshot_stream(spark, f"{tmp_path}/in")
        append_rejects(stream, f"{tmp_path}/rejects", f"{tmp_path}/rejects-seen").awaitTermination()
    kept = spark.read.parquet(f"{tmp_path}/rejects").collect()
    by_file = {}
    for row in kept:
        by_file.setdefault(row["file"].rsplit("/", 1)[1], []).append(row["body"])
    assert sorted(by_file) == ["page.json", "pretty.json", "text.json"]
    assert by_file["page.json"] == ["<html>busy</html>"]
    assert sorted(by_file["pretty.json"]) == sorted(pretty.splitlines())
