"""Distributed median and rank against plain Python on small and skewed data."""

import math
import random
import statistics

import pytest

from stratalake.functions import exact_median
from stratalake.operators.joins import spread_join
from stratalake.operators.ranking import rank_in_group

rng = random.Random(7)
CASES = {
    "empty": [],
    "missing only": [None, None],
    "one": [3.5],
    "two": [1.0, 2.0],
    "third equal": [50000.0] * 40 + [rng.uniform(0, 150000) for _ in range(81)],
    "even and odd signs": [rng.gauss(0, 1000) for _ in range(200)],
    "far apart": [-1.7e308, 1e-300, 2.0, 1e18, 1.7e308],
    "narrow": [1.0 + i * 2**-50 for i in range(101)],
    "with missing and nan": [1.0, None, math.nan, 4.0, 10.0],
    "infinite": [-math.inf, 1.0, 2.0, math.inf, math.inf],
    "step edges": [float(2**i) for i in range(40)],
}


@pytest.mark.parametrize("name", CASES)
def test_median(spark, name):
    values = CASES[name]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    real = [v for v in values if v is not None and not math.isnan(v)]
    assert exact_median(df, "v") == (statistics.median(real) if real else None)


def test_rank_in_group(spark):
    rows = []
    for i in range(600):
        group = "big" if i % 3 else rng.choice("abc")
        value = rng.choice([0.0, 0.0, -5.5, rng.uniform(-10, 10), rng.uniform(0, 1e9), 2.0**rng.randrange(40)])
        rows.append((group, i, value))
    df = spark.createDataFrame(rows, "g string, id int, v double").repartition(4)
    got = {r["id"]: r["nth"] for r in rank_in_group(df, "g", "v", "nth").collect()}
    assert got == {
        i: 1 + sum(1 for g2, _, v2 in rows if g2 == g and v2 > v) for g, i, v in rows
    }


def test_rank_of_missing_and_close_values(spark):
    rows = [(None, None), (None, 2.0), ("a", None), ("a", None), ("a", 1.0), ("a", math.nan)]
    rows += [("a", 1.0 + i * 2**-40) for i in range(300)] + [("b", math.inf), ("b", -math.inf), ("b", -0.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(3)
    df.createOrReplaceTempView("ranked_rows")
    want = spark.sql("SELECT g, v, rank() OVER (PARTITION BY g ORDER BY v DESC NULLS LAST) AS nth FROM ranked_rows")
    got = rank_in_group(df, "g", "v", "nth").select("g", "v", "nth")
    assert got.count() == len(rows)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("kind", ["double", "decimal(9,2)", "smallint", "timestamp_ntz", "string"])
def test_spread_join_of_any_key(spark, kind):
    values = "timestamp_ntz'2020-01-01 00:00:00' + make_interval(0, 0, 0, id)" if kind == "timestamp_ntz" else "id"
    rows = spark.range(20).selectExpr(f"CAST({values} AS {kind}) AS k", "id")
    per_key = rows.select("k", "id").withColumnRenamed("id", "other")
    assert spread_join(rows, per_key, "k").where("id = other").count() == 20


def test_spread_join_of_both_zeros(spark):
    rows = spark.createDataFrame([(-0.0, 1), (0.0, 2)], "k double, id int")
    assert spread_join(rows, spark.createDataFrame([(0.0, "z")], "k double, z string"), "k").count() == 2


MANY = {
    "subnormal": [0.0, 5e-324] * 50,
    "two values": [1.0] * 61 + [2.0] * 60,
    "two values, even": [1.0] * 50 + [2.0] * 50,
    "one value": [7.0] * 101,
    "zeros of both signs": [0.0, -0.0] * 40 + [1.0],
    "infinite ends": [-math.inf] * 30 + [math.inf] * 31,
    "a third equal": [5.0] * 100 + [rng.gauss(0, 1e6) for _ in range(200)],
    "sorted": [float(i) for i in range(1000)],
    "close": [1.0 + i * 2**-52 for i in range(500)],
}


@pytest.mark.parametrize("few, sample", [(4, 9), (1, 2)])
def test_median_by_brackets(spark, monkeypatch, few, sample):
    """Also where the sample misses the middle."""
    from stratalake.functions import median

    monkeypatch.setattr(median, "FEW", few)
    monkeypatch.setattr(median, "SAMPLE", sample)
    for name, values in MANY.items():
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
        assert exact_median(df, "v") == statistics.median(values), name


def test_median_reads_its_input_once(spark, monkeypatch):
    from stratalake.functions import median

    seen = spark.sparkContext.accumulator(0)
    monkeypatch.setattr(median, "FEW", 10)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    df = spark.range(0, 5000, 1, 4).selectExpr("CAST(id AS DOUBLE) AS v").mapInPandas(count, "v double")
    assert exact_median(df, "v") == 2499.5 and seen.value == 5000


def test_rank_with_a_third_of_all_rows_on_one_value(spark):
    rows = [("a", 5.0)] * 700 + [(rng.choice("ab"), float(rng.randrange(50))) for _ in range(1400)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    got = sorted(map(tuple, rank_in_group(df, "g", "v", "nth").collect()))
    above = {(g, v): 1 + sum(1 for g2, v2 in rows if g2 == g and v2 > v) for g, v in set(rows)}
    assert got == sorted((g, v, above[g, v]) for g, v in rows)


def test_rank_reads_each_table_once(spark):
    """The plan of the registered query reads what was written, not the models' inputs."""
    from stratalake import catalog

    df = catalog.queries()["customer_rank_in_state"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2 and "c_custkey" not in plan
    assert df._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 2


def test_rank_ranges_carry_their_offsets(spark):
    """A large group lies in many ranges, each sorted apart from the others."""
    rows = [("big", float(i)) for i in range(4000)] + [("small", 1.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r["g"], r["v"]): r["nth"] for r in rank_in_group(df, "g", "v", "nth").collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == {("big", float(i)): 4000 - i for i in range(4000)} | {("small", 1.0): 1}
