import datetime

import pytest
from pyspark.sql import functions as F

from stratalake import functions as fn

ts = datetime.datetime


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("c")).alias("x")).collect()]


def test_strip_takes_all_unicode_space(spark):
    space = "\t\n " + chr(0xA0) + chr(0x3000) + chr(0x2028)
    texts = [f"{space}a b{space}", space, "", None]
    assert column(spark, texts, "string", fn.strip) == ["a b", "", "", None]


def test_na_tokens(spark):
    texts = ["NA", "null", "", "n/a", "<NA>", " NA", "na", "x", None]
    assert column(spark, texts, "string", fn.na_to_null) == [None] * 5 + [" NA", "na", "x", None]


def test_to_number(spark):
    texts = ["1", " 2.5 ", "-3e2", "1.0d", "0x1p3", "1,0", "x", "", "inf", None]
    expected = [1.0, 2.5, -300.0] + [None] * 7
    assert column(spark, texts, "string", fn.to_number) == expected


def test_to_int_cuts_the_fraction(spark):
    texts = ["12.7", "-12.7", "1e3", "9007199254740993", "x", "", "1e300", None]
    expected = [12, -12, 1000, 9007199254740993, 0, 0, 0, 0]
    assert column(spark, texts, "string", fn.to_int) == expected


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Asia/Jakarta"])
def test_to_ts_takes_one_format_in_any_zone(spark, zone):
    texts = ["2017-10-15 00:30:00", "2017-10-15", "2017-13-01 00:00:00", "x", None]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = column(spark, texts, "string", fn.to_ts)
        # The clock of Sao Paulo skips this half hour.
        day = column(spark, ["10/15/2017"], "string", lambda c: fn.to_date_ts(c, "M/d/yyyy"))
        epoch = column(spark, [1508027400, 0], "bigint", fn.epoch_to_ts)
        pairs = spark.createDataFrame(
            [(ts(2017, 10, 14, 23, 0), ts(2017, 10, 15, 1, 0)), (ts(2020, 1, 1), None)],
            "a timestamp_ntz, b timestamp_ntz",
        )
        seconds = [r[0] for r in pairs.select(fn.seconds_between(F.col("a"), F.col("b"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [ts(2017, 10, 15, 0, 30), None, None, None, None]
    assert day == [ts(2017, 10, 15)]
    assert epoch == [ts(2017, 10, 15, 0, 30), ts(1970, 1, 1)]
    assert seconds == [7200, None]


def test_to_date_ts(spark):
    texts = ["8/6/1993", "12/31/1999", "13/1/1999", "1993-08-06", "", None]
    got = column(spark, texts, "string", lambda c: fn.to_date_ts(c, "M/d/yyyy"))
    assert got == [ts(1993, 8, 6), ts(1999, 12, 31), None, None, None, None]


def test_initcap_words(spark):
    texts = ["santa barbara d'oeste", "MOGI-guacu", "sao paulo/sp", "3rios", "a1b", "", None]
    assert column(spark, texts, "string", fn.initcap_words) == [
        "Santa Barbara D'Oeste", "Mogi-Guacu", "Sao Paulo/Sp", "3rios", "A1b", "", None,
    ]


def test_clamp_and_non_negative(spark):
    assert column(spark, [-1, 0, 1, 5, 6, None], "int", lambda c: fn.clamp(c, 1, 5)) == [1, 1, 1, 5, 5, None]
    assert column(spark, [-1.0, None, 0.0, 2.5], "double", fn.non_negative) == [0.0, 0.0, 0.0, 2.5]


def test_truthy(spark):
    texts = ["true", "True", "1", "false", "0", "", None]
    assert column(spark, texts, "string", fn.truthy) == [1, 1, 1, 0, 0, 0, 0]


def test_band_edges(spark):
    labels = ("a", "b", "c")
    got = column(spark, [49999.99, 50000.0, 99999.99, 100000.0, None], "double",
                 lambda c: fn.band(c, 50000, 100000, labels))
    assert got == ["a", "b", "b", "c", "c"]


def test_round2_halves_up(spark):
    assert column(spark, [0.125, 2.5, 1.004999, None], "double", fn.round2) == [0.13, 2.5, 1.0, None]


def test_safe_ratio(spark):
    df = spark.createDataFrame([(1, 3), (0, 0), (2, 2)], "a int, b int")
    got = [r[0] for r in df.select(fn.safe_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [0.33, 0.0, 1.0]


def test_exact_sum_of_large_negative_and_missing(spark):
    rows = [(0.1,)] * 30 + [(-12345678901.2345,), (99999999999.9999,), (None,), (-0.0001,)]
    df = spark.createDataFrame(rows, "c double").repartition(5)
    got = df.agg(fn.exact_sum(F.col("c")).alias("s")).first()["s"]
    assert got == 30 * 1000 - 123456789012345 + 999999999999999 - 1
    assert df.where("c IS NULL").agg(fn.exact_sum(F.col("c"))).first()[0] is None


def test_exact_avg_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "c double")
    assert df.agg(fn.exact_avg(F.col("c"))).first()[0] is None
