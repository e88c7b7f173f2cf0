"""CSV files whose quoted values hold line breaks, read by many tasks.

A reader that allows line breaks in values must read a file from its start, in one task. Here
the files are read as lines, split wherever Spark splits them. Whether a line begins inside a
quoted value is told by the quotes before it: an odd number leaves one open (a quote within a
value is written twice and changes nothing). The quotes of each split are counted, a
running sum over the splits of a file carries the parity on, and a window over the lines of one
split gives each line its own. A line that begins outside of quotes begins a record; lines
that begin inside belong to the record before, which may begin in an earlier split. Most
records are one line and are not moved; only those of several lines meet, by number, and are put
together in the order of their lines. Records are then parsed one by one by Spark's CSV parser.

Values with quotes must be quoted themselves, as the CSV format asks: a lone quote in a bare
value counts as one that opens. Files must be uncompressed to be split.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratalake.session import run_dir
from stratalake.sources.files import lower_header

FORMAT = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """file, split, row (in the order of the split), line, and its number of quotes."""
    raw = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        # A task numbers its rows in order, and reads the rows of a split one after the other.
        F.monotonically_increasing_id().alias("row"),
        F.col("value").alias("line"),
    )
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    return raw.withColumn("quotes", quotes)


def records_of(lines: DataFrame) -> DataFrame:
    """file, number (from 1 in each file) and text of each record. ``lines`` is read three times
    and must number its rows alike, as a written table does."""
    rest = W.partitionBy("file", "split").orderBy("row")
    earlier = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)

    def carried(column: str):
        return F.coalesce(F.sum(column).over(earlier), F.lit(0))

    # One row per split: how many quotes stand before it.
    opened = lines.groupBy("file", "split").agg(F.sum("quotes").alias("quotes"))
    opened = opened.select("file", "split", carried("quotes").alias("before"))
    place = ["file", "split"]
    before = F.col("before") + F.sum("quotes").over(rest) - F.col("quotes")
    told = lines.join(opened, place).withColumn("begins", (before % 2 == 0).cast("int"))
    # Records begun in earlier splits number those of this one.
    begun = told.groupBy("file", "split").agg(F.sum("begins").alias("begun"))
    begun = begun.select("file", "split", carried("begun").alias("records"))
    number = F.col("records") + F.sum("begins").over(rest)
    whole = (F.col("begins") == 1) & (F.col("quotes") % 2 == 0)
    numbered = told.join(begun, place).select(
        "file", number.alias("number"), "split", "row", "line", whole.alias("whole")
    )
    parts = numbered.where(~F.col("whole")).groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("split", "row", "line"))).alias("lines")
    )
    single = numbered.where("whole").select("file", "number", F.col("line").alias("record"))
    several = parts.select("file", "number", F.array_join("lines.line", "\n").alias("record"))
    records = single.unionByName(several)
    return records.withColumn("record", F.regexp_replace("record", "\r$", ""))


def read_quoted_csv(
    spark: SparkSession, path: str, header: Callable[[str], str] = lower_header
) -> DataFrame:
    """A CSV with a header line in each file as text columns, names normalised.

    The lines are written once to the shared folder, so that all steps see them in one order; the
    result reads them from there, and they stay for the caller to remove. All files must have
    the same header; another one is an error. Blank lines are no records.
    """
    folder = run_dir(spark, "quoted-csv")
    found = lines_of(spark, path)
    found.write.parquet(folder)
    records = records_of(spark.read.schema(found.schema).parquet(folder))
    # The first records alone: a header may hold line breaks too.
    headers = [r["record"] for r in records.where("number = 1").select("record").distinct().limit(2).collect()]
    if not headers:
        raise ValueError(f"no header in {path}")
    if len(headers) > 1:
        raise ValueError(f"the header of a file does not conform to the schema of the others: {headers}")
    names = spark.read.csv(spark.sparkContext.parallelize(headers, 1), **FORMAT).first()
    schema = ", ".join(f"`c{i}` string" for i in range(len(names)))
    rows = records.where((F.col("number") > 1) & (F.trim("record") != ""))
    parsed = rows.select(F.from_csv("record", schema, FORMAT).alias("r"))
    return parsed.select("r.*").toDF(*[header(name or "") for name in names])
