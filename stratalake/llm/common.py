"""What the operators share: reading tables, scratch tables, clashing column names."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.session import shared_dir

#: Bytes that separate words: a word is a run of anything else. ``bytes.split()`` cuts
#: at exactly these, so Python code splits the UTF-8 form of a text.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Tables written to the shared folder to cut lineage.

    A lost executor costs the tasks that read such a table, not the work that made
    it. ``drop`` deletes the tables that are no longer read; those that the returned
    DataFrame still reads stay until the caller calls ``drop`` or empties the folder.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0
        # The frames are held, so that no other can come to have the id of one of them.
        self.paths: dict[int, tuple[DataFrame, str]] = {}

    def keep(self, df: DataFrame) -> DataFrame:
        """The rows of ``df``, written once and read from there."""
        path = f"{self.root}/{self.count}"
        self.count += 1
        df.write.option("compression", "zstd").parquet(path)
        self.tidy()
        read = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(read)] = read, path
        return read

    def tidy(self) -> None:
        """Spark deletes the shuffle files of plans that are gone once the driver's JVM
        collects garbage, which on a driver with little to do may be late."""
        gc.collect()
        self.spark._jvm.System.gc()

    def drop(self, df: DataFrame) -> None:
        """Delete a table that ``keep`` returned."""
        _, path = self.paths.pop(id(df), (None, None))
        if path:
            jvm = self.spark._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def column(name: str) -> Column:
    """A column by its plain name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def others(df: DataFrame, taken: list[str]) -> list[str]:
    """Columns of ``df`` that no result column shadows; Spark ignores case here."""
    names = {x.lower() for x in taken}
    return [c for c in df.columns if c.lower() not in names]


def packed(df: DataFrame) -> Column:
    """The whole row as one struct, so that helper columns cannot clash with it."""
    return F.struct(*[column(c) for c in df.columns])
