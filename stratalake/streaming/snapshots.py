"""Recurring snapshot ingest: each run appends the files that arrived since the last."""

from __future__ import annotations

from contextlib import ExitStack

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratalake.plans.flights import flight_states, stamped
from stratalake.sources import schemas
from stratalake.sources.files import REJECTED, SNAPSHOT_SCHEMA, landed_bodies
from stratalake.sources.tables import MONTH, laid_out, with_month


def snapshot_stream(spark: SparkSession, landing: str, files_per_batch: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(SNAPSHOT_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(landing)
    )


def append_states(snapshots: DataFrame, table_path: str, checkpoint: str) -> StreamingQuery:
    """Process what has landed and stop; call again for the next hour.

    The checkpoint remembers the files read and the sink's log the files
    written, so a repeated or retried run adds nothing twice.
    """
    rows = with_month(stamped(flight_states(snapshots)), "event_time")
    return (
        rows.writeStream.format("parquet")
        .partitionBy(MONTH)
        .option("path", table_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


#: Folder of each batch within a table: the query that wrote it and the batch's number.
LOAD = "load"


def ingest_bodies(landed: DataFrame, table_path: str, rejects_path: str, checkpoint: str) -> StreamingQuery:
    """Process the files that have landed (``stream_whole_files``) and stop; call again for the next
    hour.

    Both tables come from one batch: a file is read once, its snapshots go to the table, sorted by
    time and aircraft within each month, and what is no snapshot goes to the rejects. A
    batch writes to a folder of its own, named by the stream and the batch's number, and replaces
    that folder when it is repeated, so a stop at any point adds nothing twice. Rows are
    dealt by ranges of month and sort key, so that a month's files are as many as its size asks for.
    """

    def write(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        folder = f"{LOAD}={stream}-{number}"
        with ExitStack() as held:
            bodies = landed_bodies(batch.sparkSession, batch.collect(), held)
            rows = stamped(flight_states(bodies.where("is_snapshot")))
            months = laid_out(rows, schemas.RAW_FLIGHTS).write.mode("overwrite").partitionBy(MONTH)
            months.parquet(f"{table_path}/{folder}")
            rejects = bodies.where(~F.col("is_snapshot")).select("file", "body", "time", F.size("states").alias("n_states"))
            rejects.write.mode("overwrite").parquet(f"{rejects_path}/{folder}")

    return (
        landed.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingested(spark: SparkSession, table_path: str) -> DataFrame:
    """The table that ``ingest_bodies`` writes, as the declared source ``raw_flights``."""
    schema = f"{schemas.RAW_FLIGHTS.ddl}, {LOAD} string, {MONTH} string"
    return spark.read.schema(schema).parquet(table_path)


def rejected(spark: SparkSession, rejects_path: str) -> DataFrame:
    return spark.read.schema(f"{REJECTS}, {LOAD} string").parquet(rejects_path)


#: Columns of the quarantine table.
REJECTS = "file string, body string, time bigint, n_states int"


def append_rejects(snapshots: DataFrame, table_path: str, checkpoint: str) -> StreamingQuery:
    """Keep what ``append_states`` could not read: file name and text of each line that
    is no snapshot. A snapshot printed over several lines ends up here line by line.

    A stream with a checkpoint of its own, which reads the landed files once more.
    """
    rejected = snapshots.where(F.col(REJECTED).isNotNull()).select(
        F.col("_metadata.file_path").alias("file"),
        F.col(REJECTED).alias("body"),
        "time",
        # What could be read of it; without this column Spark would not parse the states.
        F.size("states").alias("n_states"),
    )
    return (
        rejected.writeStream.format("parquet")
        .option("path", table_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
