"""File readers: every CSV column arrives as text and is coerced by the jobs."""

from __future__ import annotations

import re
from contextlib import ExitStack

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text that is no JSON object of this shape arrives in the last column.
REJECTED = "_corrupt_record"
SNAPSHOT_SCHEMA = f"time bigint, states array<array<string>>, {REJECTED} string"


def lower_header(name: str) -> str:
    return name.strip().lower()


def snake_header(name: str) -> str:
    return name.strip().lower().replace(" ", "_").replace("%", "percent")


#: Where a row stands: file, then place in it. Later files of a folder sort behind earlier ones by name.
PLACE = "_place"


def read_csv(
    spark: SparkSession, path: str, header=lower_header, multi_line: bool = False, place: bool = False
) -> DataFrame:
    """A CSV with a header line as text columns, names normalised.

    Names come from the header line and types are never inferred, so no pass
    over the data is needed. Ask for ``multi_line`` only where quoted text holds
    line breaks: such a file cannot be split, so it has to come in many files (or see
    ``quoted.read_quoted_csv``). ``place`` adds a column that grows along each file.
    """
    raw = spark.read.csv(
        path,
        header=True,
        inferSchema=False,
        multiLine=multi_line,
        quote='"',
        escape='"',
        # A file whose header has the columns in another order is an error, not a swap.
        enforceSchema=False,
    )
    named = raw.toDF(*[header(name) for name in raw.columns])
    if not place:
        return named
    # Rows of one split are read in order by one task, which numbers them in order.
    at = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return raw.select("*", at.alias(PLACE)).toDF(*named.columns, PLACE)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Landed JSON snapshots, one object with positional state arrays per line."""
    return spark.read.schema(SNAPSHOT_SCHEMA).json(path)


#: A snapshot's fields, and where text of another shape arrives. Without options Spark would
#: parse no more fields than a query names, and take a wrong type of another for right.
_PARSED = f"from_json(body, '{SNAPSHOT_SCHEMA}', map('mode', 'PERMISSIVE'))"
_ONE_VALUE = "size(from_json(concat('[', body, ']'), 'array<string>')) = 1"
_IS_SNAPSHOT = f"{_PARSED}.{REJECTED} IS NULL AND {_ONE_VALUE}"


def snapshots_in(texts: DataFrame) -> DataFrame:
    """Snapshots in whole files: ``file``, ``body``, ``time``, ``states`` and ``is_snapshot``.

    ``texts`` has the columns ``file`` and ``value``, the text of a file. A body that is one JSON
    object is one snapshot, over however many lines it is printed. Else, if some line is a
    snapshot, each line that is not blank is a body of its own; if none is, the whole text is one
    body that is no snapshot. Something behind a complete object makes a body no snapshot. Blank
    files have no bodies. One task parses a file, so this is for responses; ``landed_bodies`` reads
    large files of many snapshots, one a line, by many tasks.
    """

    def is_snapshot(column: str) -> str:
        return _IS_SNAPSHOT.replace("body", column)

    lines = texts.select("file", "value", F.expr("filter(split(value, '\n'), x -> trim(x) <> '')").alias("lines"))
    bodies = f"""CASE WHEN {is_snapshot('value')} THEN array(value)
        WHEN exists(lines, x -> {is_snapshot('x')}) THEN lines ELSE array(value) END"""
    each = lines.where("size(lines) > 0").select("file", F.expr(f"explode({bodies})").alias("body"))
    return each.select("file", "body", *_read())


def _read() -> list:
    """What a body says: ``time``, ``states`` and ``is_snapshot``."""
    parsed = F.expr(_PARSED)
    whole = F.coalesce(F.expr(_IS_SNAPSHOT), F.lit(False))
    return [parsed["time"].alias("time"), parsed["states"].alias("states"), whole.alias("is_snapshot")]


#: Bytes of a file above which its lines are read by many tasks before one task may hold it whole.
LARGE_FILE = 16 << 20


def landed_bodies(spark: SparkSession, landed: list, held: ExitStack) -> DataFrame:
    """The bodies ``snapshots_in`` finds in files given as (full path, length), kept on disk until
    ``held`` is closed.

    A large file of a body a line is never held whole: its lines are parsed by as many tasks as it
    has splits. It is one if some line is a snapshot and the first of several that are not white is a
    whole JSON value, or none that can begin an object or an array: then the file is not one body. Any
    other large file is one body or may be one, so one task reads it whole.
    """
    large = [path for path, length in landed if length > LARGE_FILE]
    lines = _lines(spark, large).persist(StorageLevel.DISK_ONLY)
    held.callback(lines.unpersist)
    apart = F.bool_or("is_snapshot") & F.min("first")["closed"] & (F.count("first") > 1)
    kinds = lines.groupBy("file").agg(apart.alias("by_line"))
    by_line = [r["file"] for r in kinds.where("by_line").collect()] if large else []
    parted = {_plain_path(spark, file) for file in by_line}
    wholes = snapshots_in(_named(_texts(spark, [path for path, _ in landed if path not in parted], wholetext=True)))
    wholes = wholes.persist(StorageLevel.DISK_ONLY)
    held.callback(wholes.unpersist)
    if not by_line:
        return wholes
    return wholes.unionByName(lines.where(F.col("file").isin(by_line)).select(wholes.columns))


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Each line that is not blank, read as a body; ``first`` is where it stands, and whether nothing
    that begins with it is one body, or NULL for white space."""
    raw = _texts(spark, paths, lineSep="\n")
    placed = raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("value").alias("body"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ).where("trim(body) <> ''")
    closed = F.coalesce(F.expr(_ONE_VALUE), F.lit(False)) | ~F.col("body").rlike(r"^\s*[\[{]")
    first = F.when(F.col("body").rlike(r"\S"), F.struct("block", "row", closed.alias("closed")))
    return placed.select("file", "body", *_read(), first.alias("first"))


def _texts(spark: SparkSession, paths: list[str], **options) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], "value string, _metadata struct<file_path string, file_block_start bigint>")
    return spark.read.text([re.sub(r"([\\*?\[\]{}])", r"\\\1", path) for path in paths], **options)


def _plain_path(spark: SparkSession, file: str) -> str:
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file)).toString()


def read_whole_files(spark: SparkSession, path: str) -> DataFrame:
    """``file`` and ``value`` of each file, for ``snapshots_in``."""
    return _named(spark.read.text(path, wholetext=True))


def stream_whole_files(spark: SparkSession, path: str, files_per_batch: int = 20_000) -> DataFrame:
    """``path`` and ``length`` of files as they land, for ``landed_bodies``. A batch has several
    jobs and a folder of its own, which takes seconds whatever its size, so a backlog of small
    files goes in few large ones."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    reader = spark.readStream.format("binaryFile").schema(schema)
    # The content is not asked for, so it is not read here.
    return reader.option("maxFilesPerTrigger", files_per_batch).load(path).select("path", "length")


def _named(texts: DataFrame) -> DataFrame:
    return texts.select(F.col("_metadata.file_path").alias("file"), "value")
