"""Catalog tables: create, load with an audit, replace, upsert, monthly partitions."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.keys import newer_than, replace_by_key
from stratalake.sources import folders
from stratalake.sources.schemas import SHOP_SOURCES, TableSpec

MONTH = "ym"


def layer_table(name: str, layer: str | None = None, default: str = "default") -> str:
    """``layer.name``; a named layer is used as it is, else the default database."""
    return f"{layer or default}.{name}"


def shop_source(spark: SparkSession, name: str, database: str = "default") -> DataFrame:
    return spark.table(f"{database}.{SHOP_SOURCES[name]}")


def with_month(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(MONTH, F.date_format(column, "yyyyMM"))


def clustered(df: DataFrame, *keys: str) -> DataFrame:
    """Range-partitioned and sorted, so files and row groups cover narrow key ranges.

    Rows of one key may come from many input partitions; ranging over those last
    lets a hot key, even of equal rows, spread over several tasks and files.
    """
    origin = "_origin"
    spread = df.withColumn(origin, F.spark_partition_id())
    return spread.repartitionByRange(*keys, origin).sortWithinPartitions(*keys).drop(origin)


def laid_out(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows in the table's columns and layout.

    The month leads the range key, so a task writes to few month folders and a
    large month is still spread over many tasks.
    """
    df = df.select(*[F.col(f.name).cast(f.dataType) for f in spec.schema])
    if spec.month_of is None:
        return clustered(df, *spec.sort_by)
    return clustered(with_month(df, spec.month_of), MONTH, *spec.sort_by)


def create_table(spark: SparkSession, table: str, spec: TableSpec) -> None:
    columns, partition = spec.ddl, ""
    if spec.month_of is not None:
        columns, partition = f"{columns}, {MONTH} string", f"PARTITIONED BY ({MONTH})"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet {partition}")


def append_rows(spark: SparkSession, df: DataFrame, table: str, spec: TableSpec) -> int:
    """Add the rows and return how many the write itself counted."""
    counted = Observation()
    # Above the range partitioning, which samples its input: each row passes here once.
    rows = laid_out(df, spec).observe(counted, F.count(F.lit(1)).alias("n"))
    rows.write.mode("append").insertInto(table)
    return counted.get["n"]


def append_up_to(
    spark: SparkSession, df: DataFrame, table: str, spec: TableSpec, newest_of: str, state: str
) -> int:
    """Append, and keep the newest value of a column in the ``state`` table, which has one row
    per table. The value comes from the write itself, so no load ever reads its target. A
    load that stops before the state is written is repeated as a whole by ``newer_than_state``."""
    counted = Observation()
    newest = F.max(newest_of).alias("newest")
    rows = laid_out(df, spec).observe(counted, F.count(F.lit(1)).alias("n"), newest)
    rows.write.mode("append").insertInto(table)
    seen = counted.get
    if seen["newest"] is not None:
        row = spark.createDataFrame([(table, seen["newest"])], STATE)
        if spark.catalog.tableExists(state):
            both = spark.table(state).unionByName(row)
            row = both.groupBy("name").agg(F.max("newest").alias("newest"))
        replace_table(spark, row, state)
    return seen["n"]


#: Newest value loaded into each table.
STATE = "name string, newest timestamp_ntz"


def newer_than_state(new: DataFrame, table: str, column: str, state: str) -> DataFrame:
    """Rows newer than what was last loaded into the table, by the state table alone; all rows
    before the first load."""
    spark = new.sparkSession
    if not spark.catalog.tableExists(state):
        return new
    known = spark.table(state).where(F.col("name") == table)
    return newer_than(new, known, column, "newest")


def append_audited(spark: SparkSession, df: DataFrame, table: str, spec: TableSpec) -> DataFrame:
    """Append, then one row: rows loaded, counted as they were written, and rows now in the
    table. The source is read once."""
    loaded = append_rows(spark, df, table, spec)
    in_table = spark.table(table).agg(F.count("*").alias("rows_in_table"))
    return in_table.select(F.lit(loaded).cast("bigint").alias("rows_loaded"), "rows_in_table")


def load_audit(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: rows offered, rows now in the table."""
    offered = source.agg(F.count("*").alias("rows_loaded"))
    return offered.withColumn("rows_in_table", target.agg(F.count("*")).scalar())


def replace_table(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    sort_by: tuple[str, ...] = (),
    buckets: tuple[str, int] | None = None,
) -> int:
    """Write a new version of the table in a folder of its own, then point the table to it.

    The table's location changes in one step of the catalog, so a reader finds the old rows
    or the new ones. ``df`` may read the table it replaces. The version before stays until
    the next replacement, for readers that have begun. A run that is stopped anywhere leaves the
    table as it was and at most a folder without a table, which the next run removes. Only
    a change of columns or buckets takes two steps; stopped between them, the next run
    (or ``restore_table``) ends it.

    ``buckets`` names a column and a number: rows are dealt to as many files by that column and
    sorted by ``sort_by`` within, so that joins and groupings by it need no shuffle. One task
    reads a bucket, so the number has to grow with the table (``bucket_number``), and a column
    with hot keys is none to bucket by. Returns the number of rows.
    """
    restore_table(spark, table)
    clean_table(spark, table)
    staged, counted = f"{table}__next", Observation()
    if buckets:
        column, number = buckets
        rows = df.repartition(number, column)
    else:
        rows = clustered(df, *sort_by) if sort_by else df
    writer = rows.observe(counted, F.count(F.lit(1)).alias("n")).write.format("parquet")
    if buckets:
        writer = writer.bucketBy(number, column).sortBy(*(sort_by or (column,)))
    writer.option("path", _new_folder(spark, table)).saveAsTable(staged)
    _switch(spark, table, staged)
    return counted.get["n"]


#: A task reads one bucket of every table a job joins; so many rows take it under 2 GB in all
#: steps of ``gold.fct_orders`` together, and tables of few rows still give every core a bucket.
ROWS_PER_BUCKET, FEWEST_BUCKETS = 500_000, 8


def bucket_number(*facts: DataFrame) -> int:
    """Into how many buckets to deal tables that are joined by their bucket column: as many as
    the largest of them asks for, so that a bucket does not grow with its table."""
    rows = max((df.count() for df in facts), default=0)
    return max(FEWEST_BUCKETS, -(-rows // ROWS_PER_BUCKET))


def _switch(spark: SparkSession, table: str, staged: str) -> None:
    if not spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
    elif _shape(spark, table) == _shape(spark, staged):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{_location(spark, staged)}'")
        spark.sql(f"DROP TABLE {staged}")  # its files stay, they are the table's now
    else:
        spark.sql(f"DROP TABLE {table}")
        spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return {r["col_name"]: r["data_type"] for r in rows}


def _location(spark: SparkSession, table: str) -> str:
    return _described(spark, table)["Location"]


def _shape(spark: SparkSession, table: str) -> tuple:
    """What a change of location cannot change."""
    known = _described(spark, table)
    return spark.table(table).dtypes, *[known.get(k) for k in ("Num Buckets", "Bucket Columns", "Sort Columns")]


def files_folder(spark: SparkSession, table: str) -> str:
    """Where the versions of a table lie, one folder each."""
    database, name = table.rsplit(".", 1) if "." in table else (spark.catalog.currentDatabase(), table)
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{name}__files"


def _new_folder(spark: SparkSession, table: str) -> str:
    return f"{files_folder(spark, table)}/{uuid.uuid4().hex}"


def clean_table(spark: SparkSession, table: str) -> None:
    """Remove what stopped writes left and versions that nothing points to. One writer at a time."""
    spark.sql(f"DROP TABLE IF EXISTS {table}__next")
    used = set()
    if spark.catalog.tableExists(table):
        used = {_location(spark, table), *_month_folders(spark, table).values()}
    base = files_folder(spark, table)
    for version in folders.children(spark, base):
        path = f"{base}/{version}"
        months = [m for m in folders.children(spark, path) if m.startswith(f"{MONTH}=")]
        kept = [m for m in months if any(folders.same(f"{path}/{m}", u) for u in used)]
        if kept:
            for month in set(months) - set(kept):
                folders.delete(spark, f"{path}/{month}")
        elif not any(folders.same(path, u) for u in used):
            folders.delete(spark, path)


def restore_table(spark: SparkSession, table: str) -> None:
    """End a replacement that was stopped between its two steps: the complete new version, or
    the backup that an earlier release made, becomes the table."""
    if spark.catalog.tableExists(table):
        return
    for other in (f"{table}__backup", f"{table}__next"):
        if spark.catalog.tableExists(other):
            spark.sql(f"ALTER TABLE {other} RENAME TO {table}")
            return


def upsert_table(
    spark: SparkSession, new: DataFrame, table: str, key: str, purge_missing: bool = False
) -> None:
    """Replace the rows of every key in ``new``; a first run just writes them."""
    restore_table(spark, table)
    if not spark.catalog.tableExists(table):
        replace_table(spark, new, table, (key,))
        return
    old = spark.table(table)
    replace_table(spark, replace_by_key(old, new, key, purge_missing), table, (key,))


def _month_folders(spark: SparkSession, table: str) -> dict[str, str]:
    """Month -> folder of a table partitioned by month."""
    if MONTH not in spark.table(table).columns:
        return {}
    catalog = spark._jsparkSession.sessionState().catalog()
    database, name = table.rsplit(".", 1) if "." in table else (spark.catalog.currentDatabase(), table)
    known = spark._jvm.org.apache.spark.sql.catalyst.TableIdentifier(name, spark._jvm.scala.Option.apply(database))
    listed = catalog.listPartitions(known, spark._jvm.scala.Option.empty())
    found = {}
    for part in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(listed):
        found[part.spec().apply(MONTH)] = part.location().toString()
    return found


#: The month of rows without a time, as a partition must have a name.
NO_MONTH = "none"


def upsert_months(
    spark: SparkSession, new: DataFrame, table: str, key: str, month_of: str
) -> list[str]:
    """Replace the rows of every key in ``new`` in a table partitioned by the month of a
    timestamp, and rewrite only the months this touches; returns those.

    Touched are the months of the new rows and those in which the table holds a row of one of
    their keys, which a semi join of two columns finds; months are few, so they may be named. The
    touched months are written to folders of their own, then each partition is pointed to its
    new folder, in one step a month: a reader finds a month's old rows or its new ones, and
    files of other months are not even read. A run that is stopped between two months is
    repeated as a whole, with the same result. Old folders stay until the next run.

    The new rows are computed once and kept on disk: the touched months, the ranges and the write
    all read them.
    """
    rows = new.withColumn(MONTH, F.coalesce(F.date_format(month_of, "yyyyMM"), F.lit(NO_MONTH)))
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({MONTH})")
    clean_table(spark, table)
    rows.persist(StorageLevel.DISK_ONLY)
    try:
        return _upsert_months(spark, rows, table, key)
    finally:
        rows.unpersist()


def _upsert_months(spark: SparkSession, rows: DataFrame, table: str, key: str) -> list[str]:
    old = spark.table(table)
    keys = rows.select(key).distinct()
    held = old.select(key, MONTH).join(keys, key, "left_semi").select(MONTH).distinct()
    touched = sorted(r[0] for r in held.union(rows.select(MONTH)).distinct().collect())
    if not touched:
        return []
    kept = old.where(F.col(MONTH).isin(touched)).join(keys, key, "left_anti")
    folder = _new_folder(spark, table)
    result = kept.unionByName(rows).select(*old.columns)
    clustered(result, MONTH, key).write.partitionBy(MONTH).parquet(folder)
    written = {name.partition("=")[2] for name in folders.children(spark, folder) if name.startswith(f"{MONTH}=")}
    present = _month_folders(spark, table)
    # Months that gain rows come first, so that a key that moves is never without a row.
    added = [f"PARTITION ({MONTH} = '{m}') LOCATION '{folder}/{MONTH}={m}'" for m in sorted(written - present.keys())]
    if added:
        spark.sql(f"ALTER TABLE {table} ADD {' '.join(added)}")
    for month in sorted(written & present.keys()):
        spark.sql(f"ALTER TABLE {table} PARTITION ({MONTH} = '{month}') SET LOCATION '{folder}/{MONTH}={month}'")
    for month in sorted(present.keys() & set(touched) - written):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({MONTH} = '{month}')")
    return touched


def as_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)
