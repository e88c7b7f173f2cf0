"""Folders of the shared file system: list and delete, whatever store it is."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    where, store = _path(spark, path)
    if not store.exists(where):
        return []
    return sorted(status.getPath().getName() for status in store.listStatus(where))


def delete(spark: SparkSession, path: str) -> None:
    where, store = _path(spark, path)
    store.delete(where, True)


def same(first: str, second: str) -> bool:
    """Whether two spellings name one folder (``file:/a`` and ``/a``)."""
    return _plain(first) == _plain(second)


def _plain(path: str) -> str:
    scheme, _, rest = path.rpartition(":") if path.startswith("file:") else ("", "", path)
    return "/" + rest.strip("/") if scheme or rest.startswith("/") else rest.rstrip("/")
