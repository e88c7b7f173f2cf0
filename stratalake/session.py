"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# A skewed shuffle partition is split by AQE even where that costs one more
# shuffle: a hot key must not end up in a single task.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Folders of thousands of files are listed by some tasks, not by one task a file.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}

#: Whether aggregates of collected values may hold the groups of a task in memory, 128 at first.
HASHED_OBJECTS = "spark.sql.execution.useObjectHashAggregateExec"

CHECKPOINT_DIR = "spark.checkpoint.dir"


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def one_group_at_a_time(spark: SparkSession) -> Iterator[None]:
    """Queries started within sort their rows, which spills, and collect one group's values after
    another's: for groups that are large each."""
    was = spark.conf.get(HASHED_OBJECTS)
    spark.conf.set(HASHED_OBJECTS, "false")
    try:
        yield
    finally:
        spark.conf.set(HASHED_OBJECTS, was)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session, where driver and executors are one machine, falls
    back to a temporary folder.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    return tempfile.mkdtemp(prefix="stratalake-")


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run of one job."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
