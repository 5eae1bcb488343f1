"""Tables written part-way through a job.

A staged table cuts lineage, is read back with column pruning, and survives the loss of an
executor because it lives in a folder that driver and executors share: the one the cluster names in
``spark.checkpoint.dir``, else the context's checkpoint folder, else the warehouse. A cluster whose
warehouse is a plain local path and which names no other folder gets an error, not a partial result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# For tables with all columns of all rows, where bytes count more than the time to pack them. Not for tables that models are
# fitted on: files of other sizes are read in another order, which gives other splits.
WIDE = "zstd"
_OPEN: list[list[str]] = []
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # since Spark 4.1; others do not look at it


def shared_folder(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    local = spark.sparkContext.master.split("[")[0] == "local"
    if not local and _scheme(spark, warehouse) == "file":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse}/_staged"


def _scheme(spark: SparkSession, path: str) -> str:
    """The file system a path lies in; a path without a scheme lies in the default one."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme()


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/orderlens/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once and continue from the stored copy. The shuffle files of the write go as soon as it is done."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    with _shuffles_dropped(spark):
        df.write.option("compression", compression).parquet(path)
    if _OPEN:
        _OPEN[-1].append(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept.staged_path = path
    return kept


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Else shuffle files stay on the executors' disks until the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def staged_alone(spark: SparkSession, build: Callable[[], DataFrame], label: str) -> DataFrame:
    """Stage what ``build`` returns and delete what was staged to make it."""
    with staging(spark):
        kept = staged(build(), label)
        _OPEN[-1].remove(kept.staged_path)
    if _OPEN:
        _OPEN[-1].append(kept.staged_path)
    return kept


def is_staged(df: DataFrame) -> bool:
    return "staged_path" in vars(df)


def discard(*tables: DataFrame) -> None:
    """Delete staged tables before the job ends; whatever was made of them must be staged itself."""
    for kept in tables:
        remove_path(kept.sparkSession, kept.staged_path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the Hadoop file system it lives in."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving what was staged inside; store the result before that."""
    _OPEN.append([])
    try:
        yield
    finally:
        for path in _OPEN.pop():
            remove_path(spark, path)


def broadcast_if_small(df: DataFrame, label: str, max_rows: int = 100_000) -> DataFrame:
    """Stage a summary table, then hint a broadcast only if it really has few rows."""
    kept = staged(df, label)
    return F.broadcast(kept) if kept.count() <= max_rows else kept
