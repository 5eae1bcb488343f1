"""Small helpers that the corpus operators share."""

from __future__ import annotations

import gc
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.sources.staging import staged

ARROW_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text as it is; a null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def bounded_batches(spark: SparkSession, size: int = ARROW_BYTES) -> None:
    """Long texts: close an Arrow batch by its bytes, not only by its rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def settle(df: DataFrame, label: str) -> DataFrame:
    """Stage ``df``, then let Spark drop the shuffle files that only its lineage used."""
    kept = staged(df, label, "zstd")
    release(df.sparkSession)
    return kept


def release(spark: SparkSession) -> None:
    """Collect what the driver no longer refers to and give Spark's cleaner a moment to delete it on the executors."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    time.sleep(0.5)


def parts_for(spark: SparkSession, n_bytes: int, each: int = 8 << 20) -> int:
    """How many partitions hold ``n_bytes`` at about ``each`` bytes; never fewer than the session's own number."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(n_bytes) // each))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values and the offsets of each (one more than values); nulls are empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at.astype(np.int64) - int(at[0])


def slices(batch: pa.RecordBatch, text: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``most`` bytes of text; a longer text makes a run of its own."""
    _, at = utf8(batch.column(text))
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(at, at[start] + most, "right")) - 1)
        yield batch.slice(start, min(end, batch.num_rows) - start)
        start = end


def merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the groups that the links a-b connect; each row's label is the smallest row of its group."""
    while len(a):
        la, lb = labels[a], labels[b]
        apart = la != lb
        if not apart.any():
            break
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels = up
    return labels
