"""Dataset sinks, tables, views and load profiles."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_dataset(df: DataFrame, path: str, fmt: Literal["parquet", "csv"] = "parquet") -> None:
    """Replace the dataset at ``path``; the folder is created where missing."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    else:
        writer.parquet(path)


def recreate_table(
    df: DataFrame, name: str, path: str | None = None, bucket_by: str | None = None, buckets: int = 8
) -> DataFrame:
    """Drop and create table ``name``. Bucketing by a join key lets later joins skip a shuffle."""
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def refresh_view(df: DataFrame, name: str = "analytical_dataset") -> None:
    df.createOrReplaceTempView(name)


def read_view(spark: SparkSession, name: str = "analytical_dataset") -> DataFrame:
    return spark.table(name)


def profiled(df: DataFrame, name: str = "profile") -> tuple[DataFrame, Observation]:
    """Attach a row counter that fills during whichever action runs next (no extra pass)."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def load_profile(df: DataFrame) -> DataFrame:
    """One row: number of rows, number of columns and the column names in order."""
    names = F.array(*[F.lit(c) for c in df.columns])
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count",
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        F.array_join(names, ",").alias("column_names"),
    )
