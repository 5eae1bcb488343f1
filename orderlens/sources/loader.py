"""CSV loading with the load rules of the source database, and dataset re-reads."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.sources.quoted_csv import OPTIONS, read_quoted
from orderlens.sources.schemas import MULTILINE_TABLES, SCHEMAS, Marketplace

EmptyNumeric = Literal["zero", "null"]


def _typed(field: T.StructField, empty_numeric: EmptyNumeric) -> Column:
    raw = F.col(field.name)
    kind = field.dataType
    if isinstance(kind, T.StringType):
        value = F.when(raw == "\\N", None).otherwise(F.coalesce(raw, F.lit("")))
    elif isinstance(kind, T.TimestampNTZType):
        value = F.nullif(F.trim(raw), F.lit("")).try_cast(kind)
    else:
        value = F.trim(raw).try_cast(kind)
        if empty_numeric == "zero":
            value = F.coalesce(value, F.lit(0).cast(kind))
    return value.alias(field.name)


def load_csv_table(
    spark: SparkSession, path: str, table: str, empty_numeric: EmptyNumeric = "zero"
) -> DataFrame:
    """Read one table: comma separated, double-quoted, one header row.

    Empty timestamps become NULL, empty text stays ``''`` and empty or unreadable numbers become
    0 (``empty_numeric="null"`` keeps them NULL). All files are split, those with line ends inside texts as well.
    """
    schema = SCHEMAS[table]
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    if table in MULTILINE_TABLES:
        raw = read_quoted(spark, path, as_text)
    else:
        raw = spark.read.schema(as_text).option("header", True).option("enforceSchema", True).options(**OPTIONS).csv(path)
    return raw.select(*[_typed(f, empty_numeric) for f in schema])


def load_csv_marketplace(
    spark: SparkSession, paths: dict[str, str], empty_numeric: EmptyNumeric = "zero"
) -> Marketplace:
    """Load all nine tables; ``paths`` maps table name to file or folder."""
    return Marketplace(lambda name: load_csv_table(spark, paths[name], name, empty_numeric))


def load_parquet_marketplace(spark: SparkSession, folder: str) -> Marketplace:
    """Tables kept as parquet folders named after the table; filters reach these scans."""
    return Marketplace(lambda name: spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}"))


def reread_dataset(
    spark: SparkSession, path: str, schema: T.StructType, fmt: Literal["parquet", "csv"] = "parquet"
) -> DataFrame:
    """Read a stage's output back with its known schema instead of inferring one."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        return reader.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return reader.parquet(path)


def coerce_timestamps(df: DataFrame, columns: tuple[str, ...] = ("order_purchase_timestamp",)) -> DataFrame:
    """Turn the listed columns, where present, into zone-less timestamps."""
    present = {c: F.col(c).cast("timestamp_ntz") for c in columns if c in df.columns}
    return df.withColumns(present) if present else df
