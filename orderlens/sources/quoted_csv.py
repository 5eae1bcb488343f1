"""CSV whose quoted fields may hold line ends, read by many tasks however large one file is.

Whether a line begins a record depends on how many quotes the file holds before it: an even number, and it does. Files are read as lines,
in the byte ranges that Spark's text source deals out. Each range counts its quotes by itself, for the case that it begins outside a
quoted field and for the case that it begins inside one; running sums over the ranges of a file (one row each) then say which case holds, and which
record goes on into the next range. Lines that are whole records are parsed where they are; only lines of longer records
are brought together. A doubled quote inside a field counts twice and changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPTIONS = {"quote": '"', "escape": '"', "emptyValue": "", "mode": "PERMISSIVE"}


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, id, line, odd): ids rise along a block; ``odd`` tells whether the line holds an odd number of quotes."""
    read = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return read.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), F.col("value").alias("line"), (quotes % 2).alias("odd"),
    )


def records(spark: SparkSession, path: str) -> DataFrame:
    """(record, first): the text of each record, and whether it is the first one of its file. Empty lines between records are no records."""
    in_block = Window.partitionBy("file", "block").orderBy("id")
    before = F.coalesce(F.sum("odd").over(in_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    lines = _lines(spark, path).withColumn("within", before)
    blocks = lines.groupBy("file", "block").agg(
        (F.sum("odd") % 2).alias("odd"), F.min("id").alias("top"),
        F.max(F.when(F.col("within") == 0, F.col("id"))).alias("if_even"), F.max(F.when(F.col("within") == 1, F.col("id"))).alias("if_odd"),
    )
    along = Window.partitionBy("file").orderBy("block")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("inside", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)
    begun = F.when(F.col("inside") == 0, F.col("if_even")).otherwise(F.col("if_odd"))
    blocks = blocks.withColumn("last_begun", F.when(begun.isNotNull(), F.struct(F.col("block").alias("b"), begun.alias("i"))))
    blocks = blocks.withColumn("carried", F.last("last_begun", ignorenulls=True).over(earlier))
    blocks = blocks.withColumn("head", F.min(F.struct("block", "top")).over(Window.partitionBy("file")))
    known = blocks.select(F.col("file").alias("_file"), F.col("block").alias("_block"), "inside", "carried", "head")
    same = (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block"))
    placed = lines.join(known, same)
    begins = (F.col("within") + F.col("inside")) % 2 == 0
    placed = placed.withColumn("begins", begins).withColumn("first", begins & (F.col("id") == F.col("head.top")))
    own = F.last(F.when(F.col("begins"), F.struct(F.col("block").alias("b"), F.col("id").alias("i"))), ignorenulls=True).over(in_block)
    placed = placed.withColumn("of", F.coalesce(own, "carried"))
    text = F.when(F.endswith("record", F.lit("\r")), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    whole = placed.where("begins AND odd = 0").select(F.col("line").alias("record"), "first")
    longer = (
        placed.where("NOT begins OR odd = 1")
        .groupBy("file", "of")
        .agg(F.sort_array(F.collect_list(F.struct("block", "id", "line"))).alias("lines"), F.max("first").alias("first"))
        .select(F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("record"), "first")
    )
    return whole.unionByName(longer).select(text.alias("record"), "first").where("record <> '' OR first")


def read_quoted(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The records below the header of each file at ``path``, as columns of ``schema`` (all strings)."""
    ddl = ", ".join(f"`{f.name}` string" for f in schema)
    return records(spark, path).where("NOT first").select(F.from_csv("record", ddl, OPTIONS).alias("r")).select("r.*")
