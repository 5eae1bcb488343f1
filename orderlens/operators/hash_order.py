"""Rows in the order of a hash: ranks for dealing out folds, and samples of an exact size.

Rows are counted by the leading hex digits of the hash, one aggregation with map-side combining. Running sums of these
counts say at which rank each prefix begins, so a rank needs only the order inside its prefix, and a sample needs no rank
at all: the prefix in which it ends is looked at, and its last hash becomes a plain filter on the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.sources.staging import broadcast_if_small, is_staged, staged

DIGITS = 4  # 65,536 prefixes; a task sorts a group's rows of one prefix


def row_hash(row_key: Sequence[str], seed: int) -> Column:
    """MD5 of the key's columns as text, one after the other, and the seed; a NULL counts as empty."""
    text = ", ".join(f"coalesce(CAST(`{c}` AS string), '')" for c in row_key)
    return F.expr(f"md5(concat({text}, '{seed}'))")


def in_bytes(row_hash: Column | str) -> Column:
    """The hash as 16 bytes, in the same order as its 32 digits: half as much to shuffle and sort."""
    return F.unhex(row_hash)


def _kept(df: DataFrame) -> DataFrame:
    return df if is_staged(df) else staged(df, "hash-rows")


def with_rank(df: DataFrame, group: Sequence[str], row_key: Sequence[str], seed: int, digits: int = DIGITS) -> DataFrame:
    """Add ``_rank``, from 0, in the order of the hash and then of ``row_key`` within each group. NULL is a group as well.

    ``df`` is read twice, the first time only the columns that are counted; it is staged if it is not a staged table.
    """
    rows = _kept(df).withColumn("_hash", row_hash(row_key, seed)).withColumn("_prefix", F.substring("_hash", 1, digits))
    rows = rows.withColumn("_hash", in_bytes("_hash"))
    sizes = rows.groupBy(*group, "_prefix").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*group, "_prefix", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    known = broadcast_if_small(starts.toDF(*[f"_{c}" for c in group], "_of", "_start"), "hash-starts", 16**digits * 4)
    same = F.col("_prefix") == F.col("_of")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    inside = Window.partitionBy(*group, "_prefix").orderBy("_hash", *row_key)
    ranked = rows.withColumn("_in", F.row_number().over(inside) - 1).join(known, same)
    return ranked.withColumn("_rank", F.col("_start") + F.col("_in")).select(*df.columns, "_rank")


def first_rows(df: DataFrame, fraction: float, row_key: Sequence[str], seed: int, digits: int = DIGITS) -> DataFrame:
    """The first ``round(fraction * rows)`` rows in the order of the hash (half to even); no row is shuffled.

    Rows with the same hash at the end of the sample are told apart by ``row_key``.
    """
    rows = _kept(df)
    hashed = row_hash(row_key, seed)
    sizes = rows.groupBy(F.substring(hashed, 1, digits).alias("_prefix")).agg(F.count(F.lit(1)).alias("_n"))
    sizes = staged(sizes, "hash-sizes")  # at most 16 ** digits rows
    wanted = sizes.agg(F.expr(f"CAST(bround({fraction!r}D * sum(_n)) AS long)")).first()[0] or 0
    if wanted <= 0:
        return rows.limit(0)
    running = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
    last = sizes.withColumn("_after", F.sum("_n").over(running)).where(F.col("_after") >= wanted).orderBy("_prefix").first()
    if last is None:
        return rows
    left = wanted - (last["_after"] - last["_n"])  # rows that the last prefix still gives
    of_prefix = rows.where(F.substring(hashed, 1, digits) == last["_prefix"]).select(hashed.alias("_hash"))
    steps = of_prefix.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"))
    steps = steps.withColumn("_after", F.sum("_n").over(Window.orderBy("_hash").rowsBetween(Window.unboundedPreceding, 0)))
    end = steps.where(F.col("_after") >= left).orderBy("_hash").first()
    spare = end["_after"] - left
    if not spare:
        return rows.where(hashed <= end["_hash"])
    tied = rows.where(hashed == end["_hash"]).orderBy(*row_key).limit(end["_n"] - spare)
    return rows.where(hashed < end["_hash"]).unionByName(tied)
