"""Categories as numbers: how often orders of a category were late, smoothed towards the overall rate.

For training, a row must not see its own label: its number comes only from the rows of its category that stand before it
in the order of a hash, so rows early in that order get almost the overall rate. For scoring, each category has one number, from all
training rows, in a table that is joined. Neither needs a list of the categories on the driver, however many there are, and a
category with most of the rows is cut along the hash order (``with_history``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.operators.hash_order import in_bytes, row_hash
from orderlens.operators.ordered import DEFAULT_POLICY, SkewPolicy, with_history
from orderlens.sources.staging import WIDE, broadcast_if_small, staged

MISSING = "UNKNOWN"
PRIOR_ROWS = 1.0  # the overall rate counts as so many rows


def _long(rows: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row per row and column: (*keep, column, category)."""
    pairs = ", ".join(f"struct('{c}' AS column, coalesce(CAST(`{c}` AS string), '{MISSING}') AS category)" for c in columns)
    return rows.selectExpr(*keep, f"inline(array({pairs}))")


def base_of(rows: DataFrame, label: str) -> float:
    return float(rows.agg(F.avg(label)).first()[0] or 0.0)


def ordered_statistics(
    train: DataFrame, columns: Sequence[str], label: str, row_key: Sequence[str], seed: int,
    prior_rows: float = PRIOR_ROWS, policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """``train`` with each of ``columns`` replaced by its running smoothed late rate (double).

    A NULL category counts as one named UNKNOWN; a NULL label counts as on time. ``row_key`` should identify a row. All
    columns share one shuffle, in long form.
    """
    if not columns:
        return train
    rows = staged(train.withColumn("_row", F.monotonically_increasing_id()), "target-rows", WIDE)
    base = base_of(rows, label)
    slim = rows.select("_row", in_bytes(row_hash(row_key, seed)).alias("_hash"), F.coalesce(F.col(label), F.lit(0)).cast("double").alias("_late"), *columns)
    long = _long(slim, columns, ["_row", "_hash", "_late"])
    seen = with_history(long, ["column", "category"], ["_hash", "_row"], before={"_late_before": "_late", "_rows_before": "1"}, policy=policy)
    rate = F.expr(f"(_late_before + {prior_rows!r}D * {base!r}D) / (_rows_before + {prior_rows!r}D)")
    wide = seen.withColumn("_rate", rate).groupBy("_row").agg(
        *[F.max(F.when(F.col("column") == c, F.col("_rate"))).alias(f"_stat_{i}") for i, c in enumerate(columns)]
    )
    joined = rows.join(wide, "_row")
    stats = {c: F.col(f"_stat_{i}") for i, c in enumerate(columns)}
    return joined.select(*[stats[c].alias(c) if c in stats else F.col(c) for c in train.columns])


def category_table(
    train: DataFrame, columns: Sequence[str], label: str, prior_rows: float = PRIOR_ROWS
) -> DataFrame:
    """(column, category, rows, late, rate), and for each column a row with a NULL category: the rate of categories not in the table."""
    base = base_of(train, label)
    late = F.coalesce(F.col(label), F.lit(0)).cast("double").alias("_late")
    long = _long(train.select(late, *columns), columns, ["_late"])
    counted = long.groupBy("column", "category").agg(F.count(F.lit(1)).alias("rows"), F.sum("_late").alias("late"))
    known = counted.withColumn("rate", F.expr(f"(late + {prior_rows!r}D * {base!r}D) / (rows + {prior_rows!r}D)"))
    named = ", ".join(f"'{c}'" for c in columns)
    others = train.sparkSession.range(1).selectExpr(
        f"explode(array({named})) AS column", "CAST(NULL AS string) AS category", "0L AS rows", "0D AS late", f"{base!r}D AS rate"
    )
    return known.unionByName(others)


def with_statistics(df: DataFrame, table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with each of ``columns`` replaced by its rate in a ``category_table``; unknown categories get the overall rate.

    A column's table is broadcast only if it turns out small.
    """
    others = {r["column"]: r["rate"] for r in table.where("category IS NULL").select("column", "rate").collect()}  # a row a column
    out = df
    for i, c in enumerate(columns):
        mine = table.where((F.col("column") == c) & F.col("category").isNotNull()).select(F.col("category").alias(f"_cat_{i}"), F.col("rate").alias(f"_rate_{i}"))
        category = F.coalesce(F.col(c).cast("string"), F.lit(MISSING))
        out = out.join(broadcast_if_small(mine, "category-rates"), category == F.col(f"_cat_{i}"), "left")
        out = out.withColumn(c, F.coalesce(F.col(f"_rate_{i}"), F.lit(others[c]))).drop(f"_cat_{i}", f"_rate_{i}")
    return out.select(*df.columns)
