"""Primary and foreign key violations as a report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.sources.schemas import FOREIGN_KEYS, PRIMARY_KEYS, Marketplace


def duplicate_keys(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-null references without a parent row. References are counted before the join, so a very
    frequent one costs no more than any other."""
    used = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    return used.join(parent.select(F.col(parent_column).alias(column)), column, "left_anti")


def key_report(t: Marketplace) -> DataFrame:
    """One row per key rule: how many keys and rows break it."""

    def summary(bad: DataFrame, rule: str, table: str, columns: str, parent: str) -> DataFrame:
        return bad.agg(F.count(F.lit(1)).alias("bad_keys"), F.expr("coalesce(sum(rows), 0L)").alias("bad_rows")).selectExpr(
            f"'{rule}' AS rule", f"'{table}' AS table_name", f"'{columns}' AS columns", f"'{parent}' AS parent",
            "bad_keys", "bad_rows",
        )

    primary = [
        summary(duplicate_keys(t.table(name), key), "primary key", name, ",".join(key), "")
        for name, key in PRIMARY_KEYS.items()
    ]
    foreign = [
        summary(
            orphan_keys(t.table(child), column, t.table(parent), PRIMARY_KEYS[parent][0]),
            "foreign key", child, column, parent,
        )
        for child, column, parent in FOREIGN_KEYS
    ]
    return reduce(DataFrame.unionByName, primary + foreign)
