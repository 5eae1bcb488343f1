"""Where queries and their oracles are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.oracle_tables import with_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None, *needs: str) -> Callable[[Query], Query]:
    """Register a query; ``sql`` may use the named oracle expressions in ``needs``."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_tables(sql, *needs)
        return fn

    return add


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Round every double so that summation order cannot show."""
    return df.selectExpr(
        *[
            f"round(`{c}`, {special.get(c, digits)}) AS `{c}`" if kind == "double" else f"`{c}`"
            for c, kind in df.dtypes
        ]
    )
