"""Connected components of a link table by alternating star contraction.

Every step is an aggregation with map-side combining and a join of links with one row per node, so a
node with very many links is combined early and split by adaptive execution. Each round is staged:
lineage stays short and a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import settle


def _large(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.where("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where("u <> v")
        .distinct()
    )


def _small(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that occurs in a link; component is the smallest node reachable.

    Links may repeat, point either way or from a node to itself; those with a null end are left out. An
    empty table gives an empty result.
    """
    known = links.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    pairs = known.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v")
    now = settle(pairs.distinct(), "links")
    mark = _mark(now)
    while mark[0]:
        now = settle(_small(_large(now)), "stars")
        before, mark = mark, _mark(now)
        if before == mark:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
