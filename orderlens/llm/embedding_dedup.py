"""Near-duplicate embeddings by int8 tile products with rigorous error bounds.

Equal vectors are one row first. The rest is dealt into tiles; each pair of tiles meets in one task. A unit vector u
is held as s*q + e with q in int8 and the norm of e known, so the cosine of two vectors lies within
(1 + |e_u|) |e_v| + |e_u| of s_u s_v (q_u . q_v). Only pairs whose upper bound reaches the threshold are computed again in
double precision. A task returns each vector's number of links and the group it is in, never the pairs: a group of
near copies costs a row per vector and tile pair, not the square of its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import merge_labels, settle
from orderlens.llm.components import components

THRESHOLD = 0.9
TILE = 4096
_ROWS = 512
_EXACT_DIMS = 1024  # products of so many int8 pairs are whole numbers below 2**24


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(q, s, err) per row: q in [-127, 127], s * q approximates the row, err is at least the norm of what is missing."""
    s = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / s[:, None])
    err = np.linalg.norm(unit - q * s[:, None], axis=1) * (1 + 1e-9) + 1e-12
    return q.astype(np.int8), s, err


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 rows; float32 holds them, whole numbers, for up to 1,024 dimensions at a time."""
    out = None
    for k in range(0, a.shape[1], _EXACT_DIMS):
        part = a[:, k : k + _EXACT_DIMS].astype(np.float32) @ b[:, k : k + _EXACT_DIMS].astype(np.float32).T
        out = part if out is None else out.astype(np.float64) + part
    return out


def tile_links(
    a: np.ndarray, b: np.ndarray, threshold: float, same: bool
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Hits between unit rows of two tiles: (first row, rows, columns, hit matrix over them) in parts.

    ``same``: the tile meets itself, a row is not compared with itself.
    """
    qa, sa, ea = quantise(a)
    qb, sb, eb = quantise(b)
    sb, eb = sb.astype(np.float32), eb.astype(np.float32)
    for i in range(0, len(a), _ROWS):
        rows = slice(i, i + _ROWS)
        upper = _products(qa[rows], qb) * (sa[rows, None].astype(np.float32) * sb)
        upper += (1 + ea[rows, None]).astype(np.float32) * eb + ea[rows, None].astype(np.float32)
        maybe = upper >= threshold - 1e-5  # more than float32 can round off here
        if same:
            n = len(maybe)
            maybe[np.arange(n), i + np.arange(n)] = False
        r, c = np.flatnonzero(maybe.any(axis=1)), np.flatnonzero(maybe.any(axis=0))
        if len(r):
            hit = maybe[np.ix_(r, c)] & (a[i + r] @ b[c].T >= threshold)
            if hit.any():
                yield i, r, c, hit


def _pack(table: pa.Table) -> pa.Table:
    vectors = table.column("embedding").combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype("<f8")
    with np.errstate(over="ignore"):
        narrow = flat.astype("<f4")
    ids = table.column("rep").combine_chunks().to_numpy().astype("<i8")
    many = table.column("n").combine_chunks().to_numpy().astype("<i8")
    return pa.table({
        "tile": table.column("tile")[:1],
        "ids": pa.array([ids.tobytes()], pa.binary()),
        "many": pa.array([many.tobytes()], pa.binary()),
        "flat": pa.array([narrow.tobytes() if (flat == narrow).all() else flat.tobytes()], pa.binary()),
    })


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, many = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["many"], "<i8")
    dims = len(row["flat"]) // len(ids)
    # Four bytes a component unless that would lose some.
    wide = row["dims"] * 8 == dims
    m = np.frombuffer(row["flat"], "<f8" if wide else "<f4").astype(np.float64).reshape(len(ids), -1)
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return ids, many, m / np.linalg.norm(m, axis=1, keepdims=True)


def _meet(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["tile"])
        same = len(rows) == 1
        ids, many, a = _unpack(rows[0])
        ids_b, many_b, b = (ids, many, a) if same else _unpack(rows[1])
        both = ids if same else np.concatenate([ids, ids_b])
        shift = 0 if same else len(ids)
        links, labels = np.zeros(len(both), np.int64), np.arange(len(both))
        for i, r, c, hit in tile_links(a, b, threshold, same):
            links[i + r] += hit @ many_b[c]
            if not same:
                links[shift + c] += many[i + r] @ hit
            x, y = np.nonzero(hit)
            labels = merge_labels(labels, i + r[x], shift + c[y])
        found = np.flatnonzero(links)
        return pa.table({"node": both[found], "links": links[found], "root": both[labels[found]]})

    return run


def near_vectors(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, tile: int = TILE
) -> DataFrame:
    """One row per row: vec_id, n_links (other vectors with a cosine of ``threshold`` or more), component_id, kept.

    A vector that is null, empty or zero, or holds a null or a component that is not finite, links with nothing; nor do
    vectors of different length. Repeated vectors link with each other; repeated ids keep a row each. Extra columns
    do not matter; an empty table gives no rows.
    """
    spark = rows.sparkSession
    vector = F.col(vector_col)
    doubles = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.coalesce(~bad & F.exists(doubles, lambda x: x != 0), F.lit(False))
    told = rows.select(
        F.col(id_col).cast("long").alias("vec_id"), F.when(usable, doubles).alias("embedding")
    )
    distinct = (
        told.where("embedding IS NOT NULL AND vec_id IS NOT NULL")
        .groupBy("embedding")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
    )
    # An id whose rows hold different vectors must not join them: vectors are numbered apart from ids.
    distinct = settle(distinct.withColumn("node", F.monotonically_increasing_id()), "vectors")
    dealt = distinct.withColumn("dims", F.size("embedding"))
    sizes = [(r["dims"], r["count"]) for r in dealt.groupBy("dims").count().orderBy("dims").collect()]
    found = None
    for dims, count in sizes:  # as many rounds as there are vector lengths
        n = max(1, -(-count // tile))
        tiles = (
            dealt.where(F.col("dims") == dims)
            .select(F.pmod(F.xxhash64("node"), F.lit(n)).cast("int").alias("tile"), F.col("node").alias("rep"), "n", "embedding")
            .groupBy("tile")
            .applyInArrow(_pack, "tile int, ids binary, many binary, flat binary")
        )
        # Tile t meets every tile once: pairs (smaller, larger) of numbers below n.
        others = F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        pairs = settle(tiles, "tiles").withColumn("_o", others).select(
            F.least("tile", "_o").alias("i"), F.greatest("tile", "_o").alias("j"), "tile", "ids", "many", "flat",
            F.lit(dims).alias("dims"),
        )
        part = pairs.groupBy("i", "j").applyInArrow(_meet(threshold), "node long, links long, root long")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "node long, links long, root long")
    found = settle(found, "hits")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(found, "node", "root").withColumnRenamed("component", "_root")
    in_group = distinct.join(counts, "node", "left").join(groups, "node", "left").select(
        "embedding", "rep", "n", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("_root", "node").alias("_root")
    )
    in_group = settle(in_group, "grouped")
    least = in_group.groupBy("_root").agg(F.min("rep").alias("component_id"))
    known = in_group.join(least, "_root").select(
        "embedding", (F.col("links") + F.col("n") - 1).alias("n_links"), "component_id"
    )
    linked = told.join(known, "embedding", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )
    return linked.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
