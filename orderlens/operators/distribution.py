"""Exact quantiles, histograms, box statistics and kernel densities of numeric columns.

All of them read one staged table of rows (column, value, n). Nothing is shuffled by value: quantiles are
found by rank selection, densities from moments of narrow cells, histograms and boxes by counting rows.

Rank selection counts how many rows lie in the cells between a few edges and keeps, for each level, the cell that
holds the wanted ranks. The first edges come from a sketch; whatever they are, the cells cover all values, so a poor
sketch only means one more round, with even edges inside the cell. Once a cell holds few enough rows, those
alone are grouped by value and ranked. The result is the exact linearly interpolated quantile.

``by`` is a label with few values, such as late / not late; rows with a NULL label are left out.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.sources.staging import broadcast_if_small, staged

RANKED_ROWS = 50_000  # rows of one column and level that one task sorts
SKETCH_ACCURACY = 2_000
ROUND_EDGES = 64
FEW_EDGES = 8
CELLS_PER_BANDWIDTH = 16
MOMENTS = 10


def value_rows(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows ``(*by, column, value, n)`` with n = 1, staged but not shuffled; NULL and NaN values are left out."""
    return staged(_long(df, columns, by).withColumn("n", F.lit(1).cast("long")), "values")


def _long(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS double)" for c in columns)
    long = df.selectExpr(*by, f"stack({len(columns)}, {pairs}) AS (column, value)").where(
        "value IS NOT NULL AND NOT isnan(value)"
    )
    return long.dropna(subset=list(by)) if by else long


def _cells(rows: DataFrame, edges: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows per cell: the values below all edges, at an edge, or between two neighbouring ones, with the least and the largest value."""
    most = edges.agg(F.max(F.size("_edges"))).first()[0] or 0
    if most <= FEW_EDGES:  # compared one by one, without a function call per row and edge
        place = " + ".join(f"CAST(coalesce(get(_edges, {i}) < value, false) AS int) + CAST(coalesce(get(_edges, {i}) <= value, false) AS int)" for i in range(most)) or "0"
    else:
        place = "size(filter(_edges, e -> e < value)) + size(filter(_edges, e -> e <= value))"
    return (
        rows.join(edges, list(key))
        .selectExpr(*key, "value", "n", f"{place} AS _cell")
        .groupBy(*key, "_cell")
        .agg(F.sum("n").alias("_n"), F.min("value").alias("_min"), F.max("value").alias("_max"))
    )


def _brackets(cells: DataFrame, levels: Sequence[float], key: Sequence[str]) -> DataFrame:
    """For each level the span of values that holds its two neighbouring ranks: ``(*key, level, _lo, _hi, _below, _inside, _rows)``."""
    of = Window.partitionBy(*key)
    ranked = cells.withColumn("_after", F.sum("_n").over(of.orderBy("_min").rowsBetween(Window.unboundedPreceding, 0)))
    ranked = ranked.withColumn("_rows", F.sum("_n").over(of))
    wanted = ", ".join(f"{level!r}D" for level in levels)
    low, high = "_from >= _after - _n AND _from < _after", "_to >= _after - _n AND _to < _after"
    at = ranked.selectExpr("*", f"explode(array({wanted})) AS level").selectExpr(
        "*", "CAST(floor(level * (_rows - 1)) AS long) AS _from", "least(CAST(floor(level * (_rows - 1)) AS long) + 1, _rows - 1) AS _to"
    )
    return at.groupBy(*key, "level", "_rows").agg(
        F.expr(f"max(CASE WHEN {low} THEN _min END)").alias("_lo"),
        F.expr(f"max(CASE WHEN {high} THEN _max END)").alias("_hi"),
        F.expr(f"max(CASE WHEN {low} THEN _after - _n END)").alias("_below"),
        F.expr(f"max(CASE WHEN {high} THEN _after END) - max(CASE WHEN {low} THEN _after - _n END)").alias("_inside"),
    )


def _sketch(rows: DataFrame, levels: Sequence[float], key: Sequence[str]) -> DataFrame:
    """One cell over all values of a key, and as edges two approximate quantiles around each level."""
    around = sorted({min(1.0, max(0.0, p + d)) for p in levels for d in (-2 / SKETCH_ACCURACY, 2 / SKETCH_ACCURACY)})
    shares = ", ".join(f"{p!r}D" for p in around)
    return rows.groupBy(*key).agg(
        F.lit(0).alias("_cell"), F.sum("n").alias("_n"), F.min("value").alias("_min"), F.max("value").alias("_max"),
        F.expr(f"percentile_approx(value, array({shares}), {SKETCH_ACCURACY})").alias("_edges"),
    )


def quantiles(
    rows: DataFrame, levels: Sequence[float], by: Sequence[str] = (), most: int = RANKED_ROWS
) -> DataFrame:
    """Exact quantiles of a table of rows: ``(*by, column, level, value)``.

    No more than ``most`` rows of a column and level are ranked together, unless they all have one value.
    """
    key = [*by, "column"]
    sketch = staged(_sketch(rows, levels, key), "sketch")
    found = staged(_brackets(sketch.drop("_edges"), levels, key), "brackets")
    wide = F.expr(f"_inside > {most} AND _lo < _hi")
    if found.where(wide).limit(1).count():
        edges = sketch.select(*key, "_edges")
        while True:
            cells = _cells(rows, broadcast_if_small(edges, "edges"), key)
            found = staged(_brackets(cells, levels, key), "brackets")
            open_ = found.where(wide)
            if not open_.limit(1).count():
                break
            # Edges evenly inside the cells that still hold too much, and at their ends.
            even = f"transform(sequence(0, {ROUND_EDGES}), i -> _lo + (_hi - _lo) * (i / {ROUND_EDGES}D))"
            ends = found.groupBy(*key).agg(
                F.array_sort(
                    F.array_distinct(
                        F.flatten(F.collect_list(F.expr(f"CASE WHEN _inside > {most} AND _lo < _hi THEN concat(array(_lo, _hi), {even}) ELSE array(_lo, _hi) END")))
                    )
                ).alias("_edges")
            )
            edges = ends
    spans = found.groupBy(*key).agg(
        F.collect_list(F.struct("level", "_lo", "_hi", "_below", "_rows")).alias("_spans"), F.min("_lo").alias("_least"), F.max("_hi").alias("_most")
    )
    inside = (
        rows.join(broadcast_if_small(spans, "spans"), key)
        .where("value >= _least AND value <= _most")  # nearly all rows end here
        .selectExpr(*key, "value", "n", "inline(filter(_spans, s -> value >= s._lo AND value <= s._hi))")
        .groupBy(*key, "level", "value", "_below", "_rows")
        .agg(F.sum("n").alias("n"))
    )
    running = Window.partitionBy(*key, "level").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = inside.withColumn("_after", F.sum("n").over(running) + F.col("_below")).selectExpr(
        "*", "_after - n AS _first", "level * (_rows - 1) AS _at"
    ).selectExpr("*", "floor(_at) AS _from", "least(floor(_at) + 1, _rows - 1) AS _to")
    ends = ranked.groupBy(*key, "level").agg(
        F.expr("max(CASE WHEN _from >= _first AND _from < _after THEN value END)").alias("_under"),
        F.expr("max(CASE WHEN _to >= _first AND _to < _after THEN value END)").alias("_over"),
        F.expr("max(_at - _from)").alias("_share"),
    )
    return ends.selectExpr(*key, "level", "_under + (_over - _under) * _share AS value")


def column_quantiles(df: DataFrame, columns: Sequence[str], level: float, most: int = RANKED_ROWS) -> dict[str, tuple[int, float]]:
    """Number of values and exact interpolated quantile of each column that has values; NULL and NaN are left out.

    For one level of a few columns of a stored table, which is read a few times: a sketch gives two edges around the wanted
    ranks, one pass counts the values below and between them, and only rows with a value between them are ranked. Columns
    whose edges miss the ranks, or hold more than ``most`` rows, go through ``quantiles``.
    """
    if not columns:
        return {}
    cells = df.selectExpr(*[f"nullif(CAST(`{c}` AS double), double('NaN')) AS _{i}" for i, c in enumerate(columns)])
    accuracy = min(100_000, max(SKETCH_ACCURACY, 6 * df.count() // most + 1))  # so that about 2/3 of ``most`` lie between the edges
    around = ", ".join(f"{min(1.0, max(0.0, level + d))!r}D" for d in (-2 / accuracy, 2 / accuracy))
    sketch = cells.agg(*[
        F.struct(F.count(f"_{i}"), F.expr(f"percentile_approx(_{i}, array({around}), {accuracy})")) for i in range(len(columns))
    ]).first()  # one row
    sizes = {i: n for i, (n, _) in enumerate(sketch) if n}
    if not sizes:
        return {}
    edges = {i: (F.lit(sketch[i][1][0]), F.lit(sketch[i][1][1])) for i in sizes}
    between = {i: F.col(f"_{i}").between(low, high) for i, (low, high) in edges.items()}
    counts = cells.agg(*[F.struct(F.count_if(F.col(f"_{i}") < edges[i][0]), F.count_if(between[i])) for i in sizes]).first()
    below, inside = ({i: c[k] for i, c in zip(sizes, counts)} for k in (0, 1))
    first = {i: math.floor(level * (n - 1)) for i, n in sizes.items()}
    last = {i: min(first[i] + 1, n - 1) for i, n in sizes.items()}
    held = [i for i in sizes if below[i] <= first[i] and last[i] < below[i] + inside[i] and inside[i] <= most]
    found = {}
    if held:
        near = cells.where(reduce(Column.__or__, [between[i] for i in held])).select(
            F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.when(between[i], F.col(f"_{i}")).alias("value"), F.lit(below[i]).alias("_below"), F.lit(first[i]).alias("_from"), F.lit(last[i]).alias("_to")) for i in held]))
        )
        steps = near.where("value IS NOT NULL").groupBy("i", "value", "_below", "_from", "_to").agg(F.count(F.lit(1)).alias("_n"))
        running = Window.partitionBy("i").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
        ends = steps.withColumn("_after", F.sum("_n").over(running) + F.col("_below")).groupBy("i").agg(
            F.expr("max(CASE WHEN _from >= _after - _n AND _from < _after THEN value END)").alias("under"),
            F.expr("max(CASE WHEN _to >= _after - _n AND _to < _after THEN value END)").alias("over"),
        )
        for r in ends.collect():  # one row a column
            share = level * (sizes[r["i"]] - 1) - first[r["i"]]
            found[r["i"]] = r["under"] + (r["over"] - r["under"]) * share
    missed = [columns[i] for i in sizes if i not in found]
    if missed:
        rest = {r["column"]: r["value"] for r in quantiles(value_rows(df, missed), [level], most=most).collect()}
        found |= {i: rest[c] for i, c in enumerate(columns) if c in rest}
    return {columns[i]: (n, found[i]) for i, n in sizes.items()}


def quantile_table(
    rows: DataFrame, names: dict[str, float], by: Sequence[str] = (), most: int = RANKED_ROWS
) -> DataFrame:
    """One row per (by, column) with a named column per level."""
    long = quantiles(rows, sorted(set(names.values())), by, most)
    return long.groupBy(*by, "column").agg(
        *[F.expr(f"max(CASE WHEN level = {q!r}D THEN value END)").alias(name) for name, q in names.items()]
    )


def histogram(counts: DataFrame, bins: int = 50, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins from the smallest to the largest value, the last one closed; empty bins stay.

    A column with a single value gets bins over one unit around it.
    """
    key = [*by, "column"]
    spread = counts.groupBy(*key).agg(F.min("value").alias("_min"), F.max("value").alias("_max"))
    ranges = broadcast_if_small(
        spread.selectExpr(
            *key,
            "CASE WHEN _min = _max THEN _min - 0.5D ELSE _min END AS _lo",
            "CASE WHEN _min = _max THEN _max + 0.5D ELSE _max END AS _hi",
        ),
        "ranges",
    )
    filled = (
        counts.join(ranges, key)
        .selectExpr(
            *key, "n", f"least(CAST(floor({bins} * (value - _lo) / (_hi - _lo)) AS int), {bins - 1}) AS bin"
        )
        .groupBy(*key, "bin")
        .agg(F.sum("n").alias("rows"))
    )
    return (
        ranges.selectExpr("*", f"explode(sequence(0, {bins - 1})) AS bin")
        .join(filled, [*key, "bin"], "left")
        .selectExpr(
            *key,
            "bin",
            f"_lo + (_hi - _lo) * bin / {bins} AS bin_from",
            f"_lo + (_hi - _lo) * (bin + 1) / {bins} AS bin_to",
            "coalesce(rows, 0L) AS rows",
        )
    )


def box_stats(rows: DataFrame, by: Sequence[str] = (), most: int = RANKED_ROWS) -> DataFrame:
    """Quartiles, whiskers (the last values within 1.5 IQR of the box) and the rows beyond 1.5 IQR."""
    key = [*by, "column"]
    quartiles = quantile_table(rows, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by, most)
    fenced = broadcast_if_small(
        quartiles.selectExpr("*", "q1 - 1.5D * (q3 - q1) AS _lo", "q3 + 1.5D * (q3 - q1) AS _hi"), "fences"
    )
    return (
        rows.join(fenced, key)
        .groupBy(*key)
        .agg(
            F.expr("min(CASE WHEN value >= _lo THEN value END)").alias("whisker_low"),
            F.first("q1").alias("q1"),
            F.first("median").alias("median"),
            F.first("q3").alias("q3"),
            F.expr("max(CASE WHEN value <= _hi THEN value END)").alias("whisker_high"),
            F.expr("coalesce(sum(CASE WHEN value < _lo OR value > _hi THEN n END), 0L)").alias("outliers"),
        )
    )


def _hermite(order: int, u: str) -> str:
    """The probabilists' Hermite polynomial as an expression."""
    last, now = {0: 1}, {1: 1}
    if order == 0:
        return "1D"
    for k in range(1, order):
        after = {p + 1: c for p, c in now.items()}
        for p, c in last.items():
            after[p] = after.get(p, 0) - k * c
        last, now = now, after
    return " + ".join(f"{c}D * " + (" * ".join([u] * p) or "1D") for p, c in sorted(now.items()) if c)


def density(rows: DataFrame, by: Sequence[str] = (), points: int = 200, reach: float = 3.0) -> DataFrame:
    """Gaussian kernel density of ``value_rows`` on an even grid reaching ``reach`` bandwidths beyond the data.

    The bandwidth is ``n^(-1/5)`` times the sample standard deviation and each group integrates to 1.

    Rows are summed once into cells of 1/16 bandwidth, as counts and moments about the cell's middle; the kernel of a cell
    is its Taylor series in these moments, so what is convolved depends on the grid and the bandwidth, not on the number
    of values. With ten moments and values within 1/32 bandwidth of the middle the density is off by less than
    1e-19 / bandwidth, far below what summing doubles costs; kernels are cut off at nine bandwidths, which loses less than 2e-18 / bandwidth.
    """
    key = [*by, "column"]
    # Spark's deviation is updated about the running mean: a large mean with a small spread does not cancel.
    moments = rows.groupBy(*key).agg(
        F.count("value").alias("_n"), F.min("value").alias("_min"), F.max("value").alias("_max"), F.stddev_samp("value").alias("_s")
    )
    kernels = broadcast_if_small(
        moments.where("_n > 1 AND _max > _min").selectExpr(*key, "_n", "_min", "_max", "pow(_n, -0.2D) * _s AS _h"), "kernels"
    )
    parts = CELLS_PER_BANDWIDTH
    cells = (
        rows.join(kernels, key)
        .selectExpr(*key, "(value - _min) / _h AS _u", f"floor((value - _min) / _h * {parts}) AS _cell")
        .selectExpr(*key, "_cell", f"_u - (_cell + 0.5D) / {parts} AS _d")
        .groupBy(*key, "_cell")
        .agg(*[F.expr(f"sum({' * '.join(['_d'] * k) or '1D'})").alias(f"_m{k}") for k in range(MOMENTS)])
    )
    # In bandwidths from the least value: the grid's points, and the points near enough to a cell.
    width = f"(((_max - _min) / _h + {2 * reach!r}D) / {points - 1})"
    middle = f"((_cell + 0.5D) / {parts})"
    near = (
        f"sequence(CAST(greatest(0, ceil(({middle} + {reach!r}D - 9) / {width})) AS int), "
        f"CAST(least({points - 1}, floor(({middle} + {reach!r}D + 9) / {width})) AS int))"
    )
    some = f"ceil(({middle} + {reach!r}D - 9) / {width}) <= {points - 1} AND greatest(0, ceil(({middle} + {reach!r}D - 9) / {width})) <= floor(({middle} + {reach!r}D + 9) / {width})"
    series = " + ".join(f"({_hermite(k, '_u')}) * _m{k} / {math.factorial(k)}D" for k in range(MOMENTS))
    scale = 1.0 / math.sqrt(2.0 * math.pi)
    x = f"(_min - {reach!r}D * _h) + (_max - _min + {2 * reach!r}D * _h) * point / {points - 1}"
    sums = (
        cells.join(kernels, key)
        .where(some)
        .selectExpr("*", f"explode({near}) AS point")
        .selectExpr(*key, "point", f"({x} - _min) / _h - {middle} AS _u", *[f"_m{k}" for k in range(MOMENTS)])
        .groupBy(*key, "point")
        .agg(F.expr(f"sum(exp(-0.5D * _u * _u) * ({series}))").alias("_sum"))
    )
    grid = kernels.selectExpr("*", f"explode(sequence(0, {points - 1})) AS point")
    return grid.join(sums, [*key, "point"], "left").selectExpr(
        *key, "point", f"{x} AS x", f"coalesce({scale!r}D * _sum / (_n * _h), 0D) AS density"
    )
