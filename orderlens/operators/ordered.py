"""History of a key, in order: running totals, the last few rows, the previous row.

A plain ``Window.partitionBy(key)`` puts every row of a key in one task. Here a key with more rows
than one task should hold is cut into consecutive *parts* along its own order, the parts are windowed
separately, and what each part must know about earlier parts (sums so far, last few rows) is added.
The result is exact wherever the cuts fall, so they may come from a sample; the cuts themselves are
written out once, so every branch of the plan and every retried task sees the same ones.

Sizes: the cut table holds at most ``rows / rows_per_task`` cuts (plus one row per hot key). It is written and counted, and
it and the per-part sums are broadcast only up to ``MOST_CUTS`` rows; beyond that, joins on the key and block take over.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.sources.staging import staged


@dataclass(frozen=True)
class SkewPolicy:
    """When to cut a key. ``sample`` is the share of rows looked at to find hot keys."""

    rows_per_task: int = 8_000_000
    sample: float = 0.01
    seed: int = 42
    points_per_cut: int = 8


DEFAULT_POLICY = SkewPolicy()
_PART, _BLOCK, _LO, _HI = "_part", "_block", "_lo", "_hi"
_SPREAD = 4096
MOST_CUTS = 100_000


def find_cuts(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    policy: SkewPolicy = DEFAULT_POLICY,
    at_most: int | None = None,
) -> DataFrame | None:
    """Consecutive intervals ``[_lo, _hi)`` of ``order`` for each hot key, or None without hot keys.

    ``at_most`` is a known bound on the rows of ``df``; where no key can be hot, nothing is looked at.
    """
    if at_most is not None and at_most <= policy.rows_per_task:
        return None
    seen = df.select(*key, *order).where(_known(key))
    if policy.sample < 1.0:
        seen = seen.sample(policy.sample, policy.seed)
    limit = policy.rows_per_task * policy.sample
    sizes = staged(seen.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit), "hot-keys")
    if sizes.isEmpty():
        return None

    # A few sampled positions per wanted cut; every n-th of them, in order, becomes a cut.
    wanted = sizes.withColumn("_cuts", F.ceil(F.col("_n") / limit) - 1)
    thinned = (
        seen.join(_hinted(wanted, sizes.count()), list(key))
        .where(F.rand(policy.seed) * F.col("_n") < F.col("_cuts") * policy.points_per_cut)
        .select(*key, F.struct(*order).alias("_at"))
        .distinct()
    )
    along = Window.partitionBy(*key).orderBy("_at")
    starts = (
        thinned.withColumn("_i", F.row_number().over(along))
        .where(F.col("_i") % policy.points_per_cut == 0)
        .select(*key, F.col("_at").alias(_LO))
        .unionByName(sizes.select(*key), allowMissingColumns=True)
    )
    by_start = Window.partitionBy(*key).orderBy(F.col(_LO).asc_nulls_first())
    numbered = starts.select(
        *key,
        _LO,
        F.lead(_LO).over(by_start).alias(_HI),
        (F.row_number().over(by_start) - 1).alias(_PART),
    )
    # Parts come in blocks of about the square root of their number, so a row is compared with
    # the blocks of its key and then with the parts of one block, not with every part.
    of_key = ", ".join(f"`{k}`" for k in key)
    cuts = numbered.selectExpr(
        "*", f"CAST(floor({_PART} / ceil(sqrt(count(1) OVER (PARTITION BY {of_key})))) AS int) AS {_BLOCK}"
    )
    return staged(cuts, "cuts")


def _hinted(table: DataFrame, rows: int) -> DataFrame:
    """A broadcast hint for a table known to have few rows."""
    return F.broadcast(table) if rows <= MOST_CUTS else table


def _names(columns: Sequence[str], prefix: str = "") -> str:
    return ", ".join(f"{prefix}`{c}`" for c in columns)


def _known(key: Sequence[str]) -> str:
    return " AND ".join(f"`{k}` IS NOT NULL" for k in key)


def _within(
    df: DataFrame, intervals: DataFrame, rows: int, key: Sequence[str], order: Sequence[str], add: str, how: str
) -> DataFrame:
    """Join every row to the one interval of its key that holds it; ``add`` is the interval's number."""
    same_key = " AND ".join(f"r.`{k}` = c.`{k}`" for k in key)
    at = f"struct({_names(order, 'r.')})"
    inside = f"(c.{_LO} IS NULL OR {at} >= c.{_LO}) AND (c.{_HI} IS NULL OR {at} < c.{_HI})"
    return (
        df.alias("r")
        .join(_hinted(intervals.alias("c"), rows), F.expr(f"{same_key} AND {inside}"), how)
        .selectExpr("r.*", f"c.{add}")
    )


def _assign_parts(
    df: DataFrame, key: Sequence[str], order: Sequence[str], cuts: DataFrame, n_cuts: int, how: str
) -> DataFrame:
    blocks = cuts.groupBy(*key, _BLOCK).agg(
        F.min_by(_LO, _PART).alias(_LO), F.max_by(_HI, _PART).alias(_HI)
    )
    in_block = _within(df, blocks, n_cuts, key, order, _BLOCK, how)
    return _within(in_block, cuts, n_cuts, [*key, _BLOCK], order, _PART, how).drop(_BLOCK)


def with_history(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    *,
    before: Mapping[str, str] | None = None,
    recent: Mapping[str, str] | None = None,
    recent_rows: int = 5,
    previous: Mapping[str, str] | None = None,
    total: Mapping[str, str] | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
    at_most: int | None = None,
    looked_at: DataFrame | None = None,
) -> DataFrame:
    """Add history columns to every row of ``df``. Each mapping goes from column name to a SQL expression:

    ``before``   its sum over all earlier rows of the key (0 for the first row)
    ``recent``   its sum over the ``recent_rows`` rows before this one (0 for the first row)
    ``previous`` its value on the row before this one (NULL for the first row)
    ``total``    its sum over all rows of the key

    ``order`` must order the rows of a key completely. Rows whose key is NULL have no history: they
    get NULLs and are spread over many tasks. ``at_most`` bounds the rows of ``df`` where known.
    ``looked_at`` is a table with the same rows' key and order that is cheaper to read than ``df``; hot keys
    are looked for there.
    """
    before, recent, previous, total = (dict(m or {}) for m in (before, recent, previous, total))
    key, order = list(key), list(order)
    inputs = {**before, **recent, **previous, **total}
    cuts = find_cuts(df if looked_at is None else looked_at, key, order, policy, at_most)

    carried = halo = None
    value_of = {n: f"`_in_{n}`" for n in inputs}
    if cuts is None:
        rows, part = df, "0"
        value_of = {n: f"({e})" for n, e in inputs.items()}  # not shuffled beside the columns they are made of
    else:
        rows = df.selectExpr("*", *[f"{e} AS `_in_{n}`" for n, e in inputs.items()])
        n_cuts = cuts.count()
        hot = _assign_parts(rows, key, order, cuts, n_cuts, "inner")
        rows = _assign_parts(rows, key, order, cuts, n_cuts, "left")
        part = f"coalesce({_PART}, 0)"
        carried = _carry_sums(hot, key, list(before), list(total))
        if recent or previous:
            halo = _carry_rows(hot, key, order, [*recent, *previous], recent_rows)
    spread = f"-1 - pmod(xxhash64({_names(order)}), {_SPREAD})"
    kept = [c for c in rows.columns if c != _PART]
    rows = rows.selectExpr(
        *[f"`{c}`" for c in kept], f"CAST(CASE WHEN {_known(key)} THEN {part} ELSE {spread} END AS int) AS {_PART}"
    )
    if halo is not None:
        rows = rows.withColumn("_halo", F.lit(False)).unionByName(halo, allowMissingColumns=True)

    group = f"PARTITION BY {_names(key)}, {_PART}"
    ordered = f"{group} ORDER BY {_names(order)}"
    # Carried-over rows of earlier parts only serve `recent` and `previous`.
    own = "{}" if halo is None else "CASE WHEN NOT _halo THEN {} END"
    windows = [
        f"sum({own.format(value_of[n])}) OVER ({ordered} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS `{n}`"
        for n in before
    ]
    windows += [
        f"sum({value_of[n]}) OVER ({ordered} ROWS BETWEEN {recent_rows} PRECEDING AND 1 PRECEDING) AS `{n}`"
        for n in recent
    ]
    windows += [f"lag({value_of[n]}) OVER ({ordered}) AS `{n}`" for n in previous]
    windows += [f"sum({own.format(value_of[n])}) OVER ({group}) AS `{n}`" for n in total]
    out = rows.selectExpr("*", *windows)
    if halo is not None:
        out = out.where("NOT _halo")

    value = {n: f"coalesce(`{n}`, 0)" for n in [*before, *recent, *total]}
    if carried is not None:
        out = out.join(_hinted(carried, n_cuts), [*key, _PART], "left")
        value |= {n: f"coalesce(`{n}`, 0) + coalesce(`_add_{n}`, 0)" for n in before}
        value |= {n: f"coalesce(`_all_{n}`, `{n}`, 0)" for n in total}
    value |= {n: f"`{n}`" for n in previous}
    return out.selectExpr(
        *[f"`{c}`" for c in df.columns],
        *[f"CASE WHEN {_known(key)} THEN {value[n]} END AS `{n}`" for n in inputs],
    )


def _carry_sums(hot: DataFrame, key: list[str], before: list[str], total: list[str]) -> DataFrame | None:
    """One row per (hot key, part): sums over earlier parts and over the whole key."""
    names = [*before, *total]
    if not names:
        return None
    parts = hot.groupBy(*key, _PART).agg(*[F.sum(f"_in_{n}").alias(n) for n in names])
    earlier = f"PARTITION BY {_names(key)} ORDER BY {_PART} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return parts.selectExpr(
        *[f"`{k}`" for k in key],
        _PART,
        *[f"sum(`{n}`) OVER ({earlier}) AS `_add_{n}`" for n in before],
        *[f"sum(`{n}`) OVER (PARTITION BY {_names(key)}) AS `_all_{n}`" for n in total],
    )


def _carry_rows(hot: DataFrame, key: list[str], order: list[str], names: list[str], rows: int) -> DataFrame:
    """For every part, the last ``rows`` rows that come before it, labelled with that part."""
    inputs = [f"_in_{n}" for n in names]
    newest = ", ".join(f"`{c}` DESC" for c in order)
    tails = (
        hot.selectExpr(
            *[f"`{c}`" for c in [*key, _PART, *order, *inputs]],
            f"row_number() OVER (PARTITION BY {_names(key)}, {_PART} ORDER BY {newest}) AS _i",
        )
        .where(f"_i <= {rows}")
        .drop("_i")
    )
    return (
        tails.selectExpr(
            "*",
            f"collect_list(struct({_names([*order, *inputs])})) OVER (PARTITION BY {_names(key)} "
            f"ORDER BY {_names(order)} ROWS BETWEEN {rows} PRECEDING AND 1 PRECEDING) AS _last",
            f"row_number() OVER (PARTITION BY {_names(key)}, {_PART} ORDER BY {_names(order)}) AS _first",
        )
        .where(f"_first = 1 AND {_PART} > 0")
        .selectExpr(*[f"`{k}`" for k in key], _PART, "explode(_last) AS _row")
        .selectExpr(*[f"`{k}`" for k in key], _PART, "_row.*", "true AS _halo")
    )
