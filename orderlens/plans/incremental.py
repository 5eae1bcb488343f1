"""Histories that go on from where the last run ended.

After each run a table keeps, for every key, what its later rows need: how many rows it has had, the sums, and its last few rows. The next
run orders only the new rows (keys with very many of them are cut as usual) and adds what the table says. Done
day by day, the result is that of one run over all rows, at the cost of the new ones. Rows must not be older than
what their key has already seen; that is checked.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.operators.ordered import DEFAULT_POLICY, SkewPolicy, with_history
from orderlens.plans.history import ORDER, TS
from orderlens.sources.staging import staged


@dataclass(frozen=True)
class History:
    """Columns as ``with_history`` takes them: name to SQL expression."""

    key: tuple[str, ...]
    order: tuple[str, ...] = tuple(ORDER)
    before: Mapping[str, str] = field(default_factory=dict)
    recent: Mapping[str, str] = field(default_factory=dict)
    recent_rows: int = 5
    previous: Mapping[str, str] = field(default_factory=dict)

    @property
    def tail_rows(self) -> int:
        return max(self.recent_rows if self.recent else 0, 1)


SELLER = History(
    ("seller_id",), before={"_late": "is_late", "_orders": "1"}, recent={"_late5": "is_late", "_orders5": "1"}, previous={"_last": TS}
)
CUSTOMER = History(("customer_unique_id",), before={"_orders": "1"})
ROUTE = History(("seller_state", "customer_state"), before={"_late": "is_late", "_orders": "1"})


def _names(columns) -> str:
    return ", ".join(f"`{c}`" for c in columns)


def advance(
    rows: DataFrame, history: History, state: DataFrame | None = None, policy: SkewPolicy = DEFAULT_POLICY
) -> tuple[DataFrame, DataFrame]:
    """``rows`` with the history's columns, as if the rows behind ``state`` stood before them, and the state after them.

    Rows with a NULL in their key have no history (NULL) and leave no state. Both results are staged.
    """
    key, names = list(history.key), [*history.before, *history.recent, *history.previous]
    known = " AND ".join(f"`{k}` IS NOT NULL" for k in key)
    tail = {f"r_{n}": e for n, e in history.recent.items()} | {f"p_{n}": e for n, e in history.previous.items()}
    parts = ", ".join([f"struct({_names(history.order)}) AS at", *[f"{e} AS `{n}`" for n, e in tail.items()]])
    own = rows.selectExpr("*", f"struct({parts}) AS _tail")
    seen = with_history(
        own, key, list(history.order), before={**history.before, "_nth": "1"}, recent=history.recent or None, recent_rows=history.recent_rows,
        previous=history.previous or None, total={"_rows": "1", **{f"_sum_{n}": e for n, e in history.before.items()}}, policy=policy,
    )
    seen = staged(seen, "history-batch")
    ends = seen.where(known).groupBy(*key).agg(
        F.max("_rows").alias("rows"), *[F.max(f"_sum_{n}").alias(f"sum_{n}") for n in history.before],
        F.sort_array(F.collect_list(F.when(F.col("_rows") - F.col("_nth") <= history.tail_rows, F.col("_tail")))).alias("tail"),
    )
    if state is None:
        return staged(seen.select(*rows.columns, *names), "history-rows"), staged(ends, "history-state")
    old = state.select(*key, F.col("rows").alias("_old_rows"), F.col("tail").alias("_old_tail"), *[F.col(f"sum_{n}").alias(f"_old_{n}") for n in history.before])
    joined = seen.join(old, key, "left")
    late = joined.where(f"_nth = 0 AND struct({_names(history.order)}) <= element_at(_old_tail, -1).at")
    if not late.isEmpty():
        raise ValueError(f"rows of {key} are older than what their key has seen")
    value = {n: f"`{n}` + coalesce(`_old_{n}`, 0)" for n in history.before}
    missing = f"CAST(greatest({history.recent_rows} - _nth, 0) AS int)"
    for n in history.recent:
        # The first rows of a batch look back into the stored rows.
        earlier = f"aggregate(slice(reverse(coalesce(_old_tail, array())), 1, {missing}), CAST(0 AS double), (s, x) -> s + coalesce(x.`r_{n}`, 0))"
        value[n] = f"CAST(coalesce(`{n}`, 0) + {earlier} AS {dict(seen.dtypes)[n]})"
    value |= {n: f"CASE WHEN _nth = 0 THEN element_at(_old_tail, -1).`p_{n}` ELSE `{n}` END" for n in history.previous}
    out = joined.selectExpr(*[f"`{c}`" for c in rows.columns], *[f"CASE WHEN {known} THEN {value[n]} END AS `{n}`" for n in names])
    both = state.select(*key, *[F.col(c).alias(f"_a_{c}") for c in state.columns if c not in key]).join(
        ends.select(*key, *[F.col(c).alias(f"_b_{c}") for c in ends.columns if c not in key]), key, "full"
    )
    sums = [f"coalesce(`_a_{c}`, 0) + coalesce(`_b_{c}`, 0) AS `{c}`" for c in ("rows", *[f"sum_{n}" for n in history.before])]
    tails = f"concat(coalesce(_a_tail, array()), coalesce(_b_tail, array()))"
    after = both.selectExpr(*[f"`{k}`" for k in key], *sums, f"reverse(slice(reverse({tails}), 1, {history.tail_rows})) AS tail")
    return staged(out, "history-rows"), staged(after.select(*ends.columns), "history-state")


def load_state(spark: SparkSession, folder: str) -> tuple[DataFrame | None, int]:
    """The newest complete state below ``folder`` and its number; None and 0 where there is none."""
    try:
        numbers = [r["run"] for r in spark.read.schema("run int").parquet(f"{folder}/done").collect()]  # one row a run
    except AnalysisException:
        numbers = []
    newest = max(numbers, default=0)
    return (spark.read.parquet(f"{folder}/run-{newest}") if newest else None), newest


def advance_stored(rows: DataFrame, history: History, folder: str, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """``advance`` from the newest state in ``folder``, leaving the next one there.

    A state counts once its number is written, after its rows; a run that dies before leaves the earlier state in force.
    """
    spark = rows.sparkSession
    state, newest = load_state(spark, folder)
    out, after = advance(rows, history, state, policy)
    after.write.mode("overwrite").parquet(f"{folder}/run-{newest + 1}")
    spark.range(1).selectExpr(f"{newest + 1} AS run").write.mode("append").parquet(f"{folder}/done")
    return out
