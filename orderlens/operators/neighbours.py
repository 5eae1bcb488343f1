"""How much a numeric column says about a label, from the distances of nearest neighbours.

For a row, the distance to its k-th neighbour among rows of its own label, and how many rows of any label are nearer
than that: where the label follows the value, hardly more than k are. With digamma functions of these counts the
estimate is digamma(n) + digamma(k) - mean digamma(rows of the label) - mean digamma(rows nearer), never below 0.

In one dimension neighbours stand next to each other. Rows are ranked per column and label; the ranks are cut into blocks that
share their k outermost rows, so a block finds all its distances alone. Rows nearer than a distance are a difference of two running
counts over the sorted values. Ranks and counts come from ``with_history``, which cuts columns and labels with very many rows.

Equal values are told apart by a shift of at most half a billionth of their size that a hash of the row decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.operators.ordered import DEFAULT_POLICY, SkewPolicy, with_history
from orderlens.sources.staging import staged

NEIGHBOURS = 3
BLOCK_ROWS = 100_000


def shifted(value: Column, key: Column) -> Column:
    """The value moved by up to half a billionth of its size (of 1, if smaller), as the hash of ``key`` says."""
    share = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0) - F.lit(0.5)
    return value + share * F.lit(1e-9) * F.greatest(F.lit(1.0), F.abs(value))


def digamma(n: Column) -> Column:
    """For whole numbers from 1 on: the series at n + 8, less the steps back down to n; off by less than 1e-14."""
    x = n + F.lit(8.0)
    y = F.lit(1.0) / (x * x)
    series = F.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y * (1 / 132)))))
    for i in range(8):
        series = series - 1.0 / (n + F.lit(float(i)))
    return series


def _distances(rows: DataFrame, k: int, block_rows: int, policy: SkewPolicy) -> DataFrame:
    """Adds ``_radius`` and ``_edge``: the distance to the k-th neighbour of the same column and label, and its value. Labels with k rows or fewer are left out."""
    ranked = with_history(rows, ["column", "_label"], ["value", "_row"], before={"_rank": "1"}, total={"_of_label": "1"}, policy=policy)
    ranked = ranked.where(F.col("_of_label") > k)
    block, at = F.floor(F.col("_rank") / block_rows), F.pmod("_rank", F.lit(block_rows))
    near = F.array(block, F.when((at < k) & (block > 0), block - 1), F.when(at >= block_rows - k, block + 1))
    copies = ranked.withColumn("_block", F.explode(F.array_distinct(F.array_compact(near)))).withColumn("_own", F.col("_block") == block)
    order = Window.partitionBy("column", "_label", "_block").orderBy("_rank")
    others = [f("value", i).over(order) for i in range(1, k + 1) for f in (F.lag, F.lead)]
    steps = [F.when(x.isNotNull(), F.struct(F.abs(x - F.col("value")).alias("d"), x.alias("at"))) for x in others]
    nearest = F.get(F.array_sort(F.array_compact(F.array(*steps))), F.lit(k - 1))
    found = copies.withColumn("_nearest", nearest).where("_own").drop("_block", "_own", "_rank")
    return found.withColumns({"_radius": F.col("_nearest.d"), "_edge": F.col("_nearest.at")}).drop("_nearest")


def neighbour_information(
    df: DataFrame, columns: Sequence[str], label: str, row_key: Sequence[str], k: int = NEIGHBOURS,
    block_rows: int = BLOCK_ROWS, policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """(column, rows, information): nats that each of ``columns`` tells about ``label``, over all rows without missing values.

    Rows whose label occurs k times or less are left out. ``row_key`` should identify a row: rows that repeat it and a value cannot be told apart.
    """
    if not k < block_rows:
        raise ValueError("a block must hold more rows than neighbours")
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in row_key])
    complete = df.select(F.col(label).cast("string").alias("_label"), key.alias("_key"), *[F.col(c).cast("double").alias(c) for c in columns]).dropna(subset=["_label", *columns])
    pairs = ", ".join(f"struct('{c}' AS column, `{c}` AS value)" for c in columns)
    long = complete.withColumn("_row", F.monotonically_increasing_id()).selectExpr("_label", "_key", "_row", f"inline(array({pairs}))")
    long = long.where(~F.isnan("value")).withColumn("value", shifted(F.col("value"), F.col("_key"))).drop("_key")
    found = staged(_distances(staged(long, "neighbour-values"), k, block_rows, policy), "neighbour-radius")
    # A row's questions: how many values are below value + radius, and how many not above value - radius. Equal values
    # must not count, so of equal places the upper question comes before the values and the lower one after them; with a radius of 0 equal values do count.
    tied = F.when(F.col("_radius") > 0, F.lit(1)).otherwise(F.lit(-1))
    # On the neighbour's side the border is its very value, so that rounding cannot take it in.
    upper = F.when(F.col("_edge") > F.col("value"), F.col("_edge")).otherwise(F.col("value") + F.col("_radius"))
    lower = F.when(F.col("_edge") < F.col("value"), F.col("_edge")).otherwise(F.col("value") - F.col("_radius"))
    places = F.array(
        F.struct(F.col("value").alias("at"), F.lit(0).alias("kind"), F.lit(1).alias("point"), F.lit(0).alias("sign")),
        F.struct(upper.alias("at"), (-tied).alias("kind"), F.lit(0).alias("point"), F.lit(1).alias("sign")),
        F.struct(lower.alias("at"), tied.alias("kind"), F.lit(0).alias("point"), F.lit(-1).alias("sign")),
    )
    asked = found.select("column", "_row", "_of_label", F.inline(places))
    counted = with_history(asked, ["column"], ["at", "kind", "sign", "_row"], before={"_before": "point"}, policy=policy)
    per_row = counted.where("sign <> 0").groupBy("column", "_row").agg(F.sum(F.col("sign") * F.col("_before")).alias("m"), F.first("_of_label").alias("_of_label"))
    means = per_row.groupBy("column").agg(
        F.count(F.lit(1)).alias("rows"), F.avg(digamma(F.col("m"))).alias("_m"), F.avg(digamma(F.col("_of_label"))).alias("_label")
    )
    estimate = digamma(F.col("rows")) + digamma(F.lit(k)) - F.col("_label") - F.col("_m")
    return means.select("column", "rows", F.greatest(F.lit(0.0), estimate).alias("information"))
