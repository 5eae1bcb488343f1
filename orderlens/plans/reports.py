"""Aggregate reports over the analytical dataset (``df``) or the model features (``features``).

Keys that are NULL or empty text are left out of grouped reports. Where rows tie in a ranking, the
key decides. Reports over features see logged columns: the order-count and backlog bins cut
``log(1 + x)``, so the bin named "1" holds customers with one and with two orders.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.bins import right_closed_bin
from orderlens.functions.calendar import day_name, month_start, whole_days_between
from orderlens.operators import distribution as dist
from orderlens.sources.staging import broadcast_if_small, staged

TS = "order_purchase_timestamp"
NUMERIC = (
    "distance_km",
    "total_items",
    "total_price",
    "total_freight",
    "total_payment",
    "max_installments",
    "lead_time_days_estimated",
    "is_late",
)
OUTLIER_COLUMNS = ("total_price", "total_freight", "distance_km")


def _known(df: DataFrame, *keys: str) -> DataFrame:
    text = {c for c, kind in df.dtypes if kind == "string"}
    for key in keys:
        df = df.where(f"`{key}` IS NOT NULL" + (f" AND `{key}` <> ''" if key in text else ""))
    return df


def late_rate_by(df: DataFrame, *keys: str) -> DataFrame:
    """Rows and late rate per key."""
    return (
        _known(df, *keys)
        .groupBy(*keys)
        .agg(F.avg("is_late").alias("late_rate"), F.count(F.lit(1)).alias("rows"))
    )


def _late_counts(df: DataFrame, key: str) -> DataFrame:
    """Staged ``(key, late, labelled, rows)`` with a row for NULL: the data is read once, whatever is made of it after."""
    counted = df.groupBy(key).agg(
        F.sum("is_late").alias("late"), F.count("is_late").alias("labelled"), F.count(F.lit(1)).alias("rows")
    )
    return staged(counted, "late-counts")


# ---------------------------------------------------------------- data quality and label
def missing_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, in one pass; empty text counts as missing."""
    tests = [f"`{c}` IS NULL" + (f" OR `{c}` = ''" if kind == "string" else "") for c, kind in df.dtypes]
    counted = df.selectExpr(*[f"count_if({t}) AS `{c}`" for t, c in zip(tests, df.columns)])
    pairs = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    return counted.selectExpr(f"stack({len(df.columns)}, {pairs}) AS (column_name, missing)")


def label_counts(df: DataFrame) -> DataFrame:
    """Rows per label, and the overall late percentage beside each."""
    counts = df.groupBy("is_late").agg(F.count(F.lit(1)).alias("rows"))
    overall = F.expr("100D * sum(is_late * rows) OVER () / sum(rows) OVER ()")
    return counts.withColumn("late_percent", overall)  # two rows: the window is over labels


# ---------------------------------------------------------------- distributions
def price_freight_grid(df: DataFrame, bins_per_decade: int = 5) -> DataFrame:
    """Price against freight on logarithmic axes: rows per cell and label. Zero amounts have no place
    on a log axis and are left out."""
    cell = "CAST(floor(log10({0}) * {1}) AS int)"
    return (
        df.where("total_price > 0 AND total_freight > 0")
        .selectExpr(
            f"{cell.format('total_price', bins_per_decade)} AS price_bin",
            f"{cell.format('total_freight', bins_per_decade)} AS freight_bin",
            "is_late",
        )
        .groupBy("price_bin", "freight_bin", "is_late")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def distance_lead_grid(df: DataFrame, km: int = 500, days: int = 2) -> DataFrame:
    """Distance against promised lead time: rows and late rate per cell."""
    return (
        df.where("distance_km IS NOT NULL AND lead_time_days_estimated IS NOT NULL")
        .selectExpr(
            f"CAST(floor(distance_km / {km}) * {km} AS int) AS km_from",
            f"CAST(floor(lead_time_days_estimated / {days}) * {days} AS int) AS days_from",
            "is_late",
        )
        .groupBy("km_from", "days_from")
        .agg(F.count(F.lit(1)).alias("rows"), F.avg("is_late").alias("late_rate"))
    )


def density_by_label(df: DataFrame, column: str, points: int = 200) -> DataFrame:
    return dist.density(dist.value_rows(df, [column], by=["is_late"]), by=["is_late"], points=points)


def density_over_histogram(df: DataFrame, column: str, points: int = 200) -> DataFrame:
    """The curve drawn over a histogram: it ends where the data ends."""
    return dist.density(dist.value_rows(df, [column]), points=points, reach=0.0)


def purchase_hours(df: DataFrame) -> DataFrame:
    return _known(df, "purchase_hour").groupBy("purchase_hour").agg(F.count(F.lit(1)).alias("rows"))


def histograms(df: DataFrame, columns: Sequence[str], bins: int = 50) -> DataFrame:
    return dist.histogram(dist.value_rows(df, columns), bins)


def distance_histograms(df: DataFrame, bins: int = 50) -> DataFrame:
    """Raw and log(1 + x) distances."""
    both = df.selectExpr("distance_km", "log1p(distance_km) AS log_distance_km")
    return histograms(both, ["distance_km", "log_distance_km"], bins)


def item_counts(df: DataFrame, most: int = 5) -> DataFrame:
    return df.where(f"total_items <= {most}").groupBy("total_items").agg(F.count(F.lit(1)).alias("rows"))


def installment_counts(df: DataFrame, most: int = 12) -> DataFrame:
    return (
        df.where(f"max_installments <= {most}")
        .groupBy("max_installments", "is_late")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def estimate_errors(df: DataFrame, orders: DataFrame) -> DataFrame:
    """Whole days between estimate and delivery (negative = early, unknown = 0), one row per dataset row.

    The delivery date is not part of the dataset; it comes from the orders.
    """
    dates = orders.select("order_id", "order_delivered_customer_date", "order_estimated_delivery_date")
    days = whole_days_between("order_estimated_delivery_date", "order_delivered_customer_date")
    return df.select("order_id").join(dates, "order_id").select("order_id", F.coalesce(days, F.lit(0)).alias("days_diff"))


# ---------------------------------------------------------------- late rates
def top_late_categories(df: DataFrame, k: int = 10) -> DataFrame:
    late = _known(df.where("is_late = 1"), "product_category")
    counts = late.groupBy("product_category").agg(F.count(F.lit(1)).alias("late_rows"))
    return counts.orderBy(F.desc("late_rows"), "product_category").limit(k)


def customer_state_rates(df: DataFrame) -> DataFrame:
    """Late rate per customer state beside the national average."""
    counts = _late_counts(df, "customer_state")
    national = counts.agg(F.expr("try_divide(CAST(sum(late) AS double), sum(labelled))").alias("national"))
    rates = _known(counts, "customer_state").selectExpr("customer_state", "try_divide(CAST(late AS double), labelled) AS late_rate", "rows")
    return rates.withColumn("national_rate", national.scalar())


def category_rates(df: DataFrame, k: int) -> DataFrame:
    """Late rate of the ``k`` biggest categories."""
    counts = _known(_late_counts(df, "product_category"), "product_category")
    biggest = counts.orderBy(F.desc("rows"), "product_category").limit(k)
    return biggest.selectExpr("product_category", "try_divide(CAST(late AS double), labelled) AS late_rate", "rows")


def seller_state_rates(df: DataFrame, more_than: int = 50) -> DataFrame:
    return late_rate_by(df, "seller_state").where(F.col("rows") > more_than)


def payment_type_rates(df: DataFrame) -> DataFrame:
    return late_rate_by(df, "primary_payment_type")


def monthly_rates(df: DataFrame) -> DataFrame:
    return late_rate_by(df.select(month_start(TS).alias("month"), "is_late"), "month")


def freight_share_rates(df: DataFrame, share: float = 0.5) -> DataFrame:
    """Late rate where freight is more than ``share`` of the price; free goods with freight count as more."""
    flag = (
        f"CASE WHEN total_freight / nullif(total_price, 0) > {share} OR (total_price = 0 AND total_freight > 0) "
        f"THEN 'High Freight (>{share * 100:g}%)' ELSE 'Normal Freight' END AS freight_flag"
    )
    return late_rate_by(df.selectExpr(flag, "is_late"), "freight_flag")


def weekday_rates(df: DataFrame) -> DataFrame:
    return late_rate_by(df, "purchase_day_of_week").withColumn("day_name", day_name("purchase_day_of_week"))


def top_seller_states(features: DataFrame, k: int = 10) -> DataFrame:
    return late_rate_by(features, "seller_state").orderBy(F.desc("late_rate"), "seller_state").limit(k)


def flag_rates(features: DataFrame, flags: Sequence[str] = ("is_black_friday", "is_holiday")) -> DataFrame:
    """Late rate with and without each flag."""
    pairs = ", ".join(f"'{f}', `{f}`" for f in flags)
    long = features.selectExpr("is_late", f"stack({len(flags)}, {pairs}) AS (flag, flag_value)")
    return late_rate_by(long, "flag", "flag_value")


# ---------------------------------------------------------------- dependence
def correlations(df: DataFrame, columns: Sequence[str] = NUMERIC) -> DataFrame:
    """Pearson matrix in long form; every pair uses the rows where both values are known."""
    pairs = list(combinations(columns, 2))
    one = df.selectExpr(
        *[f"corr(CAST({a} AS double), CAST({b} AS double)) AS `{a}|{b}`" for a, b in pairs],
        *[f"count({c}) AS `n|{c}`" for c in columns],
    )
    cells = [f"'{a}', '{b}', `{a}|{b}`, '{b}', '{a}', `{a}|{b}`" for a, b in pairs]
    cells += [f"'{c}', '{c}', CASE WHEN `n|{c}` > 1 THEN 1D END" for c in columns]
    return one.selectExpr(f"stack({len(columns) ** 2}, {', '.join(cells)}) AS (row_name, column_name, correlation)")


def mutual_information(df: DataFrame, columns: Sequence[str] = NUMERIC[:-1], bins: int = 10) -> DataFrame:
    """How much each column, cut at its quantiles, says about the label (in nats), over all rows
    without missing values."""
    complete = df.select(*columns, "is_late").dropna()
    counts = dist.value_rows(complete, columns, by=["is_late"])
    cuts = dist.quantiles(counts.drop("is_late"), [i / bins for i in range(1, bins)])
    edges = broadcast_if_small(cuts.groupBy("column").agg(F.collect_list("value").alias("_edges")), "edges")
    cells = (
        counts.join(edges, "column")
        .selectExpr("column", "is_late", "n", "size(filter(_edges, e -> e < value)) AS bin")
        .groupBy("column", "bin", "is_late")
        .agg(F.sum("n").alias("n"))
    )
    # From here on at most bins x labels rows per column.
    shares = cells.selectExpr(
        "column",
        "n / sum(n) OVER (PARTITION BY column) AS p",
        "sum(n) OVER (PARTITION BY column, bin) / sum(n) OVER (PARTITION BY column) AS px",
        "sum(n) OVER (PARTITION BY column, is_late) / sum(n) OVER (PARTITION BY column) AS py",
    )
    return shares.groupBy("column").agg(F.expr("sum(p * ln(p / (px * py)))").alias("information"))


# ---------------------------------------------------------------- outliers and boxes
def iqr_outliers(df: DataFrame, columns: Sequence[str] = OUTLIER_COLUMNS) -> DataFrame:
    """Rows beyond 1.5 IQR of the quartiles, as a count and as a share of all rows."""
    # A constant column rides along to count the rows, missing values included.
    counts = dist.value_rows(df.selectExpr(*columns, "0D AS _all"), [*columns, "_all"])
    boxes = dist.box_stats(counts.where("column <> '_all'"))
    rows = counts.where("column = '_all'").agg(F.sum("n").alias("rows"))
    return boxes.select("column", "outliers", rows.scalar().alias("rows")).selectExpr(
        "column", "outliers", "100D * outliers / rows AS percent"
    )


def boxes(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return dist.box_stats(dist.value_rows(df, columns, by), by)


# ---------------------------------------------------------------- binned features
def _rate_per_bin(features: DataFrame, column: str, edges: Sequence[float], labels: Sequence[str]) -> DataFrame:
    return late_rate_by(features.select(right_closed_bin(column, edges, labels).alias("bin"), "is_late"), "bin")


# The bins of the loyalty, review and backlog reports.
LOYALTY = ((-1, 0.1, 1.1, 5, 100), ("New", "Repeat", "Frequent", "VIP"))
ORDER_COUNT = ((0, 1.1, 2.1, 5.1, 100), ("1", "2", "3-5", "6+"))
REVIEW_SCORE = ((0, 3, 4, 4.5, 5), ("Low", "Fair", "Good", "Excellent"))
BACKLOG = ((-1, 2, 5, 20), ("Low", "Med", "High"))
TERTILES = ("Short", "Medium", "Long")


def loyalty_rates(features: DataFrame) -> DataFrame:
    return _rate_per_bin(features, "customer_total_orders", *LOYALTY)


def order_count_rates(features: DataFrame) -> DataFrame:
    """Like ``loyalty_rates`` with the report's bins; bins without rows stay, with a NULL rate."""
    edges, labels = ORDER_COUNT
    found = _rate_per_bin(features, "customer_total_orders", edges, labels)
    listed = ", ".join(f"'{x}'" for x in labels)
    every = features.sparkSession.range(1).selectExpr(f"explode(array({listed})) AS bin")
    return every.join(found, "bin", "left").selectExpr("bin", "late_rate", "coalesce(rows, 0L) AS rows")


def review_score_rates(features: DataFrame) -> DataFrame:
    """Sellers without a score yet (0) fall in no bin."""
    return _rate_per_bin(features, "seller_avg_review_score", *REVIEW_SCORE)


def _distance_pivot(features: DataFrame, column: str, edges: Sequence[float], labels: Sequence[str]) -> DataFrame:
    """Late rate by distance third (rows) and bin (columns)."""
    kept = staged(features.select("distance_km", column, "is_late"), "pivot-rows")  # read for the thirds and for the cells
    rows = dist.value_rows(kept, ["distance_km"])
    thirds = dist.quantile_table(rows, {"first": 1 / 3, "second": 2 / 3}).first()
    if thirds is None:
        raise ValueError("no distances to cut into thirds")
    third = (
        f"CASE WHEN distance_km <= {thirds['first']!r}D THEN 'Short' "
        f"WHEN distance_km <= {thirds['second']!r}D THEN 'Medium' WHEN distance_km IS NOT NULL THEN 'Long' END"
    )
    binned = kept.select(
        F.expr(third).alias("distance_third"), right_closed_bin(column, edges, labels).alias("_bin"), "is_late"
    )
    return (
        binned.where("distance_third IS NOT NULL AND _bin IS NOT NULL")
        .groupBy("distance_third")
        .pivot("_bin", list(labels))
        .agg(F.avg("is_late"))
    )


def distance_loyalty_pivot(features: DataFrame) -> DataFrame:
    return _distance_pivot(features, "customer_total_orders", *LOYALTY)


def distance_backlog_pivot(features: DataFrame) -> DataFrame:
    return _distance_pivot(features, "seller_state_backlog", *BACKLOG)
