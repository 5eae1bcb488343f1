"""Aggregate reports."""

from __future__ import annotations

from checks.registry import register, rounded
from orderlens.operators.neighbours import neighbour_information
from orderlens.plans import features as fe
from orderlens.plans import reports as rp
from orderlens.plans.dataset import ANALYTICAL_TYPES, analytical_dataset
from orderlens.sources.marketplace import marketplace_from_star

TS = "order_purchase_timestamp"


def _data(spark, folder, *columns):
    return analytical_dataset(marketplace_from_star(spark, folder), columns)


def _features(spark, folder, *columns):
    """Uncapped features: the reports on features read no capped column."""
    inputs = [*dict.fromkeys([*fe.REQUIRED, *columns, "is_late"])]
    return fe.prepare(_data(spark, folder, *inputs))


_TEXT = {c for c, k in ANALYTICAL_TYPES.items() if k.simpleString() == "string"}


@register(
    "a01_missing_counts",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL"
        + (f" OR {c} = ''" if c in _TEXT else "")
        + ") AS missing FROM analytical"
        for c in ANALYTICAL_TYPES
    ),
    "analytical",
)
def _(spark, folder):
    return rp.missing_counts(analytical_dataset(marketplace_from_star(spark, folder)))


@register(
    "a02_label_counts",
    """SELECT is_late, count(*) AS rows, round((SELECT avg(is_late) * 100 FROM plain_dataset), 6) AS late_percent
       FROM plain_dataset GROUP BY is_late""",
    "plain_dataset",
)
def _(spark, folder):
    return rounded(rp.label_counts(_data(spark, folder, "is_late")))


@register(
    "a03_price_freight_grid",
    """SELECT CAST(floor(log10(total_price) * 5) AS INTEGER) AS price_bin,
           CAST(floor(log10(total_freight) * 5) AS INTEGER) AS freight_bin, is_late, count(*) AS rows
       FROM plain_dataset WHERE total_price > 0 AND total_freight > 0 GROUP BY ALL""",
    "plain_dataset",
)
def _(spark, folder):
    return rp.price_freight_grid(_data(spark, folder, "total_price", "total_freight", "is_late"))


def _density_sql(column: str, source: str) -> str:
    return f"""SELECT k.is_late, '{column}' AS column_name, CAST(g.point AS INTEGER) AS point,
           round(lo - 3 * h + (hi - lo + 6 * h) * g.point / 199, 4) AS x,
           round(sum(exp(-0.5 * pow((lo - 3 * h + (hi - lo + 6 * h) * g.point / 199 - d.{column}) / h, 2)))
               / (max(n) * max(h) * sqrt(2 * pi())), 9) AS density
       FROM (SELECT is_late, count(*) AS n, min({column}) AS lo, max({column}) AS hi,
                 pow(count(*), -0.2) * stddev_samp({column}) AS h
             FROM {source} WHERE {column} IS NOT NULL GROUP BY is_late) k
       JOIN {source} d ON d.is_late = k.is_late AND d.{column} IS NOT NULL,
           (SELECT unnest(range(0, 200)) AS point) g
       GROUP BY k.is_late, g.point, lo, hi, h"""


def _density(df, column):
    curve = rp.density_by_label(df, column).withColumnRenamed("column", "column_name")
    return rounded(curve, x=4, density=9)


@register("a04_distance_density", _density_sql("distance_km", "plain_dataset"), "plain_dataset")
def _(spark, folder):
    return _density(_data(spark, folder, "distance_km", "is_late"), "distance_km")


def _curve_sql(column: str, source: str) -> str:
    return f"""SELECT '{column}' AS column_name, CAST(g.point AS INTEGER) AS point,
           round(lo + (hi - lo) * g.point / 199, 4) AS x,
           round(sum(exp(-0.5 * pow((lo + (hi - lo) * g.point / 199 - d.{column}) / h, 2)))
               / (max(n) * max(h) * sqrt(2 * pi())), 9) AS density
       FROM (SELECT count(*) AS n, min({column}) AS lo, max({column}) AS hi,
                 pow(count(*), -0.2) * stddev_samp({column}) AS h FROM {source} WHERE {column} IS NOT NULL) k,
           {source} d, (SELECT unnest(range(0, 200)) AS point) g
       WHERE d.{column} IS NOT NULL GROUP BY g.point, lo, hi, h"""


def _curve(df, column):
    return rounded(rp.density_over_histogram(df, column).withColumnRenamed("column", "column_name"), x=4, density=9)


@register("a05_purchase_hour_density", _curve_sql("purchase_hour", "plain_dataset"), "plain_dataset")
def _(spark, folder):
    return _curve(_data(spark, folder, "purchase_hour"), "purchase_hour")


@register(
    "a16_estimate_error_density",
    f"""SELECT * FROM (WITH src AS (SELECT coalesce(floor(date_diff('second', order_estimated_delivery_date,
            order_delivered_customer_date) / 86400.0), 0)::DOUBLE AS days_diff
            FROM plain_dataset JOIN shop_orders USING (order_id))
        {_curve_sql('days_diff', 'src')})""",
    "plain_dataset",
    "shop_orders",
)
def _(spark, folder):
    t = marketplace_from_star(spark, folder)
    return _curve(rp.estimate_errors(analytical_dataset(t, ["order_id"]), t.orders), "days_diff")


@register("a05_purchase_hours", "SELECT purchase_hour, count(*) AS rows FROM plain_dataset GROUP BY 1", "plain_dataset")
def _(spark, folder):
    return rp.purchase_hours(_data(spark, folder, "purchase_hour"))


@register(
    "a06_top_late_categories",
    """SELECT product_category, count(*) AS late_rows FROM plain_dataset WHERE is_late = 1 AND product_category <> ''
       GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "plain_dataset",
)
def _(spark, folder):
    return rp.top_late_categories(_data(spark, folder, "product_category", "is_late"))


def _histogram_sql(column: str, value: str, digits: int = 4) -> str:
    return f"""SELECT '{column}' AS column_name, CAST(bin AS INTEGER) AS bin,
           round(lo + (hi - lo) * bin / 50, {digits}) AS bin_from,
           round(lo + (hi - lo) * (bin + 1) / 50, {digits}) AS bin_to, count(x) AS rows
       FROM (SELECT min({value}) AS lo, max({value}) AS hi FROM src) r
       CROSS JOIN (SELECT unnest(range(0, 50)) AS bin) b
       LEFT JOIN (SELECT {value} AS x, least(CAST(floor(50 * ({value} - lo) / (hi - lo)) AS INTEGER), 49) AS xb
                  FROM src, (SELECT min({value}) AS lo, max({value}) AS hi FROM src)) v ON v.xb = b.bin
       GROUP BY bin, lo, hi"""


def _histograms(df):
    return rounded(df.withColumnRenamed("column", "column_name"), 4)


@register(
    "a07_price_freight_histograms",
    f"""SELECT * FROM (WITH src AS (SELECT total_price, total_freight FROM plain_dataset)
        {_histogram_sql('total_price', 'total_price')}
        UNION ALL {_histogram_sql('total_freight', 'total_freight')})""",
    "plain_dataset",
)
def _(spark, folder):
    df = _data(spark, folder, "total_price", "total_freight")
    return _histograms(rp.histograms(df, ["total_price", "total_freight"]))


@register(
    "a08_item_counts",
    "SELECT total_items, count(*) AS rows FROM plain_dataset WHERE total_items <= 5 GROUP BY 1",
    "plain_dataset",
)
def _(spark, folder):
    return rp.item_counts(_data(spark, folder, "total_items"))


@register(
    "a09_installments",
    "SELECT max_installments, is_late, count(*) AS rows FROM plain_dataset WHERE max_installments <= 12 GROUP BY ALL",
    "plain_dataset",
)
def _(spark, folder):
    return rp.installment_counts(_data(spark, folder, "max_installments", "is_late"))


_RATES = "round(avg(is_late), 6) AS late_rate, count(*) AS rows FROM"


@register(
    "a10_customer_state_rates",
    f"""SELECT customer_state, (SELECT round(avg(is_late), 6) FROM plain_dataset) AS national_rate, {_RATES}
        plain_dataset GROUP BY 1""",
    "plain_dataset",
)
def _(spark, folder):
    return rounded(rp.customer_state_rates(_data(spark, folder, "customer_state", "is_late")))


def _register_categories(name: str, k: int) -> None:
    @register(
        name,
        f"""SELECT product_category, {_RATES} plain_dataset WHERE product_category IN (
                SELECT product_category FROM plain_dataset WHERE product_category <> '' GROUP BY 1
                ORDER BY count(*) DESC, 1 LIMIT {k}) GROUP BY 1""",
        "plain_dataset",
    )
    def _(spark, folder, k=k):
        return rounded(rp.category_rates(_data(spark, folder, "product_category", "is_late"), k))


_register_categories("a11_category_rates", 15)


@register(
    "a12_seller_state_rates",
    f"SELECT seller_state, {_RATES} plain_dataset GROUP BY 1 HAVING count(*) > 50",
    "plain_dataset",
)
def _(spark, folder):
    return rounded(rp.seller_state_rates(_data(spark, folder, "seller_state", "is_late")))


@register(
    "a13_payment_types",
    f"SELECT primary_payment_type, {_RATES} plain_dataset WHERE primary_payment_type IS NOT NULL GROUP BY 1",
    "plain_dataset",
)
def _(spark, folder):
    return rounded(rp.payment_type_rates(_data(spark, folder, "primary_payment_type", "is_late")))


@register(
    "a14_monthly_rates",
    f"SELECT CAST(date_trunc('month', {TS}) AS TIMESTAMP) AS month, {_RATES} plain_dataset GROUP BY 1",
    "plain_dataset",
)
def _(spark, folder):
    return rounded(rp.monthly_rates(_data(spark, folder, TS, "is_late")))


@register(
    "a15_freight_share_rates",
    f"""SELECT CASE WHEN total_freight > 0.5 * total_price THEN 'High Freight (>50%)' ELSE 'Normal Freight' END
        AS freight_flag, {_RATES} plain_dataset GROUP BY 1""",
    "plain_dataset",
)
def _(spark, folder):
    return rounded(rp.freight_share_rates(_data(spark, folder, "total_price", "total_freight", "is_late")))


@register(
    "a16_estimate_errors",
    f"""SELECT * FROM (WITH src AS (SELECT coalesce(floor(date_diff('second', order_estimated_delivery_date,
            order_delivered_customer_date) / 86400.0), 0)::DOUBLE AS days_diff
            FROM plain_dataset JOIN shop_orders USING (order_id))
        {_histogram_sql('days_diff', 'days_diff')})""",
    "plain_dataset",
    "shop_orders",
)
def _(spark, folder):
    t = marketplace_from_star(spark, folder)
    errors = rp.estimate_errors(analytical_dataset(t, ["order_id"]), t.orders)
    return _histograms(rp.histograms(errors, ["days_diff"]))


@register(
    "a17_correlations",
    "\nUNION ALL ".join(
        f"SELECT '{a}' AS row_name, '{b}' AS column_name, "
        f"round(corr({a}, {b}), 6) AS correlation FROM plain_dataset"
        for a in rp.NUMERIC
        for b in rp.NUMERIC
        if a != b
    )
    + "\nUNION ALL SELECT c, c, 1.0::DOUBLE FROM (SELECT unnest(["
    + ", ".join(f"'{c}'" for c in rp.NUMERIC)
    + "]) AS c)",
    "plain_dataset",
)
def _(spark, folder):
    return rounded(rp.correlations(_data(spark, folder, *rp.NUMERIC)))


_MI = rp.NUMERIC[:-1]
_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in rp.NUMERIC)


def _information_sql(c: str) -> str:
    edges = ", ".join(f"quantile_cont({c}::DOUBLE, {i / 10})" for i in range(1, 10))
    return f"""SELECT '{c}' AS column_name, round(sum(n / t * ln((n / t) / ((nx / t) * (ny / t)))), 6) AS information
        FROM (SELECT bin, is_late, n::DOUBLE AS n, sum(n) OVER (PARTITION BY bin)::DOUBLE AS nx,
                  sum(n) OVER (PARTITION BY is_late)::DOUBLE AS ny, sum(n) OVER ()::DOUBLE AS t
              FROM (SELECT len(list_filter(edges, lambda e: e < {c}::DOUBLE)) AS bin, is_late, count(*) AS n
                    FROM complete, (SELECT [{edges}] AS edges FROM complete) GROUP BY ALL))"""


@register(
    "a18_mutual_information",
    f"SELECT * FROM (WITH complete AS (SELECT * FROM plain_dataset WHERE {_COMPLETE}) "
    + " UNION ALL ".join(_information_sql(c) for c in _MI)
    + ")",
    "plain_dataset",
)
def _(spark, folder):
    found = rp.mutual_information(_data(spark, folder, *rp.NUMERIC))
    return rounded(found.withColumnRenamed("column", "column_name"))


def _digamma(n: str) -> str:
    x = f"({n} + 8.0)"
    steps = " + ".join(f"1.0 / ({n} + {i}.0)" for i in range(8))
    return f"(ln({x}) - 0.5 / {x} - 1 / (12 * {x} * {x}) + 1 / (120 * pow({x}, 4)) - 1 / (252 * pow({x}, 6)) + 1 / (240 * pow({x}, 8)) - ({steps}))"


def _neighbours_sql(c: str) -> str:
    near = ", ".join(f"{f}(v, {i}) OVER (PARTITION BY is_late ORDER BY v)" for i in (1, 2, 3) for f in ("lag", "lead"))
    return f"""SELECT '{c}' AS column_name, count(*) AS rows,
        round(greatest(0, {_digamma('count(*)')} + {_digamma('3.0')} - avg({_digamma('mine')}) - avg({_digamma('m')})), 6) AS information
        FROM (SELECT order_id, any_value(mine) AS mine, count(*) AS m
              FROM (SELECT *, CASE WHEN edge > v THEN edge ELSE v + r END AS hi, CASE WHEN edge < v THEN edge ELSE v - r END AS lo
                    FROM (SELECT *, kth.d AS r, kth.p AS edge FROM (
                        SELECT *, list_sort(list_filter([CASE WHEN q IS NULL THEN NULL ELSE {{'d': abs(q - v), 'p': q}} END FOR q IN near],
                               lambda z: z IS NOT NULL))[3] AS kth
                        FROM (SELECT *, [{near}] AS near, count(*) OVER (PARTITION BY is_late) AS mine FROM moved_{c}))) WHERE mine > 3) a
              JOIN (SELECT v AS w FROM moved_{c}) b ON w < hi AND w > lo GROUP BY order_id)"""


_MOVED = "CAST(concat('0x', substr(md5(order_id), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE - 0.5"


@register(
    "a18_neighbour_information",
    f"SELECT * FROM (WITH complete AS MATERIALIZED (SELECT DISTINCT order_id, is_late, {', '.join(_MI)} FROM plain_dataset WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _MI)}), "
    + ", ".join(
        f"moved_{c} AS MATERIALIZED (SELECT order_id, is_late, {c}::DOUBLE + ({_MOVED}) * 1e-9::DOUBLE * greatest(1.0::DOUBLE, abs({c}::DOUBLE)) AS v FROM complete)"
        for c in _MI
    )
    + " "
    + " UNION ALL ".join(_neighbours_sql(c) for c in _MI)
    + ")",
    "plain_dataset",
)
def _(spark, folder):
    df = analytical_dataset(marketplace_from_star(spark, folder), ["order_id", "is_late", *_MI], dedupe_reviews=True)
    found = neighbour_information(df, _MI, "is_late", ["order_id"])
    return rounded(found.withColumnRenamed("column", "column_name"))


@register(
    "a19_distance_histograms",
    f"""SELECT * FROM (WITH src AS (SELECT distance_km FROM plain_dataset)
        {_histogram_sql('distance_km', 'distance_km')}
        UNION ALL {_histogram_sql('log_distance_km', 'ln(1 + distance_km)')})""",
    "plain_dataset",
)
def _(spark, folder):
    return _histograms(rp.distance_histograms(_data(spark, folder, "distance_km")))


@register(
    "a20_weekday_rates",
    f"""SELECT purchase_day_of_week, ['Mon','Tue','Wed','Thu','Fri','Sat','Sun'][purchase_day_of_week + 1] AS day_name,
        {_RATES} plain_dataset GROUP BY 1, 2""",
    "plain_dataset",
)
def _(spark, folder):
    return rounded(rp.weekday_rates(_data(spark, folder, "purchase_day_of_week", "is_late")))


@register(
    "a21_distance_lead_grid",
    f"""SELECT CAST(floor(distance_km / 500) * 500 AS INTEGER) AS km_from,
           CAST(floor(lead_time_days_estimated / 2.0) * 2 AS INTEGER) AS days_from, {_RATES} plain_dataset
        WHERE distance_km IS NOT NULL AND lead_time_days_estimated IS NOT NULL GROUP BY 1, 2""",
    "plain_dataset",
)
def _(spark, folder):
    return rounded(rp.distance_lead_grid(_data(spark, folder, "distance_km", "lead_time_days_estimated", "is_late")))


_register_categories("a22_target_encoding", 20)

_FENCES = """SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi"""


def _box_source(columns, source, label="NULL"):
    return " UNION ALL ".join(f"SELECT '{c}' AS c, {c}::DOUBLE AS v, {label} AS l FROM {source}" for c in columns)


@register(
    "a23_iqr_outliers",
    f"""SELECT c AS column_name, count(*) FILTER (v < lo OR v > hi) AS outliers,
           round(100.0 * count(*) FILTER (v < lo OR v > hi) / count(*), 6) AS percent
        FROM ({_box_source(rp.OUTLIER_COLUMNS, 'plain_dataset')}) JOIN (
            {_FENCES} FROM (SELECT c, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3
            FROM ({_box_source(rp.OUTLIER_COLUMNS, 'plain_dataset')}) GROUP BY c)) USING (c) GROUP BY c""",
    "plain_dataset",
)
def _(spark, folder):
    found = rp.iqr_outliers(_data(spark, folder, *rp.OUTLIER_COLUMNS))
    return rounded(found.withColumnRenamed("column", "column_name"))


def _box_sql(columns, source, label):
    src = _box_source(columns, source, label)
    return f"""SELECT l AS is_late, c AS column_name, round(min(v) FILTER (v >= lo), 6) AS whisker_low,
           round(max(q1), 6) AS q1, round(max(m), 6) AS median, round(max(q3), 6) AS q3,
           round(max(v) FILTER (v <= hi), 6) AS whisker_high, count(*) FILTER (v < lo OR v > hi) AS outliers
        FROM ({src}) JOIN ({_FENCES} FROM (SELECT c, l, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS m,
            quantile_cont(v, 0.75) AS q3 FROM ({src}) GROUP BY c, l)) USING (c, l) GROUP BY c, l"""


@register(
    "a24_boxes",
    f"SELECT * EXCLUDE (is_late) FROM ({_box_sql(rp.OUTLIER_COLUMNS, 'plain_dataset', '0')})",
    "plain_dataset",
)
def _(spark, folder):
    found = rp.boxes(_data(spark, folder, *rp.OUTLIER_COLUMNS), rp.OUTLIER_COLUMNS)
    return rounded(found.withColumnRenamed("column", "column_name"))


_BACKLOGS = ("seller_state_backlog", "customer_state_backlog")


@register("a24_backlog_boxes_by_label", _box_sql(_BACKLOGS, "uncapped", "is_late"), "uncapped")
def _(spark, folder):
    found = rp.boxes(_features(spark, folder, *_BACKLOGS), _BACKLOGS, by=["is_late"])
    return rounded(found.withColumnRenamed("column", "column_name"))


@register(
    "a25_calendar_flag_rates",
    f"""SELECT 'is_black_friday' AS flag, is_black_friday AS flag_value, {_RATES} logged GROUP BY 2
        UNION ALL SELECT 'is_holiday', is_holiday, {_RATES} logged GROUP BY 2""",
    "logged",
)
def _(spark, folder):
    return rounded(rp.flag_rates(_features(spark, folder)))


@register("a26_recent_delay_density", _density_sql("seller_recent_delay_rate", "uncapped"), "uncapped")
def _(spark, folder):
    return _density(_features(spark, folder, "seller_recent_delay_rate"), "seller_recent_delay_rate")


def _cut(column: str, edges, labels) -> str:
    cases = " ".join(
        f"WHEN {column} > {lo} AND {column} <= {hi} THEN '{x}'" for lo, hi, x in zip(edges, edges[1:], labels)
    )
    return f"CASE {cases} END"


@register(
    "a27_loyalty_rates",
    f"""SELECT bin, {_RATES} (SELECT {_cut('customer_total_orders', *rp.LOYALTY)} AS bin, is_late FROM logged)
        WHERE bin IS NOT NULL GROUP BY 1""",
    "logged",
)
def _(spark, folder):
    return rounded(rp.loyalty_rates(_features(spark, folder, "customer_total_orders")))


@register(
    "a28_order_count_rates",
    f"""SELECT bin, round(avg(is_late), 6) AS late_rate, count(is_late) AS rows
        FROM (SELECT unnest(['1', '2', '3-5', '6+']) AS bin) LEFT JOIN
            (SELECT {_cut('customer_total_orders', *rp.ORDER_COUNT)} AS bin, is_late FROM logged) USING (bin)
        GROUP BY 1""",
    "logged",
)
def _(spark, folder):
    return rounded(rp.order_count_rates(_features(spark, folder, "customer_total_orders")))


@register(
    "a29_review_score_rates",
    f"""SELECT bin, {_RATES} (SELECT {_cut('seller_avg_review_score', *rp.REVIEW_SCORE)} AS bin, is_late FROM logged)
        WHERE bin IS NOT NULL GROUP BY 1""",
    "logged",
)
def _(spark, folder):
    return rounded(rp.review_score_rates(_features(spark, folder, "seller_avg_review_score")))


def _pivot_sql(column: str, edges, labels) -> str:
    cells = ", ".join(f"round(avg(is_late) FILTER (bin = '{x}'), 6) AS \"{x}\"" for x in labels)
    return f"""SELECT distance_third, {cells} FROM (
        SELECT CASE WHEN distance_km <= e1 THEN 'Short' WHEN distance_km <= e2 THEN 'Medium' ELSE 'Long' END
               AS distance_third, {_cut(column, edges, labels)} AS bin, is_late
        FROM logged, (SELECT quantile_cont(distance_km, {1 / 3}) AS e1, quantile_cont(distance_km, {2 / 3}) AS e2
                      FROM logged)) WHERE bin IS NOT NULL GROUP BY 1"""


@register("a30_distance_loyalty_pivot", _pivot_sql("customer_total_orders", *rp.LOYALTY), "logged")
def _(spark, folder):
    return rounded(rp.distance_loyalty_pivot(_features(spark, folder, "customer_total_orders")))


@register("a31_distance_backlog_pivot", _pivot_sql("seller_state_backlog", *rp.BACKLOG), "logged")
def _(spark, folder):
    return rounded(rp.distance_backlog_pivot(_features(spark, folder)))


@register(
    "a32_top_seller_states",
    f"SELECT seller_state, {_RATES} logged GROUP BY 1 ORDER BY avg(is_late) DESC, 1 LIMIT 10",
    "logged",
)
def _(spark, folder):
    return rounded(rp.top_seller_states(_features(spark, folder, "seller_state")))
