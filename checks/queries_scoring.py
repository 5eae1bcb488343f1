"""Scoring requests, in batch and as a stream.

The oracles use a fixed formula as the scorer, so every step around a model is compared exactly; the
queries named ``model`` run the same steps with a fitted model.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.oracle_features import HOLIDAY_LIST
from checks.oracle_tables import define
from checks.queries_modeling import SMALL, features
from checks.registry import register, rounded
from orderlens.functions.labels import FEATURE_LABELS, feature_label, risk_sentence
from orderlens.plans import ensemble as en
from orderlens.plans import features as fe
from orderlens.plans import modeling as md
from orderlens.plans import scoring as sc
from orderlens.plans.dataset import analytical_dataset
from orderlens.sources.marketplace import marketplace_from_star
from orderlens.sources.staging import fresh_path, staged
from orderlens.streaming import scoring as stream

CAPS = {"total_price": 100000.0, "total_freight": 9000.0, "dist_backlog_ratio": 6.0, "required_velocity": 0.6}
FORMULA = (
    "1 / (1 + exp(-(0.5 * {distance_km} - 0.12 * {lead_time_days_estimated} + 0.8 * {is_holiday} "
    "+ 0.00001 * {total_price} + 2 * {required_velocity} - 2.2)))"
)
COLUMNS = ["distance_km", "lead_time_days_estimated", "is_holiday", "total_price", "required_velocity"]
_PLAIN = {c: c for c in COLUMNS}


def formula_scorer(df):
    return df.withColumn("late_probability", F.expr(FORMULA.format(**_PLAIN)))


def raw_requests(spark, folder):
    """One request per order, all fields as text; some lack a distance, some have unusable values."""
    columns = ["order_id", "distance_km", "lead_time_days_estimated", "total_weight_g", "total_price", "total_freight",
               "customer_state", "seller_state", "product_category", "order_purchase_timestamp", "total_items"]
    df = analytical_dataset(marketplace_from_star(spark, folder), columns, dedupe_reviews=True)
    return df.selectExpr(
        *[f"CAST({c} AS string) AS {c}" for c in columns if c not in ("total_items", "order_purchase_timestamp")],
        "CASE WHEN CAST(order_id AS bigint) % 13 = 0 THEN 'many' ELSE CAST(total_items AS string) END AS total_items",
        "CASE WHEN CAST(order_id AS bigint) % 17 = 0 THEN 'soon' ELSE CAST(order_purchase_timestamp AS string) END "
        "AS order_purchase_timestamp",
    )


def _valid(spark, folder):
    return sc.valid_requests(sc.checked_requests(raw_requests(spark, folder)))


def _scored(spark, folder):
    return sc.score_requests(_valid(spark, folder), formula_scorer, COLUMNS, CAPS)


define(
    "requests",
    """SELECT DISTINCT order_id, distance_km, lead_time_days_estimated::DOUBLE AS lead_time_days_estimated,
           total_weight_g::DOUBLE AS total_weight_g, total_price, total_freight, customer_state, seller_state,
           product_category, order_purchase_timestamp AS ts, total_items,
           order_id::BIGINT % 13 = 0 AS bad_items, order_id::BIGINT % 17 = 0 AS bad_time FROM plain_dataset""",
    "plain_dataset",
)


def _score_sql(km: str = "distance_km", lead: str = "lead_time_days_estimated", source: str = "good") -> str:
    """Model features of the formula and its probability, from raw request columns."""
    values = {
        "distance_km": "km", "lead_time_days_estimated": "lead", "is_holiday": "is_holiday",
        "total_price": "price", "required_velocity": "velocity",
    }
    return f"""SELECT *, {FORMULA.format(**values)} AS p FROM (
        SELECT *, ln(1 + {km}) AS km, {lead} AS lead, CAST(ts::DATE IN ({HOLIDAY_LIST}) AS INTEGER) AS is_holiday,
            least(total_price, 100000.0) AS price, least(ln(1 + {km}) / ({lead} + 1), 0.6) AS velocity FROM {source})"""


define("good", "SELECT * FROM requests WHERE distance_km IS NOT NULL AND NOT bad_items AND NOT bad_time", "requests")
define("scored", _score_sql(), "good")
BAND = "CASE WHEN p > 0.5 THEN 'High' WHEN p > 0.3 THEN 'Moderate' ELSE 'Low' END"


@register(
    "p01_input_contract",
    """SELECT order_id, distance_km IS NOT NULL AND NOT bad_items AND NOT bad_time AS valid,
           concat_ws('; ', CASE WHEN distance_km IS NULL THEN 'missing distance_km' END,
               CASE WHEN bad_time THEN 'not a timestamp_ntz: order_purchase_timestamp' END,
               CASE WHEN bad_items THEN 'not a int: total_items' END) AS reasons FROM requests""",
    "requests",
)
def _(spark, folder):
    checked = sc.checked_requests(raw_requests(spark, folder))
    both = sc.valid_requests(checked).selectExpr("order_id", "true AS valid", "'' AS reasons").unionByName(
        sc.rejected_requests(checked).selectExpr("order_id", "false AS valid", "concat_ws('; ', reasons) AS reasons")
    )
    return both


@register(
    "p02_request_features",
    """SELECT order_id, round(km, 6) AS distance_km, round(velocity, 6) AS required_velocity, is_holiday,
           round(least(total_freight, 9000.0), 2) AS total_freight, CAST(month(ts) AS VARCHAR) AS purchase_month,
           round(ln(2.0), 6) AS seller_state_backlog FROM scored""",
    "scored",
)
def _(spark, folder):
    df = sc.request_features(_valid(spark, folder), CAPS).select(
        "order_id", "distance_km", "required_velocity", "is_holiday", "total_freight", "purchase_month",
        "seller_state_backlog",
    )
    return rounded(df, total_freight=2)


@register(
    "p03_aligned_columns",
    """SELECT order_id, 0.0::DOUBLE AS max_installments, round(km, 6) AS distance_km, 0.0::DOUBLE AS total_payment FROM scored""",
    "scored",
)
def _(spark, folder):
    ready = sc.request_features(_valid(spark, folder), CAPS)
    return rounded(sc.aligned(ready, ["max_installments", "distance_km", "total_payment"], ["order_id"]))


@register(
    "p04_enforced_categoricals",
    """SELECT order_id, '0.0' AS purchase_month, coalesce(nullif(product_category, ''), 'UNKNOWN') AS product_category,
           'credit_card' AS primary_payment_type FROM scored""",
    "scored",
)
def _(spark, folder):
    ready = sc.request_features(_valid(spark, folder), CAPS, strict=True)
    return sc.aligned(ready, ["purchase_month", "product_category", "primary_payment_type"], ["order_id"])


@register(
    "p05_risk_bands",
    f"SELECT order_id, round(p, 4) AS delay_probability, p > 0.5 AS is_high_risk, {BAND} AS risk_level FROM scored",
    "scored",
)
def _(spark, folder):
    return sc.with_risk(_scored(spark, folder)).select("order_id", "delay_probability", "is_high_risk", "risk_level")


_BASELINE = {"distance_km": 6.0, "lead_time_days_estimated": 15.0, "is_holiday": 0.0, "total_price": 50000.0,
             "required_velocity": 0.3}


def _impact_sql() -> str:
    values = {
        "distance_km": "km", "lead_time_days_estimated": "lead", "is_holiday": "is_holiday",
        "total_price": "price", "required_velocity": "velocity",
    }
    return " UNION ALL ".join(
        f"SELECT order_id, '{c}' AS feature, p - {FORMULA.format(**(values | {c: repr(v)}))} AS d FROM scored"
        for c, v in _BASELINE.items()
    )


@register(
    "p06_top_risk_factors",
    f"""SELECT order_id, CAST(r AS INTEGER) AS rank, feature, round(d, 4) AS impact,
           CASE WHEN d >= 0 THEN 'increasing' ELSE 'decreasing' END AS direction
        FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY -abs(d), feature) AS r FROM ({_impact_sql()}))
        WHERE r <= 3""",
    "scored",
)
def _(spark, folder):
    ready = sc.request_features(_valid(spark, folder), CAPS)
    return sc.top_factors(sc.aligned(ready, COLUMNS, ["order_id"]), formula_scorer, COLUMNS, _BASELINE)


@register(
    "p07_what_if",
    f"""SELECT order_id, scenario, round(b, 4) AS delay_probability, round(p, 4) AS scenario_probability,
           round((round(p, 4) - round(b, 4)) * 100, 4) AS delta_points FROM (
        SELECT order_id, 'Distance +10%' AS scenario, p, b FROM (
            {_score_sql('distance_km * 1.1', source='(SELECT * EXCLUDE (p, km, lead, is_holiday, price, velocity), p AS b FROM scored)')})
        UNION ALL SELECT order_id, 'Lead Time -10%', p, b FROM (
            {_score_sql(lead='lead_time_days_estimated * 0.9',
                        source='(SELECT * EXCLUDE (p, km, lead, is_holiday, price, velocity), p AS b FROM scored)')}))""",
    "scored",
)
def _(spark, folder):
    found = sc.what_if(_scored(spark, folder), formula_scorer, COLUMNS, CAPS)
    return rounded(
        found.select("order_id", "scenario", "delay_probability", "scenario_probability", "delta_points"), 4
    )


@register(
    "p08_scenario_presets",
    """SELECT order_id, preset, round(CASE preset WHEN 'Standard Local' THEN 50.0 WHEN 'Long Distance' THEN 2500.0
               ELSE distance_km END, 6) AS distance_km,
           CASE preset WHEN 'Standard Local' THEN 5.0 WHEN 'Long Distance' THEN 20.0 ELSE lead_time_days_estimated END::DOUBLE
               AS lead_time_days_estimated,
           CASE preset WHEN 'Standard Local' THEN 'SP' WHEN 'Long Distance' THEN 'RN' ELSE customer_state END AS customer_state,
           CASE preset WHEN 'Holiday Rush' THEN seller_state ELSE 'SP' END AS seller_state,
           CASE preset WHEN 'Standard Local' THEN 0.5 WHEN 'Holiday Rush' THEN 4.5 ELSE 1.0 END::DOUBLE AS seller_state_backlog,
           CASE preset WHEN 'Standard Local' THEN 0.5 WHEN 'Holiday Rush' THEN 4.5 ELSE 1.0 END::DOUBLE AS seller_intensity_score,
           CASE preset WHEN 'Holiday Rush' THEN 0.15 ELSE 0.05 END::DOUBLE AS seller_historical_delay_rate
       FROM good, (SELECT unnest(['Standard Local', 'Long Distance', 'Holiday Rush']) AS preset)""",
    "good",
)
def _(spark, folder):
    df = sc.with_presets(_valid(spark, folder))
    return rounded(
        df.select(
            "order_id", "preset", "distance_km", "lead_time_days_estimated", "customer_state", "seller_state",
            "seller_state_backlog", "seller_intensity_score", "seller_historical_delay_rate",
        )
    )


@register(
    "p09_advanced_flag",
    """SELECT order_id, order_id::BIGINT % 2 = 0 OR product_category <> 'UNKNOWN' AS is_advanced
       FROM (SELECT order_id, CASE WHEN order_id::BIGINT % 3 = 0 THEN 'UNKNOWN' ELSE product_category END AS product_category
             FROM good)""",
    "good",
)
def _(spark, folder):
    # Inputs at their form defaults, except for the weight of even orders and most categories.
    form = _valid(spark, folder).selectExpr(
        "order_id", "1.0D AS seller_state_backlog", "4.5D AS seller_avg_review_score", "89.0D AS total_price",
        "0.05D AS seller_historical_delay_rate",
        "CASE WHEN CAST(order_id AS bigint) % 2 = 0 THEN 750.0D ELSE 500.0D END AS total_weight_g",
        "CASE WHEN CAST(order_id AS bigint) % 3 = 0 THEN 'UNKNOWN' ELSE product_category END AS product_category",
    )
    return sc.with_advanced_flag(form).select("order_id", "is_advanced")


_LABELS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FEATURE_LABELS.items() if k in COLUMNS)


@register(
    "f10_factor_sentences",
    f"""SELECT order_id, rank, label, label || CASE WHEN direction = 'increasing' THEN ': This is contributing to a higher risk of delay.'
               WHEN feature = 'required_velocity' THEN ': This factor is in an optimal state for on-time delivery.'
               ELSE ': This is significantly helping to keep the delivery on time.' END AS sentence
        FROM (SELECT order_id, CAST(r AS INTEGER) AS rank, feature, CASE feature {_LABELS} WHEN 'total_price' THEN 'Total Price'
                  WHEN 'lead_time_days_estimated' THEN 'Lead Time Days Estimated' END AS label,
                  CASE WHEN d >= 0 THEN 'increasing' ELSE 'decreasing' END AS direction
              FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY -abs(d), feature) AS r FROM ({_impact_sql()}))
              WHERE r <= 3)""",
    "scored",
)
def _(spark, folder):
    """Names from the label map and names spelled out, in both directions, with the wording of velocities."""
    ready = sc.request_features(_valid(spark, folder), CAPS)
    top = sc.top_factors(sc.aligned(ready, COLUMNS, ["order_id"]), formula_scorer, COLUMNS, _BASELINE)
    return top.select("order_id", "rank", feature_label("feature").alias("label"), risk_sentence("feature", "direction").alias("sentence"))


@register(
    "p10_alerts_per_mille",
    """SELECT order_id, CASE WHEN r > 0.5 THEN 'High Risk Alert: Predicted delay probability is ' || t
               || '%. Immediate intervention required.'
           WHEN r > 0.3 THEN 'Warning: Moderate risk detected (' || t || '%). Monitor closely.'
           ELSE 'Success: Low risk delivery (' || t || '%). On-time arrival expected.' END AS alert
       FROM (SELECT order_id, round(p, 3) AS r, printf('%.1f', round(p, 3) * 100) AS t FROM scored)""",
    "scored",
)
def _(spark, folder):
    # Three digits make percentages with one decimal, which both engines print alike.
    fine = sc.with_risk(_scored(spark, folder)).withColumn("delay_probability", F.expr("round(late_probability, 3)"))
    return sc.with_alert(fine).select("order_id", "alert")


@register(
    "p10_alerts",
    """SELECT order_id, CASE WHEN r > 0.5 THEN 'High Risk Alert: Predicted delay probability is ' || t
               || '%. Immediate intervention required.'
           WHEN r > 0.3 THEN 'Warning: Moderate risk detected (' || t || '%). Monitor closely.'
           ELSE 'Success: Low risk delivery (' || t || '%). On-time arrival expected.' END AS alert
       FROM (SELECT order_id, round(p, 2) AS r, printf('%.1f', round(p, 2) * 100) AS t FROM scored)""",
    "scored",
)
def _(spark, folder):
    # Two digits keep engines from disagreeing on how to print a half.
    coarse = sc.with_risk(_scored(spark, folder)).withColumn("delay_probability", F.expr("round(late_probability, 2)"))
    return sc.with_alert(coarse).select("order_id", "alert")


def _streamed(spark, raw, scorer, columns, thresholds):
    """The requests in two micro-batches, each of files enough for all cores."""
    home, half = fresh_path(spark, "stream"), max(2, spark.sparkContext.defaultParallelism)
    raw.repartition(2 * half, "order_id").write.parquet(f"{home}/requests")
    incoming = stream.request_stream(spark, f"{home}/requests", raw.schema, files_per_batch=half)
    good = stream.scored_stream(incoming, scorer, columns, thresholds)
    bad = stream.rejected_stream(incoming)
    for name, out in (("scored", good), ("rejected", bad)):
        stream.start(out, f"{home}/{name}", f"{home}/checkpoint-{name}").awaitTermination()
    scored = spark.read.schema(good.schema).parquet(f"{home}/scored")
    rejected = spark.read.schema(bad.schema).parquet(f"{home}/rejected")
    return scored, rejected


@register(
    "p11_stream_scoring",
    f"""SELECT order_id, round(p, 4) AS delay_probability, {BAND} AS risk_level FROM scored
        UNION ALL SELECT order_id, NULL, 'rejected' FROM requests WHERE order_id NOT IN (SELECT order_id FROM scored)""",
    "scored",
    "requests",
)
def _(spark, folder):
    scored, rejected = _streamed(spark, raw_requests(spark, folder), formula_scorer, COLUMNS, CAPS)
    return scored.select("order_id", "delay_probability", "risk_level").unionByName(
        rejected.selectExpr("order_id", "CAST(NULL AS double) AS delay_probability", "'rejected' AS risk_level")
    )


def _fitted(spark, folder):
    df = features(spark, folder)
    return df, md.fit_trees(df, SMALL), fe.fit_thresholds(df)


@register("p_model_scores_and_what_if")
def _(spark, folder):
    _, model, caps = _fitted(spark, folder)
    columns, scorer = sc.model_columns(model), sc.model_scorer(model)
    scored = sc.score_requests(_valid(spark, folder), scorer, columns, caps)
    return sc.what_if(scored, scorer, columns, caps)


@register("p_model_top_factors")
def _(spark, folder):
    df, model, caps = _fitted(spark, folder)
    columns, scorer = sc.model_columns(model), sc.model_scorer(model)
    baseline = sc.feature_baseline(df, columns)
    ready = sc.aligned(sc.request_features(_valid(spark, folder), caps), columns, ["order_id"])
    return sc.top_factors(ready, scorer, columns, baseline)


@register("p06_additive_factors", "SELECT order_id, 3::BIGINT AS factors, true AS adds_up FROM scored", "scored")
def _(spark, folder):
    """Per request: its three largest contributions, and whether all of them and the base are the log-odds of its probability."""
    _, model, caps = _fitted(spark, folder)
    columns = sc.model_columns(model)
    ready = staged(sc.aligned(sc.request_features(_valid(spark, folder), caps), columns, ["order_id"]), "requests")
    plain = md.without_gaps(ready)
    parts = en.contributions(model, plain, ["order_id"]).selectExpr("order_id", "base + aggregate(parts, 0D, (s, p) -> s + p.contribution) AS total")
    top = en.top_contributions(model, plain, "order_id").groupBy("order_id").agg(F.count("rank").alias("factors"))
    both = sc.model_scorer(model)(ready).select("order_id", "late_probability").join(parts, "order_id").join(top, "order_id")
    return both.selectExpr("order_id", "factors", "abs(total - ln(late_probability / (1 - late_probability))) < 1e-9 AS adds_up")


@register(
    "p_model_stream_equals_batch", "SELECT count(*) AS rows, 0::BIGINT AS differing FROM scored", "scored"
)
def _(spark, folder):
    _, model, caps = _fitted(spark, folder)
    columns, scorer = sc.model_columns(model), sc.model_scorer(model)
    raw = staged(raw_requests(spark, folder), "raw-requests")
    streamed, _ = _streamed(spark, raw, scorer, columns, caps)
    batch = sc.with_risk(sc.score_requests(sc.valid_requests(sc.checked_requests(raw)), scorer, columns, caps))
    both = streamed.select("order_id", F.col("delay_probability").alias("p")).join(batch.select("order_id", F.col("delay_probability").alias("q")), "order_id", "full")
    return both.agg(F.count(F.lit(1)).alias("rows"), F.expr("count_if(NOT p <=> q)").alias("differing"))


@register("p_model_stream")
def _(spark, folder):
    _, model, caps = _fitted(spark, folder)
    scored, _ = _streamed(spark, raw_requests(spark, folder), sc.model_scorer(model), sc.model_columns(model), caps)
    return scored.select("order_id", "delay_probability", "risk_level")


