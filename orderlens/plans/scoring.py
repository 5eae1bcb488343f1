"""Scoring requests: input contract, alignment, risk bands, risk factors and what-if scenarios.

A request is a row; whatever else the row carries (an id, say) is kept. A *scorer* adds
``late_probability`` to rows of model features, usually ``model_scorer`` around a fitted model.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.plans import features as fe
from orderlens.plans.ensemble import top_impacts
from orderlens.plans.modeling import feature_columns, without_gaps

Scorer = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    default: str | None = None  # SQL literal; None means required


# The fields of a scoring request and their defaults.
REQUEST = (
    Field("distance_km", "double"),
    Field("lead_time_days_estimated", "double"),
    Field("total_weight_g", "double"),
    Field("total_price", "double"),
    Field("total_freight", "double"),
    Field("customer_state", "string"),
    Field("seller_state", "string"),
    Field("product_category", "string", "'UNKNOWN'"),
    Field("primary_payment_type", "string", "'credit_card'"),
    Field("order_purchase_timestamp", "timestamp_ntz"),
    Field("seller_avg_review_score", "double", "4.0D"),
    Field("seller_historical_delay_rate", "double", "0.05D"),
    Field("total_items", "int", "1"),
    Field("avg_product_volume_cm3", "double", "1000.0D"),
    Field("seller_state_backlog", "double", "1.0D"),
    Field("seller_intensity_score", "double", "1.0D"),
    Field("route_delay_rate", "double", "0.02D"),
)
REQUEST_FIELDS = tuple(f.name for f in REQUEST)
# The inputs called advanced and their form defaults.
ADVANCED_DEFAULTS = {
    "seller_state_backlog": "1.0D",
    "seller_avg_review_score": "4.5D",
    "seller_historical_delay_rate": "0.05D",
    "total_weight_g": "500.0D",
    "total_price": "89.0D",
    "product_category": "'UNKNOWN'",
}
# What-if factors and preset overrides.
WHAT_IF = {"Distance +10%": {"distance_km": 1.1}, "Lead Time -10%": {"lead_time_days_estimated": 0.9}}
PRESETS: dict[str, dict[str, str]] = {
    "Standard Local": {
        "distance_km": "50.0D",
        "lead_time_days_estimated": "5.0D",
        "seller_state_backlog": "0.5D",
        "customer_state": "'SP'",
        "seller_state": "'SP'",
    },
    "Long Distance": {
        "distance_km": "2500.0D",
        "lead_time_days_estimated": "20.0D",
        "customer_state": "'RN'",
        "seller_state": "'SP'",
    },
    "Holiday Rush": {"seller_state_backlog": "4.5D", "seller_historical_delay_rate": "0.15D"},
}


# ---------------------------------------------------------------- input contract
def checked_requests(raw: DataFrame) -> DataFrame:
    """Type every field, fill defaults and list what is wrong in ``reasons`` (empty for a good request)."""
    present = set(raw.columns)
    typed, reasons = [], []
    for f in REQUEST:
        given = f"`{f.name}`" if f.name in present else f"CAST(NULL AS {f.kind})"
        cast = f"try_cast({given} AS {f.kind})"
        typed.append(f"coalesce({cast}, {f.default}) AS `{f.name}`" if f.default else f"{cast} AS `{f.name}`")
        if f.default is None:
            reasons.append(f"CASE WHEN {given} IS NULL THEN 'missing {f.name}' END")
        reasons.append(f"CASE WHEN {given} IS NOT NULL AND {cast} IS NULL THEN 'not a {f.kind}: {f.name}' END")
    others = [f"`{c}`" for c in raw.columns if c not in REQUEST_FIELDS]
    return raw.selectExpr(*others, *typed, f"filter(array({', '.join(reasons)}), r -> r IS NOT NULL) AS reasons")


def valid_requests(checked: DataFrame) -> DataFrame:
    return checked.where("size(reasons) = 0").drop("reasons")


def rejected_requests(checked: DataFrame) -> DataFrame:
    return checked.where("size(reasons) > 0")


# ---------------------------------------------------------------- scoring
def request_features(requests: DataFrame, thresholds: Mapping[str, float], strict: bool = False) -> DataFrame:
    """The training features of each request. The purchase month, weekday and hour are derived unless
    ``strict``, where they stay absent and alignment fills them with 0, as the online service did."""
    if not strict:
        ts = fe.TS
        requests = requests.selectExpr(
            "*", f"month({ts}) AS purchase_month", f"weekday({ts}) AS purchase_day_of_week", f"hour({ts}) AS purchase_hour"
        )
    return fe.cap(fe.prepare(requests), thresholds)


def aligned(features: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the model's columns in its order; absent ones are 0.0. Categoricals end up as text."""
    have = set(features.columns)
    picked = features.selectExpr(
        *[f"`{c}`" for c in keep], *[f"`{c}`" if c in have else f"0.0D AS `{c}`" for c in columns]
    )
    return fe.fill_categoricals(picked)


def model_columns(model: PipelineModel) -> list[str]:
    return [c.removesuffix("_index") for c in model.stages[-2].getInputCols()]


@dataclass(frozen=True)
class ModelScorer:
    model: PipelineModel

    def __call__(self, features: DataFrame) -> DataFrame:
        scored = self.model.transform(without_gaps(features))
        return scored.select(*features.columns, vector_to_array("probability")[1].alias("late_probability"))


def model_scorer(model: PipelineModel) -> Scorer:
    return ModelScorer(model)


def score_requests(
    requests: DataFrame,
    scorer: Scorer,
    columns: Sequence[str],
    thresholds: Mapping[str, float] | None = None,
    strict: bool = False,
) -> DataFrame:
    """Every request with its ``late_probability``; the request's own columns stay as they were."""
    packed = requests.selectExpr("*", f"struct({', '.join(f'`{c}`' for c in requests.columns)}) AS _request")
    ready = aligned(request_features(packed, thresholds or {}, strict), columns, ["_request"])
    return scorer(ready).selectExpr("_request.*", "late_probability")


def with_risk(scored: DataFrame) -> DataFrame:
    """Rounded probability, flag and band; the bands look at the unrounded probability."""
    return scored.selectExpr(
        "*",
        "round(late_probability, 4) AS delay_probability",
        "late_probability > 0.5D AS is_high_risk",
        "CASE WHEN late_probability > 0.5D THEN 'High' WHEN late_probability > 0.3D THEN 'Moderate' ELSE 'Low' END "
        "AS risk_level",
    )


def with_alert(risked: DataFrame) -> DataFrame:
    """The sentence shown for the band (it looks at the rounded probability)."""
    percent = "format_string('%.1f', delay_probability * 100)"
    return risked.selectExpr(
        "*",
        f"CASE WHEN delay_probability > 0.5D THEN concat('High Risk Alert: Predicted delay probability is ', {percent}, "
        "'%. Immediate intervention required.') "
        f"WHEN delay_probability > 0.3D THEN concat('Warning: Moderate risk detected (', {percent}, '%). Monitor closely.') "
        f"ELSE concat('Success: Low risk delivery (', {percent}, '%). On-time arrival expected.') END AS alert",
    )


def with_advanced_flag(requests: DataFrame) -> DataFrame:
    """Whether any advanced input differs from its form default."""
    changed = " OR ".join(f"NOT (`{c}` <=> {v})" for c, v in ADVANCED_DEFAULTS.items())
    return requests.selectExpr("*", f"({changed}) AS is_advanced")


# ---------------------------------------------------------------- risk factors
def feature_baseline(features: DataFrame, columns: Sequence[str] | None = None) -> dict[str, float | str]:
    """What each feature looks like on a typical row: the mean, or the most frequent text."""
    columns = list(columns or feature_columns(features))
    text = [c for c, kind in features.dtypes if c in columns and kind == "string"]
    numbers = [c for c in columns if c not in text]
    found: dict[str, float | str] = {}
    if numbers:
        means = features.agg(*[F.avg(c).alias(c) for c in numbers]).first().asDict()
        found |= {c: float(means[c] or 0.0) for c in numbers}
    if text:
        pairs = ", ".join(f"'{c}', `{c}`" for c in text)
        common = (
            features.selectExpr(f"stack({len(text)}, {pairs}) AS (name, value)")
            .where("value IS NOT NULL")
            .groupBy("name", "value")
            .agg(F.count(F.lit(1)).alias("n"))
            .groupBy("name")
            .agg(F.expr("max_by(value, struct(n, value))").alias("value"))
        )
        found |= {c: "UNKNOWN" for c in text} | {r["name"]: r["value"] for r in common.collect()}
    return found


def top_factors(
    features: DataFrame,
    scorer: Scorer,
    columns: Sequence[str],
    baseline: Mapping[str, float | str],
    key: str = "order_id",
    k: int = 3,
) -> DataFrame:
    """The ``k`` features that move a row's probability most.

    A feature's impact is the probability minus the probability with that feature at its baseline.
    Rows with the same key are ranked each. With a ``ModelScorer`` the variants of a row are never made as rows: a task
    walks again only the trees that split on the feature. Any other scorer scores each row once per feature; the variants
    of a row are produced next to each other and shrink to one array before they are shuffled.
    """

    def literal(c: str) -> str:
        value = baseline[c]
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(value, str) else f"{value!r}D"

    kinds = dict(features.dtypes)
    direction = "CASE WHEN {0} >= 0 THEN 'increasing' ELSE 'decreasing' END AS direction"
    if isinstance(scorer, ModelScorer) and sorted(columns) == sorted(model_columns(scorer.model)):
        usual = features.sparkSession.range(1).selectExpr(*[f"CAST({literal(c)} AS {_wide(kinds[c])}) AS `{c}`" for c in columns])
        found = top_impacts(scorer.model, without_gaps(features.select(key, *columns)), usual, key, k)
        return found.selectExpr(f"`{key}`", "rank", "feature", "round(impact, 4) AS impact", direction.format("impact"))
    names = ", ".join(f"'{c}'" for c in columns)
    rows = features.select(key, *columns).withColumn("_row", F.monotonically_increasing_id())
    scored = scorer(rows).withColumnRenamed("late_probability", "_actual")
    variants = scored.selectExpr(key, "_row", "_actual", f"explode(array({names})) AS _feature", *[f"`{c}`" for c in columns])
    variants = variants.selectExpr(
        key, "_row", "_actual", "_feature",
        *[f"CAST(CASE WHEN _feature = '{c}' THEN {literal(c)} ELSE `{c}` END AS {_wide(kinds[c])}) AS `{c}`" for c in columns],
    )
    impacts = scorer(variants).selectExpr(key, "_row", "_feature", "_actual - late_probability AS _impact")
    ranked = impacts.groupBy(key, "_row").agg(
        F.expr("sort_array(collect_list(struct(-abs(_impact) AS size, _feature AS feature, _impact AS impact)))").alias("_all")
    )
    return ranked.selectExpr(key, f"posexplode(slice(_all, 1, {k})) AS (_pos, _f)").selectExpr(
        key,
        "_pos + 1 AS rank",
        "_f.feature AS feature",
        "round(_f.impact, 4) AS impact",
        direction.format("_f.impact"),
    )


def _wide(kind: str) -> str:
    return "string" if kind == "string" else "double"


# ---------------------------------------------------------------- scenarios
def what_if(
    scored: DataFrame,
    scorer: Scorer,
    columns: Sequence[str],
    thresholds: Mapping[str, float] | None = None,
    scenarios: Mapping[str, Mapping[str, float]] = WHAT_IF,
    strict: bool = False,
) -> DataFrame:
    """Rescore every request under each scenario (fields times a factor); ``delta_points`` compares the
    rounded probabilities in percentage points. ``scored`` comes from ``score_requests``."""
    names = ", ".join(f"'{n}'" for n in scenarios)
    fields = sorted({f for factors in scenarios.values() for f in factors})

    def shifted(f: str) -> str:
        cases = " ".join(f"WHEN '{n}' THEN `{f}` * {float(fs[f])!r}D" for n, fs in scenarios.items() if f in fs)
        return f"CASE scenario {cases} ELSE `{f}` END AS `{f}`"

    base = scored.withColumnRenamed("late_probability", "_base")
    spread = base.selectExpr("*", f"explode(array({names})) AS scenario")
    changed = spread.selectExpr(*[shifted(c) if c in fields else f"`{c}`" for c in spread.columns])
    rescored = score_requests(changed, scorer, columns, thresholds, strict)
    return rescored.selectExpr(
        *[f"`{c}`" for c in scored.columns if c not in ("late_probability", *fields)],
        "scenario",
        "round(_base, 4) AS delay_probability",
        "round(late_probability, 4) AS scenario_probability",
        "(round(late_probability, 4) - round(_base, 4)) * 100 AS delta_points",
    )


def with_presets(requests: DataFrame, presets: Mapping[str, Mapping[str, str]] = PRESETS) -> DataFrame:
    """Every request once per preset, with the preset's fields overridden; a preset that sets the seller's backlog sets
    the seller's intensity to the same number, as the request form does."""
    presets = {
        n: {"seller_intensity_score": fs["seller_state_backlog"], **fs} if "seller_state_backlog" in fs else fs
        for n, fs in presets.items()
    }
    names = ", ".join(f"'{n}'" for n in presets)
    spread = requests.selectExpr("*", f"explode(array({names})) AS preset")

    def overridden(c: str) -> str:
        cases = " ".join(f"WHEN '{n}' THEN {fs[c]}" for n, fs in presets.items() if c in fs)
        return f"CASE preset {cases} ELSE `{c}` END AS `{c}`" if cases else f"`{c}`"

    return spread.selectExpr(*[overridden(c) for c in spread.columns])
