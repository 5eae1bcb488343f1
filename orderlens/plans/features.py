"""Model features from the analytical dataset.

``prepare`` derives everything up to, but without, the outlier caps. ``fit_thresholds`` finds the caps
and ``build_features`` puts both together. Steps whose columns are missing are left out, so the same
code serves full datasets and single scoring requests.

A lead time of -1 makes a division by zero; the result is NULL here and becomes 0 in capped columns.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.calendar import BLACK_FRIDAYS, HOLIDAYS, days_to_nearest, is_one_of
from orderlens.operators.distribution import column_quantiles
from orderlens.sources.staging import is_staged, staged

TS = "order_purchase_timestamp"
HUB = "SP"
CAP_LEVEL = 0.995

# The column roles of the feature step.
CATEGORICALS = (
    "customer_state",
    "seller_state",
    "product_category",
    "primary_payment_type",
    "purchase_month",
    "purchase_day_of_week",
    "purchase_hour",
)
DROPPED = (
    "customer_id",
    "customer_city",
    "seller_city",
    "order_purchase_timestamp",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
    "max_shipping_limit_date",
)
LOGGED = (
    "distance_km",
    "total_weight_g",
    "avg_product_volume_cm3",
    "seller_state_backlog",
    "customer_state_backlog",
    "customer_total_orders",
    "seconds_since_last_seller_order",
    "seller_intensity_score",
    "avg_description_length",
)
CAPPED = (
    "total_price",
    "total_freight",
    "freight_ratio",
    "total_payment",
    "dist_backlog_ratio",
    "required_velocity",
)
HISTORY_RATES = ("seller_historical_delay_rate", "seller_avg_review_score", "route_delay_rate")
ZERO_FILLED = ("avg_product_photos", "shipping_limit_spread")
REQUIRED = (
    "distance_km",
    "seller_state_backlog",
    "total_freight",
    "total_weight_g",
    "lead_time_days_estimated",
    "order_purchase_timestamp",
)


def present_categoricals(df: DataFrame) -> list[str]:
    return [c for c in CATEGORICALS if c in df.columns]


def with_calendar(df: DataFrame) -> DataFrame:
    """Black Friday and holiday flags and the distance to the nearest holiday."""
    return df.withColumns(
        {
            "is_black_friday": is_one_of(TS, BLACK_FRIDAYS),
            "is_holiday": is_one_of(TS, HOLIDAYS),
            "_holiday_distance": days_to_nearest(TS, HOLIDAYS),
        }
    )


def drop_unused(df: DataFrame) -> DataFrame:
    return df.drop(*DROPPED)


def _replace(df: DataFrame, expressions: Mapping[str, str]) -> DataFrame:
    """Overwrite or append columns from SQL expressions that all see the columns as they are now."""
    old = [f"{expressions[c]} AS `{c}`" if c in expressions else f"`{c}`" for c in df.columns]
    new = [f"{e} AS `{c}`" for c, e in expressions.items() if c not in df.columns]
    return df.selectExpr(*old, *new)


def fill_categoricals(df: DataFrame) -> DataFrame:
    return _replace(
        df, {c: f"coalesce(nullif(CAST(`{c}` AS string), ''), 'UNKNOWN')" for c in present_categoricals(df)}
    )


def log_scale(df: DataFrame) -> DataFrame:
    """log(1 + x) in place, unknown values as 0."""
    return _replace(df, {c: f"log1p(coalesce(CAST(`{c}` AS double), 0D))" for c in LOGGED if c in df.columns})


def with_interactions(df: DataFrame, hub: str = HUB) -> DataFrame:
    """Products and ratios of logged columns; expects the calendar columns."""
    has = set(df.columns)
    lead = "(lead_time_days_estimated + 1)"
    new = {
        "dist_backlog_ratio": "distance_km * seller_state_backlog",
        "freight_per_gram": "try_divide(CAST(total_freight AS double), total_weight_g + 1)",
        "required_velocity": f"try_divide(distance_km, {lead})",
    }
    if "seller_shipping_buffer_days" in has:
        buffer = "coalesce(seller_shipping_buffer_days, 0)"
        new["seller_shipping_buffer_days"] = buffer
        new["buffer_to_lead_ratio"] = f"try_divide(CAST({buffer} AS double), {lead})"
    if "route_delay_rate" in has:
        rate = "CAST(coalesce(route_delay_rate, 0) AS double)"
        new["route_delay_rate"] = rate
        new["route_risk_score"] = f"{rate} * distance_km"
    if {"seller_state", "customer_state"} <= has:
        new["is_hub_delivery"] = f"CAST(seller_state = '{hub}' AND customer_state = '{hub}' AS int)"
        new["is_hub_exit"] = f"CAST(seller_state = '{hub}' AND customer_state <> '{hub}' AS int)"
    if "seller_intensity_score" in has:
        new["seller_stress_ratio"] = "seller_intensity_score - seller_state_backlog"
    new["days_to_nearest_holiday"] = "_holiday_distance"
    new["is_holiday_season"] = "CASE WHEN _holiday_distance <= 7 THEN 1 ELSE 0 END"
    new["tight_schedule_holiday_risk"] = f"try_divide(distance_km, {lead}) * is_holiday"
    return _replace(df, new).drop("_holiday_distance")


def clean_capped(df: DataFrame) -> DataFrame:
    """NULL, NaN and infinite values of the capped columns become 0."""
    finite = "CASE WHEN abs({0}) < double('Infinity') THEN {0} ELSE 0D END"
    return _replace(df, {c: finite.format(f"CAST(`{c}` AS double)") for c in CAPPED if c in df.columns})


def fill_numbers(df: DataFrame) -> DataFrame:
    """Target as int, missing histories and listing qualities as 0."""
    new = {}
    if "is_late" in df.columns:
        new["is_late"] = "CAST(is_late AS int)"
    new |= {c: f"CAST(coalesce(`{c}`, 0) AS double)" for c in HISTORY_RATES if c in df.columns}
    new |= {c: f"coalesce(`{c}`, 0)" for c in ZERO_FILLED if c in df.columns}
    return _replace(df, new)


def prepare(df: DataFrame, hub: str = HUB) -> DataFrame:
    """All features, not yet capped."""
    missing = [c for c in REQUIRED if c not in df.columns]
    if missing:
        raise ValueError(f"features need the columns {missing}")
    df = fill_categoricals(drop_unused(with_calendar(df)))
    return fill_numbers(clean_capped(with_interactions(log_scale(df), hub)))


def fit_thresholds(prepared: DataFrame, stored: bool = False) -> dict[str, float]:
    """The 99.5 % value of each capped column; empty for fewer than two rows.

    The result is one number per column (six at most), so it is plain Python. The columns are read a few times: they are
    staged, unless ``prepared`` is a staged table or, as ``stored`` says, made row by row from one.
    """
    columns = [c for c in CAPPED if c in prepared.columns]
    values = prepared.select(*columns)
    if columns and not (stored or is_staged(prepared)):
        values = staged(values, "values")
    found = column_quantiles(values, columns, CAP_LEVEL)
    return {c: value for c, (_, value) in found.items()} if any(n > 1 for n, _ in found.values()) else {}


def cap(prepared: DataFrame, thresholds: Mapping[str, float]) -> DataFrame:
    """Values above a column's threshold become the threshold."""
    return _replace(
        prepared,
        {c: f"least(`{c}`, {float(thresholds[c])!r}D)" for c in CAPPED if c in prepared.columns and c in thresholds},
    )


def build_features(
    df: DataFrame,
    thresholds: Mapping[str, float] | None = None,
    hub: str = HUB,
) -> DataFrame:
    """Capped features. Thresholds passed in win, column by column; the others are fitted on ``df``."""
    prepared = prepare(df, hub)
    known = dict(thresholds or {})
    if any(c in prepared.columns and c not in known for c in CAPPED):
        known = fit_thresholds(prepared, is_staged(df)) | known
    return cap(prepared, known)
