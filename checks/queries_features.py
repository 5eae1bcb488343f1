"""Feature engineering, step by step and as a whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.oracle_features import CAPPED, NEAREST, ROUNDED_FEATURES
from checks.registry import register, rounded
from orderlens.plans import features as fe
from orderlens.plans.dataset import analytical_dataset
from orderlens.sources.marketplace import marketplace_from_star
from orderlens.sources.staging import staged_alone

TS = "order_purchase_timestamp"
MONEY = {"total_price": 2, "total_freight": 2, "total_payment": 2}


def dataset(spark, folder, columns=None):
    """The dataset as the feature step finds it: stored, then read."""
    return staged_alone(spark, lambda: analytical_dataset(marketplace_from_star(spark, folder), columns), "analytical")


def plain(spark, folder, *columns):
    return analytical_dataset(marketplace_from_star(spark, folder), ["order_id", *columns])


@register("e01_black_friday", "SELECT order_id, is_black_friday FROM logged", "logged")
def _(spark, folder):
    return fe.with_calendar(plain(spark, folder, TS)).select("order_id", "is_black_friday")


@register("e02_holiday", "SELECT order_id, is_holiday FROM logged", "logged")
def _(spark, folder):
    return fe.with_calendar(plain(spark, folder, TS)).select("order_id", "is_holiday")


@register("e03_drop_columns", "SELECT order_id, customer_state FROM plain_dataset", "plain_dataset")
def _(spark, folder):
    return fe.drop_unused(plain(spark, folder, "customer_id", "customer_city", "seller_city", TS, "customer_state"))


@register(
    "e04_categorical_fill",
    "SELECT order_id, product_category, primary_payment_type, purchase_month, purchase_hour FROM logged",
    "logged",
)
def _(spark, folder):
    return fe.fill_categoricals(
        plain(spark, folder, "product_category", "primary_payment_type", "purchase_month", "purchase_hour")
    )


@register(
    "e05_log_scale",
    """SELECT order_id, round(distance_km, 6) AS distance_km, round(total_weight_g, 6) AS total_weight_g,
           round(avg_product_volume_cm3, 6) AS avg_product_volume_cm3,
           round(avg_description_length, 6) AS avg_description_length FROM logged""",
    "logged",
)
def _(spark, folder):
    columns = ("distance_km", "total_weight_g", "avg_product_volume_cm3", "avg_description_length")
    return rounded(fe.log_scale(plain(spark, folder, *columns)))


def _prepared(spark, folder, *columns):
    inputs = dict.fromkeys(["order_id", *fe.REQUIRED, *columns])
    return fe.prepare(analytical_dataset(marketplace_from_star(spark, folder), list(inputs)))


def _register_prepared(name: str, columns: tuple[str, ...], *inputs: str) -> None:
    """``inputs`` are the dataset columns the step needs beyond the required ones."""
    whole = ("is_", "days_to_nearest_holiday")
    listed = ", ".join(c if c.startswith(whole) else f"round({c}, 6) AS {c}" for c in columns)

    @register(name, f"SELECT order_id, {listed} FROM uncapped", "uncapped")
    def _(spark, folder):
        return rounded(_prepared(spark, folder, *inputs).select("order_id", *columns))


_register_prepared("e06_distance_times_backlog", ("dist_backlog_ratio",))
_register_prepared("e07_freight_per_gram", ("freight_per_gram",))
_register_prepared("e08_required_velocity", ("required_velocity",))
_register_prepared("e09_buffer_ratio", ("buffer_to_lead_ratio",), "seller_shipping_buffer_days")
_register_prepared("e10_route_risk", ("route_risk_score",), "route_delay_rate")
_register_prepared("e11_hub_flags", ("is_hub_delivery", "is_hub_exit"), "seller_state", "customer_state")
_register_prepared("e12_seller_stress", ("seller_stress_ratio",), "seller_intensity_score")
_register_prepared("e15_tight_holiday_risk", ("tight_schedule_holiday_risk",))
_register_prepared(
    "e16_cleaned_columns", ("freight_ratio", "dist_backlog_ratio", "required_velocity", "total_payment"),
    "freight_ratio", "total_payment",
)
_FILLED = ("seller_historical_delay_rate", "seller_avg_review_score", "route_delay_rate", "avg_product_photos")
_register_prepared("e19_filled_numbers", (*_FILLED, "is_late"), *_FILLED, "is_late")


@register(
    "e13_nearest_holiday",
    f"SELECT order_id, CAST({NEAREST} AS INTEGER) AS days FROM plain_dataset",
    "plain_dataset",
)
def _(spark, folder):
    return fe.with_calendar(plain(spark, folder, TS)).selectExpr("order_id", "_holiday_distance AS days")


@register("e14_holiday_season", "SELECT order_id, is_holiday_season FROM uncapped", "uncapped")
def _(spark, folder):
    return fe.prepare(dataset(spark, folder)).select("order_id", "is_holiday_season")


_CAPS = " UNION ALL ".join(f"SELECT '{c}' AS column_name, round(cap_{c}, 4) AS threshold FROM caps" for c in CAPPED)


@register("e17_fitted_thresholds", _CAPS, "caps")
def _(spark, folder):
    found = fe.fit_thresholds(_prepared(spark, folder, "total_price", "freight_ratio", "total_payment"))
    return spark.createDataFrame([(k, round(v, 4)) for k, v in found.items()], "column_name string, threshold double")


@register(
    "e18_stored_thresholds",
    """SELECT order_id, round(least(total_price, 150000.0), 2) AS total_price,
           round(least(required_velocity, 0.25), 6) AS required_velocity FROM uncapped""",
    "uncapped",
)
def _(spark, folder):
    capped = fe.cap(_prepared(spark, folder, "total_price"), {"total_price": 150000.0, "required_velocity": 0.25, "unused": 1.0})
    return rounded(capped.select("order_id", "total_price", "required_velocity"), **MONEY)


@register("e20_present_categoricals", "SELECT unnest(['customer_state', 'purchase_hour']) AS name, "
          "(SELECT count(*) FROM plain_dataset) AS rows", "plain_dataset")
def _(spark, folder):
    df = plain(spark, folder, "purchase_hour", "customer_state", "is_late")
    names = ", ".join(f"'{c}'" for c in fe.present_categoricals(df))
    return df.agg(F.count(F.lit(1)).alias("rows")).selectExpr(f"explode(array({names})) AS name", "rows")


@register("e_features", f"SELECT {ROUNDED_FEATURES} FROM features", "features")
def _(spark, folder):
    return rounded(fe.build_features(dataset(spark, folder)), **MONEY)
