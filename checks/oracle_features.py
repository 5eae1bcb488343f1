"""Oracle expressions for the feature step."""

from __future__ import annotations

from checks.oracle_tables import define

BLACK = "(DATE '2016-11-25', DATE '2017-11-24')"
# Holiday dates.
DAYS = (
    "2016-12-25", "2017-01-01", "2017-04-14", "2017-04-21", "2017-05-01", "2017-09-07", "2017-10-12", "2017-11-02",
    "2017-11-15", "2017-12-25", "2018-01-01", "2018-03-30", "2018-04-21", "2018-05-01", "2018-09-07",
)
HOLIDAY_LIST = ", ".join(f"DATE '{d}'" for d in DAYS)
NEAREST = "least(" + ", ".join(
    f"abs(date_diff('day', DATE '{d}', order_purchase_timestamp::DATE))" for d in DAYS
) + ")"
_CATEGORICALS = (
    "customer_state", "seller_state", "product_category", "primary_payment_type", "purchase_month",
    "purchase_day_of_week", "purchase_hour",
)
_LOGGED = (
    "distance_km", "total_weight_g", "avg_product_volume_cm3", "seller_state_backlog", "customer_state_backlog",
    "customer_total_orders", "seconds_since_last_seller_order", "seller_intensity_score", "avg_description_length",
)
CAPPED = ("total_price", "total_freight", "freight_ratio", "total_payment", "dist_backlog_ratio", "required_velocity")

_REPLACED = ", ".join(
    [f"coalesce(nullif(CAST({c} AS VARCHAR), ''), 'UNKNOWN') AS {c}" for c in _CATEGORICALS]
    + [f"ln(1 + coalesce({c}, 0)::DOUBLE) AS {c}" for c in _LOGGED]
)
define(
    "logged",
    f"""SELECT * EXCLUDE (customer_id, customer_city, seller_city) REPLACE ({_REPLACED}),
           CAST(order_purchase_timestamp::DATE IN {BLACK} AS INTEGER) AS is_black_friday,
           CAST(order_purchase_timestamp::DATE IN ({HOLIDAY_LIST}) AS INTEGER) AS is_holiday,
           CAST({NEAREST} AS INTEGER) AS days_to_nearest_holiday
       FROM analytical""",
    "analytical",
)
define(
    "uncapped",
    """SELECT * EXCLUDE (order_purchase_timestamp)
           REPLACE (coalesce(freight_ratio, 0) AS freight_ratio, coalesce(total_payment, 0) AS total_payment),
           coalesce(distance_km * seller_state_backlog, 0) AS dist_backlog_ratio,
           total_freight / (total_weight_g + 1) AS freight_per_gram,
           coalesce(distance_km / nullif(lead_time_days_estimated + 1, 0), 0) AS required_velocity,
           seller_shipping_buffer_days / nullif(lead_time_days_estimated + 1, 0) AS buffer_to_lead_ratio,
           route_delay_rate * distance_km AS route_risk_score,
           CAST(seller_state = 'SP' AND customer_state = 'SP' AS INTEGER) AS is_hub_delivery,
           CAST(seller_state = 'SP' AND customer_state <> 'SP' AS INTEGER) AS is_hub_exit,
           seller_intensity_score - seller_state_backlog AS seller_stress_ratio,
           CAST(days_to_nearest_holiday <= 7 AS INTEGER) AS is_holiday_season,
           distance_km / nullif(lead_time_days_estimated + 1, 0) * is_holiday AS tight_schedule_holiday_risk
       FROM logged""",
    "logged",
)
define(
    "caps",
    "SELECT " + ", ".join(f"quantile_cont({c}, 0.995) AS cap_{c}" for c in CAPPED) + " FROM uncapped",
    "uncapped",
)
define(
    "features",
    "SELECT u.* REPLACE ("
    + ", ".join(f"least(u.{c}, cap_{c}) AS {c}" for c in CAPPED)
    + ") FROM uncapped u, caps",
    "uncapped",
    "caps",
)
_FEATURE_DOUBLES = _LOGGED + CAPPED + (
    "avg_product_photos", "seller_historical_delay_rate", "seller_avg_review_score", "seller_recent_delay_rate",
    "route_delay_rate", "freight_per_gram", "buffer_to_lead_ratio", "route_risk_score", "seller_stress_ratio",
    "tight_schedule_holiday_risk",
)
ROUNDED_FEATURES = "* REPLACE (" + ", ".join(
    f"round({c}, {2 if c in ('total_price', 'total_freight', 'total_payment') else 6}) AS {c}" for c in _FEATURE_DOUBLES
) + ")"
