import math

import pytest

from orderlens.plans import features as fe

BASE = {
    "order_id": "test_1", "customer_id": "c1", "customer_state": "SP", "seller_state": "SP", "distance_km": 100.0,
    "lead_time_days_estimated": 10.0, "total_weight_g": 500.0, "total_price": 100.0, "total_freight": 15.0,
    "product_category": "health_beauty", "primary_payment_type": "credit_card",
    "order_purchase_timestamp": "2018-01-01 10:00:00", "seller_state_backlog": 1.0, "customer_state_backlog": 1.0,
    "seller_intensity_score": 1.0, "route_delay_rate": 0.02, "avg_product_volume_cm3": 1000.0,
    "customer_total_orders": 1, "seconds_since_last_seller_order": 3600, "avg_description_length": 500,
    "purchase_month": "1", "purchase_day_of_week": "0", "purchase_hour": "10",
}


@pytest.fixture
def orders(spark):
    def build(*changes):
        rows = [BASE | c for c in (changes or ({},))]
        kinds = {int: "int", float: "double", str: "string"}
        schema = ", ".join(f"{k} {kinds[type(v)]}" for k, v in BASE.items())
        df = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
        return df.withColumn("order_purchase_timestamp", df["order_purchase_timestamp"].cast("timestamp_ntz"))

    return build


def test_new_columns(orders):
    row = fe.build_features(orders()).first()
    assert row["is_holiday"] == 1 and row["is_hub_delivery"] == 1 and row["is_hub_exit"] == 0
    assert row["dist_backlog_ratio"] == pytest.approx(math.log(101) * math.log(2))
    assert row["required_velocity"] == pytest.approx(math.log(101) / 11)
    assert row["freight_per_gram"] == pytest.approx(15 / (math.log(501) + 1))
    assert row["tight_schedule_holiday_risk"] == pytest.approx(math.log(101) / 11)
    assert "customer_id" not in row.asDict() and "order_purchase_timestamp" not in row.asDict()


@pytest.mark.parametrize("day,flag", [("2017-11-24 10:00:00", 1), ("2018-05-01 10:00:00", 0)])
def test_black_friday(orders, day, flag):
    assert fe.build_features(orders({"order_purchase_timestamp": day})).first()["is_black_friday"] == flag


@pytest.mark.parametrize("time,days", [("2018-04-30 14:00:00", 1), ("2018-05-01 14:00:00", 0), ("2018-05-09 00:00:00", 8)])
def test_nearest_holiday(orders, time, days):
    row = fe.build_features(orders({"order_purchase_timestamp": time})).first()
    assert row["days_to_nearest_holiday"] == days and row["is_holiday_season"] == int(days <= 7)


def test_single_row_is_not_capped_without_thresholds(orders):
    assert fe.build_features(orders({"total_price": 1e6})).first()["total_price"] == 1e6


def test_thresholds_passed_in_win_per_column(orders):
    df = orders({"total_price": 10.0}, {"total_price": 1000.0, "total_freight": 99.0})
    out = fe.build_features(df, {"total_price": 500.0}).orderBy("total_price").collect()
    assert [r["total_price"] for r in out] == [10.0, 500.0]
    assert out[1]["total_freight"] == pytest.approx(15 + 0.995 * (99 - 15))  # fitted on these two rows


def test_zero_divisor_and_missing_values(orders):
    row = fe.build_features(orders({"lead_time_days_estimated": -1.0})).first()
    assert row["required_velocity"] == 0.0 and row["tight_schedule_holiday_risk"] is None
    empty = orders().selectExpr(*[f"CAST(NULL AS {k}) AS {c}" if c in ("product_category", "distance_km", "total_price")
                                  else c for c, k in orders().dtypes])
    row = fe.build_features(empty).first()
    assert row["product_category"] == "UNKNOWN" and row["distance_km"] == 0.0 and row["total_price"] == 0.0


def test_missing_inputs_are_named(orders):
    with pytest.raises(ValueError, match="distance_km"):
        fe.prepare(orders().drop("distance_km"))


def test_optional_columns_may_be_absent(orders):
    out = fe.build_features(orders().drop("route_delay_rate", "seller_intensity_score", "customer_state"))
    assert "route_risk_score" not in out.columns and "is_hub_exit" not in out.columns
