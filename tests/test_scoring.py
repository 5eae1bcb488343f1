import pytest
from pyspark.sql import functions as F

from orderlens.plans import scoring as sc
from orderlens.streaming import scoring as stream

GOOD = {
    "distance_km": "150.0", "lead_time_days_estimated": "10.0", "total_weight_g": "350.0", "total_price": "49.90",
    "total_freight": "12.00", "customer_state": "SP", "seller_state": "SP",
    "order_purchase_timestamp": "2018-06-01 12:00:00",
}
COLUMNS = ["distance_km", "required_velocity", "purchase_month", "max_installments"]


def scorer(df):
    return df.withColumn("late_probability", F.expr("distance_km / 20 + required_velocity / 10"))


@pytest.fixture
def requests(spark):
    def build(*rows):
        names = ["id", *sc.REQUEST_FIELDS]
        schema = ", ".join(f"{n} string" for n in names)
        return spark.createDataFrame([tuple(({"id": str(i)} | r).get(n) for n in names) for i, r in enumerate(rows)], schema)

    return build


def test_defaults_and_rejections(requests):
    checked = sc.checked_requests(requests(GOOD, {"distance_km": "150.0"}, GOOD | {"total_items": "many"}))
    good = sc.valid_requests(checked).collect()
    assert [r["id"] for r in good] == ["0"]
    assert good[0]["seller_avg_review_score"] == 4.0 and good[0]["primary_payment_type"] == "credit_card"
    bad = {r["id"]: r["reasons"] for r in sc.rejected_requests(checked).collect()}
    assert "missing customer_state" in bad["1"] and len(bad["1"]) == 7
    assert bad["2"] == ["not a int: total_items"]


def test_fields_may_be_absent_as_columns(spark):
    df = spark.createDataFrame([tuple(GOOD.values())], ", ".join(f"{k} string" for k in GOOD))
    assert sc.valid_requests(sc.checked_requests(df)).first()["route_delay_rate"] == 0.02


def test_score_keeps_the_request_and_aligns_columns(requests):
    valid = sc.valid_requests(sc.checked_requests(requests(GOOD)))
    scored = sc.score_requests(valid, scorer, COLUMNS).first()
    assert scored["id"] == "0" and scored["distance_km"] == 150.0 and 0 < scored["late_probability"] < 1
    ready = sc.aligned(sc.request_features(valid, {}, strict=True), COLUMNS).first()
    assert ready["purchase_month"] == "0.0" and ready["max_installments"] == 0.0
    assert sc.aligned(sc.request_features(valid, {}), COLUMNS).first()["purchase_month"] == "6"


def test_bands_are_strict(spark):
    df = spark.createDataFrame([(0.3,), (0.30001,), (0.5,), (0.50001,)], "late_probability double")
    out = sc.with_risk(df).collect()
    assert [r["risk_level"] for r in out] == ["Low", "Moderate", "Moderate", "High"]
    assert [r["is_high_risk"] for r in out] == [False, False, False, True]


def test_alert_text(spark):
    df = sc.with_alert(sc.with_risk(spark.createDataFrame([(0.71,), (0.4,), (0.05,)], "late_probability double")))
    assert [r["alert"] for r in df.collect()] == [
        "High Risk Alert: Predicted delay probability is 71.0%. Immediate intervention required.",
        "Warning: Moderate risk detected (40.0%). Monitor closely.",
        "Success: Low risk delivery (5.0%). On-time arrival expected.",
    ]


def test_top_factors_come_in_order_of_impact(requests):
    ready = sc.aligned(sc.request_features(sc.valid_requests(sc.checked_requests(requests(GOOD, GOOD))), {}), COLUMNS, ["id"])
    out = sc.top_factors(ready, scorer, COLUMNS, {"distance_km": 9.0, "required_velocity": 0.0, "purchase_month": "1",
                                                  "max_installments": 0.0}, key="id", k=2)
    rows = out.where("id = '1'").orderBy("rank").collect()
    assert [r["feature"] for r in rows] == ["distance_km", "required_velocity"]
    assert [r["direction"] for r in rows] == ["decreasing", "increasing"]


def test_baseline_is_mean_and_most_frequent(spark):
    df = spark.createDataFrame([(1.0, "a"), (3.0, "b"), (None, "b"), (2.0, None)], "n double, t string")
    assert sc.feature_baseline(df) == {"n": 2.0, "t": "b"}


def test_what_if_and_presets(requests):
    valid = sc.valid_requests(sc.checked_requests(requests(GOOD)))
    scored = sc.score_requests(valid, scorer, COLUMNS)
    out = {r["scenario"]: r for r in sc.what_if(scored, scorer, COLUMNS).collect()}
    assert set(out) == {"Distance +10%", "Lead Time -10%"}
    assert out["Distance +10%"]["delta_points"] > 0 and out["Lead Time -10%"]["delta_points"] > 0
    presets = {r["preset"]: r for r in sc.with_presets(valid).collect()}
    assert presets["Long Distance"]["customer_state"] == "RN" and presets["Long Distance"]["distance_km"] == 2500.0
    assert presets["Holiday Rush"]["distance_km"] == 150.0 and presets["Holiday Rush"]["seller_state_backlog"] == 4.5


def test_stream_scores_like_a_batch(spark, requests, tmp_path):
    raw = requests(*[GOOD | {"distance_km": str(10.0 * i)} for i in range(1, 21)], {"distance_km": "1"})
    raw.repartition(4).write.parquet(str(tmp_path / "in"))
    incoming = stream.request_stream(spark, str(tmp_path / "in"), raw.schema, files_per_batch=1)
    good = stream.scored_stream(incoming, scorer, COLUMNS, {"total_price": 10.0})
    stream.start(good, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    stream.start(good, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()  # nothing twice
    stream.start(stream.rejected_stream(incoming), str(tmp_path / "bad"), str(tmp_path / "cp2")).awaitTermination()
    valid = sc.valid_requests(sc.checked_requests(raw))
    batch = sc.with_risk(sc.score_requests(valid, scorer, COLUMNS, {"total_price": 10.0}))
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == sorted(map(tuple, batch.collect()))
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 1


def test_streamed_requests_keep_all_cores_busy(spark, sf):
    from checks import queries_scoring as qs

    raw = qs.raw_requests(spark, sf)
    scored, rejected = qs._streamed(spark, raw, qs.formula_scorer, qs.COLUMNS, qs.CAPS)
    home = scored.inputFiles()[0].rsplit("/scored/", 1)[0]
    assert len(spark.read.parquet(f"{home}/requests").inputFiles()) >= 2 * spark.sparkContext.defaultParallelism
    assert scored.count() + rejected.count() == raw.count()
