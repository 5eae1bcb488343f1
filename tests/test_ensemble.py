import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from orderlens.plans import ensemble
from orderlens.plans import modeling as md
from orderlens.plans import scoring as sc


@pytest.fixture(scope="module")
def rows(spark):
    late = "10 + 40 * CAST(id % 3 = 0 AS int) + 30 * CAST(id % 11 > 6 AS int)"
    return spark.range(1500).selectExpr(
        "CAST(id AS string) AS order_id", f"CAST(pmod(xxhash64(id), 100) < {late} AS int) AS is_late", "concat('c', id % 12) AS product_category",
        "CAST(id % 11 AS double) AS total_price", "CAST(pmod(hash(id), 17) AS double) AS distance_km",
    )


@pytest.fixture(scope="module")
def model(rows):
    return md.fit_trees(rows, md.TreeSettings(rounds=6, depth=4, learning_rate=0.3))


def _probabilities(model, df):
    scored = model.transform(md.without_gaps(df)).withColumn("p", vector_to_array("probability")[1])
    return {r["order_id"]: r["p"] for r in scored.select("order_id", "p").collect()}


def test_node_table_holds_every_node(model):
    trees = model.stages[-1].trees
    nodes = ensemble.node_table(model.stages[-1])
    assert nodes.groupBy("tree").count().count() == 6
    assert {r["tree"]: r["count"] for r in nodes.groupBy("tree").count().collect()} == {i: t.numNodes for i, t in enumerate(trees)}
    assert nodes.where("feature IS NULL AND (left IS NOT NULL OR threshold IS NOT NULL)").isEmpty()
    assert not nodes.where("categories IS NOT NULL").isEmpty() and not nodes.where("threshold IS NOT NULL").isEmpty()


@pytest.mark.parametrize("rounds", [1, 3, 6, 9])
def test_first_trees_score_like_the_curve(rows, model, rounds, tmp_path):
    cut = ensemble.first_trees(model, rounds)
    assert cut.stages[-1].getNumTrees == min(rounds, 6)
    scored = md.predict(cut, rows, ["order_id", "is_late"]).withColumn("g", F.lit(0))
    expected = md.decision_metrics(scored).first().asDict()
    row = {r["round"]: r for r in ensemble.round_curve(model, rows, "is_late").collect()}[min(rounds, 6)]
    assert {k: row[k] for k in expected} == pytest.approx(expected)
    assert row["rows"] == 1500
    assert row["pr_auc"] == pytest.approx(md.average_precision(scored, "g").first()["pr_auc"], abs=2e-3)
    cut.write().overwrite().save(str(tmp_path / "m"))
    assert _probabilities(md.load_model([str(tmp_path / "m")]), rows) == _probabilities(cut, rows)


def test_fewer_rounds_need_no_second_fit(rows, model):
    """The first trees of a longer fit are the trees of a shorter one."""
    short = md.fit_trees(rows, md.TreeSettings(rounds=2, depth=4, learning_rate=0.3))
    assert _probabilities(short, rows) == pytest.approx(_probabilities(ensemble.first_trees(model, 2), rows))


def test_early_stopping_keeps_the_best_round(rows):
    train, held_out = rows.where("CAST(order_id AS int) % 3 > 0"), rows.where("CAST(order_id AS int) % 3 = 0")
    settings = md.TreeSettings(rounds=8, depth=3, learning_rate=0.5)
    curve = ensemble.round_curve(md.fit_trees(train, settings), held_out, "is_late").orderBy("round").collect()
    kept = md.fit_with_early_stopping(train, held_out, settings, patience=3)
    assert kept.stages[-1].getNumTrees == md.best_round([-r["f1"] for r in curve], 3)
    best = md.decision_metrics(md.predict(kept, held_out, ["order_id", "is_late"])).first()["f1"]
    assert best == pytest.approx(curve[kept.stages[-1].getNumTrees - 1]["f1"])


def test_contributions_add_up_to_the_log_odds(rows, model):
    unseen = rows.limit(5).withColumns({"product_category": F.lit("elsewhere"), "order_id": F.concat(F.lit("u"), "order_id")})
    every = rows.unionByName(unseen)
    p = _probabilities(model, every)
    found = ensemble.contributions(model, every, ["order_id"]).collect()
    assert len(found) == 1505
    for r in found:
        assert r["base"] + sum(x["contribution"] for x in r["parts"]) == pytest.approx(r["log_odds"])
        assert r["log_odds"] == pytest.approx(math.log(p[r["order_id"]] / (1 - p[r["order_id"]])))
    assert [x["feature"] for x in found[0]["parts"]] == md.feature_columns(rows)


def test_contributions_follow_the_paths(spark):
    """One tree with one split: the whole step belongs to its feature."""
    df = spark.createDataFrame([(str(i), int(i % 4 == 0), float(i % 4 == 0), 1.0) for i in range(80)], "order_id string, is_late int, a double, b double")
    model = md.fit_trees(df, md.TreeSettings(rounds=1, depth=1))
    for r in ensemble.contributions(model, df, ["order_id"]).collect():
        parts = {x["feature"]: x["contribution"] for x in r["parts"]}
        assert parts["b"] == 0 and parts["a"] == pytest.approx(r["log_odds"] - r["base"])
    top = ensemble.top_contributions(model, df, "order_id", 1).collect()
    assert {(r["feature"], r["rank"]) for r in top} == {("a", 1)}
    assert {r["direction"] for r in top if int(r["order_id"]) % 4 == 0} == {"increasing"}


def test_an_empty_table(rows, model):
    assert ensemble.round_curve(model, rows.limit(0), "is_late").collect() == []
    assert ensemble.contributions(model, rows.limit(0), ["order_id"]).collect() == []
    assert np.isfinite(ensemble.forest_of(model).value).all()


def test_impacts_of_a_model_make_no_rows_of_variants(rows, model):
    """The same factors as scoring every variant, with ties by name, copies of a key, gaps and an unseen baseline."""
    some = rows.limit(60)
    gap = some.limit(2).selectExpr("order_id", "is_late", "'elsewhere' AS product_category", "CAST(NULL AS double) AS total_price", "distance_km")
    some = some.unionByName(gap).drop("is_late")
    columns, baseline = sc.model_columns(model), {"product_category": "it's new", "total_price": 4.5, "distance_km": 8.0}
    scorer = sc.model_scorer(model)
    fast = sc.top_factors(some, scorer, columns, baseline)
    plain = sc.top_factors(some, lambda df: scorer(df), columns, baseline)
    assert fast.dtypes == plain.dtypes
    found = sorted(map(tuple, fast.collect()))
    assert found == sorted(map(tuple, plain.collect())) and len(found) == 3 * 62
    plan = fast._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Aggregate" not in plan


def test_features_as_an_array_are_those_of_the_vector_without_making_it(spark, model):
    odd = spark.createDataFrame(
        [("a", "c1", 1.5, -0.0), ("b", "c99", None, 3.0), ("c", None, float("nan"), 0.0)], "order_id string, product_category string, total_price double, distance_km double"
    )
    ready = ensemble._ready(model, odd, ["order_id"])
    vectors = model.stages[1].transform(model.stages[0].transform(odd)).select("order_id", vector_to_array("features").alias("x"))
    expected = {r["order_id"]: r["x"] for r in vectors.collect()}
    for r in ready.collect():
        np.testing.assert_array_equal(r["_x"], expected[r["order_id"]])
    assert "struct(" not in ready._jdf.queryExecution().optimizedPlan().toString()
