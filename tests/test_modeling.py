import pytest
from pyspark.sql import functions as F

from orderlens.operators.ordered import SkewPolicy
from orderlens.plans import modeling as md


def _scored(spark, pairs):
    return spark.createDataFrame([(0, y, p) for y, p in pairs], "g int, is_late int, late_probability double")


@pytest.mark.parametrize("policy", [SkewPolicy(), SkewPolicy(2, 1.0, points_per_cut=1)], ids=["plain", "cut"])
def test_average_precision_with_ties(spark, policy):
    pairs = [(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.4), (1, 0.3), (0, 0.1)]
    # steps: 1/1 at recall 1/3, 2/3 at 2/3 (tied pair), 3/5 at 1
    expected = 1 / 3 * 1 + 1 / 3 * 2 / 3 + 1 / 3 * 3 / 5
    assert md.average_precision(_scored(spark, pairs), "g", policy).first()["pr_auc"] == pytest.approx(expected)


def test_metrics_where_nothing_is_predicted(spark):
    row = md.decision_metrics(_scored(spark, [(1, 0.5), (0, 0.2)])).first()
    assert (row["f1"], row["precision"], row["recall"]) == (0.0, 0.0, 0.0)
    row = md.decision_metrics(_scored(spark, [(1, 0.6), (0, 0.7), (1, 0.1)])).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.5, 0.5, 0.5)


def _labelled(spark, n=1003):
    return spark.range(n).selectExpr("CAST(id AS string) AS order_id", "CAST(id % 11 = 0 AS int) AS is_late")


def test_folds_are_even_in_each_class(spark):
    folds = md.with_folds(_labelled(spark), 5)
    for label in (0, 1):
        sizes = [r["count"] for r in folds.where(f"is_late = {label}").groupBy("_fold").count().collect()]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    again = md.with_folds(_labelled(spark).repartition(3), 5)
    assert sorted(map(tuple, folds.collect())) == sorted(map(tuple, again.collect()))


def test_sample_has_the_exact_size(spark):
    df = _labelled(spark)
    assert md.sample_rows(df, 0.25).count() == 251
    assert md.sample_rows(df, 1.0) is df


@pytest.mark.parametrize("losses,patience,rounds", [
    ([5, 4, 3, 4, 5, 6], 2, 3), ([5, 4, 3, 4, 2, 6], 2, 5), ([5, 4, 3, 4, 4.5, 2], 2, 3), ([1], 5, 1), ([3, 2, 1], 9, 3),
])
def test_best_round(losses, patience, rounds):
    assert md.best_round(losses, patience) == rounds


def test_class_weights(spark):
    df = md.with_balanced_weights(_labelled(spark, 110)).groupBy("is_late").avg("_weight").collect()
    assert {r[0]: r[1] for r in df} == {0: 1.0, 1: 10.0}


def test_search_settings_depend_on_earlier_trials_only():
    space = md.SearchSpace()
    assert space.draw(3) == space.draw(3) != space.draw(4)
    done = [{"trial": i, "pr_auc": 1 / (1 + abs(s.depth - 6)), **md.asdict(s)} for i, s in ((i, space.draw(i)) for i in range(14))]
    assert space.draw(12, done) == space.draw(12, done[:12]) != space.draw(12)
    s = space.draw(11)
    assert 200 <= s.rounds <= 1000 and 4 <= s.depth <= 10 and 0.01 <= s.learning_rate <= 0.3 and 1 <= s.min_rows <= 50


def test_search_goes_on_where_it_stopped(spark, tmp_path):
    tried = []

    def score(df, settings):
        tried.append(settings)
        return 1.0 / settings.depth

    path = str(tmp_path / "trials")
    md.search(_labelled(spark, 10), path, 2, score=score)
    table = md.search(_labelled(spark, 10), path, 4, score=score)
    assert len(tried) == 4 and table.count() == 4
    assert md.best_trial(table).first()["depth"] == min(s.depth for s in tried)


def test_train_save_and_choose(spark, tmp_path):
    df = spark.range(400).selectExpr(
        "CAST(id AS string) AS order_id", "CAST(id % 5 = 0 AS int) AS is_late",
        "CASE WHEN id % 5 = 0 THEN 'far' ELSE 'near' END AS product_category", "CAST(id % 7 AS double) AS total_price",
        "CAST(NULL AS double) AS buffer_to_lead_ratio",
    )
    settings = md.TreeSettings(rounds=2, depth=2, learning_rate=0.5)
    done = md.train(df, str(tmp_path), settings, folds=2, patience=1)
    assert done.metrics.first()["cv_mean_pr_auc"] == pytest.approx(1.0)
    assert done.thresholds == {"total_price": 6.0}
    assert md.importances(done.model).first()["feature"] == "product_category"
    model = md.load_model([str(tmp_path / "tuned"), str(tmp_path / "baseline")])
    assert md.predicted_rate(md.predict(model, df)).first()[0] == pytest.approx(20.0)
    unseen = df.limit(1).selectExpr("order_id", "'elsewhere' AS product_category", "total_price", "buffer_to_lead_ratio")
    assert md.predict(model, unseen).count() == 1
    with pytest.raises(FileNotFoundError):
        md.load_model([str(tmp_path / "nowhere")])


def test_a_fit_assembles_each_row_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def value(i):
        seen.add(1)
        return float(i % 7)

    rows = spark.range(400).selectExpr("CAST(id AS string) AS order_id", "CAST(id % 3 = 0 AS int) AS is_late", "id").withColumn("total_price", F.udf(value, "double")("id")).drop("id")
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    model = md.fit_trees(rows, md.TreeSettings(rounds=2, depth=2))
    assert seen.value == 400
    assert md.trees_of(model).getNumTrees == 2
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept
