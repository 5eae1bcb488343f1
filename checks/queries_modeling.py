"""Modelling jobs. Metrics, folds, samples and target statistics have oracles. What a fitted model says cannot be put into
SQL; its queries return rows only, and queries beside them check what must hold of it against constants and row counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from checks.oracle_features import CAPPED
from checks.queries_features import dataset
from checks.registry import register, rounded
from orderlens.plans import ensemble as en
from orderlens.plans import features as fe
from orderlens.plans import modeling as md
from orderlens.plans import target_stats as ts
from orderlens.plans.dataset import analytical_dataset
from orderlens.sources.artifacts import write_importances
from orderlens.sources.marketplace import marketplace_from_star
from orderlens.sources.staging import fresh_path, staged, staged_alone

ROW_KEY = ("order_id", "seller_avg_review_score")
# A probability made of dataset columns, with many ties, that both engines compute alike.
SCORE = "CAST((total_items * 7 + purchase_hour * 13 + purchase_month * 5) % 100 AS DOUBLE) / 100"
SMALL = md.TreeSettings(rounds=4, depth=3, learning_rate=0.2)


def _scored(spark, folder):
    columns = ["order_id", "is_late", "total_items", "purchase_hour", "purchase_month"]
    df = analytical_dataset(marketplace_from_star(spark, folder), columns)
    return df.selectExpr("order_id", "is_late", f"{SCORE} AS late_probability")


def _orders(spark, folder):
    return analytical_dataset(marketplace_from_star(spark, folder), ["order_id", "is_late"], dedupe_reviews=True)


def features(spark, folder):
    return staged_alone(spark, lambda: fe.build_features(dataset(spark, folder)), "features")


_ONE_PER_ORDER = "(SELECT DISTINCT order_id, is_late FROM plain_dataset)"


@register(
    "m01_feature_target_split",
    "SELECT 44::BIGINT AS features, 7::BIGINT AS categoricals, count(*) AS rows, sum(is_late)::BIGINT AS late FROM features",
    "features",
)
def _(spark, folder):
    df = fe.prepare(analytical_dataset(marketplace_from_star(spark, folder)))
    n, k = len(md.feature_columns(df)), len(fe.present_categoricals(df))
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum("is_late").alias("late")).selectExpr(
        f"{n}L AS features", f"{k}L AS categoricals", "rows", "late"
    )


def _running(column: str, w: str) -> str:
    return f"round((coalesce(sum(is_late) OVER {w}, 0) + p) / (count(*) OVER {w} + 1), 9) AS {column}"


def _window(column: str) -> str:
    return f"""(PARTITION BY coalesce({column}, 'UNKNOWN') ORDER BY md5(order_id || '42'), order_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


_CATEGORIES = ("product_category", "customer_state")
_WITH_CATEGORIES = f"(SELECT DISTINCT order_id, is_late, {', '.join(_CATEGORIES)} FROM plain_dataset)"


def _categorized(spark, folder):
    return analytical_dataset(marketplace_from_star(spark, folder), ["order_id", "is_late", *_CATEGORIES], dedupe_reviews=True)


@register(
    "m01_target_statistics",
    f"""SELECT order_id, {', '.join(_running(c, f'w{i}') for i, c in enumerate(_CATEGORIES))}
        FROM {_WITH_CATEGORIES}, (SELECT avg(is_late) AS p FROM {_WITH_CATEGORIES})
        WINDOW {', '.join(f'w{i} AS {_window(c)}' for i, c in enumerate(_CATEGORIES))}""",
    "plain_dataset",
)
def _(spark, folder):
    found = ts.ordered_statistics(_categorized(spark, folder), _CATEGORIES, "is_late", ["order_id"], md.SEED)
    return rounded(found.drop("is_late"), 9)


@register(
    "m01_category_rates",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, coalesce({c}, 'UNKNOWN') AS category, count(*) AS rows, sum(is_late)::DOUBLE AS late,
            round((sum(is_late) + max(p)) / (count(*) + 1), 9) AS rate
            FROM {_WITH_CATEGORIES}, (SELECT avg(is_late) AS p FROM {_WITH_CATEGORIES}) GROUP BY ALL
            UNION ALL SELECT '{c}', NULL, 0, 0, round(avg(is_late), 9) FROM {_WITH_CATEGORIES}"""
        for c in _CATEGORIES
    ),
    "plain_dataset",
)
def _(spark, folder):
    return rounded(ts.category_table(_categorized(spark, folder), _CATEGORIES, "is_late").withColumnRenamed("column", "column_name"), 9)


@register(
    "m02_base_rate",
    "SELECT count(*) AS rows, round(avg(is_late) * 100, 6) AS late_percent FROM plain_dataset",
    "plain_dataset",
)
def _(spark, folder):
    return rounded(md.base_rate(analytical_dataset(marketplace_from_star(spark, folder), ["is_late"])))


@register(
    "m03_class_weights",
    """SELECT is_late, count(*) AS rows, round(max(count(*)) OVER () / count(*), 6) AS weight
       FROM plain_dataset GROUP BY is_late""",
    "plain_dataset",
)
def _(spark, folder):
    df = md.with_balanced_weights(analytical_dataset(marketplace_from_star(spark, folder), ["is_late"]))
    return rounded(df.groupBy("is_late").agg(F.count(F.lit(1)).alias("rows"), F.max("_weight").alias("weight")))


@register(
    "m04_stratified_folds",
    f"""SELECT order_id, is_late, CAST((row_number() OVER (PARTITION BY is_late ORDER BY md5(order_id || '42'), order_id) - 1)
        % 5 AS INTEGER) AS fold FROM {_ONE_PER_ORDER}""",
    "plain_dataset",
)
def _(spark, folder):
    return md.with_folds(_orders(spark, folder), 5).withColumnRenamed("_fold", "fold")


@register("m05_boosted_trees")
def _(spark, folder):
    df = features(spark, folder)
    return md.predict(md.fit_trees(df, SMALL), df)


@register("m06_early_stopping")
def _(spark, folder):
    dealt = staged_alone(spark, lambda: md.with_folds(features(spark, folder), 3, row_key=ROW_KEY), "folds")
    held_out = dealt.where("_fold = 0")
    model = md.fit_with_early_stopping(dealt.where("_fold <> 0"), held_out, SMALL, patience=2)
    rounds = md.trees_of(model).getNumTrees
    return md.predict(model, held_out).withColumn("rounds", F.lit(rounds))


def _differing(a, b, digits=12):
    """(rows, differing): how many probabilities of two predictions of the same rows differ."""
    key = ["order_id", "_copy"]
    numbered = [
        x.selectExpr("order_id", f"round(late_probability, {digits}) AS p").withColumn(
            "_copy", F.row_number().over(Window.partitionBy("order_id").orderBy("p"))
        )
        for x in (a, b)
    ]
    both = numbered[0].join(numbered[1].withColumnRenamed("p", "q"), key, "full")
    return both.agg(F.count(F.lit(1)).alias("rows"), F.expr("count_if(NOT p <=> q)").alias("differing"))


_ALL_EQUAL = "SELECT count(*) AS rows, 0::BIGINT AS differing FROM features"


@register("m05_same_seed_same_model", _ALL_EQUAL, "features")
def _(spark, folder):
    """Two fits with one seed say the same of every row."""
    df = features(spark, folder)
    return _differing(md.predict(md.fit_trees(df, SMALL), df), md.predict(md.fit_trees(df, SMALL), df))


@register("m05_trees_on_statistics", "SELECT count(*) AS rows, 0::BIGINT AS outside, true AS above_base_rate FROM features", "features")
def _(spark, folder):
    """Trees over target statistics: probabilities between 0 and 1 that rank late rows better than chance."""
    df = features(spark, folder)
    fitted = md.fit_on_statistics(df, SMALL, ROW_KEY)
    scored = staged(md.predict_on_statistics(fitted, df, ["order_id", "is_late"]).withColumn("g", F.lit(0)), "scores")
    ap = md.average_precision(scored, "g").first()["pr_auc"]
    return scored.agg(
        F.count(F.lit(1)).alias("rows"), F.expr("count_if(NOT late_probability BETWEEN 0 AND 1)").alias("outside"),
        (F.lit(ap) > F.avg("is_late")).alias("above_base_rate"),
    )


@register(
    "m06_round_curve",
    "SELECT unnest(range(1, 5))::INTEGER AS round, count(*) AS rows, true AS f1_agrees, true AS pr_auc_agrees FROM features",
    "features",
)
def _(spark, folder):
    """Each round of the curve against the metrics of the model cut to that many trees."""
    df = features(spark, folder)
    model = md.fit_trees(df, SMALL)
    curve = en.round_curve(model, md.without_gaps(df).withColumn("_weight", F.lit(1.0)), "is_late")
    parts = [md.predict(en.first_trees(model, n), df, ["order_id", "is_late"]).withColumn("_fold", F.lit(n)) for n in range(1, SMALL.rounds + 1)]
    direct = md.fold_metrics(staged(reduce(DataFrame.unionByName, parts), "rounds"))
    direct = direct.select(F.col("_fold").alias("round"), F.col("f1").alias("f"), F.col("pr_auc").alias("ap"))
    return curve.join(direct, "round").selectExpr("round", "rows", "abs(f1 - f) < 1e-12 AS f1_agrees", "abs(pr_auc - ap) < 2e-3 AS pr_auc_agrees")


@register("m06_best_round", "SELECT true AS is_best_of_the_curve, 0::BIGINT AS differing FROM features LIMIT 1", "features")
def _(spark, folder):
    """Early stopping keeps the first trees of the whole fit, as many as the stored curve says."""
    dealt = staged_alone(spark, lambda: md.with_folds(features(spark, folder), 3, row_key=ROW_KEY), "folds")
    train, held_out = dealt.where("_fold <> 0"), dealt.where("_fold = 0")
    whole = md.fit_trees(train, SMALL)
    curve = en.round_curve(whole, md.without_gaps(held_out).withColumn("_weight", F.lit(1.0)), "is_late")
    kept = md.fit_with_early_stopping(train, held_out, SMALL, patience=2)
    best = md.best_round([-r["f1"] for r in curve.orderBy("round").collect()], 2)
    same = _differing(md.predict(kept, held_out), md.predict(en.first_trees(whole, best), held_out))
    return same.select(F.lit(md.trees_of(kept).getNumTrees == best).alias("is_best_of_the_curve"), "differing")


@register("m10_reloaded_model", _ALL_EQUAL, "features")
def _(spark, folder):
    """A model read back from its folder says what it said in memory."""
    df, home = features(spark, folder), fresh_path(spark, "training")
    done = md.train(df, home, SMALL, folds=2, patience=0, row_key=ROW_KEY)
    return _differing(md.predict(done.model, df), md.predict(md.load_model([f"{home}/baseline"]), df))


@register("m11_importance_shares", "SELECT 44::BIGINT AS names, 100.0::DOUBLE AS total, 0::BIGINT AS negative FROM features LIMIT 1", "features")
def _(spark, folder):
    shares = md.importances(md.fit_trees(features(spark, folder), SMALL))
    return shares.agg(
        F.countDistinct("feature").alias("names"), F.round(F.sum("importance"), 6).alias("total"), F.expr("count_if(importance < 0)").alias("negative")
    )


@register("m15_tuned_is_the_refit", _ALL_EQUAL, "features")
def _(spark, folder):
    """The tuned model is the one that the settings of the best stored trial give on all rows."""
    df, home = features(spark, folder), fresh_path(spark, "tuning")
    score = md.cross_validated_score(folds=2, patience=0, row_key=ROW_KEY)
    tuned = md.tune(df, home, 1, _SPACE, 1.0, score, ROW_KEY)
    best = md.best_trial(spark.read.parquet(f"{home}/trials")).first().asDict()
    again = md.fit_trees(df, md.TreeSettings(**{k: best[k] for k in md.asdict(md.TreeSettings())}))
    return _differing(md.predict(tuned, df), md.predict(again, df))


@register("m17_baseline_where_nothing_is_tuned", _ALL_EQUAL, "features")
def _(spark, folder):
    df, home = features(spark, folder), fresh_path(spark, "models")
    model = md.fit_trees(df, SMALL)
    model.write().overwrite().save(f"{home}/baseline")
    return _differing(md.predict(model, df), md.predict(md.load_model([f"{home}/tuned", f"{home}/baseline"]), df))


_METRICS = """SELECT fold, round(coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1,
    round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall
    FROM (SELECT {fold} AS fold, count(*) FILTER (p > 0.5 AND is_late = 1) AS tp,
        count(*) FILTER (p > 0.5 AND is_late = 0) AS fp, count(*) FILTER (p <= 0.5 AND is_late = 1) AS fn
        FROM {source} GROUP BY 1)"""
_AP = """SELECT fold, round(sum(pos / total * tp_in / n_in), 6) AS pr_auc FROM (
    SELECT fold, p, pos, sum(pos) OVER (PARTITION BY fold) AS total,
        sum(pos) OVER (PARTITION BY fold ORDER BY p DESC) AS tp_in, sum(n) OVER (PARTITION BY fold ORDER BY p DESC) AS n_in
    FROM (SELECT {fold} AS fold, p, sum(is_late)::DOUBLE AS pos, count(*)::DOUBLE AS n FROM {source} GROUP BY 1, 2))
    GROUP BY fold"""
_FOLDED = f"""(SELECT order_id, is_late, p, CAST((row_number() OVER (PARTITION BY is_late
    ORDER BY md5(order_id || '42'), order_id) - 1) % 3 AS INTEGER) AS f
    FROM (SELECT DISTINCT order_id, is_late, {SCORE} AS p FROM plain_dataset))"""
_ALL = f"(SELECT is_late, {SCORE} AS p FROM plain_dataset)"


@register("m07_decision_metrics", f"SELECT * EXCLUDE (fold) FROM ({_METRICS.format(fold='0', source=_ALL)})", "plain_dataset")
def _(spark, folder):
    return rounded(md.decision_metrics(_scored(spark, folder)))


@register("m08_average_precision", _AP.format(fold="0", source=_ALL), "plain_dataset")
def _(spark, folder):
    scored = _scored(spark, folder).withColumn("fold", F.lit(0))
    return rounded(md.average_precision(scored, "fold"))


def _fold_metrics(spark, folder):
    columns = ["order_id", "is_late", "total_items", "purchase_hour", "purchase_month"]
    df = analytical_dataset(marketplace_from_star(spark, folder), columns, dedupe_reviews=True)
    scored = df.selectExpr("order_id", "is_late", f"{SCORE} AS late_probability")
    return md.fold_metrics(staged(md.with_folds(scored, 3), "fold-scores"))


_PER_FOLD = (
    f"(SELECT * FROM ({_METRICS.format(fold='f', source=_FOLDED)}) JOIN ({_AP.format(fold='f', source=_FOLDED)}) USING (fold))"
)


@register("m09_fold_metrics", f"SELECT * FROM {_PER_FOLD}", "plain_dataset")
def _(spark, folder):
    return rounded(_fold_metrics(spark, folder).withColumnRenamed("_fold", "fold"))


@register(
    "m09_mean_metrics",
    "SELECT " + ", ".join(f"round(avg({m}), 5) AS cv_mean_{m}" for m in md.METRICS) + f" FROM {_PER_FOLD}",
    "plain_dataset",
)
def _(spark, folder):
    return rounded(md.mean_metrics(_fold_metrics(spark, folder)), 5)


@register("m10_train_and_save")
def _(spark, folder):
    df, home = features(spark, folder), fresh_path(spark, "training")
    md.train(df, home, SMALL, folds=2, patience=0, row_key=ROW_KEY)
    return md.predict(md.load_model([f"{home}/baseline"]), df)


@register("m11_importances")
def _(spark, folder):
    return md.importances(md.fit_trees(features(spark, folder), SMALL))


@register(
    "m12_thresholds_of_capped_features",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(quantile_cont({c}, 0.995), 4) AS threshold FROM features" for c in CAPPED
    ),
    "features",
)
def _(spark, folder):
    inputs = dict.fromkeys([*fe.REQUIRED, "total_price", "freight_ratio", "total_payment"])
    stored = staged(analytical_dataset(marketplace_from_star(spark, folder), list(inputs)), "analytical")
    found = fe.fit_thresholds(fe.build_features(stored))
    return spark.createDataFrame([(k, round(v, 4)) for k, v in found.items()], "column_name string, threshold double")


@register(
    "m13_row_sample",
    f"""SELECT order_id, is_late FROM (SELECT *, row_number() OVER (ORDER BY md5(order_id || '42'), order_id) AS r,
        count(*) OVER () AS n FROM {_ONE_PER_ORDER}) WHERE r <= round_even(0.3 * n, 0)""",
    "plain_dataset",
)
def _(spark, folder):
    return md.sample_rows(_orders(spark, folder), 0.3)


_SPACE = md.SearchSpace(rounds=(2, 3), depth=(2, 3), learning_rate=(0.1, 0.3), min_rows=(1, 4))


@register("m14_search_with_resume")
def _(spark, folder):
    df, path = features(spark, folder), fresh_path(spark, "trials")
    score = md.cross_validated_score(folds=2, patience=0, row_key=ROW_KEY)
    md.search(df, path, 1, _SPACE, 0.5, score, ROW_KEY)
    return md.search(df, path, 2, _SPACE, 0.5, score, ROW_KEY)


@register("m14_resumed_equals_whole", "SELECT 13::BIGINT AS trials, 0::BIGINT AS differing FROM features LIMIT 1", "features")
def _(spark, folder):
    """A search that stops and goes on tries what one run tries; the score is a formula of the settings and the rows."""
    late = md.base_rate(features(spark, folder)).first()["late_percent"]
    df = spark.range(1)

    def score(_, s):
        return late / (1 + abs(s.depth - 6) + abs(s.learning_rate - 0.05) + s.rounds / 1000)

    whole, parts = fresh_path(spark, "trials"), fresh_path(spark, "trials")
    md.search(df, whole, 13, score=score)
    md.search(df, parts, 11, score=score)
    md.search(df, parts, 13, score=score)
    a, b = (spark.read.parquet(p) for p in (whole, parts))
    return a.select(F.count(F.lit(1)).alias("trials")).withColumn("differing", F.lit(a.exceptAll(b).count() + b.exceptAll(a).count()).cast("long"))


@register("m15_tuned_model")
def _(spark, folder):
    df, home = features(spark, folder), fresh_path(spark, "tuning")
    score = md.cross_validated_score(folds=2, patience=0, row_key=ROW_KEY)
    return md.predict(md.tune(df, home, 1, _SPACE, 1.0, score, ROW_KEY), df)


@register(
    "m16_decisions",
    f"""SELECT order_id, {SCORE} AS late_probability, CAST({SCORE} > 0.5 AS INTEGER) AS is_late_prediction
        FROM plain_dataset""",
    "plain_dataset",
)
def _(spark, folder):
    return md.with_decision(_scored(spark, folder).drop("is_late"))


@register("m17_model_choice")
def _(spark, folder):
    df, home = features(spark, folder), fresh_path(spark, "models")
    md.fit_trees(df, SMALL).write().overwrite().save(f"{home}/baseline")
    return md.predict(md.load_model([f"{home}/tuned", f"{home}/baseline"]), df)


@register(
    "m18_predicted_rate",
    f"SELECT round(avg(CAST({SCORE} > 0.5 AS INTEGER)) * 100, 6) AS predicted_late_percent FROM plain_dataset",
    "plain_dataset",
)
def _(spark, folder):
    return rounded(md.predicted_rate(md.with_decision(_scored(spark, folder))))


@register(
    "s12_importance_artifact",
    "SELECT unnest(['is_late', 'total_items']) AS feature, count(*)::DOUBLE AS importance FROM plain_dataset",
    "plain_dataset",
)
def _(spark, folder):
    df = analytical_dataset(marketplace_from_star(spark, folder), ["is_late", "total_items"])
    long = df.selectExpr("stack(2, 'is_late', CAST(is_late AS bigint), 'total_items', total_items) AS (feature, v)")
    path = fresh_path(spark, "importance")
    write_importances(long.groupBy("feature").agg(F.count("v").cast("double").alias("importance")), path)
    return spark.read.schema("feature string, importance double").option("header", True).csv(path)
