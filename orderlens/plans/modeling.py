"""Training, checking, tuning and applying the late-delivery classifier on Spark ML.

Spark's gradient-boosted trees stand in for the boosted trees users trained before; settings without
a counterpart (L2 on leaves, random strength, bagging temperature) are replaced by the subsampling
rate, the least rows of a node and the share of features a node may split on. Nothing puts a label with most of the rows into one task: folds and exact samples go by hash
prefixes, average precision by ``with_history``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.operators.hash_order import first_rows, with_rank
from orderlens.operators.ordered import DEFAULT_POLICY, SkewPolicy, with_history
from orderlens.plans.ensemble import first_trees, round_curve
from orderlens.plans.features import fit_thresholds, present_categoricals
from orderlens.plans.parzen import Range, suggest
from orderlens.plans.target_stats import category_table, ordered_statistics, with_statistics
from orderlens.sources.artifacts import append_run, write_importances, write_settings, write_thresholds
from orderlens.sources.staging import staged, staged_alone, staging

LABEL = "is_late"
ID = "order_id"
SEED = 42
METRICS = ("f1", "precision", "recall", "pr_auc")


@dataclass(frozen=True)
class TreeSettings:
    """Defaults of the baseline model."""

    rounds: int = 500
    depth: int = 6
    learning_rate: float = 0.05
    subsampling: float = 1.0
    min_rows: int = 1  # rows that a node must have
    feature_share: float = 1.0  # of the features, drawn anew for each node
    seed: int = SEED


# ---------------------------------------------------------------- data preparation
def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in (ID, LABEL) and not c.startswith("_")]


def base_rate(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), (F.avg(LABEL) * 100).alias("late_percent"))


def with_balanced_weights(df: DataFrame) -> DataFrame:
    """Weight each class by largest class / own class (two numbers, found in one pass)."""
    sizes = {r[LABEL]: r["n"] for r in df.groupBy(LABEL).agg(F.count(F.lit(1)).alias("n")).collect()}
    largest = max(sizes.values(), default=1)
    cases = " ".join(f"WHEN {k} THEN {largest / n!r}D" for k, n in sorted(sizes.items()))
    return df.withColumn("_weight", F.expr(f"CASE {LABEL} {cases} END") if cases else F.lit(1.0))


def with_folds(df: DataFrame, k: int, seed: int = SEED, row_key: Sequence[str] = (ID,)) -> DataFrame:
    """Add ``_fold``: rows of each class, shuffled by a hash of ``row_key``, dealt out in turn.

    Fold sizes differ by at most one per class. ``row_key`` should identify a row.
    """
    return with_rank(df, [LABEL], row_key, seed).selectExpr("*", f"CAST(_rank % {k} AS int) AS _fold").drop("_rank")


def sample_rows(df: DataFrame, fraction: float, seed: int = SEED, row_key: Sequence[str] = (ID,)) -> DataFrame:
    """Exactly ``round(fraction * rows)`` rows, the same ones on every run."""
    return df if fraction >= 1.0 else first_rows(df, fraction, row_key, seed)


def _encoder(df: DataFrame) -> tuple[list[StringIndexer | VectorAssembler], list[str]]:
    kinds = dict(df.dtypes)
    categorical = [c for c in present_categoricals(df) if kinds[c] == "string"]
    inputs = [f"{c}_index" if c in categorical else c for c in feature_columns(df)]
    indexers = [
        StringIndexer(
            inputCols=categorical, outputCols=[f"{c}_index" for c in categorical], handleInvalid="keep",
            stringOrderType="frequencyDesc",
        )
    ] if categorical else []
    return [*indexers, VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")], inputs


def without_gaps(df: DataFrame) -> DataFrame:
    """Trees need numbers: what is still NULL after the feature step (a zero lead time's ratio) becomes 0."""
    numeric = [c for c, kind in df.dtypes if kind in ("double", "int", "bigint", "float") and c not in (ID, LABEL)]
    return df.fillna(0, numeric)


# ---------------------------------------------------------------- fitting
def fit_trees(train: DataFrame, settings: TreeSettings, validation_column: str | None = None) -> PipelineModel:
    """Index, assemble and boost; classes are balanced by weights."""
    ready = with_balanced_weights(without_gaps(train))
    stages, _ = _encoder(ready)
    encoder = Pipeline(stages=stages).fit(ready)
    sizes = [len(labels) for s in encoder.stages if isinstance(s, StringIndexerModel) for labels in s.labelsArray]
    booster = GBTClassifier(
        labelCol=LABEL, featuresCol="features", weightCol="_weight", maxIter=settings.rounds,
        maxDepth=settings.depth, stepSize=settings.learning_rate, subsamplingRate=settings.subsampling,
        minInstancesPerNode=settings.min_rows, seed=settings.seed,
        featureSubsetStrategy="all" if settings.feature_share >= 1.0 else repr(settings.feature_share), maxBins=max(32, *(n + 1 for n in sizes)) if sizes else 32,
    )
    if validation_column:
        booster = booster.setValidationIndicatorCol(validation_column)
    # Boosting reads its rows three times before it has bins. They are assembled once and kept on the executors' disks, so
    # that the bins have the memory. Same partitions and order of rows as without this, so the same splits.
    assembled = encoder.transform(ready).select(LABEL, "_weight", "features", *([validation_column] if validation_column else []))
    assembled.persist(StorageLevel.DISK_ONLY)
    try:
        model = booster.fit(assembled)
    finally:
        assembled.unpersist()
    return PipelineModel(stages=[*encoder.stages, model])


@dataclass(frozen=True)
class FittedOnStatistics:
    """Trees over target statistics, and the table that turns categories into them."""

    model: PipelineModel
    categories: DataFrame
    columns: tuple[str, ...]


def fit_on_statistics(train: DataFrame, settings: TreeSettings, row_key: Sequence[str] = (ID,)) -> FittedOnStatistics:
    """Boost with each category as its smoothed late rate: of earlier rows in hash order for training, of all for scoring.

    No category is listed on the driver and trees need no bin for each one.
    """
    columns = tuple(present_categoricals(train))
    spark = train.sparkSession
    table = staged(category_table(train, columns, LABEL), "category-table")
    with staging(spark):
        numbers = staged_alone(spark, lambda: ordered_statistics(train, columns, LABEL, row_key, settings.seed), "target-numbers")
        model = fit_trees(numbers, settings)
    return FittedOnStatistics(model, table, columns)


def predict_on_statistics(fitted: FittedOnStatistics, features: DataFrame, keep: Sequence[str] = (ID,)) -> DataFrame:
    return predict(fitted.model, with_statistics(features, fitted.categories, fitted.columns), keep)


def trees_of(model: PipelineModel) -> GBTClassificationModel:
    return model.stages[-1]


def best_round(losses: Sequence[float], patience: int) -> int:
    """Rounds to keep: the best so far when ``patience`` rounds in a row brought nothing better."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def fit_with_early_stopping(
    train: DataFrame, validation: DataFrame, settings: TreeSettings, patience: int = 50
) -> PipelineModel:
    """Keep the number of rounds with the best F1 on the validation rows.

    One fit with all rounds; the validation rows pass its trees once, and the model is cut to its first trees.
    With ``patience=0`` Spark's own tolerance rule stops during the fit instead.
    """
    if patience <= 0:
        both = train.withColumn("_validation", F.lit(False)).unionByName(
            validation.withColumn("_validation", F.lit(True))
        )
        return fit_trees(both, settings, "_validation")
    model = fit_trees(train, settings)
    curve = round_curve(model, without_gaps(validation).withColumn("_weight", F.lit(1.0)), LABEL)
    f1 = [r["f1"] for r in curve.orderBy("round").collect()]  # one number a round
    return first_trees(model, best_round([-x for x in f1], patience)) if f1 else model


# ---------------------------------------------------------------- applying
def predict(model: PipelineModel, features: DataFrame, keep: Sequence[str] = (ID,)) -> DataFrame:
    """Late probability and, strictly above one half, the late prediction."""
    scored = model.transform(without_gaps(features)).withColumn(
        "late_probability", vector_to_array("probability")[1]
    )
    return with_decision(scored.select(*keep, "late_probability"))


def with_decision(scored: DataFrame) -> DataFrame:
    return scored.withColumn("is_late_prediction", F.expr("CASE WHEN late_probability > 0.5 THEN 1 ELSE 0 END"))


def predicted_rate(predictions: DataFrame) -> DataFrame:
    return predictions.agg((F.avg("is_late_prediction") * 100).alias("predicted_late_percent"))


def load_model(paths: Sequence[str]) -> PipelineModel:
    """The first model that exists, tuned before baseline."""
    for path in paths:
        try:
            return PipelineModel.load(path)
        except AnalysisException:
            continue  # nothing there
        except Exception as error:  # the ML reader reports a missing folder as a Java error
            if "does not exist" not in str(error):
                raise
    raise FileNotFoundError(f"no model in {list(paths)}")


# ---------------------------------------------------------------- metrics
def decision_metrics(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """F1, precision and recall at one half; 0 where undefined."""
    counts = scored.groupBy(*by).agg(
        F.expr(f"count_if(late_probability > 0.5 AND {LABEL} = 1)").alias("tp"),
        F.expr(f"count_if(late_probability > 0.5 AND {LABEL} = 0)").alias("fp"),
        F.expr(f"count_if(NOT late_probability > 0.5 AND {LABEL} = 1)").alias("fn"),
    )
    return counts.selectExpr(
        *by,
        "coalesce(try_divide(2D * tp, 2 * tp + fp + fn), 0D) AS f1",
        "coalesce(try_divide(CAST(tp AS double), tp + fp), 0D) AS precision",
        "coalesce(try_divide(CAST(tp AS double), tp + fn), 0D) AS recall",
    )


def average_precision(scored: DataFrame, by: str, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Area under the precision-recall steps, per value of ``by``; tied scores form one step."""
    steps = staged(
        scored.where("late_probability IS NOT NULL")
        .groupBy(by, (-F.col("late_probability")).alias("_descending"))
        .agg(F.sum(LABEL).alias("_pos"), F.count(F.lit(1)).alias("_n")),
        "score-steps",
    )
    summed = with_history(
        steps, [by], ["_descending"],
        before={"_pos_before": "_pos", "_n_before": "_n"}, total={"_pos_all": "_pos"},
        policy=policy, at_most=steps.count(),
    )
    step = "try_divide(CAST(_pos AS double), _pos_all) * (_pos_before + _pos) / (_n_before + _n)"
    return summed.groupBy(by).agg(F.expr(f"coalesce(sum({step}), 0D)").alias("pr_auc"))


def fold_metrics(scored: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """One row of metrics per ``_fold``."""
    return decision_metrics(scored, ["_fold"]).join(average_precision(scored, "_fold", policy), "_fold")


def mean_metrics(per_fold: DataFrame) -> DataFrame:
    return per_fold.agg(*[F.avg(m).alias(f"cv_mean_{m}") for m in METRICS])


# ---------------------------------------------------------------- jobs
def cross_validate(
    features: DataFrame,
    settings: TreeSettings = TreeSettings(),
    folds: int = 5,
    patience: int = 50,
    row_key: Sequence[str] = (ID,),
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Metrics per fold. Each fold's model is fitted on the other folds, in parallel inside Spark."""

    def scores() -> DataFrame:
        dealt = staged_alone(features.sparkSession, lambda: with_folds(features, folds, settings.seed, row_key), "folds")
        scored = None
        for fold in range(folds):
            train, held_out = dealt.where(f"_fold <> {fold}"), dealt.where(f"_fold = {fold}")
            model = fit_with_early_stopping(train, held_out, settings, patience)
            part = predict(model, held_out, [ID, LABEL, "_fold"])
            scored = part if scored is None else scored.unionByName(part)
        return scored

    return fold_metrics(staged_alone(features.sparkSession, scores, "fold-scores"), policy)


def importances(model: PipelineModel) -> DataFrame:
    """(feature, importance in percent), largest first; one row per feature."""
    trees = trees_of(model)
    names = [c.removesuffix("_index") for c in model.stages[-2].getInputCols()]
    rows = [(n, float(v) * 100) for n, v in zip(names, trees.featureImportances.toArray())]
    spark = SparkSession.active()
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


@dataclass(frozen=True)
class Training:
    model: PipelineModel
    metrics: DataFrame
    thresholds: dict[str, float]


def train(
    features: DataFrame,
    folder: str,
    settings: TreeSettings = TreeSettings(),
    folds: int = 5,
    patience: int = 50,
    row_key: Sequence[str] = (ID,),
) -> Training:
    """Cross-validate, fit on all rows and leave model, importances, thresholds and run log in ``folder``.

    Thresholds are taken from the already capped features, as scoring has always used them; they can
    be slightly below the caps of training.
    """
    spark = features.sparkSession
    metrics = staged(mean_metrics(cross_validate(features, settings, folds, patience, row_key)), "cv-metrics")
    model = fit_trees(features, settings)
    model.write().overwrite().save(f"{folder}/baseline")
    write_importances(importances(model), f"{folder}/feature_importance")
    thresholds = fit_thresholds(features)
    write_thresholds(spark, thresholds, f"{folder}/feature_thresholds")
    params = asdict(settings) | {"model": "GBTClassifier", "cv_splits": folds, "class_weights": "balanced"}
    append_run(spark, f"{folder}/runs", "baseline", params, metrics.first().asDict())
    return Training(model, metrics, thresholds)


# ---------------------------------------------------------------- tuning
@dataclass(frozen=True)
class SearchSpace:
    """Ranges of the search; the learning rate and the rows of a node are drawn on a logarithmic scale."""

    rounds: tuple[int, int] = (200, 1000)
    depth: tuple[int, int] = (4, 10)
    learning_rate: tuple[float, float] = (0.01, 0.3)
    subsampling: tuple[float, float] = (0.5, 1.0)
    min_rows: tuple[int, int] = (1, 50)
    feature_share: tuple[float, float] = (0.4, 1.0)

    def ranges(self) -> dict[str, Range]:
        whole, logarithmic = ("rounds", "depth", "min_rows"), ("learning_rate", "min_rows")
        return {n: Range(*v, logarithmic=n in logarithmic, whole=n in whole) for n, v in asdict(self).items()}

    def draw(self, trial: int, done: Sequence[Mapping[str, float]] = (), seed: int = SEED) -> TreeSettings:
        """The settings of a trial, given the finished trials (``pr_auc`` and the settings) of smaller number."""
        earlier = sorted((d for d in done if d["trial"] < trial), key=lambda d: d["trial"])
        found = suggest(self.ranges(), earlier, [d["pr_auc"] for d in earlier], trial, seed)
        return TreeSettings(**found, seed=seed)


TRIAL_SCHEMA = (
    "trial int, pr_auc double, rounds int, depth int, learning_rate double, subsampling double, min_rows int, feature_share double, seed int"
)
Score = Callable[[DataFrame, TreeSettings], float]


def cross_validated_score(
    folds: int = 3, patience: int = 50, row_key: Sequence[str] = (ID,)
) -> Score:
    def score(features: DataFrame, settings: TreeSettings) -> float:
        return mean_metrics(cross_validate(features, settings, folds, patience, row_key)).first()["cv_mean_pr_auc"]

    return score


def search(
    features: DataFrame,
    trials_path: str,
    trials: int = 50,
    space: SearchSpace = SearchSpace(),
    fraction: float = 1.0,
    score: Score | None = None,
    row_key: Sequence[str] = (ID,),
) -> DataFrame:
    """Search for the best mean average precision, each trial guided by the finished ones (see ``parzen``).

    Each finished trial is appended to the table at ``trials_path``; trials already there are not
    repeated, so an interrupted search goes on where it stopped, with the settings it would have tried.
    """
    spark = features.sparkSession
    score = score or cross_validated_score(row_key=row_key)
    tuned_on = features if fraction >= 1.0 else staged(sample_rows(features, fraction, row_key=row_key), "tuning-rows")
    empty = spark.createDataFrame([], TRIAL_SCHEMA)
    empty.write.mode("append").parquet(trials_path)
    table = spark.read.schema(TRIAL_SCHEMA).parquet(trials_path)
    done = {r["trial"]: r.asDict() for r in table.collect()}  # one row per trial
    for trial in range(trials):
        if trial in done:
            continue
        settings = space.draw(trial, list(done.values()))
        found = {"trial": trial, "pr_auc": float(score(tuned_on, settings)), **asdict(settings)}
        spark.createDataFrame([tuple(found[f.name] for f in empty.schema)], empty.schema).coalesce(1).write.mode(
            "append"
        ).parquet(trials_path)
        done[trial] = found
    return spark.read.schema(TRIAL_SCHEMA).parquet(trials_path)


def best_trial(trials: DataFrame) -> DataFrame:
    return trials.orderBy(F.desc("pr_auc"), "trial").limit(1)


def tune(
    features: DataFrame,
    folder: str,
    trials: int = 50,
    space: SearchSpace = SearchSpace(),
    fraction: float = 1.0,
    score: Score | None = None,
    row_key: Sequence[str] = (ID,),
) -> PipelineModel:
    """Search, refit the best settings on all rows, and leave model and artifacts in ``folder``."""
    spark = features.sparkSession
    best = best_trial(search(features, f"{folder}/trials", trials, space, fraction, score, row_key)).first().asDict()
    settings = TreeSettings(**{k: best[k] for k in asdict(TreeSettings())})
    write_settings(spark, {k: v for k, v in asdict(settings).items() if k != "seed"}, f"{folder}/best_settings")
    model = fit_trees(features, settings)
    model.write().overwrite().save(f"{folder}/tuned")
    write_importances(importances(model), f"{folder}/tuned_importance")
    append_run(spark, f"{folder}/runs", "tuning", asdict(settings), {"best_pr_auc": best["pr_auc"]})
    return model


def settings_from(values: Mapping[str, float]) -> TreeSettings:
    """Settings read back from their artifact."""
    return TreeSettings(
        int(values["rounds"]), int(values["depth"]), float(values["learning_rate"]), float(values["subsampling"]),
        int(values.get("min_rows", 1)), float(values.get("feature_share", 1.0)),
    )
