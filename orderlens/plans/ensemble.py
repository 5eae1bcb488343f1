"""What the trees of a fitted ensemble say one by one: scores after every round, and what each feature adds.

The node table of a model (a row for each node, as Spark ML writes it) is as large as the settings allow and does not depend
on the data. Tasks hold it as arrays and send Arrow batches of rows down all trees, a level at a time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.sources.staging import fresh_path, remove_path

STEPS = 4096  # of the probability, for curves; a half lies on the border of two


def node_table(model: GBTClassificationModel) -> DataFrame:
    """(tree, weight, node, value, rows, feature, left, right, threshold, categories): leaves have no feature; a row goes
    left if its value is at most the threshold, or one of the categories."""
    spark = SparkSession.active()
    path = fresh_path(spark, "trees")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()  # bounded by the settings
    remove_path(spark, path)
    rows = []
    for n in nodes:
        leaf, split = n.leftChild < 0, n.split
        categorical = not leaf and split.numCategories >= 0
        rows.append((
            n.treeID, float(model.treeWeights[n.treeID]), n.id, n.prediction, n.rawCount,
            *((None, None, None) if leaf else (split.featureIndex, n.leftChild, n.rightChild)),
            None if leaf or categorical else split.leftCategoriesOrThreshold[0],
            [int(c) for c in split.leftCategoriesOrThreshold] if categorical else None,
        ))
    schema = "tree int, weight double, node int, value double, rows long, feature int, left int, right int, threshold double, categories array<int>"
    return spark.createDataFrame(rows, schema)


class Forest:
    """Arrays (tree, node) of a node table."""

    def __init__(self, nodes: Sequence):
        trees, size = 1 + max(n.tree for n in nodes), 1 + max(n.node for n in nodes)
        self.weight = np.zeros(trees)
        self.value = np.zeros((trees, size))
        self.feature = np.full((trees, size), -1, np.int32)
        self.child = np.tile(np.arange(size, dtype=np.int32), (2, trees, 1))  # right, left; a leaf is its own child
        self.threshold = np.zeros((trees, size))
        self.category = np.full((trees, size), -1, np.int32)  # row of ``goes_left`` of a split by category
        sets = [n.categories for n in nodes if n.categories is not None]
        self.goes_left = np.zeros((len(sets), 2 + max((max(s, default=0) for s in sets), default=0)), bool)
        k = 0
        for n in nodes:
            at = n.tree, n.node
            self.weight[n.tree], self.value[at] = n.weight, n.value
            if n.feature is None:
                continue
            self.feature[at] = n.feature
            self.child[0][at], self.child[1][at] = n.right, n.left
            if n.categories is None:
                self.threshold[at] = n.threshold
            else:
                self.goes_left[k, n.categories] = True
                self.category[at], k = k, k + 1

    def paths(self, x: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
        """For each tree the nodes that the rows of ``x`` pass, level by level until all are in leaves."""
        for t in range(len(self.weight)):
            yield t, list(self._levels(t, x))

    def _levels(self, t: int, x: np.ndarray) -> Iterator[np.ndarray]:
        every, last = np.arange(len(x)), self.goes_left.shape[1] - 1
        node = np.zeros(len(x), np.int32)
        yield node
        while (inner := self.feature[t, node] >= 0).any():
            value = x[every, np.maximum(self.feature[t, node], 0)]
            left = value <= self.threshold[t, node]
            category = self.category[t, node]
            if (category >= 0).any():
                # A category beyond all sets, such as one not seen in training, goes right.
                known = np.clip(np.nan_to_num(value, nan=last), 0, last).astype(np.int64)
                left = np.where(category >= 0, self.goes_left[category, known], left)
            node = np.where(inner, self.child[left.astype(np.int8), t, node], node)
            yield node

    def _leaves(self, t: int, x: np.ndarray) -> np.ndarray:
        for node in self._levels(t, x):
            pass
        return node

    def margins(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """The rows' margins after each tree; the late probability is 1 / (1 + exp(-2 * margin))."""
        sums = np.zeros(len(x))
        for t, passed in self.paths(x):
            sums = sums + self.weight[t] * self.value[t, passed[-1]]
            yield sums

    def contributions(self, x: np.ndarray) -> tuple[float, np.ndarray]:
        """The log-odds of a row that knows nothing, and what each feature adds to them along the row's paths."""
        out = np.zeros(x.shape)
        every = np.arange(len(x))
        for t, passed in self.paths(x):
            for above, below in zip(passed[:-1], passed[1:], strict=True):
                step = self.value[t, below] - self.value[t, above]  # 0 for rows that are in their leaf
                np.add.at(out, (every, np.maximum(self.feature[t, above], 0)), 2 * self.weight[t] * step)
        return float(2 * (self.weight * self.value[:, 0]).sum()), out


    def impacts(self, x: np.ndarray, baseline: np.ndarray) -> np.ndarray:
        """What each feature adds to the rows' late probability: minus the probability with that feature at its baseline.

        A tree is walked again only for the features it splits on; features that no tree splits on get 0.
        """
        splits = [np.unique(self.feature[t][self.feature[t] >= 0]) for t in range(len(self.weight))]
        used = np.unique(np.concatenate(splits))
        margin, changed = np.zeros(len(x)), np.zeros((len(used), len(x)))  # each summed tree by tree, in one order
        place = {f: i for i, f in enumerate(used)}
        for t, passed in self.paths(x):
            value = self.weight[t] * self.value[t, passed[-1]]
            margin = margin + value
            added = np.tile(value, (len(used), 1))
            for f in splits[t]:
                own = x[:, f].copy()
                x[:, f] = baseline[f]
                added[place[f]] = self.weight[t] * self.value[t, self._leaves(t, x)]
                x[:, f] = own
            changed += added
        out = np.zeros(x.shape)
        out[:, used] = (1 / (1 + np.exp(-2 * margin)) - 1 / (1 + np.exp(-2 * changed))).T
        return out


def forest_of(model: PipelineModel) -> Forest:
    return Forest(node_table(model.stages[-1]).collect())


def _ready(model: PipelineModel, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The features as an array, with the numbers that the assembler puts into its vector (NaN for NULL), and the columns to keep."""
    encoded = PipelineModel(stages=model.stages[:-1]).transform(rows)  # checks the columns; the vector itself is not computed
    numbers = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for c in model.stages[-2].getInputCols()]
    return encoded.select(*keep, F.array(*numbers).alias("_x"))


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def round_curve(model: PipelineModel, rows: DataFrame, label: str) -> DataFrame:
    """(round, rows, f1, precision, recall, pr_auc) of the ensemble's first 1, 2, … trees on ``rows``, found in one pass.

    Tasks count late and all rows by round and step of the probability (1/4096), so what is shuffled does not
    grow with the rows. F1, precision and recall are exact; probabilities of one step count as tied for the average precision.
    """
    forest = forest_of(model)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, len(forest.weight), STEPS + 1), np.int64)
        for batch in batches:
            late = np.nan_to_num(batch.column(0).to_numpy(zero_copy_only=False).astype(float)) > 0
            for t, margin in enumerate(forest.margins(_matrix(batch.column(1)))):
                step = np.ceil(STEPS / (1 + np.exp(-2 * margin))).astype(np.int64)  # over a half: above STEPS / 2
                n[0, t] += np.bincount(step, minlength=STEPS + 1)
                n[1, t] += np.bincount(step[late], minlength=STEPS + 1)
        t, step = np.nonzero(n[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(t + 1, pa.int32()), pa.array(step, pa.int32()), pa.array(n[0, t, step]), pa.array(n[1, t, step])], ["round", "step", "n", "late"]
        )

    seen = _ready(model, rows, [label]).mapInArrow(count, "round int, step int, n long, late long")
    steps = seen.groupBy("round", "step").agg(F.sum("n").alias("n"), F.sum("late").alias("late"))
    down = Window.partitionBy("round").orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = steps.select("*", F.sum("n").over(down).alias("n_in"), F.sum("late").over(down).alias("late_in"), F.sum("late").over(Window.partitionBy("round")).alias("all_late"))
    sums = ranked.groupBy("round").agg(
        F.sum("n").alias("rows"),
        F.expr(f"sum(IF(step > {STEPS // 2}, late, 0L))").alias("tp"),
        F.expr(f"sum(IF(step > {STEPS // 2}, n - late, 0L))").alias("fp"),
        F.expr(f"sum(IF(step > {STEPS // 2}, 0L, late))").alias("fn"),
        F.expr("coalesce(sum(try_divide(CAST(late AS double), all_late) * late_in / n_in), 0D)").alias("pr_auc"),
    )
    return sums.selectExpr(
        "round", "rows",
        "coalesce(try_divide(2D * tp, 2 * tp + fp + fn), 0D) AS f1",
        "coalesce(try_divide(CAST(tp AS double), tp + fp), 0D) AS precision",
        "coalesce(try_divide(CAST(tp AS double), tp + fn), 0D) AS recall",
        "pr_auc",
    )


def first_trees(model: PipelineModel, rounds: int) -> PipelineModel:
    """The model after its first ``rounds`` rounds; boosting is sequential, so nothing has to be fitted again."""
    whole: GBTClassificationModel = model.stages[-1]
    if rounds >= whole.getNumTrees:
        return model
    spark = SparkSession.active()
    gateway, jvm = spark.sparkContext._gateway, spark._jvm
    old = whole._java_obj
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(jvm.double, rounds)
    for i in range(rounds):
        trees[i], weights[i] = old.trees()[i], old.treeWeights()[i]
    made = jvm.org.apache.spark.ml.classification.GBTClassificationModel(whole.uid, trees, weights, whole.numFeatures, 2)
    cut = GBTClassificationModel(made)
    cut._resetUid(whole.uid)
    for param, value in whole.extractParamMap().items():
        cut._set(**{param.name: value})
    return PipelineModel(stages=[*model.stages[:-1], cut])


def contributions(model: PipelineModel, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """(*keep, base, log_odds, parts): ``parts`` holds (feature, contribution) for every feature, in the model's order; base and contributions add up to the log-odds.

    A feature gets, for every split on it along a row's path, the step of the tree's mean value there, so features no
    tree splits on get 0.
    """
    forest = forest_of(model)
    names = [c.removesuffix("_index") for c in model.stages[-2].getInputCols()]
    ready = _ready(model, rows, keep)
    schema = pa.list_(pa.struct([("feature", pa.string()), ("contribution", pa.float64())]))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            base, parts = forest.contributions(_matrix(batch.column(n_kept)))
            flat = pa.StructArray.from_arrays([pa.array(names * n, pa.string()), pa.array(parts.ravel())], ["feature", "contribution"])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * len(names), pa.int32()), flat).cast(schema)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n_kept], pa.array(np.full(n, base)), pa.array(base + parts.sum(axis=1)), lists], [*keep, "base", "log_odds", "parts"]
            )

    n_kept = len(keep)
    kinds = dict(ready.dtypes)
    wanted = ", ".join(f"`{c}` {kinds[c]}" for c in keep)
    return ready.mapInArrow(add, f"{wanted}, base double, log_odds double, parts array<struct<feature: string, contribution: double>>")


def top_contributions(model: PipelineModel, rows: DataFrame, key: str, k: int = 3) -> DataFrame:
    """(key, rank, feature, contribution, direction): each row's ``k`` features with the largest contributions either way;
    equal ones by name. A direction is that of the late probability."""
    found = contributions(model, rows, [key])
    by_size = "array_sort(parts, (a, b) -> CASE WHEN abs(a.contribution) > abs(b.contribution) THEN -1 WHEN abs(a.contribution) < abs(b.contribution) THEN 1 WHEN a.feature < b.feature THEN -1 WHEN a.feature > b.feature THEN 1 ELSE 0 END)"
    return found.selectExpr(key, f"posexplode(slice({by_size}, 1, {k})) AS (_pos, _f)").selectExpr(
        key, "_pos + 1 AS rank", "_f.feature AS feature", "_f.contribution AS contribution",
        "CASE WHEN _f.contribution >= 0 THEN 'increasing' ELSE 'decreasing' END AS direction",
    )


def top_impacts(model: PipelineModel, rows: DataFrame, baseline: DataFrame, key: str, k: int = 3) -> DataFrame:
    """(key, rank, feature, impact): each row's ``k`` features with the largest impacts on its late probability either way
    (see ``Forest.impacts``); equal ones by name. ``baseline`` is one row of features."""
    forest = forest_of(model)
    names = [c.removesuffix("_index") for c in model.stages[-2].getInputCols()]
    usual = np.array(_ready(model, baseline, []).first()["_x"])  # one number a feature
    ready = _ready(model, rows, [key])
    by_name = np.array(sorted(range(len(names)), key=lambda i: names[i].encode()))
    k = min(k, len(names))

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = pa.array(names, pa.string())
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            impacts = forest.impacts(_matrix(batch.column(1)).copy(), usual)[:, by_name]
            first = np.argsort(-np.abs(impacts), axis=1, kind="stable")[:, :k]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(np.arange(n), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                    texts.take(pa.array(by_name[first].ravel())), pa.array(np.take_along_axis(impacts, first, 1).ravel()),
                ],
                [key, "rank", "feature", "impact"],
            )

    return ready.mapInArrow(rank, f"`{key}` {dict(ready.dtypes)[key]}, rank int, feature string, impact double")
