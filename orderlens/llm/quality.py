"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Statistics of a whole text (shares of kinds of characters, word lengths, repetition) are standardised and mapped to
cosine features that approximate a Gaussian kernel. Each partition sums its part of the normal equations; the
sums are added up row by row of the matrix, so the driver gets one matrix of fixed size. Scores of labelled
documents that took no part in the fit are pooled in fixed bins and made monotone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import bounded_batches, settle, slices, utf8
from orderlens.sources.staging import broadcast_if_small

FEATURES = 256
BINS = 1024
THRESHOLD = 0.3
STATISTICS = (
    "log_bytes", "log_words", "letters", "upper", "digits", "spaces", "newlines", "pipes", "marks", "other_ascii",
    "beyond_ascii", "word_length", "word_length_spread", "same_as_last", "distinct_words", "marked_words", "upper_words",
    "pipe_words", "bytes_per_line",
)

_KIND = np.full(256, 8, np.uint8)  # beyond ASCII
_KIND[:128] = 7  # other ASCII
_KIND[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 6  # marks
_KIND[[9, 11, 12, 13, 32]] = 3
_KIND[10] = 4
_KIND[124] = 5  # pipe
_KIND[48:58] = 2
_KIND[65:91] = 1
_KIND[97:123] = 0
_SIMPLE = np.zeros(256, bool)  # sentence marks, not counted against a word
_SIMPLE[[33, 39, 44, 45, 46, 58, 59, 63, 34, 40, 41]] = True


def statistics(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row of STATISTICS per text; ``raw`` holds all texts' UTF-8 bytes, ``at`` their offsets. Empty texts: zeros."""
    n = len(at) - 1
    out = np.zeros((n, len(STATISTICS)))
    size = np.diff(at)
    full = size > 0
    if not full.any():
        return out
    starts = at[:-1][full]
    length = size[full].astype(float)
    kind = _KIND[raw]

    def total(values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, starts, dtype=np.int64).astype(float)

    counts = [total(kind == k) for k in range(9)]
    blank = (kind == 3) | (kind == 4)
    edge = np.zeros(len(raw) + 1, bool)
    edge[at[:-1]] = True
    before = np.concatenate([[True], blank[:-1]]) | edge[:-1]
    begin = np.flatnonzero(~blank & before)
    after = np.concatenate([blank[1:], [True]]) | np.concatenate([edge[1:-1], [True]])
    end = np.flatnonzero(~blank & after) + 1
    doc = np.searchsorted(at, begin, "right") - 1
    doc = np.searchsorted(np.flatnonzero(full), doc)
    m = int(full.sum())
    words = np.bincount(doc, minlength=m).astype(float)
    some = np.maximum(words, 1)
    if len(begin):
        long = (end - begin).astype(float)
        # A word's hash: its bytes weighted by powers of an odd number, taken from running sums.
        place = np.arange(len(raw), dtype=np.uint64)
        weight = _SCRAMBLE[raw] * (place * np.uint64(2) + np.uint64(1))
        running = np.concatenate([[np.uint64(0)], np.cumsum(weight, dtype=np.uint64)])
        flat = np.concatenate([[np.uint64(0)], np.cumsum(_SCRAMBLE[raw], dtype=np.uint64)])
        word = running[end] - running[begin] - (flat[end] - flat[begin]) * (begin.astype(np.uint64) * np.uint64(2))
        word = word * np.uint64(0x9E3779B97F4A7C15) + long.astype(np.uint64)
        again = np.concatenate([[False], (word[1:] == word[:-1]) & (doc[1:] == doc[:-1])])
        order = np.lexsort((word, doc))
        w, d = word[order], doc[order]
        first = np.concatenate([[True], (w[1:] != w[:-1]) | (d[1:] != d[:-1])])
        odd = (kind == 6) & ~_SIMPLE[raw]
        sums = np.concatenate([[0], np.cumsum(odd)])
        marked = (sums[end] - sums[begin]) > 0
        sums = np.concatenate([[0], np.cumsum(kind == 1)])
        upper = (sums[end] - sums[begin]) * 2 > long
        by = lambda v: np.bincount(doc, weights=v, minlength=m)
        mean = by(long) / some
        spread = np.sqrt(np.maximum(by(long * long) / some - mean * mean, 0))
        repeated, distinct = by(again) / some, np.bincount(d, weights=first, minlength=m) / np.sqrt(some)
        marked, upper, pipes = by(marked) / some, by(upper) / some, by(raw[begin] == 124) / some
    else:
        mean = spread = repeated = distinct = marked = upper = pipes = np.zeros(m)
    columns = [
        np.log1p(length), np.log1p(words), *[c / length for c in (counts[0], *counts[1:9])],
        mean, spread, repeated, distinct / np.sqrt(some), marked, upper, pipes, np.log1p(length / (counts[4] + 1)),
    ]
    out[full] = np.column_stack([np.log1p(c) if i in (11, 12) else c for i, c in enumerate(columns)])
    return out


_SCRAMBLE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, stats) per row; a null text counts as empty."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                rows = statistics(*utf8(batch.column(1)))
                flat = pa.array(rows.astype(np.float32).ravel())
                offsets = pa.array(np.arange(len(rows) + 1) * len(STATISTICS), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.ListArray.from_arrays(offsets, flat)], ["doc_id", "stats"]
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, stats array<float>")


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    levels: np.ndarray  # calibrated value of each bin of the raw score

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -6, 6)
        wave = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.column_stack([np.ones(len(z)), wave])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated score from 0 to 1; a small part of the raw score keeps the order within a level."""
        raw = np.clip(self.raw(stats), -0.5, 1.5) + 0.5
        centres = (np.arange(len(self.levels)) + 0.5) * 2 / len(self.levels)
        return 0.99 * np.interp(raw, centres, self.levels) + 0.01 * raw / 2


def _stack(column: pa.Array) -> np.ndarray:
    return column.values.to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS)).astype(float)


def monotone(total: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Isotonic regression of good/total over ordered bins; bins without rows take their neighbours' level."""
    blocks: list[list[float]] = []
    for i in np.flatnonzero(total):
        blocks.append([float(good[i]), float(total[i]), i, i])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            g, t, _, last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + g, blocks[-1][1] + t, blocks[-1][2], last]
    if not blocks:
        return np.full(len(total), 0.5)
    at = np.concatenate([[b[2], b[3]] for b in blocks])
    level = np.repeat([(b[0] + 0.5) / (b[1] + 1) for b in blocks], 2)
    return np.interp(np.arange(len(total)), at, np.maximum.accumulate(level))


def fit(labelled: DataFrame, features: int = FEATURES, ridge: float = 1e-4, bins: int = BINS, seed: int = 11) -> Model:
    """Fit on rows (doc_id, stats, label 0/1): four of five for the ridge, the fifth for the calibration."""
    labelled = labelled.withColumn("_fold", F.pmod(F.xxhash64("doc_id"), F.lit(5)))
    k = len(STATISTICS)
    moments = labelled.agg(
        *[F.avg(F.col("stats")[i].cast("double")).alias(f"m{i}") for i in range(k)],
        *[F.stddev_pop(F.col("stats")[i].cast("double")).alias(f"s{i}") for i in range(k)],
    ).first()
    mean = np.array([moments[f"m{i}"] or 0.0 for i in range(k)])
    scale = np.array([moments[f"s{i}"] or 0.0 for i in range(k)])
    scale[scale < 1e-9] = 1.0
    rng = np.random.default_rng(seed)
    directions = rng.normal(size=(k, features)) / np.sqrt(k)
    phases = rng.uniform(0, 2 * np.pi, features)
    model = Model(mean, scale, directions, phases, np.zeros(features + 1), np.zeros(bins))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((features + 1, features + 2))
        for batch in batches:
            z = model.features(_stack(batch.column(0)))
            y = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
            gram += z.T @ np.column_stack([z, y])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(features + 1)), pa.array([r.tobytes() for r in gram])], ["i", "v"]
        )

    def add(rows: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(v) for v in rows.column("v").to_pylist()], axis=0)
        return pa.table({"i": rows.column("i")[:1], "v": pa.array([total.tobytes()], pa.binary())})

    parts = labelled.where("_fold <> 0").select("stats", "label").mapInArrow(sums, "i long, v binary")
    summed = parts.groupBy("i").applyInArrow(add, "i long, v binary").orderBy("i").collect()
    if summed:
        whole = np.array([np.frombuffer(r["v"]) for r in summed])
        gram, target = whole[:, :-1], whole[:, -1]
        penalty = ridge * max(gram[0, 0], 1.0) * np.eye(features + 1)
        penalty[0, 0] = 1e-9
        model = Model(mean, scale, directions, phases, np.linalg.solve(gram + penalty, target), model.levels)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.clip(model.raw(_stack(batch.column(0))), -0.5, 1.5) + 0.5
            at = np.minimum((raw * bins / 2).astype(np.int64), bins - 1)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column(1)], ["bin", "label"])

    held = labelled.where("_fold = 0").select("stats", F.col("label").cast("long").alias("label"))
    counted = held.mapInArrow(binned, "bin long, label long").groupBy("bin").agg(
        F.count("*").alias("n"), F.sum("label").alias("good")
    )
    total, good = np.zeros(bins), np.zeros(bins)
    for r in counted.collect():  # at most one row per bin
        total[r["bin"]], good[r["bin"]] = r["n"], r["good"]
    return Model(mean, scale, directions, phases, model.weights, monotone(total, good))


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(5)) == 0


def score_documents(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Labels of held-out documents (crc32 of the id as text is a multiple of 5) and null labels are not learnt from. A null
    text counts as empty. Repeated rows, also of labels, count each. Without any label to learn from the score is
    0.5; an empty table gives no rows; extra columns do not matter.
    """
    stats = settle(document_statistics(docs, id_col, text_col), "statistics")
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col(label_col).cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & F.col("_id").isNotNull() & ~held_out(F.col("_id")))
    labelled = settle(stats.join(known, stats.doc_id == known._id).select("doc_id", "stats", "label"), "labelled")
    model = fit(labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = pa.array(model.score(_stack(batch.column(1))) if batch.num_rows else np.zeros(0))
            yield pa.RecordBatch.from_arrays([batch.column(0), score], ["doc_id", "score"])

    scored = stats.mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents that the classifier rejects, all columns as they were; rows without an id stay."""
    bad = score_documents(docs, labels).where("predicted = 0 AND doc_id IS NOT NULL").select("doc_id").distinct()
    bad = broadcast_if_small(bad, "rejected").withColumnRenamed("doc_id", "_bad")
    return docs.join(bad, docs["doc_id"] == F.col("_bad"), "left_anti")
