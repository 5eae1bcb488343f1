"""Licence scan: sparse TF-IDF cosine to templates, then inheritance from the nearest directory.

Spans of consecutive words, wherever they stand in a text and over line ends, are compared with templates as sparse TF-IDF
vectors. A span begins and ends with a word of a template (others at its ends only lower the cosine) and has at most
twice the template's words. Document frequencies of all terms are counted over all files. By Cauchy's inequality a span can
only reach the threshold if the template's words in it hold that part of the template's norm; few spans do, and only
those leave their task, equal ones as one row before they meet the templates in a join on terms. A file
without a licence of its own takes that of the nearest licence file above it: a join of its directories with the
directories of licence files.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import bounded_batches, settle, text_of

# Licence, statement.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("proprietary", "All rights reserved."),
)
LICENSE_FILES = r"(?i)(^|/)(licen[cs]e|copying|notice)[^/]*$"
THRESHOLD = 0.8


_TERM = re.compile(r"[a-z]+|[0-9]+(?:\.[0-9]+)*")
_MOST_TERMS = 500_000


def _terms(text: str | None) -> list[str]:
    """Words and numbers, version numbers whole, lower-cased."""
    return _TERM.findall((text or "").lower())


def _frequencies(texts: DataFrame) -> DataFrame:
    """(term, files): in how many rows of ``texts`` each term stands; the empty term stands for all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flushed() -> pa.RecordBatch:
            found = [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())]
            seen.clear()
            return pa.RecordBatch.from_arrays(found, ["term", "files"])

        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column("text"):
                seen.update({"", *_terms(text.as_py())})
                if len(seen) > _MOST_TERMS:
                    yield flushed()
        if seen:
            yield flushed()

    return texts.select("text").mapInArrow(run, "term string, files long").groupBy("term").agg(F.sum("files").alias("files"))


def _spans(terms: list[str], templates: list[tuple[dict, frozenset, float, int]]) -> set[str]:
    """Spans that can reach the threshold. A template: weight of each of its words, words of which each span
    needs one, the weight that a span needs, and the longest span."""
    found = set()
    have = set(terms)
    for squares, anchors, need, most in templates:
        if not have & anchors or sum(squares[w] for w in squares.keys() & have) < need:
            continue
        at = [i for i, w in enumerate(terms) if w in squares]
        for x, i in enumerate(at):
            held, total = set(), 0.0
            for j in at[x:]:
                if j - i >= most:
                    break
                if terms[j] not in held:
                    held.add(terms[j])
                    total += squares[terms[j]]
                if total >= need:
                    found.add(" ".join(terms[i : j + 1]))
    return found


def _candidates(texts: DataFrame, templates: list[tuple[dict, frozenset, float, int]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, spans = [], []
            for row, text in enumerate(batch.column("text")):
                found = _spans(_terms(text.as_py()), templates)
                rows += [row] * len(found)
                spans += found
            paths = batch.column("path").take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([paths, pa.array(spans, pa.string())], ["path", "span"])

    return texts.mapInArrow(run, "path string, span string")


def scan_texts(
    files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, path_col: str = "path", text_col: str = "text"
) -> DataFrame:
    """(path, license, score): each file's best template over all spans of its text, files without a match left out.

    Document frequencies, of foreign terms as well, are counted over all files and smoothed by one.
    """
    spark = files.sparkSession
    bounded_batches(spark)
    texts = files.select(F.col(path_col).cast("string").alias("path"), text_of(text_col).alias("text"))
    words_of = [(i, w, n) for i, (_, statement) in enumerate(templates) for w, n in Counter(_terms(statement)).items()]
    vocabulary = sorted({w for _, w, _ in words_of})
    counts = settle(_frequencies(texts), "terms")
    seen = {r["term"]: r["files"] for r in counts.where(F.col("term").isin(["", *vocabulary])).collect()}
    total = seen.get("", 0)
    idf = {t: math.log((total + 1.0) / (seen.get(t, 0) + 1.0)) + 1.0 for t in vocabulary}
    wanted, theirs = [], []
    for i, (name, statement) in enumerate(templates):
        squares = {w: (n * idf[w]) ** 2 for t, w, n in words_of if t == i}
        norm = math.sqrt(sum(squares.values()))
        need = threshold**2 * norm**2 * (1 - 1e-9)
        # The heaviest words without which what is left cannot reach the threshold.
        anchors, left = set(), norm**2
        for w in sorted(squares, key=lambda w: (-squares[w], w)):
            if left < need:
                break
            anchors.add(w)
            left -= squares[w]
        wanted.append((squares, frozenset(anchors), need, 2 * len(_terms(statement))))
        theirs += [(i, name, w, n * idf[w], norm) for t, w, n in words_of if t == i]
    spans = settle(_candidates(texts, wanted), "spans")
    terms = spans.select("span").distinct().select("span", F.explode(F.split("span", " ")).alias("term"))
    terms = settle(terms.groupBy("span", "term").agg(F.count("*").alias("n")), "words")
    known = settle(counts.join(terms.select("term").distinct(), "term", "left_semi"), "known")
    weight = F.log((F.lit(total) + 1.0) / (F.col("files") + 1.0)) + 1.0
    ours = terms.join(known, "term").select("span", "term", (F.col("n") * weight).alias("w"))
    norms = ours.groupBy("span").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    theirs = spark.createDataFrame(theirs, "t int, license string, term string, v double, t_norm double")
    dots = ours.join(F.broadcast(theirs), "term").groupBy("span", "t", "license", "t_norm").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    cosine = F.round(F.col("dot") / (F.col("norm") * F.col("t_norm")), 9)
    close = dots.join(norms, "span").withColumn("score", cosine).where(F.col("score") >= threshold)
    best = close.groupBy("span").agg(F.max(F.struct("score", F.negative("t").alias("_t"), "license")).alias("b"))
    best = settle(best.select("span", "b.score", "b.license", F.col("b._t")), "licences")
    hits = spans.join(best, "span").groupBy("path").agg(F.max(F.struct("score", "_t", "license")).alias("b"))
    return hits.select("path", "b.license", "b.score")


def scan_licenses(
    files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, path_col: str = "path",
    text_col: str = "text", keep: tuple[str, ...] = (), license_files: str = LICENSE_FILES,
) -> DataFrame:
    """One row per row of ``files``: path, license, score, found_in, origin and ``keep``.

    origin is ``own`` (a span of the file is a licence statement), ``inherited`` (the nearest directory at or above the file that
    holds a licence file with a match; of several such files the one of the highest score, then the first path) or
    ``none``. A null text is empty, a null path lies nowhere and inherits nothing; repeated paths share the
    best match of their rows; extra columns do not matter; an empty table gives no rows.
    """
    rows = files.select(F.col(path_col).alias("path"), F.col(text_col).alias("_text"), *[F.col(c).alias(f"_col_{c}") for c in keep])
    own = settle(scan_texts(rows, templates, threshold, "path", "_text"), "own")
    return inherited(rows.drop("_text"), own, license_files).select(
        "path", "license", "score", "found_in", "origin", *[F.col(f"_col_{c}") for c in keep]
    )


def inherited(rows: DataFrame, own: DataFrame, license_files: str = LICENSE_FILES) -> DataFrame:
    """``rows`` (path, more) with license, score, found_in and origin, given the files' own matches (path, license, score)."""
    folder = F.regexp_replace("path", r"/?[^/]*$", "")
    givers = own.where(F.regexp_like("path", F.lit(license_files))).select(folder.alias("folder"), "license", "score", "path")
    by_folder = Window.partitionBy("folder").orderBy(F.desc("score"), "path")
    givers = givers.withColumn("_k", F.row_number().over(by_folder)).where("_k = 1").drop("_k")
    # Only folders climb, each once, not files: all ancestors of a folder, itself included.
    names = F.split("folder", "/")
    folders = rows.select(folder.alias("folder")).where("folder IS NOT NULL").distinct()
    depth = F.when(F.col("folder") == "", 0).otherwise(F.size(names))
    above = folders.select("folder", F.explode(F.sequence(F.lit(0), depth)).alias("depth"), names.alias("_names"))
    above = above.select("folder", "depth", F.array_join(F.slice("_names", F.lit(1), F.col("depth")), "/").alias("above"))
    g = givers.select(F.col("folder").alias("above"), "license", "score", F.col("path").alias("found_in"))
    nearest = above.join(g, "above").groupBy("folder").agg(F.max(F.struct("depth", "license", "score", "found_in")).alias("i"))
    mine = own.select("path", F.struct("license", "score").alias("o"))
    joined = rows.withColumn("folder", folder).join(mine, "path", "left").join(nearest, "folder", "left")
    return joined.select(
        *rows.columns,
        F.coalesce("o.license", "i.license").alias("license"),
        F.coalesce("o.score", "i.score").alias("score"),
        F.when(F.col("o").isNotNull(), F.col("path")).otherwise(F.col("i.found_in")).alias("found_in"),
        F.when(F.col("o").isNotNull(), "own").when(F.col("i").isNotNull(), "inherited").otherwise("none").alias("origin"),
    )
