import numpy as np
import pyarrow as pa

from orderlens.llm import quality as q
from orderlens.llm.common import utf8
from tests.llm.conftest import LONG


def test_statistics_of_one_text_do_not_depend_on_others():
    texts = ["a bb ccc.\nDD 12 | x", "", None, "x", " ", "naïve é", "the the the cat", LONG]
    together = q.statistics(*utf8(pa.array(texts)))
    for t, row in zip(texts, together):
        np.testing.assert_allclose(q.statistics(*utf8(pa.array([t], pa.string())))[0], row)
    name = dict(zip(q.STATISTICS, together[6]))
    assert abs(name["same_as_last"] - 0.5) < 1e-9 and abs(name["distinct_words"] - 0.5) < 1e-9


def test_isotonic_levels():
    total, good = np.array([0, 4, 4, 0, 4, 0.0]), np.array([0, 3, 1, 0, 4, 0.0])
    level = q.monotone(total, good)
    assert (np.diff(level) >= 0).all() and level[1] == level[2] and level[0] == level[1] and level[5] == level[4]
    assert (q.monotone(np.zeros(3), np.zeros(3)) == 0.5).all()


def test_held_out_accuracy_and_odd_rows(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (None, "a b"), (-3, LONG), (-3, LONG)], "doc_id long, text string")
    rows = docs.select("doc_id", "text").unionByName(odd)
    scored = q.score_documents(rows, labels)
    assert scored.count() == docs.count() + 5
    bad = scored.join(labels, "doc_id").where("predicted <> quality")
    assert bad.where("held_out").count() <= 0.02 * labels.count() and bad.count() <= 0.02 * labels.count()
    assert scored.where("score < 0 OR score > 1 OR score IS NULL OR predicted <> CAST(score >= 0.3 AS int)").count() == 0


def test_without_labels_and_without_rows(docs, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.predicted for r in q.score_documents(docs([(1, "a")]), none).collect()] == [1]
    assert q.score_documents(docs([]), none).collect() == []
    assert q.keep_good(docs([(1, "a"), (None, None)]), none).count() == 2
