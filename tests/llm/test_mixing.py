import math

import numpy as np
import pytest

from orderlens.llm import mixing
from tests.llm.conftest import LONG

SCHEMA = "doc_id long, text string, source string, size int, target string, s int, class int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, 7, "x", 1, 2) for i, t, s in rows], SCHEMA)


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    """Sources (already in order) to targets: reshare what is above the limit until nothing is."""
    total, open_, held = sum(sizes), set(range(len(sizes))), 0
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    out = [0.0] * len(sizes)
    while open_:
        theta = (total - held) / sum(w[i] for i in open_)
        above = {i for i in open_ if w[i] * theta > most * sizes[i]}
        if not above:
            for i in open_:
                out[i] = w[i] * theta
            break
        for i in above:
            out[i] = most * sizes[i]
            held += most * sizes[i]
        open_ -= above
    return out


def brute_rates(sizes, target, most=3):
    """min(most, exp(a * size)) with the words of the target, by bisection."""
    sizes = np.array(sizes, float)
    if target >= most * sizes.sum():
        return np.full(len(sizes), float(most))
    lo, hi = -50.0, 50.0
    for _ in range(300):
        a = (lo + hi) / 2
        rate = np.exp(np.minimum(a * sizes, math.log(most)))
        lo, hi = (a, hi) if (rate * sizes).sum() < target else (lo, a)
    return rate


def check(rows, got):
    names = sorted({s for _, _, s in rows if s is not None}, key=lambda s: s.encode()) + [None] * any(s is None for _, _, s in rows)
    sizes = [[len([w for w in (t or "").replace("\t", " ").replace("\n", " ").split(" ") if w]) for _, t, s in rows if s == n] for n in names]
    targets = brute_targets([sum(x) for x in sizes])
    assert len(got) == len(rows)
    for name, each, target in zip(names, sizes, targets, strict=True):
        mine = [r for r in got if r.source == name]
        assert sorted(r["size"] for r in mine) == sorted(each)
        assert all(r.source_size == sum(each) and math.isclose(r.target, target, abs_tol=1e-9) for r in mine)
        some = sorted((x for x in each if x), reverse=False)
        if not some:
            assert all(r.copies == 1 for r in mine)
            continue
        expected = dict(zip(some, brute_rates(some, target), strict=True))
        for r in mine:
            if r["size"]:
                assert math.isclose(r.rate, expected[r["size"]], rel_tol=1e-6, abs_tol=1e-6)
            assert 0 <= r.copies <= 3 and abs(r.copies - r.rate) <= 1.000001
        taken = sum(r["size"] * r.copies for r in mine)
        assert abs(taken - target) <= (0.001 * target if len(each) > 400 else 0.02 * target + max(some) / 2) + 1


def test_documents_meet_brute_force(spark, sf):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    first, again = (sorted(mixing.mix(frame(spark, x)).collect()) for x in (rows, rows[::-1]))
    check(rows, first)
    assert first == again


def test_one_hot_source_and_capped_sources(spark):
    rows = [(i, "w " * (1 + i % 50), "a") for i in range(3000)]
    rows += [(10_000 + i, "v\tu " * (1 + i % 7), name) for i, name in enumerate("bcdé\U0001f600" * 30)] + [(20_000 + i, "x y z", None) for i in range(40)]
    check(rows, mixing.mix(frame(spark, rows)).collect())


def test_nulls_empty_long_and_repeated_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (None, "a b", "a"), (None, "a b", "a"), (4, LONG, "b"), (5, "q", "b"), (5, "q", "b"), (6, None, None), (7, "one two", "")]
    got = mixing.mix(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    alike = [r.copies for r in got if r.doc_id == 5]
    assert alike[0] == alike[1]
    assert {r["size"] for r in got if r.doc_id == 4} == {30_000}
    assert {(r.target, r.copies) for r in got if r.doc_id == 6} == {(0.0, 1)}
    by = {r.source: r.target for r in got}
    assert math.isclose(sum(by.values()), sum({r.source: r.source_size for r in got}.values()))
    assert mixing.mix(frame(spark, [])).collect() == []
    assert {r.copies for r in mixing.mix(frame(spark, [(1, None, "a"), (2, " ", None)])).collect()} == {1}


def test_words_are_counted_as_the_pattern_says(spark):
    texts = ["a b c", "\x1c \x1f", "\x0b\x0c\r\n\t", "日本 語", "\U0001f600", "x" * 5000]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in df.select(mixing.words(df.text)).collect()] == [2, 2, 0, 2, 1, 1]


def test_the_mixture_holds_every_row_as_often_as_its_copies(spark):
    rows = [(i, "w " * (1 + i % 9), "ab"[i % 5 == 0]) for i in range(200)] + [(None, "k", None)]
    docs = frame(spark, rows)
    plan = {(r.doc_id, r.source): r.copies for r in mixing.mix(docs).collect()}
    mixed = mixing.mixture(docs)
    assert mixed.columns == docs.columns
    counts = {(r.doc_id, r.source): r["count"] for r in mixed.groupBy("doc_id", "source").count().collect()}
    assert counts == {k: n for k, n in plan.items() if n}


def test_no_python_on_the_path(spark, sf):
    plan = mixing.mix(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "ExistingRDD"))


@pytest.mark.parametrize("sizes", [[5], [0, 0], [1, 10, 100], [100, 1, 1, 1], [3, 3, 3, 0]])
def test_targets_reshare_until_none_is_above(spark, sizes):
    df = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    assert [got[f"s{i}"] for i in range(len(sizes))] == pytest.approx(brute_targets(sizes))
