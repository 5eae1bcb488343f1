import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from orderlens.operators.ordered import SkewPolicy, find_cuts, with_history

CUT = SkewPolicy(rows_per_task=150, sample=0.6)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(7)
    n = 6000
    frame = pd.DataFrame(
        {
            "k": np.where(rng.random(n) < 0.4, "hot", rng.integers(0, 40, n).astype(str)),
            "t": rng.integers(0, 300, n),
            "id": [f"{i:05d}" for i in rng.permutation(n)],
            "v": rng.integers(0, 5, n),
        }
    )
    frame.loc[rng.random(n) < 0.03, "k"] = None
    return frame


def _expected(frame):
    g = frame.sort_values(["k", "t", "id"]).copy()
    by = g.groupby("k")
    g["so_far"] = by["v"].cumsum() - g["v"]
    g["last_few"] = by["v"].transform(lambda x: x.shift().rolling(5, min_periods=0).sum()).fillna(0)
    g["last_t"] = by["t"].shift()
    g["rows"] = by["v"].transform("size")
    return g.sort_values("id").reset_index(drop=True)


@pytest.mark.parametrize("policy", [SkewPolicy(), CUT], ids=["plain", "cut"])
def test_history_equals_brute_force(spark, rows, policy):
    df = spark.createDataFrame(rows).repartition(6)
    out = with_history(
        df, ["k"], ["t", "id"],
        before={"so_far": "v"}, recent={"last_few": "v"}, previous={"last_t": "t"}, total={"rows": "1"}, policy=policy,
    ).toPandas().sort_values("id").reset_index(drop=True)
    expected = _expected(rows)
    assert len(out) == len(rows)
    known = expected["k"].notna()
    for column in ("so_far", "last_few", "last_t", "rows"):
        left = out.loc[known, column].astype(float).fillna(-1)
        right = expected.loc[known, column].astype(float).fillna(-1)
        assert (left == right).all(), column
        assert out.loc[~known, column].isna().all()


def test_parts_with_fewer_rows_than_the_look_back(spark):
    df = spark.createDataFrame([("a", i, i) for i in range(40)], "k string, t int, v int")
    tiny = SkewPolicy(rows_per_task=2, sample=1.0, points_per_cut=2)
    assert find_cuts(df, ["k"], ["t"], tiny).count() > 10
    out = with_history(df, ["k"], ["t"], recent={"s": "v"}, previous={"p": "v"}, policy=tiny).orderBy("t").collect()
    assert [r["s"] for r in out] == [sum(range(max(0, i - 5), i)) for i in range(40)]
    assert [r["p"] for r in out] == [None, *range(39)]


def test_hot_key_is_spread_over_parts(spark, rows):
    cuts = find_cuts(spark.createDataFrame(rows), ["k"], ["t", "id"], CUT)
    assert cuts.where("k = 'hot'").count() >= 10
    assert cuts.groupBy("k", "_part").count().where("count > 1").isEmpty()


def test_no_look_for_hot_keys_where_none_can_be(spark, rows):
    df = spark.createDataFrame(rows)
    assert find_cuts(df, ["k"], ["t"], SkewPolicy(), at_most=len(rows)) is None
    assert find_cuts(df, ["k"], ["t"], SkewPolicy()) is None


def test_rows_without_key_are_spread(spark):
    df = spark.range(1000).selectExpr("CAST(NULL AS string) AS k", "id AS t")
    out = with_history(df, ["k"], ["t"], before={"n": "1"})
    assert out.where(F.col("n").isNull()).count() == 1000
