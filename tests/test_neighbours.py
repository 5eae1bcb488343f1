import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.operators import neighbours as nb
from orderlens.operators.ordered import SkewPolicy


def psi(n):
    return sum(1.0 / i for i in range(1, n)) - 0.57721566490153286


def brute(rows, column, k=3):
    """rows: (key, label, {column: value}); distances to all rows."""
    kept = [(r[1], r[2][column], r[0]) for r in rows]
    x = np.array([v + (int(hashlib.md5(i.encode()).hexdigest()[:8], 16) / 4294967296.0 - 0.5) * 1e-9 * max(1.0, abs(v)) for _, v, i in kept])
    y = np.array([str(label) for label, _, _ in kept])
    use = np.array([(y == v).sum() > k for v in y])
    x, y = x[use], y[use]
    total = 0.0
    for i in range(len(x)):
        mine = np.sort(np.delete(np.abs(x[y == y[i]] - x[i]), np.flatnonzero(np.flatnonzero(y == y[i]) == i)))
        radius = mine[k - 1]
        away = np.abs(x - x[i])
        m = int((away < radius).sum()) if radius > 0 else int((away <= 0).sum())
        total += psi(len(x)) + psi(k) - psi(int((y == y[i]).sum())) - psi(m)
    return max(0.0, total / len(x))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    out = []
    for i in range(400):
        late = int(rng.random() < 0.3)
        out.append((f"o{i}", late, {"a": float(rng.normal(2 * late)), "b": float(rng.integers(0, 6) + 3 * late), "c": float(rng.normal()), "d": 1.0}))
    return [*out, ("rare", 7, {"a": 0.0, "b": 0.0, "c": 0.0, "d": 0.0})]


@pytest.mark.parametrize("block,policy", [(100_000, SkewPolicy()), (7, SkewPolicy()), (11, SkewPolicy(50, 1.0))], ids=["plain", "blocks", "cut"])
def test_same_as_all_distances(spark, rows, block, policy):
    df = spark.createDataFrame([(i, y, *v.values()) for i, y, v in rows] + [("gap", 1, None, 1.0, 1.0, 1.0)], "order_id string, is_late int, a double, b double, c double, d double")
    found = {r["column"]: r for r in nb.neighbour_information(df, list("abcd"), "is_late", ["order_id"], block_rows=block, policy=policy).collect()}
    assert {r["rows"] for r in found.values()} == {400}
    for c in "abcd":
        assert found[c]["information"] == pytest.approx(brute(rows, c), abs=1e-9)
    assert found["a"]["information"] > found["c"]["information"]


def test_digamma(spark):
    n = [1, 2, 3, 7, 50, 12345, 10**9]
    got = spark.createDataFrame([(x,) for x in n], "n long").select("n", nb.digamma(F.col("n")).alias("p")).collect()
    for r in got:
        expected = psi(r["n"]) if r["n"] < 10**6 else math.log(r["n"]) - 0.5 / r["n"]
        assert r["p"] == pytest.approx(expected, abs=1e-12)


def test_few_rows(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("b", 1, 2.0), ("c", 1, None)], "order_id string, is_late int, x double")
    assert nb.neighbour_information(df, ["x"], "is_late", ["order_id"]).collect() == []
    assert nb.neighbour_information(df.limit(0), ["x"], "is_late", ["order_id"]).collect() == []
