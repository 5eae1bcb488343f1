import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.operators import distribution as dist


@pytest.fixture(scope="module")
def numbers():
    rng = np.random.default_rng(3)
    return np.round(rng.lognormal(3, 1, 3000), 2)


@pytest.fixture(scope="module")
def counts(spark, numbers):
    rows = [(float(v), int(i % 3 == 0)) for i, v in enumerate(numbers)] + [(None, 1), (float("nan"), 0)]
    return dist.value_rows(spark.createDataFrame(rows, "x double, label int"), ["x"])


LEVELS = [0.0, 0.25, 1 / 3, 0.5, 0.995, 1.0]


@pytest.mark.parametrize("most", [dist.RANKED_ROWS, 100, 3], ids=["at once", "cells", "narrow cells"])
def test_quantiles_equal_numpy(counts, numbers, most):
    found = {r["level"]: r["value"] for r in dist.quantiles(counts, LEVELS, most=most).collect()}
    for level in LEVELS:
        assert found[level] == pytest.approx(np.quantile(numbers, level), abs=1e-9)


def test_a_poor_sketch_only_costs_rounds(spark, monkeypatch):
    """Edges far from the wanted ranks leave wide cells, which the next rounds cut evenly."""
    rng = np.random.default_rng(5)
    groups = {"a": rng.lognormal(0, 6, 2000), "b": np.r_[np.zeros(900), rng.normal(0, 1e-9, 100), [-1e18, 1e18]], "c": np.full(500, 7.5), "d": np.array([2.0])}
    df = spark.createDataFrame([(k, float(v)) for k, values in groups.items() for v in values], "g string, x double")
    rows = dist.value_rows(df, ["x"], by=["g"])
    far = lambda rows, levels, key: rows.groupBy(*key).agg(
        F.lit(0).alias("_cell"), F.sum("n").alias("_n"), F.min("value").alias("_min"), F.max("value").alias("_max"), F.array(F.lit(-1e300), F.lit(1e300)).alias("_edges")
    )
    monkeypatch.setattr(dist, "_sketch", far)
    found = {(r["g"], r["level"]): r["value"] for r in dist.quantiles(rows, LEVELS, by=["g"], most=20).collect()}
    assert len(found) == len(groups) * len(LEVELS)
    for (g, level), value in found.items():
        assert value == pytest.approx(np.quantile(groups[g], level), rel=1e-12, abs=1e-300)


def test_quantiles_with_infinite_values(spark):
    df = spark.createDataFrame([(float("inf"),)] * 5 + [(float("-inf"),)] * 5 + [(float(i),) for i in range(91)], "x double")
    found = [r["value"] for r in dist.quantiles(dist.value_rows(df, ["x"]), [0.25, 0.5, 0.75], most=4).orderBy("level").collect()]
    assert found == [20.0, 45.0, 70.0]


def test_quantiles_shuffle_no_values(spark):
    """Only the cells' counts and the rows inside the last cells go through an exchange."""
    rows = dist.value_rows(spark.range(20_000).selectExpr("id % 997 * 1.5D AS x"), ["x"])
    found = dist.quantiles(rows, [0.25, 0.75], most=200)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(column" in plan and "BroadcastHashJoin" in plan and "rangepartitioning" not in plan
    by_value = [x for x in plan.split("\n") if "Exchange hashpartitioning(" in x and "value" in x.split("Exchange")[1]]
    assert all("level" in x for x in by_value)
    assert dist.quantiles(rows.where("n > 1"), [0.5]).collect() == []


def test_histogram_equals_numpy(counts, numbers):
    expected, edges = np.histogram(numbers, bins=50)
    found = dist.histogram(counts, 50).orderBy("bin").collect()
    assert [r["rows"] for r in found] == expected.tolist()
    assert found[0]["bin_from"] == pytest.approx(edges[0]) and found[-1]["bin_to"] == pytest.approx(edges[-1])


def test_histogram_of_one_value(spark):
    counts = dist.value_rows(spark.createDataFrame([(2.0,), (2.0,)], "x double"), ["x"])
    found = dist.histogram(counts, 4).orderBy("bin").collect()
    assert [r["rows"] for r in found] == [0, 0, 2, 0]


def test_box_and_outliers(counts, numbers):
    box = dist.box_stats(counts).first()
    q1, q3 = np.quantile(numbers, [0.25, 0.75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    inside = numbers[(numbers >= low) & (numbers <= high)]
    assert box["whisker_low"] == inside.min() and box["whisker_high"] == inside.max()
    assert box["outliers"] == len(numbers) - len(inside)


def test_density_equals_direct_sum(counts, numbers):
    h = len(numbers) ** -0.2 * numbers.std(ddof=1)
    grid = np.linspace(numbers.min() - 3 * h, numbers.max() + 3 * h, 50)
    direct = np.exp(-0.5 * ((grid[:, None] - numbers) / h) ** 2).sum(axis=1) / (len(numbers) * h * np.sqrt(2 * np.pi))
    found = dist.density(counts, points=50).orderBy("point").collect()
    assert np.allclose([r["x"] for r in found], grid)
    assert np.allclose([r["density"] for r in found], direct)


def test_density_of_large_values_with_a_small_spread(spark):
    rows = [(1e9 + i * 1e-3, 0) for i in range(100)]
    counts = dist.value_rows(spark.createDataFrame(rows, "x double, label int"), ["x"])
    found = [r["density"] for r in dist.density(counts, points=20).collect()]
    assert len(found) == 20 and all(0 <= d < 100 for d in found) and max(found) > 1


def test_density_work_does_not_grow_with_values(spark):
    """Many distinct values share the cells of a bandwidth; far points and far values keep their places."""
    rng = np.random.default_rng(9)
    values = np.r_[rng.normal(0, 1, 20_000), [40.0]]
    rows = dist.value_rows(spark.createDataFrame([(float(v),) for v in values], "x double"), ["x"])
    found = dist.density(rows, points=60, reach=0.0).orderBy("point").collect()
    h = len(values) ** -0.2 * values.std(ddof=1)
    grid = np.linspace(values.min(), values.max(), 60)
    direct = np.exp(-0.5 * ((grid[:, None] - values) / h) ** 2).sum(axis=1) / (len(values) * h * np.sqrt(2 * np.pi))
    assert np.allclose([r["density"] for r in found], direct, rtol=1e-9, atol=2e-15 / h)


def test_hermite_polynomials():
    for k, f in enumerate([lambda u: 1, lambda u: u, lambda u: u * u - 1, lambda u: u**3 - 3 * u, lambda u: u**4 - 6 * u * u + 3]):
        for u in (-2.0, 0.0, 0.3, 1.7):
            assert eval(dist._hermite(k, "u").replace("D", "")) == pytest.approx(f(u))


@pytest.mark.parametrize("most", [dist.RANKED_ROWS, 100], ids=["between edges", "edges that hold too much"])
@pytest.mark.parametrize("level", [1 / 3, 0.995, 1.0])
def test_quantiles_of_columns_equal_numpy(spark, numbers, most, level):
    """NULL and NaN left out, ties, a constant, one value, no value, infinite ends."""
    ties = np.floor(numbers / 20)
    ends = np.r_[-np.inf, numbers[:100], np.inf]
    columns = {"x": numbers, "t": ties, "c": np.full(700, 2.5), "one": np.array([-1.0]), "none": np.array([])}
    if most == dist.RANKED_ROWS:
        columns["e"] = ends
    n = len(numbers) + 2
    padded = {k: [*map(float, v), None, float("nan"), *[None] * n][:n] for k, v in columns.items()}
    df = spark.createDataFrame([*zip(*padded.values(), strict=True)], ", ".join(f"{k} double" for k in padded))
    found = dist.column_quantiles(df, list(columns), level, most)
    assert {k: found[k][0] for k in found} == {k: len(v) for k, v in columns.items() if len(v)}
    for k in found:
        ranked = np.sort(columns[k])
        at = level * (len(ranked) - 1)
        low, high = ranked[int(at)], ranked[min(int(at) + 1, len(ranked) - 1)]
        want = low + (high - low) * (at - int(at)) if np.isfinite(high - low) else None
        assert want is None or found[k][1] == want


def test_quantiles_of_columns_agree_with_those_of_rows(spark, numbers):
    df = spark.createDataFrame([(float(v), float(v) % 7) for v in numbers], "x double, y double")
    rows = {r["column"]: r["value"] for r in dist.quantiles(dist.value_rows(df, ["x", "y"]), [0.995]).collect()}
    assert {k: v for k, (_, v) in dist.column_quantiles(df, ["x", "y"], 0.995).items()} == rows
    assert dist.column_quantiles(df.limit(0), ["x", "y"], 0.995) == {} == dist.column_quantiles(df, [], 0.5)
