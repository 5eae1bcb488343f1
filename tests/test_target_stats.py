import hashlib
import math

import pytest

from orderlens.operators.ordered import SkewPolicy
from orderlens.plans import modeling as md
from orderlens.plans import target_stats as ts

COLUMNS = ["seller_state", "product_category"]


def rows_of(spark, n=600):
    return spark.range(n).selectExpr(
        "CAST(id AS string) AS order_id", "CAST(id % 4 = 0 AS int) AS is_late", "CASE WHEN id % 9 = 1 THEN NULL WHEN id % 9 < 6 THEN 'SP' ELSE concat('s', id % 9) END AS seller_state",
        "concat('c', id % 37) AS product_category", "CAST(id AS double) AS total_price",
    )


def brute(rows, column):
    base = sum(r["is_late"] for r in rows) / len(rows)
    late, seen, out = {}, {}, {}
    for r in sorted(rows, key=lambda r: hashlib.md5(f"{r['order_id']}42".encode()).hexdigest()):
        c = r[column] or "UNKNOWN"
        out[r["order_id"]] = (late.get(c, 0) + base) / (seen.get(c, 0) + 1)
        late[c], seen[c] = late.get(c, 0) + r["is_late"], seen.get(c, 0) + 1
    return out, {c: (late[c] + base) / (seen[c] + 1) for c in seen}, base


@pytest.mark.parametrize("policy", [SkewPolicy(), SkewPolicy(50, 1.0)], ids=["plain", "cut"])
def test_a_row_sees_only_rows_before_it(spark, policy):
    df = rows_of(spark)
    got = ts.ordered_statistics(df, COLUMNS, "is_late", ["order_id"], 42, policy=policy)
    assert got.columns == df.columns
    rows = df.collect()
    for c in COLUMNS:
        expected, _, _ = brute(rows, c)
        assert {r["order_id"]: r[c] for r in got.collect()} == pytest.approx(expected)


def test_scoring_joins_the_table(spark):
    df = rows_of(spark)
    table = ts.category_table(df, COLUMNS, "is_late")
    new = spark.createDataFrame([("a", None, "c3", 1.0), ("b", "s7", "never seen", 2.0)], "order_id string, seller_state string, product_category string, total_price double")
    got = {r["order_id"]: r for r in ts.with_statistics(new, table, COLUMNS).collect()}
    _, states, base = brute(df.collect(), "seller_state")
    _, kinds, _ = brute(df.collect(), "product_category")
    assert got["a"]["seller_state"] == pytest.approx(states["UNKNOWN"]) and got["a"]["product_category"] == pytest.approx(kinds["c3"])
    assert got["b"]["seller_state"] == pytest.approx(states["s7"]) and got["b"]["product_category"] == pytest.approx(base)


def test_many_categories_need_no_list_on_the_driver(spark):
    df = spark.range(120_000).selectExpr("CAST(id AS string) AS order_id", "CAST(id % 10 = 0 AS int) AS is_late", "concat('c', id % 100000) AS product_category")
    table = ts.category_table(df, ["product_category"], "is_late")
    assert table.count() == 100_001
    got = ts.ordered_statistics(df, ["product_category"], "is_late", ["order_id"], 42)
    row = got.selectExpr("count(*) AS n", "min(product_category) AS low", "max(product_category) AS high").first()
    assert row["n"] == 120_000 and 0 < row["low"] and row["high"] <= 1
    assert ts.with_statistics(df, table, ["product_category"]).where("product_category IS NULL").isEmpty()


def test_trees_on_statistics(spark):
    df = rows_of(spark).selectExpr("* EXCEPT (is_late)", "CAST(product_category IN ('c1', 'c2', 'c3', 'c4', 'c5') AS int) AS is_late")
    fitted = md.fit_on_statistics(df, md.TreeSettings(rounds=5, depth=3, learning_rate=0.5))
    scored = md.predict_on_statistics(fitted, df, ["order_id", "is_late"])
    assert md.decision_metrics(scored).first()["f1"] > 0.9
    unseen = df.limit(3).selectExpr("order_id", "is_late", "'x' AS seller_state", "'y' AS product_category", "total_price")
    assert all(math.isfinite(r["late_probability"]) for r in md.predict_on_statistics(fitted, unseen).collect())
    assert [s.__class__.__name__ for s in fitted.model.stages] == ["VectorAssembler", "GBTClassificationModel"]


def test_empty_tables(spark):
    df = rows_of(spark).limit(0)
    assert ts.ordered_statistics(df, COLUMNS, "is_late", ["order_id"], 42).collect() == []
    assert ts.ordered_statistics(df, [], "is_late", ["order_id"], 42) is df
    assert ts.category_table(df, COLUMNS, "is_late").where("category IS NOT NULL").collect() == []
