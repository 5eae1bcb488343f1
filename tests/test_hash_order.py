import hashlib

import pytest

from orderlens.operators import hash_order
from orderlens.operators.hash_order import first_rows, with_rank
from orderlens.sources.staging import staged

KEY = ("order_id", "part")


def rows_of(spark, n=900):
    return spark.range(n).selectExpr(
        "CASE WHEN id % 50 = 0 THEN NULL ELSE CAST(id AS string) END AS order_id", "CAST(id % 3 AS int) AS part", "CASE WHEN id % 7 > 1 THEN id % 7 > 4 END AS late"
    )


def order(r):
    text = "".join("" if r[c] is None else str(r[c]) for c in KEY) + "42"
    return hashlib.md5(text.encode()).hexdigest(), "" if r["order_id"] is None else r["order_id"], r["part"]


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_ranks_are_those_of_a_total_order(spark, digits):
    df = rows_of(spark)
    got = with_rank(df, ["late"], KEY, 42, digits).collect()
    assert len(got) == df.count() and got[0].__fields__ == [*df.columns, "_rank"]
    for label in (None, True, False):
        mine = sorted((r for r in got if r["late"] is label), key=lambda r: r["_rank"])
        assert [r["_rank"] for r in mine] == list(range(len(mine)))
        assert [order(r) for r in mine] == sorted(order(r) for r in mine)


@pytest.mark.parametrize("digits", [1, 4])
@pytest.mark.parametrize("fraction", [0.0, 0.001, 0.25, 0.5, 0.999])
def test_samples_are_the_first_rows(spark, fraction, digits):
    df = rows_of(spark)
    got = sorted(order(r) for r in first_rows(df, fraction, KEY, 42, digits).collect())
    assert got == sorted(order(r) for r in df.collect())[: round(fraction * 900)]


def test_a_sample_shuffles_no_rows(spark):
    df = spark.range(5000).selectExpr("CAST(id AS string) AS order_id")
    plan = first_rows(df, 0.3, ["order_id"], 1)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan


def test_rows_that_repeat_a_key_and_empty_tables(spark):
    same = spark.range(100).selectExpr("'a' AS order_id", "CAST(id % 2 AS int) AS part")
    assert first_rows(same, 0.3, ["order_id"], 42).count() == 30
    assert sorted(r["_rank"] for r in with_rank(same, ["part"], ["order_id"], 42).collect()) == sorted([*range(50), *range(50)])
    assert first_rows(same.limit(0), 0.5, ["order_id"], 42).collect() == [] == with_rank(same.limit(0), ["part"], KEY, 42).collect()


def test_staged_rows_are_not_staged_again(spark, monkeypatch):
    df, made = staged(rows_of(spark), "rows"), []
    monkeypatch.setattr(hash_order, "staged", lambda df, label: made.append(label) or staged(df, label))
    ranked, first = with_rank(df, ["late"], KEY, 42), first_rows(df, 0.3, KEY, 42)
    assert "hash-rows" not in made
    assert sorted(map(str, ranked.collect())) == sorted(map(str, with_rank(rows_of(spark), ["late"], KEY, 42).collect()))
    assert sorted(map(str, first.collect())) == sorted(map(str, first_rows(rows_of(spark), 0.3, KEY, 42).collect()))
