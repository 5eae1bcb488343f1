"""Steps that all model queries share do no work twice and nothing row by row that can be done in bulk."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from orderlens.functions import calendar
from orderlens.operators import backlog, distribution
from orderlens.operators.hash_order import in_bytes, row_hash, with_rank
from orderlens.operators.ordered import SkewPolicy, with_history
from orderlens.plans import features, history
from orderlens.sources import staging
from orderlens.sources.marketplace import marketplace_from_star


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_amounts_are_made_of_whole_cents_without_doubles(spark, sf):
    items = marketplace_from_star(spark, sf).order_items.select("order_id", "order_item_id", "price", "freight_value")
    assert "as double) / 100" not in plan_of(items)
    cents, tax = "CAST(round(l_extendedprice * 100) AS bigint)", "CAST(round(l_tax * 100) AS bigint)"
    raw = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr(
        "CAST(l_orderkey AS string) AS order_id", "l_linenumber AS order_item_id", f"CAST({cents} / 100D AS decimal(10,2)) AS price",
        f"CAST((({cents} * ({tax} + 2) + 50) div 100) / 100D AS decimal(10,2)) AS freight_value",
    )
    raw = raw.join(spark.read.parquet(f"{sf}/orders.parquet").selectExpr("CAST(o_orderkey AS string) AS order_id"), "order_id")
    assert items.count() == raw.count() > 0
    assert items.exceptAll(raw).count() == 0
    assert dict(items.dtypes)["price"] == dict(items.dtypes)["freight_value"] == "decimal(10,2)"


def orders(spark, n=3000):
    return spark.range(n).selectExpr(
        "CAST(id AS string) AS order_id", "CAST(id % 2 AS string) AS state", "CAST(id % 3 AS string) AS seller_id", "id % 4 AS review_count",
        "timestampadd(SECOND, CAST(id * 997 % 500000 AS int), TIMESTAMP_NTZ'2018-01-01 00:00:00') AS order_purchase_timestamp",
    )


def captured(monkeypatch, module):
    seen = []

    def spy(df, *args, **kwargs):
        seen.append(kwargs.get("looked_at"))
        return with_history(df, *args, **kwargs)

    monkeypatch.setattr(module, "with_history", spy)
    return seen


@pytest.mark.parametrize("policy", [SkewPolicy(), SkewPolicy(200, 1.0)], ids=["plain", "cut"])
def test_busy_states_are_looked_for_among_stored_rows(spark, monkeypatch, policy):
    df, ts = orders(spark), "order_purchase_timestamp"
    seen = captured(monkeypatch, backlog)
    plain = backlog.with_backlog(df, "state", ts, 3, "n").select("order_id", "n")
    got = backlog.with_backlog(df, "state", ts, 3, "n", policy, 3000, df).select("order_id", "n")
    assert seen[0] is None and "Exchange" not in plan_of(seen[1])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))


@pytest.mark.parametrize("policy", [SkewPolicy(), SkewPolicy(200, 1.0)], ids=["plain", "cut"])
def test_busy_sellers_are_looked_for_among_orders(spark, monkeypatch, policy):
    df = orders(spark)
    reviews = df.selectExpr("order_id", "explode(sequence(1L, greatest(review_count, 1L))) AS i", "review_count").where("review_count > 0")
    reviews = reviews.selectExpr("order_id", "concat(order_id, '-', i) AS review_id", "CAST(1 + (CAST(order_id AS int) + i) % 5 AS int) AS review_score")
    seen = captured(monkeypatch, history)
    rows = lambda x: sorted(map(str, x.collect()))
    plain = rows(history.seller_review_history(df, reviews))
    assert rows(history.seller_review_history(df, reviews, policy, 6000, 3)) == plain
    assert seen[0] is None and "Exchange" not in plan_of(seen[1])
    # One order with a task's worth of reviews may have to be cut itself: then its reviews are looked at.
    history.seller_review_history(df, reviews, policy, 6000, policy.rows_per_task)
    assert seen[2] is None


@pytest.mark.parametrize("edges", [[], [0.5], [0.25, 0.25, 0.5], [i / 40 for i in range(40)]])
def test_cells_between_few_edges_need_no_function_call(spark, edges):
    rows = distribution.value_rows(spark.range(101).selectExpr("id / 100 AS x", "id AS y"), ["x"])
    table = spark.range(1).select(F.lit("x").alias("column"), F.array(*[F.lit(e) for e in edges]).cast("array<double>").alias("_edges"))
    cells = distribution._cells(rows, table, ["column"])
    assert ("lambda" in plan_of(cells)) == (len(edges) > distribution.FEW_EDGES)
    want = {}
    for i in range(101):
        cell = sum(e < i / 100 for e in edges) + sum(e <= i / 100 for e in edges)
        want[cell] = want.get(cell, 0) + 1
    assert {r["_cell"]: r["_n"] for r in cells.collect()} == want


def test_hashes_are_shuffled_as_bytes_in_the_order_of_their_digits(spark):
    df = spark.range(2000).selectExpr("CAST(id AS string) AS order_id", "id % 2 AS late")
    hashed = df.select(row_hash(["order_id"], 42).alias("digits")).withColumn("bytes", in_bytes("digits"))
    assert [r["digits"] for r in hashed.orderBy("bytes").collect()] == [r["digits"] for r in hashed.orderBy("digits").collect()]
    assert {len(r["bytes"]) for r in hashed.collect()} == {16}
    assert re.search(r"unhex\(_hash", plan_of(with_rank(df, ["late"], ["order_id"], 42)))


def test_caps_of_a_stored_table_are_fitted_without_writing_values(spark, monkeypatch):
    """Values of a table that is not stored are written once, so that it is not built for every pass."""
    df = spark.range(500).selectExpr(*[f"CAST(id * {i + 3} % 101 AS double) AS {c}" for i, c in enumerate(features.CAPPED)])
    written = []
    keep = staging.staged
    for module in (features, distribution):
        monkeypatch.setattr(module, "staged", lambda df, label, *a: written.append(label) or keep(df, label, *a))
    plain = features.fit_thresholds(df)
    assert written == ["values"]
    assert features.fit_thresholds(keep(df, "features")) == plain and len(plain) == len(features.CAPPED)
    assert written == ["values"]
    assert features.fit_thresholds(df.limit(1)) == {}


def test_the_nearest_holiday_is_found_without_a_function_call_per_day(spark):
    days = spark.range(-900, 1500).selectExpr("timestampadd(DAY, CAST(id AS int), TIMESTAMP_NTZ'2016-12-25 13:00:00') AS t").unionByName(spark.sql("SELECT CAST(NULL AS timestamp_ntz) AS t"))
    got = days.select("t", calendar.days_to_nearest("t").alias("n"))
    assert "lambdafunction" not in plan_of(got) and dict(got.dtypes)["n"] == "int"
    listed = [dt.date.fromisoformat(d) for d in calendar.HOLIDAYS]
    for t, n in got.collect():
        assert n == (None if t is None else min(abs((t.date() - d).days) for d in listed))
