"""What the feature step shuffles and keeps on disk."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from orderlens.operators.backlog import with_backlog
from orderlens.operators.ordered import SkewPolicy, with_history
from orderlens.plans import dataset, facts, modeling
from orderlens.plans.dataset import analytical_dataset
from orderlens.sources import staging as st
from orderlens.sources.marketplace import marketplace_from_star


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def all_shuffled(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def shuffle_files(spark) -> set:
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f"{d}/{n}" for top in manager.localDirsString() for d, _, names in os.walk(top) for n in names if n.startswith("shuffle_")}


def kept_tables(spark) -> set:
    folder = os.path.join(st.shared_folder(spark), "orderlens")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_a_staged_table_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(st._CLEANUP)
    with st.staging(spark):
        kept = st.staged(spark.range(5000).groupBy((F.col("id") % 7).alias("k")).count(), "probe")
        assert shuffle_files(spark) <= before
        assert sorted(map(tuple, kept.collect())) == [(k, 715 if k < 2 else 714) for k in range(7)]
    assert spark.conf.get(st._CLEANUP) == setting


def test_what_was_staged_on_the_way_goes(spark):
    before = kept_tables(spark)
    with st.staging(spark):
        kept = st.staged_alone(spark, lambda: st.staged(spark.range(10), "first").selectExpr("id + 1 AS id"), "second")
        assert [t.split("-")[0] for t in kept_tables(spark) - before] == ["second"]
        assert st.is_staged(kept) and kept.agg(F.sum("id")).first()[0] == 55
    assert kept_tables(spark) == before


def test_folds_go_when_their_scores_are_stored(spark):
    before = kept_tables(spark)
    df = spark.range(200).selectExpr("CAST(id AS string) AS order_id", "CAST(id % 5 = 0 AS int) AS is_late", "CAST(id % 11 AS double) AS x")
    with st.staging(spark):
        metrics = modeling.cross_validate(st.staged(df, "rows"), modeling.TreeSettings(rounds=1, depth=1), folds=2, patience=0)
        assert metrics.count() == 2
        assert {t.split("-")[0] for t in kept_tables(spark) - before} == {"rows", "fold", "score"}  # of fold-scores, score-steps
    assert kept_tables(spark) == before


def test_products_join_items_before_their_orders_do(spark, sf, all_shuffled):
    t = marketplace_from_star(spark, sf)
    summary = facts.item_summary(t.order_items, t.products)
    assert plan_of(summary).count("Exchange hashpartitioning") == 4  # items, products, both by order, orders
    plain = t.order_items.select("*")  # not known to be joined late
    assert plan_of(facts.item_summary(plain, t.products)).count("Exchange hashpartitioning") == 5
    same = facts.item_summary(plain, t.products)
    assert summary.schema == same.schema and summary.count() == same.count() > 0
    assert summary.exceptAll(same).isEmpty()


def test_few_sellers_do_not_move_the_facts(spark, sf, all_shuffled, monkeypatch):
    t = marketplace_from_star(spark, sf)
    assert "hashpartitioning(coalesce(seller_id" in plan_of(facts.order_facts(t))
    few = facts.order_facts(t, few_sellers=True)
    assert "hashpartitioning(coalesce(seller_id" not in plan_of(few)
    assert few.exceptAll(facts.order_facts(t)).isEmpty() and few.count() == facts.order_facts(t).count()
    asked = []
    build = facts.order_facts
    monkeypatch.setattr(dataset, "order_facts", lambda t, parts, few: asked.append(few) or build(t, parts, few))
    with st.staging(spark):
        analytical_dataset(t, ["order_id", "customer_total_orders"])
        monkeypatch.setattr(dataset, "MOST_SELLERS", 1)
        analytical_dataset(t, ["order_id", "customer_total_orders"])
    assert asked == [True, False]


def test_inputs_of_a_history_are_not_shuffled_beside_their_columns(spark):
    df = spark.range(50).selectExpr("id % 3 AS k", "id AS t", "CAST(id % 2 AS int) AS v")
    out = with_history(df, ["k"], ["t"], before={"s": "v", "n": "1"}, previous={"last": "t"}, total={"all": "v"})
    assert "_in_" not in plan_of(out)
    cut = with_history(df, ["k"], ["t"], before={"s": "v", "n": "1"}, previous={"last": "t"}, total={"all": "v"}, policy=SkewPolicy(5, 1.0))
    assert out.schema == cut.schema
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, cut.collect()))


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
@pytest.mark.parametrize("half", [0, 500_000], ids=["whole", "fractions"])
@pytest.mark.parametrize("policy", [SkewPolicy(), SkewPolicy(100, 1.0)], ids=["plain", "cut"])
def test_backlog_of_stored_rows_equals_a_count_of_pairs(spark, monkeypatch, kind, half, policy):
    start = dt.datetime(2018, 3, 1)
    rows = [
        (i, "a" if i % 3 else None if i % 15 == 0 else "b", start + dt.timedelta(seconds=i * 7919 % 400_000 // 3, microseconds=half * (i % 2)))
        for i in range(300)
    ]
    df = spark.createDataFrame(rows, f"id int, state string, ts {kind}").repartition(3)
    points = []
    monkeypatch.setattr("orderlens.operators.backlog.with_history", lambda df, *a, **k: points.append(df) or with_history(df, *a, **k))
    got = {r["id"]: r["n"] for r in with_backlog(df, "state", "ts", 1, "n", policy, 300, df).collect()}
    day, second = dt.timedelta(days=1), dt.timedelta(seconds=1)
    assert got == {i: None if k is None else sum(k == l and t - day <= u <= t - second for _, l, u in rows) for i, k, t in rows}
    instants = len({(k, t) for _, k, t in rows if k is not None})
    assert points[0].count() == instants * (3 if half else 2)
    assert ("_asked" in points[0].columns) == (kind == "timestamp")
