"""What the physical plans must and must not contain."""

import pytest

from orderlens.operators.ordered import SkewPolicy, with_history
from orderlens.plans import facts, history, reports
from orderlens.plans.dataset import analytical_dataset
from orderlens.sources.loader import load_parquet_marketplace
from orderlens.sources.marketplace import marketplace_from_star


@pytest.fixture(scope="module")
def stored(spark, sf, tmp_path_factory):
    """The marketplace as parquet folders, as a real deployment has it."""
    folder = str(tmp_path_factory.mktemp("tables"))
    t = marketplace_from_star(spark, sf)
    for name in t.names():
        df = t.table(name)
        if name == "geolocation":
            df = df.selectExpr(
                "* EXCEPT (geolocation_lat, geolocation_lng)", "CAST(geolocation_lat AS decimal(10,8)) AS geolocation_lat",
                "CAST(geolocation_lng AS decimal(11,8)) AS geolocation_lng",
            )
        df.write.parquet(f"{folder}/{name}")
    return load_parquet_marketplace(spark, folder)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(stored):
    plan = plan_of(facts.base_orders(stored.orders))
    assert "IsNotNull(order_delivered_customer_date)" in plan
    assert "EqualTo(order_status,delivered)" in plan
    assert "order_approved_at" not in plan
    items = plan_of(facts.item_summary(stored.order_items, stored.products))
    assert "product_name_lenght" not in items


def test_no_pairwise_joins(stored):
    for df in (analytical_dataset(stored), reports.customer_state_rates(analytical_dataset(stored, ["customer_state", "is_late"]))):
        plan = plan_of(df)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_seller_windows_share_one_shuffle(stored):
    df = facts.base_orders(stored.orders).selectExpr(
        "*", "customer_id AS seller_id", "0L AS review_count", "true AS has_customer", "true AS has_seller"
    )
    plan = plan_of(history.with_seller_history(df))
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_histories_need_no_join_back(stored):
    df = facts.order_facts(stored, {"customers"})
    joins = plan_of(df).count("Join")
    assert plan_of(history.with_customer_history(df)).count("Join") == joins


def test_cut_history_broadcasts_only_cuts_and_sums(spark):
    df = spark.range(5000).selectExpr("CASE WHEN id >= 0 THEN 'a' END AS k", "id AS t")
    plan = plan_of(with_history(df, ["k"], ["t"], before={"n": "1"}, policy=SkewPolicy(500, 1.0)))
    assert plan.count("BroadcastHashJoin") == 5  # blocks and cuts, twice, and the sums of earlier parts
    assert "BroadcastNestedLoopJoin" not in plan and "hashpartitioning(k" in plan


def test_unneeded_parts_are_not_joined(stored):
    plan = plan_of(analytical_dataset(stored, ["order_id", "total_price"]))
    assert "payment" not in plan and "geolocation" not in plan


@pytest.fixture
def all_shuffled(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_backlogs_count_stored_rows(spark, stored, tmp_path):
    """What earlier histories have added is not computed again for the counts."""
    df = facts.base_orders(stored.orders).selectExpr("*", "customer_id AS seller_state", "'x' AS customer_state")
    df.write.parquet(str(tmp_path / "facts"))
    kept = spark.read.parquet(str(tmp_path / "facts"))
    one = history.with_seller_state_backlog(kept, at_most=kept.count(), looked_at=kept)
    both = history.with_customer_state_backlog(one, at_most=kept.count(), looked_at=kept)
    assert plan_of(both).count("Join") == 2
    same = history.with_customer_state_backlog(history.with_seller_state_backlog(kept))
    assert both.exceptAll(same).isEmpty() and both.count() == kept.count()


def test_items_are_shuffled_by_order_once(spark, sf, all_shuffled):
    items = marketplace_from_star(spark, sf).order_items
    assert plan_of(items.groupBy("order_id").count()).count("Exchange hashpartitioning") == 2  # items, orders


def test_wide_rows_are_shuffled_once_after_the_facts(spark, stored, all_shuffled):
    plan = plan_of(analytical_dataset(stored, ["order_id", "product_category", "customer_total_orders", "seller_avg_review_score"]))
    shuffles = [line for line in plan.split("Exchange hashpartitioning(")[1:]]
    assert sum("product_category" in s.split("FileScan")[0] and s.startswith("order_id") for s in shuffles) <= 1


def test_customers_join_before_items(stored, all_shuffled):
    plan = plan_of(facts.order_facts(stored, {"items", "customers"}))
    assert plan.index("SortMergeJoin [order_id") < plan.index("SortMergeJoin [customer_id")  # the upper join comes first
