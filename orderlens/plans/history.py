"""History features: what was known from earlier purchases of a seller, customer, state or route.

Histories use the outcome of every earlier *purchase*, whether or not that order had been delivered
by then. Purchases at the same time are ordered by order id. Each function keeps all rows of its
input and counts only rows that have the key: orders without items belong to no seller but still
count for their customer. ``looked_at`` is the stored table that ``facts`` was made from: hot keys are looked for
and instants counted there, not on what earlier histories have added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.calendar import seconds_between
from orderlens.operators.backlog import with_backlog
from orderlens.operators.ordered import DEFAULT_POLICY, SkewPolicy, with_history
from orderlens.plans.facts import reviewed_orders

TS = "order_purchase_timestamp"
ORDER = [TS, "order_id"]


def _rate(total: str, count: str) -> Column:
    return F.expr(f"try_divide(CAST({total} AS double), {count})")


def with_seller_history(
    facts: DataFrame, policy: SkewPolicy = DEFAULT_POLICY, at_most: int | None = None, looked_at: DataFrame | None = None
) -> DataFrame:
    """Late rate before this order, late rate of the last five orders, seconds since the last order
    and the seller's number of rows in the final dataset: four windows over one shuffle."""
    with_windows = with_history(
        facts,
        ["seller_id"],
        ORDER,
        before={"_late": "is_late", "_orders": "1"},
        recent={"_late5": "is_late", "_orders5": "1"},
        recent_rows=5,
        previous={"_last": TS},
        total={"seller_rows": "CASE WHEN has_customer AND has_seller THEN greatest(review_count, 1) ELSE 0 END"},
        policy=policy,
        at_most=at_most,
        looked_at=looked_at,
    )
    return with_windows.withColumns(
        {
            "seller_historical_delay_rate": _rate("_late", "_orders"),
            "seller_recent_delay_rate": _rate("_late5", "_orders5"),
            "seconds_since_last_seller_order": seconds_between("_last", TS),
        }
    ).drop("_late", "_orders", "_late5", "_orders5", "_last")


def with_customer_history(
    facts: DataFrame, policy: SkewPolicy = DEFAULT_POLICY, at_most: int | None = None, looked_at: DataFrame | None = None
) -> DataFrame:
    """The running number of orders of the customer identity, this order included."""
    counted = with_history(
        facts, ["customer_unique_id"], ORDER, before={"_orders": "1"}, policy=policy, at_most=at_most, looked_at=looked_at
    )
    return counted.withColumn("customer_total_orders", F.col("_orders") + 1).drop("_orders")


def with_route_history(
    facts: DataFrame, policy: SkewPolicy = DEFAULT_POLICY, at_most: int | None = None, looked_at: DataFrame | None = None
) -> DataFrame:
    """Late rate of earlier orders between the same two states."""
    rated = with_history(
        facts,
        ["seller_state", "customer_state"],
        ORDER,
        before={"_late": "is_late", "_orders": "1"},
        policy=policy,
        at_most=at_most,
        looked_at=looked_at,
    )
    return rated.withColumn("route_delay_rate", _rate("_late", "_orders")).drop("_late", "_orders")


def with_seller_state_backlog(
    facts: DataFrame, policy: SkewPolicy = DEFAULT_POLICY, at_most: int | None = None, looked_at: DataFrame | None = None
) -> DataFrame:
    return with_backlog(facts, "seller_state", TS, 7, "seller_state_backlog", policy, at_most, looked_at)


def with_customer_state_backlog(
    facts: DataFrame, policy: SkewPolicy = DEFAULT_POLICY, at_most: int | None = None, looked_at: DataFrame | None = None
) -> DataFrame:
    return with_backlog(facts, "customer_state", TS, 3, "customer_state_backlog", policy, at_most, looked_at)


def seller_review_history(
    facts: DataFrame,
    order_reviews: DataFrame,
    policy: SkewPolicy = DEFAULT_POLICY,
    at_most: int | None = None,
    most_reviews: int | None = None,
) -> DataFrame:
    """Average review score of the seller before each row; one row per order and review.

    ``most_reviews`` is the largest ``review_count``, where known: unless one order has a task's worth of reviews, hot
    sellers are looked for among the orders, which spares joining the reviews for that.
    """
    sold = facts.where(F.col("seller_id").isNotNull()).select("order_id", "seller_id", TS, "review_count")
    rows = reviewed_orders(sold, order_reviews).withColumn("review_id", F.coalesce("review_id", F.lit("")))
    looked_at = None
    if most_reviews is not None and most_reviews * policy.points_per_cut <= policy.rows_per_task:
        looked_at = sold.selectExpr("seller_id", *ORDER, "'' AS review_id", "explode(sequence(1L, greatest(review_count, 1L)))")
    scored = with_history(
        rows,
        ["seller_id"],
        [*ORDER, "review_id"],
        before={
            "_score": "review_score",
            "_scores": "CASE WHEN review_score IS NOT NULL THEN 1 ELSE 0 END",
        },
        policy=policy,
        at_most=at_most,
        looked_at=looked_at,
    )
    return scored.select(
        "order_id",
        "review_id",
        "review_count",
        "seller_id",
        _rate("_score", "_scores").alias("seller_avg_review_score"),
    )
