"""The analytical dataset: 37 columns, one row per delivered order and review."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.operators.ordered import DEFAULT_POLICY, SkewPolicy
from orderlens.plans import history
from orderlens.plans.facts import order_facts
from orderlens.sources.schemas import Marketplace
from orderlens.sources.staging import WIDE, staged

TS = "order_purchase_timestamp"
MOST_SELLERS = 500_000  # that are broadcast; about 100 MB

_TEXT, _INT, _LONG, _DOUBLE, _TIME = (
    T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampNTZType(),
)
ANALYTICAL_TYPES: dict[str, T.DataType] = {
    "order_id": _TEXT,
    "customer_id": _TEXT,
    "customer_city": _TEXT,
    "customer_state": _TEXT,
    "seller_city": _TEXT,
    "seller_state": _TEXT,
    "is_same_state": _INT,
    "distance_km": _DOUBLE,
    "is_late": _INT,
    "order_purchase_timestamp": _TIME,
    "purchase_day_of_week": _INT,
    "purchase_hour": _INT,
    "purchase_month": _INT,
    "total_items": _LONG,
    "total_price": _DOUBLE,
    "total_freight": _DOUBLE,
    "total_weight_g": _LONG,
    "avg_product_volume_cm3": _DOUBLE,
    "freight_ratio": _DOUBLE,
    "product_category": _TEXT,
    "total_payment": _DOUBLE,
    "max_installments": _INT,
    "primary_payment_type": _TEXT,
    "avg_product_photos": _DOUBLE,
    "avg_description_length": _DOUBLE,
    "seller_shipping_buffer_days": _INT,
    "shipping_limit_spread": _INT,
    "lead_time_days_estimated": _INT,
    "seller_historical_delay_rate": _DOUBLE,
    "seller_avg_review_score": _DOUBLE,
    "seller_state_backlog": _LONG,
    "customer_state_backlog": _LONG,
    "customer_total_orders": _LONG,
    "seller_recent_delay_rate": _DOUBLE,
    "seconds_since_last_seller_order": _LONG,
    "seller_intensity_score": _DOUBLE,
    "route_delay_rate": _DOUBLE,
}
ANALYTICAL_SCHEMA = T.StructType([T.StructField(n, k) for n, k in ANALYTICAL_TYPES.items()])
ANALYTICAL_COLUMNS = ANALYTICAL_SCHEMA.names

# Which columns need more than the order's own items, customer and seller.
_NEEDS = {
    "distance_km": "coordinates",
    "total_payment": "payments",
    "max_installments": "payments",
    "primary_payment_type": "payments",
    "seller_historical_delay_rate": "seller",
    "seller_recent_delay_rate": "seller",
    "seconds_since_last_seller_order": "seller",
    "seller_intensity_score": "seller",
    "seller_avg_review_score": "review",
    "seller_state_backlog": "seller_backlog",
    "customer_state_backlog": "customer_backlog",
    "customer_total_orders": "customer",
    "route_delay_rate": "route",
}
# What stands in for a missing history: no orders yet, or 30 days without an order.
_DEFAULTS = {
    "seller_historical_delay_rate": 0.0,
    "seller_avg_review_score": 0.0,
    "seller_state_backlog": 0,
    "customer_state_backlog": 0,
    "customer_total_orders": 1,
    "seller_recent_delay_rate": 0.0,
    "seconds_since_last_seller_order": 2_592_000,
    "route_delay_rate": 0.0,
}


# Columns that are not simply carried over from the order facts.
_EXPRESSIONS = {
    "is_same_state": "CASE WHEN customer_state = seller_state THEN 1 ELSE 0 END",
    "purchase_day_of_week": f"weekday({TS})",  # Monday = 0
    "purchase_hour": f"hour({TS})",
    "purchase_month": f"month({TS})",
    "freight_ratio": "try_divide(total_freight, total_price)",
    "seller_shipping_buffer_days": f"datediff(max_shipping_limit_date, {TS})",
    "lead_time_days_estimated": f"datediff(order_estimated_delivery_date, {TS})",
    "seller_intensity_score": "try_divide(CAST(coalesce(seller_state_backlog, 0) AS double), seller_rows)",
}


def _output(name: str) -> str:
    value = _EXPRESSIONS.get(name, name)
    if name in _DEFAULTS:
        value = f"coalesce({value}, {_DEFAULTS[name]})"
    return f"CAST({value} AS {ANALYTICAL_TYPES[name].simpleString()}) AS {name}"


def analytical_dataset(
    t: Marketplace,
    columns: Sequence[str] | None = None,
    *,
    dedupe_reviews: bool = False,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Build the dataset, or only ``columns`` of it (parts that no column needs are not computed).

    An order with several reviews appears once per review. ``dedupe_reviews=True`` gives one row per
    order instead, with the review history as it stood before the order's first review; the seller's
    volume behind ``seller_intensity_score`` is the same in both forms.
    """
    wanted = list(columns) if columns is not None else list(ANALYTICAL_COLUMNS)
    needs = {_NEEDS[c] for c in wanted if c in _NEEDS}
    if "seller_intensity_score" in wanted:
        needs.add("seller_backlog")
    histories = needs & {"seller", "review", "seller_backlog", "customer_backlog", "customer", "route"}

    parts = {"items", "customers", "sellers", "reviews"} | (needs & {"payments", "coordinates"})
    facts = order_facts(t, parts, bool(histories) and t.sellers.count() <= MOST_SELLERS)
    at_most = None
    if histories:
        # Read several times from here on, a few columns at a time.
        facts = staged(facts, "order-facts", WIDE)
        at_most = facts.count()

    rows = facts.where("has_customer AND has_seller")
    others = _order_histories(facts, histories, policy, at_most) if histories - {"review"} else None
    if "review" in histories:
        rows = _with_review_scores(rows, others, facts, t, dedupe_reviews, policy)
    elif others is not None:
        rows = rows.join(others.drop("review_count"), "order_id")
    if "review" not in histories and not dedupe_reviews:
        rows = rows.selectExpr("*", "explode(sequence(1L, greatest(review_count, 1L)))")
    return rows.selectExpr(*[_output(c) for c in wanted])


def _order_histories(facts: DataFrame, histories: set[str], policy: SkewPolicy, at_most: int) -> DataFrame:
    """Order id, review count and history columns. Each step adds its columns to the same slim rows, so no history
    has to be joined back; orders that will not be in the dataset drop out at the end."""
    slim = facts.select(
        "order_id", TS, "is_late", "seller_id", "seller_state", "customer_unique_id", "customer_state",
        "review_count", "has_customer", "has_seller",
    )
    inputs = [c for c in slim.columns if c not in ("order_id", "review_count")]
    if "customer" in histories:
        slim = history.with_customer_history(slim, policy, at_most, facts)
    if "seller" in histories:
        slim = history.with_seller_history(slim, policy, at_most, facts)
    if "route" in histories:
        slim = history.with_route_history(slim, policy, at_most, facts)
    if "seller_backlog" in histories:
        slim = history.with_seller_state_backlog(slim, policy, at_most, facts)
    if "customer_backlog" in histories:
        slim = history.with_customer_state_backlog(slim, policy, at_most, facts)
    return slim.where("has_customer AND has_seller").drop(*inputs)


def _with_review_scores(
    rows: DataFrame, others: DataFrame | None, facts: DataFrame, t: Marketplace, dedupe: bool, policy: SkewPolicy
) -> DataFrame:
    """Join the histories and the per-review rows back to their order, an order with very many reviews in pieces.

    The slim histories and scores meet first, so that the wide rows are shuffled once.
    """
    at_most, most = facts.agg(F.sum(F.greatest("review_count", F.lit(1))), F.max("review_count")).first()
    scores = history.seller_review_history(facts, t.order_reviews, policy, at_most or 0, most or 0)
    if dedupe:
        first = scores.groupBy("order_id").agg(
            F.min_by("seller_avg_review_score", "review_id").alias("seller_avg_review_score")
        )
        if others is not None:
            rows = rows.join(others.drop("review_count"), "order_id")
        return rows.join(first, "order_id", "left")
    # 1 for any ordinary order
    pieces = f"CAST(greatest(1, ceil(review_count / {policy.rows_per_task})) AS int)"
    in_pieces = ("*", f"explode(sequence(0, {pieces} - 1)) AS _piece")
    scores = scores.selectExpr(
        "order_id", f"CAST(pmod(xxhash64(review_id), {pieces}) AS int) AS _piece", "seller_avg_review_score"
    )
    if others is not None:
        scores = scores.join(others.selectExpr(*in_pieces).drop("review_count"), ["order_id", "_piece"])
    return rows.selectExpr(*in_pieces).join(scores, ["order_id", "_piece"])
