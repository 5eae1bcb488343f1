import pytest
from pyspark.sql import functions as F

from orderlens.operators.ordered import SkewPolicy, with_history
from orderlens.plans import incremental as inc

COLUMNS = ["_late", "_orders", "_late5", "_orders5", "_last"]


@pytest.fixture(scope="module")
def facts(spark):
    return spark.range(400).selectExpr(
        "CAST(id AS string) AS order_id", "timestamp_ntz '2018-01-01 00:00:00' + make_interval(0, 0, 0, 0, CAST(id / 3 AS int)) AS order_purchase_timestamp",
        "CASE WHEN id % 13 = 0 THEN NULL WHEN id % 3 = 0 THEN 'big' ELSE concat('s', pmod(hash(id), 40)) END AS seller_id",
        "CAST(pmod(xxhash64(id), 5) = 0 AS int) AS is_late", "concat('st', id % 2) AS seller_state", "IF(id % 17 = 0, NULL, 'SP') AS customer_state",
    ).withColumn("order_id", F.lpad("order_id", 4, "0"))


def whole(facts, h):
    return with_history(facts, list(h.key), list(h.order), before=h.before, recent=h.recent or None, previous=h.previous or None)


def same(a, b, names):
    key = lambda df: sorted(tuple(r) for r in df.select("order_id", *[F.col(n).cast("string") for n in names]).collect())
    rows = lambda x: [tuple(str(v) for v in r) for r in key(x)]
    assert rows(a) == rows(b)


@pytest.mark.parametrize("policy", [SkewPolicy(), SkewPolicy(20, 1.0)], ids=["plain", "cut"])
@pytest.mark.parametrize("history", [inc.SELLER, inc.ROUTE], ids=["seller", "route"])
def test_day_by_day_equals_the_full_build(facts, history, policy, tmp_path):
    """Batches of uneven size: one row, a few, none, many."""
    edges = [0, 1, 7, 40, 40, 260, 400]
    parts = [
        inc.advance_stored(facts.where(f"CAST(order_id AS int) >= {a} AND CAST(order_id AS int) < {b}"), history, str(tmp_path), policy)
        for a, b in zip(edges, edges[1:], strict=False)
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    names = [*history.before, *history.recent, *history.previous]
    same(out, whole(facts, history), names)
    state, newest = inc.load_state(facts.sparkSession, str(tmp_path))
    assert newest == len(parts)
    known = facts.dropna(subset=list(history.key))
    assert state.agg(F.sum("rows")).first()[0] == known.count()
    assert state.where(f"size(tail) > {history.tail_rows}").isEmpty()


def test_rows_older_than_the_state_are_refused(facts):
    late, early = facts.where("order_id >= '0200'"), facts.where("order_id < '0200'")
    _, state = inc.advance(late, inc.SELLER)
    with pytest.raises(ValueError, match="older"):
        inc.advance(early, inc.SELLER, state)


def test_an_empty_first_run(facts, tmp_path):
    none = inc.advance_stored(facts.limit(0), inc.CUSTOMER if "customer_unique_id" in facts.columns else inc.SELLER, str(tmp_path))
    assert none.collect() == []
    same(inc.advance_stored(facts, inc.SELLER, str(tmp_path)), whole(facts, inc.SELLER), COLUMNS)
