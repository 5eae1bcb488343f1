"""Traps of the dataset: who counts in which history, fan-out, defaults, ties."""

import pytest

from orderlens.operators.ordered import SkewPolicy
from orderlens.plans import facts, history
from orderlens.plans.dataset import ANALYTICAL_COLUMNS, ANALYTICAL_SCHEMA, analytical_dataset
from tests.conftest import at


def _order(n, customer, bought, delivered="2018-02-01", estimated="2018-03-01", status="delivered"):
    return {
        "order_id": f"o{n}", "customer_id": customer, "order_status": status,
        "order_purchase_timestamp": at(bought),
        "order_delivered_customer_date": at(delivered) if delivered else None,
        "order_estimated_delivery_date": at(estimated) if estimated else None,
    }


def _item(order, n=1, product="p1", seller="s1", price="10.00", freight="1.00", limit="2018-01-05"):
    from decimal import Decimal

    return {
        "order_id": order, "order_item_id": n, "product_id": product, "seller_id": seller,
        "shipping_limit_date": at(limit), "price": Decimal(price), "freight_value": Decimal(freight),
    }


@pytest.fixture(scope="module")
def market(shop):
    product = dict(product_weight_g=100, product_length_cm=2, product_height_cm=3, product_width_cm=4)
    return shop(
        customers=[
            dict(customer_id=f"c{i}", customer_unique_id="u1", customer_zip_code_prefix="1", customer_state="SP")
            for i in range(1, 8)
        ],
        sellers=[
            dict(seller_id="s1", seller_zip_code_prefix="2", seller_state="SP"),
            dict(seller_id="s2", seller_zip_code_prefix="9", seller_state="RJ"),
        ],
        products=[dict(product_id="p1", product_category_name="toys", **product),
                  dict(product_id="p2", product_category_name="books", product_photos_qty=4, **product)],
        geolocation=[
            dict(geolocation_zip_code_prefix=z, geolocation_lat=lat, geolocation_lng=lng)
            for z, lat, lng in []
        ],
        orders=[
            _order(1, "c1", "2018-01-01 10:00:00", estimated="2018-01-15"),  # late
            _order(2, "c2", "2018-01-01 10:00:00", delivered="2018-02-01", estimated="2018-02-01"),  # on time, same moment
            _order(3, "c3", "2018-01-02 10:00:00"),  # no items at all
            _order(4, "c4", "2018-01-03 10:00:00", estimated=None),  # no estimate: not late
            _order(5, "c5", "2018-01-04 10:00:00", status="canceled"),
            _order(6, "c6", "2018-01-05 10:00:00", delivered=None),
            _order(7, "c7", "2018-01-06 10:00:00"),  # only an unknown product
            _order(8, "c1", "2018-01-07 10:00:00"),  # two reviews
            _order(9, "cX", "2018-01-06 12:00:00", estimated="2018-01-10"),  # unknown customer, late
        ],
        order_items=[
            _item("o1"), _item("o1", 2, "p2", "s1"), _item("o2"), _item("o4"), _item("o5"), _item("o6"),
            _item("o7", product="gone"), _item("o8", price="0.00"), _item("o9"),
        ],
        order_payments=[],
        order_reviews=[
            dict(review_id="r1", order_id="o1", review_score=2),
            dict(review_id="r8a", order_id="o8", review_score=5),
            dict(review_id="r8b", order_id="o8", review_score=1),
        ],
    )


@pytest.fixture(scope="module", params=[SkewPolicy(), SkewPolicy(rows_per_task=1, sample=1.0, points_per_cut=1)],
                ids=["plain", "cut"])
def rows(request, market):
    out = {}
    for r in analytical_dataset(market, policy=request.param).collect():
        out.setdefault(r["order_id"], []).append(r)
    return out


def test_schema(market):
    df = analytical_dataset(market)
    assert df.columns == ANALYTICAL_COLUMNS and len(df.columns) == 37
    assert [f.dataType for f in df.schema] == [f.dataType for f in ANALYTICAL_SCHEMA]


def test_only_complete_delivered_orders_and_review_fan_out(rows):
    assert {k: len(v) for k, v in rows.items()} == {"o1": 1, "o2": 1, "o4": 1, "o8": 2}


def test_label(rows):
    assert [rows[o][0]["is_late"] for o in ("o1", "o2", "o4", "o8")] == [1, 0, 0, 0]


def test_customer_history_counts_orders_without_items(rows):
    # c1..c7 are one person: o1, o2, o3 (no items), o4, o7 (no known product) come before o8
    assert rows["o8"][0]["customer_total_orders"] == 6
    assert rows["o4"][0]["customer_total_orders"] == 4


def test_seller_history_counts_unknown_customers_but_not_missing_items(rows):
    # before o8 the seller has o1 (late), o2, o4 and o9 (late, unknown customer)
    assert rows["o8"][0]["seller_historical_delay_rate"] == pytest.approx(2 / 4)
    assert rows["o8"][0]["seller_recent_delay_rate"] == pytest.approx(2 / 4)
    assert rows["o8"][0]["seconds_since_last_seller_order"] == 22 * 3600
    # the route needs both states, so the unknown customer does not count
    assert rows["o8"][0]["route_delay_rate"] == pytest.approx(1 / 3)


def test_first_order_has_defaults(rows):
    first = rows["o1"][0]
    assert first["seconds_since_last_seller_order"] == 2_592_000
    assert first["seller_historical_delay_rate"] == first["seller_avg_review_score"] == 0.0
    assert first["customer_total_orders"] == 1


def test_same_moment_is_ordered_by_order_id(rows):
    assert rows["o2"][0]["seller_historical_delay_rate"] == 1.0
    assert rows["o2"][0]["seconds_since_last_seller_order"] == 0
    assert rows["o2"][0]["seller_state_backlog"] == 0  # the frame ends one second earlier


def test_review_history_per_review(rows):
    assert sorted(r["seller_avg_review_score"] for r in rows["o8"]) == [2.0, 3.5]  # (2), (2 + 5) / 2


def test_intensity_uses_rows_after_fan_out(rows):
    # five rows in the dataset belong to s1
    r = rows["o8"][0]
    assert r["seller_intensity_score"] == pytest.approx(r["seller_state_backlog"] / 5)


def test_ratios_and_missing_coordinates(rows):
    assert rows["o8"][0]["freight_ratio"] is None and rows["o1"][0]["freight_ratio"] == pytest.approx(0.1)
    assert rows["o1"][0]["distance_km"] is None and rows["o1"][0]["total_payment"] is None


def test_largest_text_stands_for_the_order(rows):
    assert rows["o1"][0]["product_category"] == "toys"
    assert rows["o1"][0]["avg_product_photos"] == 2.0


def test_one_row_per_order(market):
    out = analytical_dataset(market, ["order_id", "seller_avg_review_score", "seller_intensity_score"], dedupe_reviews=True)
    found = {r["order_id"]: r for r in out.collect()}
    assert len(found) == out.count() == 4 and found["o8"]["seller_avg_review_score"] == 2.0


def test_hot_order_reviews_are_joined_in_pieces(shop, market):
    many = [dict(review_id=f"r{i:03d}", order_id="o8", review_score=1 + i % 5) for i in range(60)]
    crowded = shop(**{n: [r.asDict() for r in market.table(n).collect()] for n in
                      ("customers", "sellers", "products", "orders", "order_items")}, order_reviews=many)
    plain = analytical_dataset(crowded, ["order_id", "seller_avg_review_score"])
    cut = analytical_dataset(crowded, ["order_id", "seller_avg_review_score"], policy=SkewPolicy(7, 1.0))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, cut.collect()))
    assert plain.where("order_id = 'o8'").count() == 60


def test_distance(shop, spark):
    from orderlens.functions.geo import great_circle_km
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(0.0, 0.0, 0.0, 180.0), (-23.5, -46.6, -22.9, -43.2)], "a double, b double, c double, d double")
    km = [r[0] for r in df.select(great_circle_km(*[F.col(c) for c in "abcd"])).collect()]
    assert km[0] == pytest.approx(20015.087, abs=0.01) and 350 < km[1] < 365


def test_rates_stay_between_zero_and_one(spark, sf):
    from orderlens.sources.marketplace import marketplace_from_star

    df = analytical_dataset(marketplace_from_star(spark, sf))
    rates = ["seller_historical_delay_rate", "seller_recent_delay_rate", "route_delay_rate"]
    assert df.where(" OR ".join(f"{c} < 0 OR {c} > 1" for c in rates)).isEmpty()


def test_facts_keep_every_delivered_order(market):
    df = facts.order_facts(market)
    assert df.count() == 7
    assert history.with_customer_history(df).where("order_id = 'o9'").first()["customer_total_orders"] is None
