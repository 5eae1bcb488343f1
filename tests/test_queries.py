"""Registered queries against their oracles; ORDERLENS_ALL=1 runs every one of them."""

import os

import pytest

from checks import ORACLES, QUERIES
from tests.compare import assert_same, oracle

QUICK = [
    "s01_load_order_reviews",
    "s04_key_report",
    "r02_item_summary",
    "r10_review_fan_out",
    "r14_analytical_dataset",
    "w01_seller_review_average",
    "w06_seller_state_backlog",
    "f10_risk_sentences",
    "e_features",
    "a04_distance_density",
    "a18_mutual_information",
    "a24_backlog_boxes_by_label",
    "a30_distance_loyalty_pivot",
    "m04_stratified_folds",
    "m09_fold_metrics",
    "p01_input_contract",
    "p06_top_risk_factors",
    "p11_stream_scoring",
]
CHOSEN = sorted(ORACLES) if os.environ.get("ORDERLENS_ALL") else QUICK


@pytest.fixture(scope="module")
def con(sf):
    return oracle(sf)


@pytest.mark.parametrize("name", CHOSEN)
def test_query_matches_oracle(spark, sf, con, name):
    assert_same(QUERIES[name](spark, sf), con, ORACLES[name])


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) > 130
