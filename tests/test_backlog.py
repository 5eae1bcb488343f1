import numpy as np
import pandas as pd
import pytest

from orderlens.operators.backlog import with_backlog
from orderlens.operators.ordered import SkewPolicy
from tests.conftest import at


def _frame(spark, rows):
    return spark.createDataFrame(rows, "id int, state string, ts timestamp_ntz")


def test_frame_ends_are_inclusive(spark):
    now = at("2018-01-10 00:00:00")
    rows = [
        (1, "A", at("2018-01-03 00:00:00")),  # exactly seven days before
        (2, "A", at("2018-01-02 23:59:59")),  # one second too early
        (3, "A", at("2018-01-09 23:59:59")),  # exactly one second before
        (4, "A", now),
        (5, "A", now),  # same time: not counted
        (6, "B", at("2018-01-09 12:00:00")),
        (7, None, now),
    ]
    out = {r["id"]: r["n"] for r in with_backlog(_frame(spark, rows), "state", "ts", 7, "n").collect()}
    assert out[4] == out[5] == 2
    assert out[2] == 0 and out[1] == 1 and out[6] == 0
    assert out[7] is None


@pytest.mark.parametrize("policy", [SkewPolicy(), SkewPolicy(100, 1.0)], ids=["plain", "cut"])
def test_equals_plain_window(spark, policy):
    rng = np.random.default_rng(1)
    start = pd.Timestamp("2017-01-01")
    rows = [
        (i, "hot" if rng.random() < 0.5 else str(rng.integers(0, 3)),
         (start + pd.Timedelta(seconds=int(rng.integers(0, 40 * 86400 // 600)) * 600)).to_pydatetime())
        for i in range(2000)
    ]
    df = _frame(spark, rows)
    plain = df.selectExpr(
        "id",
        "count(id) OVER (PARTITION BY state ORDER BY ts RANGE BETWEEN INTERVAL '3 00:00:00' DAY TO SECOND PRECEDING "
        "AND INTERVAL '0 00:00:01' DAY TO SECOND PRECEDING) AS n",
    )
    bucketed = with_backlog(df, "state", "ts", 3, "n", policy).select("id", "n")
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, bucketed.collect()))


def test_fractions_of_a_second_before_do_not_count(spark):
    rows = [(1, "A", at("2018-01-01 00:00:00.500")), (2, "A", at("2018-01-01 00:00:01.000")), (3, "A", at("2018-01-01 00:00:01.500"))]
    out = {r["id"]: r["n"] for r in with_backlog(_frame(spark, rows), "state", "ts", 7, "n").collect()}
    assert out == {1: 0, 2: 0, 3: 1}
