"""Calendar expressions over zone-less timestamps. Arguments are column names or SQL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Black Fridays and the public holidays considered, 2016-2018.
BLACK_FRIDAYS = ("2016-11-25", "2017-11-24")
HOLIDAYS = (
    "2016-12-25",
    "2017-01-01",
    "2017-04-14",
    "2017-04-21",
    "2017-05-01",
    "2017-09-07",
    "2017-10-12",
    "2017-11-02",
    "2017-11-15",
    "2017-12-25",
    "2018-01-01",
    "2018-03-30",
    "2018-04-21",
    "2018-05-01",
    "2018-09-07",
)
# Weekday names, Monday = 0.
DAY_NAMES = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


def seconds_between(earlier: str, later: str) -> Column:
    return F.expr(f"timestampdiff(SECOND, {earlier}, {later})")


def whole_days_between(earlier: str, later: str) -> Column:
    """Elapsed whole days, rounded down: 10 hours before is -1 day, 14 hours after is 0 days."""
    return F.expr(f"floor(timestampdiff(SECOND, {earlier}, {later}) / 86400)")


def month_start(ts: str) -> Column:
    return F.expr(f"CAST(date_trunc('month', {ts}) AS timestamp_ntz)")


def is_one_of(ts: str, days: tuple[str, ...]) -> Column:
    """1 where the timestamp falls on one of the days, else 0 (also for an unknown time)."""
    listed = ", ".join(f"DATE'{d}'" for d in days)
    return F.expr(f"CASE WHEN CAST({ts} AS date) IN ({listed}) THEN 1 ELSE 0 END")


def days_to_nearest(ts: str, days: tuple[str, ...] = HOLIDAYS) -> Column:
    """Calendar days to the closest of the given days, before or after."""
    listed = ", ".join(f"abs(datediff(CAST({ts} AS date), DATE'{d}'))" for d in days)
    return F.expr(f"least({listed})" if len(days) > 1 else listed)


def day_name(number: str) -> Column:
    names = ", ".join(f"'{n}'" for n in DAY_NAMES)
    return F.expr(f"try_element_at(array({names}), CAST({number} AS int) + 1)")
