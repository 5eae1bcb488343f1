"""How many rows of a key fall in the days before each row.

A sliding range frame would add up its whole content again for every row, which grows with the square
of the traffic of a busy key. Here rows are counted per key and instant, and the answer for an instant
is a difference of two running counts: rows up to one second before it, minus rows before the look-back
begins. Among whole seconds the first is the running count of the instant itself. Both are read off one running sum over the instants and the points asked about, and busy keys
are cut into parts (see ``ordered``), so the work grows with the number of instants only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.operators.ordered import DEFAULT_POLICY, SkewPolicy, with_history
from orderlens.sources.staging import staged


def with_backlog(
    df: DataFrame,
    key: str,
    ts: str,
    days: int,
    name: str,
    policy: SkewPolicy = DEFAULT_POLICY,
    at_most: int | None = None,
    looked_at: DataFrame | None = None,
) -> DataFrame:
    """Add ``name``: rows of the same key from ``days`` days up to one second before the row's time.

    Rows with a NULL key or time get NULL. ``at_most`` bounds the rows of ``df`` where known.
    ``looked_at`` is a table with the same rows' key and time that is cheaper to read than ``df``; rows are counted there.
    """
    known = (df if looked_at is None else looked_at).where(f"`{key}` IS NOT NULL AND `{ts}` IS NOT NULL")
    asked = known.select(F.col(key).alias("_key"), F.col(ts).alias("_asked"))
    # Among whole seconds, what comes one second before a row or earlier is all that comes before it.
    whole = looked_at is not None and known.where(f"extract(SECOND FROM `{ts}`) % 1 <> 0").isEmpty()
    counts = asked.groupBy("_key", "_asked").agg(F.count(F.lit(1)).alias("_n"))
    if at_most is None:
        counts = staged(counts, "instants")
        at_most = counts.count()
    # Hot keys are looked for among the rows as stored, each as an instant of its own: counting the instants once more would
    # shuffle them once more. Cuts may fall anywhere.
    each = None if looked_at is None else _points(asked.withColumn("_n", F.lit(1).cast("long")), days, whole)
    running = with_history(
        _points(counts, days, whole), ["_key"], ["_time", "_kind"], before={"_seen": "_rows"}, policy=policy, at_most=3 * at_most,
        looked_at=each,
    )
    if not whole:
        running = running.where("_kind <> 1")
    if "_asked" not in running.columns:
        back = f"CASE _kind WHEN 0 THEN INTERVAL '{days}' DAY WHEN 1 THEN INTERVAL '0' SECOND ELSE INTERVAL '1' SECOND END"
        running = running.withColumn("_asked", F.expr(f"_time + {back}"))
    backlog = running.groupBy("_key", "_asked").agg(F.expr("sum(CASE _kind WHEN 0 THEN -_seen ELSE _seen END)").alias(name))
    same = (F.col(key) == F.col("_key")) & (F.col(ts) == F.col("_asked"))
    return df.join(backlog, same, "left").select(*df.columns, name)


def _points(counts: DataFrame, days: int, whole: bool) -> DataFrame:
    """At one and the same time: first the start of a look-back, then the rows, then its end; among ``whole`` seconds the rows are the end.

    A point without a time zone says by its kind what it was asked for; others, whose days differ in length, carry it along.
    """
    zoned = dict(counts.dtypes)["_asked"] != "timestamp_ntz"
    return counts.selectExpr(
        "_key",
        *(["_asked"] if zoned else []),
        "inline(array("
        f"struct(_asked - INTERVAL '{days}' DAY AS _time, 0 AS _kind, 0L AS _rows), "
        "struct(_asked AS _time, 1 AS _kind, _n AS _rows)"
        f"{'' if whole else ", struct(_asked - INTERVAL '1' SECOND AS _time, 2 AS _kind, 0L AS _rows)"}))",
    )
