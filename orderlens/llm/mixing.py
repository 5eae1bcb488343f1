"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the number of copies it should have. Of all rates that give each source its target of
words and that lie between 0 and ``most``, those nearest to one copy of everything in relative entropy are wanted. They
have the form min(most, exp(dual * size)): one dual variable for each source, the solution of a convex problem whose
gradient is the source's words at these rates less its target.

1. Sizes are counted once and stored; the duals see them only as a histogram (source, size, documents).
2. Targets: shares by weight, held at ``most`` times the source's size; one aggregation over the sources for each round of resharing.
3. Newton steps for all sources at once. A step is one join of the histogram with the duals and one aggregation. Sums are
   of whole numbers (rates in units of 2**-30), so a rerun gives the same bits however rows are dealt out.
4. Rounding: a document takes its whole copies and perhaps one more. Within a source and a class of sizes (powers of two)
   documents stand in the order of a hash less the fraction, and a cut says which take one more. Cuts are chosen from the largest
   class to the smallest; each hands what it could not meet to the next one, so a source misses its target by about
   half of one of its smallest documents. Bins of that order are counted first; only documents in the bins that can hold a cut are ranked.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.sources.staging import broadcast_if_small, discard, staged

WEIGHTS = (1, 2, 3)
MOST = 3
UNIT = 1 << 30  # rates are whole numbers of 1 / UNIT
BINS = 1 << 12  # of the order within a source and class of sizes
NEWTON_STEPS = 120
STEPS_STORED = 3
CLOSE = 1e-9

_NO_ID = -(1 << 63)  # stands for a null id


def words(text: Column) -> Column:
    """Number of maximal runs of characters other than space and tab to carriage return; a null has none."""
    marked = F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "x")
    return F.coalesce(F.length(F.translate(marked, " \t\n\x0b\f\r", "")), F.lit(0)).cast("long")


def _numbered(sources: DataFrame) -> DataFrame:
    """Sources with their place ``s`` (from 0) in the order of code points, null last.

    Dealt out by range; a source's place is that in its part plus the sizes of the parts before it.
    """
    n = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = F.col("source").asc_nulls_last()
    dealt = staged(sources.repartitionByRange(n, order).withColumn("_part", F.spark_partition_id()), "mix_sources")
    parts = F.sort_array(F.collect_list(F.struct("_part", "_n")))  # one entry a part, not a source
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_n")).agg(parts.alias("_all"))
    before = F.aggregate(
        F.filter("_all", lambda x: x._part < F.col("_here._part")), F.lit(0).cast("long"), lambda a, x: a + x._n
    )
    offsets = sizes.select("_all", F.explode("_all").alias("_here")).select(F.col("_here._part").alias("_part"), before.alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1
    return dealt.withColumn("_place", place).join(offsets, "_part").withColumn("s", F.col("_place") + F.col("_before")).drop("_part", "_place", "_before")


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """Adds ``s``, ``weight`` and ``target`` to (source, source_size, …), one row a source.

    The theta of target = min(most * source_size, weight * theta) is found by resharing what stands above the
    limit until nothing does; each round is one aggregation.
    """
    given = F.array(*[F.lit(float(w)) for w in weights])
    rows = _numbered(sources).withColumn("weight", F.get(given, F.pmod("s", F.lit(len(weights))).cast("int")))
    rows = staged(rows, "mix_weights")
    limit = F.col("source_size") * float(most)
    total, theta, capped = float(rows.agg(F.sum("source_size")).first()[0] or 0), 0.0, -1
    while total:
        above = limit <= F.col("weight") * theta if capped >= 0 else F.lit(False)
        row = rows.agg(
            F.count_if(above).alias("n"),
            F.sum(F.when(above, limit).otherwise(0.0)).alias("held"),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if row.n == capped or not row.weight:
            break
        capped, theta = row.n, (total - row.held) / row.weight
    return rows.withColumn("target", F.least(limit, F.col("weight") * theta))


def _rate(size: Column, dual: Column, most: float) -> Column:
    """The rate in whole units: floor(UNIT * min(most, exp(dual * size))). A null dual means the full ``most``."""
    at = dual * size
    full = dual.isNull() | (at >= math.log(most))
    return F.when(full, F.lit(int(most * UNIT))).otherwise(F.least(F.floor(F.exp(at) * UNIT), F.lit(int(most * UNIT)))).cast("long")


def _newton_step(sizes: DataFrame, duals: DataFrame, most: float) -> DataFrame:
    """One step for every source: a Newton step on the logarithm of its words, or the middle of the bracket."""
    known = sizes.join(duals, "s")
    rate = _rate(F.col("size"), F.col("dual"), most)
    mass = (F.col("n") * F.col("size")).cast("decimal(20,0)") * rate.cast("decimal(12,0)")
    slope = F.when(rate < int(most * UNIT), mass * F.col("size").cast("decimal(10,0)")).otherwise(F.lit(0).cast("decimal(38,0)"))
    keep = ["target", "lo", "hi", "dual", "off"]
    sums = known.groupBy("s").agg(
        *[F.first(c).alias(c) for c in keep], (F.sum(mass).cast("double") / UNIT).alias("_words"), (F.sum(slope).cast("double") / UNIT).alias("_slope")
    )
    off = F.col("_words") / F.col("target") - 1
    lo, hi = F.when(off < 0, F.col("dual")).otherwise(F.col("lo")), F.when(off > 0, F.col("dual")).otherwise(F.col("hi"))
    sums = sums.withColumn("_off", off).withColumn("lo", lo).withColumn("hi", hi)
    step = F.col("dual") - F.log(F.col("_words") / F.col("target")) * F.col("_words") / F.col("_slope")
    middle = (F.col("lo") + F.col("hi")) / 2
    good = (F.col("_slope") > 0) & (F.col("_words") > 0)
    good = good & (step > F.col("lo")) & (step < F.col("hi"))
    moved = F.when(F.abs("_off") <= CLOSE, F.col("dual")).when(good, step).otherwise(middle)
    return sums.select("s", "target", "lo", "hi", moved.alias("dual"), F.abs("_off").alias("off"))


def duals(sizes: DataFrame, sources: DataFrame, most: float = MOST) -> DataFrame:
    """(s, dual) for sources whose target lies strictly between 0 and ``most`` times their size.

    ``sizes`` is the histogram (s, size, n) of documents with words.
    """
    rho = F.col("target") / F.col("source_size")
    open_ = sources.where((F.col("target") > 0) & (F.col("target") < F.col("source_size") * float(most)))
    # At the bracket's ends even the smallest document has a rate that gives the target or more (less).
    edge = F.when(rho < 1, F.log(rho) / F.col("least")).otherwise(F.lit(math.log(most)) / F.col("least"))
    start = F.log(rho) * F.col("rows") / F.col("source_size")  # exact if all sizes are equal
    start = F.when((start > F.least(edge, F.lit(0.0))) & (start < F.greatest(edge, F.lit(0.0))), start).otherwise(edge / 2)
    now = open_.select(
        "s", "target", F.least(edge, F.lit(0.0)).alias("lo"), F.greatest(edge, F.lit(0.0)).alias("hi"),
        F.when(rho == 1, F.lit(0.0)).otherwise(start).alias("dual"), F.lit(1.0).alias("off"),
    )
    now = staged(now, "mix_duals")
    for _ in range(0, NEWTON_STEPS, STEPS_STORED):
        worst = now.agg(F.max("off")).first()[0]
        if worst is None or worst <= CLOSE:
            break
        after = now
        for _ in range(STEPS_STORED):
            after = _newton_step(sizes, after, most)
        after = staged(after, "mix_duals")
        discard(now)
        now = after
    return now.select("s", "dual")


def _cuts(ranked: DataFrame, sources: DataFrame) -> DataFrame:
    """(s, class, cut_v, cut_key): documents up to the cut in the order (v, key) take one more copy.

    ``ranked``: s, class, v, key, size, part (the fraction in units) of documents that may take one more.
    """
    bin_ = F.shiftright(F.col("v") + UNIT, 31 - int(math.log2(BINS)))
    ranked = ranked.withColumn("bin", bin_)
    counted = ranked.groupBy("s", "class", "bin").agg(
        F.sum("size").alias("words"), F.sum((F.col("size").cast("decimal(20,0)") * F.col("part").cast("decimal(11,0)"))).alias("mass")
    )
    of = Window.partitionBy("s", "class")
    counted = counted.withColumn("after", F.sum("words").over(of.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)))
    counted = counted.withColumn("goal", F.sum("mass").over(of).cast("double") / UNIT).withColumn("before", F.col("after") - F.col("words"))
    # What a class is handed is at most the size of a document of the class above, so its cut is near its own goal.
    slack = F.expr("shiftleft(16L, class)")
    bins = counted.where((F.col("before") <= F.col("goal") + slack) & (F.col("after") >= F.col("goal") - slack))
    bins = staged(bins.select("s", "class", "bin", "before", "goal"), "mix_bins")
    known = broadcast_if_small(bins.select("s", "class", "bin"), "mix_open_bins")
    near = ranked.join(known, ["s", "class", "bin"]).groupBy("s", "class", "bin", "v", "key").agg(F.sum("size").alias("words"))
    near = near.join(bins, ["s", "class", "bin"])
    inside = Window.partitionBy("s", "class", "bin").orderBy("v", "key").rowsBetween(Window.unboundedPreceding, 0)
    near = near.withColumn("after", F.col("before") + F.sum("words").over(inside))
    entry = F.struct("v", "key", F.col("after").cast("double").alias("after"))
    slack = slack.cast("double")
    close = (F.col("after") >= F.col("goal") - slack) & (F.col("after") - F.col("words") <= F.col("goal") + slack)
    first = F.min(F.col("after") - F.col("words")).cast("double").alias("start")
    classes = near.where(close).groupBy("s", "class").agg(F.first("goal").alias("goal"), first, F.sort_array(F.collect_list(entry)).alias("entries"))
    by_source = classes.groupBy("s").agg(F.sort_array(F.collect_list(F.struct("class", "goal", "start", "entries")), asc=False).alias("all"))
    lowest = F.lit(-(1 << 62)).cast("long")
    cut_type = "array<struct<class:int,v:bigint,key:bigint>>"

    def choose(state: Column, x: Column) -> Column:
        want = x.goal + state.carry
        none = F.struct(lowest.alias("v"), lowest.alias("key"), x.start.alias("after"))
        best = F.aggregate(x.entries, none, lambda b, e: F.when(F.abs(e.after - want) < F.abs(b.after - want), e).otherwise(b))
        made = F.transform(F.array(best), lambda b: F.struct((want - b.after).alias("carry"), F.concat(state.cuts, F.array(F.struct(x["class"].alias("class"), b.v.alias("v"), b.key.alias("key")))).alias("cuts")))
        return made[0]

    begin = F.struct(F.col("missing").alias("carry"), F.array().cast(cut_type).alias("cuts"))
    chosen = by_source.join(sources.select("s", "missing"), "s").select("s", F.aggregate("all", begin, choose).cuts.alias("cuts"))
    flat = chosen.select("s", F.explode("cuts").alias("c"))
    return flat.select("s", F.col("c.class").alias("class"), F.col("c.v").alias("cut_v"), F.col("c.key").alias("cut_key"))


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[float] = WEIGHTS, most: int = MOST,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, rate (double) and copies (long, 0 to ``most``).

    Sources are numbered by code points, null last as a source of its own, and take ``weights`` in turn. A null or empty
    text has size 0, rate 1 and one copy (no words). Rows that repeat an id, source and size take the same number of
    copies. Ties of the order are broken by the id, a null id first. A source without words has target 0; an empty table gives no rows.
    Other columns are not looked at.
    """
    sized = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), words(F.col(text_col)).alias("size"))
    sized = staged(sized, "mix_sizes", "zstd")
    histogram = staged(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "mix_histogram")
    some = F.when(F.col("size") > 0, F.col("size"))
    per = histogram.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.min(some).alias("least"), F.sum(F.when(F.col("size") > 0, F.col("n"))).alias("rows")
    )
    sources = staged(targets(per, weights, most), "mix_targets")
    names = sources.select(F.col("source").alias("_name"), "s")
    same = F.col("source").eqNullSafe(F.col("_name"))
    sizes = staged(histogram.where("size > 0").join(names, same).select("s", "size", "n"), "mix_numbered")
    found = sources.join(duals(sizes, sources, most), "s", "left")
    closed = F.col("source_size") == 0  # nothing to tilt
    found = found.withColumn("dual", F.when(closed, F.lit(0.0)).otherwise(F.col("dual")))
    found = staged(found.select("source", "s", "source_size", "target", "dual"), "mix_found")
    # What the rates in whole units miss of the target is handed to the largest class.
    mass = (F.col("n") * F.col("size")).cast("decimal(20,0)") * _rate(F.col("size"), F.col("dual"), most).cast("decimal(12,0)")
    given = sizes.join(found, "s").groupBy("s").agg((F.first("target") - F.sum(mass).cast("double") / UNIT).alias("missing"))
    known = broadcast_if_small(found.withColumnRenamed("source", "_name"), "mix_known")
    rate = _rate(F.col("size"), F.col("dual"), most)
    placed = sized.join(known, same, "left").withColumn("_rate", rate)
    whole, part = F.floor(F.col("_rate") / UNIT), F.pmod("_rate", F.lit(UNIT))
    key = F.coalesce("doc_id", F.lit(_NO_ID))
    draw = F.shiftrightunsigned(F.xxhash64(key, "s", "size"), 34)
    placed = placed.select(
        "doc_id", "source", "size", "source_size", "target", "s", (F.col("_rate") / UNIT).alias("rate"), whole.cast("long").alias("whole"), part.alias("part"),
        key.alias("key"), (draw - part).alias("v"), (F.length(F.bin("size")) - 1).alias("class"),
    )
    free = (F.col("size") > 0) & (F.col("whole") < most)
    cuts = staged(_cuts(placed.where(free).select("s", "class", "v", "key", "size", "part"), given), "mix_cuts")
    cuts = broadcast_if_small(cuts.withColumnsRenamed({"s": "_s", "class": "_class"}), "mix_known_cuts")
    joined = placed.join(cuts, (F.col("s") == F.col("_s")) & (F.col("class") == F.col("_class")), "left")
    more = free & ((F.col("v") < F.col("cut_v")) | ((F.col("v") == F.col("cut_v")) & (F.col("key") <= F.col("cut_key"))))
    copies = F.col("whole") + F.when(more, 1).otherwise(0)
    return joined.select("doc_id", "source", "size", "source_size", "target", "rate", copies.cast("long").alias("copies"))


def mixture(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[float] = WEIGHTS, most: int = MOST,
) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as ``mix`` says, with all its columns."""
    plan = mix(docs, id_col, text_col, source_col, weights, most).groupBy("doc_id", "source", "size").agg(F.max("copies").alias("_copies"))
    plan = plan.withColumnsRenamed({"doc_id": "_mix_id", "source": "_mix_source", "size": "_mix_size"})
    same = docs[id_col].cast("long").eqNullSafe(F.col("_mix_id")) & docs[source_col].cast("string").eqNullSafe(F.col("_mix_source"))
    joined = docs.join(plan, same & (words(docs[text_col]) == F.col("_mix_size")))
    copies = F.when(F.col("_copies") > 0, F.sequence(F.lit(1).cast("long"), F.col("_copies"))).otherwise(F.array().cast("array<long>"))
    return joined.withColumn("_copy", F.explode(copies)).select(*[docs[c] for c in docs.columns])
