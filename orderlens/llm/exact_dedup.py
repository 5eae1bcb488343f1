"""Exact deduplication by deterministic block naming; DataFrame operations only.

A text is cut into blocks of a fixed number of characters. Distinct blocks are sorted, in ranges of their hash, and
numbered: equal blocks, and only they, get one integer name. Then adjacent pairs of names are named in
the same way, again and again, until every text is one name. No step compares hashes in place of text,
so the identity is free of collisions.

Only texts that can have an equal are named: one whose length and 64-bit hash nobody shares differs
from every other text. A hash that two different texts share costs work, never a wrong result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import settle, text_of
from orderlens.sources.staging import broadcast_if_small

BLOCK_CHARS = 1024


def _named(rows: DataFrame, *content: str) -> DataFrame:
    """Distinct ``content`` with an integer name each; sorted in ranges of its hash, then by itself, so names follow that order.

    Ranges are found from a sample on the driver, which so gets eight bytes for a block and not its text.
    """
    at = F.xxhash64(*content)
    ordered = rows.select(*content).distinct().repartitionByRange(at).sortWithinPartitions(at, *content)
    return settle(ordered.withColumn("name", F.monotonically_increasing_id()), "names")


def block_identity(rows: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(_row, _size, _name) for rows (_row, _text): equal texts, and only they, share (_size, _name).

    _size is the number of blocks; an empty text is one empty block.
    """
    size = F.greatest(F.lit(1), F.ceil(F.char_length("_text") / F.lit(block_chars))).cast("int")
    cut = (
        rows.select("_row", "_text", size.alias("_size"))
        .select("_row", "_text", "_size", F.explode(F.sequence(F.lit(0), F.col("_size") - 1)).alias("at"))
        .select(
            "_row", "_size", "at",
            F.substring("_text", F.col("at") * block_chars + 1, F.lit(block_chars)).alias("block"),
        )
    )
    names = _named(cut, "block")
    now = settle(cut.join(names, "block").select("_row", "_size", "at", "name"), "named")
    done = now.where("_size = 1").select("_row", "_size", F.col("name").alias("_name"))
    longest = now.agg(F.max("_size")).first()[0] or 1
    width = 1
    while width < longest:
        # Texts that take part still have more than one name; pairs (2i, 2i+1) become i, an odd one out stays alone.
        pairs = (
            now.where(F.col("_size") > width)
            .groupBy("_row", "_size", F.floor(F.col("at") / 2).cast("int").alias("at"))
            .agg(
                F.max(F.when(F.col("at") % 2 == 0, F.col("name"))).alias("left"),
                F.max(F.when(F.col("at") % 2 == 1, F.col("name"))).alias("right"),
            )
            .withColumn("right", F.coalesce("right", F.lit(-1)))
        )
        pairs = settle(pairs, "pairs")
        named = _named(pairs, "left", "right")
        width *= 2
        now = settle(pairs.join(named, ["left", "right"]).select("_row", "_size", "at", "name"), "named")
        done = done.unionByName(
            now.where((F.col("_size") <= width)).select("_row", "_size", F.col("name").alias("_name"))
        )
    return done


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """One row per input row: _id, _keep_id, _group_size, _kept, _sha256 and, named _col_<name>, the columns
    in ``keep``.

    Texts are equal when identical without any change; a null text counts as empty. Of equal texts the row
    with the largest id stays; rows that repeat both id and text are a group of their own size of which one
    stays; a null id is smaller than any other. Extra columns do not matter, an empty table gives no rows.
    """
    text = text_of(text_col)
    rows = docs.select(
        F.col(id_col).alias("_id"), text.alias("_text"), F.octet_length(text).alias("_bytes"),
        F.xxhash64(text).alias("_hash"), *[F.col(c).alias(f"_col_{c}") for c in keep],
    )
    shared = rows.groupBy("_bytes", "_hash").count().where("count > 1").select("_bytes", "_hash")
    shared = broadcast_if_small(shared, "shared")
    kept = [F.col(f"_col_{c}") for c in keep]
    single = rows.join(shared, ["_bytes", "_hash"], "left_anti").select(
        "_id", F.col("_id").alias("_keep_id"), F.lit(1).cast("long").alias("_group_size"), F.lit(True).alias("_kept"),
        F.sha2("_text", 256).alias("_sha256"), *kept,
    )
    several = rows.join(shared, ["_bytes", "_hash"], "left_semi").drop("_bytes", "_hash")
    several = settle(several.withColumn("_row", F.monotonically_increasing_id()), "several")
    identity = settle(
        block_identity(several.select("_row", "_text")).join(several.select("_row", "_id"), "_row"), "identity"
    )
    groups = identity.groupBy("_size", "_name").agg(
        F.max(F.struct("_id", "_row")).alias("_best"), F.count("*").alias("_group_size")
    )
    decided = identity.join(groups, ["_size", "_name"]).select(
        "_row", F.col("_best._id").alias("_keep_id"), "_group_size", (F.col("_best._row") == F.col("_row")).alias("_kept")
    )
    grouped = several.join(decided, "_row").select(
        "_id", "_keep_id", "_group_size", "_kept", F.sha2("_text", 256).alias("_sha256"), *kept
    )
    return single.unionByName(grouped)


def dedup_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were."""
    stays = exact_groups(docs, id_col, text_col, tuple(docs.columns)).where("_kept")
    return stays.select(*[F.col(f"_col_{c}").alias(c) for c in docs.columns])
