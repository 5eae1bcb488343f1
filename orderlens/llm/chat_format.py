"""Conversations rendered as one training text each; DataFrame operations only.

Grammar of the output, one turn after the other with nothing between::

    turn  = "<s>[" tag "] " text "</s>"
    tag   = ("INST" | "/INST" | "ROLE=" role) ["&"]        user, assistant, any other role

``&`` after the tag says that the text is escaped. Every conversation is first rendered as it is, parsed
again and compared with its source. Where a recovered turn differs, the turns that hold control strings
are escaped; where that is not enough all turns are. The parser rejects a text that contains a control
string, so none reaches the output from inside a text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.sources.staging import staged

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
ENTITIES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lsqb;"))
ROLE_ENTITIES = (*ENTITIES, ("]", "&rsqb;"))


def _swap(text: Column, pairs) -> Column:
    return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), pairs, text)


def escape(text: Column, pairs=ENTITIES) -> Column:
    return _swap(text, pairs)


def unescape(text: Column, pairs=ENTITIES) -> Column:
    return _swap(text, [(b, a) for a, b in reversed(pairs)])


def _holds_control(text: Column) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(c)) for c in CONTROL])


def _header(role: Column, escaped: Column) -> Column:
    tag = (
        F.when(role == "user", F.lit("INST"))
        .when(role == "assistant", F.lit("/INST"))
        .otherwise(F.concat(F.lit("ROLE="), escape(role, ROLE_ENTITIES)))
    )
    return F.concat(F.lit("<s>["), tag, F.when(escaped, F.lit("&")).otherwise(F.lit("")), F.lit("] "))


def _render(turns: Column, escaped) -> Column:
    """Rendered turns; ``escaped`` tells of each source turn whether its text is escaped."""

    def one(t: Column) -> Column:
        flag = escaped(t)
        return F.concat(_header(t["role"], flag), F.when(flag, escape(t["text"])).otherwise(t["text"]), F.lit("</s>"))

    return F.transform(turns, one)


def parse(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation; a turn outside the grammar has a null text."""

    def one(piece: Column) -> Column:
        close = F.instr(piece, "] ")
        tag = piece.substr(F.lit(5), close - 5)
        escaped = F.endswith(tag, F.lit("&"))
        name = F.when(escaped, tag.substr(F.lit(1), F.char_length(tag) - 1)).otherwise(tag)
        role = (
            F.when(name == "INST", F.lit("user"))
            .when(name == "/INST", F.lit("assistant"))
            .otherwise(unescape(name.substr(F.lit(6), F.char_length(name)), ROLE_ENTITIES))
        )
        raw = piece.substr(close + 2, F.char_length(piece))
        good = F.startswith(piece, F.lit("<s>[")) & ~_holds_control(raw)
        text = F.when(good, F.when(escaped, unescape(raw)).otherwise(raw))
        return F.struct(role.alias("role"), text.alias("text"))

    pieces = F.split(formatted, "</s>", -1)
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), one)


def _same(turns: Column, recovered: Column) -> Column:
    plain = F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return F.coalesce(plain == recovered, F.lit(False))


def format_conversations(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: conv_id, turns (source), formatted, loss_spans (start, length of assistant texts
    in ``formatted``, counted in characters from 0, and whether the text there is escaped).

    Turns go by number, then role, then text; a null number comes first. A null text or role counts as empty; a row
    without a conversation id is a conversation of its own. Repeated rows are repeated turns; extra columns do not
    matter. A conversation is one text, so one task holds it; the work grows with its length.
    """
    cell = F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), text_column(text).alias("text")
    )
    alone = F.when(F.col(conv).isNull(), F.monotonically_increasing_id())
    grouped = rows.select(F.col(conv).alias("conv_id"), alone.alias("_row"), cell.alias("t")).groupBy("conv_id", "_row")
    whole = grouped.agg(F.sort_array(F.collect_list("t")).alias("turns"))
    plain = whole.withColumn("_first", F.array_join(_render(F.col("turns"), lambda t: F.lit(False)), ""))
    tried = plain.withColumn("_level", F.when(_same(F.col("turns"), parse(F.col("_first"))), 0).otherwise(1))

    def conflicting(t: Column) -> Column:
        single = F.concat(_header(t["role"], F.lit(False)), t["text"], F.lit("</s>"))
        back = parse(single)
        return ~F.coalesce((F.size(back) == 1) & (F.element_at(back, 1)["text"] == t["text"]), F.lit(False))

    second = F.when(F.col("_level") == 0, F.col("_first")).otherwise(
        F.array_join(_render(F.col("turns"), conflicting), "")
    )
    tried = tried.withColumn("_second", second)
    still = (F.col("_level") == 1) & ~_same(F.col("turns"), parse(F.col("_second")))
    tried = tried.withColumn("_level", F.when(still, 2).otherwise(F.col("_level")))
    level = F.col("_level")
    # Stored: what the level is must not be found again for every turn.
    tried = staged(tried.select("conv_id", "_row", "turns", "_level"), "chat_levels")
    level = F.col("_level")
    # The pieces of the attempt that came back identical, then the place of each text in it.
    pieces = _render(F.col("turns"), lambda t: ((level == 1) & conflicting(t)) | (level == 2))
    flat = tried.select("conv_id", "_row", F.posexplode(F.arrays_zip(F.col("turns").alias("t"), pieces.alias("piece"))).alias("pos", "x"))
    flat = flat.select("conv_id", "_row", "pos", F.col("x.t").alias("t"), F.col("x.piece").alias("piece"))
    order = Window.partitionBy("conv_id", "_row").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    n, head = F.char_length("piece").cast("int"), F.instr("piece", "] ") + 1
    placed = flat.withColumn("_end", F.sum(n).over(order).cast("int"))
    span = F.struct(
        (F.col("_end") - n + head).alias("start"), (n - head - len("</s>")).alias("length"),
        F.startswith(F.col("piece"), F.lit("<s>[/INST&] ")).alias("escaped"),
    )
    placed = placed.select("conv_id", "_row", F.struct("pos", "t", "piece", F.when(F.col("t.role") == "assistant", span).alias("span")).alias("x"))
    whole = placed.groupBy("conv_id", "_row").agg(F.sort_array(F.collect_list("x")).alias("all"))
    done = whole.select(
        "conv_id", F.transform("all", lambda x: x["t"]).alias("turns"), F.array_join(F.transform("all", lambda x: x["piece"]), "").alias("formatted"),
        F.array_compact(F.transform("all", lambda x: x["span"])).alias("loss_spans"),
    )
    return staged(done, "chat_formatted")


def text_column(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, recovered turns, loss_text (all text under the loss mask, unescaped) and formatted."""

    def under(s: Column) -> Column:
        raw = F.col("formatted").substr(s["start"] + 1, s["length"])
        return F.when(s["escaped"], unescape(raw)).otherwise(raw)

    loss = F.array_join(F.transform("loss_spans", under), "")
    return formatted.select("conv_id", parse(F.col("formatted")).alias("recovered"), loss.alias("loss_text"), "formatted")


def digest(formatted: DataFrame) -> DataFrame:
    lines = F.transform("recovered", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read_back(formatted).select(
        "conv_id",
        F.size("recovered").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
