"""Chat formatting in budgeted windows, with built-in functions only.

A conversation's turns are laid end to end by their tokens; prefix sums place each turn. The line of tokens is cut
into cells of one span's budget: turns that lie within one cell make a window, and a turn across a border is a
window of its own, so a window keeps to its budget unless one turn alone is longer (it is never cut). Every
window begins with the system turn and with those turns before it that fit `history` tokens, marked as
repeated; the loss mask covers the new assistant texts only.

Template: `<|turn|>role<|text|>text<|end|>`, and `<|again|>` in place of `<|turn|>` for a repeated turn. In roles and texts `&` is written
`&amp;` and `<` is written `&lt;`, so no marker can occur in them and the way back is exact.

Defined results: a null text, role is empty; turns are ordered by turn (null last), role, text, so ties and repeated rows keep
a fixed order; a null conv_id is a conversation of its own; an empty table gives an empty result; further columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockflow.session import settle

TURN, AGAIN, TEXT, END = "<|turn|>", "<|again|>", "<|text|>", "<|end|>"
#: Turns with numbers in one range of so many are ordered together; ranges are joined by their sums.
RANGE = 64


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def tokens(text: Column) -> Column:
    """Words and single marks, and four for the template."""
    return F.regexp_count(text, F.lit(r"\w+|[^\w\s]")).cast("long") + 4


def placed(turns: DataFrame) -> DataFrame:
    """Each turn with `number` (1, 2, ...) and `start`, the tokens before it in its conversation."""
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv"),
        F.coalesce(F.col("turn").cast("long"), F.lit(1 << 62)).alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("tokens", tokens(F.col("text"))).withColumn("part", F.floor(F.col("turn") / RANGE))
    # The order inside a range of turns first, then one row per range: a very long conversation is no single task's work.
    inside = W.partitionBy("conv", "part").orderBy("turn", "role", "text").rowsBetween(W.unboundedPreceding, 0)
    local = settle(
        rows.withColumn("number", F.count("*").over(inside)).withColumn("start", F.sum("tokens").over(inside) - F.col("tokens")),
        "chat-turns",
    )
    before = W.partitionBy("conv").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = (
        local.groupBy("conv", "part")
        .agg(F.count("*").alias("n"), F.sum("tokens").alias("t"))
        .select(
            F.col("conv").alias("c"),
            F.col("part").alias("p"),
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"),
            F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t_before"),
        )
    )
    return local.join(parts, F.col("conv").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))).select(
        "conv",
        "role",
        "text",
        "tokens",
        (F.col("number") + F.col("n_before")).alias("number"),
        (F.col("start") + F.col("t_before")).alias("start"),
    )


def _piece(mark: Column) -> Column:
    return F.concat(mark, escape(F.col("role")), F.lit(TEXT), escape(F.col("text")), F.lit(END))


def windows(turns: DataFrame, budget: int = 1024, history: int = 256) -> DataFrame:
    """Formatted windows: conv_id, window (its first new turn's number), formatted, loss (array of start and length, in characters).

    A system turn longer than a quarter of the budget leaves the spans half of the budget.
    """
    told = settle(placed(turns), "chat-placed")
    system = told.where((F.col("number") == 1) & (F.col("role") == "system")).select(
        F.col("conv").alias("c"), F.struct("role", "text").alias("system"), F.col("tokens").alias("system_tokens")
    )
    room = F.greatest(F.lit(budget - history) - F.coalesce("system_tokens", F.lit(0)), F.lit(budget // 2))
    spans = (
        told.join(system, F.col("conv").eqNullSafe(F.col("c")), "left")
        .withColumn("room", room)
        .withColumn("cell", F.floor(F.col("start") / F.col("room")))
        .withColumn("last_cell", F.floor((F.col("start") + F.col("tokens") - 1) / F.col("room")))
        .drop("c")
    )
    spans = settle(spans, "chat-spans")
    firsts = spans.groupBy("conv", "cell", "last_cell").agg(F.min(F.struct("start", "number", "system")).alias("first"))
    first = firsts.select(
        F.col("conv").alias("c"), F.col("cell").alias("at"), F.col("last_cell").alias("to"), F.col("first.start").alias("from"),
        F.col("first.number").alias("window"), F.col("first.system").alias("system"),
    )
    key = F.col("conv").eqNullSafe(F.col("c"))
    is_system = (F.col("number") == 1) & (F.col("role") == "system")
    loss = F.col("role") == "assistant"
    new = spans.drop("system").join(first, key & (F.col("cell") == F.col("at")) & (F.col("last_cell") == F.col("to"))).select(
        "conv", "window", "number", _piece(F.lit(TURN)).alias("piece"),
        F.when(loss, F.length(F.lit(TURN)) + F.length(escape(F.col("role"))) + F.length(F.lit(TEXT))).alias("skip"),
    )
    # History reaches back less than a cell, so a turn can only be wanted by windows that begin in its cell or the next one.
    near = spans.drop("system", "last_cell").where(~is_system).withColumn("near", F.explode(F.array(F.col("cell"), F.col("cell") + 1)))
    wanted = (F.col("start") < F.col("from")) & (F.col("start") >= F.col("from") - history)
    again = near.join(first, key & (F.col("near") == F.col("at")) & wanted).select(
        "conv", "window", "number", _piece(F.lit(AGAIN)).alias("piece"), F.lit(None).cast("int").alias("skip")
    )
    kept = first.where(F.col("system").isNotNull() & (F.col("window") > 1)).select(
        F.col("c").alias("conv"), "window", F.lit(1).cast("long").alias("number"), F.col("system.role").alias("role"), F.col("system.text").alias("text")
    )
    kept = kept.select("conv", "window", "number", _piece(F.lit(AGAIN)).alias("piece"), F.lit(None).cast("int").alias("skip"))
    pieces = (
        new.unionByName(again)
        .unionByName(kept)
        .groupBy("conv", "window")
        .agg(F.sort_array(F.collect_list(F.struct("number", "piece", "skip"))).alias("pieces"))
    )

    def step(state: Column, piece: Column) -> Column:
        size = F.length(piece["piece"])
        here = F.struct(
            (state["at"] + piece["skip"]).cast("int").alias("start"),
            (size - piece["skip"] - len(END)).cast("int").alias("length"),
        )
        spans = F.when(piece["skip"].isNull(), state["spans"]).otherwise(F.concat(state["spans"], F.array(here)))
        return F.struct((state["at"] + size).cast("int").alias("at"), spans.alias("spans"))

    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    return pieces.select(
        F.col("conv").alias("conv_id"),
        "window",
        F.array_join(F.transform("pieces", lambda x: x["piece"]), "").alias("formatted"),
        F.aggregate("pieces", empty, step)["spans"].alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the windows alone: turns in order, text under the loss mask, and sizes.

    The digests run over a whole conversation, so its texts meet in one row here; the windows do not need that.
    """
    pieces = F.filter(F.split("formatted", r"<\|end\|>"), lambda x: F.startswith(x, F.lit(TURN)))
    bodies = F.transform(pieces, lambda x: F.split(F.substr(x, F.lit(len(TURN) + 1)), r"<\|text\|>", 2))
    lines = F.transform(bodies, lambda x: F.concat(unescape(x[0]), F.lit("\n"), unescape(x[1]), F.lit("\n")))
    losses = F.transform("loss", lambda x: unescape(F.substr(F.col("formatted"), x["start"] + 1, x["length"])))
    read = formatted.select(
        "conv_id", "window", F.size(pieces).alias("n"), F.array_join(lines, "").alias("lines"),
        F.array_join(losses, "").alias("losses"), F.length("formatted").alias("chars"),
    )
    whole = read.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("window", "lines", "losses"))).alias("parts"),
        F.sum("chars").cast("long").alias("formatted_chars"),
    )
    joined = whole.select(
        "conv_id", "n_turns", "formatted_chars",
        F.array_join(F.transform("parts", lambda x: x["lines"]), "").alias("lines"),
        F.array_join(F.transform("parts", lambda x: x["losses"]), "").alias("losses"),
    )
    return joined.select(
        "conv_id", "n_turns", F.sha2("lines", 256).alias("turns_sha256"), F.length("losses").cast("long").alias("loss_chars"),
        F.sha2("losses", 256).alias("loss_sha256"), "formatted_chars",
    )
