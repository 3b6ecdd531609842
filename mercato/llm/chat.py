"""Chat formatting by replaying conversation logs. DataFrame functions only.

A log has the columns conv_id, seq, turn, kind, role, text. Kinds: ``message`` sets a turn, ``delta``
appends streamed text, ``edit`` replaces the text, ``regenerate`` clears the turn and removes what was logged
before it (or at the same seq) of the later turns; a later turn lives on with what comes after. Events are folded
per turn in order of seq first; a conversation meets in one group only as its final messages, which one rendered
row has to hold anyway.

The template is ``<|im_start|>role<|im_sep|>text<|im_end|>``. Control strings inside roles and texts get
one backslash after their first character (``<\\|im_end|>``), one more if they have some already, so the
escape is undone by taking one away. Loss spans are code point ranges of the assistant texts.

Nulls: null text and null role are empty, a null turn or seq comes last, a null conv_id is a conversation.
Ties: events of one turn and seq come in the order of KINDS, then by text; rows of one turn number are turns of
their own, ordered by role and text. An unknown kind appends like a delta. Empty log: empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
# fixed values: control strings of this and of other public templates
ANGLED = r"(\|[A-Za-z_]+\|>|/?s>|</?SYS>>)"
SQUARE = r"(/?INST\])"

#: The order of events with equal seq; a delta goes on from what the others set.
KINDS = ["message", "edit", "regenerate", "delta"]


def escaped(text: Column) -> Column:
    angled = F.regexp_replace(text, r"<(\\*)" + ANGLED, r"<\\$1$2")
    return F.regexp_replace(angled, r"\[(\\*)" + SQUARE, r"[\\$1$2")


def unescaped(text: Column) -> Column:
    angled = F.regexp_replace(text, r"<\\(\\*)" + ANGLED, "<$1$2")
    return F.regexp_replace(angled, r"\[\\(\\*)" + SQUARE, "[$1$2")


def events_of(rows: DataFrame) -> DataFrame:
    """A table of finished turns as a log: other texts arrive as a first half and an edit, assistant texts as a first
    half that is regenerated and then streamed in two deltas."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    turns = rows.select(
        "conv_id", F.row_number().over(order).cast("bigint").alias("turn"), role.alias("role"), text.alias("text")
    )
    turns = turns.withColumn("half", F.floor(F.char_length("text") / 2).cast("int"))
    first, rest = F.expr("left(text, half)"), F.expr("substring(text, half + 1)")

    def event(kind: str, part: Column, late: int) -> Column:
        seq = F.col("turn") * 4 + late
        return F.struct(seq.alias("seq"), F.lit(kind).alias("kind"), part.alias("text"))

    streamed = [event("message", first, 0), event("regenerate", F.lit(""), 1), event("delta", first, 2), event("delta", rest, 3)]
    edited = [event("message", first, 0), event("edit", F.col("text"), 1)]
    both = F.when(F.col("role") == "assistant", F.array(*streamed)).otherwise(F.array(*edited))
    log = turns.select("conv_id", "turn", "role", F.explode(both).alias("e"))
    return log.select("conv_id", "turn", "role", "e.*")


def folded(log: DataFrame) -> DataFrame:
    """conv_id, turn, role, text: the final messages of every conversation."""
    seq = F.coalesce("seq", F.lit((1 << 63) - 1))
    place = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.coalesce("kind", F.lit("")))
    kind = F.when(place > 0, place).otherwise(len(KINDS)).cast("int")
    event = F.struct(seq.alias("seq"), kind.alias("kind"), F.coalesce("text", F.lit("")).alias("text"))
    turns = log.groupBy("conv_id", "turn").agg(
        F.sort_array(F.collect_list(event)).alias("events"),
        F.max(F.when(F.col("kind") == "regenerate", seq)).alias("redone"),
        F.max_by("role", F.when(F.col("role").isNotNull(), seq)).alias("role"),
    )
    before = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last())
    earlier = F.max("redone").over(before.rowsBetween(Window.unboundedPreceding, -1))
    left = F.filter("events", lambda e: F.col("cleared_at").isNull() | (e["seq"] > F.col("cleared_at")))
    # the text is what the last event that sets it brings, and all deltas after that one
    resets = F.transform(F.filter("left", lambda e: e["kind"] < len(KINDS)), lambda e: F.struct(e["seq"], e["kind"]))
    reset = F.array_max(resets)
    live = F.filter("left", lambda e: F.col("reset").isNull() | (F.struct(e["seq"], e["kind"]) >= F.col("reset")))
    return (
        turns.withColumn("cleared_at", earlier)
        .withColumn("left", left)
        .filter(F.size("left") > 0)
        .withColumn("reset", reset)
        .withColumn("text", F.array_join(F.transform(live, lambda e: e["text"]), ""))
        .select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), "text")
    )


def rendered(log: DataFrame) -> DataFrame:
    """conv_id, formatted, loss: the rendered conversation and its spans (start, length) under the loss mask."""
    head = F.concat(F.lit(START), escaped(F.col("role")), F.lit(SEPARATOR))
    pieces = folded(log).withColumns({"head": head, "body": escaped(F.col("text"))})
    pieces = pieces.withColumn("piece", F.concat("head", "body", F.lit(END)))
    before = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last())
    offset = F.sum(F.char_length("piece")).over(before.rowsBetween(Window.unboundedPreceding, -1))
    start = F.coalesce(offset, F.lit(0)) + F.char_length("head")
    last = F.coalesce("turn", F.lit((1 << 63) - 1))
    span = F.struct(
        last.alias("turn"),
        "piece",
        (F.col("role") == "assistant").alias("learn"),
        start.cast("int").alias("start"),
        F.char_length("body").alias("length"),
    )
    turns = pieces.withColumn("span", span).groupBy("conv_id").agg(F.sort_array(F.collect_list("span")).alias("turns"))
    learnt = F.filter("turns", lambda t: t["learn"])
    return turns.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform(learnt, lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"))).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (role, text) and the learnt texts, both taken out of the rendered string."""
    pieces = F.filter(F.split("formatted", r"<\|im_end\|>"), lambda p: p != "")

    def turn(piece: Column) -> Column:
        parts = F.split(piece, r"<\|im_sep\|>", 2)
        role = F.substring(parts[0], len(START) + 1, 1 << 30)
        return F.struct(unescaped(role).alias("role"), unescaped(parts[1]).alias("text"))

    texts = F.transform(
        "loss", lambda s: unescaped(F.substr(F.col("formatted"), s["start"] + 1, s["length"]))
    )
    return formatted.select("conv_id", "formatted", F.transform(pieces, turn).alias("turns"), texts.alias("learnt"))
