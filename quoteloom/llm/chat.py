"""Chat formatting by event-sourced reconstruction, in DataFrame functions only.

A log holds events of conversations: whole messages, streamed deltas, edits, regenerations.
Folding keeps no state row by row; it is written as two aggregations.  Per message, the last
event that sets its text decides where it begins and later deltas are appended in order; per
conversation, running maxima tell which messages a regeneration or an edit has overtaken.
The surviving messages are rendered with a template whose control strings can't occur inside
a text, so the output can be read back without loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Turn marks by role; any other role is spelled out between marks of its own.
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
ROLE, TEXT, END = "[TURN]", "[TEXT]", "[/TURN]"
# Every control string is one bracket, then one of these.  Text gets a backslash between.
_CONTROL = r"([<\[])(/?s>|<?/?SYS>>|/?INST\]|/?TURN\]|TEXT\])"
_CLOSING = r"(?<=</s>)|(?<=\[/INST\])|(?<=<</SYS>>)|(?<=\[/TURN\])"
# message: sets the text; delta: appends; edit: sets the text and drops what answered it;
# regenerate: empties the message and drops what followed it.
KINDS = ("message", "delta", "edit", "regenerate")


def escape(text: Column) -> Column:
    """Doubles backslashes and puts one inside every control string."""
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), _CONTROL, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def fold(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, position, role, text) of a log.

    ``events``: conv_id, seq, message_id, kind, role, text.  Events count in the order of seq
    (ties: kind, then text); a null kind is a message, a null text is empty, a null
    message_id makes its event a message of its own.  A message stands where its first event
    stands and has the role of the last event that names one.  Messages that began after a
    message and before its last edit or regeneration are gone.  Repeated events count each
    time; an empty log has no messages.
    """
    kind = F.coalesce("kind", F.lit("message"))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), kind)
    key = F.struct(F.col("seq"), rank.alias("rank"), F.coalesce("text", F.lit("")).alias("text"))
    own = F.when(F.col("message_id").isNull(), F.struct("seq", "kind", "role", "text"))
    log = events.select("conv_id", "message_id", own.alias("own"), key.alias("key"), kind.alias("kind"), "role")
    # An own number for each repeated event without a message; others share number 0.
    log = log.withColumn("again", F.when(F.col("message_id").isNull(), F.monotonically_increasing_id()).otherwise(F.lit(0)))
    sets, drops = F.col("kind") != "delta", F.col("kind").isin("edit", "regenerate")
    messages = log.groupBy("conv_id", "message_id", "own", "again").agg(
        F.min("key").alias("first"),
        F.max(F.when(sets, F.struct("key", "kind"))).alias("base"),
        F.max(F.when(drops, F.col("key")))["seq"].alias("dropped_at"),
        F.max(F.when(F.col("role").isNotNull(), F.struct("key", "role")))["role"].alias("role"),
        F.array_sort(F.collect_list(F.when(~sets, F.col("key")))).alias("deltas"),
    )
    begun = F.when(F.col("base.kind") == "regenerate", "").otherwise(F.coalesce("base.key.text", F.lit("")))
    later = F.filter("deltas", lambda d: F.col("base").isNull() | (d > F.col("base.key")))
    text = F.concat(begun, F.array_join(F.transform(later, lambda d: d["text"]), ""))
    ordered = Window.partitionBy("conv_id").orderBy("first", "message_id", "again")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    final = messages.select("conv_id", "message_id", "again", "first", "role", text.alias("text"), "dropped_at")
    final = final.withColumn("overtaken", F.max("dropped_at").over(before))
    final = final.where(F.col("overtaken").isNull() | (F.col("first.seq") > F.col("overtaken")))
    return final.select("conv_id", F.row_number().over(ordered).alias("position"), "role", "text")


def _marks(role: Column, which: int) -> Column:
    other = END if which else F.concat(F.lit(ROLE), escape(role), F.lit(TEXT))
    out = F.lit(other) if isinstance(other, str) else other
    for name, marks in MARKS.items():
        out = F.when(role == name, F.lit(marks[which])).otherwise(out)
    return out


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, loss_mask.

    ``loss_mask`` lists (start, length) in code points of ``formatted`` that a loss is taken
    on: assistant texts, without marks.  A null role is an empty one.  Offsets are running
    sums over a conversation's rows, so a long conversation costs no more per turn; its text
    is one row, as its reader needs it.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = messages.select("conv_id", "position", role.alias("role"), escape(text).alias("body"))
    turns = turns.withColumns({"open": _marks(F.col("role"), 0), "close": _marks(F.col("role"), 1)})
    size = (F.length("open") + F.length("body") + F.length("close")).cast("long")
    before = Window.partitionBy("conv_id").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("at", F.coalesce(F.sum(size).over(before), F.lit(0)))
    span = F.when(
        F.col("role") == "assistant",
        F.struct((F.col("at") + F.length("open")).alias("start"), F.length("body").cast("long").alias("length")),
    )
    grouped = turns.groupBy("conv_id").agg(
        F.count("*").alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("position", F.concat("open", "body", "close").alias("piece"), span.alias("span")))).alias("p"),
    )
    return grouped.select(
        "conv_id", "n_turns", F.array_join("p.piece", "").alias("formatted"),
        F.filter("p.span", lambda s: s.isNotNull()).alias("loss_mask"),
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of (role, text)."""
    pieces = F.filter(F.split(formatted, _CLOSING), lambda p: p != "")

    def turn(p: Column) -> Column:
        # Literal cuts, for a text may hold anything but control strings.
        role, body = F.lit(None).cast("string"), F.lit(None).cast("string")
        for name, (a, b) in MARKS.items():
            here = p.startswith(F.lit(a))
            role = F.when(here, F.lit(name)).otherwise(role)
            body = F.when(here, F.substring(p, F.lit(len(a) + 1), F.length(p) - len(a) - len(b))).otherwise(body)
        here = p.startswith(F.lit(ROLE))
        cut = F.instr(p, TEXT)
        role = F.when(here, F.substring(p, F.lit(len(ROLE) + 1), cut - 1 - len(ROLE))).otherwise(role)
        body = F.when(here, F.substring(p, cut + len(TEXT), F.length(p) - cut - len(TEXT) + 1 - len(END))).otherwise(body)
        return F.struct(unescape(role).alias("role"), unescape(body).alias("text"))

    return F.transform(pieces, turn)


def masked_text(formatted: Column, loss_mask: Column) -> Column:
    """All text under the mask, unescaped, nothing between."""
    parts = F.transform(loss_mask, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return F.array_join(parts, "")


def format_chats(events: DataFrame) -> DataFrame:
    """``render`` of ``fold``: the finished conversations of a log of events."""
    return render(fold(events))
