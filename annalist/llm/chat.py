"""Chat formatting: conversations rebuilt from an event log and rendered with a loss mask.

A log holds streamed deltas, edits and regenerations, numbered over a conversation.
Events are partitioned by conversation and ordered by that number: a delta adds to
its message, an edit replaces what the message holds, and a regeneration empties it
and takes back the messages behind it, as these answered what is gone. Only what
follows the last replacement counts, so a fold is two maxima and an ordered
concatenation.
Messages are then rendered in a template whose marks cannot occur inside texts.
Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The marks of the template.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Control strings as a pattern: what opens them, and the rest. Besides the template's own these are other common ones.
_OPEN, _REST = r"(<|\[)", r"(\|[A-Za-z0-9_]+\|>|/?s>|</?SYS>>|/?INST\])"
KINDS = ("delta", "edit", "regenerate")


def escaped(text: Column) -> Column:
    """Control strings get a backslash behind their first character; those with backslashes there one more."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _OPEN + r"(\\*)" + _REST, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    """The reverse of :func:`escaped`, whatever the text."""
    return F.regexp_replace(text, _OPEN + r"\\(\\*)" + _REST, "$1$2$3")


def folded(events: DataFrame) -> DataFrame:
    """Final messages ``conv_id, message, role, text`` of events ``conv_id, seq, message, kind, role, text``.

    ``seq`` counts over a conversation. A regeneration drops all earlier events of
    messages of a higher number; a message without an event left is gone. Of a
    message the last edit or regeneration counts and the deltas after it, in order
    of ``seq``; a tie in ``seq`` is ordered by kind, then text. Other kinds and a
    null kind are ignored, but their message stays. The role is the first one
    given. Null texts read as empty, a null message comes before all others.
    """
    number = F.coalesce(F.col("message").cast("long"), F.lit(-(2**62)))
    before = Window.partitionBy("conv_id").orderBy("_number").rangeBetween(Window.unboundedPreceding, -1)
    taken = F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).over(before)
    narrow = events.select("conv_id", "message", "seq", "kind", "role", F.coalesce("text", F.lit("")).alias("text"), number.alias("_number"))
    left = narrow.withColumn("taken", taken).where(F.col("taken").isNull() | (F.col("seq") > F.col("taken")))
    place = F.struct("seq", "kind", "text")
    last = F.max(F.when(F.col("kind").isin("edit", "regenerate"), place)).over(Window.partitionBy("conv_id", "message"))
    counted = left.select("conv_id", "message", "seq", "kind", "role", "text", place.alias("place"), last.alias("last"))
    holds = (F.col("kind") == "delta") & (F.col("last").isNull() | (F.col("place") > F.col("last")))
    holds = holds | ((F.col("kind") == "edit") & (F.col("place") == F.col("last")))
    parts = F.sort_array(F.collect_list(F.when(holds, F.struct("seq", "kind", "text"))))
    role = F.min(F.when(F.col("role").isNotNull(), F.struct("seq", "role")))
    text = F.array_join(F.transform(F.col("parts"), lambda p: p["text"]), "")
    return counted.groupBy("conv_id", "message").agg(parts.alias("parts"), role.alias("first")).select("conv_id", "message", F.col("first.role").alias("role"), text.alias("text"))


def rendered(messages: DataFrame, learned: str = "assistant") -> DataFrame:
    """``conv_id, formatted, loss_mask``: a conversation as one string, and where the loss counts.

    Messages stand in order of ``message``. Each is TURN, role, TEXT, text, END,
    role and text escaped; a null role or text reads as empty. ``loss_mask``
    lists spans by code points: ``turn`` counts turns from 0, ``start`` counts
    from the turn's first character behind TURN, ``offset`` from the start of
    ``formatted``. A conversation becomes one value, which Spark limits to 2 GB;
    only its rendered messages, no events, meet in a task.
    """
    role, text = escaped(F.col("role")), escaped(F.col("text"))
    parts = messages.select("conv_id", "message", F.coalesce(F.col("role") == learned, F.lit(False)).alias("learned"), role.alias("role"), text.alias("text"))
    turn = F.concat(F.lit(TURN), F.col("role"), F.lit(TEXT), F.col("text"), F.lit(END))
    parts = parts.select(
        "conv_id", "message", "learned", turn.alias("turn"), (F.length("role") + len(TEXT)).cast("long").alias("start"), F.length("text").cast("long").alias("length")
    )
    # Messages of one number are ordered by what they say.
    order = Window.partitionBy("conv_id").orderBy("message", "turn")
    number = F.row_number().over(order) - 1
    offset = F.coalesce(F.sum(F.length("turn").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + len(TURN) + F.col("start")
    placed = parts.select("conv_id", number.cast("long").alias("number"), "turn", "learned", "start", "length", offset.alias("offset"))
    span = F.when(F.col("learned"), F.struct(F.col("number").alias("turn"), "start", "length", "offset"))
    grouped = placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("number", "turn"))).alias("turns"), F.sort_array(F.collect_list(span)).alias("loss_mask")
    )
    return grouped.select("conv_id", F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"), "loss_mask")


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, turns, loss_texts, formatted_chars`` from :func:`rendered`: roles and texts as they were, each text under the mask, the length."""
    marks = F.split("formatted", r"\Q" + TURN + r"\E")
    turns = F.slice(marks, F.lit(2), F.greatest(F.size(marks) - 1, F.lit(0)))
    opened = formatted.select("conv_id", turns.alias("raw"), "loss_mask", F.length("formatted").cast("long").alias("formatted_chars"))

    def turn(part: Column) -> Column:
        body = F.split(part, r"\Q" + TEXT + r"\E")
        return F.struct(unescaped(body[0]).alias("role"), unescaped(F.regexp_replace(body[1], r"\Q" + END + r"\E$", "")).alias("text"))

    def masked(span: Column) -> Column:
        raw = F.get(F.col("raw"), span["turn"].cast("int"))
        return unescaped(F.substring(raw, (span["start"] + 1).cast("int"), span["length"].cast("int")))

    return opened.select("conv_id", F.transform("raw", turn).alias("turns"), F.transform("loss_mask", masked).alias("loss_texts"), "formatted_chars")


def as_events(conversations: DataFrame) -> DataFrame:
    """An event log, numbered over each conversation, whose fold is the given conversations.

    Each row becomes a message, numbered by turn (ties by role and text). Its
    text is streamed in three deltas; every third message is first streamed
    wrongly and answered, and its regeneration takes the answer back; every fifth
    is first sent wrongly and edited.
    """
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    rows = conversations.select("conv_id", number.cast("long").alias("message"), "role", F.coalesce("text", F.lit("")).alias("text"))
    third = F.ceil(F.length("text") / 3).cast("int")
    cuts = [F.substring("text", F.lit(1), third), F.substring("text", third + 1, third), F.substring("text", third * 2 + 1, third + 1)]

    def event(step: int, kind: str, text: Column, ahead: int = 0) -> Column:
        seq = F.col("message") * 8 + step
        return F.struct(seq.alias("seq"), (F.col("message") + ahead).alias("message"), F.lit(kind).alias("kind"), text.alias("text"))

    deltas = [event(4 + i, "delta", cut) for i, cut in enumerate(cuts)]
    wrong, answer = event(1, "delta", F.reverse(F.col("text"))), event(2, "delta", F.lit("An answer to what is taken back."), 1)
    again = F.array(wrong, answer, event(3, "regenerate", F.lit(None).cast("string")), *deltas)
    edited = F.array(wrong, event(3, "edit", cuts[0]), *deltas[1:])
    log = F.when(F.col("message") % 3 == 0, again).when(F.col("message") % 5 == 0, edited).otherwise(F.array(*deltas))
    return rows.select("conv_id", "role", F.explode(log).alias("event")).select("conv_id", "event.seq", "event.message", "event.kind", "role", "event.text")
