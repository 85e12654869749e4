"""Chat formatting from an event log. Only DataFrame functions.

A log row is (conversation, sequence, kind, target, role, text). The kinds: ``message``
opens a message, which is named by its own sequence number; ``delta`` adds text to the
message ``target``; ``edit`` replaces its text; ``regenerate`` starts it again from what
the row says. Conversations are folded to final messages and rendered with a template

    <|im_start|>role, new line, text, <|im_end|>, new line

Inside roles and texts a backslash is doubled and ``<|`` becomes ``<\\|`` (a new line in
a role ``<\\!>``), so a control string can only be the template's, and ``parse`` gives
back exactly what went in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START = "<|im_start|>"
END = "<|im_end|>"
LEARNED_ROLE = "assistant"

_OPENS = ("message", "edit", "regenerate")


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    opened = F.replace(text, F.lit("<\\|"), F.lit("<|"))
    return F.replace(opened, F.lit("\\\\"), F.lit("\\"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\!>"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\!>"), F.lit("\n")))


def fold(events: DataFrame) -> DataFrame:
    """Final messages of each conversation: ``conv_id``, ``messages`` (role, text).

    ``events`` has conv_id, seq, kind, target, role, text; further columns are ignored.
    Events are taken in the order of seq, ties in the order opens before deltas, then
    role and text, so repeated rows fold the same way every time. A message's text is
    what its last opening event said and every later delta. Two ``message`` events with
    one number are two messages. Its role is the last one named, a null role or text is
    empty, a null target is the event's own seq, and an unknown kind counts as a delta.
    A null conv_id is a conversation like any other; no events, no rows.

    First messages, then conversations are gathered, so the events of a long
    conversation meet as messages only.
    """
    each = events.select(
        "conv_id",
        F.coalesce("target", "seq").alias("target"),
        F.struct(
            F.col("seq"),
            (~F.coalesce(F.col("kind"), F.lit("")).isin(*_OPENS)).alias("delta"),
            (F.coalesce(F.col("kind"), F.lit("")) == "message").alias("message"),
            F.col("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("event"),
    )
    by_message = each.groupBy("conv_id", "target").agg(
        F.sort_array(F.collect_list("event")).alias("events")
    )
    opened = F.filter("events", lambda e: e["message"])
    earlier = F.slice(opened, F.lit(1), F.greatest(F.size(opened) - 1, F.lit(0)))
    resets = F.transform("events", lambda e, i: F.when(~e["delta"], i))
    roles = F.filter("events", lambda e: e["role"].isNotNull())
    folded = by_message.withColumn("_from", F.coalesce(F.array_max(resets), F.lit(0))).select(
        "conv_id",
        F.struct(
            F.col("target"),
            F.transform(
                earlier, lambda e: F.struct(F.coalesce(e["role"], F.lit("")).alias("role"), e["text"].alias("text"))
            ).alias("earlier"),
            F.coalesce(F.get(roles, F.size(roles) - 1)["role"], F.lit("")).alias("role"),
            F.array_join(
                F.transform(
                    F.filter("events", lambda e, i: i >= F.col("_from")), lambda e: e["text"]
                ),
                "",
            ).alias("text"),
        ).alias("message"),
    )
    gathered = folded.groupBy("conv_id").agg(F.sort_array(F.collect_list("message")).alias("all"))
    return gathered.select(
        "conv_id",
        F.flatten(
            F.transform(
                "all",
                lambda m: F.concat(
                    m["earlier"], F.array(F.struct(m["role"].alias("role"), m["text"].alias("text")))
                ),
            )
        ).alias("messages"),
    )


def render(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``segments`` and ``formatted`` for messages as ``fold`` gives them.

    The segments (text, loss) in order make up the formatted text; those with ``loss``
    are the escaped texts of the assistant, the part to learn from.
    """

    def parts(m):
        head = F.concat(F.lit(START), _escape_role(m["role"]), F.lit("\n"))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(m["text"]).alias("text"), (m["role"] == LEARNED_ROLE).alias("loss")),
            F.struct(F.lit(END + "\n").alias("text"), F.lit(False).alias("loss")),
        )

    return conversations.select(
        "conv_id", F.flatten(F.transform("messages", parts)).alias("segments")
    ).withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def parse(formatted: Column) -> Column:
    """The messages (role, text) of a formatted text."""
    pieces = F.split(formatted, "<\\|im_start\\|>")
    turns = F.slice(pieces, F.lit(2), F.size(pieces))

    def message(piece):
        head = F.substring_index(piece, "\n", 1)
        start = F.length(head) + 2
        body = F.substr(piece, start, F.length(piece) - start - len(END))
        return F.struct(_unescape_role(head).alias("role"), unescape(body).alias("text"))

    return F.transform(turns, message)


def learned_text(segments: Column) -> Column:
    """All text under the loss mask, as it was before escaping."""
    under = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(under, lambda s: unescape(s["text"])), "")
