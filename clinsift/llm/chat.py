"""Chat formatting from event logs: fold events into final messages, then render.

A log holds, per conversation and sequence number, events of four kinds:

* ``message``    opens a message with a role and a first piece of text,
* ``delta``      appends a streamed piece to its message,
* ``edit``       replaces its message's text,
* ``regenerate`` empties its message, to be filled by the deltas that follow.

An edit or a regeneration rewinds the conversation: messages opened after the one it changes
and before it happened are withdrawn.  What is left, in the order the messages were opened, is
rendered into segments with a loss mask: assistant texts are under the mask, markers and
other texts are not.  Control strings inside texts and roles are broken up by a backslash
(and backslashes doubled), so no text can forge a marker and every text can be read back.

Everything is built-in DataFrame functions.  Messages fold on (conversation, message); a long
conversation is put together in blocks of ``BLOCK`` sequence numbers first and the blocks
are joined last, so that no task sorts a whole long log.

Defined cases: null texts and roles are empty; a null sequence number comes first; events
with equal numbers are ordered by kind, role and text; a null conversation id is a
conversation of its own; an event without an opening ``message`` opens its message itself
with its own role.  Repeated ``message`` rows with different message ids are separate
messages.  An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEAD, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
BLOCK = 256
_FIRST = -(1 << 62)
_CONTROL = r"(<)(?=\|[A-Za-z0-9_]+\|>|/?s>|</?SYS>>)|(\[)(?=/?INST\])"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, _CONTROL, r"$1$2\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def fold(events: DataFrame) -> DataFrame:
    """``conv_id, at, role, text`` of the messages that remain.

    ``events``: conv_id, seq, kind, msg, role, text.
    """
    clean = events.select(
        "conv_id",
        "msg",
        F.coalesce("seq", F.lit(_FIRST)).alias("seq"),
        F.coalesce("kind", F.lit("message")).alias("kind"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    place = F.struct(
        "seq",
        F.when(F.col("kind") == "message", 0).when(F.col("kind") == "delta", 2).otherwise(1).alias("k"),
        "role",
        "text",
    )
    resets = F.col("kind").isin("message", "edit", "regenerate")
    rewinds = F.col("kind").isin("edit", "regenerate")
    messages = clean.groupBy("conv_id", "msg").agg(
        F.min(place).alias("opened"),
        F.max(F.when(resets, place)).alias("reset"),
        F.max(F.when(rewinds, F.col("seq"))).alias("rewound"),
        F.sort_array(F.collect_list(place)).alias("pieces"),
    )
    valid = F.when(
        F.col("reset").isNotNull(), F.filter("pieces", lambda p: p >= F.col("reset"))
    ).otherwise(F.col("pieces"))
    messages = messages.select(
        "conv_id",
        F.col("opened.seq").alias("at"),
        F.col("opened.role").alias("role"),
        F.array_join(F.transform(valid, lambda p: p["text"]), "").alias("text"),
        "rewound",
        F.floor(F.col("opened.seq") / BLOCK).alias("block"),
    )
    return _without_withdrawn(messages)


def _without_withdrawn(messages: DataFrame) -> DataFrame:
    """Drop messages opened after an earlier message and before that one's last rewind."""
    by_block = messages.where("rewound is not null").groupBy("conv_id", "block").agg(
        F.max("rewound").alias("far")
    )
    # blocks with a rewind only; the running maximum over them, one row per block
    earlier = Window.partitionBy("conv_id").orderBy("block")
    spans = by_block.select(
        F.col("conv_id").alias("c"),
        (F.col("block") + 1).alias("from_block"),
        F.max("far").over(earlier).alias("far"),
        F.lead("block").over(earlier).alias("to_block"),
    )
    here = Window.partitionBy("conv_id", "block").orderBy("at").rangeBetween(
        Window.unboundedPreceding, -1
    )
    ahead = messages.withColumn("near", F.max("rewound").over(here))
    joined = ahead.join(
        spans,
        F.col("conv_id").eqNullSafe(F.col("c"))
        & (F.col("block") >= F.col("from_block"))
        & (F.col("to_block").isNull() | (F.col("block") <= F.col("to_block"))),
        "left",
    )
    gone = F.coalesce(F.greatest("near", "far") > F.col("at"), F.lit(False))
    return joined.where(~gone).select("conv_id", "at", "role", "text")


def render(messages: DataFrame, masked_role: str = "assistant") -> DataFrame:
    """``conv_id, segments``: the conversation's text in pieces, each under the mask or not."""
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    never = F.lit(False)
    segments = F.array(
        piece(F.concat(F.lit(HEAD), escape(F.col("role")), F.lit(SEP)), never),
        piece(escape(F.col("text")), F.col("role") == masked_role),
        piece(F.lit(END), never),
    )
    blocks = messages.groupBy("conv_id", F.floor(F.col("at") / BLOCK).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("at", "role", "text", segments.alias("s")))).alias("m")
    )
    blocks = blocks.select("conv_id", "block", F.flatten(F.col("m.s")).alias("s"))
    whole = blocks.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("block", "s"))).alias("b")
    )
    return whole.select("conv_id", F.flatten(F.col("b.s")).alias("segments"))


def formatted(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def turns(text: Column) -> Column:
    """Role and text of every turn, read back from a rendered conversation."""
    pieces = F.filter(F.split(text, r"<\|im_end\|>"), lambda p: p != "")
    halves = F.transform(pieces, lambda p: F.split(p, r"<\|im_sep\|>"))
    return F.transform(
        halves,
        lambda h: F.struct(
            unescape(F.substring(h[0], len(HEAD) + 1, 1 << 30)).alias("role"),
            unescape(h[1]).alias("text"),
        ),
    )


def masked_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    parts = F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"]))
    return F.array_join(parts, "")
