"""Chat formatting by prefix-target expansion, in DataFrame functions only.

``prefix_targets`` explodes every assistant turn into an example of its own: the context is
all preceding turns, and only that reply is trainable.  ``format_conversations`` stores where a
context ends (``context_chars``), so its output stays proportional to the input; the
examples themselves are whole texts, cut out row by row, and those of a long conversation
add up to the square of its length.

Template, per turn: ``<|im_start|>`` role, newline, text, ``<|im_end|>``, newline.
Inside texts and roles ``&`` becomes ``&amp;`` and ``<|`` becomes ``&lt;|`` (in roles a newline
also becomes ``&#10;``), so a control string in a text cannot end a turn and ``unescape``
restores every text.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("&#10;"))


def unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("&#10;"), F.lit("\n")))


def format_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``examples``.

    ``examples`` is an array with one struct per turn whose role is ``assistant``:
    ``example_no`` (from 1), ``context_chars`` (code points of the prefix of ``formatted``
    that holds all preceding turns and the opening of this one) and ``target`` (the reply
    as rendered).

    Null role and null text are empty; a null turn sorts first; turns with equal numbers
    are ordered by role, then text, and repeated rows all stay; rows with a null
    ``conv_id`` form one conversation.  A conversation without an assistant turn has no
    examples.  Other columns are ignored.  One conversation is one value by definition, so
    its turns meet in one row; nothing is gathered across conversations.
    """
    empty = F.lit("")
    src = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
                       F.coalesce(F.col(role), empty).alias("role"), F.coalesce(F.col(text), empty).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    rows = (src.withColumn("head", head).withColumn("body", escape(F.col("text")))
            .withColumn("chars", (F.length("head") + F.length("body") + F.lit(len(END))).cast("long"))
            .withColumn("pos", F.row_number().over(order))
            .withColumn("context_chars", F.coalesce(F.sum("chars").over(before), F.lit(0).cast("long"))
                        + F.length("head"))
            .withColumn("is_reply", F.col("role") == F.lit("assistant")))
    turn_row = F.struct("pos", "head", "body", "is_reply", "context_chars")
    conv_rows = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn_row)).alias("ts"))
    replies = F.filter("ts", lambda t: t["is_reply"])
    return conv_rows.select(
        "conv_id",
        F.array_join(F.transform("ts", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("formatted"),
        F.transform(replies, lambda t, i: F.struct(
            (i + 1).alias("example_no"), t["context_chars"].alias("context_chars"),
            t["body"].alias("target"))).alias("examples"))


def prefix_targets(formatted: DataFrame) -> DataFrame:
    """Expand ``format_conversations`` output: a row per assistant turn with ``conv_id``, ``example_no``,
    ``example`` (all preceding turns and this one, as rendered), ``context_chars`` and ``target``.  The loss
    mask of an example covers exactly ``target``, which starts after ``context_chars`` code
    points of it.  Conversations without a reply give no row."""
    e = formatted.select("conv_id", "formatted", F.explode("examples").alias("e"))
    chars = F.col("e.context_chars") + F.length("e.target") + F.lit(len(END))
    return e.select("conv_id", "e.example_no", F.substring("formatted", F.lit(1), chars.cast("int")).alias("example"),
                    "e.context_chars", "e.target")


def under_mask(example: Column, context_chars: Column) -> Column:
    """What the loss mask of an example covers: what follows its context, without the closing mark."""
    return F.substring(example, (context_chars + 1).cast("int"), (F.length(example) - context_chars - F.lit(len(END))).cast("int"))


def with_context(formatted: DataFrame) -> DataFrame:
    """``prefix_targets`` with the text of each context (``context``): for consumers that
    want prompt and completion side by side, at quadratic size in a conversation's length."""
    return (formatted.select("conv_id", "formatted", F.explode("examples").alias("e"))
            .select("conv_id", "e.example_no",
                    F.substring("formatted", F.lit(1), F.col("e.context_chars").cast("int")).alias("context"),
                    "e.context_chars", "e.target"))


def read_turns(formatted: DataFrame) -> DataFrame:
    """Parse the rendered conversations back: ``conv_id``, ``formatted``, ``turns`` (array of role, text)."""
    segments = F.filter(F.split("formatted", r"<\|im_end\|>\n", -1), lambda s: s != "")
    parsed = F.transform(segments, lambda s: F.struct(
        unescape_role(F.substring_index(F.substr(s, F.lit(len(START) + 1)), "\n", 1)).alias("role"),
        unescape(F.substr(s, F.instr(s, F.lit("\n")) + 1)).alias("text")))
    return formatted.select("conv_id", "formatted", parsed.alias("turns"))
