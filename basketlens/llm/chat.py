"""Prefix-target expansion of conversations into training examples.

Every assistant turn becomes one example, written out whole: the turns before
it are its context, its text alone is trained on.  The loss mask is a pair of
offsets into the example's text: ``[target_start, target_end)`` is the trained
reply.  The examples of a conversation together are as long as the sum of its
prefixes, so a conversation of ``n`` turns gives rows whose lengths grow with
``n``; they are made one after another and never held together.  Turns after
the last reply are in no example; they are kept as rows that are not trained
on, so that the output holds every turn.

A segment reads ``### role: text</turn>`` and a line feed.  Inside roles and
texts a backslash precedes each backslash, each ``#`` and the slash of each
``</`` (in roles also each colon), so neither marker can occur there and
reading back takes the backslashes away again.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import column

OPEN, AFTER_ROLE, CLOSE = "### ", ": ", "</turn>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\#]|(?<=<)/)", r"\\$1")


def escape_role(role: Column) -> Column:
    return F.regexp_replace(role, r"([\\#:]|(?<=<)/)", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\#:/])", "$1")


def segments(df: DataFrame, assistant: str = "assistant") -> DataFrame:
    """One row per turn: conv_id, place, segment, begins, target_start, target_end, trained.

    ``place`` numbers the turns of a conversation from 1, by turn (nulls
    first), then role and text, so ties and repeated rows have a fixed order
    and all stay.  Null roles and texts are empty; rows with a null conv_id
    form one conversation.  Offsets count code points of the conversation's
    formatted string, which is its segments in order.
    """
    text, role = (F.coalesce(column(df, c, "string"), F.lit("")) for c in ("text", "role"))
    rows = df.select(column(df, "conv_id", "bigint").alias("conv_id"), column(df, "turn", "bigint").alias("turn"),
                     role.alias("role"), text.alias("text"))
    head = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit(AFTER_ROLE))
    rows = rows.withColumn("head", head).withColumn("body", escape(F.col("text")))
    rows = rows.withColumn("segment", F.concat("head", "body", F.lit(CLOSE)))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumn("place", F.row_number().over(order)).withColumn(
        "ends", F.sum(F.length("segment").cast("bigint")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    begins = F.col("ends") - F.length("segment")
    start = begins + F.length("head")
    return rows.select("conv_id", F.col("place").cast("bigint").alias("place"), "segment", begins.alias("begins"),
                       start.alias("target_start"), (start + F.length("body")).alias("target_end"),
                       F.coalesce(F.col("role") == F.lit(assistant), F.lit(False)).alias("trained"))


def training_rows(parts: DataFrame) -> DataFrame:
    """conv_id, place, trained, text, target_start, target_end: the examples, and the turns after the last as they stand.

    An example's text is all segments of its conversation up to and with its
    own, so its context is in it.
    """
    turns = Window.partitionBy("conv_id")
    before = turns.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    last = F.coalesce(F.max(F.when(F.col("trained"), F.col("place"))).over(turns), F.lit(0))
    text = (F.when(F.col("trained"), F.array_join(F.collect_list("segment").over(before), ""))
            .when(F.col("place") > last, F.col("segment")))
    return (parts.withColumn("text", text).where("text is not null")
            .select("conv_id", "place", "trained", "text", "target_start", "target_end"))


def examples(parts: DataFrame) -> DataFrame:
    """One row per assistant turn: conv_id, place, the text of its context and reply, and the loss mask as offsets."""
    return training_rows(parts).where("trained").drop("trained")


def example_texts(parts: DataFrame) -> DataFrame:
    """The same by the name it had while ``examples`` held offsets alone."""
    return examples(parts)


def read_turns(text: Column) -> Column:
    """Array of (role, text) of the turns in a formatted string."""
    pattern = rf"(?s)^{OPEN}((?:[^\\:]++|\\.)*+){AFTER_ROLE}(.*)$"
    bodies = F.split(text, CLOSE, -1)
    return F.transform(F.slice(bodies, F.lit(1), F.size(bodies) - 1), lambda x: F.struct(
        unescape(F.regexp_extract(x, pattern, 1)).alias("role"), unescape(F.regexp_extract(x, pattern, 2)).alias("text")))


def conversation_digests(df: DataFrame) -> DataFrame:
    """Per conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_examples.

    All is read back from the texts of the training rows: the turns from the
    last example, whose context and reply are all turns up to there, and the
    rows after it; the loss text from every example under its mask.
    ``formatted_chars`` is the length of all these texts, contexts counted in
    each example.  A conversation without assistant turn has no example: its
    loss text is empty.
    The two digests are of one conversation's whole text, which therefore
    meets in one row.
    """
    made = training_rows(segments(df))
    masked = F.substring("text", (F.col("target_start") + 1).cast("int"), (F.col("target_end") - F.col("target_start")).cast("int"))
    made = made.select("conv_id", "place", "trained", "text", F.length("text").cast("bigint").alias("chars"),
                       F.when(F.col("trained"), unescape(masked)).alias("loss"))
    in_order = lambda value, kept: F.array_join(F.sort_array(F.collect_list(
        F.when(kept, F.struct("place", F.col(value).alias("x"))))).getField("x"), "")
    whole = made.groupBy("conv_id").agg(
        F.max_by("text", F.when(F.col("trained"), F.col("place"))).alias("last"), in_order("text", ~F.col("trained")).alias("rest"),
        in_order("loss", F.col("trained")).alias("loss"), F.sum("chars").alias("formatted_chars"),
        F.count_if("trained").alias("n_examples"))
    whole = whole.withColumn("turns", read_turns(F.concat(F.coalesce("last", F.lit("")), "rest")))
    text = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return whole.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(text, 256).alias("turns_sha256"),
                        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                        "formatted_chars", "n_examples")
