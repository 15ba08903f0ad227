"""Chat formatting with prefix-target expansion.

Every assistant turn becomes a training example of its own: all turns before it
as context, and only its reply trainable. A conversation that does not end with
a reply also gets one record of all its turns without a target, so no turn is
lost. Control strings inside texts are broken by a backslash in their midst and
restored on reading, so a record can be split at the literal strings alone.

Conversations are rows by ``turn``; equal turns are ordered by role and text,
null turns come first, and null roles and texts are empty. A row without a
conversation id is a conversation of its own, told apart by ``alone``. An empty
table gives no record, and other columns are left out. A single conversation
must fit in a task's memory, as the last of its examples has to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, AFTER_ROLE, CLOSE = "### ", ": ", " </turn>\n"
REPLIES = "assistant"


def escaped(text: Column) -> Column:
    """Text without OPEN or the tag of CLOSE in it; each backslash starts a pair."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit("</turn>"), F.lit("<\\/turn>")), F.lit("### "), F.lit("#\\## "))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit(AFTER_ROLE), F.lit(":\\ "))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def examples(turns: DataFrame, replies: str = REPLIES) -> DataFrame:
    """Records: conv_id, alone, target (place of the reply, null without one), formatted, loss_start, loss_length.

    The loss mask is a span of code points in ``formatted``.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    head = F.concat(F.lit(OPEN), escaped_role(role), F.lit(AFTER_ROLE))
    alone = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id())
    rendered = turns.select(
        "conv_id", alone.alias("alone"),
        F.struct(
            F.col("turn").alias("turn"), role.alias("role"), text.alias("text"),
            F.concat(head, escaped(text), F.lit(CLOSE)).alias("line"),
            F.length(head).alias("head"), F.length(escaped(text)).alias("body"),
        ).alias("one"),
    )
    whole = rendered.groupBy("conv_id", "alone").agg(F.array_sort(F.collect_list("one")).alias("turns"))
    places = F.filter(
        F.sequence(F.lit(1), F.size("turns")),
        lambda i: (F.element_at("turns", i)["role"] == replies) | (i == F.size("turns")),
    )
    target = F.element_at("turns", F.col("upto"))
    formatted = F.array_join(F.transform(F.slice("turns", 1, F.col("upto")), lambda t: t["line"]), "")
    trained = target["role"] == replies
    return (
        whole.withColumn("upto", F.explode(places))
        .select(
            "conv_id", "alone", "upto", trained.alias("trained"), formatted.alias("formatted"),
            target["body"].alias("body"),
        )
        .select(
            "conv_id", "alone",
            F.when(F.col("trained"), F.col("upto") - 1).alias("target"),
            "formatted",
            F.when(F.col("trained"), F.length("formatted") - len(CLOSE) - F.col("body")).alias("loss_start"),
            F.when(F.col("trained"), F.col("body")).alias("loss_length"),
        )
    )


def parsed(formatted: Column) -> Column:
    """The turns of a record, as an array of role and text."""
    def one(line: Column) -> Column:
        parts = F.split(F.substring(line, len(OPEN) + 1, F.length(line)), AFTER_ROLE, 2)
        return F.struct(unescaped(parts[0]).alias("role"), unescaped(parts[1]).alias("text"))

    lines = F.split(formatted, CLOSE, -1)
    return F.transform(F.slice(lines, 1, F.size(lines) - 1), one)


def read_back(records: DataFrame) -> DataFrame:
    """Per conversation what its records say: turns, trained text and sizes."""
    loss = F.when(
        F.col("target").isNotNull(), unescaped(F.substring("formatted", F.col("loss_start") + 1, F.col("loss_length")))
    )
    size = F.length("formatted")
    per_conv = records.select(
        "conv_id", "alone", "formatted", size.alias("size"), F.struct(size.alias("size"), "target", loss.alias("loss")).alias("trained"),
    ).groupBy("conv_id", "alone").agg(
        F.max_by("formatted", "size").alias("longest"),
        F.sort_array(F.collect_list(F.when(F.col("trained.target").isNotNull(), F.col("trained")))).alias("trained"),
        F.sum("size").alias("formatted_chars"),
    )
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    trained = F.array_join(F.transform("trained", lambda t: t["loss"]), "")
    return per_conv.select("conv_id", parsed(F.col("longest")).alias("turns"), trained.alias("trained"), "formatted_chars").select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"),
        F.sha2("trained", 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long"),
    )
