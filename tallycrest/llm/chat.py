"""Chat template that a deterministic grammar reads back to exactly the source turns.

    conversation := turn*
    turn         := "### " role ": " body "\\n</turn>\\n"

In a body, a control string (``</turn>`` or ``### ``) with backslashes before it loses one of
them when read. In a role, a backslash takes the next character as it is. A turn is first
rendered as it stands and read again; if other turns come back, its control strings get one
more backslash, and it is read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, AFTER_ROLE, END = "### ", ": ", "\n</turn>\n"
CONTROL = "(</turn>|### )"
LOSS_ROLE = "assistant"


def _role(role: Column) -> Column:
    return F.regexp_replace(role, r"([\\:<])", r"\\$1")


def _escaped(body: Column) -> Column:
    return F.regexp_replace(body, r"(\\*)" + CONTROL, r"\\$1$2")


def render(role: Column, body: Column) -> Column:
    return F.concat(F.lit(HEAD), _role(role), F.lit(AFTER_ROLE), body, F.lit(END))


def read(formatted: Column) -> Column:
    """Turns (role, text) of a rendered conversation."""
    pieces = F.split(formatted, END, -1)  # what follows the last end is no turn

    def turn(piece: Column) -> Column:
        head = F.regexp_extract(piece, r"(?s)^### (?:[^\\:]|\\.)*+: ", 0)
        role = F.substr(head, F.lit(len(HEAD) + 1), F.length(head) - len(HEAD) - len(AFTER_ROLE))
        body = F.substr(piece, F.length(head) + 1)
        return F.struct(
            F.regexp_replace(role, r"(?s)\\(.)", "$1").alias("role"),
            F.regexp_replace(body, r"\\(\\*)" + CONTROL, "$1$2").alias("text"),
        )

    return F.transform(F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0))), turn)


def format_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and ``rendered``, row by row without a shuffle.

    Null text and null role count as empty. A turn that does not come back as it went in is
    escaped; if even that does not come back, the job fails rather than alter a text.
    """
    source = F.array(F.struct(F.col("role").alias("role"), F.col("text").alias("text")))
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    plain, safe = render(F.col("role"), F.col("text")), render(F.col("role"), _escaped(F.col("text")))
    return rows.withColumn(
        "rendered",
        F.when(read(plain) == source, plain)
        .when(read(safe) == source, safe)
        .otherwise(F.raise_error(F.lit("a turn does not survive the template")).cast("string")),
    )


def format_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted and ``turns`` read back from it, one row per conversation.

    Turns are in order of ``turn`` (null first), then role and text, so ties and repeated rows
    have a fixed place; rows without conv_id are one conversation of null id. Other columns are
    not read; an empty table gives no rows. A conversation is one value of its row, as its
    format demands; turns are rendered before they meet.
    """
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text", "rendered")))
    return (
        format_turns(conversations)
        .groupBy("conv_id")
        .agg(turns.alias("rows"))
        .select(
            "conv_id",
            F.array_join(F.col("rows.rendered"), "").alias("formatted"),
            F.arrays_zip(F.col("rows.role").alias("role"), F.col("rows.text").alias("text")).alias("source"),
        )
        .withColumn("turns", read(F.col("formatted")))
        .withColumn(
            "turns",
            F.when(F.to_json("turns") == F.to_json("source"), F.col("turns")).otherwise(
                F.raise_error(F.lit("a conversation does not survive the template")).cast(
                    "array<struct<role:string,text:string>>"
                )
            ),
        )
        .select("conv_id", "formatted", "turns")
    )


def loss_text(turns: Column) -> Column:
    """All text under the loss mask: the assistant's, nothing between."""
    kept = F.filter(turns, lambda t: t["role"] == LOSS_ROLE)
    return F.array_join(F.transform(kept, lambda t: t["text"]), "")


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and checksums, all taken from what was read back."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return formatted.withColumn("loss", loss_text(F.col("turns"))).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
