"""Chat formatting with DataFrame expressions alone: one marked-up string and loss mask for each conversation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, PART, END = "<|turn|>", "<|text|>", "<|part|>", "<|end|>"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    """Text without a control string of this template or other common ones: a backslash stands within each.

    Backslashes are doubled first, so that ``unescape`` gives back the text.
    """
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), r"(<(?=\||/?s>|/?SYS>>)|\[(?=/?INST\]))", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, mask: rows in the order of turn, then role, then text.

    A run of turns of one role has one header, and its texts are parts; ``mask``
    is the formatted string in pieces, each with whether it is under the loss:
    every assistant's text is.  Null texts and roles are empty, a null turn comes
    first, a null conv_id is a conversation, repeated rows are turns each, an
    empty table gives no rows, and extra columns are not read.  A conversation is
    one value and has to fit into one row, as its output does.
    """
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = turns.select("conv_id", row.alias("row")).groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))

    def piece(x: Column, i: Column) -> Column:
        before = F.get("rows", i - 1)
        header = F.concat(F.lit(TURN), escape(x["role"]), F.lit(TEXT))
        lead = F.when(i == 0, header).when(before["role"].eqNullSafe(x["role"]), F.lit(PART)).otherwise(F.concat(F.lit(END), header))
        return F.array(F.struct(lead.alias("text"), F.lit(False).alias("loss")), F.struct(escape(x["text"]).alias("text"), (x["role"] == ASSISTANT).alias("loss")))

    closing = F.array(F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")))
    masked = grouped.select("conv_id", F.concat(F.flatten(F.transform("rows", piece)), closing).alias("mask"))
    return masked.select("conv_id", F.array_join(F.transform("mask", lambda x: x["text"]), "").alias("formatted"), "mask")


def read_back(formatted: DataFrame) -> DataFrame:
    """What the formatted strings and masks hold: turns, loss texts and their digests."""
    blocks = F.filter(F.split("formatted", r"<\|turn\|>"), lambda block: block != "")

    def turns(block: Column) -> Column:
        role = F.substring_index(block, TEXT, 1)
        body = F.split(F.regexp_replace(F.regexp_replace(block, r"(?s)^.*?<\|text\|>", ""), r"(?s)<\|end\|>\z", ""), r"<\|part\|>")
        return F.transform(body, lambda part: F.concat(unescape(role), F.lit("\n"), unescape(part), F.lit("\n")))

    parts = formatted.select("conv_id", "formatted", F.flatten(F.transform(blocks, turns)).alias("turns"), F.array_join(F.transform(F.filter("mask", lambda x: x["loss"]), lambda x: unescape(x["text"])), "").alias("loss"))
    return parts.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def with_probe(conversations: DataFrame) -> DataFrame:
    """The conversations and number -7, whose texts are another template's control strings."""
    probe = conversations.sparkSession.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return conversations.select("conv_id", "turn", "role", "text").union(probe)


ORACLE_SQL = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), escaped AS (
  SELECT *, lag(role) OVER w AS before, row_number() OVER w AS k,
    length(regexp_replace(regexp_replace(replace(text, '\', '\\'), '<(\||/?s>|/?SYS>>)', '<\\\1', 'g'), '\[(/?INST\])', '[\\\1', 'g')) AS text_chars,
    length(regexp_replace(regexp_replace(replace(role, '\', '\\'), '<(\||/?s>|/?SYS>>)', '<\\\1', 'g'), '\[(/?INST\])', '[\\\1', 'g')) AS role_chars
  FROM given WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(7 + sum(text_chars + CASE WHEN k = 1 THEN 16 + role_chars WHEN before = role THEN 8 ELSE 23 + role_chars END) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""
