"""Chat formatting in Spark expressions only.

Turns are collected as structs and sorted; adjacent turns of a role become one
block.  The template is

    <turn ROLE>TEXT<next/>TEXT</turn>NEWLINE

where <next/> parts the texts of one block.  Inside roles and texts a backslash
becomes \\s, < becomes \\l and > becomes \\g, so that no control string can occur
there and the conversation can be read back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_ESCAPES = (("\\", "\\s"), ("<", "\\l"), (">", "\\g"))


def escape(c: Column) -> Column:
    for plain, coded in _ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(coded))
    return c


def unescape(c: Column) -> Column:
    for plain, coded in reversed(_ESCAPES):
        c = F.replace(c, F.lit(coded), F.lit(plain))
    return c


def format_chats(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """(conv_id, segments, formatted) of turns (conv_id, turn, role, text), one row a conversation.

    segments: the pieces of `formatted` in order, each with `loss`, true for the
    texts of loss_role.  Turns are ordered by turn, role and text (null first),
    so ties and repeated rows come out in a fixed order, each once for each row;
    a null role or text counts as empty; a null conv_id is a conversation.
    Other columns are ignored; an empty table gives an empty result.
    """
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("_t"))

    def pieces(t: Column, i: Column) -> Column:
        earlier, later = F.get(F.col("_t"), i - 1)["role"], F.get(F.col("_t"), i + 1)["role"]
        opened = F.when(t["role"].eqNullSafe(earlier), F.lit("<next/>")).otherwise(F.concat(F.lit("<turn "), escape(t["role"]), F.lit(">")))
        closed = F.when(t["role"].eqNullSafe(later), F.lit("")).otherwise(F.lit("</turn>\n"))
        segment = lambda piece, loss: F.struct(piece.alias("piece"), loss.alias("loss"))
        return F.array(segment(opened, F.lit(False)), segment(escape(t["text"]), t["role"] == loss_role), segment(closed, F.lit(False)))

    chats = chats.withColumn("segments", F.flatten(F.transform("_t", pieces)))
    return chats.select("conv_id", "segments", F.array_join(F.transform("segments", lambda s: s["piece"]), "").alias("formatted"))


def read_back(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation."""
    blocks = F.filter(F.split(formatted, r"</turn>\n"), lambda b: b != "")

    def texts(block: Column) -> Column:
        role = unescape(F.regexp_extract(block, r"(?s)\A<turn ([^>]*)>", 1))
        body = F.regexp_replace(block, r"(?s)\A<turn [^>]*>", "")
        return F.transform(F.split(body, "<next/>"), lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))

    return F.flatten(F.transform(blocks, texts))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    chats = format_chats(turns.unionByName(extra)).withColumn("_turns", read_back(F.col("formatted")))
    learnt = unescape(F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: s["piece"]), ""))
    return chats.withColumn("_loss", learnt).select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").cast("binary"), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), o AS (
  SELECT *, row_number() OVER w AS i, lag(role) OVER w AS earlier, lead(role) OVER w AS later FROM t
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), p AS (
  SELECT *, len(text) + len(regexp_replace(text, '[^\\<>]', '', 'g')) AS chars,
    len(role) + len(regexp_replace(role, '[^\\<>]', '', 'g')) AS role_chars
  FROM o
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars + CASE WHEN earlier IS NOT DISTINCT FROM role THEN 7 ELSE 7 + role_chars END
    + CASE WHEN later IS NOT DISTINCT FROM role THEN 0 ELSE 8 END)::BIGINT AS formatted_chars
FROM p GROUP BY conv_id
"""
