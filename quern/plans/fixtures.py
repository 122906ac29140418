"""Inputs the operators need that the given tables do not hold directly, derived from whole tables.

Every derivation exists twice, as a DataFrame and as SQL text for the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.text import WHITESPACE
from quern.plans.registry import sql_text, table

WS_SQL = sql_text(WHITESPACE)
TOKENS_SQL = r"[\p{L}]+|[0-9]|[^ \t\n\f\r\p{L}0-9]"


def sql_strip(e: str) -> str:
    return f"trim({e}, {WS_SQL})"


def sql_tokens(e: str) -> str:
    return f"regexp_extract_all(lower({e}), '{TOKENS_SQL}')"


def sql_hash(seed, *cols: str) -> str:
    return "md5(concat_ws(':', '" + str(seed) + "', " + ", ".join(f"{c}::VARCHAR" for c in cols) + "))"


def qa_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """A user turn, the assistant turn after it and the assistant turn before it (joined on unique keys)."""
    conv = table(spark, sf, "conversations")
    said = conv.where(F.col("role") == "assistant")
    asked = conv.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("input"))
    after = said.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output"))
    before = said.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("prev"))
    on = ["conv_id", "turn"]
    return asked.join(after, on).join(before, on, "left")


QA_SQL = """qa AS (
  SELECT u.conv_id, u.turn, u.text AS input, a.text AS output, p.text AS prev
  FROM conversations u
  JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  LEFT JOIN conversations p ON p.conv_id = u.conv_id AND p.turn = u.turn - 1 AND p.role = 'assistant'
  WHERE u.role = 'user')"""


def chat_turns(spark: SparkSession, sf: str) -> DataFrame:
    """The conversations with chat-record role names."""
    role = F.when(F.col("role") == "user", "human").when(F.col("role") == "assistant", "gpt").otherwise(F.col("role"))
    return table(spark, sf, "conversations").select("conv_id", "turn", role.alias("role"), "text")


TURNS_SQL = """turns AS (
  SELECT conv_id, turn, text,
         CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt' ELSE role END AS role
  FROM conversations)"""


def flat_chat(df: DataFrame) -> DataFrame:
    """Chat arrays as one row per turn."""
    keep = [c for c in df.columns if c != "conversations"]
    out = df.select(*keep, F.posexplode("conversations").alias("pos", "_t"))
    return out.select(
        *keep,
        F.col("pos").cast("bigint").alias("pos"),
        F.col("_t.from").alias("from_role"),
        F.col("_t.value").alias("value"),
    )


def json_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Two-turn chat records as JSON text, damaged in one of nine ways by key."""
    qa = qa_pairs(spark, sf)
    human = F.concat(F.lit('{"from":"human","value":'), F.to_json(F.col("input").cast("variant")), F.lit("}"))
    gpt = F.concat(F.lit('{"from":"gpt","value":'), F.to_json(F.col("output").cast("variant")), F.lit("}"))
    good = F.concat(F.lit('{"id":"x","conversations":['), human, F.lit(","), gpt, F.lit("]}"))
    kind = F.pmod(F.col("conv_id") + F.col("turn"), F.lit(9))
    line = (
        F.when(kind == 1, F.substr(good, F.lit(1), (F.length(good) - 3).cast("int")))
        .when(kind == 2, F.replace(good, F.lit('"conversations"'), F.lit('"messages"')))
        .when(kind == 3, F.concat(F.lit('{"conversations":'), F.to_json(F.col("input").cast("variant")), F.lit("}")))
        .when(kind == 4, F.concat(F.lit('{"conversations":['), human, F.lit(',{"from":"gpt"}]}')))
        .when(kind == 5, F.concat(F.lit('{"conversations":['), human, F.lit(',{"from":"robot","value":"x"}]}')))
        .when(kind == 6, F.lit('{"conversations":[]}'))
        .when(kind == 7, F.concat(F.lit("["), human, F.lit("]")))
        .when(kind == 8, F.lit(" "))
        .otherwise(good)
    )
    return qa.select("conv_id", "turn", line.alias("line"))


JSON_SQL = (
    QA_SQL
    + """, parts AS (
  SELECT conv_id, turn, (conv_id + turn) % 9 AS kind, to_json(input)::VARCHAR AS i,
         '{"from":"human","value":' || to_json(input)::VARCHAR || '}' AS h,
         '{"from":"gpt","value":' || to_json(output)::VARCHAR || '}' AS g FROM qa),
good AS (SELECT *, '{"id":"x","conversations":[' || h || ',' || g || ']}' AS good FROM parts),
lines AS (SELECT conv_id, turn, CASE kind
  WHEN 1 THEN left(good, length(good) - 3)
  WHEN 2 THEN replace(good, '"conversations"', '"messages"')
  WHEN 3 THEN '{"conversations":' || i || '}'
  WHEN 4 THEN '{"conversations":[' || h || ',{"from":"gpt"}]}'
  WHEN 5 THEN '{"conversations":[' || h || ',{"from":"robot","value":"x"}]}'
  WHEN 6 THEN '{"conversations":[]}'
  WHEN 7 THEN '[' || h || ']'
  WHEN 8 THEN ' ' ELSE good END AS line FROM good),
checked AS (SELECT conv_id, turn, CASE
  WHEN NOT json_valid(line) THEN ['bad_json']
  WHEN json_type(line) <> 'OBJECT' THEN ['not_object']
  WHEN json_extract(line, '$.conversations') IS NULL THEN ['missing_conversations']
  WHEN json_type(line, '$.conversations') <> 'ARRAY' THEN ['not_a_list']
  ELSE list_filter([
    CASE WHEN len(list_filter(json_extract(line, '$.conversations[*]'), lambda t:
      json_extract(t, '$.from') IS NULL OR json_extract(t, '$.value') IS NULL)) > 0 THEN 'missing_turn_key' END,
    CASE WHEN len(list_filter(json_extract(line, '$.conversations[*]'), lambda t:
      json_extract(t, '$.from') IS NOT NULL AND json_extract(t, '$.value') IS NOT NULL
      AND coalesce(json_extract_string(t, '$.from') NOT IN ('system', 'human', 'gpt'), true))) > 0 THEN 'bad_role' END
  ], lambda r: r IS NOT NULL) END AS reasons FROM lines)"""
)
