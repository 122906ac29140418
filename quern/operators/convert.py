"""Record conversions: instruction, question/answer, chain-of-thought and web text to chat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import find, is_blank, left, strip
from quern.operators.filters import has_math, length_between, non_empty
from quern.operators.ordering import dense_index

# The wording and formats the converted records must carry.
COT_INSTRUCTION = "Let's think step by step and output the final answer within \\boxed{}."
NO_SOLUTION = "No solution available."
WEB_ID_PREFIX = "openwebmath-"
WEB_TEMPLATES = [
    "Please explain the following mathematical content step by step:\n\n{context}",
    "Read the following math text and provide a detailed explanation:\n\n{context}",
    "Explain and elaborate on the following mathematical concepts:\n\n{context}",
    "Continue the following mathematical discussion with detailed reasoning:\n\n{context}",
    "Provide a thorough explanation of the math described below:\n\n{context}",
]


def chat_turn(role: str, value: Column) -> Column:
    return F.struct(F.lit(role).alias("from"), value.alias("value"))


def chat_pair(human: Column, gpt: Column) -> Column:
    """A two-turn conversation."""
    return F.array(chat_turn("human", human), chat_turn("gpt", gpt))


def alpaca_to_chat(df: DataFrame) -> DataFrame:
    """``instruction, input, output`` to a chat column; a blank or null input is left out."""
    has_input = F.col("input").isNotNull() & ~is_blank(F.col("input"))
    asked = F.when(has_input, F.concat("instruction", F.lit("\n\n"), "input")).otherwise(F.col("instruction"))
    keep = [c for c in df.columns if c not in ("instruction", "input", "output")]
    return df.select(*keep, chat_pair(asked, F.col("output")).alias("conversations"))


def qa_to_chat(df: DataFrame) -> DataFrame:
    """``input, output`` to a chat column."""
    keep = [c for c in df.columns if c not in ("input", "output")]
    return df.select(*keep, chat_pair(F.col("input"), F.col("output")).alias("conversations"))


def chat_project(df: DataFrame) -> DataFrame:
    """Keep only the conversation column, whichever of its two names it has."""
    if "items" in df.columns:
        df = df.withColumnRenamed("items", "conversations")
    return df.select("conversations")


def cot_to_chat(df: DataFrame, key: str, source: str, start: int = 0, end: int = -1) -> DataFrame:
    """``problem, solution`` to chat rows with ids ``source-0, source-1, …`` counted inside the chosen range."""
    rows = dense_index(df, key, name="_pos")
    if start > 0:
        rows = rows.where(F.col("_pos") >= start)
    if end > 0:
        rows = rows.where(F.col("_pos") < end)
    asked = F.concat(F.col("problem"), F.lit(" " + COT_INSTRUCTION))
    solved = F.coalesce(F.nullif(F.col("solution"), F.lit("")), F.lit(NO_SOLUTION))
    ident = F.concat(F.lit(source + "-"), (F.col("_pos") - F.lit(start)).cast("string"))
    return rows.select(ident.alias("id"), chat_pair(asked, solved).alias("conversations"))


def natural_split_point(text: Column, low: float = 0.1, high: float = 0.4) -> Column:
    """First paragraph break, sentence end or line break between the two length ratios; null if none."""
    n = F.length(text)
    first = (n * F.lit(low)).cast("int")
    limit = (n * F.lit(high)).cast("int")

    def hit(needle: str, shift: int) -> Column:
        at = find(text, needle, first)
        return F.when((at >= 0) & (at < limit), at + shift)

    sentence = F.least(hit(". ", 1), hit(".\n", 1))
    return F.coalesce(hit("\n\n", 0), sentence, hit("\n", 0))


def context_cut(text: Column) -> Column:
    """Where the prompt context ends, with the fixed-share fallback."""
    fallback = F.greatest(F.lit(100), (F.length(text) * F.lit(0.2)).cast("int"))
    return F.coalesce(natural_split_point(text), fallback)


def rotated_prompt(idx: Column, context: Column) -> Column:
    """Prompt wording number ``idx`` (cyclic) around the context."""
    wording = F.get(F.array(*[F.lit(t) for t in WEB_TEMPLATES]), F.pmod(idx, F.lit(len(WEB_TEMPLATES))).cast("int"))
    return F.replace(wording, F.lit("{context}"), context)


def select_web_math(df: DataFrame, text: str = "text") -> DataFrame:
    """Non-empty texts of acceptable length holding mathematics, cheapest test first."""
    t = F.col(text)
    return df.where(non_empty(t) & length_between(t, 500, 8000) & has_math(t))


def web_math_row(text: Column, idx: Column, ident: Column) -> list[Column]:
    """The stateless part of the web conversion, shared by batch and stream."""
    context = strip(left(text, context_cut(text)))
    return [ident.alias("id"), rotated_prompt(idx, context).alias("human"), strip(text).alias("gpt")]


def web_math_to_chat(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Web corpus to prompt/response rows, ids counted over the kept rows in ``key`` order."""
    kept = dense_index(select_web_math(df.select(key, text), text), key, bounds_from=df)
    ident = F.concat(F.lit(WEB_ID_PREFIX), F.col("idx").cast("string"))
    return kept.select(*web_math_row(F.col(text), F.col("idx"), ident))


def as_chat(df: DataFrame, human: str = "human", gpt: str = "gpt") -> DataFrame:
    """Pair columns to the nested chat record written to disk."""
    keep = [c for c in df.columns if c not in (human, gpt)]
    return df.select(*keep, chat_pair(F.col(human), F.col(gpt)).alias("conversations"))


