"""Row predicates and the chat-record validator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import strip

IGNORE = -100

# What counts as mathematics, as one alternation. (?d): only \n ends a line.
MATH_PATTERNS = [
    r"\$.*?\$",
    r"\\\[.*?\\\]",
    r"\\frac\{",
    r"\\sqrt",
    r"\\sum",
    r"\\int",
    r"\\begin\{",
    r"[=<>]\s*\d",
    r"\d+\s*[+\-*/^]\s*\d+",
]
# Speakers a chat record may name.
CHAT_ROLES = ["system", "human", "gpt"]


def non_empty(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def length_between(c: Column, low: int, high: int) -> Column:
    return F.length(c).between(low, high)


def has_math(c: Column) -> Column:
    """Any of the patterns. Each needs a dollar sign, a backslash or a digit, which is cheaper to look for first."""
    return c.rlike(r"[$\\0-9]") & c.rlike("(?d)" + "|".join(MATH_PATTERNS))


def pair_chars_ok(prompt: Column, chosen: Column, rejected: Column, max_source: int, max_target: int) -> Column:
    """Both full texts are non-empty and at most ``max_source + max_target`` characters long."""
    limit = max_source + max_target
    return (F.length(prompt) + F.length(chosen)).between(1, limit) & (
        F.length(prompt) + F.length(rejected)
    ).between(1, limit)


def pair_tokens_ok(chosen_ids: Column, rejected_ids: Column, limit: int) -> Column:
    return F.size(chosen_ids).between(1, limit) & F.size(rejected_ids).between(1, limit)


def has_label(labels: Column) -> Column:
    """Some label is not the ignore mark (false for an empty array)."""
    return F.exists(labels, lambda x: x != IGNORE)


def select_range(df: DataFrame, idx: str, start: int, end: int) -> DataFrame:
    """Rows ``start <= idx < end``; ``end <= 0`` keeps everything from the first row on."""
    if end <= 0:
        return df
    return df.where((F.col(idx) >= start) & (F.col(idx) < end))


def validate_chat_lines(df: DataFrame, line: str) -> DataFrame:
    """Add ``reasons`` (sorted array, empty when valid) and ``valid``; every row is kept."""
    v = F.try_parse_json(F.col(line))
    conv = F.try_variant_get(v, "$.conversations", "variant")
    turns = F.try_variant_get(v, "$.conversations", "array<variant>")
    is_object = strip(F.col(line)).startswith("{")

    def lacks(key: str):
        return lambda t: F.try_variant_get(t, f"$.{key}", "variant").isNull()

    def bad_role(t: Column) -> Column:
        role = F.try_variant_get(t, "$.from", "string")
        complete = ~(lacks("from")(t) | lacks("value")(t))
        return complete & ~F.coalesce(role.isin(CHAT_ROLES), F.lit(False))

    nothing = F.lit(None).cast("string")
    found = F.when(v.isNull(), F.array(F.lit("bad_json")))
    found = found.when(~is_object, F.array(F.lit("not_object")))
    found = found.when(conv.isNull(), F.array(F.lit("missing_conversations")))
    found = found.when(turns.isNull(), F.array(F.lit("not_a_list")))
    found = found.otherwise(
        F.array(
            F.when(F.exists(turns, lambda t: lacks("from")(t) | lacks("value")(t)), F.lit("missing_turn_key")).otherwise(
                nothing
            ),
            F.when(F.exists(turns, bad_role), F.lit("bad_role")).otherwise(nothing),
        )
    )
    return df.withColumn("reasons", F.array_compact(found)).withColumn("valid", F.size("reasons") == 0)


def validation_summary(checked: DataFrame) -> DataFrame:
    """One ``total``, ``valid`` and ``invalid`` row, then one row per reason."""
    parts = F.concat(
        F.array(F.lit("total"), F.when(F.col("valid"), F.lit("valid")).otherwise(F.lit("invalid"))),
        F.transform("reasons", lambda r: F.concat(F.lit("reason:"), r)),
    )
    return checked.select(F.explode(parts).alias("measure")).groupBy("measure").agg(F.count(F.lit(1)).alias("n"))


