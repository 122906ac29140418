"""Answer extraction and comparison as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions.text import from_pos, let, strip

# The answer notations. (?d): only \n ends a line; (?s): a dot crosses lines.
THINK = r"(?s)<think>.*?</think>"
BOXED = r"\\boxed\{([^}]+)\}"
HASHES = r"####\s*([+-]?\d[\d,]*\.?\d*)"
SPOKEN = r"[Tt]he\s+(?:final\s+)?answer\s+is[:\s]*\$?([+-]?\d[\d,]*\.?\d*)\$?"
ANY_NUMBER = r"[+-]?\d[\d,]*\.?\d*"
NUMBER_TEXT = r"\A[+-]?(?:(?:\d+(?:_\d+)*\.?(?:\d+(?:_\d+)*)?|\.\d+(?:_\d+)*)(?:[eE][+-]?\d+)?|(?i:inf|infinity|nan))\z"
FLAT_BRACES = r"\A\{([^{}]*)\}"
ANSWER_TAG = r"(?s)<answer>(.*?)</answer>"
FORMAT_TAGS = r"(?d)^<think>.*?</think><answer>.*?</answer>$"
GOLD_MARK = "####"
TOLERANCE = 1e-3


def strip_think(c: Column) -> Column:
    """Remove the reasoning blocks."""
    return F.regexp_replace(c, THINK, "")


def to_number(c: Column) -> Column:
    """The number a text spells, null if it is anything else."""
    bare = strip(F.replace(c, F.lit(","), F.lit("")))
    return let(bare, lambda t: F.when(t.rlike(NUMBER_TEXT), F.replace(t, F.lit("_"), F.lit("")).try_cast("double")))


def _last(c: Column, pattern: str, group: int) -> Column:
    return F.try_element_at(F.regexp_extract_all(c, F.lit(pattern), group), F.lit(-1))


def extract_number(c: Column) -> Column:
    """Numeric answer: boxed, then after ``####``, then spoken, then the last number; null if none parses."""
    ways = [(BOXED, 1), (HASHES, 1), (SPOKEN, 1), (ANY_NUMBER, 0)]
    return let(strip_think(c), lambda t: F.coalesce(*[to_number(_last(t, p, g)) for p, g in ways]))


def boxed_balanced(c: Column) -> Column:
    """Content of the last ``\\boxed``/``\\fbox`` with its braces balanced; null when they are not.

    The ``\\boxed x`` form ends at the next dollar sign. An ``\\fbox{…}`` is located but, as a result, unwrapped to
    null: only the boxed form has content here.
    """
    spaced = F.split_part(F.substring_index(c, "\\boxed ", -1), F.lit("$"), F.lit(1))
    found = let(F.substring_index(c, "\\boxed", -1), _braced)
    return F.when(c.contains("\\boxed "), spaced).when(c.contains("\\boxed"), found)


def _braced(tail: Column) -> Column:
    """Content of the balanced braces a text starts with; a flat pair needs no counting."""
    chars = F.split(tail, "")
    start = F.struct(
        F.lit(0).alias("depth"), F.lit(0).alias("at"), F.lit(0).alias("end"), F.lit(False).alias("done")
    )

    def step(acc: Column, ch: Column) -> Column:
        depth = acc["depth"] + F.when(ch == "{", 1).when(ch == "}", -1).otherwise(0)
        closes = ~acc["done"] & (ch == "}") & (depth == 0)
        at = acc["at"] + 1
        return F.struct(
            depth.cast("int").alias("depth"),
            at.alias("at"),
            F.when(closes, at).otherwise(acc["end"]).alias("end"),
            (acc["done"] | closes).alias("done"),
        )

    counted = let(
        F.aggregate(chars, start, step)["end"],
        lambda end: F.when(end > 0, F.substr(tail, F.lit(2), (end - 2).cast("int"))),
    )
    return F.when(tail.rlike(FLAT_BRACES), F.regexp_extract(tail, FLAT_BRACES, 1)).when(tail.startswith("{"), counted)


def answer_tag(c: Column) -> Column:
    """Stripped content of the first answer tag, else the stripped text; '' for null."""
    tagged = strip(F.regexp_extract(c, ANSWER_TAG, 1))
    return F.coalesce(F.when(c.rlike(ANSWER_TAG), tagged).otherwise(strip(c)), F.lit(""))


def normalize_spaces(c: Column) -> Column:
    """Lower case, stripped, runs of white space as one blank; '' for null."""
    return F.coalesce(F.regexp_replace(F.lower(strip(c)), r"\s+", " "), F.lit(""))


def gold_answer(c: Column) -> Column:
    """What follows the first gold mark, else the whole text; stripped."""
    at = F.locate(GOLD_MARK, c)
    return strip(F.when(at > 0, from_pos(c, at - 1 + len(GOLD_MARK))).otherwise(c))


def numbers_agree(a: Column, b: Column) -> Column:
    return F.coalesce(F.abs(a - b) < F.lit(TOLERANCE), F.lit(False))


def verify_numeric(prediction: Column, truth_value: Column) -> Column:
    """1.0 when the extracted number is within tolerance of the true value, else 0.0."""
    return F.when(numbers_agree(extract_number(prediction), truth_value), 1.0).otherwise(0.0)


def normalize_math(c: Column) -> Column:
    """Answer text without layout commands, units and grouping commas; a simple fraction as ``a/b``."""
    t = F.regexp_replace(c, r"\\(?:left|right|,|;|!|quad)", "")
    t = F.regexp_replace(t, r"\\d?frac\{([^{}]+)\}\{([^{}]+)\}", "$1/$2")
    t = F.regexp_replace(t, r"\\(?:text|mathrm)\{[^{}]*\}", "")
    t = F.regexp_replace(t, r"\\?[$%]", "")
    t = F.regexp_replace(t, r"(\d),(\d\d\d)", "$1$2")
    t = F.regexp_replace(t, r"(\d)\s*(?:dollars|cents|units|degrees|percent|cm|kg|km|m)\z", "$1")
    return F.lower(F.regexp_replace(t, r"\s+", ""))


def math_value(c: Column) -> Column:
    """Numeric value of a normalised answer, fractions included."""
    top = to_number(F.split_part(c, F.lit("/"), F.lit(1)))
    bottom = to_number(F.split_part(c, F.lit("/"), F.lit(2)))
    return F.when(c.contains("/"), F.try_divide(top, bottom)).otherwise(to_number(c))


def same_answer(p: Column, g: Column) -> Column:
    """How two normalised answers agree: ``text``, ``value`` or ``differ``."""
    return F.when(p == g, "text").when(numbers_agree(math_value(p), math_value(g)), "value").otherwise("differ")


def candidate_answer(prediction: Column) -> Column:
    """The answer a prediction states outright (boxed, hashed or tagged); null when it states none."""

    def stated(t: Column) -> Column:
        hashed = F.when(t.contains(GOLD_MARK), strip(F.regexp_extract(t, r"(?d)####[ \t]*(.*)", 1)))
        tagged = F.when(t.rlike(ANSWER_TAG), answer_tag(t))
        return F.coalesce(boxed_balanced(t), hashed, tagged)

    return let(strip_think(prediction), stated)


def truth_answer(truth: Column) -> Column:
    """The gold answer: after the gold mark, else in a box, else the text itself."""
    return F.when(truth.contains(GOLD_MARK), gold_answer(truth)).otherwise(
        F.coalesce(boxed_balanced(truth), strip(truth))
    )


def verify_path(prediction: Column, truth: Column) -> Column:
    """Which rule settles normalised equality: ``text``, ``value``, ``differ`` or ``unparsed``."""
    sides = F.struct(
        normalize_math(candidate_answer(prediction)).alias("p"), normalize_math(truth_answer(truth)).alias("g")
    )
    return let(
        sides,
        lambda s: F.when(s["p"].isNull() | (s["g"] == ""), "unparsed").otherwise(same_answer(s["p"], s["g"])),
    )


def accuracy_reward(completion: Column, answer: Column) -> Column:
    """1.0 when a completion's answer equals the reference answer, by text or by value.

    A gold-marked reference is compared with the answer tag (or the whole completion), any other with the answer the
    completion states outright.
    """
    said = F.when(answer.contains(GOLD_MARK), answer_tag(completion)).otherwise(candidate_answer(completion))
    sides = F.struct(normalize_math(said).alias("p"), normalize_math(truth_answer(answer)).alias("g"))
    return let(
        sides, lambda s: F.when((s["g"] != "") & (same_answer(s["p"], s["g"]) != "differ"), 1.0).otherwise(0.0)
    )


def format_reward(c: Column) -> Column:
    """1.0 when the text is one reasoning block directly followed by one answer block, on one line each."""
    return F.when(c.rlike(FORMAT_TAGS), 1.0).otherwise(0.0)
