"""Quality rules: fixed base rules, and thresholds that adapt to each language and source."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import keeping, key_of, lookup_join, map_rows, replaced, written
from quern.llm.sketches import merge, quantiles, sketch

SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
MORE = "n_lines long, n_upper long, n_letters long, n_distinct long"

#: metric -> (lower fence?, upper fence?, inner quantile, outer quantile, least distance). A value is out beyond the
#: quantiles of its group by FENCE times the distance between them. Shares that are 0 in most documents have no quartile
#: distance, so theirs is taken further out. The least distance, about what one stray sign or line makes in a short text,
#: counts only where a group has next to no spread.
METRICS = {
    "word_length": (True, True, 0.25, 0.75, 0.25),
    "symbols_per_word": (False, True, 0.5, 0.875, 0.05),
    "dup_line_share": (False, True, 0.5, 0.875, 0.1),
    "repeat_share": (False, True, 0.5, 0.875, 0.05),
    "upper_share": (False, True, 0.25, 0.75, 0.02),
}
FENCE = 4.0
#: Groups with fewer documents take the thresholds of their language, and languages those of all documents.
LEAST_DOCS = 100
BASE_WORDS = 50


def count_text(text: str | None) -> tuple[int, ...]:
    """The counts of one text, columns as in ``COUNTS`` and ``MORE``; null and empty texts count 0 throughout."""
    if not text:
        return (0,) * 9
    raw = text.encode()
    words = raw.split()  # splits at exactly \x20 and \x09-\x0D
    n = len(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    size = len(raw)
    upper = size - len(raw.translate(None, UPPER))
    letters = sum(map(str.isalpha, text))
    return (
        n,
        len(text) - (size - len(raw.translate(None, SPACES))),
        size - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        upper,
        letters,
        len(set(words)),
    )


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three found twice or more, each word once."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    often = Counter(windows)
    marks = bytearray(len(words))
    for i, w in enumerate(windows):
        if often[w] > 1:
            marks[i : i + 3] = b"\1\1\1"
    return marks.count(1)


def with_counts(docs: DataFrame) -> DataFrame:
    """Add the counts, ``base_failed`` and the metrics to every document."""
    out = map_rows(replaced(docs, list(METRICS)), ["text"], f"{COUNTS}, {MORE}", lambda: count_text)
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b))
    return out.withColumns({
        "base_failed": (F.col("n_words") < BASE_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50),
        "word_length": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "upper_share": F.coalesce(share("n_upper", "n_letters"), F.when(F.col("n_words") > 0, F.lit(0.0))),
    })


def thresholds(sketches: DataFrame, group: list[str]) -> DataFrame:
    """``group…, docs`` and the fences of every metric (``lo_…``, ``hi_…``), one row per group."""
    q = quantiles(sketches, group, {f"q{p}": p for p in sorted({p for *_, a, b, _ in METRICS.values() for p in (a, b)})})
    low, high = (of_metric(lambda m, k=k: F.col(f"`q{METRICS[m][k]}`")) for k in (2, 3))
    beyond = F.greatest((high - low) * FENCE, of_metric(lambda m: F.lit(METRICS[m][4])))
    q = q.withColumns({"lo": low - beyond, "hi": high + beyond})
    pick = lambda m, c: F.max(F.when(F.col("metric") == m, F.col(c)))
    return q.groupBy(*group).agg(
        F.max("n").alias("docs"), *(pick(m, c).alias(f"{c}_{m}") for m in METRICS for c in ("lo", "hi"))
    )


def of_metric(value):
    """``value(m)`` in the rows of metric ``m``."""
    out = F.lit(None).cast("double")
    for m in METRICS:
        out = F.when(F.col("metric") == m, value(m)).otherwise(out)
    return out


def rule_thresholds(counted: DataFrame) -> DataFrame:
    """Fences per language and source (keys ``_q_lang, _q_source``) from one merged sketch of all counted rows.

    Documents that fail a base rule stay out of the sketches. Small groups fall back to their language's sketch and
    small languages to that of all documents; both are merged from the fine sketches without another look at the rows.
    """
    fine = written(sketch(counted.filter("NOT base_failed"), ["_q_lang", "_q_source"], list(METRICS)), "sketch")
    cols = [f"{c}_{m}" for m in METRICS for c in ("lo", "hi")]
    own = thresholds(fine, ["_q_lang", "_q_source"])
    lang = thresholds(merge(fine, ["_q_lang"]), ["_q_lang"]).select("_q_lang", F.col("docs").alias("docs_lang"), *(F.col(c).alias(f"{c}_lang") for c in cols))
    every = thresholds(merge(fine, []).withColumn("_q_every", F.lit(1)), ["_q_every"]).select("_q_every", *(F.col(c).alias(f"{c}_all") for c in cols))
    out = own.join(lang, "_q_lang").withColumn("_q_every", F.lit(1)).join(F.broadcast(every), "_q_every")
    pick = lambda c: F.when(F.col("docs") >= LEAST_DOCS, F.col(c)).when(F.col("docs_lang") >= LEAST_DOCS, F.col(f"{c}_lang")).otherwise(F.col(f"{c}_all"))
    return written(out.select("_q_lang", "_q_source", *(pick(c).alias(c) for c in cols)), "thresholds")


def quality_rules(docs: DataFrame) -> DataFrame:
    """Add the counts, metrics, ``base_failed``, ``failed_rules`` and ``kept`` to every document.

    A document is kept unless a base rule fails or one of its metrics lies beyond the fences of its language and
    source. Fences come from quantile sketches over all documents and are joined back by language and source. Null
    languages and sources are groups of their own; null, empty and blank texts fail the base rules; equal rows get
    equal verdicts; an empty table stays empty. Columns read: ``text, lang, source``.
    """
    base = docs.drop("failed_rules", "kept").withColumns({"_q_lang": key_of("lang"), "_q_source": key_of("source")})
    counted = written(with_counts(base), "counted")
    out = lookup_join(counted, rule_thresholds(counted), ["_q_lang", "_q_source"])
    out_of = []
    for m, (lower, upper, *_) in METRICS.items():
        bad = F.lit(False)
        if lower:
            bad = bad | (F.col(m) < F.col(f"lo_{m}"))
        if upper:
            bad = bad | (F.col(m) > F.col(f"hi_{m}"))
        out_of.append(F.when(F.coalesce(bad, F.lit(False)), F.lit(m)))
    out = out.withColumn("failed_rules", F.array_compact(F.array(*out_of)))
    out = out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
    return out.drop("_q_lang", "_q_source", *(f"{c}_{m}" for m in METRICS for c in ("lo", "hi")))


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with their own columns, also those called as the rules' ones."""
    added = [c.split()[0] for c in f"{COUNTS}, {MORE}".split(", ")] + [*METRICS, "base_failed", "failed_rules", "kept"]
    return keeping(docs, added, lambda d: quality_rules(d).filter("kept"))
