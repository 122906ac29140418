"""Mixing sources to target weights by systematic sampling, in DataFrame functions only."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import keeping, key_of, lookup_join, replaced, running_totals, size_level, written

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: No source gives more than this many times its own size.
MAX_COPIES = 3
SEED = 42
ADDED = ("size", "source_size", "target", "copies", "taken")


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def offset_of(seed: int) -> float:
    """The one random offset, from the seed."""
    return int(hashlib.md5(f"offset {seed}".encode()).hexdigest()[:12], 16) / 16**12


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """Add ``target`` to a table of one row per source (``source``, ``source_size``).

    Targets share the total by weight. A source that would give more than ``max_copies`` times its size stops there,
    and what it leaves is shared by the others by weight until none is above: sources are taken in the order of
    limit over weight, and those before the first that fits its share are at their limits. The table, a row per
    source, is ordered in one task.
    """
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    at = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (at + 1).cast("int")).cast("long")
    whole = Window.partitionBy(F.lit(0))
    out = sizes.withColumn("_q_w", weight).withColumn("_q_cap", F.col("source_size") * max_copies)
    by_limit = whole.orderBy(F.col("_q_cap") / F.col("_q_w"), F.col("source").asc_nulls_last())
    earlier = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    out = out.withColumns({
        "_q_left": F.sum("source_size").over(whole) - F.coalesce(F.sum("_q_cap").over(earlier), F.lit(0)),
        "_q_rest": F.sum("_q_w").over(by_limit.rowsBetween(0, Window.unboundedFollowing)),
    })
    fits = F.col("_q_left") * F.col("_q_w") <= F.col("_q_cap") * F.col("_q_rest")
    out = out.withColumn("_q_fits", fits).withColumn("_q_n", F.row_number().over(by_limit))
    first = F.min(F.struct(F.when(F.col("_q_fits"), F.col("_q_n")).otherwise(2**30).alias("n"), "_q_left", "_q_rest")).over(whole)
    out = out.withColumn("_q_first", first)
    share = (F.col("_q_first._q_left") * F.col("_q_w")).cast("double") / F.col("_q_first._q_rest").cast("double")
    target = F.when(F.col("_q_n") < F.col("_q_first.n"), F.col("_q_cap").cast("double")).otherwise(share)
    return out.withColumn("target", target).drop("_q_w", "_q_cap", "_q_left", "_q_rest", "_q_fits", "_q_n", "_q_first")


def mix_sources(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_copies: int = MAX_COPIES, seed: int = SEED
) -> DataFrame:
    """Add ``size, source_size, target, copies`` and ``taken = copies * size`` to every document.

    Within a source each document is expected ``target / source_size`` times. Documents are lined up by size level and
    the digest of their id, expected copies are summed up along the line, one random offset is added, and a document
    is emitted once per integer that its interval crosses: the taken words differ from the target by about one largest
    document at most, and no document exceeds ``max_copies`` times its size. The order depends on ids and sizes alone,
    so reruns agree on any partitioning. Columns read: ``doc_id, text, source``; null sources form a source of their
    own, named last; a null text has size 0; equal rows are documents of their own. An empty table stays empty.
    """
    base = replaced(docs, ADDED).withColumn("size", word_count()).withColumn("_q_src", key_of("source"))
    totals = base.groupBy("_q_src").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    targets = written(source_targets(totals, weights, max_copies).drop("source"), "targets")
    tie = F.concat(
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))),
        F.lpad(F.col("size").cast("string"), 12, "0"),
    )
    lined = running_totals(base, ["_q_src"], -size_level(F.col("size")), tie, {"_q_rank": F.lit(1)}, docs.count())
    out = lookup_join(lined, targets, ["_q_src"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size").cast("double")).otherwise(0.0)
    crossed = lambda k: F.floor(F.lit(offset_of(seed)) + rate * k)
    copies = (crossed(F.col("_q_rank")) - crossed(F.col("_q_rank") - 1)).cast("long")
    out = out.withColumn("copies", F.least(copies, F.lit(max_copies).cast("long")))
    return out.withColumn("taken", F.col("copies") * F.col("size")).drop("_q_src", "_q_rank")


def emit_copies(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row as often as ``copies`` says."""
    return mixed.filter("copies > 0").withColumn("_q_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("_q_copy")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix of a table as rows of its own columns."""
    return keeping(docs, ADDED, lambda d: emit_copies(mix_sources(d)))


ORACLE = rf"""
WITH sized AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN 'n' ELSE 'v' || source END AS src,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
per_source AS (SELECT src, any_value(source) AS source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY src),
weighted AS (
  SELECT *, CAST(CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS BIGINT) AS w
  FROM per_source),
ordered AS (
  SELECT *, row_number() OVER o AS n, sum(source_size) OVER () - coalesce(sum(source_size * 3) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
         sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM weighted WINDOW o AS (ORDER BY (source_size * 3) / w, source NULLS LAST)),
fit AS (SELECT n, left_over, rest FROM ordered WHERE left_over * w <= source_size * 3 * rest ORDER BY n LIMIT 1),
targets AS (
  SELECT o.src, o.source_size,
         CASE WHEN o.n < f.n THEN CAST(o.source_size * 3 AS DOUBLE) ELSE CAST(f.left_over * o.w AS DOUBLE) / CAST(f.rest AS DOUBLE) END AS target
  FROM ordered o, fit f),
lined AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         row_number() OVER (PARTITION BY s.src ORDER BY -(length(bin(s.size)) * 16 + (s.size >> greatest(length(bin(s.size)) - 4, 0))),
           md5('{SEED}:' || coalesce(CAST(s.doc_id AS VARCHAR), 'null')) || lpad(CAST(s.size AS VARCHAR), 12, '0')) AS r,
         CASE WHEN t.source_size > 0 THEN t.target / CAST(t.source_size AS DOUBLE) ELSE 0 END AS rate
  FROM sized s JOIN targets t USING (src))
SELECT doc_id, size, source_size, target,
       CAST(floor({offset_of(SEED)!r} + rate * r) - floor({offset_of(SEED)!r} + rate * (r - 1)) AS BIGINT) * size AS taken
FROM lined
"""
