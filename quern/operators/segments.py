"""Scans along long ordered groups (the turns of one dialog) in bounded pieces.

A group is cut every ``size`` positions. Each piece is small enough for one task; what a piece needs from the
pieces before it travels as one summary row per piece. A dialog that holds a third of the table is thus spread
over many tasks, and a short dialog costs nothing extra: it has a single piece.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEGMENT = 4096
SEG = "_seg"


def with_segment(df: DataFrame, pos: str, size: int = SEGMENT) -> DataFrame:
    return df.withColumn(SEG, F.floor(F.col(pos) / F.lit(size)).cast("bigint"))


def attach_facts(
    rows: DataFrame, keys: Sequence[str], pos: str, aggs: Sequence[Column], size: int = SEGMENT
) -> DataFrame:
    """Join per-group aggregates to every row of the group, one copy of the aggregates per piece."""
    rows = rows if SEG in rows.columns else with_segment(rows, pos, size)
    facts = rows.groupBy(*keys).agg(*aggs, F.max(SEG).alias("_last_seg"))
    spread = facts.withColumn(SEG, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_last_seg")))).drop(
        "_last_seg"
    )
    return rows.join(spread, [*keys, SEG])


def running_count(
    rows: DataFrame,
    keys: Sequence[str],
    pos: str,
    cond: Column,
    name: str,
    total: str | None = None,
    size: int = SEGMENT,
) -> DataFrame:
    """Count of ``cond`` rows of the group up to and including the row; optionally the group's total too."""
    rows = rows if SEG in rows.columns else with_segment(rows, pos, size)
    rows = rows.withColumn("_c", F.when(cond, 1).otherwise(0))
    w = Window.partitionBy(*keys).orderBy(SEG)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry = (
        rows.groupBy(*keys, SEG)
        .agg(F.sum("_c").alias("_s"))
        .select(
            *keys,
            SEG,
            F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_carry"),
            F.sum("_s").over(whole).alias("_total"),
        )
    )
    local = Window.partitionBy(*keys, SEG).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.join(carry, [*keys, SEG]).withColumn(name, (F.sum("_c").over(local) + F.col("_carry")).cast("bigint"))
    if total:
        out = out.withColumn(total, F.col("_total").cast("bigint"))
    return out.drop("_c", "_carry", "_total")


def last_before(
    rows: DataFrame, keys: Sequence[str], pos: str, value: Column, name: str, size: int = SEGMENT
) -> DataFrame:
    """Latest non-null ``value`` of the group strictly before the row, null if there is none."""
    rows = rows if SEG in rows.columns else with_segment(rows, pos, size)
    rows = rows.withColumn("_v", value)
    tail = rows.groupBy(*keys, SEG).agg(
        F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col(pos))).alias("_t")
    )
    before = Window.partitionBy(*keys).orderBy(SEG).rowsBetween(Window.unboundedPreceding, -1)
    carry = tail.select(*keys, SEG, F.last("_t", ignorenulls=True).over(before).alias("_carry")).where(
        F.col("_carry").isNotNull()
    )
    local = Window.partitionBy(*keys, SEG).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    found = F.coalesce(F.last("_v", ignorenulls=True).over(local), F.col("_carry"))
    return rows.join(carry, [*keys, SEG], "left").withColumn(name, found).drop("_v", "_carry")


def trailing_lines(
    rows: DataFrame, keys: Sequence[str], pos: str, line: Column, k: int, name: str, size: int = SEGMENT
) -> DataFrame:
    """The ``k`` lines before each row, in order, as an array.

    ``pos`` is the gap-free position in the group. The last ``k`` rows of a piece are copied into the next piece,
    so no window reaches beyond its own piece.
    """
    if k > size:
        raise ValueError("window longer than a piece")
    rows = with_segment(rows, pos, size).withColumn("_line", line)
    edge = F.col(pos) % F.lit(size) >= size - k
    targets = F.when(
        edge,
        F.array(
            F.struct(F.col(SEG).alias("seg"), F.lit(True).alias("own")),
            F.struct((F.col(SEG) + 1).alias("seg"), F.lit(False).alias("own")),
        ),
    ).otherwise(F.array(F.struct(F.col(SEG).alias("seg"), F.lit(True).alias("own"))))
    spread = (
        rows.withColumn("_to", F.explode(targets))
        .withColumn(SEG, F.col("_to.seg"))
        .withColumn("_own", F.col("_to.own"))
        .drop("_to")
    )
    w = Window.partitionBy(*keys, SEG).orderBy(pos).rowsBetween(-k, -1)
    return (
        spread.withColumn(name, F.collect_list("_line").over(w))
        .where("_own")
        .drop("_own", "_line", SEG)
    )


def joined_text(rows: DataFrame, keys: Sequence[str], pos: str, text: Column, name: str, sep: str = "") -> DataFrame:
    """Concatenate the texts of a group in order: one row per group, which must fit a value."""
    piece = F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), text.alias("t"))))
    joined = F.array_join(F.transform("_p", lambda x: x["t"]), sep)
    return rows.groupBy(*keys).agg(piece.alias("_p")).select(*keys, joined.alias(name))


def scan(
    rows: DataFrame,
    keys: Sequence[str],
    pos: str,
    counts: dict[str, Column] | None = None,
    totals: dict[str, Column] | None = None,
    highest: dict[str, Column] | None = None,
    previous: dict[str, Column] | None = None,
    following: dict[str, Column] | None = None,
    size: int = SEGMENT,
) -> DataFrame:
    """Several scans of the same rows for the price of one join.

    ``counts`` are running counts of conditions, ``totals`` and ``highest`` aggregates of the whole group,
    ``previous`` and ``following`` the value of the neighbouring row.
    """
    counts, totals, highest = counts or {}, totals or {}, highest or {}
    previous, following = previous or {}, following or {}
    rows = rows if SEG in rows.columns else with_segment(rows, pos, size)
    for n, c in counts.items():
        rows = rows.withColumn(f"_c_{n}", F.when(c, 1).otherwise(0))
    aggs = [F.sum(f"_c_{n}").alias(f"_c_{n}") for n in counts]
    aggs += [F.count_if(c).alias(f"_t_{n}") for n, c in totals.items()]
    aggs += [F.max(c).alias(f"_h_{n}") for n, c in highest.items()]
    aggs += [F.max_by(c, pos).alias(f"_p_{n}") for n, c in previous.items()]
    aggs += [F.min_by(c, pos).alias(f"_f_{n}") for n, c in following.items()]
    w = Window.partitionBy(*keys).orderBy(SEG)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry = rows.groupBy(*keys, SEG).agg(*aggs).select(
        *keys,
        SEG,
        *[F.coalesce(F.sum(f"_c_{n}").over(before), F.lit(0)).alias(f"_b_{n}") for n in counts],
        *[F.sum(f"_t_{n}").over(whole).alias(n) for n in totals],
        *[F.max(f"_h_{n}").over(whole).alias(n) for n in highest],
        *[F.lag(f"_p_{n}").over(w).alias(f"_p_{n}") for n in previous],
        *[F.lead(f"_f_{n}").over(w).alias(f"_f_{n}") for n in following],
    )
    local = Window.partitionBy(*keys, SEG).orderBy(pos)
    so_far = local.rowsBetween(Window.unboundedPreceding, 0)
    out = rows.join(carry, [*keys, SEG])
    added = [(F.sum(f"_c_{n}").over(so_far) + F.col(f"_b_{n}")).cast("bigint").alias(n) for n in counts]
    for n, c in previous.items():
        added.append(F.when(F.row_number().over(local) == 1, F.col(f"_p_{n}")).otherwise(F.lag(c).over(local)).alias(n))
    for n, c in following.items():
        # A piece's last row has no local successor; a marker tells that from a successor whose value is null.
        nxt = F.lead(F.struct(c.alias("v"))).over(local)
        added.append(F.when(nxt.isNull(), F.col(f"_f_{n}")).otherwise(nxt["v"]).alias(n))
    plain = [c for c in rows.columns if not c.startswith("_c_")]
    return out.select(*plain, *totals, *highest, *added)
