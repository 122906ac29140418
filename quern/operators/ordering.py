"""Order-dependent operators that never put one group in one task.

A row number over a whole table (or over one hot group) is a single task in Spark. Here rows are cut into
ordered buckets, the buckets are counted, the counts are prefix-summed (one small row per bucket) and the row
number is taken inside each bucket. Which executor holds which row does not matter to the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.session import shuffle_width

BUCKET_ROWS = 100_000  # rows that a bucket of a large table holds about
MAX_BUCKETS = 16_384  # splitters of a numeric key at most
MIN_BUCKETS, PER_PARTITION = 64, 8  # hash buckets at least, and per shuffle partition of the session


def hash_key(seed: int | str, *cols: Column) -> Column:
    """Seeded, partition-independent shuffle key (32 hex digits)."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in cols]))


def hash_bucket(h: Column, buckets: int) -> Column:
    """Bucket of a hex hash that keeps the order of the hashes."""
    return F.shiftright(F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") * buckets, 32)


def quantile_bounds(df: DataFrame, key: str, buckets: int | None = None) -> list[float]:
    """Splitters of a numeric key, in number after the rows, from one approximate-percentile aggregate."""
    n = buckets or min(MAX_BUCKETS, max(4, 2 * shuffle_width(df.sparkSession)))
    probs = [i / n for i in range(1, n)]
    splitters = F.percentile_approx(F.col(key).cast("double"), probs, 20 * n)
    row = df.agg(splitters.alias("b"), F.count(F.lit(1)).alias("n")).first()
    wanted = min(MAX_BUCKETS, row["n"] // BUCKET_ROWS)
    if buckets is None and wanted > n:
        return quantile_bounds(df, key, wanted)
    return sorted(set(row["b"] or []))


def with_bucket(df: DataFrame, key: str, bounds: Sequence[float], name: str = "_b") -> DataFrame:
    """Add the ordered bucket of ``key`` for the given splitters."""
    if not bounds:
        return df.withColumn(name, F.lit(0))
    splits = [float("-inf"), *[float(b) for b in bounds], float("inf")]
    b = Bucketizer(splits=splits, inputCol=key, outputCol=name, handleInvalid="keep")
    return b.transform(df).withColumn(name, F.coalesce(F.col(name).cast("int"), F.lit(-1)))  # nulls come first


def _bucketed(df: DataFrame, key: str, by: Sequence[str], hashed: bool, bounds_from: DataFrame | None) -> DataFrame:
    """Rows with bucket ``_b`` and group ``_g`` (a struct, so that a null group is a group like any other)."""
    if hashed:
        n = max(MIN_BUCKETS, PER_PARTITION * shuffle_width(df.sparkSession))
        rows = df.withColumn("_b", F.coalesce(hash_bucket(F.col(key), n), F.lit(-1)))
    else:
        rows = with_bucket(df, key, quantile_bounds(bounds_from if bounds_from is not None else df, key))
    return rows.withColumn("_g", F.struct(*by)) if by else rows


def _placed(b: DataFrame, by: Sequence[str], order: Sequence[str], limit: Column | None = None) -> DataFrame:
    """Add ``_pos``; with ``limit``, buckets that start beyond it are left out before any sorting."""
    on = ["_g", "_b"] if by else ["_b"]
    counts = b.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_g" if by else F.lit(0)).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(*on, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    rows = b.join(offs if by else F.broadcast(offs), on)  # without groups: one row per bucket
    if limit is not None:
        rows = rows.where(F.col("_off") < limit)
    inside = F.row_number().over(Window.partitionBy(*on).orderBy(*order))
    return rows.withColumn("_pos", (inside - 1 + F.col("_off")).cast("bigint"))


def dense_index(
    df: DataFrame,
    key: str,
    by: Sequence[str] = (),
    name: str = "idx",
    ties: Sequence[str] = (),
    hashed: bool = False,
    bounds_from: DataFrame | None = None,
) -> DataFrame:
    """Append the gap-free 0-based position of each row in ``key`` order (within ``by``, if given).

    ``key`` is numeric, or a hex hash with ``hashed=True``; ``(key, *ties)`` must be unique within ``by``. Null keys
    come first.
    ``bounds_from`` may name a cheaper table holding the same key, used only to place the splitters.
    """
    rows = _placed(_bucketed(df, key, by, hashed, bounds_from), by, [key, *ties])
    return rows.withColumnRenamed("_pos", name).select(*df.columns, name)


def first_n(
    df: DataFrame,
    n: int | Column,
    key: str,
    by: Sequence[str] = (),
    name: str = "idx",
    ties: Sequence[str] = (),
    hashed: bool = False,
    bounds_from: DataFrame | None = None,
) -> DataFrame:
    """The first ``n`` rows in ``key`` order (per group), with their position in ``name``."""
    n = F.lit(n) if isinstance(n, int) else n
    rows = _placed(_bucketed(df, key, by, hashed, bounds_from), by, [key, *ties], n)
    return rows.withColumnRenamed("_pos", name).where(F.col(name) < n).select(*df.columns, name)


def _numbers(values: Sequence, kind: str) -> Column:
    """A constant array of numbers, however many, as one literal."""
    return F.split(F.lit(" ".join(str(x) for x in values)), " ").cast(f"array<{kind}>")


def dense_runs(df: DataFrame, key: str, rows: int, name: str = "idx", run: str = "run", part: str = "part") -> DataFrame:
    """Append the position of each row in ``key`` order, its ``run`` of ``rows`` consecutive rows, and its ``part``, which
    is made of whole runs.

    The positions of the keys alone tell where parts begin, so the rows themselves are shuffled once, by part: what is
    then grouped by part and run stays where it is. ``key`` is a number and unique; a null key comes first.
    """
    keys = df.select(key)
    n = keys.count()
    wanted = max(n // MAX_BUCKETS + 1, min(BUCKET_ROWS, n // max(4, 2 * shuffle_width(df.sparkSession))))
    size = -(-wanted // rows) * rows
    starts, firsts = [0], []
    if n > size:
        begins = dense_index(keys, key, name="_i").where((F.col("_i") % size == 0) & F.col(key).isNotNull() & (F.col("_i") > 0))
        for r in begins.orderBy("_i").collect():  # at most MAX_BUCKETS
            if not firsts or float(r[key]) > float(firsts[-1]):
                starts.append(r["_i"])
                firsts.append(r[key])
    placed = with_bucket(df, key, firsts, "_b")
    if firsts:
        # Large whole numbers can round up to the first key of the next part.
        beyond = F.get(_numbers(firsts, df.schema[key].dataType.simpleString()), F.col("_b") - 1) > F.col(key)
        placed = placed.withColumn("_b", F.when(beyond, F.col("_b") - 1).otherwise(F.greatest("_b", F.lit(0))))
    inside = F.row_number().over(Window.partitionBy("_b").orderBy(F.col(key).asc_nulls_first()))
    at = (F.get(_numbers(starts, "bigint"), F.col("_b")) + inside - 1).cast("bigint")
    out = placed.withColumn(name, at).withColumn(run, F.floor(F.col(name) / rows))
    return out.select(*df.columns, name, run, F.col("_b").alias(part))
