"""The key at a place in the order of a table, without sorting the table.

The keys' range is cut into buckets, the buckets are counted (partial counts, a bounded number of rows), and the search
goes on in the one bucket that holds the place, until what is left fits a task. Comparisons are on the key's own type: a
whole number is never turned into a floating-point one, so any 64-bit id has its place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Buckets of a pass, and keys that may be sorted in one task at the end.
BUCKETS, FEW = 4096, 10_000
#: Bytes of a text that a pass goes by.
STEP = 2


def _whole(kind: T.DataType) -> bool:
    return isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def _counted(keys: DataFrame, bucket: Column) -> list:
    """``b, n, lo, hi`` of each bucket in order: a bounded number of rows."""
    rows = keys.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi"))
    return sorted(rows.collect(), key=lambda r: r["b"])


def _found(rows: list, place: int) -> tuple:
    """The bucket that holds the place, and the place within it."""
    for r in rows:
        if place < r["n"]:
            return r, place
        place -= r["n"]
    raise AssertionError("the place lies behind the last row")


def _text_bucket(done: int) -> Column:
    """The bytes behind the first ``done`` ones as a number that keeps their order; an ended text comes first."""
    digits = F.hex(F.encode("k", "UTF-8"))
    parts = [
        F.coalesce(F.conv(F.nullif(F.substring(digits, 2 * (done + i) + 1, 2), F.lit("")), 16, 10).cast("int") + 1, F.lit(0))
        for i in range(STEP)
    ]
    return parts[0] * 257 + parts[1]


def key_at(df: DataFrame, key: str, place: int):
    """The key of the row at the 0-based ``place`` in ascending order, among rows whose key is not null.

    None where there is no such row, and NaN counts as none. Keys are whole numbers, texts, floating-point numbers or
    decimals; other types with an order (dates, times) are an error beyond ``FEW`` rows.
    """
    kind = df.schema[key].dataType
    keys = df.select(F.col(key).alias("k")).where("k IS NOT NULL")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        keys = keys.where("NOT isnan(k)")
    first = keys.agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi")).first()
    if place < 0 or place >= first["n"]:
        return None
    n, lo, hi, done = first["n"], first["lo"], first["hi"], 0
    while lo != hi and n > FEW:
        inside = keys.where((F.col("k") >= F.lit(lo)) & (F.col("k") <= F.lit(hi)))
        if isinstance(kind, T.StringType):
            shared = _shared_bytes(lo, hi)
            done = max(done, shared)
            bucket = _text_bucket(done)
        elif _whole(kind):
            width = (hi - lo) // BUCKETS + 1
            bucket = F.expr(f"CAST((CAST(k AS DECIMAL(20,0)) - {lo}) DIV {width} AS INT)")
        else:
            number, a, b = _as_number(kind, lo, hi)
            bucket = F.least(F.floor((number - F.lit(a)) / F.lit((b - a) / BUCKETS)), F.lit(BUCKETS - 1)).cast("int")
        row, place = _found(_counted(inside, bucket), place)
        if (row["n"], row["lo"], row["hi"]) == (n, lo, hi):
            break  # neighbouring floating-point numbers that one bucket cannot tell apart
        n, lo, hi = row["n"], row["lo"], row["hi"]
    if lo == hi:
        return lo
    rest = keys.where((F.col("k") >= F.lit(lo)) & (F.col("k") <= F.lit(hi)))
    # Few rows, or few distinct ones: counted per key, they are put in order here.
    return _found(_counted(rest, F.col("k")), place)[0]["b"]


def _shared_bytes(lo: str, hi: str) -> int:
    a, b = lo.encode(), hi.encode()
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def _as_number(kind: T.DataType, lo, hi) -> tuple[Column, float, float]:
    """The key as a floating-point number that keeps its order, and that of both ends."""
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return F.col("k").cast("double"), float(lo), float(hi)
    raise TypeError(f"keys of type {kind.simpleString()} have no buckets")
