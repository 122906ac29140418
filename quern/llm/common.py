"""What the operators of this subpackage share: row mapping, written tables, skew-proof joins and running totals.

Conventions of every operator here: null texts count as empty; an input column whose name an operator also returns is
replaced by the operator's; every other column is carried along; equal rows are all kept unless an operator says so.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from quern.session import scratch_dir

#: Rows of an incoming Arrow batch worked on at a time.
SLICE_ROWS = 256
#: A lookup of at most this many narrow rows may be broadcast; the number is counted before.
MAX_BROADCAST_ROWS = 50_000
#: A key is hot above this share of the rows, so there are at most this many hot keys.
MAX_HOT_KEYS = 512


def replaced(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` without columns that are about to be added."""
    return df.drop(*names)


def map_rows(
    df: DataFrame, inputs: Sequence[str], outputs: str, make: Callable[[], Callable], batch: bool = False
) -> DataFrame:
    """Add the columns ``outputs`` (DDL), computed in Python from the columns ``inputs`` of the same row.

    ``make`` runs once per task and returns the function of one row, or with ``batch`` that of a slice of rows, which
    returns a list or Arrow array per output. All other columns pass through as Arrow data.
    """
    added = T.StructType.fromDDL(outputs)
    base = replaced(df, added.names)
    schema = T.StructType(base.schema.fields + added.fields)
    kinds = [to_arrow_type(f.dataType) for f in added.fields]
    names = schema.names
    lower = [c.lower() for c in base.columns]  # names are found as Spark finds them
    at = [lower.index(c.lower()) for c in inputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE_ROWS):
                b = whole.slice(start, SLICE_ROWS)
                cols = [b.column(i).to_pylist() for i in at]
                rows = None if batch else [fn(*r) for r in zip(*cols, strict=True)]
                outs = fn(*cols) if batch else [[r[k] for r in rows] for k in range(len(kinds))]
                made = [x if isinstance(x, pa.Array) else pa.array(x, k) for x, k in zip(outs, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*b.columns, *made], names=names)

    return base.mapInArrow(run, schema)


def keeping(df: DataFrame, names: Sequence[str], apply: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``apply(df)`` with just the columns of ``df``; its own columns called ``names`` are put aside meanwhile."""
    own = {c for c in df.columns if c.lower() in {n.lower() for n in names}}
    out = apply(df.withColumnsRenamed({c: f"_q_own_{c}" for c in own}))
    return out.select(*(F.col(f"_q_own_{c}").alias(c) if c in own else F.col(c) for c in df.columns))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder: it is computed once and survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def size_level(size: Column) -> Column:
    """Bit length and the four leading bits: sizes of one level differ by an eighth at most."""
    bits = F.length(F.bin(size)).cast("int")
    return bits * 16 + F.call_function("shiftright", size, F.greatest(bits - 4, F.lit(0))).cast("int")


def chosen_share(n: int, wanted: int, *by: str) -> Column:
    """Whether a row is among those that a hash of ``by`` chooses: all of up to four times ``wanted``, else about
    twice as many as wanted. Equal keys are chosen or left together."""
    if n <= 4 * wanted:
        return F.lit(True)
    return F.pmod(F.xxhash64(F.lit("chosen"), *by), F.lit(1 << 40)) < int((1 << 40) * 2 * wanted / n)


def key_of(col: str) -> Column:
    """A never-null key: nulls get one of their own."""
    c = F.col(col).cast("string")
    return F.when(c.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), c))


def lookup_join(left: DataFrame, right: DataFrame, keys: Sequence[str], rows: int | None = None) -> DataFrame:
    """Left join to a table with one row per key (keys never null), however often a key occurs on the left.

    A table of at most ``MAX_BROADCAST_ROWS`` rows, counted here, is broadcast. Otherwise only the rows of the left's
    hot keys are, at most ``MAX_HOT_KEYS`` of them, and the other keys meet by a shuffle. Both inputs should be written
    tables, as they are read more than once.
    """
    keys = list(keys)
    if (right.count() if rows is None else rows) <= MAX_BROADCAST_ROWS:
        return left.join(F.broadcast(right), keys, "left")
    least = max(1000, left.count() // MAX_HOT_KEYS)
    hot = left.groupBy(*keys).count().filter(F.col("count") > least).select(*keys)
    hot = written(hot, "hot-keys")
    if hot.isEmpty():
        return left.join(right.hint("merge"), keys, "left")
    hot_rows = hot.join(right, keys, "left").withColumn("_q_hot", F.lit(True))
    here = left.join(F.broadcast(hot.withColumn("_q_hot", F.lit(True))), keys, "left")
    many = here.filter(F.col("_q_hot")).drop("_q_hot").join(F.broadcast(hot_rows), keys, "left").drop("_q_hot")
    few = here.filter(F.col("_q_hot").isNull()).drop("_q_hot").join(right.hint("merge"), keys, "left")
    return many.unionByName(few)


def running_totals(
    df: DataFrame, group: Sequence[str], level: Column, tie: Column, measures: dict[str, Column], rows: int | None = None
) -> DataFrame:
    """Add, for each measure, the total over the rows of the same group up to and including this one.

    Rows of a group are in the order of ``level`` (a long of few values) and then ``tie`` (a hexadecimal digest that
    spreads rows evenly; rows with equal ties should be interchangeable). Groups, which are never null, may be of any
    size: rows are cut into slices by the leading digits of ``tie``, so no task sorts more than a slice of one level,
    and the totals of slices, about the square root of the rows in number, give each slice its offset.
    """
    group = list(group)
    n = df.count() if rows is None else rows
    slices = max(1, math.ceil(math.sqrt(n) / 40))
    cut = F.floor(F.conv(F.substring(F.col("_q_tie"), 1, 8), 16, 10).cast("long") * slices / F.lit(2**32)).cast("long")
    put = df.withColumn("_q_level", level.cast("long")).withColumn("_q_tie", tie).withColumn("_q_slice", cut)
    for name, m in measures.items():
        put = put.withColumn(f"_q_m_{name}", m)
    at = [*group, "_q_level", "_q_slice"]
    totals = put.groupBy(*at).agg(*(F.sum(f"_q_m_{k}").alias(f"_q_t_{k}") for k in measures))
    before = Window.partitionBy(*group).orderBy("_q_level", "_q_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*at, *(F.coalesce(F.sum(f"_q_t_{k}").over(before), F.lit(0)).alias(f"_q_o_{k}") for k in measures))
    inside = Window.partitionBy(*at).orderBy("_q_tie").rowsBetween(Window.unboundedPreceding, 0)
    run = put.withColumns({f"_q_r_{k}": F.sum(f"_q_m_{k}").over(inside) for k in measures})
    out = run.join(offsets, at, "left").withColumns({k: F.col(f"_q_r_{k}") + F.col(f"_q_o_{k}") for k in measures})
    return out.drop("_q_level", "_q_tie", "_q_slice", *(f"_q_{x}_{k}" for x in "mro" for k in measures))


def components(edges: DataFrame, spark: SparkSession) -> DataFrame:
    """``node, root`` for every node of the edges ``a, b``: root is the smallest node of its connected component.

    Alternating star contractions: each round points every neighbour at the smallest node known to it, so the number of
    rounds grows with the logarithm of the longest chain. Each round is written to the shared folder.
    """
    def pairs(df: DataFrame) -> DataFrame:
        return df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()

    links = written(pairs(edges), "links")
    seen = state(links)
    while seen[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(pairs(large), "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = written(pairs(small.unionByName(least.select("a", F.col("m").alias("b")))), "links")
        now = state(links)
        if now == seen:
            break
        seen = now
    roots = links.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return roots.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
