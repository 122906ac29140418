"""Mergeable quantile sketches as tables: counts in buckets whose bounds grow by a fixed factor."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Values in a bucket differ by this factor at most, so a quantile is right within about one hundredth.
GROWTH = 1.02
#: Smaller values share the lowest bucket.
LEAST = 1e-6
LOWEST = -(10**6)


def bucket_of(value: Column) -> Column:
    return F.when(value < LEAST, F.lit(LOWEST)).otherwise(F.ceil(F.log(value) / math.log(GROWTH)).cast("int"))


def value_of(bucket: Column) -> Column:
    return F.when(bucket == LOWEST, F.lit(0.0)).otherwise(F.pow(F.lit(GROWTH), bucket) * (2 / (1 + GROWTH)))


def sketch(df: DataFrame, group: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """``group…, metric, bucket, n`` for the non-negative metrics of every row; nulls are left out.

    Counts of buckets add up: partial sketches are merged by a sum, first inside each task, so a hot group costs one
    row per bucket and task. A sketch has as many rows as the metric spans buckets, whatever the number of rows.
    """
    each = F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), bucket_of(F.col(m)).alias("bucket")) for m in metrics)))
    rows = df.select(*group, each.alias("_q_s")).select(*group, "_q_s.metric", "_q_s.bucket")
    return rows.filter("bucket IS NOT NULL").groupBy(*group, "metric", "bucket").agg(F.count("*").alias("n"))


def merge(sketches: DataFrame, group: Sequence[str]) -> DataFrame:
    """The sketches of coarser groups."""
    return sketches.groupBy(*group, "metric", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, group: Sequence[str], qs: dict[str, float]) -> DataFrame:
    """``group…, metric, n`` and one column per named quantile."""
    w = Window.partitionBy(*group, "metric")
    upto = F.sum("n").over(w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    ranked = sketches.withColumn("_q_upto", upto).withColumn("_q_all", F.sum("n").over(w))
    pick = lambda q: value_of(F.min(F.when(F.col("_q_upto") >= F.col("_q_all") * q, F.col("bucket"))))
    return ranked.groupBy(*group, "metric").agg(F.sum("n").alias("n"), *(pick(q).alias(k) for k, q in qs.items()))
