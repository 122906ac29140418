"""Approximate nearest vectors by cosine: inverted lists round coarse centroids, exact scores within the lists probed.

Centroids are fitted on a bounded sample; every vector of the table is put into the list of its nearest one. A list of
any length is cut into parts by the hash of the id, so that a part is one task's work of bounded size. A query visits the
lists of the centroids nearest to it, where its exact scores are taken; with as many probes as lists the result is exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.session import scratch_dir

#: Vectors that the centroids are fitted on at most, lists at most, and rounds of fitting.
SAMPLE, MAX_LISTS, ROUNDS = 20_000, 4096, 8
#: Vectors of a part, about.
PART = 8192
#: Vectors of the sample that are asked to choose the number of lists that a query visits, and the share of their nearest
#: ones that it has to reach.
ASKED, REACHED = 400, 0.95
SEED = 42


@dataclass
class DenseIndex:
    """``rows`` (``list, part, doc_id, v``), ``parts`` (``list, parts``; a row per list), the centroids and the number of
    lists that a query visits unless told otherwise."""

    rows: DataFrame
    parts: DataFrame
    centroids: np.ndarray
    probes: int


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """List values as a matrix; missing components count as 0."""
    out = np.zeros((len(column), width))
    for i, row in enumerate(column.to_pylist()):
        out[i, : len(row)] = [x or 0.0 for x in row[:width]]
    return out


def fit_centroids(sample: np.ndarray, lists: int) -> np.ndarray:
    """Spherical k-means in numpy; a centroid without vectors stays where it is."""
    rng = np.random.default_rng(SEED)
    centroids = sample[rng.choice(len(sample), lists, replace=False)]
    for _ in range(ROUNDS):
        near = (sample @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, sample)
        held = np.bincount(near, minlength=lists) > 0
        centroids = np.where(held[:, None], _unit(sums), centroids)
    return centroids


def probes_needed(sample: np.ndarray, centroids: np.ndarray, k: int = 5) -> int:
    """How many lists hold ``REACHED`` of the ``k`` nearest others of vectors of the sample."""
    some = sample[np.linspace(0, len(sample) - 1, min(ASKED, len(sample))).astype(int)]
    at = (sample @ centroids.T).argmax(axis=1)
    visited = np.argsort(np.argsort(-(some @ centroids.T), axis=1), axis=1)  # the turn at which a list is visited
    nearest = np.argsort(-(some @ sample.T), axis=1)[:, 1 : k + 1]
    turns = np.take_along_axis(visited, at[nearest], axis=1).ravel()
    return int(np.quantile(turns, REACHED, method="higher")) + 1 if turns.size else 1


def build_dense_index(vectors: DataFrame, key: str, vector: str, lists: int | None = None, path: str | None = None) -> DenseIndex:
    """Index every row whose vector is not null below ``path``, by default a new folder in the shared scratch folder.

    The sample is chosen by the hash of the id. There are about as many lists as the square root of the rows.
    """
    spark = vectors.sparkSession
    path = path or scratch_dir(spark, "dense")
    rows = vectors.select(F.col(key).alias("doc_id"), F.col(vector).cast("array<double>").alias("v")).where("v IS NOT NULL")
    n, width = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    share = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 40)) < int((1 << 40) * min(1.0, 2 * SAMPLE / max(n, 1)))
    some = rows.where(F.lit(True) if n <= SAMPLE else share).select("v").limit(SAMPLE).toArrow()["v"].combine_chunks()
    sample = _unit(_matrix(some, width))
    lists = max(1, min(lists or math.isqrt(n), MAX_LISTS, len(sample)))
    centroids = fit_centroids(sample, lists) if len(sample) else np.zeros((1, width))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = (_unit(_matrix(b.column(1), width)) @ centroids.T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *b.columns], names=["list", "doc_id", "v"])

    kinds = T.StructType([T.StructField("list", T.IntegerType()), *rows.schema.fields])
    rows.mapInArrow(near, kinds).write.parquet(f"{path}/vectors")
    put = spark.read.schema(kinds).parquet(f"{path}/vectors")
    parts = put.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))
    parts.write.parquet(f"{path}/parts")
    parts = spark.read.schema(parts.schema).parquet(f"{path}/parts")
    part = F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int")
    cut = put.join(F.broadcast(parts), "list").select("list", part.alias("part"), "doc_id", "v")  # at most MAX_LISTS rows
    return DenseIndex(cut, parts, centroids, probes_needed(sample, centroids) if len(sample) else 1)


def search_dense(index: DenseIndex, queries: DataFrame, key: str, vector: str, k: int = 5, probes: int | None = None) -> DataFrame:
    """``query_id, doc_id, score, rank``: the ``k`` nearest vectors by cosine among those in the lists probed.

    Scores are exact; ties go to the smaller id. Null query vectors have no answers.
    """
    centroids = index.centroids
    width = centroids.shape[1]
    visits = min(len(centroids), probes or index.probes)
    asked = queries.select(F.col(key).alias("query_id"), F.col(vector).cast("array<double>").alias("v")).where("v IS NOT NULL")

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = _unit(_matrix(b.column(1), width)) @ centroids.T
            at = np.argpartition(-score, visits - 1, axis=1)[:, :visits]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(at.astype(np.int32)), pa.list_(pa.int32()))], names=["query_id", "v", "lists"])

    kinds = T.StructType([*asked.schema.fields, T.StructField("lists", T.ArrayType(T.IntegerType()))])
    sent = asked.mapInArrow(nearest, kinds).withColumn("list", F.explode("lists")).join(F.broadcast(index.parts), "list")
    sent = sent.select("list", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "query_id", "v")
    id_kind, query_kind = index.rows.schema["doc_id"].dataType, asked.schema["query_id"].dataType
    both = index.rows.select("list", "part", "doc_id", F.lit(None).cast(query_kind).alias("query_id"), "v", F.lit(False).alias("asks"))
    both = both.unionByName(sent.withColumn("doc_id", F.lit(None).cast(id_kind)).withColumn("asks", F.lit(True)))

    def score(t: pa.Table) -> pa.Table:
        asks = t["asks"].to_numpy(zero_copy_only=False)
        at, q = np.flatnonzero(~asks), np.flatnonzero(asks)
        rows, cols, points = [], [], []
        if len(at) and len(q):
            unit = _unit(_matrix(t["v"].combine_chunks(), width))
            for start in range(0, len(q), 256):
                block = q[start : start + 256]
                s = np.round(unit[block] @ unit[at].T, 9)
                least = np.partition(s, max(0, len(at) - k), axis=1)[:, max(0, len(at) - k)]
                i, j = np.nonzero(s >= least[:, None])  # ties at the edge are ranked later
                rows.append(block[i])
                cols.append(at[j])
                points.append(s[i, j])
        i, j, s = (np.concatenate([*x, np.zeros(0, kind)]) for x, kind in ((rows, int), (cols, int), (points, float)))
        return pa.table([t["query_id"].take(pa.array(i)), t["doc_id"].take(pa.array(j)), pa.array(s)], ["query_id", "doc_id", "score"])

    out = T.StructType([T.StructField("query_id", query_kind), T.StructField("doc_id", id_kind), T.StructField("score", T.DoubleType())])
    hits = both.groupBy("list", "part").applyInArrow(score, out)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: ``n_exact`` hits, ``n_found`` of them also in ``found``, and their ``recall``."""
    both = exact.select("query_id", "doc_id").join(found.select("query_id", "doc_id", F.lit(1).alias("hit")), ["query_id", "doc_id"], "left")
    return both.agg(F.count(F.lit(1)).alias("n_exact"), F.count("hit").alias("n_found")).withColumn(
        "recall", F.try_divide(F.col("n_found"), F.col("n_exact"))
    )
