"""Exact top-k by inner product: the threshold algorithm over sorted lists, one list per dimension."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALE = 256
EVERY = 50
K = 5
#: Vectors and queries that meet in one task.
BLOCK_VECTORS = 8192
BLOCK_QUERIES = 1024
FIRST_DEPTH = 16


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, v, copies``: floor(scale * x) of each component; equal rows together.

    Rows whose id or vector is null, or whose vector holds a null or non-finite component, take no part; nor do vectors
    with a scaled component of ``2**31`` divided by the root of their length, or more, so that every score fits 64 bits.
    """
    x = F.col("embedding").cast("array<double>")
    most = F.lit(float(1 << 31)) / F.sqrt(F.greatest(F.size("embedding"), F.lit(1)))
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) * scale >= most))
    good = vectors.filter(F.col("vec_id").isNotNull() & ~F.coalesce(odd, F.lit(True)))
    v = F.transform(x, lambda c: F.floor(c * scale).cast("long"))
    return good.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).groupBy("vec_id", "v").agg(F.count("*").alias("copies"))


def matrix(rows: list[list[int]], width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def exact_kind(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The smallest number type in which no sum of products rounds."""
    largest = max(1, int(np.abs(v).max(initial=0))) * max(1, int(np.abs(q).max(initial=0))) * max(1, v.shape[1])
    return np.dtype("f4" if largest < 1 << 24 else "f8" if largest < 1 << 53 else "i8" if largest < 1 << 63 else object)


def threshold_search(
    ids: np.ndarray, v: np.ndarray, copies: np.ndarray, qids: np.ndarray, q: np.ndarray, k: int = K
) -> list[tuple[int, int, int]]:
    """``(query, vec_id, score)`` of each query's best ``k`` rows of a block, its own id left out.

    Each dimension's list is read from its best end for the query, in steps of doubling depth; ids not met before are
    scored whole. What has not been met scores at most the sum of what the lists now show, so reading stops as soon as
    the k-th score is above that sum (not merely equal, as an equal score with a smaller id would still win).
    """
    kind = exact_kind(v, q)
    by_id = np.argsort(ids, kind="stable")
    ids, v, copies = ids[by_id], v[by_id].astype(kind), copies[by_id]
    lists = np.argsort(v, axis=0, kind="stable").astype(np.int32)
    values = np.take_along_axis(v, lists, axis=0)
    n, out = len(ids), []
    for qid, row in zip(qids.tolist(), q.astype(kind), strict=True):
        up, down = np.flatnonzero(row > 0), np.flatnonzero(row < 0)
        met = np.zeros(n, bool)
        best_at, best = np.zeros(0, np.int64), np.zeros(0, kind)
        read, depth = 0, min(n, FIRST_DEPTH)
        while True:
            now = np.zeros(n, bool)
            now[lists[n - depth : n - read][:, up]] = True
            now[lists[read:depth][:, down]] = True
            if depth == n:
                now[:] = True  # a query of zeros has no lists to read
            new = np.flatnonzero(now & ~met)
            met[new] = True
            new = new[ids[new] != qid]
            score = v[new] @ row
            if len(best) >= k and len(new):
                fit = score >= best[-1]
                new, score = new[fit], score[fit]
            at, score = np.concatenate((best_at, new)), np.concatenate((best, score))
            keep = np.lexsort((at, -score))[:k]  # positions follow ids, so ties go to the smaller id
            best_at, best = at[keep], score[keep]
            if depth == n:
                break
            if copies[best_at].sum() >= k:
                last = best[np.searchsorted(np.cumsum(copies[best_at]), k)]
                if last > row[up] @ values[n - depth, up] + row[down] @ values[depth - 1, down]:
                    break
            read, depth = depth, min(n, depth * 2)
        for i, s in zip(best_at.tolist(), best.tolist(), strict=True):
            out += [(qid, int(ids[i]), int(s))] * min(k, int(copies[i]))
    return out


def exact_topk(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` best other rows by integer inner product.

    ``is_query`` chooses the queries by ``vec_id``; candidates are all rows but those of the query's own id. Ties go to
    the smaller ``vec_id``; equal rows count each, a query id that occurs in several rows is asked once per distinct
    vector and its answers are ranked together; shorter vectors count as filled up with zeros; fewer candidates give
    fewer ranks; an empty table or no queries give no rows. Too large components: see :func:`integer_vectors`.

    Vectors are dealt into blocks by hash, queries into blocks of their own, and each pair of blocks is one task's work
    of bounded size that leaves ``k`` rows per query. Columns read: ``vec_id, embedding``.
    """
    rows = integer_vectors(vectors, scale)
    counts = vectors.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    n_blocks = max(1, -(-counts["n"] // BLOCK_VECTORS))
    q_blocks = max(1, -(-counts["q"] // BLOCK_QUERIES))
    spread = F.xxhash64("vec_id", "v")
    all_of = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    cands = rows.select(F.pmod(spread, F.lit(n_blocks)).alias("b"), all_of(q_blocks).alias("qb"), F.lit(False).alias("asks"), "vec_id", "v", "copies")
    asked = rows.filter(is_query).select(all_of(n_blocks).alias("b"), F.pmod(spread, F.lit(q_blocks)).alias("qb"), F.lit(True).alias("asks"), "vec_id", "v", "copies")

    def search(t: pa.Table) -> pa.Table:
        asks = t["asks"].to_numpy()
        ids, copies = t["vec_id"].to_numpy(), t["copies"].to_numpy()
        v = t["v"].to_pylist()
        width = max(map(len, v))
        full = matrix(v, width)
        got = threshold_search(ids[~asks], full[~asks], copies[~asks], ids[asks], full[asks], k) if asks.any() and (~asks).any() else []
        return pa.table([pa.array([x[i] for x in got], pa.int64()) for i in range(3)], ["query_id", "vec_id", "score"])

    found = cands.unionByName(asked).groupBy("b", "qb").applyInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q, v c WHERE q.vec_id % {EVERY} = 0 AND c.vec_id <> q.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}
"""
