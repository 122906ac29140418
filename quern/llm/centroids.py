"""Centroid clustering whose assignments come from Orchard's search.

Vectors are scaled to whole numbers, so that every sum, mean and distance is exact and results do not depend on the
partitioning. For a round the driver sorts, for each centroid, the other centroids by their distance from it (a table of
``k`` times ``k``). A vector starts at some centroid and walks along that centroid's list: a closer one found on the way
becomes the new centre and its list is walked from the front, centroids met before are skipped, and the walk ends where
the next entry lies strictly more than twice as far from the centre as the vector does, because nothing further down can
be as near. All vectors of a batch walk at once in numpy. A task returns one row per centroid and round.

Nulls: a vector that is null, has another length, or holds null or non-finite components takes no part. So does one with
a component of ``LARGEST`` or more in magnitude, as squared distances must fit 64 bits. Of vectors with equal start
hashes (repeated ids, null ids) the one with smaller components starts first; repeated rows are clustered like any
others. Fewer vectors than centroids give fewer centroids, an empty table an empty table. Sums of distances beyond 64
bits are null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.common import written

DIMS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
LARGEST = float(1 << 16)
#: Vectors that walk together.
BATCH = 4096


def neighbour_lists(centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances between centroids, and for each the others in the order of theirs (ties: smaller number)."""
    apart = ((centres[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)
    lists = np.argsort(apart, axis=1, kind="stable")
    others = np.array([[q for q in row if q != c] for c, row in enumerate(lists)], dtype=np.int64)
    return apart, others.reshape(len(centres), -1)


def orchard(vectors: np.ndarray, centres: np.ndarray, apart: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest centroid of each vector (ties: smaller number), its squared distance, and the distances computed."""
    n, k = len(vectors), len(centres)
    at = np.zeros(n, dtype=np.int64)  # the centre whose list is walked
    step = np.zeros(n, dtype=np.int64)
    near = ((vectors - centres[0]) ** 2).sum(axis=1)
    met = np.zeros((n, k), dtype=bool)
    met[:, 0] = True
    computed = n
    walking = np.arange(n)
    while walking.size:
        walking = walking[step[walking] < k - 1]
        c = at[walking]
        q = lists[c, step[walking]] if walking.size else c
        go = apart[c, q] <= 4 * near[walking]
        walking, q = walking[go], q[go]
        step[walking] += 1
        new = ~met[walking, q]
        rows, q = walking[new], q[new]
        met[rows, q] = True
        computed += rows.size
        d = ((vectors[rows] - centres[q]) ** 2).sum(axis=1)
        better = (d < near[rows]) | ((d == near[rows]) & (q < at[rows]))
        rows, q = rows[better], q[better]
        at[rows], near[rows], step[rows] = q, d[better], 0
    return at, near, computed


def whole_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``key, v``: the vectors that take part, their components scaled and rounded down."""
    x = F.transform(vector, lambda c: c.cast("double"))
    fit = F.forall(x, lambda c: F.coalesce(F.abs(c) < LARGEST, F.lit(False)))  # false for null, NaN and infinite ones
    kept = df.filter(F.coalesce((F.size(vector) == DIMS) & fit, F.lit(False)))
    return kept.select(key, F.transform(x, lambda c: F.floor(c * SCALE).cast("int")).alias("v"))


def start_centres(vectors: DataFrame, key: str) -> np.ndarray:
    """The components of the ``CLUSTERS`` vectors with the smallest hashes of their ids."""
    h = F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    rows = vectors.select(h.alias("h"), "v").orderBy("h", "v").limit(CLUSTERS).collect()
    return np.array([r["v"] for r in rows], dtype=np.int64).reshape(len(rows), DIMS)


def _walked(batches: Iterator[pa.RecordBatch], centres: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    apart, lists = neighbour_lists(centres)
    for whole in batches:
        for start in range(0, whole.num_rows, BATCH):
            b = whole.slice(start, BATCH)
            v = b.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(b.num_rows, DIMS)
            at, near, _ = orchard(v, centres, apart, lists)
            yield b, v, at, near


def next_centres(vectors: DataFrame, centres: np.ndarray) -> np.ndarray:
    """One round: every centroid with vectors becomes their mean, rounded down; the others stay."""
    k = len(centres)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k, DIMS), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for _, v, at, _near in _walked(batches, centres):
            for c in range(k):
                mine = at == c
                n[c] += mine.sum()
                total[c] += v[mine].sum(axis=0)
        cells = np.concatenate([n[:, None], total], axis=1)  # dimension 0 is the count
        at = np.indices(cells.shape)
        yield pa.RecordBatch.from_arrays([pa.array(x.ravel()) for x in (at[0], at[1], cells)], names=["cluster", "dim", "s"])

    parts = vectors.select("v").mapInArrow(sums, "cluster long, dim long, s long")
    cells = np.zeros((k, DIMS + 1), dtype=object)
    for r in parts.groupBy("cluster", "dim").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():
        cells[r["cluster"], r["dim"]] = int(r["s"])  # a row per centroid and dimension
    means = [[x // row[0] for x in row[1:]] if row[0] else old for row, old in zip(cells, centres, strict=True)]
    return np.array(means, dtype=np.int64).reshape(k, DIMS)


def assigned(vectors: DataFrame, key: str, centres: np.ndarray) -> DataFrame:
    """``key, cluster, distance`` of every vector."""
    schema = T.StructType([vectors.schema[key], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, _, at, near in _walked(batches, centres):
            cols = [b.column(0), pa.array(at.astype(np.int32)), pa.array(near)]
            yield pa.RecordBatch.from_arrays(cols, names=[key, "cluster", "distance"])

    return vectors.select(key, "v").mapInArrow(nearest, schema)


def centre_digest(centre: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in centre).encode()).hexdigest()


def cluster_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``key, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector that takes part.

    The scaled vectors are written once and read once per round; other columns are not carried.
    """
    spark: SparkSession = df.sparkSession
    vectors = written(whole_vectors(df, key, vector), "vectors")
    centres = start_centres(vectors, key)
    for _ in range(ROUNDS if len(centres) else 0):
        centres = next_centres(vectors, centres)
    placed = assigned(vectors, key, centres) if len(centres) else vectors.select(
        key, F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")
    )
    placed = written(placed, "assigned")
    digests = spark.createDataFrame([(c, centre_digest(x)) for c, x in enumerate(centres)], "cluster int, centroid_sha256 string")

    def total(c: str) -> Column:
        return F.sum(F.col(c).cast("decimal(38,0)"))

    sums = placed.groupBy("cluster").agg(total("distance").alias("part"))  # a row per centroid
    every = sums.agg(total("part").alias("whole"))
    stats = sums.crossJoin(every).join(digests, "cluster").select(
        "cluster", F.expr("try_cast(part AS long)").alias("cluster_inertia"), F.expr("try_cast(whole AS long)").alias("inertia"), "centroid_sha256"
    )
    return placed.join(F.broadcast(stats), "cluster").select(key, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle() -> str:
    """The rounds one after another; sums of whole numbers, so nothing depends on the order of rows."""
    near = f"""SELECT vec_id, any_value(v) AS v, min(d) AS distance, arg_min(cluster, d * {CLUSTERS} + cluster) AS cluster FROM (
    SELECT vec_id, v, cluster, list_sum(list_transform(range(1, {DIMS + 1}), lambda j: (v[j] - w[j]) * (v[j] - w[j])))::BIGINT AS d FROM q, c%d) GROUP BY vec_id"""
    parts = [
        f"""q AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMS})""",
        f"""c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY h) - 1)::INTEGER AS cluster, v AS w FROM (
  SELECT sha256('{SEED}:' || vec_id) AS h, v FROM q ORDER BY h LIMIT {CLUSTERS}))""",
    ]
    for k in range(ROUNDS):
        parts.append(f"a{k} AS MATERIALIZED ({near % k})")
        parts.append(f"""c{k + 1} AS MATERIALIZED (SELECT cluster, coalesce(m, w) AS w FROM c{k} LEFT JOIN (
  SELECT cluster, list(((s - ((s % n) + n) % n) / n)::BIGINT ORDER BY j) AS m FROM (
    SELECT cluster, j, sum(v[j])::BIGINT AS s, count(*) AS n FROM a{k}, unnest(range(1, {DIMS + 1})) AS u(j) GROUP BY cluster, j) GROUP BY cluster) USING (cluster))""")
    parts.append(f"z AS MATERIALIZED ({near % ROUNDS})")
    return f"""WITH {', '.join(parts)}
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(w, ',')) AS centroid_sha256 FROM z JOIN c{ROUNDS} USING (cluster)"""


ORACLE = _oracle()
