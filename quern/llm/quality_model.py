"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network with a temperature."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import chosen_share, map_rows, replaced, written

#: Buckets of words, and as many of word shapes; components of a vector; non-zero ones of an index vector.
BUCKETS, WIDTH, SPARSE = 4096, 64, 2
WINDOW = 2
#: The network is fitted on at most this many labelled documents; everything else covers all documents.
MAX_LABELLED = 6000
HIDDEN, EPOCHS, BATCH, RATE = 24, 30, 128, 3e-3
CALIBRATION_SHARE = 0.2
SEED = 42
LEAST_SCORE = 0.3
REMEMBERED = 300_000
SHAPES = ((re.compile(rb"[a-z\x80-\xff]+"), b"a"), (re.compile(rb"[A-Z]+"), b"A"), (re.compile(rb"[0-9]+"), b"0"), (re.compile(rb"(.)\1+"), rb"\1\1"))


def shape_of(word: bytes) -> bytes:
    """Runs of lower-case and other letters, capitals and digits as one sign each; other signs stay, twice at most."""
    for pattern, sign in SHAPES:
        word = pattern.sub(sign, word)
    return word


class Units(dict):
    """Word -> bucket of the word and, behind all word buckets, that of its shape."""

    def __missing__(self, word: bytes) -> int:
        a = xxhash.xxh64_intdigest(word.lower(), SEED) % BUCKETS
        b = xxhash.xxh64_intdigest(shape_of(word), SEED) % BUCKETS
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = got = a << 32 | b
        return got


def units_of(text: str | None, units: Units) -> np.ndarray:
    """Two rows: the words' buckets and their shapes'."""
    words = text.encode().split() if text else []
    packed = np.fromiter(map(units.__getitem__, words), np.int64, len(words))
    return np.stack((packed >> 32, (packed & 0xFFFFFFFF) + BUCKETS))


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """The sparse index vector of each bucket: positions of its non-zero components, and their signs."""
    rng = np.random.default_rng(SEED)
    return rng.integers(0, WIDTH, (2 * BUCKETS, SPARSE)), rng.choice(np.array([-1, 1]), (2 * BUCKETS, SPARSE))


def context_sums(docs: DataFrame) -> np.ndarray:
    """The context vector of every bucket over all documents: the sum of the index vectors of the words around it.

    Each task adds up its own table; tables, of fixed size, are summed in a shuffle by bucket.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sign = index_vectors()
        table = np.zeros(2 * BUCKETS * WIDTH, np.int64)
        units = Units()
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                for kind in context_entries([units_of(t, units) for t in whole.column(0).slice(start, 256).to_pylist()], at, sign):
                    table += kind
        table = table.reshape(2 * BUCKETS, WIDTH)
        used = np.flatnonzero(table.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(list(table[used]), pa.list_(pa.int64()))], ["unit", "v"])

    parts = docs.select("text").mapInArrow(run, "unit long, v array<long>")
    sums = parts.groupBy("unit").agg(*(F.sum(F.col("v")[i]).alias(f"v{i}") for i in range(WIDTH))).toPandas()
    out = np.zeros((2 * BUCKETS, WIDTH))
    out[sums["unit"].to_numpy(np.int64)] = sums.drop(columns="unit").to_numpy(np.float64)
    return out


def context_entries(rows: list[np.ndarray], at: np.ndarray, sign: np.ndarray) -> Iterator[np.ndarray]:
    gap = np.full((2, WINDOW), -1)
    line = np.concatenate([x for r in rows for x in (r, gap)] or [gap], axis=1)
    for kind in (0, 1):
        t = line[kind]
        for step in range(1, WINDOW + 1):
            a, b = t[:-step], t[step:]
            ok = (a >= 0) & (b >= 0)
            a, b = a[ok], b[ok]
            for x, y in ((a, b), (b, a)):
                flat = (x * WIDTH)[:, None] + at[y]
                yield np.bincount(flat.ravel(), weights=sign[y].ravel(), minlength=2 * BUCKETS * WIDTH).astype(np.int64)


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """Unit-length context vectors; a bucket without contexts has its index vector."""
    at, sign = index_vectors()
    index = np.zeros((2 * BUCKETS, WIDTH))
    np.add.at(index, (np.arange(2 * BUCKETS)[:, None], at), sign)
    damped = np.sign(sums) * np.sqrt(np.abs(sums))
    size = np.linalg.norm(damped, axis=1, keepdims=True)
    out = np.where(size > 0, damped / np.maximum(size, 1e-9), index / np.maximum(np.linalg.norm(index, axis=1, keepdims=True), 1e-9))
    return out.astype(np.float32)


N_FEATURES = 4 * WIDTH + 3


def pooled(text: str | None, vectors: np.ndarray, units: Units) -> np.ndarray:
    """Mean and spread of a document's word and shape vectors, how alike neighbours are, and the logarithm of its length."""
    u = units_of(text, units)
    n = u.shape[1]
    out = np.zeros(N_FEATURES, np.float32)
    if not n:
        return out
    for k in (0, 1):
        v = vectors[u[k]]
        mean = v.mean(axis=0)
        out[2 * k * WIDTH : (2 * k + 1) * WIDTH] = mean
        out[(2 * k + 1) * WIDTH : (2 * k + 2) * WIDTH] = np.sqrt(np.maximum(np.einsum("ij,ij->j", v, v) / n - mean * mean, 0))
        out[4 * WIDTH + k] = np.mean(u[k, 1:] == u[k, :-1]) if n > 1 else 0
    out[-1] = np.log1p(n)
    return out


class Network:
    """tanh layer and logit, trained by Adam on the log loss; then one temperature on rows kept aside for it."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.mean = x.mean(axis=0) if len(x) else np.zeros(N_FEATURES)
        self.scale = np.maximum(x.std(axis=0), 1e-4) if len(x) else np.ones(N_FEATURES)
        self.temperature = 1.0
        self.prior = (y.sum() + 1) / (len(y) + 2)
        self.constant = len(np.unique(y)) < 2
        if self.constant:
            return
        z = self.inputs(x)
        aside = np.arange(len(z)) % round(1 / CALIBRATION_SHARE) == 0
        fit = ~aside if len(np.unique(y[~aside])) == 2 else np.ones(len(y), bool)
        d = z.shape[1]
        self.p = [rng.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
        m, v, t = [np.zeros_like(a) for a in self.p], [np.zeros_like(a) for a in self.p], 0
        zt, yt = z[fit], y[fit]
        for _ in range(EPOCHS):
            order = rng.permutation(len(zt))
            for at in range(0, len(order), BATCH):
                t += 1
                for k, g in enumerate(self.gradients(zt[order[at : at + BATCH]], yt[order[at : at + BATCH]])):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] = self.p[k] - RATE * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
        logits, said = self.logits(z[aside]), y[aside]
        if len(said):
            grid = np.geomspace(0.25, 8, 61)
            loss = [np.mean(np.logaddexp(0, -np.where(said == 1, 1, -1) * logits / g)) for g in grid]
            self.temperature = float(grid[int(np.argmin(loss))])

    def inputs(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def logits(self, z: np.ndarray) -> np.ndarray:
        return np.tanh(z @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3][0]

    def gradients(self, z: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        h = np.tanh(z @ self.p[0] + self.p[1])
        d = (1 / (1 + np.exp(-(h @ self.p[2] + self.p[3][0]))) - y) / len(y)
        dh = d[:, None] * self.p[2] * (1 - h * h)
        return [z.T @ dh + 1e-4 * self.p[0], dh.sum(axis=0), h.T @ d, d.sum(keepdims=True)]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.logits(self.inputs(x)) / self.temperature, -30, 30)))


def held_out(folds: int, fold: int):
    """Whether a document's id falls into the fold that nothing is learned from; ids that are null do."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(True))


def labelled_features(docs: DataFrame, labels: DataFrame, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled vectors and labels of at most ``MAX_LABELLED`` labelled documents, chosen by the hash of their id."""
    known = labels.filter(F.col("quality").isin(0, 1) & ~held_out(5, 0)).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    known = written(known, "known-labels")
    few = known.filter(chosen_share(known.count(), MAX_LABELLED, "doc_id"))
    some = few.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    rows = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").groupBy("doc_id", "quality").agg(F.max("text").alias("text"))

    def make():
        units = Units()
        return lambda text: (pooled(text, vectors, units).tolist(),)

    got = map_rows(rows, ["text"], "features array<float>", make).select("doc_id", "quality", "features").toPandas().sort_values("doc_id")
    order = np.argsort([xxhash.xxh64_intdigest(str(i), SEED) for i in got["doc_id"]], kind="stable")
    x = np.array(got["features"].tolist(), np.float64).reshape(-1, N_FEATURES)
    return x[order], got["quality"].to_numpy(np.float64)[order]


def fit_quality(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, Network]:
    vectors = word_vectors(context_sums(docs))
    return vectors, Network(*labelled_features(docs, labels, vectors))


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Add ``held_out, score, predicted`` to every document.

    Word vectors come from the contexts in all documents; the network from the labels (0 or 1; others are ignored, of
    repeated ids the largest counts) of documents outside the held-out fold. A score depends on the text alone; null and
    empty texts are scored as documents of no words, equal rows alike; without labels of both kinds every score is the
    smoothed share of ones. An empty table stays empty. Columns read: ``doc_id, text``; of labels ``doc_id, quality``.
    """
    vectors, network = fit_quality(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast((vectors, network))  # a fixed size, some megabytes

    def make():
        vectors, network = shared.value
        units = Units()

        def rows(texts):
            scores = network.score(np.stack([pooled(t, vectors, units) for t in texts]))
            return scores.tolist(), [int(s >= LEAST_SCORE) for s in scores.tolist()]

        return rows

    out = map_rows(replaced(docs, ["held_out"]), ["text"], "score double, predicted int", make, batch=True)
    return out.withColumn("held_out", held_out(5, 0))
