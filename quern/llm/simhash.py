"""SimHash near-duplicates by covering locality-sensitive hashing: no pair within the radius is missed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import MAX_BROADCAST_ROWS, components, key_of, lookup_join, map_rows, written

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Buckets with more fingerprints are cut into blocks, compared block against block.
MAX_BUCKET = 4096
BLOCK = 1024
MASK64 = (1 << 64) - 1
BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)
OCTET_BITS = np.arange(256)[:, None] >> np.arange(8) & 1


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text as a signed integer; 0 for texts without words."""
    words = text.encode().lower().split() if text else []  # lowers A-Z, splits at exactly \x20 and \x09-\x0D
    if not words:
        return 0
    if len(words) <= shingle:
        bits = xxhash.xxh64_intdigest(b" ".join(words), SEED)
        return bits - (1 << 64) if bits >> 63 else bits
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    n = len(words) - shingle + 1
    spans = zip(starts[:n].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in spans), np.uint64, n)
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(octets[:, k], minlength=256) @ OCTET_BITS for k in range(8)])
    return int(np.bitwise_or.reduce(BITS[ones * 2 > n], initial=np.uint64(0)).astype(np.int64))


def covering_masks(radius: int, bits: int = 64) -> list[int]:
    """``2^(radius+1) - 1`` masks such that any ``radius`` bit positions are all outside one of them.

    Each position gets a non-zero vector of ``radius + 1`` bits, and the mask of a non-zero vector v holds the positions
    whose vectors have odd product with v. Up to ``radius`` vectors leave some v orthogonal to all of them: two
    fingerprints that differ there only agree on all of v's mask.
    """
    size = 1 << (radius + 1)
    vector = [i % (size - 1) + 1 for i in range(bits)]
    masks = []
    for v in range(1, size):
        mask = sum(1 << i for i in range(bits) if (vector[i] & v).bit_count() % 2)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def spanning_links(prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among fingerprints: the pairs within ``radius`` connect the same sets."""
    links, left = [], np.unique(prints)
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            x = front.pop()
            near = np.bitwise_count((left ^ x).view(np.uint64)) <= radius
            found = left[near]
            if len(found):
                links += [(int(x), int(y)) for y in found]
                front += list(found)
                left = left[~near]
    return links


def bucket_links(rows: DataFrame, radius: int) -> DataFrame:
    """``a, b``: per bucket of (bucket keys…, fp) a spanning forest of its links. Every bucket must fit a task."""
    keys = [c for c in rows.columns if c != "fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for b in batches:
            cols = [b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in (*keys, "fp")]
            if held:
                cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
            n = len(cols[0])
            if not n:
                continue
            new = np.zeros(n, bool)
            for c in cols[:-1]:
                new[1:] |= c[1:] != c[:-1]
            starts = np.concatenate(([0], np.flatnonzero(new)))
            yield links_of(cols[-1], starts)
            held = [c[starts[-1] :] for c in cols]  # the last bucket may go on
        if held:
            yield links_of(held[-1], np.array([0, len(held[-1])]))

    def links_of(prints: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
        out = []
        for i in np.flatnonzero(np.diff(starts) > 1):
            part = prints[starts[i] : starts[i + 1]]
            if len(part) == 2:
                if part[0] != part[1] and ((int(part[0]) ^ int(part[1])) & MASK64).bit_count() <= radius:
                    out.append((int(part[0]), int(part[1])))
            else:
                out += spanning_links(part, radius)
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")


def near_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``a, b``: links among the distinct fingerprints ``fp`` that connect exactly those within ``radius`` bits.

    Each fingerprint goes to one bucket per covering mask. Only spanning forests leave a bucket, never all its pairs.
    Buckets are counted first: those above ``MAX_BUCKET`` are cut into blocks, and each pair of blocks is a task's work.
    """
    masked = [F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(m))) for k, m in enumerate(covering_masks(radius))]
    put = prints.select("fp", F.explode(F.array(*masked)).alias("bucket"))
    large = written(put.groupBy("bucket").agg(F.count("*").alias("n")).filter(F.col("n") > MAX_BUCKET), "large-buckets")
    n_large = large.count()
    if not n_large:
        return bucket_links(put.select("bucket", "fp"), radius)
    small_side = F.broadcast(large) if n_large <= MAX_BROADCAST_ROWS else large
    few = put.join(small_side, "bucket", "left_anti").select("bucket", "fp")
    many = put.join(small_side, "bucket")
    blocks = F.ceil(F.col("n") / BLOCK).cast("long")
    many = many.withColumn("_b", F.pmod(F.xxhash64("fp", "bucket"), blocks))
    many = many.withColumn("_o", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    many = many.select("bucket", F.least("_b", "_o").alias("i"), F.greatest("_b", "_o").alias("j"), "fp")
    return bucket_links(few, radius).unionByName(bucket_links(many, radius))


def with_fingerprint(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Add ``_q_fp``, the fingerprint as a signed long."""
    return map_rows(docs, ["text"], "_q_fp long", lambda: lambda t: (fingerprint(t, shingle),))


def fingerprint_roots(printed: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``_q_fp, root`` for the fingerprints that have a near one, root naming their connected component."""
    prints = written(printed.select(F.col("_q_fp").alias("fp")).distinct(), "prints")
    roots = components(near_links(prints, radius), printed.sparkSession)
    return roots.withColumnRenamed("node", "_q_fp")


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, keep_text: bool = True) -> DataFrame:
    """Add ``fingerprint`` (16 hexadecimal digits) and ``component_id`` to every document.

    Documents are linked when their fingerprints differ in at most ``radius`` bits; ``component_id`` is the smallest
    ``doc_id`` that links reach. Texts without words (null and empty ones too) have fingerprint zero and are linked
    like any other. Rows with a null ``doc_id`` take part and never name a component that has another id (a component
    of null ids alone has a null one). Equal rows are rows of one component. An empty table stays empty. Work beyond
    the texts is on distinct fingerprints, so copies cost nothing. Without ``keep_text`` texts are neither written nor
    returned. Columns read: ``doc_id, text``.
    """
    base = docs.drop("fingerprint", "component_id")
    printed = with_fingerprint(base, shingle)
    printed = written(printed if keep_text else printed.drop("text"), "fingerprints")
    least = written(printed.groupBy("_q_fp").agg(F.min("doc_id").alias("_q_least")), "least-ids")
    roots = written(fingerprint_roots(printed, radius), "roots")
    named = least.join(roots, "_q_fp", "left").withColumn("root", F.coalesce("root", "_q_fp"))
    names = named.groupBy("root").agg(F.min("_q_least").alias("component_id"))
    ids = written(named.join(names, "root").select("_q_fp", "component_id"), "component-ids")
    out = lookup_join(printed, ids, ["_q_fp"])
    return out.withColumn("fingerprint", F.lower(F.lpad(F.hex("_q_fp"), 16, "0"))).drop("_q_fp")


def first_of_groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each component: a row of its smallest ``doc_id``.

    Only ids and fingerprints meet in the grouping; texts are shuffled once, after exact repeats of an id and
    fingerprint are dropped inside their tasks. Rows of a component whose ids are all null give one row.
    """
    printed = written(with_fingerprint(docs, shingle), "fingerprints")
    roots = written(fingerprint_roots(printed, radius), "roots")
    printed = printed.withColumn("_q_id", key_of("doc_id"))
    first_id = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_q_id"))
    least = printed.groupBy("_q_fp").agg(first_id.alias("_q_least"))
    named = least.join(roots, "_q_fp", "left").withColumn("root", F.coalesce("root", "_q_fp"))
    first = named.groupBy("root").agg(F.min(F.struct("_q_least", "_q_fp")).alias("k"))
    keep = first.select(F.col("k._q_least._q_id").alias("_q_id"), F.col("k._q_fp").alias("_q_fp"))
    return printed.dropDuplicates(["_q_id", "_q_fp"]).join(keep, ["_q_id", "_q_fp"], "left_semi").select(*docs.columns)
