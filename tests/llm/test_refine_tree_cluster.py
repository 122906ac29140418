"""Exact duplicates, the Merkle manifest and centroid clustering against brute force, and their edge cases."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import centroids, exact_dedup, merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# exact duplicates


def copies(spark, rows, **kw):
    docs = spark.createDataFrame(rows, "doc_id long, text string, KEPT string, extra string")
    return exact_dedup.group_copies(docs, **kw)


def test_copies_equal_plain_grouping(spark):
    rng = random.Random(5)
    head = "h" * 100
    texts = ["", None, "a", "b", "ab", "ba", head + "x", head + "y", "é" * 50, "e" * 100, "long " * 200_000, "Long " * 200_000]
    rows = [(i, rng.choice(texts), "own", str(i)) for i in range(300)]
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[t or ""].append(i)
    got = copies(spark, rows).collect()
    assert len(got) == 300 and set(got[0].asDict()) == {"doc_id", "text", "extra", "keep_id", "group_size", "kept"}
    for r in got:
        mine = groups[r["text"] or ""]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (max(mine), len(mine), r["doc_id"] == max(mine))
    narrow = copies(spark, rows, keep_text=False)
    assert "text" not in narrow.columns and narrow.filter("kept").count() == len(groups)


def test_one_row_stays_of_repeated_and_null_ids(spark):
    rows = [(1, "t", "o", "a")] * 3 + [(None, "t", "o", "a"), (None, "u", "o", "b"), (None, "u", "o", "c"), (None, "alone", "o", "d")]
    got = copies(spark, rows).collect()
    by = defaultdict(list)
    for r in got:
        by[r["text"]].append(r)
    assert [(r["keep_id"], r["group_size"]) for r in by["t"]] == [(1, 4)] * 4 and sum(r["kept"] for r in by["t"]) == 1
    assert [r["kept"] for r in by["t"] if r["doc_id"] is None] == [False]
    assert sum(r["kept"] for r in by["u"]) == 1 and by["alone"][0]["kept"] and by["alone"][0]["group_size"] == 1


def test_documents_that_stay_keep_their_columns(spark):
    rows = [(2, "t", "own", "a"), (9, "t", "mine", "b"), (3, "u", None, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, KEPT string, extra string")
    out = exact_dedup.distinct_documents(docs)
    assert out.columns == docs.columns and sorted(map(tuple, out.collect())) == sorted([rows[1], rows[2]])
    assert exact_dedup.distinct_documents(docs.limit(0)).count() == 0


def test_only_shared_heads_are_read_whole(spark):
    docs = spark.createDataFrame([(i, f"text {i:04}") for i in range(64)] + [(99, "text 0007")], "doc_id long, text string")
    heads = docs.select(F.octet_length("text").alias("_q_len"), F.xxhash64(F.substring("text", 1, 64)).alias("_q_head"))
    words = exact_dedup.shared_slots(heads.groupBy("_q_len", "_q_head").agg(F.count("*").alias("n"))).collect()
    assert sum(bin(r["_q_bits"] & (2**64 - 1)).count("1") for r in words) == 1


def test_copies_by_many_groups_use_the_shuffle(spark, monkeypatch):
    from quern.llm import common

    monkeypatch.setattr(common, "MAX_BROADCAST_ROWS", 3)
    rows = [(i, f"t{i % 20}", "o", "x") for i in range(100)] + [(1000 + i, "hot", "o", "x") for i in range(3000)]
    got = Counter((r["keep_id"], r["group_size"]) for r in copies(spark, rows, keep_text=False).collect())
    assert got == Counter({**{(80 + i, 5): 5 for i in range(20)}, (3999, 3000): 3000})


def test_copies_run_without_python(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "a")], "doc_id long, text string")
    plan = exact_dedup.group_copies(docs)._jdf.queryExecution().toString()
    assert "Arrow" not in plan and "Python" not in plan


# Merkle manifest


def climb(nodes):
    """Levels of a tree over ``nodes``."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha(*below[i : i + merkle.FAN]) for i in range(0, len(below), merkle.FAN)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        first = i - i % merkle.FAN
        run = level[first : first + merkle.FAN]
        out.append(("".join(run[: i - first]), "".join(run[i - first + 1 :])))
        i //= merkle.FAN
    return out


def brute(rows):
    """(lang, leaf) to a list of (subroot, root, path), of rows (doc_id, lang, leaf)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: climb([r[2] for r in sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, r[2]))]) for g in names}
    above = climb([trees[g][-1][0] for g in names])
    out = Counter()
    for j, g in enumerate(names):
        for i, leaf in enumerate(trees[g][0]):
            path = siblings(trees[g], i) + siblings(above, j)
            out[g, leaf, trees[g][-1][0], above[-1][0], tuple(path)] += 1
    return out


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 2, None: 1}, {"en": 333, "fr": 17, "": 16, "z": 1, None: 3}, {str(i): 1 + i % 3 for i in range(35)}])
def test_manifest_equals_brute_force(spark, sizes):
    rng = random.Random(len(sizes))
    rows = []
    for g, n in sizes.items():
        rows += [(rng.choice([None, rng.randrange(-50, 50), rng.randrange(2**60, 2**60 + 9)]), g, sha(g or "", str(rng.randrange(200)))) for _ in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, leaf string")
    got = merkle.manifest(df, "lang", "doc_id", "leaf")
    want = brute(rows)
    assert Counter((r["lang"], r["leaf"], r["subroot"], r["root"], tuple(map(tuple, r["path"]))) for r in got.collect()) == want
    checks = got.select((merkle.fold(F.col("leaf"), F.col("path")) == F.col("root")).alias("ok"), (merkle.fold(F.lit(sha("x")), F.col("path")) == F.col("root")).alias("bad"))
    assert {tuple(r) for r in checks.collect()} == {(True, False)}


def test_manifest_of_repeated_rows_and_clashing_names(spark):
    rows = [(7, "en", sha("a"), "r", 1)] * 200 + [(7, "en", sha("b"), "s", 2), (None, "en", sha("c"), None, 3)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, leaf string, ROOT string, extra int")
    got = merkle.manifest(df, "lang", "doc_id", "leaf")
    assert got.columns == ["doc_id", "lang", "leaf", "extra", "subroot", "root", "path"]
    out = got.collect()
    assert Counter(r["extra"] for r in out) == Counter({1: 200, 2: 1, 3: 1})
    assert Counter((r["lang"], r["leaf"], r["subroot"], r["root"], tuple(map(tuple, r["path"]))) for r in out) == brute([r[:3] for r in rows])
    assert merkle.manifest(df.limit(0), "lang", "doc_id", "leaf").count() == 0


def test_leaves_tell_nulls_and_lengths_apart(spark):
    row = (3, "é" * 100_000, None, "", None)
    df = spark.createDataFrame([row], DOCS)
    leaf = df.select(merkle.leaf_of(*(F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")))).first()[0]
    assert leaf == sha("1:3", "0:", "-", "-", "200000:" + "é" * 100_000)


# centroid clustering


def test_orchard_equals_brute_force():
    rng = np.random.default_rng(3)
    for spread in (2, 50, 1000):  # small spreads give ties
        centres = rng.integers(-spread, spread, (8, centroids.DIMS))
        centres[5] = centres[2]  # equal centroids
        near = centres[rng.integers(0, 8, 3000)] + rng.integers(-1 - spread // 9, 2 + spread // 9, (3000, centroids.DIMS))
        vectors = np.concatenate([near, centres, rng.integers(-spread, spread, (500, centroids.DIMS))])
        at, d, computed = centroids.orchard(vectors, centres, *centroids.neighbour_lists(centres))
        all_d = ((vectors[:, None, :] - centres[None]) ** 2).sum(axis=2)
        assert (d == all_d.min(axis=1)).all() and (at == all_d.argmin(axis=1)).all()
        assert computed <= all_d.size
    close = centres[np.arange(4000) % 8] + rng.integers(-2, 3, (4000, centroids.DIMS))
    *_, computed = centroids.orchard(close, centres, *centroids.neighbour_lists(centres))
    assert computed < 0.8 * 4000 * 8  # lists end early


def plain_clusters(rows):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    first = sorted(kept, key=lambda r: (sha(f"3:{'' if r[0] is None else r[0]}"), r[1]))[:8]
    centres = [v for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centres))

    for _ in range(10):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        centres = [[sum(x) // len(groups[k]) for x in zip(*groups[k], strict=True)] if groups[k] else c for k, c in enumerate(centres)]
    out = [(i, *nearest(v)[::-1]) for i, v in kept]
    part = Counter()
    for _, k, d in out:
        part[k] += d
    return Counter((i, k, d, part[k], sum(part.values()), sha(",".join(map(str, centres[k])))) for i, k, d in out)


@pytest.mark.parametrize("n", [1, 5, 120])
def test_clusters_equal_brute_force(spark, n):
    rng = random.Random(n)
    rows = [(i, [rng.gauss(i % 3, 1) for _ in range(64)]) for i in range(n)]
    rows += [rows[0], (None, [0.5] * 64), (None, [0.25] * 64), (7, rows[0][1])]
    bad = [(1001, None), (1002, [1.0] * 63), (1003, [None] + [1.0] * 63), (1004, [float("nan")] * 64), (1005, [float("-inf")] + [0.0] * 63), (1006, [1e30] * 64), (1007, [])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").withColumn("cluster", F.lit("own"))
    got = Counter(tuple(r) for r in centroids.cluster_vectors(df).collect())
    assert got == plain_clusters(rows)


def test_no_vectors_give_no_clusters(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, None)], "vec_id long, embedding array<float>")
    out = centroids.cluster_vectors(df)
    assert out.count() == 0 and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
