"""The two models against plain loops, their training rows, and how archives are dealt to tasks."""

import math
import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from quern.llm import language, quality_model, simhash, topk, warc
from quern.llm.common import map_rows


def plain_states(net, data):
    """Both directions over one text, a byte and a unit at a time."""
    h = net.h
    out = []
    for d, line in ((0, list(data)), (1, list(data)[::-1])):
        x, u = net.p["x"][d].astype(float), net.p["u"][d].astype(float)
        state, states = [0.0] * h, []
        for byte in line:
            s = [sum(state[i] * u[i][j] for i in range(h)) for j in range(3 * h)]
            z = [1 / (1 + math.exp(-(x[byte][j] + s[j]))) for j in range(h)]
            r = [1 / (1 + math.exp(-(x[byte][h + j] + s[h + j]))) for j in range(h)]
            c = [math.tanh(x[byte][2 * h + j] + r[j] * s[2 * h + j]) for j in range(h)]
            state = [z[j] * state[j] + (1 - z[j]) * c[j] for j in range(h)]
            states.append(state)
        out.append(states if d == 0 else states[::-1])
    return out


def plain_probabilities(net, data):
    forward, backward = plain_states(net, data)
    rows = []
    for a, b in zip(forward, backward, strict=True):
        logits = [sum(a[i] * net.p["w"][0][i][k] + b[i] * net.p["w"][1][i][k] for i in range(net.h)) + net.p["b"][k] for k in range(net.classes)]
        e = [math.exp(v - max(logits)) for v in logits]
        rows.append([v / sum(e) for v in e])
    return np.array(rows)


def test_language_network_equals_plain_loops():
    net = language.ByteNetwork(3, hidden=4, seed=5)
    texts = ["short é", "x", "a longer text, of one stretch and " + "more " * 40, "é" * 200]
    got = language.pooled_languages(texts, ["a", "b", "c"], net)
    for text, (lang, score) in zip(texts, got, strict=True):
        raw = text.encode()
        whole = np.zeros(3)
        for at in range(0, len(raw), language.STRETCH):
            lo, hi = max(0, at - language.AROUND), min(len(raw), at + language.STRETCH + language.AROUND)
            prob = plain_probabilities(net, raw[lo:hi])
            whole += prob[at - lo : at - lo + min(language.STRETCH, len(raw) - at)].sum(axis=0)
        assert lang == "abc"[int(whole.argmax())] and abs(score - whole.max() / whole.sum()) < 1e-4


def test_each_byte_is_labelled_once_and_sees_around_the_border():
    rng = random.Random(1)
    texts = [None, "", "a", *("".join(rng.choices("abcé", k=n)) for n in (127, 128, 129, 700))]
    codes, there, labelled, owner = language.stretches(texts)
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        mine = owner == i
        assert codes[mine][labelled[mine]].tobytes() == raw
        for nth, (c, on) in enumerate(zip(codes[mine], there[mine], strict=True)):
            lo = max(0, nth * language.STRETCH - language.AROUND)
            assert c[on].tobytes() == raw[lo : (nth + 1) * language.STRETCH + language.AROUND]


def test_every_language_is_learned(spark):
    alphabet = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîï"
    rows = [(100 * k + i, (alphabet[k] + " ") * 30, f"l{k:02}") for k in range(len(alphabet)) for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    texts, said = language.training_rows(df, F.lit(True))
    assert len(set(said)) == len(alphabet) > 32 and len(texts) == len(rows)


def test_a_long_text_is_learned_from_in_part(spark):
    df = spark.createDataFrame([(1, "x" * 50_000, "a"), (2, "short", "b"), (3, "y" * 2000, "b")], "doc_id long, text string, lang string")
    texts, said = language.training_rows(df, F.lit(True))
    assert sorted(map(len, texts)) == [5, 2000, language.MAX_CHARS] and said == ["a", "b", "b"]


def test_labels_that_cannot_be_used_do_not_shrink_the_training_rows(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"))
    usable = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    rest = spark.range(400, 60_000).select(F.col("id").alias("doc_id"), F.lit(None).cast("int").alias("quality"))
    vectors = quality_model.word_vectors(np.zeros((2 * quality_model.BUCKETS, quality_model.WIDTH)))
    x, y = quality_model.labelled_features(docs, usable.unionByName(rest), vectors)
    mine = usable.filter(~quality_model.held_out(5, 0)).count()
    assert len(x) == len(y) == mine


def test_quality_features_and_network_equal_plain_loops():
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(2 * quality_model.BUCKETS, quality_model.WIDTH)).astype(np.float32)
    text = "One two TWO two, 33 three! " * 3
    got = quality_model.pooled(text, vectors, quality_model.Units())
    words = [w.encode() for w in text.split()]
    kinds = [
        [xxhash.xxh64_intdigest(w.lower(), quality_model.SEED) % quality_model.BUCKETS for w in words],
        [quality_model.BUCKETS + xxhash.xxh64_intdigest(quality_model.shape_of(w), quality_model.SEED) % quality_model.BUCKETS for w in words],
    ]
    want = []
    for at in kinds:
        rows = vectors[at].astype(float)
        mean = rows.sum(axis=0) / len(at)
        want += [*mean, *np.sqrt(np.maximum((rows * rows).sum(axis=0) / len(at) - mean * mean, 0))]
    want += [sum(a == b for a, b in zip(k, k[1:], strict=False)) / (len(k) - 1) for k in kinds]
    assert np.allclose(got, [*want, math.log(1 + len(words))], atol=1e-3)

    x = rng.normal(size=(300, quality_model.N_FEATURES))
    y = (x[:, 0] + 0.3 * rng.normal(size=300) > 0).astype(float)
    net = quality_model.Network(x, y)
    for row, score in zip(x[:20], net.score(x[:20]), strict=True):
        z = [max(-6, min(6, (v - m) / s)) for v, m, s in zip(row, net.mean, net.scale, strict=True)]
        hidden = [math.tanh(sum(a * b for a, b in zip(z, net.p[0][:, j], strict=True)) + net.p[1][j]) for j in range(quality_model.HIDDEN)]
        logit = sum(a * b for a, b in zip(hidden, net.p[2], strict=True)) + net.p[3][0]
        assert abs(score - 1 / (1 + math.exp(-logit / net.temperature))) < 1e-9


def test_archives_are_bounded_and_read_by_many_tasks(spark):
    pages = spark.range(600).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat(F.repeat(F.lit("x"), 1000), F.col("id").cast("string")).alias("html"))
    archives, root = warc.archive_pages(pages.coalesce(2), archive_bytes=50_000)
    n = archives.count()
    assert n >= 12 and archives.agg(F.sum("records"), F.max("records")).first()[0] == 600
    chunks = warc.read_chunks(archives, root)
    assert chunks.rdd.getNumPartitions() >= n
    tasks = chunks.select(F.spark_partition_id().alias("t")).distinct().count()
    assert tasks > n // 2
    assert warc.read_pages(archives, root).agg(F.count_distinct("page_id")).first()[0] == 600


def test_vectors_too_large_for_a_score_take_no_part(spark):
    rows = [(0, [1.0, 0.5]), (1, [1e30, 1.0]), (2, [1e20, 2.0]), (3, [5.0e6, 1.0]), (4, [-5.9e6, 1.0]), (5, [6.0e6, 0.0]), (6, [0.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.exact_topk(df, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert [(r[2], r[3]) for r in got] == [(3, 256 * 1280000000 + 128 * 256), (6, 128 * 512), (4, -256 * 1510400000 + 128 * 256)]


def test_columns_are_found_whatever_their_case(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, Text string")
    assert map_rows(df, ["text"], "n int", lambda: lambda t: (len(t),)).first()["n"] == 3


def test_groups_without_texts_are_the_same(spark):
    df = spark.createDataFrame([(1, "a b c d e"), (2, "a b c d e"), (3, None), (4, "other words " * 5)], "doc_id long, text string")
    whole, narrow = simhash.simhash_groups(df), simhash.simhash_groups(df, keep_text=False)
    assert "text" not in narrow.columns and sorted(map(tuple, whole.drop("text").collect())) == sorted(map(tuple, narrow.collect()))
