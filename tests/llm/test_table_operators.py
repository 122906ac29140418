"""WARC, resharding, mixing, top-k and the two models against brute force, and their edge cases."""

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import language, mixing, quality_model, resharding, topk, warc
from quern.llm.queries import ORACLES, QUERIES
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    n, problem = compare(spark, connect(SF), name, QUERIES[name], ORACLES[name], SF)
    assert not problem and n > 0


# WARC


def test_archives_are_standard_and_chunked(spark):
    big = "é" * 3333
    rows = [(1, "http://a/\n", big), (2, None, ""), (3, "u", None), (7, "u", big), (7, "u", big), (None, "u", big), (None, "u", "own"), (-5, "u", "neg")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("is_response", F.lit(1)).coalesce(1)
    archives, root = warc.archive_pages(pages)
    got = sorted((r.asDict() for r in warc.read_pages(archives, root).collect()), key=str)
    sha = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    kinds = Counter((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in got)
    n, d = len(big.encode()), sha(big)
    assert kinds == Counter({
        (1, "revisit", 7, n, d): 1, (7, "response", None, n, d): 2, (None, "revisit", 7, n, d): 1, (None, "response", None, 3, sha("own")): 1,
        (2, "revisit", 3, 0, sha("")): 1, (3, "response", None, 0, sha("")): 1, (-5, "response", None, 3, sha("neg")): 1,
    })
    chunks = warc.read_chunks(archives, root, data=True, chunk=1000).filter("page_id = 7").collect()
    by = defaultdict(list)
    for c in chunks:
        by[c["archive"], c["record_no"]].append(c)
    for parts in by.values():
        parts.sort(key=lambda c: c["chunk_no"])
        assert all(len(c["chunk"]) <= 1000 for c in parts) and len(parts) > 5
        whole = b""
        for c in parts:
            whole += c["chunk"]
            assert c["running_digest"] == base64.b32encode(hashlib.sha1(whole).digest()).decode()
        assert whole.decode() == big and parts[-1]["last"] and not parts[0]["last"]
    fs, base = warc.open_fs(root)
    name = archives.filter("records > 0").first()["archive"]
    raw = fs.open_input_stream(f"{base}/{name}", compression=None).read()
    gz = zlib.decompressobj(31)
    first = gz.decompress(raw)
    assert first.startswith(b"WARC/1.1\r\nWARC-Type: ") and first.endswith(b"\r\n\r\n") and gz.unused_data[:2] == b"\x1f\x8b"


def test_broken_payloads_are_noticed():
    import io

    out = io.BytesIO()
    warc.write_record(out, 1, "u", memoryview(b"abc"), None, True)
    plain = zlib.decompressobj(31).decompress(out.getvalue()).replace(b"abc", b"abd")
    gz = zlib.compressobj(6, zlib.DEFLATED, 31)
    bad = gz.compress(plain) + gz.flush()
    with pytest.raises(ValueError, match="another digest"):
        list(warc.records(warc.Unzipped(io.BytesIO(bad)), "x", False))
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.records(warc.Unzipped(io.BytesIO(out.getvalue()[:-20])), "x", False))


def test_no_pages_give_no_records(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_pages(*warc.archive_pages(pages)).count() == 0


# resharding


def least_moved(have, cap):
    return sum(max(0, h - (cap[i] if i < len(cap) else 0)) for i, h in enumerate(have))


def test_flow_is_whole_and_cheapest():
    rng = random.Random(1)
    for _ in range(30):
        have = [rng.randrange(0, 50) for _ in range(rng.randrange(1, 6))]
        m = rng.randrange(1, 7)
        cap = [sum(have) // m + (j < sum(have) % m) for j in range(m)]
        flow = resharding.min_cost_flow(have, cap, resharding.moving_cost)
        for i, h in enumerate(have):
            assert sum(f for (a, _), f in flow.items() if a == i) == h
        for j, c in enumerate(cap):
            assert sum(f for (_, b), f in flow.items() if b == j) <= c
        assert sum(f for (a, b), f in flow.items() if a != b) == least_moved(have, cap)
    with pytest.raises(ValueError):
        resharding.min_cost_flow([5], [4], resharding.moving_cost)


def test_flow_takes_detours_for_other_costs():
    price = [[3, 1], [1, 9]]
    assert resharding.min_cost_flow([4, 4], [4, 4], lambda i, j: price[i][j]) == {(0, 1): 4, (1, 0): 4}


def write_docs(spark, rows, files):
    from quern.session import scratch_dir

    path = scratch_dir(spark, "docs")
    spark.createDataFrame(rows, DOCS).repartition(files).write.parquet(path)
    return path


def check_layout(rows, n, parts):
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r)
    for part in by.values():
        assert sorted(r["slot"] for r in part) == list(range(len(part)))
    sizes = [sum(r["size"] for r in by.get(j, [])) for j in range(parts)]
    assert len(rows) == n
    return sizes


def test_shards_are_near_equal_and_keep_what_they_can(spark):
    rng = random.Random(2)
    rows = [(i % 700, "x" * rng.randrange(0, 400), "en", "s", 1) for i in range(3000)] + [(5, None, None, None, None)] * 900
    path = write_docs(spark, rows, 6)
    got = resharding.reshard_files(spark, path, 9).collect()
    sizes = check_layout(got, 3900, 9)
    mean = sum(sizes) / 9
    assert max(sizes) - min(sizes) <= 0.06 * mean
    have = [0] * 6
    for r in got:
        have[r["old_shard"]] += r["size"]
    moved = sum(r["size"] for r in got if r["old_shard"] != r["shard"])
    assert moved <= least_moved(have, [mean] * 9) + 9 * mean * 0.03
    assert sum(r["text"] is None for r in got) == 900


def test_resharding_of_little_and_unchanged_tables(spark):
    path = write_docs(spark, [(1, "a", "en", "s", 1), (2, "b" * 500, "en", "s", 1)], 1)
    assert len(check_layout(resharding.reshard_files(spark, path, 5).collect(), 2, 5)) == 5
    same = resharding.reshard_files(spark, path, 1)
    assert {r["shard"] for r in same.collect()} == {0} and "shard=" not in "".join(same.inputFiles())
    empty = write_docs(spark, [], 1)
    assert resharding.reshard_files(spark, empty, 4).count() == 0


def test_op3_contract(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op3_reshard"](spark, SF).collect()
    sizes = check_layout(got, len(docs), 40)
    for r in got:
        raw = (docs[r["doc_id"]] or "").encode()
        assert r["size"] == len(raw) + 16 and r["text_crc32"] == zlib.crc32(raw) and r["law"] == "bytes" and r["grown_shard"] is None
    assert max(sizes) - min(sizes) <= max(max(r["size"] for r in got), sum(sizes) / 40 * 0.05)


# mixing


def plain_targets(sizes, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        free = [s for s in names if s not in capped]
        out = {s: rest * w[s] / sum(w[x] for x in free) for s in free} | {s: 3.0 * sizes[s] for s in capped}
        over = {s for s in free if out[s] > 3 * sizes[s]}
        if not over:
            return out
        capped |= over


def test_targets_follow_the_rounds_of_resharing(spark):
    rng = random.Random(3)
    for _ in range(4):
        sizes = {f"s{i}": rng.choice([0, 1, 10, 100, 1000]) for i in range(7)} | {None: 50, "é": 3}
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
        want = plain_targets(sizes)
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) <= 1e-9 * max(1, want[s]) for s in want)


def test_taken_words_come_near_the_targets_on_any_partitioning(spark):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randrange(0, 60), "en", rng.choice(["a", "b", "b", "b", "c", None]), 1) for i in range(2000)] + [(7, "same text", "en", "b", 1)] * 800 + [(None, None, None, None, None)]
    df = spark.createDataFrame(rows, DOCS).withColumn("copies", F.lit("x"))
    got = mixing.mix_sources(df.repartition(5)).select("doc_id", "source", "size", "target", "taken", "source_size").collect()
    again = mixing.mix_sources(df.repartition(3)).select("doc_id", "source", "size", "target", "taken", "source_size").collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again)) and len(got) == len(rows)
    taken, target = Counter(), {}
    for r in got:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    assert all(abs(taken[s] - target[s]) <= 60 for s in target)
    copies = mixing.emit_copies(mixing.mix_sources(df)).count()
    assert copies == sum(r["copies"] for r in mixing.mix_sources(df).collect())
    assert mixing.mix_sources(df.limit(0)).count() == 0


def test_running_totals_do_not_depend_on_slices(spark):
    from quern.llm.common import running_totals

    rng = random.Random(5)
    rows = [(rng.choice("aab"), rng.randrange(5), hashlib.md5(str(i).encode()).hexdigest(), rng.randrange(9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, l int, t string, m long")
    for n in (1, 3000, 10**7):
        got = running_totals(df, ["g"], F.col("l"), F.col("t"), {"total": F.col("m"), "rank": F.lit(1)}, n).collect()
        assert len(got) == 3000
        for g in "ab":
            total = 0
            for k, r in enumerate(sorted((r for r in got if r["g"] == g), key=lambda r: (r["l"], r["t"])), 1):
                total += r["m"]
                assert (r["total"], r["rank"]) == (total, k)


def test_lookups_of_hot_keys(spark, monkeypatch):
    from quern.llm import common

    monkeypatch.setattr(common, "MAX_BROADCAST_ROWS", 10)
    left = spark.createDataFrame([(i % 50 if i % 2 else 7, i) for i in range(6000)], "k int, i int")
    right = spark.createDataFrame([(k, str(k)) for k in range(0, 50, 1) if k != 3], "k int, v string")
    got = common.lookup_join(left, right, ["k"]).collect()
    assert len(got) == 6000 and all(r["v"] == (None if r["k"] == 3 else str(r["k"])) for r in got)


# top-k


def test_threshold_search_equals_brute_force():
    rng = np.random.default_rng(6)
    for n, d, top in ((300, 8, 50), (40, 3, 2), (5, 4, 10**9), (1, 2, 3), (200, 6, 1)):
        v = rng.integers(-top, top + 1, (n, d))
        copies = rng.integers(1, 4, n)
        ids = rng.permutation(n)
        q = np.concatenate((v[:20], np.zeros((1, d), np.int64)))
        qids = np.concatenate((ids[:20], [-1]))
        got = defaultdict(list)
        for a, b, s in topk.threshold_search(ids, v, copies, qids, q):
            got[a].append((-s, b))
        for a, row in zip(qids.tolist(), q, strict=True):
            want = sorted((-int(sum(int(x) * int(y) for x, y in zip(row, c, strict=True))), int(i)) for i, c, m in zip(ids, v, copies, strict=True) for _ in range(m) if i != a)[:5]
            assert sorted(got[a])[:5] == want


def test_topk_of_odd_vectors(spark):
    rows = [(0, [0.5, 0.5], 0), (1, [0.5, 0.5], 0), (2, [0.5, 0.5], 0), (2, [0.5, 0.5], 0), (3, None, 0), (4, [None, 1.0], 0), (5, [float("nan"), 1.0], 0), (6, [float("inf"), 1.0], 0), (7, [], 0), (8, [-1.0], 0), (None, [1.0, 1.0], 0), (50, [0.0, 0.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("rank", F.lit(1))
    got = [tuple(r) for r in topk.exact_topk(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()]
    s = 2 * 128 * 128
    assert got == [(0, 1, 1, s), (0, 2, 2, s), (0, 3, 2, s), (0, 4, 7, 0), (0, 5, 50, 0), (50, 1, 0, 0), (50, 2, 1, 0), (50, 3, 2, 0), (50, 4, 2, 0), (50, 5, 7, 0)]
    assert topk.exact_topk(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


# models


def test_network_gradients_and_back_propagation_are_right():
    rng = np.random.default_rng(7)
    net = language.ByteNetwork(3, hidden=4)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    codes, mask = rng.integers(0, 5, (3, 6)).astype(np.uint8), np.arange(6) < np.array([[6], [4], [1]])
    label = np.array([0, 2, 1])
    loss, grads = net.gradients(codes, mask, label)
    for k in grads:
        flat = [np.unravel_index(i, net.p[k].shape) for i in np.argsort(-np.abs(grads[k]).ravel())[:4]]
        for at in flat:
            old, h = net.p[k][at], 1e-2
            net.p[k][at] = old + h
            up = net.gradients(codes, mask, label)[0]
            net.p[k][at] = old - h
            down = net.gradients(codes, mask, label)[0]
            net.p[k][at] = old
            assert abs((up - down) / (2 * h) - grads[k][at]) < 2e-3 + 0.02 * abs(grads[k][at])


def test_languages_are_told_apart_on_held_out_documents(spark):
    got = QUERIES["op7_language"](spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(got) > 200 and sum(r["lang"] == r["lang_pred"] for r in got) >= 0.97 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_languages_of_odd_tables(spark, monkeypatch):
    monkeypatch.setattr(language, "LEAST_STEPS", 3)
    df = spark.createDataFrame([(1, None, "en", "s", 1), (2, "", "de", "s", 1), (3, "123 !!", None, "s", 1), (None, "abc", "en", "s", 1)], DOCS)
    none = {r["doc_id"]: r for r in language.identify_languages(df).collect()}
    assert {r["lang_pred"] for r in none.values()} == {"und"} and none[None]["held_out"]
    some = df.unionByName(spark.createDataFrame([(i, "hello there", "en", "s", 1) for i in range(8)] + [(i, "x" * 70_000, "de", "s", 1) for i in range(20, 24)], DOCS)).withColumn("score", F.lit("x"))
    got = language.identify_languages(some).collect()
    assert len(got) == 16 and {r["lang_pred"] for r in got if r["text"] in (None, "", "123 !!")} == {"und"}
    assert {r["lang_pred"] for r in got if r["text"] == "hello there"} <= {"en", "de"}
    assert language.identify_languages(df.limit(0)).count() == 0


def test_quality_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op6_quality_model"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    good, bad = [r["score"] for r in got if r["quality"] == 1], [r["score"] for r in got if r["quality"] == 0]
    wins = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert wins >= 0.9
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in got)


def test_quality_of_odd_tables(spark):
    df = spark.createDataFrame([(1, None, "en", "s", 1), (2, "", "en", "s", 1), (None, "a b c", "en", "s", 1), (4, "a b c", "en", "s", 1)], DOCS).withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(1, 1, 0), (4, None, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    got = quality_model.score_quality(df, labels).collect()
    assert len(got) == 4 and len({r["score"] for r in got}) == 1 and all(0 <= r["score"] <= 1 for r in got)
    assert quality_model.score_quality(df.limit(0), labels).count() == 0


def test_context_sums_equal_plain_counting(spark):
    texts = ["a b c a b", "b c", None, "x"]
    sums = quality_model.context_sums(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    at, sign = quality_model.index_vectors()
    want = np.zeros_like(sums)
    units = quality_model.Units()
    for t in texts:
        rows = quality_model.units_of(t, units)
        n = rows.shape[1]
        for k in (0, 1):
            for i in range(n):
                for j in range(n):
                    if i != j and abs(i - j) <= quality_model.WINDOW:
                        np.add.at(want[rows[k, i]], at[rows[k, j]], sign[rows[k, j]])
    assert (sums == want).all()
