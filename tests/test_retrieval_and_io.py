"""Chunkers, retrieval, sinks and streams against plain loops."""

import hashlib
import math
import random
import re
from collections import Counter
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from quern.operators import lexical as lex
from quern.operators import retrieval as ret
from quern.operators import scoring
from quern.operators import vectors as vec
from quern.session import scratch_dir, scratch_root
from quern.sources import readers, writers
from quern.streaming import jobs


def brute_sentences(text, size):
    chunks, cur = [], ""
    for s in re.split(r"(?<=[.!?])\s+", text.replace("\n", " ")):
        if not cur or len(cur) + len(s) <= size:
            cur = f"{cur} {s}" if cur else s
        else:
            chunks.append(cur)
            cur = s
    return chunks + [cur] if cur else chunks


@pytest.mark.parametrize("text", ["", "One. Two! Three? ", "a" * 30 + ". b. " + "c" * 30, "no end\nat all", " . . . "])
def test_sentence_chunks(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(ret.chunk_sentences(F.col("t"), 12).alias("c")).first()["c"]
    assert got == brute_sentences(text, 12)


def brute_cjk(text, size, overlap):
    """Units one by one: a chunk is closed before a unit that does not fit and after a sentence end near the limit."""
    chunks, cur = [], ""
    for unit in re.findall(r"(?s)[A-Za-z0-9]+|.", text):
        if len(cur + unit) > size:
            chunks.append(cur.strip())
            cur = ""
        cur += unit
        if unit in ret.CJK_ENDINGS and len(cur) > size - overlap:
            chunks.append(cur.strip())
            cur = ""
    return [*chunks, cur.strip()] if cur else chunks


@pytest.mark.parametrize(("size", "overlap"), [(5, 2), (3, 0), (4, 3), (6, 6), (4, 9)])
def test_cjk_chunks(spark, size, overlap):
    rng = random.Random(size)
    texts = ["中文句子。还有一句！", "中" * 7, "abcdef中", "", "a", "。", "abcdefgh", "中abcdefg。xyzxyzxyz"]
    texts += ["".join(rng.choices("中文。！\n ab1", k=rng.randrange(1, 30))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    got = {r["k"]: r["c"] for r in df.select("k", ret.chunk_cjk(F.col("t"), size, overlap).alias("c")).collect()}
    assert got == {i: brute_cjk(t, size, overlap) for i, t in enumerate(texts)}


def test_overlap_and_router(spark):
    df = spark.createDataFrame([(0, "Aa bb. Cc dd. Ee"), (1, "一二三。四五六。"), (2, "")], "k bigint, t string")
    rows = ret.chunk_documents(df, "k", "t", 6, 3).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r["k"], r["chunk_idx"])):
        got.setdefault(r["k"], []).append(r["chunk"])
    assert got == {0: ["Aa bb. Cc", "Cc dd. Ee", "Ee"], 1: ["一二三。 四五六", "四五六。"]}


def test_broken_lines(spark):
    df = spark.createDataFrame([(["a,", "b.", "c", "d"],), (["x!"],), ([],)], "l array<string>")
    got = [r["m"] for r in df.select(ret.merge_broken_lines(F.col("l")).alias("m")).collect()]
    assert got == [["a,b.", "cd"], ["x!"], []]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(11)
    words = ["the"] * 40 + [f"w{i}" for i in range(30)]
    docs = [(i, " ".join(rng.choices([w.replace("0", "o") for w in words], k=rng.randrange(1, 40)))) for i in range(300)]
    docs[5] = (5, docs[4][1])  # an exact copy: the smaller id must win the tie
    asked = [(i, " ".join(rng.choices(["the", "w", "x"], k=3))) for i in range(7)] + [(9, "unseen")]
    return docs, asked


def brute_bm25(docs, asked, k):
    split = {d: re.findall(r"[a-z]+|[0-9]", t) for d, t in docs}
    df = Counter(w for t in split.values() for w in set(t))
    n, avg = len(split), sum(map(len, split.values())) / len(split)
    out = {}
    for q, text in asked:
        scores = {}
        for d, t in split.items():
            tf, s = Counter(t), 0.0
            for w in re.findall(r"[a-z]+|[0-9]", text):
                idf = math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5))
                s += idf * tf[w] * 2.5 / (tf[w] + 1.5 * (0.25 + 0.75 * len(t) / avg))
            if s > 0:
                scores[d] = round(s, 9)
        out[q] = sorted(scores, key=lambda d: (-scores[d], d))[:k]
    return out


def hits_of(frame, asked):
    got = {a: [] for a, _ in asked}
    for r in sorted(frame.collect(), key=lambda r: r["rank"]):
        got[r["query_id"]].append(r["doc_id"])
    return got


@pytest.mark.parametrize("block", [512, 3])
def test_bm25(spark, corpus, block):
    docs, asked = corpus
    d = spark.createDataFrame(docs, "d bigint, t string").repartition(5)
    q = spark.createDataFrame(asked, "q bigint, t string")
    got = {a: [] for a, _ in asked}
    for r in sorted(ret.bm25_topk(d, "d", "t", q, "q", "t", 4, block).collect(), key=lambda r: r["rank"]):
        got[r["query_id"]].append(r["doc_id"])
    assert got == brute_bm25(docs, asked, 4)


def test_large_query_blocks_are_split(corpus, monkeypatch):
    import pandas as pd

    monkeypatch.setattr(ret, "BLOCK_BYTES", 64)
    block = pd.DataFrame({"query_id": range(5), "q": [["a", "b"], ["c"], ["d", "e", "f"], ["a"], []]})
    parts = list(ret._fit(block))
    assert sum(len(p) for p, _ in parts) == 5
    assert all(len(t) * len(p) * 8 <= 64 or len(p) == 1 for p, t in parts)


@pytest.mark.parametrize("size", [256, 3])
def test_bm25_by_the_index(spark, corpus, size, monkeypatch):
    monkeypatch.setattr(lex, "RANGE", size)
    monkeypatch.setattr(lex, "HOT_LEAST", 4 if size == 3 else 4096)  # several salts of a term
    monkeypatch.setattr(lex, "MAX_SENT", 0 if size == 3 else 500_000)  # all by shuffles
    docs, asked = corpus
    d = spark.createDataFrame(docs, "d bigint, t string").repartition(5)
    q = spark.createDataFrame(asked, "q bigint, t string")
    index = lex.build_index(d, "d", "t", only=lex.query_terms(q, "q", "t"))
    assert hits_of(lex.search(index, q, "q", "t", 4), asked) == brute_bm25(docs, asked, 4)


def test_a_stored_index_is_asked_again(spark, monkeypatch):
    rng = random.Random(8)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)]
    pick = lambda n: " ".join(rng.choices(words, [1 / (i + 1) for i in range(120)], k=n))
    docs = [(i, pick(rng.randrange(1, 120))) for i in range(400)]
    asked = [(i, pick(12)) for i in range(20)] + [(77, docs[5][1]), (78, "waa"), (79, "none"), (80, "")]
    monkeypatch.setattr(lex, "RANGE", 16)
    d = spark.createDataFrame([*docs, (9999, None)], "d bigint, t string").select(F.concat(F.lit("x"), F.lpad("d", 5, "0")).alias("d"), "t")
    path = scratch_dir(spark, "index")
    built = lex.build_index(d, "d", "t", path)
    opened = lex.open_index(spark, path)
    assert (opened.n, opened.average) == (built.n, built.average) and opened.n == 401
    q = spark.createDataFrame([*asked, (81, None)], "q bigint, t string")
    named = {f"x{i:05}": i for i, _ in docs}
    got = hits_of(lex.search(opened, q, "q", "t", 5), [*asked, (81, "")])
    want = brute_bm25([*docs, (9999, "")], asked, 5)
    assert {k: [named[x] for x in v] for k, v in got.items()} == {**want, 81: []}
    posts = {(r["term"], r["doc_id"]): (r["tf"], r["length"]) for r in opened.postings().collect()}
    assert posts == {(w, f"x{i:05}"): (c, len(t.split())) for i, t in docs for w, c in Counter(t.split()).items()}
    tops = opened.blocks.select(F.forall("postings", lambda p: p["w"] <= F.col("top")).alias("ok")).distinct().collect()
    assert [r["ok"] for r in tops] == [True]


def test_an_empty_corpus_has_no_hits(spark):
    d = spark.createDataFrame([], "d bigint, t string")
    q = spark.createDataFrame([(1, "a b")], "q bigint, t string")
    assert ret.bm25_topk(d, "d", "t", q, "q", "t").count() == 0
    assert lex.search(lex.build_index(d, "d", "t"), q, "q", "t").count() == 0


def test_long_texts_are_chunked_in_linear_time(spark):
    import time

    text = F.repeat(F.lit("This is one short sentence, of forty chars. "), 32_000)
    df = spark.range(1).select(text.alias("t"))
    df.select(F.size(ret.chunk_sentences(F.col("t")))).first()
    start = time.time()
    assert df.select(F.size(ret.chunk_sentences(F.col("t")))).first()[0] == 6400
    lines = F.split(F.replace(F.replace(F.col("t"), F.lit(", "), F.lit(",\n")), F.lit(". "), F.lit(".\n")), "\n")
    assert df.select(F.size(ret.merge_broken_lines(F.array_append(lines, "open")))).first()[0] == 32_001
    assert time.time() - start < 10


def test_dense_and_fusion(spark):
    v = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 2.0]), (3, [2.0, 2.0])], "d bigint, v array<float>")
    q = spark.createDataFrame([(7, [0.0, 1.0])], "q bigint, v array<double>")
    hits = ret.dense_topk(v, "d", "v", q, "q", "v", 3)
    assert [r["doc_id"] for r in hits.orderBy("rank").collect()] == [2, 1, 3]
    other = spark.createDataFrame([(7, 3, 1), (7, 2, 2)], "query_id bigint, doc_id bigint, rank int")
    fused = ret.fuse_ranks([hits, other]).orderBy("rank").collect()
    assert [r["doc_id"] for r in fused] == [2, 3, 1]


def test_inverted_lists_of_vectors(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16))
    rows = [(f"v{i:04}", (centres[i % 12] + 0.3 * rng.normal(size=16)).tolist()) for i in range(900)]
    rows += [("none", None), ("zero", [0.0] * 16), ("twin", rows[0][1]), ("short", rows[1][1][:9])]
    df = spark.createDataFrame(rows, "d string, v array<double>").repartition(4)
    q = df.where("substring(d, 4, 2) = '00' OR d IN ('twin', 'none')")
    monkeypatch.setattr(vec, "PART", 16)  # lists of several parts
    index = vec.build_dense_index(df, "d", "v")
    assert index.rows.count() == 903 and index.rows.select("list", "part").distinct().count() > index.parts.count()
    names = [d for d, v in rows if v is not None]
    m = np.zeros((len(names), 16))
    for i, v in enumerate(v for _, v in rows if v is not None):
        m[i, : len(v)] = v
    m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
    asked = sorted(r["d"] for r in q.where("v IS NOT NULL").collect())
    want = {}
    for a in asked:
        s = np.round(m @ m[names.index(a)], 9)
        want[a] = sorted(range(len(names)), key=lambda i: (-s[i], names[i]))[:5]
    exact = vec.search_dense(index, q, "d", "v", 5, probes=10_000)
    got = {a: [] for a in asked}
    for r in exact.orderBy("rank").collect():
        got[r["query_id"]].append(r["doc_id"])
    assert got == {a: [names[i] for i in w] for a, w in want.items()}
    assert vec.recall(vec.search_dense(index, q, "d", "v", 5), exact).first()["recall"] >= 0.9
    none = vec.build_dense_index(df.limit(0), "d", "v")
    assert vec.search_dense(none, q, "d", "v").count() == 0


def test_prompts_without_hits_or_corpus(spark):
    q = spark.createDataFrame([(1, "why")], "q bigint, t string")
    hits = spark.createDataFrame([], "query_id bigint, doc_id bigint, rank int")
    docs = spark.createDataFrame([(1, "x")], "d bigint, t string")
    assert ret.context_prompts(q, "q", "t", hits, docs, "d", "t").first()["prompt"] == ret.NO_HITS
    assert ret.context_prompts(q, "q", "t", hits, docs.limit(0), "d", "t").first()["prompt"] == "why"
    assert ret.context_prompts(q, "q", "t", None, None, "d", "t").first()["prompt"] == "why"


def test_jsonl_keeps_nulls_and_text(spark):
    path = scratch_dir(spark, "t")
    writers.write_jsonl(spark.createDataFrame([("é中", None)], "a string, b string"), path)
    assert [r["value"] for r in spark.read.text(path).collect()] == ['{"a":"é中","b":null}']


def test_mixed_extensions_are_refused(spark):
    path = scratch_dir(spark, "t")
    spark.range(2).write.json(f"{path}/a")
    spark.range(2).select(F.col("id").cast("string")).write.text(f"{path}/b")
    with pytest.raises(ValueError, match="json.*txt"):
        readers.require_single_extension(spark.read.option("recursiveFileLookup", True).text(path))


def test_fingerprint_uses_the_first_mebibyte(spark):
    df = spark.createDataFrame([(bytearray(b"a" * readers.MIB + b"x"),), (bytearray(b"a" * readers.MIB + b"y"),)], "b binary")
    assert df.select(readers.fingerprint(F.col("b")).alias("f")).distinct().count() == 1


def test_files_beyond_two_gigabytes_are_fingerprinted_by_their_head(spark, tmp_path):
    (tmp_path / "a b").mkdir()
    large, small = tmp_path / "a b" / "large.bin", tmp_path / "é%20#.txt"
    small.write_bytes(b"hello")
    with large.open("wb") as f:
        f.write(b"start")
        f.truncate(3 << 30)  # sparse: takes no room on disk
    head = b"start" + bytes((1 << 20) - 5)
    got = {r["path"].rsplit("/", 1)[1]: r["fingerprint"] for r in readers.file_fingerprints(spark, str(tmp_path)).collect()}
    assert got == {"large.bin": hashlib.md5(head).hexdigest(), "é%20#.txt": hashlib.md5(b"hello").hexdigest()}
    plan = readers._heads(spark, str(tmp_path))._jdf.queryExecution().toString()
    assert "ReadSchema: struct<path:string>" in plan
    assert tuple(readers.file_set_fingerprint(spark, str(tmp_path)).first()) == (hashlib.md5(head + b"hello").hexdigest(), 2)


def test_a_store_that_python_cannot_open_is_read_by_spark(spark, tmp_path, monkeypatch):
    (tmp_path / "x.txt").write_bytes(b"hello")

    def refuse(name, stores):
        raise OSError("no such store")

    monkeypatch.setattr(readers, "_head", refuse)
    assert readers.file_fingerprints(spark, str(tmp_path)).first()["fingerprint"] == hashlib.md5(b"hello").hexdigest()


def test_files_as_a_set_have_one_fingerprint(spark):
    import hashlib

    df = spark.createDataFrame([(2, b"b"), (1, b"a" * (readers.MIB + 5)), (3, None)], "k int, c binary").repartition(3)
    want = hashlib.md5(b"a" * readers.MIB + b"b").hexdigest()
    assert tuple(readers.set_fingerprint(df, "k", "c").first()) == (want, 3)


def test_document_files_by_extension(spark):
    from pathlib import Path

    folder = Path(scratch_dir(spark, "docs").removeprefix("file:"))
    folder.mkdir(parents=True)
    (folder / "a.md").write_text("# Head\n\n* a [link](http://x) **bold**\n> said\n")
    (folder / "b.html").write_text("<p>One &#65;&#x42; &amp; two</p><p>Three</p><script>x</script>&#9999999;")
    (folder / "c.txt").write_text("  plain # text \n\n end")
    got = {r["path"].rsplit("/", 1)[1]: r["text"] for r in readers.read_documents(spark, str(folder)).collect()}
    assert got == {"a.md": "Head\na link bold\nsaid", "b.html": "One AB & two\nThree\n&#9999999;", "c.txt": "plain # text\nend"}


def test_counters_of_a_watched_scan(spark):
    from quern.operators import sampling

    df, seen = sampling.watched(spark.range(100).repartition(3), F.col("id") % 4 == 0)
    df.write.format("noop").mode("overwrite").save()
    got = sampling.throughput(seen)
    assert (got["scanned"], got["collected"], got["yield_pct"]) == (100, 25, 25.0) and got["rows_per_second"] > 0


def test_summaries_of_other_runs_stay(spark):
    path = scratch_dir(spark, "sum")
    for m in ("m1", "m2", "m1"):
        writers.write_summary(spark.createDataFrame([(m, "d", 2, 1, 50.0)], "model_label string, eval_dataset string, total long, correct long, accuracy double"), path)
    assert sorted(r["model_label"] for r in spark.read.json(path).collect()) == ["m1", "m2"]


def test_eval_names(spark):
    df = spark.createDataFrame([(1, "q", "#### 5")], "k bigint, problem string, groud_truth_solution string")
    assert tuple(readers.normalize_eval(df, "k", "d").first())[2:] == ("q", "#### 5", 5.0)


def test_scratch_follows_the_session(spark):
    cluster = SimpleNamespace(conf={"spark.checkpoint.dir": "hdfs://shared/work/"})
    assert scratch_dir(cluster, "x").startswith("hdfs://shared/work/x-")
    assert scratch_root(spark) == scratch_root(spark)


def test_resume_is_idempotent(spark):
    samples = spark.createDataFrame(
        [(i, "d", "q", f"#### {i}", float(i)) for i in range(6)],
        "sample_id bigint, eval_dataset string, question string, ground_truth string, ground_truth_value double",
    )
    said = spark.createDataFrame([(i, "m", "d", f"it is {i // 2 * 2}") for i in range(6)], "sample_id bigint, model_label string, eval_dataset string, prediction string")
    old = scoring.score_predictions(samples, said.where("sample_id < 2"))
    once = scoring.resume_scoring(samples, said, old)
    twice = scoring.resume_scoring(samples, said, once)
    assert once.count() == twice.count() == 6
    assert tuple(scoring.accuracy_summary(twice).first()) == ("m", "d", 6, 3, 50.0)


def test_broken_json_lines_fail_the_read(spark):
    path = scratch_dir(spark, "t")
    spark.createDataFrame([('{"a": 1}',), ('{"a": ',)], "value string").coalesce(1).write.text(path)
    spark.range(1).select(F.lit(1).alias("a")).write.json(f"{path}/ok")
    assert readers.read_jsonl_dir(spark, f"{path}/ok", "a int").count() == 1
    bad = scratch_dir(spark, "t") + "/x.jsonl"
    from pathlib import Path

    Path(bad).parent.mkdir(parents=True, exist_ok=True)
    Path(bad).write_text('{"a": 1}\n{"a": \n')
    with pytest.raises(Exception, match="MALFORMED"):
        readers.read_jsonl_dir(spark, bad, "a int").collect()


def test_streams_of_a_folder_of_files_equal_batch(spark):
    folder = scratch_dir(spark, "sf")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.repartition(5).write.parquet(f"{folder}/documents.parquet")
    assert jobs.stream_text(spark, folder).count() == docs.where("text <> ''").count()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        jobs.stream_text(spark, scratch_dir(spark, "none"))


def test_resumed_streams_score_each_file_once(spark):
    samples = spark.createDataFrame([(i, "d", "q", "#### 1", 1.0) for i in range(6)], "sample_id bigint, eval_dataset string, question string, ground_truth string, ground_truth_value double")
    schema = "sample_id bigint, model_label string, eval_dataset string, prediction string"
    path, state = scratch_dir(spark, "p"), scratch_dir(spark, "s")
    for part in ([0, 1, 2], [3, 4, 5]):
        spark.createDataFrame([(i, "m", "d", "it is 1") for i in part], schema).write.mode("append").parquet(path)
        results, summary = jobs.stream_scores(samples, path, schema, state)
        assert results.count() == part[-1] + 1
    assert tuple(summary.first()) == ("m", "d", 6, 6, 100.0)
    assert jobs.stream_scores(samples, path, schema, state)[0].count() == 6


def test_a_cluster_without_a_shared_folder_is_refused():
    cluster = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(
        master="spark://x", getConf=lambda: {}, getCheckpointDir=lambda: None))
    with pytest.raises(ValueError, match="checkpoint.dir"):
        scratch_root(cluster)


def test_perplexity_of_documents_without_words(spark):
    df = spark.createDataFrame([(1, "a a b"), (2, ""), (3, None)], "k bigint, t string")
    got = {r["k"]: (r["n_tokens"], r["nll"]) for r in scoring.unigram_perplexity(df, "k", "t").collect()}
    nll = (2 * -math.log(3 / 5) - math.log(2 / 5)) / 3
    assert got[2] == got[3] == (0, None) and got[1][0] == 3 and abs(got[1][1] - nll) < 1e-12


def test_stream_packing_equals_batch(spark):
    from quern.operators import tokens as tok
    from quern.plans import token_jobs as tj

    sf = "/root/testdata/sf0.001"
    vocab = tj.vocabulary(spark, sf)
    flow = jobs.stream_pack(spark, sf, vocab, 64, 50).select("pack_group", "block", "input_ids").collect()
    batch = tok.pack_eos_blocks(tok.pack_groups(tj.encoded(spark, sf), "doc_id", 50), "ids", 64).collect()
    assert sorted(map(tuple, flow)) == sorted(map(tuple, batch))


def test_a_set_of_files_is_digested_in_parts(spark, monkeypatch):
    monkeypatch.setattr(readers, "PART_BYTES", 40)
    rows = [(i, None if i % 7 == 0 else f"text {i}") for i in range(60)] + [(None, "first")]
    df = spark.createDataFrame(rows, "k bigint, c string").repartition(3)
    got = readers.set_fingerprint(df, "k", "c")
    want = hashlib.md5(("first" + "".join(c or "" for _, c in rows[:-1])).encode()).hexdigest()
    assert tuple(got.first()) == (want, 61)
    assert re.search(r"PartitionFilters: \[[^\]]*_part#\d+ = \d+", got._jdf.queryExecution().toString())  # the last part alone


def test_hashed_vectors_cut_a_text_into_tokens_once(spark):
    from quern.plans import retrieval_jobs as jobs

    got = jobs.hashed_vectors(spark.createDataFrame([(0, "a b a"), (1, ""), (2, None)], "k bigint, text string"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and "lambdafunction" not in plan  # a lambda runs once per bucket
    want = [0.0] * jobs.VEC
    for t in "aba":
        want[int(hashlib.md5(t.encode()).hexdigest()[:4], 16) % jobs.VEC] += 1
    assert {r["k"]: r["v"] for r in got.collect()} == {0: want, 1: [0.0] * jobs.VEC, 2: [None] * jobs.VEC}


def test_postings_come_with_the_figures_of_their_term(spark, monkeypatch):
    monkeypatch.setattr(lex, "HOT_LEAST", 2)
    texts = {0: "a b a", 1: "a c", 2: "a", 3: None, 4: "c a a"}
    index = lex.build_index(spark.createDataFrame(list(texts.items()), "d bigint, t string"), "d", "t")
    got = {(r["term"], r["doc_id"]): (r["tf"], r["length"], r["df"], r["cf"]) for r in index.postings("df", "cf").collect()}
    words = {d: (t or "").split() for d, t in texts.items()}
    held = {w: [d for d in words if w in words[d]] for w in "abc"}
    assert got == {
        (w, d): (words[d].count(w), len(words[d]), len(held[w]), sum(x.count(w) for x in words.values())) for w in held for d in held[w]
    }
    counted = spark.createDataFrame([(["b", "a", "b"],), ([],), (None,)], "w array<string>").select(lex.term_counts(F.col("w")).alias("t"))
    assert "lambdafunction" not in counted._jdf.queryExecution().optimizedPlan().toString()  # no step per token in the plan
    assert [[tuple(x) for x in r["t"]] for r in counted.collect()] == [[("a", 1), ("b", 2)], [], []]
