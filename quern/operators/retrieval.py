"""Chunking, lexical and dense scoring, rank fusion and prompt building, as table jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.text import explode_indexed, has_cjk, strip, tokens
from quern.operators.lexical import K1, B
from quern.operators.ordering import dense_index
from quern.operators.tokens import encode, lookup_table
from quern.session import scratch_dir

# Sentence ends, the characters that close a line, prompt wording and fusion constants.
SENTENCE_BREAK = r"(?<=[.!?])\s+"
CJK_ENDINGS = ["\n", "。", "！", "？", "；", "…"]
LINE_ENDINGS = [
    ".", "!", "?", "。", "！", "？", "…", ";", "；", ":", "：", "”", "’", "）", "】", "》", "」",
    "』", "〕", "〉", "》", "〗", "〞", "〟", "»", '"', "'", ")", "]", "}",
]
RAG_PROMPT = """基于以下已知信息，简洁和专业的来回答用户的问题。
如果无法从中得到答案，请说 "根据已知信息无法回答该问题" 或 "没有提供足够的相关信息"，不允许在答案中添加编造成分，答案请使用中文。

已知内容:
{context_str}

问题:
{query_str}
"""
NO_HITS = "没有提供足够的相关信息"
FUSION_WEIGHTS, FUSION_C = (0.5, 0.5), 2
FUSION_DEPTH = 50
#: Hits (two ids and a rank each) that may be sent to every task.
MAX_HITS = 100_000


# ---------------------------------------------------------------- chunks


def chunk_sentences(text: Column, size: int = 250) -> Column:
    """Sentences packed greedily into chunks of about ``size`` characters, in time linear in the text.

    Line ends become blanks, so one can then stand for a border. A chunk is as many sentences as together, with a blank
    between any two, have at most ``size + 1`` characters, or one sentence that is longer.
    """
    bordered = F.regexp_replace(F.replace(text, F.lit("\n"), F.lit(" ")), SENTENCE_BREAK, "\n")
    pattern = rf"(?s)(.{{1,{size + 1}}}|[^\n]+)(?:\n|\z)"
    return F.transform(F.regexp_extract_all(bordered, F.lit(pattern), F.lit(1)), lambda c: F.replace(c, F.lit("\n"), F.lit(" ")))


def chunk_cjk(text: Column, size: int = 250, overlap: int = 50) -> Column:
    """Characters (words, for Latin runs) packed into chunks, closed early at a sentence end near the limit.

    One pattern describes a chunk: up to the first sentence end beyond ``size - overlap``, else as much as fits without
    cutting a Latin run, else a Latin run that is longer than a chunk. Where such a run follows a closed chunk, the
    chunk that was open by then is empty.
    """
    ends = "[" + "".join(CJK_ENDINGS) + "]"
    near = max(size - overlap, 0)
    closed = rf".{{{near},{size - 1}}}?{ends}" if near < size else rf"(?!){ends}"
    whole = rf".{{1,{size}}}(?:(?<![A-Za-z0-9])|(?![A-Za-z0-9]))"
    pattern = rf"(?s){closed}|{whole}|[A-Za-z0-9]+"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def chunk(c: Column, i: Column) -> Column:
        before = F.get(found, i - 1)
        shut = (F.length(before) > near) & F.right(before, F.lit(1)).isin(CJK_ENDINGS)
        lone = (F.length(c) > size) & ((i == 0) | F.coalesce(shut, F.lit(False)))
        return F.when(lone, F.array(F.lit(""), strip(c))).otherwise(F.array(strip(c)))

    return F.flatten(F.transform(found, chunk))


def overlap_chunks(chunks: Column, overlap: int) -> Column:
    """Each chunk followed by the start of the next; the last one as it is."""
    if overlap <= 0:
        return chunks
    return F.transform(
        chunks,
        lambda c, i: F.when(
            i < F.size(chunks) - 1, strip(F.concat(c, F.lit(" "), F.substring(F.get(chunks, i + 1), 1, overlap)))
        ).otherwise(c),
    )


def chunk_documents(df: DataFrame, key: str, text: str, size: int = 250, overlap: int = 50) -> DataFrame:
    """``key, chunk_idx, chunk``: CJK texts by character, all others by sentence, with overlap."""
    is_cjk = has_cjk(F.col(text))
    routed = df.select(
        key,
        chunk_cjk(F.when(is_cjk, F.col(text)), size, overlap).alias("_cjk"),
        F.when(~is_cjk, F.col(text)).alias("_latin"),
    )
    cut = routed.select(key, F.coalesce("_cjk", chunk_sentences(F.col("_latin"), size)).alias("_c"))
    cut = cut.select(key, overlap_chunks(F.col("_c"), overlap).alias("_c"))
    return explode_indexed(cut, [key], "_c", "chunk_idx", "chunk")


def merge_broken_lines(lines: Column) -> Column:
    """Neighbouring lines joined until one ends in closing punctuation; an open remainder is kept.

    Lines hold no line ends, so they are joined by one and cut by a pattern, in time linear in their length.
    """
    ends = "".join(rf"\x{{{ord(c):x}}}" for c in LINE_ENDINGS)
    pattern = rf"(?s).*?[{ends}](?=\n|\z)|.+"
    return F.transform(
        F.regexp_extract_all(F.array_join(lines, "\n"), F.lit(pattern), F.lit(0)), lambda c: F.replace(c, F.lit("\n"), F.lit(""))
    )


# ---------------------------------------------------------------- top-k scoring

BLOCK_BYTES = 64 << 20  # largest query block sent to the tasks


def _keep_best(best, queries, ids, scores, k):
    """Merge new scores into the running best-k list of each query (ties to the smaller id, all kept until ranked)."""
    for q in queries:
        s = scores[:, q]
        hit = np.flatnonzero(s > -np.inf)
        if hit.size == 0:
            continue
        old_s, old_i = best.get(q, (np.empty(0), np.empty(0, dtype=np.int64)))
        if old_s.size == k:
            hit = hit[s[hit] >= old_s[-1]]
            if hit.size == 0:
                continue
        if hit.size > k:
            cut = np.partition(s[hit], hit.size - k)[hit.size - k]
            hit = hit[s[hit] >= cut]
        all_s, all_i = np.concatenate([old_s, s[hit]]), np.concatenate([old_i, ids[hit]])
        order = np.lexsort((all_i, -all_s))[:k]
        best[q] = (all_s[order], all_i[order])


def _task_best(frames: Iterator[pd.DataFrame], score: Callable, query_ids: np.ndarray, k: int) -> Iterator[pd.DataFrame]:
    """One task's share: score each slice of rows against the query block and keep ``k`` rows per query."""
    best: dict = {}
    for pdf in frames:
        for at in range(0, len(pdf), 256):
            part = pdf.iloc[at : at + 256]
            scores = score(part)
            _keep_best(best, range(len(query_ids)), part.iloc[:, 0].to_numpy(dtype=np.int64), scores, k)
    for q, (s, i) in best.items():
        yield pd.DataFrame({"query_id": query_ids[q], "doc_id": i, "score": s})


def _rank(hits: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows per query over all tasks."""
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _query_blocks(queries: DataFrame, key: str, rows_per_block: int) -> Iterator[pd.DataFrame]:
    """The queries in blocks of bounded size. One block is the rule; more queries mean more passes, not more memory."""
    n = queries.count()
    if n <= rows_per_block:
        if n:
            yield queries.toPandas()
        return
    placed = dense_index(queries, key, name="_q")
    for at in range(0, n, rows_per_block):
        yield placed.where((F.col("_q") >= at) & (F.col("_q") < at + rows_per_block)).drop("_q").toPandas()


def _fit(block: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, list[str]]]:
    """Halve a query block until its term-by-query matrix is small enough; with each part its sorted terms."""
    terms = sorted({t for q in block["q"] for t in q})
    if len(terms) * len(block) * 8 <= BLOCK_BYTES or len(block) == 1:
        yield block, terms
        return
    half = len(block) // 2
    yield from _fit(block.iloc[:half])
    yield from _fit(block.iloc[half:])


def _union(parts: list[DataFrame], empty: DataFrame) -> DataFrame:
    out = empty if not parts else parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


HITS = "query_id bigint, doc_id bigint, score double"


def bm25_topk(
    docs: DataFrame, doc_key: str, doc_text: str, queries: DataFrame, query_key: str, query_text: str, k: int = 5,
    block_queries: int = 512,
) -> DataFrame:
    """``query_id, doc_id, score, rank``: the ``k`` best documents per query by BM25.

    The query block is what travels: its terms become a lookup table and a term-by-query weight matrix. Each document
    is reduced in place to the codes of the query terms it holds, and each task returns ``k`` rows per query, so
    neither posting lists nor document-query pairs are shuffled and a term in every document costs nothing extra.
    Queries beyond one block are scored in further passes; for many queries, or a corpus that is asked again and again,
    see :mod:`quern.operators.lexical`.
    """
    spark = docs.sparkSession
    words = docs.select(F.col(doc_key).cast("bigint").alias("doc_id"), tokens(F.col(doc_text)).alias("t"))
    parts = []
    asked = queries.select(F.col(query_key).cast("bigint").alias("query_id"), tokens(F.col(query_text)).alias("q"))
    for block, terms in (x for b in _query_blocks(asked, "query_id", block_queries) for x in _fit(b)):
        code = {t: i for i, t in enumerate(terms)}
        vocab = spark.createDataFrame([(t, i) for t, i in code.items()], "piece string, id int")
        coded = words.withColumn("_table", lookup_table(vocab, 4096)).select(
            "doc_id", F.size("t").alias("n"), encode(F.col("t"), F.col("_table"), 4096, -1).alias("c")
        )
        coded = coded.select("doc_id", "n", F.filter("c", lambda c: c >= 0).alias("c"))
        # One pass for all statistics: code -1 stands for the document itself.
        marks = coded.select("n", F.explode(F.array_append(F.array_distinct("c"), F.lit(-1))).alias("c"))
        seen = marks.groupBy("c").agg(F.count(F.lit(1)).alias("df"), F.sum("n").alias("len"))
        df, n_docs, avgdl = np.zeros(len(terms)), 0, 1.0
        for row in seen.collect():  # at most one row per query term and one for the corpus
            if row["c"] < 0:
                n_docs, avgdl = row["df"], max(row["len"] / row["df"], 1e-9)
            else:
                df[row["c"]] = row["df"]
        idf = np.log(1 + (n_docs - df + 0.5) / (df + 0.5))
        weight = np.zeros((len(terms), len(block)))
        for j, q in enumerate(block["q"]):
            for t in q:
                weight[code[t], j] += idf[code[t]]
        shared = spark.sparkContext.broadcast((weight, block["query_id"].to_numpy(dtype=np.int64)))
        n_terms = len(terms)

        def score(part: pd.DataFrame, shared=shared, n_terms=n_terms) -> np.ndarray:
            sizes = part["c"].map(len).to_numpy()
            rows = np.repeat(np.arange(len(part)), sizes)
            codes = np.concatenate([*part["c"], np.empty(0, dtype=np.int64)]).astype(np.int64)
            tf = np.bincount(rows * n_terms + codes, minlength=len(part) * n_terms).reshape(len(part), n_terms)
            norm = K1 * (1 - B + B * part["n"].to_numpy(dtype=float) / avgdl)
            points = np.round((tf * (K1 + 1) / (tf + norm[:, None])) @ shared.value[0], 9)
            return np.where(points > 0, points, -np.inf)

        def run(frames, score=score, shared=shared):
            yield from _task_best(frames, score, shared.value[1], k)

        parts.append(coded.mapInPandas(run, HITS))
    return _rank(_union(parts, spark.createDataFrame([], HITS)), k)


def dense_topk(
    vectors: DataFrame, key: str, vector: str, queries: DataFrame, query_key: str, query_vector: str, k: int = 5
) -> DataFrame:
    """``query_id, doc_id, score, rank``: the ``k`` nearest vectors per query by cosine.

    The query block is sent to the tasks after a check of its size; a larger query set is scored block by block. Each
    task returns ``k`` rows per query. Null vectors take no part.
    """
    spark = vectors.sparkSession
    asked = queries.select(F.col(query_key).cast("bigint").alias("query_id"), F.col(query_vector).alias("q"))
    width = asked.select(F.max(F.size("q"))).first()[0] or 1
    rows = vectors.select(F.col(key).cast("bigint").alias("doc_id"), F.col(vector).alias("v")).where("v is not null")
    parts = []
    for block in _query_blocks(asked, "query_id", max(1, BLOCK_BYTES // (8 * width))):
        q = np.stack(block["q"].to_numpy()).astype(float)
        q = q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-300)
        shared = spark.sparkContext.broadcast((q.T.copy(), block["query_id"].to_numpy(dtype=np.int64)))

        def score(part: pd.DataFrame, shared=shared) -> np.ndarray:
            v = np.stack(part["v"].to_numpy()).astype(float)
            v = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)
            return np.round(v @ shared.value[0], 9)

        def run(frames, score=score, shared=shared):
            yield from _task_best(frames, score, shared.value[1], k)

        parts.append(rows.mapInPandas(run, HITS))
    return _rank(_union(parts, spark.createDataFrame([], HITS)), k)


def group_centroids(df: DataFrame, group: str, vector: str) -> DataFrame:
    """Mean vector per group, summed per dimension before the exchange."""
    cells = df.select(group, F.posexplode(vector).alias("dim", "x"))
    means = cells.groupBy(group, "dim").agg(F.avg(F.col("x").cast("double")).alias("m"))
    packed = means.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("dim", "m"))).alias("p"))
    return packed.select(group, F.transform("p", lambda x: x["m"]).alias("centroid"))


def fuse_ranks(lists: list[DataFrame], weights: tuple[float, ...] = FUSION_WEIGHTS, c: float = FUSION_C, k: int = 5) -> DataFrame:
    """Weighted reciprocal-rank fusion of ranked lists: sum of ``w / (c + rank)``, re-ranked.

    The lists should be much deeper than ``k`` (see ``FUSION_DEPTH``): a document in the middle of both can win.
    """
    parts = [
        hits.select("query_id", "doc_id", (F.lit(float(w)) / (F.lit(float(c)) + F.col("rank"))).alias("s"))
        for hits, w in zip(lists, weights, strict=True)
    ]
    fused = _union(parts, parts[0]).groupBy("query_id", "doc_id").agg(F.round(F.sum("s"), 9).alias("score"))
    return _rank(fused, k)


def context_prompts(
    queries: DataFrame, query_key: str, query_text: str, hits: DataFrame | None, docs: DataFrame | None, doc_key: str,
    doc_text: str, context_len: int = 2048,
) -> DataFrame:
    """``query_id, prompt``: the numbered hits in the prompt template, cut to the context length.

    Without a corpus, or with an empty one, the prompt is the bare query; a query without hits gets the fixed reply.
    """
    asked = queries.select(F.col(query_key).alias("query_id"), F.col(query_text).alias("_q"))
    if docs is None or hits is None:
        return asked.select("query_id", F.col("_q").alias("prompt"))
    spark = docs.sparkSession
    texts = docs.select(F.col(doc_key).alias("doc_id"), F.col(doc_text).alias("_d"))
    path = scratch_dir(spark, "hits")
    hits.select("query_id", "doc_id", "rank").write.parquet(path)
    hits = spark.read.parquet(path)
    few = hits.count() <= MAX_HITS  # only the texts of hits are shuffled then; otherwise both sides are
    found = (F.broadcast(hits) if few else hits).join(texts, "doc_id").groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "_d"))).alias("_h")
    )
    lines = F.transform("_h", lambda h: F.concat(F.lit("["), h["rank"].cast("string"), F.lit(']\t "'), h["_d"], F.lit('"')))
    context = F.substring(F.array_join(lines, "\n"), 1, max(context_len - len(RAG_PROMPT), 0))
    head, rest = RAG_PROMPT.split("{context_str}")
    middle, tail = rest.split("{query_str}")
    prompt = F.concat(F.lit(head), context, F.lit(middle), F.col("_q"), F.lit(tail))
    empty = texts.limit(1).select(F.count(F.lit(1)) == 0).scalar()
    reply = F.when(empty, F.col("_q")).when(F.col("_h").isNull(), NO_HITS).otherwise(prompt)
    return asked.join(found, "query_id", "left").select("query_id", reply.alias("prompt"))
