"""Queries for chunking, retrieval and retrieval prompts."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.text import explode_indexed, strip_lines, tokens
from quern.operators import lexical as lex
from quern.operators import retrieval as ret
from quern.operators import vectors as vec
from quern.plans.fixtures import sql_strip, sql_tokens
from quern.plans.registry import query, spread_table, sql_text, table

LATIN, HAN = "aeiou.!?;", "安饿一哦乌。！？；"


def corpus(spark, sf):
    return spread_table(spark, sf, "documents", "doc_id")


def english_sql(text: str, size: int, src: str) -> str:
    """CTE ``eng(doc_id, chunks)`` folding sentences of ``src(doc_id, …)``."""
    return rf"""sent AS (SELECT doc_id, list_transform(string_split(regexp_replace(replace({text}, chr(10), ' '), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)),
    lambda s: {{'done': []::VARCHAR[], 'cur': s}}) AS l FROM {src}),
fold AS (SELECT doc_id, list_reduce(l, lambda a, s: CASE WHEN length(a.cur) + length(s.cur) <= {size} OR a.cur = ''
    THEN {{'done': a.done, 'cur': a.cur || CASE WHEN a.cur = '' THEN '' ELSE ' ' END || s.cur}}
    ELSE {{'done': list_append(a.done, a.cur), 'cur': s.cur}} END, {{'done': []::VARCHAR[], 'cur': ''}}) AS f FROM sent),
eng AS (SELECT doc_id, CASE WHEN f.cur <> '' THEN list_append(f.done, f.cur) ELSE f.done END AS chunks FROM fold)"""


def overlap_sql(n: int, src: str) -> str:
    return f"""SELECT doc_id, i - 1 AS chunk_idx, CASE WHEN i < m THEN {sql_strip(f"c || ' ' || left(nxt, {n})")} ELSE c END AS chunk FROM (
  SELECT doc_id, u.c, u.i, lead(u.c) OVER (PARTITION BY doc_id ORDER BY u.i) AS nxt, len(chunks) AS m
  FROM {src}, unnest(chunks) WITH ORDINALITY AS u(c, i))"""


@query("chunk_english", f"WITH {english_sql('text', 250, 'documents')} SELECT doc_id, i - 1 AS chunk_idx, u.c AS chunk FROM eng, unnest(chunks) WITH ORDINALITY AS u(c, i)")
def chunk_english(spark, sf):
    cut = corpus(spark, sf).select("doc_id", ret.chunk_sentences(F.col("text"), 250).alias("c"))
    return explode_indexed(cut, ["doc_id"], "c", "chunk_idx", "chunk")


@query("chunk_overlap", f"WITH {english_sql('text', 250, 'documents')} {overlap_sql(50, 'eng')}")
def chunk_overlap(spark, sf):
    cut = corpus(spark, sf).select("doc_id", ret.chunk_sentences(F.col("text"), 250).alias("c"))
    cut = cut.select("doc_id", ret.overlap_chunks(F.col("c"), 50).alias("c"))
    return explode_indexed(cut, ["doc_id"], "c", "chunk_idx", "chunk")


def cjk_sql(text: str, size: int, overlap: int, src: str) -> str:
    """CTE ``cjk(doc_id, chunks)``."""
    ends = "chr(10), " + ", ".join(f"'{x}'" for x in ret.CJK_ENDINGS[1:])
    return f"""units AS (SELECT doc_id, list_transform(regexp_extract_all({text}, '(?s)[A-Za-z0-9]+|.'), lambda s: {{'done': []::VARCHAR[], 'cur': s}}) AS l FROM {src}),
cfold AS (SELECT doc_id, list_reduce(l, lambda a, s:
  CASE WHEN right(s.cur, 1) IN ({ends}) AND length(CASE WHEN length(a.cur) + length(s.cur) > {size} THEN s.cur ELSE a.cur || s.cur END) > {size - overlap}
    THEN {{'done': CASE WHEN length(a.cur) + length(s.cur) > {size} THEN list_append(list_append(a.done, {sql_strip('a.cur')}), {sql_strip('s.cur')})
                   ELSE list_append(a.done, {sql_strip('a.cur || s.cur')}) END, 'cur': ''}}
    WHEN length(a.cur) + length(s.cur) > {size} THEN {{'done': list_append(a.done, {sql_strip('a.cur')}), 'cur': s.cur}}
    ELSE {{'done': a.done, 'cur': a.cur || s.cur}} END, {{'done': []::VARCHAR[], 'cur': ''}}) AS f FROM units),
cjk AS (SELECT doc_id, CASE WHEN f.cur <> '' THEN list_append(f.done, {sql_strip('f.cur')}) ELSE f.done END AS chunks FROM cfold)"""


@query(
    "chunk_chinese",
    f"WITH h AS (SELECT doc_id, translate(text, '{LATIN}', '{HAN}') AS text FROM documents), {cjk_sql('text', 250, 50, 'h')} "
    "SELECT doc_id, i - 1 AS chunk_idx, u.c AS chunk FROM cjk, unnest(chunks) WITH ORDINALITY AS u(c, i)",
)
def chunk_chinese(spark, sf):
    text = F.translate("text", LATIN, HAN)
    cut = corpus(spark, sf).select("doc_id", ret.chunk_cjk(text, 250, 50).alias("c"))
    return explode_indexed(cut, ["doc_id"], "c", "chunk_idx", "chunk")


@query(
    "chunk_router",
    f"""WITH r AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN translate(text, '{LATIN}', '{HAN}') ELSE text END AS text FROM documents),
han AS (SELECT * FROM r WHERE regexp_matches(text, '[\\x{{4e00}}-\\x{{9fff}}]')), lat AS (SELECT * FROM r WHERE NOT regexp_matches(text, '[\\x{{4e00}}-\\x{{9fff}}]')),
{english_sql('text', 100, 'lat')}, {cjk_sql('text', 100, 5, 'han')}, every AS (SELECT * FROM eng UNION ALL SELECT * FROM cjk)
{overlap_sql(5, 'every')}""",
)
def chunk_router(spark, sf):
    text = F.when(F.col("doc_id") % 2 == 0, F.translate("text", LATIN, HAN)).otherwise(F.col("text"))
    rows = corpus(spark, sf).select("doc_id", text.alias("text"))
    return ret.chunk_documents(rows, "doc_id", "text", 100, 5)


ENDS_SQL = "[" + ", ".join(sql_text(x) for x in ret.LINE_ENDINGS) + "]"


@query(
    "merge_broken_lines",
    f"""WITH l AS (SELECT doc_id, {sql_strip('u.x')} AS x, u.i FROM documents, unnest(string_split(replace(text, ', ', ',' || chr(10)), chr(10))) WITH ORDINALITY AS u(x, i)),
k AS (SELECT *, list_contains({ENDS_SQL}, right(x, 1)) AS closes FROM l WHERE x <> ''),
g AS (SELECT *, coalesce(sum(closes::INTEGER) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS island FROM k)
SELECT doc_id, island::BIGINT AS line_no, string_agg(x, '' ORDER BY i) AS line FROM g GROUP BY ALL""",
)
def merge_broken_lines(spark, sf):
    broken = F.replace(F.col("text"), F.lit(", "), F.lit(",\n"))
    rows = corpus(spark, sf).select("doc_id", ret.merge_broken_lines(strip_lines(broken)).alias("l"))
    return explode_indexed(rows, ["doc_id"], "l", "line_no", "line")


@query(
    "bm25_index",
    f"""WITH dt AS (SELECT doc_id, {sql_tokens('text')} AS t FROM documents), n AS (SELECT count(*) AS n, avg(len(t)) AS average FROM dt),
p AS (SELECT term, doc_id, count(*) AS tf, any_value(len) AS length FROM (SELECT doc_id, len(t) AS len, unnest(t) AS term FROM dt) GROUP BY ALL),
s AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM p GROUP BY term)
SELECT term, doc_id, tf, length, df, cf, round(ln(1 + (n - df + 0.5) / (df + 0.5)), 6) AS idf, round(average, 6) AS average FROM p JOIN s USING (term), n""",
)
def bm25_index(spark, sf):
    index = lex.build_index(corpus(spark, sf), "doc_id", "text")
    posts = index.postings("df", "cf", "idf").withColumn("idf", F.round("idf", 6))
    return posts.withColumn("average", F.lit(round(index.average, 6)))


BM25_SQL = f"""dt AS (SELECT doc_id, {sql_tokens('text')} AS t FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM dt) GROUP BY ALL),
dl AS (SELECT doc_id, len(t) AS dl FROM dt), st AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl),
dfs AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
qt AS (SELECT item_id, term, count(*) AS qtf FROM (SELECT item_id, unnest({sql_tokens('text')}) AS term FROM benchmark) GROUP BY ALL),
sc AS (SELECT item_id AS query_id, doc_id, round(sum(qtf * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))), 9) AS score
  FROM qt JOIN tf USING (term) JOIN dfs USING (term) JOIN dl USING (doc_id), st GROUP BY ALL),
lexall AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM sc),
lex AS (SELECT * FROM lexall WHERE rank <= 5)"""


def lexical(spark, sf, k=5):
    return ret.bm25_topk(corpus(spark, sf), "doc_id", "text", table(spark, sf, "benchmark"), "item_id", "text", k)


@query("bm25_topk", f"WITH {BM25_SQL} SELECT query_id, doc_id, round(score, 6) AS score, rank::INTEGER AS rank FROM lex")
def bm25_topk(spark, sf):
    return lexical(spark, sf).withColumn("score", F.round("score", 6))


@query("bm25_index_topk", f"WITH {BM25_SQL} SELECT query_id, doc_id, round(score, 6) AS score, rank::INTEGER AS rank FROM lex")
def bm25_index_topk(spark, sf):
    """The same answers from the index, by the blocks that can hold one."""
    asked = table(spark, sf, "benchmark")
    index = lex.build_index(corpus(spark, sf), "doc_id", "text", only=lex.query_terms(asked, "item_id", "text"))
    return lex.search(index, asked, "item_id", "text").withColumn("score", F.round("score", 6))


CENT_SQL = """cent AS (SELECT label, list(m ORDER BY d) AS q FROM (SELECT label, d, avg(x::DOUBLE) AS m FROM (
  SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS d FROM embeddings) GROUP BY ALL) GROUP BY label)"""


@query(
    "dense_topk",
    f"""WITH {CENT_SQL}, s AS (SELECT label::BIGINT AS query_id, vec_id AS doc_id, round(list_cosine_similarity(embedding::DOUBLE[], q), 9) AS score FROM embeddings e, (SELECT label AS label_, q FROM cent) c(label, q)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM (SELECT query_id, doc_id, score FROM s))
SELECT query_id, doc_id, round(score, 6) AS score, rank::INTEGER AS rank FROM r WHERE rank <= 5""".replace(
        "label::BIGINT AS query_id", "c.label::BIGINT AS query_id"
    ),
)
def dense_topk(spark, sf):
    vectors = table(spark, sf, "embeddings")
    centroids = ret.group_centroids(vectors, "label", "embedding")
    hits = ret.dense_topk(vectors, "vec_id", "embedding", centroids, "label", "centroid", 5)
    return hits.withColumn("score", F.round("score", 6))


@query(
    "dense_index_topk",
    """SELECT 5 * count(*) AS n_exact, TRUE AS recalled FROM embeddings WHERE vec_id % 50 = 0""",
)
def dense_index_topk(spark, sf):
    """Every 50th vector asked against the index of all, and whether nine tenths of the exact answers are found."""
    vectors = table(spark, sf, "embeddings")
    asked = vectors.where("vec_id % 50 = 0")
    index = vec.build_dense_index(vectors, "vec_id", "embedding")
    exact = ret.dense_topk(vectors, "vec_id", "embedding", asked, "vec_id", "embedding", 5)
    found = vec.search_dense(index, asked, "vec_id", "embedding", 5)
    return vec.recall(found, exact).select("n_exact", (F.col("recall") >= 0.9).alias("recalled"))


# A document's vector is the share of each hash bucket among its tokens; so is a query's.
VEC = 32
VEC_SQL = f"""tv AS (SELECT 'd' AS side, doc_id AS id, unnest({sql_tokens('text')}) AS x FROM documents UNION ALL SELECT 'q', item_id, unnest({sql_tokens('text')}) FROM benchmark),
cells AS (SELECT side, id, CAST('0x' || substr(md5(x), 1, 4) AS BIGINT) % {VEC} AS d, count(*) AS n FROM tv GROUP BY ALL),
norms AS (SELECT side, id, sqrt(sum(n * n)) AS norm FROM cells GROUP BY ALL),
dots AS (SELECT q.id AS query_id, d.id AS doc_id, sum(q.n * d.n) AS dot FROM cells q JOIN cells d ON q.d = d.d AND q.side = 'q' AND d.side = 'd' GROUP BY ALL),
ds AS (SELECT query_id, doc_id, round(dot / (a.norm * b.norm), 9) AS score FROM dots JOIN norms a ON a.side = 'q' AND a.id = query_id JOIN norms b ON b.side = 'd' AND b.id = doc_id),
deep AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM ds) WHERE rank <= {ret.FUSION_DEPTH})"""


def hashed_vectors(df):
    """Token counts in ``VEC`` hash buckets, a batch of rows at a time; a token is hashed once per batch."""

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def counted(rows: pa.Array) -> pa.Array:
        found = rows.flatten().dictionary_encode()
        bucket = np.array([int(hashlib.md5(t.encode()).hexdigest()[:4], 16) % VEC for t in found.dictionary.to_pylist()], np.int64)
        sizes = pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False)
        cells = np.repeat(np.arange(len(rows)) * VEC, sizes) + bucket[found.indices.to_numpy(zero_copy_only=False)]
        none = np.repeat(rows.is_null().to_numpy(zero_copy_only=False), VEC)
        n = pa.array(np.bincount(cells, minlength=len(rows) * VEC).astype(float), mask=none)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * VEC, pa.int32()), n)

    return df.withColumn("v", counted(tokens(F.col("text"))))


@query(
    "ensemble_rank",
    f"""WITH {BM25_SQL}, {VEC_SQL},
f AS (SELECT query_id, doc_id, round(sum(0.5 / (2 + rank)), 9) AS score FROM (SELECT query_id, doc_id, rank FROM deep UNION ALL SELECT query_id, doc_id, rank FROM lexall WHERE rank <= {ret.FUSION_DEPTH}) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM f)
SELECT query_id, doc_id, round(score, 6)::DOUBLE AS score, rank::INTEGER AS rank FROM r WHERE rank <= 5""",
)
def ensemble_rank(spark, sf):
    docs = hashed_vectors(corpus(spark, sf).select("doc_id", "text"))
    asked = hashed_vectors(table(spark, sf, "benchmark"))
    dense = ret.dense_topk(docs, "doc_id", "v", asked, "item_id", "v", ret.FUSION_DEPTH)
    lists = [dense, lexical(spark, sf, ret.FUSION_DEPTH)]
    return ret.fuse_ranks(lists).withColumn("score", F.round("score", 6))


HEAD, _REST = ret.RAG_PROMPT.split("{context_str}")
MIDDLE, TAIL = _REST.split("{query_str}")


@query(
    "rag_context_prompt",
    f"""WITH {BM25_SQL}, c AS (SELECT query_id, string_agg('[' || rank || ']' || chr(9) || ' "' || text || '"', chr(10) ORDER BY rank) AS ctx
  FROM lex JOIN documents USING (doc_id) GROUP BY query_id)
SELECT item_id AS query_id, CASE WHEN ctx IS NULL THEN '{ret.NO_HITS}' ELSE
  {sql_text(HEAD)} || left(ctx, {2048 - len(ret.RAG_PROMPT)}) || {sql_text(MIDDLE)} || text || {sql_text(TAIL)} END AS prompt
FROM benchmark LEFT JOIN c ON query_id = item_id""",
)
def rag_context_prompt(spark, sf):
    asked, docs = table(spark, sf, "benchmark"), table(spark, sf, "documents")
    return ret.context_prompts(asked, "item_id", "text", lexical(spark, sf), docs, "doc_id", "text")
