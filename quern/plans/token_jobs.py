"""Queries for vocabularies, encoding, truncation and packing."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions.text import nfkc, tokens
from quern.operators import filters
from quern.operators import tokens as tok
from quern.operators.ordering import dense_runs
from quern.plans.dialogs import RENDERED_SQL, rendered_dialogs
from quern.plans.fixtures import sql_tokens
from quern.plans.registry import query, spread_table
from quern.session import ensure_checkpoint_dir, scratch_dir

COUNTS_SQL = f"counts AS (SELECT piece, count(*) AS freq FROM (SELECT unnest({sql_tokens('text')}) AS piece FROM documents) GROUP BY piece)"
VOCAB_SQL = f"""{COUNTS_SQL},
vocab AS (SELECT (row_number() OVER (ORDER BY freq DESC, piece) + 3)::INTEGER AS id, piece, freq FROM counts ORDER BY freq DESC, piece LIMIT {tok.VOCAB_SIZE})"""
ENC_SQL = f"""{VOCAB_SQL},
toks AS (SELECT doc_id, unnest(t) AS piece, generate_subscripts(t, 1) AS pos FROM (SELECT doc_id, {sql_tokens('text')} AS t FROM documents)),
enc AS (SELECT doc_id, pos, coalesce(id, 0)::INTEGER AS id FROM toks LEFT JOIN vocab USING (piece)),
docs AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS idx, coalesce(ids, []) AS ids FROM documents
  LEFT JOIN (SELECT doc_id, list(id ORDER BY pos) AS ids FROM enc GROUP BY doc_id) USING (doc_id))"""


def corpus(spark, sf):
    return spread_table(spark, sf, "documents", "doc_id")


def vocabulary(spark, sf):
    return tok.build_vocab(tok.piece_counts(corpus(spark, sf)))


def encoded(spark, sf):
    docs = corpus(spark, sf).select("doc_id", "text")
    return tok.encode_column(docs, "text", vocabulary(spark, sf)).select("doc_id", "ids")


def total(c):
    return F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x)


@query("build_vocab", f"WITH {VOCAB_SQL} SELECT id, piece, freq FROM vocab")
def build_vocab(spark, sf):
    return vocabulary(spark, sf)


MERGES = 16


def merges_sql(rounds: int) -> str:
    """The rounds one after another, each over the words as the round before left them."""
    parts = [COUNTS_SQL, "w0 AS MATERIALIZED (SELECT ' ' || array_to_string(string_split(piece, ''), '  ') || ' ' AS w, freq FROM counts)"]
    for k in range(rounds):
        parts.append(f"""b{k} AS MATERIALIZED (SELECT s[i] AS a, s[i + 1] AS b, sum(freq)::BIGINT AS n
  FROM (SELECT freq, s, unnest(range(1, len(s))) AS i FROM (SELECT freq, string_split(trim(w, ' '), '  ') AS s FROM w{k})) GROUP BY ALL ORDER BY n DESC, a, b LIMIT 1)""")
        parts.append(f"w{k + 1} AS MATERIALIZED (SELECT replace(w, ' ' || a || '  ' || b || ' ', ' ' || a || b || ' ') AS w, freq FROM w{k}, b{k})")
    picks = " UNION ALL ".join(f"SELECT {k} AS round, a AS first, b AS second, n AS freq FROM b{k}" for k in range(rounds))
    return f"WITH {', '.join(parts)} {picks}"


@query("train_bpe_merges", merges_sql(MERGES))
def train_bpe_merges(spark, sf):
    return tok.train_bpe_merges(spark, tok.piece_counts(corpus(spark, sf)), MERGES)


MERGED_SQL = f"""c AS (SELECT lang, piece, count(*) AS freq FROM (SELECT lang, unnest({sql_tokens('text')}) AS piece FROM documents) GROUP BY ALL),
made AS (SELECT concat(chr((19968 + doc_id % 20992)::INTEGER), chr((19968 + doc_id * 7 % 20992)::INTEGER)) AS piece FROM documents),
u AS (SELECT piece, 0 AS stage, freq::DOUBLE AS score FROM c WHERE lang = 'en'
  UNION ALL SELECT piece, 1, NULL FROM c WHERE lang = 'fr'
  UNION ALL SELECT piece, 2, NULL FROM (SELECT piece FROM c WHERE lang = 'de' UNION ALL SELECT piece FROM made)
    WHERE regexp_matches(piece, '^[\\x{{4e00}}-\\x{{9fa5}}]*$')
  UNION ALL (SELECT piece, 3, NULL FROM c WHERE lang = 'es' ORDER BY freq DESC, piece LIMIT 20000)),
m AS (SELECT piece, min(stage) AS stage, CASE WHEN min(stage) = 0 THEN max(score) ELSE 0.0::DOUBLE END AS score FROM u GROUP BY piece),
merged AS (SELECT (row_number() OVER (ORDER BY stage, score DESC, piece) + 3)::INTEGER AS id, piece, stage, score FROM m)"""


@query("merge_vocab", f"WITH {MERGED_SQL} SELECT id, piece, stage, score FROM merged")
def merge_vocab(spark, sf, by_lang=None):
    docs = corpus(spark, sf)
    by_lang = tok.piece_counts(docs, by=["lang"]) if by_lang is None else by_lang

    def han(c):
        return F.decode(F.unhex(F.lpad(F.hex(F.lit(19968) + c % 20992), 4, "0")), "UTF-16BE")

    def counts(lang):
        return by_lang.where(F.col("lang") == lang).select("piece", "freq")

    made = docs.select(F.concat(han(F.col("doc_id")), han(F.col("doc_id") * 7)).alias("piece"))
    listed = counts("de").select("piece").unionByName(made)
    base = counts("en").select("piece", F.col("freq").alias("score"))
    return tok.merge_vocab(base, counts("fr"), listed, counts("es"))


@query(
    "encode_merged",
    f"""WITH {MERGED_SQL}, w AS (SELECT doc_id, unnest({sql_tokens('text')}) AS piece FROM documents)
SELECT doc_id, count(w.piece) AS n, coalesce(sum(coalesce(id, 0)) FILTER (w.piece IS NOT NULL), 0)::BIGINT AS id_sum, count(CASE WHEN stage > 0 THEN 1 END) AS n_added
FROM documents LEFT JOIN w USING (doc_id) LEFT JOIN merged USING (piece) GROUP BY doc_id""",
)
def encode_merged(spark, sf):
    ensure_checkpoint_dir(spark)
    by_lang = tok.piece_counts(corpus(spark, sf), by=["lang"]).checkpoint()
    merged = merge_vocab(spark, sf, by_lang).checkpoint()
    first_added = merged.where("stage > 0").select(F.min("id")).scalar()
    counts = by_lang.groupBy("piece").agg(F.sum("freq").alias("freq"))
    ids = tok.encode_joined(corpus(spark, sf).select("doc_id", "text"), "doc_id", "text", merged, counts=counts, keep=[])
    ids = ids.withColumn("_first", first_added)
    added = F.size(F.filter("ids", lambda i: i >= F.col("_first")))
    return ids.select("doc_id", F.size("ids").cast("bigint").alias("n"), total(F.col("ids")).alias("id_sum"), added.cast("bigint").alias("n_added"))


@query(
    "encode_tokens",
    f"""WITH {ENC_SQL} SELECT doc_id, len(ids)::INTEGER AS n, list_sum(ids)::BIGINT AS id_sum, array_to_string(ids, ' ') AS ids FROM docs""",
)
def encode_tokens(spark, sf):
    return encoded(spark, sf).select(
        "doc_id", F.size("ids").alias("n"), total(F.col("ids")).alias("id_sum"), F.array_join("ids", " ").alias("ids")
    )


# Some dialogs get a prompt that fills the width and an empty answer, so that their first pair does not fit.
LONG = "conv_id % 17 = 3"
SFT_SQL = f"""WITH d AS (WITH {RENDERED_SQL} SELECT conv_id, pair_idx, CASE WHEN {LONG} THEN repeat(prompt_text, 60) ELSE prompt_text END AS prompt_text,
  CASE WHEN {LONG} THEN '' ELSE response END AS response FROM rendered), {VOCAB_SQL},
sides AS (SELECT conv_id, pair_idx, 's' AS side, {sql_tokens('prompt_text')} AS t FROM d UNION ALL SELECT conv_id, pair_idx, 't', {sql_tokens('response')} FROM d),
tk AS (SELECT conv_id, pair_idx, side, unnest(t) AS piece, generate_subscripts(t, 1) AS pos FROM sides),
ids AS (SELECT conv_id, pair_idx, side, list(coalesce(id, 0) ORDER BY pos) AS ids FROM tk LEFT JOIN vocab USING (piece) GROUP BY ALL),
both_ AS (SELECT d.conv_id, d.pair_idx, list_concat(CASE WHEN d.pair_idx = 0 THEN [1] ELSE [] END, coalesce(a.ids, [])) AS s, coalesce(b.ids, []) AS t FROM d
  LEFT JOIN ids a ON a.conv_id = d.conv_id AND a.pair_idx = d.pair_idx AND a.side = 's'
  LEFT JOIN ids b ON b.conv_id = d.conv_id AND b.pair_idx = d.pair_idx AND b.side = 't'),
lim AS (SELECT *, len(s) + len(t) AS tot, trunc(512::DOUBLE * (len(s)::DOUBLE / (len(s) + len(t))))::INTEGER AS ms,
  trunc(512::DOUBLE * (len(t)::DOUBLE / (len(s) + len(t))))::INTEGER - 1 AS mt FROM both_),
cutp AS (SELECT conv_id, pair_idx, CASE WHEN len(s) > ms THEN s[:ms] ELSE s END AS s,
  CASE WHEN len(t) > mt THEN CASE WHEN mt >= 0 THEN list_slice(t, 1, mt) ELSE list_slice(t, 1, greatest(len(t) + mt, 0)) END ELSE t END AS t FROM lim),
run AS (SELECT *, sum(len(s) + len(t) + 1) OVER (PARTITION BY conv_id ORDER BY pair_idx) AS used FROM cutp),
sft AS (SELECT conv_id, coalesce(flatten(list(list_concat(s, t, [2]) ORDER BY pair_idx) FILTER (used <= 512)), []) AS input_ids,
  coalesce(flatten(list(list_concat(list_transform(s, lambda x: -100), t, [2]) ORDER BY pair_idx) FILTER (used <= 512)), []) AS labels FROM run GROUP BY conv_id)"""


def sft_rows(spark, sf):
    long = F.expr(LONG)
    prompt = F.when(long, F.repeat("prompt_text", F.lit(60))).otherwise(F.col("prompt_text"))
    answer = F.when(long, "").otherwise(F.col("response"))
    pairs = rendered_dialogs(spark, sf).select("conv_id", "pair_idx", prompt.alias("prompt_text"), answer.alias("response"))
    vocab = vocabulary(spark, sf)
    rows = tok.encode_columns(pairs, {"_s": "prompt_text", "t": "response"}, vocab)
    opened = F.when(F.col("pair_idx") == 0, F.concat(F.array(F.lit(tok.BOS)), "_s")).otherwise(F.col("_s"))
    return tok.encode_dialogs(rows.withColumn("s", opened), "s", "t", 512)


@query(
    "encode_sft",
    f"""{SFT_SQL} SELECT conv_id, len(input_ids)::INTEGER AS n, coalesce(list_sum(input_ids), 0)::BIGINT AS id_sum, coalesce(list_sum(labels), 0)::BIGINT AS label_sum,
array_to_string(labels, ' ') AS labels FROM sft""",
)
def encode_sft(spark, sf):
    return sft_rows(spark, sf).select(
        "conv_id", F.size("input_ids").alias("n"), total(F.col("input_ids")).alias("id_sum"),
        total(F.col("labels")).alias("label_sum"), F.array_join("labels", " ").alias("labels"),
    )


@query(
    "filter_all_ignored",
    f"{SFT_SQL} SELECT conv_id FROM (SELECT conv_id, CASE WHEN conv_id % 3 = 0 THEN list_transform(labels, lambda x: -100) ELSE labels END AS labels FROM sft) "
    "WHERE len(list_filter(labels, lambda x: x <> -100)) > 0",
)
def filter_all_ignored(spark, sf):
    hidden = F.when(F.col("conv_id") % 3 == 0, F.transform("labels", lambda x: F.lit(filters.IGNORE))).otherwise(F.col("labels"))
    return sft_rows(spark, sf).withColumn("labels", hidden).where(filters.has_label(F.col("labels"))).select("conv_id")


@query(
    "encode_byte_fallback",
    f"""WITH {COUNTS_SQL}, vocab AS (SELECT (row_number() OVER (ORDER BY freq DESC, piece) + 259)::INTEGER AS id, piece FROM counts ORDER BY freq DESC, piece LIMIT 500),
w AS (SELECT doc_id, unnest({sql_tokens('text')}) AS piece FROM documents),
e AS (SELECT doc_id, CASE WHEN id IS NULL THEN octet_length(encode(piece)) ELSE 1 END AS n,
  coalesce(id, list_sum(list_transform(range(octet_length(encode(piece))), lambda i: CAST('0x' || substr(hex(encode(piece)), CAST(2 * i + 1 AS INT), 2) AS BIGINT) + 4))) AS s
  FROM w LEFT JOIN vocab USING (piece))
SELECT doc_id, coalesce(sum(n), 0)::BIGINT AS n, coalesce(sum(s), 0)::BIGINT AS id_sum FROM documents LEFT JOIN e USING (doc_id) GROUP BY doc_id""",
)
def encode_byte_fallback(spark, sf):
    """A small vocabulary over texts in compatibility form; tokens outside it become bytes."""
    docs = corpus(spark, sf).select("doc_id", nfkc(F.col("text")).alias("text"))
    vocab = tok.build_vocab(tok.piece_counts(corpus(spark, sf), normalize=True), 500, byte_fallback=True)
    rows = docs.withColumn("_table", tok.lookup_table(vocab)).select("doc_id", tok.encode_or_bytes(tokens(F.col("text")), F.col("_table")).alias("ids"))
    return rows.select("doc_id", F.size("ids").cast("bigint").alias("n"), total(F.col("ids")).alias("id_sum"))


@query(
    "encode_fixed_pad",
    f"""WITH {ENC_SQL}, c AS (SELECT doc_id, ids[:128] AS c FROM docs),
p AS (SELECT doc_id, len(c)::INTEGER AS n_real, list_concat(c, list_transform(range(128 - len(c)), lambda x: 3)) AS p FROM c)
SELECT doc_id, n_real, len(p)::INTEGER AS n, list_sum(p)::BIGINT AS id_sum, list_sum(p)::BIGINT AS label_sum, p[128]::INTEGER AS last_id FROM p""",
)
def encode_fixed_pad(spark, sf):
    rows = encoded(spark, sf).withColumn("p", tok.pad_fixed(F.col("ids"), 128))
    rows = rows.withColumn("labels", F.col("p"))
    return rows.select(
        "doc_id", F.least(F.size("ids"), F.lit(128)).alias("n_real"), F.size("p").alias("n"), total(F.col("p")).alias("id_sum"),
        total(F.col("labels")).alias("label_sum"), F.get("p", F.lit(127)).alias("last_id"),
    )


def pack_sql(rows: str, block: int) -> str:
    """Oracle of the packing over ``src(grp, idx, ids)``."""
    return f"""{ENC_SQL}, src AS ({rows}),
flat AS (SELECT grp, idx, unnest(ids) AS id, generate_subscripts(ids, 1) AS pos FROM src),
off AS (SELECT grp, id, row_number() OVER (PARTITION BY grp ORDER BY idx, pos) - 1 AS o, count(*) OVER (PARTITION BY grp) AS total FROM flat),
blk AS (SELECT grp, o // {block} AS block, list(id ORDER BY o) AS ids FROM off WHERE (o // {block} + 1) * {block} <= total OR total < {block} GROUP BY ALL)"""


PACKED_SQL = (
    "WITH " + pack_sql("SELECT idx // 100 AS grp, idx, list_append(ids, 2) AS ids FROM docs", 256)
    + " SELECT grp AS pack_group, block, len(ids)::INTEGER AS n, list_sum(ids)::BIGINT AS id_sum, md5(array_to_string(ids, ' ')) AS digest FROM blk"
)


@query("pack_eos_blocks", PACKED_SQL)
def pack_eos_blocks(spark, sf):
    return block_digests(tok.pack_eos_blocks(tok.pack_groups(encoded(spark, sf), "doc_id", 100), "ids", 256))


def block_digests(blocks):
    return blocks.select(
        "pack_group", "block", F.size("input_ids").alias("n"), total(F.col("input_ids")).alias("id_sum"),
        F.md5(F.array_join("input_ids", " ")).alias("digest"),
    )


@query(
    "pack_boundary_blocks",
    "WITH " + pack_sql("SELECT idx // 100 AS grp, idx, list_slice(ids, 2, len(ids) - 1) AS ids FROM docs", 254)
    + """, first_ AS (SELECT idx // 100 AS grp, arg_min(ids[1], idx) AS a, arg_min(ids[-1], idx) AS z FROM docs GROUP BY 1),
w AS (SELECT grp, block, list_concat([a], ids, [z]) AS ids FROM blk JOIN first_ USING (grp))
SELECT grp AS pack_group, block, len(ids)::INTEGER AS n, md5(array_to_string(ids, ' ')) AS digest FROM w""",
)
def pack_boundary_blocks(spark, sf):
    blocks = tok.pack_boundary_blocks(tok.pack_groups(encoded(spark, sf), "doc_id", 100), "ids", 256)
    return blocks.select(
        "pack_group", "block", F.size("input_ids").alias("n"), F.md5(F.array_join("input_ids", " ")).alias("digest")
    )


@query(
    "pad_batch",
    f"""WITH {ENC_SQL}, b AS (SELECT doc_id, ids, idx // 8 AS batch_id FROM docs),
w AS (SELECT *, (ceil(max(len(ids)) OVER (PARTITION BY batch_id) / 4) * 4)::INTEGER AS width FROM b)
SELECT doc_id, batch_id, width, (width - len(ids))::INTEGER AS n_pad, (list_sum(ids) + 3 * (width - len(ids)))::BIGINT AS id_sum,
(list_sum(ids) - 100 * (width - len(ids)))::BIGINT AS label_sum, len(ids)::BIGINT AS mask_sum FROM w""",
)
def pad_batch(spark, sf):
    rows = dense_runs(encoded(spark, sf), "doc_id", 8, run="batch_id")
    rows = rows.withColumn("n", F.size("ids")).withColumn("labels", F.col("ids"))
    out = tok.pad_batches(rows, ["part", "batch_id"], "ids", "labels")
    return out.select(
        "doc_id", "batch_id", "width", (F.size("ids") - F.col("n")).alias("n_pad"), total(F.col("ids")).alias("id_sum"),
        total(F.col("labels")).alias("label_sum"), total(F.col("attention_mask")).alias("mask_sum"),
    )


@query(
    "length_percentiles",
    f"""WITH l AS (SELECT len({sql_tokens('text')}) AS n FROM documents)
SELECT quantile_cont(n, 0.5)::DOUBLE AS p50, quantile_cont(n, 0.9)::DOUBLE AS p90, max(n)::INTEGER AS longest,
round(avg((n <= 1024)::INTEGER), 6) AS within_1024, round(avg((n <= 2048)::INTEGER), 6) AS within_2048 FROM l""",
)
def length_percentiles(spark, sf):
    rows = corpus(spark, sf).select(F.size(tokens(F.col("text"))).alias("n"))
    return tok.length_profile(rows, "n", [1024, 2048])


@query("length_sketches", "SELECT count(*) AS n, TRUE AS p50_near, TRUE AS p90_near FROM documents")
def length_sketches(spark, sf):
    """Stored sketches per source, merged, and whether the ranks of their percentiles are as near as they promise."""
    rows = corpus(spark, sf).select("source", F.size(tokens(F.col("text"))).alias("n_tokens"))
    path = scratch_dir(spark, "length-sketches")
    tok.length_sketches(rows, "n_tokens", ["source"]).write.parquet(path)
    found = tok.merged_profile(spark.read.parquet(path), [0.5, 0.9])
    lengths = rows.crossJoin(F.broadcast(found))  # one row

    def near(q: float, at: str):
        # equal lengths hold a range of ranks; the wanted one must lie in it or within the error of it
        below, upto = (F.avg(c.cast("double")) for c in (F.col("n_tokens") < F.col(at), F.col("n_tokens") <= F.col(at)))
        return (below - tok.SKETCH_ERROR <= q) & (upto + tok.SKETCH_ERROR >= q)

    return lengths.groupBy("n").agg(near(0.5, "q_50").alias("p50_near"), near(0.9, "q_90").alias("p90_near"))


@query(
    "left_truncate_context",
    f"""WITH {ENC_SQL}, t AS (SELECT doc_id, list_slice(ids, greatest(len(ids) - 120, 0) + 1, len(ids)) AS t FROM docs)
SELECT doc_id, len(t)::INTEGER AS n, array_to_string(t, ' ') AS ids FROM t""",
)
def left_truncate_context(spark, sf):
    rows = encoded(spark, sf).withColumn("t", tok.left_truncate(F.col("ids"), 256, 128))
    return rows.select("doc_id", F.size("t").alias("n"), F.array_join("t", " ").alias("ids"))


SHIFT_SQL = f"""{ENC_SQL}, nx AS (SELECT doc_id, pos, id, lead(id) OVER (PARTITION BY doc_id ORDER BY pos) AS y FROM enc),
al AS (SELECT doc_id, CASE WHEN pos % 3 = 0 THEN id ELSE y END AS p, y FROM nx WHERE y IS NOT NULL)"""


def shifted(spark, sf):
    """Stand-in predictions: right (the next token) except at every third place."""
    rows = encoded(spark, sf)
    preds = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("ids"), F.lit(1))),
        lambda i: F.when(i % 3 == 0, F.get("ids", i - 1)).otherwise(F.coalesce(F.get("ids", i), F.lit(0))),
    )
    return rows.withColumn("q", tok.shift_pairs(preds, F.col("ids")))


@query(
    "next_token_shift",
    f"""WITH {SHIFT_SQL} SELECT doc_id, count(p)::INTEGER AS n, count(CASE WHEN p = y THEN 1 END)::INTEGER AS hits,
coalesce(sum(p), 0)::BIGINT AS pred_sum, coalesce(sum(y), 0)::BIGINT AS label_sum FROM documents LEFT JOIN al USING (doc_id) GROUP BY doc_id""",
)
def next_token_shift(spark, sf):
    return shifted(spark, sf).select(
        "doc_id", F.size("q").alias("n"), F.size(F.filter("q", lambda x: x["pred"] == x["label"])).alias("hits"),
        total(F.transform("q", lambda x: x["pred"])).alias("pred_sum"), total(F.transform("q", lambda x: x["label"])).alias("label_sum"),
    )
