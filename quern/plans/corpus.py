"""Queries for sources, sinks, conversions, filters and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions.text import all_cjk, has_cjk, strip, tokens
from quern.operators import convert, filters, sampling
from quern.operators.ordering import dense_index
from quern.operators.roleplay import role_prompt
from quern.plans.fixtures import (
    JSON_SQL,
    QA_SQL,
    flat_chat,
    json_lines,
    qa_pairs,
    sql_hash,
    sql_strip,
    sql_tokens,
)
from quern.plans.registry import query, spread_table, sql_text, table
from quern.session import scratch_dir
from quern.sources import readers, writers
from quern.streaming import jobs

MATH_SQL = sql_text("|".join(filters.MATH_PATTERNS))
KEPT_SQL = f"""kept AS (
  SELECT doc_id, text, length(text) AS n, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents
  WHERE text IS NOT NULL AND text <> '' AND length(text) BETWEEN 500 AND 8000 AND regexp_matches(text, {MATH_SQL}))"""


def split_sql(src: str) -> str:
    """CTEs ``win``, ``hits`` and ``cut`` computing the split point of ``src(doc_id, text)``."""
    return f"""win AS (SELECT *, trunc(length(text) * 0.1::DOUBLE)::BIGINT AS lo,
         trunc(length(text) * 0.4::DOUBLE)::BIGINT AS hi FROM {src}),
hits AS (SELECT *,
  instr(substr(text, lo + 1), chr(10) || chr(10)) AS para,
  instr(substr(text, lo + 1), '. ') AS dot1, instr(substr(text, lo + 1), '.' || chr(10)) AS dot2,
  instr(substr(text, lo + 1), chr(10)) AS nl FROM win),
cut AS (SELECT *, coalesce(
  CASE WHEN para > 0 AND lo + para - 1 < hi THEN lo + para - 1 END,
  least(CASE WHEN dot1 > 0 AND lo + dot1 - 1 < hi THEN lo + dot1 END,
        CASE WHEN dot2 > 0 AND lo + dot2 - 1 < hi THEN lo + dot2 END),
  CASE WHEN nl > 0 AND lo + nl - 1 < hi THEN lo + nl - 1 END) AS nat FROM hits),
cuts AS (SELECT *, coalesce(nat, greatest(100, trunc(length(text) * 0.2::DOUBLE)::BIGINT)) AS cut_at FROM cut)"""


TEMPLATES_SQL = "[" + ", ".join(sql_text(t) for t in convert.WEB_TEMPLATES) + "]"


# ---------------------------------------------------------------- sources


@query("src_jsonl_dir", "SELECT conv_id, turn, role, text FROM conversations")
def src_jsonl_dir(spark, sf):
    path = scratch_dir(spark, "jsonl")
    conv = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    writers.write_jsonl(conv, f"{path}/deep/er")
    return readers.read_jsonl_dir(spark, path, "conv_id bigint, turn bigint, role string, text string")


@query(
    "src_text_lines",
    "SELECT line || chr(10) AS line, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line "
    "FROM documents) GROUP BY ALL",
)
def src_text_lines(spark, sf):
    path = scratch_dir(spark, "text")
    table(spark, sf, "documents").select("text").write.option("lineSep", "\n").text(path)
    lines = readers.read_text_lines(spark, path, keep_linebreaks=True)
    return lines.groupBy(F.col("text").alias("line")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "src_tsv_named",
    f"WITH {QA_SQL} SELECT replace(input, chr(10), ' ') AS input, replace(output, chr(10), ' ') AS output FROM qa",
)
def src_tsv_named(spark, sf):
    path = scratch_dir(spark, "tsv")
    flat = [F.regexp_replace(c, "\n", " ").alias(c) for c in ("input", "output")]
    out = qa_pairs(spark, sf).select(*flat).write.option("sep", "\t").option("quoteAll", True)
    out.option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return readers.read_named_tsv(spark, path, "qa")


@query("src_type_guard", "SELECT 'parquet' AS extension, count(*) AS n_rows FROM documents")
def src_type_guard(spark, sf):
    docs = readers.require_single_extension(table(spark, sf, "documents"))
    return readers.extension_counts(docs)


TOKEN_COUNTS_SQL = f"SELECT word, count(*) AS freq FROM (SELECT unnest({sql_tokens('text')}) AS word FROM documents) GROUP BY word"


@query(
    "src_vocab_lists",
    f"""SELECT 'list' AS kind, word, 0::BIGINT AS freq FROM (
  SELECT DISTINCT regexp_extract({sql_strip('line')}, '^[^ \\t\\n\\f\\r\\v]+') AS word
  FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) WHERE {sql_strip('line')} <> '')
UNION ALL SELECT 'freq', word, freq FROM ({TOKEN_COUNTS_SQL})""",
)
def src_vocab_lists(spark, sf):
    docs = spread_table(spark, sf, "documents", "doc_id")
    listed = scratch_dir(spark, "vocab")
    docs.select("text").write.option("lineSep", "\n").text(listed)
    counted = scratch_dir(spark, "freq")
    counts = docs.select(F.explode(tokens(F.col("text"))).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    counts.select(F.concat_ws(" ", "w", F.col("n").cast("string"), F.lit("x"))).write.text(counted)
    words = readers.first_words(readers.read_text_lines(spark, listed, False))
    freqs = readers.word_frequencies(readers.read_text_lines(spark, counted, False))
    return words.select(F.lit("list").alias("kind"), "word", F.lit(0).cast("bigint").alias("freq")).unionByName(
        freqs.select(F.lit("freq").alias("kind"), "word", "freq")
    )


def _html_sql(e: str) -> str:
    for pat in ("(?s)<!--.*?-->", r"(?is)<script\b.*?</script>", r"(?is)<style\b.*?</style>", "(?s)<[^>]*>"):
        e = f"regexp_replace({e}, {sql_text(pat)}, '', 'g')"
    for ref, char in (("&nbsp;", "chr(160)"), ("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&#39;", "''''"), ("&amp;", "'&'")):
        e = f"replace({e}, '{ref}', {char})"
    return e


@query(
    "src_doc_lines",
    f"""WITH t AS (SELECT page_id, {_html_sql('html')} AS t FROM pages),
l AS (SELECT page_id, list_filter(list_transform(string_split(t, chr(10)), lambda x: {sql_strip('x')}), lambda x: x <> '') AS l FROM t)
SELECT page_id, len(l)::BIGINT AS n_lines, array_to_string(l, chr(10)) AS text FROM l""",
)
def src_doc_lines(spark, sf):
    text = readers.document_lines(readers.html_text(F.col("html")))
    out = spread_table(spark, sf, "pages", "page_id").select("page_id", text.alias("text"))
    n = F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n")))
    return out.withColumn("n_lines", n.cast("bigint"))


@query(
    "src_prompt_lines",
    f"""SELECT item_id, line_no - 1 AS line_no, {sql_strip('line')} AS prompt FROM benchmark,
unnest(string_split(text, chr(10))) WITH ORDINALITY AS u(line, line_no)""",
)
def src_prompt_lines(spark, sf):
    return readers.prompt_lines(table(spark, sf, "benchmark"), "item_id", "text")


@query(
    "file_fingerprint",
    "SELECT doc_id, md5(array_slice(encode(text), 1, 1048576)) AS fingerprint FROM documents",
)
def file_fingerprint(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", readers.fingerprint(F.col("text").cast("binary")).alias("fingerprint"))


@query(
    "file_set_fingerprint",
    "SELECT md5(string_agg(left(text, 1048576), '' ORDER BY doc_id)) AS fingerprint, count(*) AS n FROM documents",
)
def file_set_fingerprint(spark, sf):
    return readers.set_fingerprint(table(spark, sf, "documents"), "doc_id", "text")


@query("src_stream_text", f"SELECT doc_id, {sql_strip('text')} AS text FROM documents WHERE text IS NOT NULL AND text <> ''")
def src_stream_text(spark, sf):
    return jobs.stream_text(spark, sf)


# ---------------------------------------------------------------- sinks


@query(
    "sink_jsonl",
    f"""WITH {QA_SQL} SELECT conv_id, turn, CAST(NULL AS VARCHAR) AS system_prompt, 0::BIGINT AS pos, 'human' AS from_role, input AS value FROM qa
UNION ALL SELECT conv_id, turn, NULL, 1, 'gpt', output FROM qa""",
)
def sink_jsonl(spark, sf):
    path = scratch_dir(spark, "chat")
    chat = convert.qa_to_chat(qa_pairs(spark, sf).drop("prev")).withColumn("system_prompt", F.lit(None).cast("string"))
    writers.write_jsonl(chat, path)
    schema = "conv_id bigint, turn bigint, conversations array<struct<`from`: string, value: string>>, system_prompt string"
    return flat_chat(readers.read_jsonl_dir(spark, path, schema))


@query("sink_overwrite_or_append", "SELECT role, count(*) AS n, count(DISTINCT (conv_id, turn)) AS n_keys FROM conversations GROUP BY role")
def sink_overwrite_or_append(spark, sf):
    path = scratch_dir(spark, "results")
    conv = table(spark, sf, "conversations")
    asked = conv.where(F.col("role") == "user")
    writers.write_results(conv, path, resume=False)
    writers.write_results(asked, path, resume=False)  # a fresh run replaces what was there
    rest = conv.join(asked.select("conv_id", "turn"), ["conv_id", "turn"], "left_anti")
    writers.write_results(rest, path, resume=True)
    back = readers.read_jsonl_dir(spark, path, "conv_id bigint, turn bigint, role string, text string")
    return back.groupBy("role").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("conv_id", "turn").alias("n_keys"))


# ---------------------------------------------------------------- conversions


@query(
    "alpaca_to_chat",
    f"""WITH {QA_SQL}, t AS (SELECT conv_id, turn, input AS instruction, output,
  CASE conv_id % 3 WHEN 0 THEN prev WHEN 1 THEN '  ' || chr(9) END AS input FROM qa)
SELECT conv_id, turn, 0::BIGINT AS pos, 'human' AS from_role,
  CASE WHEN input IS NOT NULL AND {sql_strip('input')} <> '' THEN instruction || chr(10) || chr(10) || input ELSE instruction END AS value FROM t
UNION ALL SELECT conv_id, turn, 1, 'gpt', output FROM t""",
)
def alpaca_to_chat(spark, sf):
    kind = F.pmod("conv_id", F.lit(3))
    extra = F.when(kind == 0, F.col("prev")).when(kind == 1, F.lit("  \t"))
    rows = qa_pairs(spark, sf).select("conv_id", "turn", F.col("input").alias("instruction"), extra.alias("input"), "output")
    return flat_chat(convert.alpaca_to_chat(rows))


@query(
    "qa_to_chat",
    f"""WITH {QA_SQL} SELECT conv_id, turn, 0::BIGINT AS pos, 'human' AS from_role, input AS value FROM qa
UNION ALL SELECT conv_id, turn, 1, 'gpt', output FROM qa""",
)
def qa_to_chat(spark, sf):
    return flat_chat(convert.qa_to_chat(qa_pairs(spark, sf).drop("prev")))


@query(
    "sharegpt_project",
    f"""WITH {QA_SQL} SELECT pos, from_role, value, count(*) AS n FROM (
  SELECT 0::BIGINT AS pos, 'human' AS from_role, input AS value FROM qa UNION ALL SELECT 1, 'gpt', output FROM qa) GROUP BY ALL""",
)
def sharegpt_project(spark, sf):
    rows = convert.qa_to_chat(qa_pairs(spark, sf)).withColumnRenamed("conversations", "items")
    flat = flat_chat(convert.chat_project(rows))
    return flat.groupBy("pos", "from_role", "value").agg(F.count(F.lit(1)).alias("n"))


@query(
    "cot_to_chat",
    f"""WITH {QA_SQL}, t AS (SELECT input AS problem, CASE WHEN conv_id % 4 = 0 THEN '' ELSE output END AS solution,
  row_number() OVER (ORDER BY conv_id, turn) - 1 AS idx FROM qa)
SELECT 'cot-' || idx AS id, 0::BIGINT AS pos, 'human' AS from_role, problem || ' ' || {sql_text(convert.COT_INSTRUCTION)} AS value FROM t
UNION ALL SELECT 'cot-' || idx, 1, 'gpt', CASE WHEN coalesce(solution, '') = '' THEN {sql_text(convert.NO_SOLUTION)} ELSE solution END FROM t""",
)
def cot_to_chat(spark, sf):
    solution = F.when(F.col("conv_id") % 4 == 0, "").otherwise(F.col("output"))
    key = F.col("conv_id") * 1000000 + F.col("turn")
    rows = qa_pairs(spark, sf).select(key.alias("key"), F.col("input").alias("problem"), solution.alias("solution"))
    return flat_chat(convert.cot_to_chat(rows, "key", "cot"))


@query(
    "web_math_to_chat",
    f"""WITH {KEPT_SQL}, {split_sql('kept')}
SELECT '{convert.WEB_ID_PREFIX}' || idx AS id,
  replace({TEMPLATES_SQL}[(idx % 5) + 1], '{{context}}', {sql_strip('left(text, cut_at)')}) AS human,
  {sql_strip('text')} AS gpt FROM cuts""",
)
def web_math_to_chat(spark, sf):
    return convert.web_math_to_chat(table(spark, sf, "documents"))


@query(
    "natural_split_point",
    f"""WITH d AS (SELECT doc_id, text FROM documents), {split_sql('d')}
SELECT doc_id, nat IS NOT NULL AS is_natural, cut_at::INTEGER AS cut, md5(left(text, cut_at)) AS context_md5 FROM cuts""",
)
def natural_split_point(spark, sf):
    docs = table(spark, sf, "documents")
    at = convert.natural_split_point(F.col("text"))
    cut = convert.context_cut(F.col("text"))
    out = docs.select("doc_id", "text", at.isNotNull().alias("is_natural"), cut.alias("cut"))
    return out.select("doc_id", "is_natural", "cut", F.md5(F.substr("text", F.lit(1), "cut")).alias("context_md5"))


@query(
    "rotate_prompt_template",
    f"""WITH t AS (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents)
SELECT doc_id, idx, replace({TEMPLATES_SQL}[(idx % 5) + 1], '{{context}}', {sql_strip('text')}) AS prompt FROM t""",
)
def rotate_prompt_template(spark, sf):
    rows = dense_index(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    return rows.select("doc_id", "idx", convert.rotated_prompt(F.col("idx"), strip(F.col("text"))).alias("prompt"))


# ---------------------------------------------------------------- filters


@query("filter_length", "SELECT doc_id FROM documents WHERE length(text) BETWEEN 500 AND 8000")
def filter_length(spark, sf):
    return table(spark, sf, "documents").where(filters.length_between(F.col("text"), 500, 8000)).select("doc_id")


@query("filter_math", f"SELECT doc_id FROM documents WHERE regexp_matches(text, {MATH_SQL})")
def filter_math(spark, sf):
    return table(spark, sf, "documents").where(filters.has_math(F.col("text"))).select("doc_id")


@query("filter_nonempty", "SELECT doc_id FROM documents WHERE text IS NOT NULL AND text <> ''")
def filter_nonempty(spark, sf):
    return table(spark, sf, "documents").where(filters.non_empty(F.col("text"))).select("doc_id")


@query(
    "validate_chat_jsonl",
    f"WITH {JSON_SQL} SELECT conv_id, turn, len(reasons) = 0 AS valid, array_to_string(reasons, ',') AS reasons FROM checked",
)
def validate_chat_jsonl(spark, sf):
    checked = filters.validate_chat_lines(json_lines(spark, sf), "line")
    return checked.select("conv_id", "turn", "valid", F.array_join("reasons", ",").alias("reasons"))


@query(
    "validate_summary",
    f"""WITH {JSON_SQL} SELECT 'total' AS measure, count(*) AS n FROM checked
UNION ALL SELECT CASE WHEN len(reasons) = 0 THEN 'valid' ELSE 'invalid' END, count(*) FROM checked GROUP BY 1
UNION ALL SELECT 'reason:' || r, count(*) FROM (SELECT unnest(reasons) AS r FROM checked) GROUP BY 1""",
)
def validate_summary(spark, sf):
    return filters.validation_summary(filters.validate_chat_lines(json_lines(spark, sf), "line"))


@query(
    "select_row_range",
    "SELECT doc_id, idx FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents) WHERE idx >= 50 AND idx < 150",
)
def select_row_range(spark, sf):
    rows = dense_index(table(spark, sf, "documents").select("doc_id"), "doc_id")
    return filters.select_range(rows, "idx", 50, 150)


@query(
    "is_cjk",
    r"""SELECT regexp_matches(word, '^[\x{4e00}-\x{9fa5}]*$') AS vocab_cjk, regexp_matches(word, '[\x{4e00}-\x{9fff}]') AS has_cjk,
count(*) AS n, sum(length(word))::BIGINT AS n_chars FROM (
  SELECT unnest(string_split(text, ' ')) AS word FROM documents UNION ALL
  SELECT concat(chr((19968 + doc_id % 20992)::INTEGER), chr((19968 + doc_id * 7 % 20992)::INTEGER)) FROM documents) GROUP BY ALL""",
)
def is_cjk(spark, sf):
    docs = spread_table(spark, sf, "documents", "doc_id")
    words = docs.select(F.explode(F.split("text", " ")).alias("word"))

    def han(c):  # one CJK character by its code point, through UTF-16
        cp = F.lit(19968) + c % 20992
        return F.decode(F.unhex(F.lpad(F.hex(cp), 4, "0")), "UTF-16BE")

    made = docs.select(F.concat(han(F.col("doc_id")), han(F.col("doc_id") * 7)).alias("word"))
    both = words.unionByName(made).select(
        all_cjk(F.col("word")).alias("vocab_cjk"), has_cjk(F.col("word")).alias("has_cjk"), F.length("word").alias("k")
    )
    return both.groupBy("vocab_cjk", "has_cjk").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("n_chars"))


# ---------------------------------------------------------------- sampling


@query("seeded_shuffle", f"SELECT doc_id, row_number() OVER (ORDER BY {sql_hash(42, 'doc_id')}, doc_id) - 1 AS shuffle_pos FROM documents")
def seeded_shuffle(spark, sf):
    return sampling.seeded_shuffle(table(spark, sf, "documents").select("doc_id"), "doc_id")


@query("buffered_shuffle", "SELECT doc_id FROM documents")
def buffered_shuffle(spark, sf):
    return sampling.buffered_shuffle(table(spark, sf, "documents").select("doc_id"), "doc_id")


@query(
    "split_head_percent",
    """SELECT doc_id, CASE WHEN rn <= floor(n * 1 / 100.0 + 0.5) THEN 'validation' ELSE 'train' END AS split
FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn, count(*) OVER () AS n FROM documents)""",
)
def split_head_percent(spark, sf):
    return sampling.split_head_percent(table(spark, sf, "documents").select("doc_id"), "doc_id", 1)


@query(
    "split_random_percent",
    f"""SELECT doc_id, CASE WHEN CAST('0x' || substr({sql_hash(42, 'doc_id')}, 1, 8) AS BIGINT) % 10000 < 200
THEN 'validation' ELSE 'train' END AS split FROM documents""",
)
def split_random_percent(spark, sf):
    return sampling.split_random_percent(table(spark, sf, "documents").select("doc_id"), "doc_id", 2.0)


@query(
    "split_tail_holdout",
    """SELECT doc_id, CASE WHEN rn > n - 100 THEN 'eval' ELSE 'train' END AS split
FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn, count(*) OVER () AS n FROM documents)""",
)
def split_tail_holdout(spark, sf):
    return sampling.split_tail_holdout(table(spark, sf, "documents").select("doc_id"), "doc_id")


@query(
    "cap_samples",
    f"""SELECT 'head' AS kind, doc_id FROM (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 100)
UNION ALL SELECT 'shuffled', doc_id FROM (SELECT doc_id FROM documents ORDER BY {sql_hash(42, 'doc_id')}, doc_id LIMIT 100)""",
)
def cap_samples(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id")
    head = sampling.cap_samples(docs, "doc_id", 100).select(F.lit("head").alias("kind"), "doc_id")
    return head.unionByName(sampling.shuffle_then_cap(docs, "doc_id", 100).select(F.lit("shuffled").alias("kind"), "doc_id"))


QUOTAS = {"en": 500, "fr": 150, "de": 100}
MIXED_SQL = f"""mixed AS (SELECT doc_id, lang, pick FROM (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {sql_hash(42, 'doc_id')}, doc_id) - 1 AS pick FROM documents)
  WHERE pick < CASE lang WHEN 'en' THEN 500 WHEN 'fr' THEN 150 WHEN 'de' THEN 100 ELSE 0 END)"""


@query("mix_sources", f"WITH {MIXED_SQL} SELECT doc_id, lang, pick FROM mixed")
def mix_sources(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return sampling.mix_sources(docs, "lang", "doc_id", QUOTAS)


@query(
    "mix_source_shares",
    f"WITH {MIXED_SQL} SELECT lang, count(*) AS n, round(count(*) / (SELECT count(*) FROM mixed), 6) AS share FROM mixed GROUP BY lang",
)
def mix_source_shares(spark, sf):
    return sampling.source_shares(mix_sources(spark, sf), "lang")


SCAN_SQL = f"""scan AS (SELECT doc_id, text, row_number() OVER (ORDER BY {sql_hash(42, 'doc_id')}, doc_id) - 1 AS scan_pos FROM documents),
taken AS (SELECT doc_id, scan_pos, row_number() OVER (ORDER BY scan_pos) - 1 AS pick FROM scan
  WHERE length(text) BETWEEN 500 AND 8000 ORDER BY scan_pos LIMIT 200)"""


@query("sample_until_quota", f"WITH {SCAN_SQL} SELECT doc_id, scan_pos, pick FROM taken")
def sample_until_quota(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.length("text").alias("n"))
    return sampling.sample_until_quota(docs, "doc_id", F.col("n").between(500, 8000), 200).drop("n")


@query(
    "progress_counters",
    f"""WITH {SCAN_SQL} SELECT max(scan_pos) + 1 AS scanned, count(*) AS collected,
round(100.0 * count(*) / (max(scan_pos) + 1), 6)::DOUBLE AS yield_pct FROM taken""",
)
def progress_counters(spark, sf):
    return sampling.scan_counters(sample_until_quota(spark, sf))


@query(
    "length_bucket_batches",
    """WITH r AS (SELECT item_id, length(text) AS n_chars, (row_number() OVER (ORDER BY length(text), item_id) - 1) // 8 AS batch_id FROM benchmark)
SELECT item_id, n_chars, batch_id, max(n_chars) OVER (PARTITION BY batch_id) - n_chars AS padding FROM r""",
)
def length_bucket_batches(spark, sf):
    return sampling.length_batches(table(spark, sf, "benchmark"), "item_id", "text", 8).drop("text")


@query("shard_assign", "SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) % 8 AS shard FROM documents")
def shard_assign(spark, sf):
    return sampling.shard_assign(table(spark, sf, "documents").select("doc_id"), "doc_id", 8)


@query(
    "seed_pair_sampling",
    f"""WITH s AS (SELECT text, row_number() OVER (ORDER BY item_id) - 1 AS i FROM benchmark),
d AS (SELECT doc_id, CAST('0x' || substr({sql_hash('a', 'doc_id')}, 1, 8) AS BIGINT) % (SELECT count(*) FROM s) AS ia,
  CAST('0x' || substr({sql_hash('b', 'doc_id')}, 1, 8) AS BIGINT) % (SELECT count(*) FROM s) AS ib FROM documents)
SELECT doc_id, '护士角色：' || a.text || chr(10) || '患者角色：' || b.text || chr(10) AS system_prompt
FROM d JOIN s a ON a.i = ia JOIN s b ON b.i = ib""",
)
def seed_pair_sampling(spark, sf):
    seeds = table(spark, sf, "benchmark")
    draws = table(spark, sf, "documents").select("doc_id")
    pairs = sampling.seed_pairs(draws, "doc_id", seeds, seeds, "item_id", "text")
    return pairs.select("doc_id", role_prompt(F.col("first_text"), F.col("second_text")).alias("system_prompt"))


@query(
    "corpus_union_shuffle",
    f"""WITH u AS (SELECT 'documents' AS origin, doc_id::VARCHAR AS row_key, text FROM documents
UNION ALL SELECT 'benchmark', item_id::VARCHAR, text FROM benchmark)
SELECT origin, row_key, md5(text) AS text_md5, row_number() OVER (ORDER BY {sql_hash(42, 'origin', 'row_key')}, origin, row_key) - 1 AS shuffle_pos FROM u""",
)
def corpus_union_shuffle(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("k"), F.md5("text").alias("t"))
    bench = table(spark, sf, "benchmark").select(F.col("item_id").alias("k"), F.md5("text").alias("t"))
    out = sampling.union_shuffle({"documents": docs, "benchmark": bench}, "k", "t")
    return out.withColumnRenamed("text", "text_md5")
