"""Queries for answer extraction, scoring, rewards, losses and the streaming jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions import answers
from quern.functions.text import tokens
from quern.operators import scoring
from quern.plans import token_jobs as tj
from quern.plans.corpus import MATH_SQL, TEMPLATES_SQL, split_sql
from quern.plans.fixtures import QA_SQL, qa_pairs, sql_strip, sql_tokens
from quern.plans.registry import query, spread_table, sql_text, table
from quern.operators import convert
from quern.session import scratch_dir
from quern.sources import readers, writers
from quern.streaming import jobs, progress

# ---------------------------------------------------------------- completions made from orders


def completions(spark, sf):
    """One text per order that states ``o_custkey % 1000`` in one of eight notations."""
    n = (F.col("o_custkey") % 1000).cast("string")
    kind = F.col("o_orderkey") % 8

    def say(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    text = (
        F.when(kind == 0, say("<think>I guess 7\nor 8</think><answer> ", n, " </answer>"))
        .when(kind == 1, say("<think>a</think><answer>", n, "</answer>"))
        .when(kind == 2, say("So \\boxed{", n, "} it is"))
        .when(kind == 3, say("So \\boxed{\\frac{", n, "}{2}} done"))
        .when(kind == 4, say("x \\boxed{a}  Then #### ", n, ",000"))
        .when(kind == 5, say("The  final answer is: $", n, "$ ok"))
        .when(kind == 6, say("take 3 then ", n, ".5\tEnd "))
        .otherwise(F.lit("No idea "))
    )
    truth = (
        F.when(kind % 3 == 0, say("work #### ", n))
        .when(kind % 3 == 1, say("\\boxed{", n, "}"))
        .otherwise(say("$", n, "$"))
    )
    orders = spread_table(spark, sf, "orders", "o_orderkey")
    return orders.select("o_orderkey", "o_custkey", "o_orderpriority", text.alias("text"), truth.alias("truth"))


COMP_SQL = r"""o AS (SELECT o_orderkey, o_custkey, o_orderpriority, (o_custkey % 1000)::VARCHAR AS n, o_orderkey % 8 AS kind FROM orders),
comp AS (SELECT o_orderkey, o_custkey, o_orderpriority, n, CASE kind
  WHEN 0 THEN '<think>I guess 7' || chr(10) || 'or 8</think><answer> ' || n || ' </answer>'
  WHEN 1 THEN '<think>a</think><answer>' || n || '</answer>'
  WHEN 2 THEN 'So \boxed{' || n || '} it is'
  WHEN 3 THEN 'So \boxed{\frac{' || n || '}{2}} done'
  WHEN 4 THEN 'x \boxed{a}  Then #### ' || n || ',000'
  WHEN 5 THEN 'The  final answer is: $' || n || '$ ok'
  WHEN 6 THEN 'take 3 then ' || n || '.5' || chr(9) || 'End ' ELSE 'No idea ' END AS text,
  CASE kind % 3 WHEN 0 THEN 'work #### ' || n WHEN 1 THEN '\boxed{' || n || '}' ELSE '$' || n || '$' END AS truth FROM o)"""

NUM = r"^[+-]?((\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+)?|(?i:inf|infinity|nan))$"


def number_sql(e: str) -> str:
    t = sql_strip(f"replace({e}, ',', '')")
    return f"CASE WHEN regexp_matches({t}, '{NUM}') THEN try_cast(replace({t}, '_', '') AS DOUBLE) END"


def think_sql(e: str) -> str:
    return f"regexp_replace({e}, '(?s)<think>.*?</think>', '', 'g')"


def extract_sql(e: str) -> str:
    t = think_sql(e)
    parts = [
        number_sql(f"list_last(regexp_extract_all({t}, {sql_text(p)}, {g}))")
        for p, g in ((answers.BOXED, 1), (answers.HASHES, 1), (answers.SPOKEN, 1), (answers.ANY_NUMBER, 0))
    ]
    return "coalesce(" + ", ".join(parts) + ")"


def boxed_sql(e: str) -> str:
    tail = f"list_last(string_split({e}, '\\boxed'))"
    body = f"regexp_extract({tail}, '^\\{{((?:[^{{}}]|\\{{(?:[^{{}}]|\\{{[^{{}}]*\\}})*\\}})*)\\}}', 1)"
    return (
        f"CASE WHEN contains({e}, '\\boxed ') THEN string_split(list_last(string_split({e}, '\\boxed ')), '$')[1] "
        f"WHEN contains({e}, '\\boxed') AND regexp_matches({tail}, '^\\{{(?:[^{{}}]|\\{{(?:[^{{}}]|\\{{[^{{}}]*\\}})*\\}})*\\}}') THEN {body} END"
    )


def tag_sql(e: str) -> str:
    return (
        f"coalesce(CASE WHEN regexp_matches({e}, '(?s)<answer>.*?</answer>') THEN {sql_strip(f'''regexp_extract({e}, '(?s)<answer>(.*?)</answer>', 1)''')} "
        f"ELSE {sql_strip(e)} END, '')"
    )


def gold_sql(e: str) -> str:
    return sql_strip(f"CASE WHEN instr({e}, '####') > 0 THEN substr({e}, instr({e}, '####') + 4) ELSE {e} END")


def norm_sql(e: str) -> str:
    for pat, to in (
        (r"\\(?:left|right|,|;|!|quad)", ""), (r"\\d?frac\{([^{}]+)\}\{([^{}]+)\}", r"\1/\2"), (r"\\(?:text|mathrm)\{[^{}]*\}", ""),
        (r"\\?[$%]", ""), (r"(\d),(\d\d\d)", r"\1\2"), (r"(\d)\s*(?:dollars|cents|units|degrees|percent|cm|kg|km|m)$", r"\1"), (r"\s+", ""),
    ):
        e = f"regexp_replace({e}, {sql_text(pat)}, {sql_text(to)}, 'g')"
    return f"lower({e})"


def value_sql(e: str) -> str:
    top, bottom = f"string_split({e}, '/')[1]", f"string_split({e}, '/')[2]"
    return f"CASE WHEN contains({e}, '/') THEN {number_sql(top)} / nullif({number_sql(bottom)}, 0) ELSE {number_sql(e)} END"


def candidate_sql(e: str) -> str:
    t = think_sql(e)
    hashed = sql_strip(f"regexp_extract({t}, '####[ \\t]*(.*)', 1)")
    tagged = tag_sql(t)
    return (
        f"coalesce({boxed_sql(t)}, CASE WHEN contains({t}, '####') THEN {hashed} END, "
        f"CASE WHEN regexp_matches({t}, '(?s)<answer>.*?</answer>') THEN {tagged} END)"
    )


def truth_sql(e: str) -> str:
    return f"CASE WHEN contains({e}, '####') THEN {gold_sql(e)} ELSE coalesce({boxed_sql(e)}, {sql_strip(e)}) END"


def by_customer(df, *aggs):
    return df.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), *aggs)


@query(
    "extract_number",
    f"WITH {COMP_SQL}, v AS (SELECT o_custkey, {extract_sql('text')} AS v FROM comp) "
    "SELECT o_custkey, count(*) AS n, count(v) AS n_found, round(sum(v), 3) AS total FROM v GROUP BY o_custkey",
)
def extract_number(spark, sf):
    rows = completions(spark, sf).withColumn("v", answers.extract_number(F.col("text")))
    return by_customer(rows, F.count("v").alias("n_found"), F.round(F.sum("v"), 3).alias("total"))


def text_digest(c):
    return [F.count(c).alias("n_found"), F.sum(F.length(c)).alias("n_chars"), F.min(c).alias("low"), F.max(c).alias("high")]


def digest_sql(e):
    return (
        f"WITH {COMP_SQL}, v AS (SELECT o_custkey, {e} AS v FROM comp) SELECT o_custkey, count(*) AS n, count(v) AS n_found, "
        "sum(length(v))::BIGINT AS n_chars, min(v) AS low, max(v) AS high FROM v GROUP BY o_custkey"
    )


@query("extract_boxed_balanced", digest_sql(boxed_sql("text")))
def extract_boxed_balanced(spark, sf):
    return by_customer(completions(spark, sf).withColumn("v", answers.boxed_balanced(F.col("text"))), *text_digest("v"))


@query("extract_answer_tag", digest_sql(tag_sql("text")))
def extract_answer_tag(spark, sf):
    return by_customer(completions(spark, sf).withColumn("v", answers.answer_tag(F.col("text"))), *text_digest("v"))


@query("strip_think", digest_sql(think_sql("text")))
def strip_think(spark, sf):
    return by_customer(completions(spark, sf).withColumn("v", answers.strip_think(F.col("text"))), *text_digest("v"))


@query("normalize_text", digest_sql(f"coalesce(regexp_replace(lower({sql_strip('text')}), '\\s+', ' ', 'g'), '')"))
def normalize_text(spark, sf):
    return by_customer(completions(spark, sf).withColumn("v", answers.normalize_spaces(F.col("text"))), *text_digest("v"))


@query("gold_answer_split", digest_sql(gold_sql("truth")))
def gold_answer_split(spark, sf):
    return by_customer(completions(spark, sf).withColumn("v", answers.gold_answer(F.col("truth"))), *text_digest("v"))


@query(
    "verify_numeric",
    f"WITH {COMP_SQL}, v AS (SELECT o_orderpriority, coalesce(abs({extract_sql('text')} - n::DOUBLE) < 1e-3, false) AS ok FROM comp) "
    "SELECT o_orderpriority, count(*) AS n, sum(ok::INTEGER)::DOUBLE AS score FROM v GROUP BY 1",
)
def verify_numeric(spark, sf):
    truth = (F.col("o_custkey") % 1000).cast("double")
    rows = completions(spark, sf).withColumn("v", answers.verify_numeric(F.col("text"), truth))
    return rows.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("score"))


PATH_SQL = f"""v0 AS (SELECT *, {norm_sql(candidate_sql('text'))} AS p, {norm_sql(truth_sql('truth'))} AS g FROM comp),
v AS (SELECT *, CASE WHEN p IS NULL OR g = '' THEN 'unparsed' WHEN p = g THEN 'text'
  WHEN coalesce(abs({value_sql('p')} - {value_sql('g')}) < 1e-3, false) THEN 'value' ELSE 'differ' END AS path FROM v0)"""


@query("verify_normalized", f"WITH {COMP_SQL}, {PATH_SQL} SELECT o_orderpriority, path, count(*) AS n, sum(o_orderkey)::BIGINT AS keys FROM v GROUP BY ALL")
def verify_normalized(spark, sf):
    rows = completions(spark, sf).withColumn("path", answers.verify_path(F.col("text"), F.col("truth")))
    return rows.groupBy("o_orderpriority", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


FORMAT_SQL = r"regexp_matches(text, '^<think>.*?</think><answer>.*?</answer>\n?$')"


@query("format_reward", f"WITH {COMP_SQL} SELECT o_custkey, count(*) AS n, sum({FORMAT_SQL}::INTEGER)::DOUBLE AS reward FROM comp GROUP BY o_custkey")
def format_reward(spark, sf):
    return by_customer(completions(spark, sf).withColumn("v", answers.format_reward(F.col("text"))), F.sum("v").alias("reward"))


@query(
    "reward_table",
    f"""WITH {COMP_SQL}, r0 AS (SELECT *, {norm_sql(f"CASE WHEN contains(truth, '####') THEN {tag_sql('text')} ELSE {candidate_sql('text')} END")} AS p,
  {norm_sql(truth_sql('truth'))} AS g FROM comp),
r AS (SELECT o_orderpriority, coalesce((p = g OR coalesce(abs({value_sql('p')} - {value_sql('g')}) < 1e-3, false)) AND g <> '', false)::INTEGER AS acc, {FORMAT_SQL}::INTEGER AS fmt FROM r0)
SELECT o_orderpriority, 'accuracy' AS reward, count(*) AS n, sum(acc)::DOUBLE AS total, round(avg(acc), 6) AS mean FROM r GROUP BY 1
UNION ALL SELECT o_orderpriority, 'format', count(*), sum(fmt)::DOUBLE, round(avg(fmt), 6) FROM r GROUP BY 1""",
)
def reward_table(spark, sf):
    rewards = {
        "accuracy": answers.accuracy_reward(F.col("text"), F.col("truth")),
        "format": answers.format_reward(F.col("text")),
    }
    rows = scoring.reward_table(completions(spark, sf), ["o_orderkey", "o_orderpriority"], rewards)
    return rows.groupBy("o_orderpriority", "reward").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.round(F.avg("value"), 6).alias("mean")
    )


# ---------------------------------------------------------------- evaluation runs


def eval_samples(spark, sf):
    """Three benchmark tables with differing column names, normalised and stacked."""
    orders = table(spark, sf, "orders")
    n = (F.col("o_custkey") % 1000).cast("string")
    asked = F.concat(F.lit("How many for order "), F.col("o_orderkey").cast("string"), F.lit("?"))
    kind = F.col("o_orderkey") % 3
    a = orders.where(kind == 0).select("o_orderkey", asked.alias("problem"), F.concat(F.lit("Sum. #### "), n).alias("groud_truth_solution"))
    b = orders.where(kind == 1).select("o_orderkey", asked.alias("question"), F.concat(F.lit("\\boxed{"), n, F.lit("}")).alias("ground_truth_solution"))
    number = F.when(F.col("o_orderkey") % 10 != 2, n.cast("double"))
    c = orders.where(kind == 2).select("o_orderkey", asked.alias("question"), n.alias("result"), number.alias("result_float"))
    parts = [readers.normalize_eval(t, "o_orderkey", d) for t, d in ((a, "gsm8k_distilled"), (b, "gsm8k_distilled"), (c, "calc_gsm8k"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


SAMPLES_SQL = f"""raw AS (SELECT o_orderkey AS sample_id, o_custkey, (o_custkey % 1000)::VARCHAR AS n, o_orderkey % 3 AS kind FROM orders),
named AS (SELECT *, CASE kind WHEN 2 THEN 'calc_gsm8k' ELSE 'gsm8k_distilled' END AS eval_dataset, 'How many for order ' || sample_id || '?' AS question,
  CASE kind WHEN 0 THEN 'Sum. #### ' || n WHEN 1 THEN '\\boxed{{' || n || '}}' ELSE n END AS ground_truth FROM raw),
samples AS (SELECT sample_id, o_custkey, n, eval_dataset, question, ground_truth,
  CASE WHEN kind = 2 THEN CASE WHEN sample_id % 10 <> 2 THEN n::DOUBLE END ELSE {extract_sql('ground_truth')} END AS ground_truth_value FROM named)"""


@query("src_eval_normalize", f"WITH {SAMPLES_SQL} SELECT sample_id, eval_dataset, question, ground_truth, ground_truth_value FROM samples")
def src_eval_normalize(spark, sf):
    return eval_samples(spark, sf)


MODELS = {"base": 4, "tuned": 7, "draft": 3}


def predictions(spark, sf):
    """Texts of three models, in five styles, off by one as often as the model's modulus says."""
    orders = spread_table(spark, sf, "orders", "o_orderkey")
    key = F.col("o_orderkey")
    dataset = F.when(key % 3 == 2, "calc_gsm8k").otherwise("gsm8k_distilled")
    models = F.array(*[F.struct(F.lit(m).alias("model_label"), F.lit(k).alias("m")) for m, k in MODELS.items()])
    rows = orders.select("o_orderkey", "o_custkey", dataset.alias("eval_dataset"), F.inline(models))
    rows = rows.where(~((F.col("model_label") == "draft") & (F.col("eval_dataset") == "calc_gsm8k")))
    off = F.when(F.col("o_custkey") % F.col("m") == 0, 1).otherwise(0)
    n = (F.col("o_custkey") % 1000 + off).cast("string")
    style = key % 5
    text = (
        F.when(style == 0, F.concat(F.lit("So \\boxed{"), n, F.lit("}.")))
        .when(style == 1, F.concat(F.lit("Thus\n#### "), n))
        .when(style == 2, F.concat(F.lit("The answer is "), n, F.lit(".")))
        .when(style == 3, F.concat(F.lit("I count 2 and get "), n))
        .otherwise(F.lit("cannot say"))
    )
    text = F.when(key % 2 == 0, F.concat(F.lit("<think>1 or\n2</think>"), text)).otherwise(text)
    return rows.select(key.alias("sample_id"), "model_label", "eval_dataset", text.alias("prediction"))


SCORED_SQL = f"""{SAMPLES_SQL}, models(model_label, m) AS (VALUES ('base', 4), ('tuned', 7), ('draft', 3)),
pr0 AS (SELECT sample_id, model_label, eval_dataset, question, ground_truth, ground_truth_value,
  (n::BIGINT + CASE WHEN o_custkey % m = 0 THEN 1 ELSE 0 END)::VARCHAR AS k FROM samples, models WHERE NOT (model_label = 'draft' AND eval_dataset = 'calc_gsm8k')),
pr AS (SELECT *, CASE WHEN sample_id % 2 = 0 THEN '<think>1 or' || chr(10) || '2</think>' ELSE '' END || CASE sample_id % 5
  WHEN 0 THEN 'So \\boxed{{' || k || '}}.' WHEN 1 THEN 'Thus' || chr(10) || '#### ' || k WHEN 2 THEN 'The answer is ' || k || '.'
  WHEN 3 THEN 'I count 2 and get ' || k ELSE 'cannot say' END AS prediction FROM pr0),
e0 AS (SELECT *, {norm_sql(candidate_sql('prediction'))} AS p, {norm_sql(truth_sql('ground_truth'))} AS g FROM pr),
e1 AS (SELECT *, CASE WHEN p IS NULL OR g = '' THEN 'unparsed' WHEN p = g THEN 'text'
  WHEN coalesce(abs({value_sql('p')} - {value_sql('g')}) < 1e-3, false) THEN 'value' ELSE 'differ' END AS path FROM e0),
scored AS (SELECT sample_id, model_label, eval_dataset, prediction,
  CASE WHEN path NOT IN ('text', 'value') AND ground_truth_value IS NOT NULL THEN 'number' ELSE path END AS verify_path,
  CASE WHEN path IN ('text', 'value') THEN true WHEN ground_truth_value IS NOT NULL THEN coalesce(abs({extract_sql('prediction')} - ground_truth_value) < 1e-3, false) ELSE false END AS correct FROM e1),
summary AS (SELECT model_label, eval_dataset, count(*) AS total, count(CASE WHEN correct THEN 1 END) AS correct,
  round_even(100.0::DOUBLE * count(CASE WHEN correct THEN 1 END) / count(*), 2) AS accuracy FROM scored GROUP BY ALL)"""


def scored(spark, sf):
    return scoring.score_predictions(eval_samples(spark, sf), predictions(spark, sf))


@query("score_predictions", f"WITH {SCORED_SQL} SELECT sample_id, model_label, eval_dataset, prediction, verify_path, correct FROM scored")
def score_predictions(spark, sf):
    return scored(spark, sf).select("sample_id", "model_label", "eval_dataset", "prediction", "verify_path", "correct")


@query("accuracy_summary", f"WITH {SCORED_SQL} SELECT * FROM summary")
def accuracy_summary(spark, sf):
    return scoring.accuracy_summary(scored(spark, sf))


@query(
    "compare_models",
    f"""WITH {SCORED_SQL} SELECT model_label,
coalesce(max(CASE WHEN eval_dataset = 'gsm8k_distilled' THEN printf('%.2f%%', accuracy) END), 'N/A') AS gsm8k_distilled,
coalesce(max(CASE WHEN eval_dataset = 'calc_gsm8k' THEN printf('%.2f%%', accuracy) END), 'N/A') AS calc_gsm8k FROM summary GROUP BY 1""",
)
def compare_models(spark, sf):
    return scoring.compare_models(scoring.accuracy_summary(scored(spark, sf)), ["gsm8k_distilled", "calc_gsm8k"])


@query("resume_eval", f"WITH {SCORED_SQL} SELECT * FROM summary")
def resume_eval(spark, sf):
    samples, said = eval_samples(spark, sf), predictions(spark, sf)
    path = scratch_dir(spark, "results")
    first = said.where(F.col("sample_id") % 3 != 1)
    scoring.score_predictions(samples, first).write.parquet(path)
    return scoring.accuracy_summary(scoring.resume_scoring(samples, said, spark.read.parquet(path)))


@query("sink_summary", f"WITH {SCORED_SQL} SELECT *, 'base' AS base_model, CASE WHEN model_label <> 'base' THEN model_label END AS lora_model FROM summary")
def sink_summary(spark, sf):
    path = scratch_dir(spark, "summary")
    adapter = F.when(F.col("model_label") != "base", F.col("model_label"))
    summary = writers.run_identity(scoring.accuracy_summary(scored(spark, sf)), F.lit("base"), adapter)
    for run in (F.col("model_label") == "base", F.col("model_label") != "base"):  # one run after another
        writers.write_summary(summary.where(run), path)
    schema = "total bigint, correct bigint, accuracy double, base_model string, lora_model string, model_label string, eval_dataset string"
    return spark.read.schema(schema).json(path)


# ---------------------------------------------------------------- metrics


@query(
    "token_accuracy",
    f"WITH {tj.SHIFT_SQL} SELECT count(*) AS n, sum((p = y)::INTEGER)::BIGINT AS hits, round(avg((p = y)::INTEGER), 6) AS accuracy FROM al",
)
def token_accuracy(spark, sf):
    return scoring.token_accuracy(tj.shifted(spark, sf), "q").withColumn("accuracy", F.round("accuracy", 6))


PAIR_SQL = """pairs AS (SELECT l_orderkey, sum(l_extendedprice) / 100000 AS c, sum(l_discount) * 10 AS r FROM lineitem GROUP BY l_orderkey)"""


def pair_scores(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        (F.sum("l_extendedprice") / 100000).alias("c"), (F.sum("l_discount") * 10).alias("r")
    )


@query("reward_mse_mae", f"WITH {PAIR_SQL} SELECT round(avg(pow(c - r, 2)), 6) AS mse, round(avg(abs(c - r)), 6) AS mae FROM pairs")
def reward_mse_mae(spark, sf):
    out = pair_scores(spark, sf).agg(*scoring.reward_errors(F.col("c"), F.col("r")))
    return out.select(F.round("mse", 6).alias("mse"), F.round("mae", 6).alias("mae"))


@query("pairwise_logloss", f"WITH {PAIR_SQL} SELECT round(avg(greatest(r - c, 0) + ln(1 + exp(-abs(c - r)))), 6) AS loss FROM pairs")
def pairwise_logloss(spark, sf):
    return pair_scores(spark, sf).agg(F.round(scoring.pairwise_logloss(F.col("c"), F.col("r")), 6).alias("loss"))


@query("perplexity", "SELECT o_orderstatus, round(exp(avg(o_totalprice / 100000)), 6) AS perplexity FROM orders GROUP BY 1")
def perplexity(spark, sf):
    value = scoring.perplexity(F.col("o_totalprice") / 100000)
    return table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.round(value, 6).alias("perplexity"))


@query(
    "mean_of_batch_losses",
    """WITH b AS (SELECT o_custkey, avg(o_totalprice / 100000) AS m FROM orders GROUP BY 1)
SELECT round(avg(m), 6) AS eval_loss, count(*) AS n_batches, round(exp(avg(m)), 6) AS perplexity FROM b""",
)
def mean_of_batch_losses(spark, sf):
    rows = table(spark, sf, "orders").withColumn("loss", F.col("o_totalprice") / 100000)
    out = scoring.mean_of_batch_losses(rows, "o_custkey", "loss")
    return out.select(F.round("eval_loss", 6).alias("eval_loss"), "n_batches", F.round("perplexity", 6).alias("perplexity"))


@query(
    "pair_perplexity_ref",
    f"WITH {QA_SQL} SELECT count(*) AS n, round(exp(sum((length(input) % 7) / 10.0::DOUBLE * 512) / (count(*) * sum(length(output)))), 9) AS perplexity FROM qa",
)
def pair_perplexity_ref(spark, sf):
    loss = (F.length("input") % 7) / F.lit(10.0)
    value = scoring.pair_perplexity(loss, F.lit(512), F.length("output"))
    return qa_pairs(spark, sf).agg(F.count(F.lit(1)).alias("n"), F.round(value, 9).alias("perplexity"))


@query(
    "unigram_perplexity",
    f"""WITH w AS (SELECT doc_id, unnest({sql_tokens('text')}) AS piece FROM documents), c AS (SELECT piece, count(*) AS c FROM w GROUP BY piece),
t AS (SELECT sum(c)::DOUBLE + count(*) AS z FROM c)
SELECT doc_id, count(c) AS n_tokens, round(avg(-ln((c + 1) / z)), 6) AS nll, round(exp(avg(-ln((c + 1) / z))), 2) AS perplexity
FROM documents LEFT JOIN w USING (doc_id) LEFT JOIN c USING (piece), t GROUP BY doc_id""",
)
def unigram_perplexity(spark, sf):
    out = scoring.unigram_perplexity(spread_table(spark, sf, "documents", "doc_id"), "doc_id", "text")
    return out.select("doc_id", "n_tokens", F.round("nll", 6).alias("nll"), F.round("perplexity", 2).alias("perplexity"))


@query(
    "usage_accounting",
    f"""WITH t AS (SELECT conv_id, role, len({sql_tokens('text')}) AS n FROM conversations)
SELECT conv_id, sum(CASE WHEN role = 'assistant' THEN 0 ELSE n END)::BIGINT AS prompt_tokens,
sum(CASE WHEN role = 'assistant' THEN n ELSE 0 END)::BIGINT AS completion_tokens, sum(n)::BIGINT AS total_tokens FROM t GROUP BY conv_id""",
)
def usage_accounting(spark, sf):
    return scoring.usage(table(spark, sf, "conversations"), "conv_id", "role", "text")


# ---------------------------------------------------------------- streams


@query(
    "stream_web_math",
    f"""WITH kept AS (SELECT doc_id, text, CAST('0x' || substr(md5(text), 1, 8) AS BIGINT) AS idx FROM documents
  WHERE text IS NOT NULL AND text <> '' AND length(text) BETWEEN 500 AND 8000 AND regexp_matches(text, {MATH_SQL})), {split_sql('kept')}
SELECT '{convert.WEB_ID_PREFIX}' || md5(text) AS id, replace({TEMPLATES_SQL}[(idx % 5) + 1], '{{context}}', {sql_strip('left(text, cut_at)')}) AS human,
{sql_strip('text')} AS gpt FROM cuts""",
)
def stream_web_math(spark, sf):
    return jobs.stream_web_math(spark, sf)


@query(
    "stream_tokenise",
    f"""WITH {tj.ENC_SQL}, c AS (SELECT doc_id, ids[:128] AS c FROM docs),
p AS (SELECT doc_id, list_concat(c, list_transform(range(128 - len(c)), lambda x: 3)) AS p FROM c)
SELECT doc_id, len(p)::INTEGER AS n, list_sum(p)::BIGINT AS id_sum FROM p""",
)
def stream_tokenise(spark, sf):
    out = jobs.stream_tokenise(spark, sf, tj.vocabulary(spark, sf), 128)
    return out.select("doc_id", F.size("input_ids").alias("n"), tj.total(F.col("input_ids")).alias("id_sum"))


@query("stream_pack", tj.PACKED_SQL)
def stream_pack(spark, sf):
    return tj.block_digests(jobs.stream_pack(spark, sf, tj.vocabulary(spark, sf), 256, 100))


@query("stream_resume_scoring", f"WITH {SCORED_SQL} SELECT * FROM summary")
def stream_resume_scoring(spark, sf):
    path = scratch_dir(spark, "predictions")
    said = predictions(spark, sf)
    state = scratch_dir(spark, "scoring")
    schema = "sample_id bigint, model_label string, eval_dataset string, prediction string"
    for side in (0, 1):  # files come in between the two calls
        said.where(F.col("sample_id") % 2 == side).write.mode("append").parquet(path)
        _, summary = jobs.stream_scores(eval_samples(spark, sf), path, schema, state)
    return summary


@query("stream_accuracy", f"WITH {SCORED_SQL} SELECT * FROM summary")
def stream_accuracy(spark, sf):
    path, state = scratch_dir(spark, "predictions"), scratch_dir(spark, "accuracy")
    said = predictions(spark, sf)
    schema = "sample_id bigint, model_label string, eval_dataset string, prediction string"
    for side in (0, 1):  # files come in between the two calls
        said.where(F.col("sample_id") % 2 == side).write.mode("append").parquet(path)
        totals = progress.stream_accuracy(eval_samples(spark, sf), path, schema, state)
    return totals


@query(
    "stream_progress",
    """SELECT count(*) AS scanned, count(CASE WHEN length(text) BETWEEN 500 AND 8000 THEN 1 END) AS collected,
round(100.0::DOUBLE * count(CASE WHEN length(text) BETWEEN 500 AND 8000 THEN 1 END) / count(*), 6) AS yield_pct,
count(CASE WHEN length(text) BETWEEN 500 AND 8000 THEN 1 END) AS written FROM documents""",
)
def stream_progress(spark, sf):
    docs = jobs.stream_table(spark, sf, "documents", jobs.DOCUMENTS)
    kept, counters = progress.collect_accepted(docs, F.length("text").between(500, 8000), "accepted")
    seen = counters.summary()
    figures = [F.lit(seen["scanned"]).cast("bigint").alias("scanned"), F.lit(seen["collected"]).cast("bigint").alias("collected")]
    return kept.agg(F.count(F.lit(1)).alias("written")).select(*figures, F.round(F.lit(seen["yield_pct"]), 6).alias("yield_pct"), "written")
