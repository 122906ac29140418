"""Queries for dialogs, templates, tool transcripts and role play."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions import replies
from quern.functions.text import tokens
from quern.operators import dialog, expand, filters, roleplay, templates
from quern.operators.ordering import dense_index
from quern.plans.fixtures import QA_SQL, WS_SQL, chat_turns, qa_pairs, sql_hash, sql_strip, sql_tokens
from quern.plans.registry import query, spread_table, sql_text, table

# ---------------------------------------------------------------- irregular dialogs


def rough_turns(spark, sf):
    """The dialogs with some speakers replaced, so that skipping, stopping and dropping all occur."""
    c, t = F.col("conv_id"), F.col("turn")
    role = F.when((c * 7 + t) % 23 == 5, "robot").when((c + t) % 11 == 3, "human").otherwise(F.col("role"))
    own = F.when(c % 4 == 1, F.concat(F.lit("Record "), c.cast("string")))
    return chat_turns(spark, sf).withColumn("role", role).withColumn("system_prompt", own)


ROUGH_SQL = """rough AS (
  SELECT conv_id, turn, text, CASE WHEN (conv_id * 7 + turn) % 23 = 5 THEN 'robot' WHEN (conv_id + turn) % 11 = 3 THEN 'human'
    WHEN role = 'user' THEN 'human' WHEN role = 'assistant' THEN 'gpt' ELSE role END AS role
  FROM conversations)"""


def pairs_sql(system_turns: bool) -> str:
    lead = "CASE WHEN r0 = 'system' THEN 1 ELSE 0 END" if system_turns else "0"
    own = "CASE WHEN conv_id % 4 = 1 THEN 'Record ' || conv_id END"
    told = f"coalesce(CASE WHEN r0 = 'system' THEN nullif(t0, '') END, {own}, CASE WHEN r0 = 'system' THEN t0 END)" if system_turns else own
    return (
        ROUGH_SQL
        + f""", f AS (SELECT conv_id, count(*) AS n, arg_min(role, turn) AS r0, arg_min(text, turn) AS t0,
    max(CASE WHEN turn = 1 THEN role END) AS r1 FROM rough GROUP BY conv_id),
g AS (SELECT *, {lead} AS lead FROM f),
h AS (SELECT *, lead + CASE WHEN (CASE WHEN lead = 1 THEN r1 ELSE r0 END) = 'human' THEN 0 ELSE 1 END AS start FROM g),
s AS (SELECT rough.*, turn - start AS j, {told} AS told FROM rough JOIN h USING (conv_id) WHERE n >= 2 AND n - start >= 2 AND turn >= start),
u AS (SELECT *, min(CASE WHEN role NOT IN ('human', 'gpt') THEN j END) OVER (PARTITION BY conv_id) AS stop FROM s),
k AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos, count(*) OVER (PARTITION BY conv_id) AS c
  FROM u WHERE (stop IS NULL OR j < stop) AND role = CASE j % 2 WHEN 0 THEN 'human' ELSE 'gpt' END),
pairs AS (SELECT conv_id, pos // 2 AS pair_idx, max(CASE WHEN pos % 2 = 0 THEN text END) AS query,
  max(CASE WHEN pos % 2 = 1 THEN text END) AS response, CASE WHEN pos // 2 = 0 THEN max(told) END AS system
  FROM k WHERE c % 2 = 0 GROUP BY conv_id, pos // 2)"""
    )


def _row(t):
    return "(" + ", ".join([str(t[0]), *[sql_text(x) for x in t[1:]]]) + ")"


REGISTRY_SQL = (
    "reg(template_id, name, template_system, role_user, role_bot, prompt, sep, stop_str) AS (VALUES "
    + ", ".join(_row((i, *t)) for i, t in enumerate(templates.TEMPLATES))
    + ")"
)


def render_sql(idx: str, q: str, system: str) -> str:
    own = f"coalesce(nullif({system}, ''), template_system)"
    return (
        f"(CASE WHEN {idx} = 0 THEN CASE WHEN {own} <> '' THEN {own} || sep ELSE '' END ELSE sep END "
        f"|| replace(prompt, '{{query}}', {q}))"
    )


RENDERED_SQL = (
    pairs_sql(True)
    + f""", {REGISTRY_SQL}, rendered AS (SELECT conv_id, pair_idx, response, {render_sql('pair_idx', 'query', 'system')} AS prompt_text
FROM pairs JOIN reg ON template_id = conv_id % 29)"""
)


def rendered_dialogs(spark, sf):
    pairs = dialog.dialog_pairs(rough_turns(spark, sf))
    rows = templates.with_template(pairs, F.pmod("conv_id", F.lit(29)))
    return dialog.render_pairs(rows, F.col("system"))


@query("dialog_pairs_sft", f"WITH {pairs_sql(True)} SELECT conv_id, pair_idx, query, response, system FROM pairs")
def dialog_pairs_sft(spark, sf):
    return dialog.dialog_pairs(rough_turns(spark, sf))


@query(
    "chat_template_dialog",
    f"""WITH {RENDERED_SQL} SELECT conv_id, pair_idx * 2 AS pos, prompt_text AS text FROM rendered
UNION ALL SELECT conv_id, pair_idx * 2 + 1, response FROM rendered""",
)
def chat_template_dialog(spark, sf):
    return dialog.dialog_texts(rendered_dialogs(spark, sf))


@query(
    "chat_template_prompt",
    f"""WITH {RENDERED_SQL} SELECT conv_id, string_agg(prompt_text || response, '' ORDER BY pair_idx) AS prompt
FROM rendered GROUP BY conv_id""",
)
def chat_template_prompt(spark, sf):
    return dialog.dialog_prompt(rendered_dialogs(spark, sf))


@query(
    "template_registry",
    f"""WITH {REGISTRY_SQL} SELECT name, role_user, role_bot, stop_str, count(*) AS n_turns,
sum(length({render_sql('0', 'text', "''")}))::BIGINT AS n_chars FROM conversations JOIN reg ON template_id = conv_id % 29
WHERE role = 'user' GROUP BY ALL""",
)
def template_registry(spark, sf):
    asked = table(spark, sf, "conversations").where(F.col("role") == "user")
    rows = templates.with_template(asked, F.pmod("conv_id", F.lit(29)))
    text = templates.render_query(F.lit(0), F.col("text"), F.lit(""))
    return rows.groupBy("name", "role_user", "role_bot", "stop_str").agg(
        F.count(F.lit(1)).alias("n_turns"), F.sum(F.length(text)).alias("n_chars")
    )


RL_SQL = (
    pairs_sql(False)
    + f""", {REGISTRY_SQL} SELECT conv_id, pair_idx, {render_sql('pair_idx', 'query', 'system')} AS prompt
FROM pairs JOIN reg ON name = 'qwen' """
)


@query("dialog_prompts_rl", f"WITH {RL_SQL}")
def dialog_prompts_rl(spark, sf):
    pairs = dialog.dialog_pairs(rough_turns(spark, sf), system_turns=False)
    rows = dialog.render_pairs(templates.with_named_template(pairs, "qwen"), F.col("system"))
    return rows.select("conv_id", "pair_idx", F.col("prompt_text").alias("prompt"))


@query("dialog_prompts_callback", f"WITH {RL_SQL}")
def dialog_prompts_callback(spark, sf):
    """The same prompts, the pairs made by a callback over each dialog's turns."""
    turns = rough_turns(spark, sf).select("conv_id", "turn", "role", "text", "system_prompt")
    pairs = expand.expand_dialogs(turns, "conv_id", "turn", "pair_idx bigint, query string, response string, system string", expand.prompts_of_dialog)
    rows = dialog.render_pairs(templates.with_named_template(pairs, "qwen"), F.col("system"))
    return rows.select("conv_id", "pair_idx", F.col("prompt_text").alias("prompt"))


@query("filter_prompt_nonempty", f"WITH q AS (WITH {RL_SQL}) SELECT conv_id, count(*) AS n_prompts FROM q WHERE length(prompt) > 0 GROUP BY 1")
def filter_prompt_nonempty(spark, sf):
    rows = dialog_prompts_rl(spark, sf).where(F.length("prompt") > 0)
    return rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_prompts"))


@query(
    "flatten_chat_pairs",
    f"""WITH {ROUGH_SQL}, l AS (SELECT *, last_value(CASE WHEN role = 'human' THEN text END IGNORE NULLS) OVER
  (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS input_text FROM rough)
SELECT conv_id, turn, input_text, text AS target_text, input_text IS NULL AS no_input FROM l WHERE role = 'gpt'""",
)
def flatten_chat_pairs(spark, sf):
    return dialog.flatten_chat_pairs(rough_turns(spark, sf))


# ---------------------------------------------------------------- preferences


def preferences(spark, sf):
    """Every good document of a language with a bad one, ranks taken in turns, as answers to a question about both."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "text")
    rated = docs.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")

    def side(quality, name):
        d = dense_index(rated.where(F.col("quality") == quality), "doc_id", by=["lang"], name="rank")
        return d.select("lang", "rank", F.col("doc_id").alias(f"{name}_id"), F.col("text").alias(f"response_{name}"), F.col("source").alias(f"{name}_source"))

    bad = side(0, "rejected")
    counts = rated.where(F.col("quality") == 0).groupBy("lang").agg(F.count(F.lit(1)).alias("n_bad"))  # a row per language
    good = side(1, "chosen").join(F.broadcast(counts), "lang").withColumn("rank", F.pmod("rank", F.col("n_bad")))
    both = good.join(bad, ["lang", "rank"])
    asked = F.concat(F.lit("Write a text in "), "lang", F.lit(" as in "), "chosen_source", F.lit("."))
    before = F.when(F.col("chosen_id") % 2 == 1, F.array(F.array("chosen_source", "rejected_source")))
    system = F.when(F.col("lang") != "en", F.concat(F.lit("Answer in "), "lang"))
    return both.select(
        "chosen_id", "rejected_id", system.alias("system"), before.alias("history"), asked.alias("question"),
        "response_chosen", "response_rejected",
    )


PREF_SQL = f"""rated AS (SELECT d.*, quality, row_number() OVER (PARTITION BY lang, quality ORDER BY doc_id) - 1 AS rank,
  count(CASE WHEN quality = 0 THEN 1 END) OVER (PARTITION BY lang) AS n_bad FROM documents d JOIN labels USING (doc_id)),
pref AS (SELECT c.doc_id AS chosen_id, r.doc_id AS rejected_id, CASE WHEN c.lang <> 'en' THEN 'Answer in ' || c.lang END AS system,
  c.doc_id % 2 = 1 AS has_history, c.source AS hq, r.source AS ha,
  'Write a text in ' || c.lang || ' as in ' || c.source || '.' AS question, c.text AS chosen, r.text AS rejected
  FROM rated c JOIN rated r ON c.lang = r.lang AND c.n_bad > 0 AND c.rank % c.n_bad = r.rank AND c.quality = 1 AND r.quality = 0),
{REGISTRY_SQL},
prompts AS (SELECT pref.*, CASE WHEN has_history THEN {render_sql('0', 'hq', 'system')} || ha || {render_sql('1', 'question', 'system')}
  ELSE {render_sql('0', 'question', 'system')} END AS prompt_text FROM pref JOIN reg ON name = 'vicuna')"""


def preference_prompts(spark, sf):
    return dialog.preference_prompt(templates.with_named_template(preferences(spark, sf), "vicuna"))


@query("preference_prompt", f"WITH {PREF_SQL} SELECT chosen_id, rejected_id, prompt_text AS prompt, chosen, rejected FROM prompts")
def preference_prompt(spark, sf):
    rows = preference_prompts(spark, sf)
    return rows.select("chosen_id", "rejected_id", F.col("prompt_text").alias("prompt"), "chosen", "rejected")


@query(
    "filter_pair_chars",
    f"""WITH {PREF_SQL} SELECT chosen_id, rejected_id, length(prompt_text) AS n_prompt FROM prompts
WHERE length(prompt_text || chosen) BETWEEN 1 AND 2560 AND length(prompt_text || rejected) BETWEEN 1 AND 2560""",
)
def filter_pair_chars(spark, sf):
    rows = preference_prompts(spark, sf)
    ok = filters.pair_chars_ok(F.col("prompt_text"), F.col("chosen"), F.col("rejected"), 2048, 512)
    return rows.where(ok).select("chosen_id", "rejected_id", F.length("prompt_text").cast("bigint").alias("n_prompt"))


def preference_texts(spark, sf):
    rows = dialog.preference_texts(templates.with_named_template(preferences(spark, sf), "vicuna"))
    return rows.withColumn("tokens_chosen", tokens(F.col("text_chosen"))).withColumn(
        "tokens_rejected", tokens(F.col("text_rejected"))
    )


@query(
    "preference_pair_render",
    f"""WITH {PREF_SQL} SELECT chosen_id, rejected_id, md5(prompt_text || chosen) AS md5_chosen, md5(prompt_text || rejected) AS md5_rejected,
len({sql_tokens('prompt_text || chosen')})::INTEGER AS n_chosen, len({sql_tokens('prompt_text || rejected')})::INTEGER AS n_rejected FROM prompts""",
)
def preference_pair_render(spark, sf):
    return preference_texts(spark, sf).select(
        "chosen_id", "rejected_id", F.md5("text_chosen").alias("md5_chosen"), F.md5("text_rejected").alias("md5_rejected"),
        F.size("tokens_chosen").alias("n_chosen"), F.size("tokens_rejected").alias("n_rejected"),
    )


@query(
    "filter_pair_tokens",
    f"""WITH {PREF_SQL} SELECT chosen_id, rejected_id FROM prompts
WHERE len({sql_tokens('prompt_text || chosen')}) BETWEEN 1 AND 384 AND len({sql_tokens('prompt_text || rejected')}) BETWEEN 1 AND 384""",
)
def filter_pair_tokens(spark, sf):
    ok = filters.pair_tokens_ok(F.col("tokens_chosen"), F.col("tokens_rejected"), 384)
    return preference_texts(spark, sf).where(ok).select("chosen_id", "rejected_id")


# ---------------------------------------------------------------- messages


@query(
    "rl_chat_prompt",
    f"""SELECT item_id, 0::BIGINT AS pos, 'system' AS role, {sql_text(dialog.REWARD_SYSTEM)} AS content, length(text)::VARCHAR AS answer FROM benchmark
UNION ALL SELECT item_id, 1, 'user', text, length(text)::VARCHAR FROM benchmark""",
)
def rl_chat_prompt(spark, sf):
    rows = table(spark, sf, "benchmark").withColumn("answer", F.length("text").cast("string"))
    out = dialog.reward_prompt(rows, "text").select("item_id", "answer", F.posexplode("prompt").alias("pos", "m"))
    return out.select("item_id", F.col("pos").cast("bigint").alias("pos"), "m.role", "m.content", "answer")


@query(
    "assemble_messages",
    """WITH t AS (SELECT conv_id, turn, role, CASE WHEN (conv_id + turn) % 5 = 0 THEN '' ELSE text END AS text FROM conversations)
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos, role, text AS content FROM t
WHERE NOT (role IN ('assistant', 'system') AND text = '')""",
)
def assemble_messages(spark, sf):
    blank = F.when((F.col("conv_id") + F.col("turn")) % 5 == 0, "").otherwise(F.col("text"))
    return dialog.assemble_messages(table(spark, sf, "conversations").withColumn("text", blank))


TOOLS = [
    {"name": "search", "description": "Find pages.", "parameters": {"q": "text"}},
    {"name": "calc", "name_for_human": "Calculator", "description": "Do sums.", "parameters": {}},
]


# Fixed value: what the instruction for these tools must read.
TOOLS_TEXT = """Answer the following questions as best you can. You have access to the following APIs:

search: Call this tool to interact with the search API. What is the search API useful for? Find pages. Parameters: {"q": "text"}

calc: Call this tool to interact with the Calculator API. What is the Calculator API useful for? Do sums. Parameters: {}

Use the following format:

Question: the input question you must answer
Thought: you should always think about what to do
Action: the action to take, should be one of [search, calc]
Action Input: the input to the action
Observation: the result of the action
... (this Thought/Action/Action Input/Observation can be repeated zero or more times)
Thought: I now know the final answer
Final Answer: the final answer to the original input question

Begin!"""


def tool_messages(spark, sf):
    """The dialogs as tool transcripts: half of the answers become call, observation and answer; some are broken."""
    c, t = F.col("conv_id"), F.col("turn")
    role = (
        F.when((c % 13 == 4) & (t == 2), "critic")
        .when((c % 13 == 6) & (F.col("role") == "user"), "assistant")
        .when((c % 13 == 8) & (t == 1), "function")
        .when((c % 13 == 10) & (t == 1), "user")
        .otherwise(F.col("role"))
    )
    conv = table(spark, sf, "conversations").withColumn("role", role)
    none = F.lit(None).cast("string")

    def entry(step, role, content, name=none, args=none):
        return F.struct(
            F.lit(step).alias("step"), role.alias("role"), content.alias("content"), name.alias("tool_name"), args.alias("tool_args")
        )

    think = F.when(c % 3 == 0, "Thought: look it up").otherwise("I check ")
    args = F.concat(F.lit('{"q": '), t.cast("string"), F.lit("}"))
    said = F.col("text")
    using = F.array(
        entry(0, F.lit("assistant"), think, F.when(t % 2 == 0, "calc").otherwise("search"), args),
        entry(1, F.lit("function"), F.concat(F.lit("\n"), said, F.lit("  "))),
        entry(2, F.lit("assistant"), said),
    )
    calls = (F.col("role") == "assistant") & ((c + t) % 2 == 0)
    steps = F.when(calls, using).otherwise(F.array(entry(0, F.col("role"), said)))
    out = conv.select("conv_id", "turn", F.explode(steps).alias("m"))
    return out.select("conv_id", (t * 3 + F.col("m.step")).alias("turn"), "m.role", "m.content", "m.tool_name", "m.tool_args")


def trimmed_sql(e: str) -> str:
    return f"rtrim(ltrim({e}, chr(10)), {WS_SQL})"


REACT_SQL = f"""conv AS (SELECT conv_id, turn, text, CASE WHEN conv_id % 13 = 4 AND turn = 2 THEN 'critic'
    WHEN conv_id % 13 = 6 AND role = 'user' THEN 'assistant' WHEN conv_id % 13 = 8 AND turn = 1 THEN 'function'
    WHEN conv_id % 13 = 10 AND turn = 1 THEN 'user' ELSE role END AS role FROM conversations),
calls AS (SELECT * FROM conv WHERE role = 'assistant' AND (conv_id + turn) % 2 = 0),
msg AS (
  SELECT conv_id, turn * 3 AS turn, role, text AS content, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS args FROM conv
    WHERE NOT (role = 'assistant' AND (conv_id + turn) % 2 = 0)
  UNION ALL SELECT conv_id, turn * 3, role, CASE WHEN conv_id % 3 = 0 THEN 'Thought: look it up' ELSE 'I check ' END,
    CASE WHEN turn % 2 = 0 THEN 'calc' ELSE 'search' END, '{{"q": ' || turn || '}}' FROM calls
  UNION ALL SELECT conv_id, turn * 3 + 1, 'function', chr(10) || text || '  ', NULL, NULL FROM calls
  UNION ALL SELECT conv_id, turn * 3 + 2, 'assistant', text, NULL, NULL FROM calls),
m0 AS (SELECT *, max(turn) OVER (PARTITION BY conv_id) AS last, count(CASE WHEN role = 'user' THEN 1 END) OVER (PARTITION BY conv_id) AS users,
  {trimmed_sql("coalesce(content, '')")} AS body FROM msg),
sys AS (SELECT conv_id, body AS system FROM m0 WHERE turn = 0 AND role = 'system'),
m1 AS (SELECT *, count(CASE WHEN role = 'user' THEN 1 END) OVER (PARTITION BY conv_id ORDER BY turn) AS island,
  lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prev FROM m0 WHERE NOT (turn = 0 AND role = 'system')),
m2 AS (SELECT *, CASE WHEN role NOT IN ('user', 'assistant', 'function') THEN 'incorrect_role'
    WHEN role = 'function' AND coalesce(prev NOT IN ('assistant', 'function'), true) THEN 'function_before_assistant'
    WHEN role = 'assistant' AND island = 0 THEN 'assistant_before_user' END AS err,
  CASE WHEN name IS NULL THEN 'Thought: I now know the final answer.' || chr(10) || 'Final Answer: ' || body
    ELSE CASE WHEN starts_with(body, 'Thought:') THEN '' ELSE 'Thought: ' END || body || chr(10) || 'Action: ' || name || chr(10) || 'Action Input: ' || args END AS said FROM m1),
m3 AS (SELECT *, CASE WHEN role = 'function' THEN chr(10) || 'Observation: ' || body || CASE WHEN turn = last THEN chr(10) || 'Thought:' ELSE '' END
    WHEN prev = 'user' THEN {trimmed_sql('said')} ELSE chr(10) || said END AS piece FROM m2),
reasons AS (SELECT conv_id, CASE WHEN max(users) = 0 THEN 'no_user' ELSE arg_min(err, turn) FILTER (err IS NOT NULL) END AS reason FROM m3 GROUP BY conv_id),
answers AS (SELECT conv_id, island, {trimmed_sql("string_agg(piece, '' ORDER BY turn)")} AS answer FROM m3 WHERE role IN ('assistant', 'function') GROUP BY ALL),
asked AS (SELECT a.conv_id, a.island, a.users, a.body AS user_text, answer FROM m3 a LEFT JOIN answers USING (conv_id, island) WHERE a.role = 'user'),
shape AS (SELECT conv_id, count(CASE WHEN answer IS NULL AND island < users THEN 1 END) AS open,
  coalesce(max(CASE WHEN answer IS NOT NULL THEN island END), 0) AS last_answered FROM asked GROUP BY conv_id),
verdict AS (SELECT conv_id, coalesce(reason, CASE WHEN open % 2 = 1 THEN 'odd_messages' WHEN open > 0 THEN 'unpaired_user' END) AS reason,
  last_answered FROM reasons LEFT JOIN shape USING (conv_id))
SELECT conv_id, island - 1 AS pair_idx, CASE WHEN island = greatest(last_answered, 1) THEN
    {sql_text(TOOLS_TEXT)} || chr(10) || chr(10) || 'Question: ' || user_text ELSE user_text END AS user_text,
  answer AS assistant_text, answer IS NULL AS is_query, CASE WHEN island = 1 THEN coalesce(system, '') ELSE '' END AS system, CAST(NULL AS VARCHAR) AS invalid_reason
FROM asked JOIN verdict USING (conv_id) LEFT JOIN sys USING (conv_id) WHERE reason IS NULL
UNION ALL SELECT conv_id, -1, NULL, NULL, false, '', reason FROM verdict WHERE reason IS NOT NULL"""


@query("react_flatten", f"WITH {REACT_SQL}")
def react_flatten(spark, sf):
    return dialog.react_flatten(tool_messages(spark, sf), TOOLS)


def replies_table(spark, sf):
    """Assistant texts dressed as tool-using replies in five styles."""
    said = table(spark, sf, "conversations").where(F.col("role") == "assistant")
    kind = (F.col("conv_id") + F.col("turn")) % 5
    call = F.concat(
        F.lit("Thought: see "), "text", F.lit("\nAction: "), F.when(F.col("turn") % 2 == 0, "calc").otherwise("search"),
        F.lit('\nAction Input: {"q": '), F.col("conv_id").cast("string"), F.lit("} \n"),
    )
    reply = (
        F.when(kind == 0, call)
        .when(kind == 1, F.concat(call, F.lit("Observation: "), "text"))
        .when(kind == 2, F.concat(F.lit("Thought: done\nFinal Answer: "), "text"))
        .when(kind == 3, F.concat(F.lit("\nAction:"), F.lit("\nAction Input: none "), "text"))
        .otherwise(F.col("text"))
    )
    return said.select("conv_id", "turn", reply.alias("reply"))


REPLIES_SQL = """c AS (SELECT conv_id, turn, text, (conv_id + turn) % 5 AS kind, 'Thought: see ' || text || chr(10) || 'Action: ' ||
    CASE WHEN turn % 2 = 0 THEN 'calc' ELSE 'search' END || chr(10) || 'Action Input: {"q": ' || conv_id || '} ' || chr(10) AS call
  FROM conversations WHERE role = 'assistant'),
replies AS (SELECT conv_id, turn, CASE kind WHEN 0 THEN call WHEN 1 THEN call || 'Observation: ' || text
  WHEN 2 THEN 'Thought: done' || chr(10) || 'Final Answer: ' || text WHEN 3 THEN chr(10) || 'Action:' || chr(10) || 'Action Input: none ' || text
  ELSE text END AS reply FROM c)"""

PARSED_SQL = f"""{REPLIES_SQL}, p0 AS (SELECT *, instr(reply, chr(10) || 'Action:') - 1 AS i, instr(reply, chr(10) || 'Action Input:') - 1 AS j,
  instr(reply, chr(10) || 'Observation:') - 1 AS k FROM replies),
p1 AS (SELECT *, i >= 0 AND i < j AS acts, CASE WHEN i >= 0 AND i < j AND k < j THEN rtrim(reply, {WS_SQL}) || chr(10) || 'Observation:' ELSE reply END AS t FROM p0),
p2 AS (SELECT *, CASE WHEN acts THEN {sql_strip('substr(t, i + 9, j - i - 8)')} ELSE '' END AS tool_name,
  CASE WHEN acts THEN {sql_strip("substr(t, j + 15, instr(t, chr(10) || 'Observation:') - 1 - j - 14)")} ELSE '' END AS args, left(t, i) AS before FROM p1),
parsed AS (SELECT conv_id, turn, tool_name, CASE WHEN tool_name <> '' THEN args ELSE '' END AS tool_args,
  CASE WHEN tool_name <> '' THEN {sql_strip("CASE WHEN instr(before, 'Thought: ') > 0 THEN substr(before, instr(before, 'Thought: ') + 9) ELSE before END")}
    ELSE list_last(string_split(t, chr(10) || 'Final Answer: ')) END AS content,
  CASE WHEN tool_name <> '' THEN 'tool_calls' ELSE 'stop' END AS finish_reason FROM p2)"""


def parsed_replies(spark, sf):
    rows = replies_table(spark, sf)
    return rows.select("conv_id", "turn", *[c.alias(n) for n, c in replies.parse_reply(F.col("reply")).items()])


@query(
    "react_parse_response",
    f"""WITH {PARSED_SQL} SELECT tool_name, finish_reason, count(*) AS n, sum(length(tool_args))::BIGINT AS args_chars,
sum(length(content))::BIGINT AS content_chars, count(DISTINCT tool_args) AS n_args, min(md5(content)) AS low, max(md5(content)) AS high FROM parsed GROUP BY ALL""",
)
def react_parse_response(spark, sf):
    return parsed_replies(spark, sf).groupBy("tool_name", "finish_reason").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("tool_args")).alias("args_chars"),
        F.sum(F.length("content")).alias("content_chars"), F.countDistinct("tool_args").alias("n_args"),
        F.min(F.md5("content")).alias("low"), F.max(F.md5("content")).alias("high"),
    )


STOPS = ["\nObservation:", "\nFinal"]


@query(
    "trim_stop_words",
    f"""WITH {REPLIES_SQL}, t AS (SELECT conv_id, reply, string_split(string_split(string_split(string_split(reply, chr(10) || 'Observation:')[1], chr(10) || 'Final')[1], 'Observation:')[1], 'Final')[1] AS cut FROM replies)
SELECT conv_id, count(*) AS n_replies, count(CASE WHEN cut <> reply THEN 1 END) AS n_trimmed, sum(length(cut))::BIGINT AS kept_chars, min(md5(cut)) AS low FROM t GROUP BY conv_id""",
)
def trim_stop_words(spark, sf):
    rows = replies_table(spark, sf)
    cut = replies.trim_stop_words(F.col("reply"), replies.extend_stop_words(STOPS))
    return rows.withColumn("cut", cut).groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_replies"), F.count_if(F.col("cut") != F.col("reply")).alias("n_trimmed"),
        F.sum(F.length("cut")).alias("kept_chars"), F.min(F.md5("cut")).alias("low"),
    )


# ---------------------------------------------------------------- role play


@query(
    "roleplay_turn_prompt",
    f"""WITH t AS (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos,
    CASE role WHEN 'user' THEN '患者:' ELSE '护士: ' END || {sql_strip('text')} || chr(10) AS line FROM conversations WHERE role IN ('user', 'assistant')),
h AS (SELECT *, coalesce(array_to_string(list(line) OVER (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING), ''), '') AS told FROM t)
SELECT conv_id, pos, CASE role WHEN 'user' THEN 'human' ELSE 'gpt' END AS role,
CASE role WHEN 'user' THEN {sql_text(roleplay.PATIENT_ASK)} || told || '患者:' ELSE {sql_text(roleplay.NURSE_ASK)} || told || '护士:' END AS prompt FROM h""",
)
def roleplay_turn_prompt(spark, sf):
    return roleplay.turn_prompts(chat_turns(spark, sf))


@query(
    "parse_generated_dialogue",
    f"""WITH {QA_SQL}, r AS (SELECT conv_id, turn, ' 患者: ' || input || chr(10) || CASE WHEN turn % 3 = 0 THEN '患者：' || output || chr(10) ELSE '' END
    || '护士:' || output || '患者' || chr(10) || 'end' AS reply FROM qa),
l AS (SELECT conv_id, turn, u.line, u.i FROM r, unnest(string_split({sql_strip('reply')}, chr(10))) WITH ORDINALITY AS u(line, i)),
p AS (SELECT conv_id, turn, i, CASE WHEN starts_with(line, '患者') THEN 'human' ELSE 'gpt' END AS who,
  substr({sql_strip("string_split(line, CASE WHEN starts_with(line, '患者') THEN '患者' ELSE '护士' END)[2]")}, 2) AS value
  FROM l WHERE starts_with(line, '患者') OR starts_with(line, '护士')),
q AS (SELECT *, lag(who) OVER (PARTITION BY conv_id, turn ORDER BY i) AS before FROM p)
SELECT conv_id, turn, count(*)::INTEGER AS n_turns, count(CASE WHEN who = before THEN 1 END)::INTEGER AS breaks,
string_agg(who || '=' || value, '|' ORDER BY i) AS turns FROM q GROUP BY ALL""",
)
def parse_generated_dialogue(spark, sf):
    again = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("患者："), "output", F.lit("\n"))).otherwise("")
    reply = F.concat(F.lit(" 患者: "), "input", F.lit("\n"), again, F.lit("护士:"), "output", F.lit("患者\nend"))
    rows = qa_pairs(spark, sf).select("conv_id", "turn", replies.parse_dialogue(reply).alias("t"))
    shown = F.array_join(F.transform("t", lambda x: F.concat(x["from"], F.lit("="), x["value"])), "|")
    return rows.select(
        "conv_id", "turn", F.size("t").alias("n_turns"), replies.alternation_breaks(F.col("t")).alias("breaks"), shown.alias("turns")
    )


@query(
    "parse_numbered_list",
    f"""WITH r AS (SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda x, i: i || CASE WHEN i % 4 = 0 THEN ' ' ELSE '.' END || x), chr(10) || chr(10)) AS reply FROM documents),
l AS (SELECT doc_id, {sql_strip('u.x')} AS x, u.i FROM r, unnest(string_split(reply, chr(10) || chr(10))) WITH ORDINALITY AS u(x, i)),
p AS (SELECT doc_id, i, substr(x, length(string_split(x, '.')[1]) + 2) AS item FROM l)
SELECT doc_id, count(*)::INTEGER AS n_items, string_agg(item, '|' ORDER BY i) AS items FROM p WHERE item <> '' GROUP BY doc_id""",
)
def parse_numbered_list(spark, sf):
    numbered = F.transform(
        F.split("text", "\n"),
        lambda x, i: F.concat((i + 1).cast("string"), F.when((i + 1) % 4 == 0, " ").otherwise("."), x),
    )
    items = replies.parse_numbered(F.array_join(numbered, "\n\n"))
    rows = spread_table(spark, sf, "documents", "doc_id").select("doc_id", items.alias("t"))
    return rows.where(F.size("t") > 0).select("doc_id", F.size("t").alias("n_items"), F.array_join("t", "|").alias("items"))


@query(
    "seed_batch_prompt",
    f"""WITH s AS (SELECT item_id % 7 <> 3 AS ok, text, row_number() OVER (ORDER BY {sql_hash(0, 'item_id')}, item_id) - 1 AS i FROM benchmark)
SELECT i // 5 AS batch_id, {sql_text(roleplay.EXPAND_ASK)} || string_agg(CASE WHEN ok THEN (i % 5 + 1) || '.' || text || chr(10) || chr(10) ELSE '' END, '' ORDER BY i) AS prompt
FROM s GROUP BY 1 HAVING bool_or(i % 5 = 4 AND ok)""",
)
def seed_batch_prompt(spark, sf):
    good = F.to_json(F.struct(F.col("text").alias("system_prompt")))
    line = F.when(F.col("item_id") % 7 == 3, F.lit("{broken")).otherwise(good)
    rows = table(spark, sf, "benchmark").select("item_id", line.alias("line"))
    return roleplay.seed_prompts(rows, "item_id", "line")
