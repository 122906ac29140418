"""Dialogs held as turn rows: clean-up, pairing, rendering, message lists, tool transcripts.

Turn tables have ``conv_id``, ``turn`` (0-based place in the dialog), ``role`` and ``text``. A dialog may be of any
length; see :mod:`quern.operators.segments` for how the long ones are spread.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import lstrip_newlines, rstrip
from quern.operators.segments import (
    SEG,
    SEGMENT,
    attach_facts,
    joined_text,
    last_before,
    running_count,
    scan,
)
from quern.operators.templates import render_history, render_query

KEY = ["conv_id"]
SPEAKERS = ("human", "gpt")


def dialog_pairs(turns: DataFrame, system_turns: bool = True, size: int = SEGMENT) -> DataFrame:
    """Well-formed (query, response) pairs of every dialog: ``conv_id, pair_idx, query, response, system``.

    With ``system_turns`` a leading system turn is taken as the system prompt; without, it is dropped like any
    other leading turn that is not the user's. Turns out of step with user/assistant alternation are skipped, an
    unknown speaker ends the dialog, and a dialog left with an odd number of turns is dropped whole. ``turn`` need
    only give the order. A column ``system_prompt``, where there is one, holds the record's own system prompt: it
    applies unless a leading system turn says something. ``system`` stands on the first pair.
    """
    own = F.col("system_prompt") if "system_prompt" in turns.columns else F.lit(None).cast("string")
    numbered = turns.select("conv_id", "turn", "role", "text", own.alias("_own"))
    numbered = running_count(numbered, KEY, "turn", F.lit(True), "_place", size=size).drop(SEG)
    turns = numbered.withColumn("turn", F.col("_place") - 1).drop("_place")
    known = F.coalesce(F.col("role").isin(*SPEAKERS), F.lit(False))
    code = F.when(F.col("role") == "human", 0).when(F.col("role") == "gpt", 1).when(F.col("role") == "system", 2)
    code = code.otherwise(3)
    aggs = [
        F.count(F.lit(1)).alias("_n"),
        F.max(F.when(F.col("turn") == 0, code)).alias("_r0"),
        F.max(F.when(F.col("turn") == 1, code)).alias("_r1"),
        F.min(F.when((F.col("turn") >= 2) & ~known, F.col("turn"))).alias("_u2"),
        F.max(F.when((F.col("turn") == 0) & (F.col("role") == "system"), F.col("text"))).alias("_told"),
    ]
    rows = attach_facts(turns, KEY, "turn", aggs, size)
    lead = F.when(F.col("_r0") == 2, 1).otherwise(0) if system_turns else F.lit(0)
    head = F.when(lead == 1, F.col("_r1")).otherwise(F.col("_r0"))
    start = lead + F.when(head == 0, 0).otherwise(1)
    stop = F.when((start <= 1) & (F.col("_r1") > 1), F.lit(1).cast("bigint")).otherwise(F.col("_u2"))
    step = F.col("turn") - start
    kept = rows.where(
        (F.col("_n") >= 2)
        & (F.col("_n") - start >= 2)
        & (step >= 0)
        & (stop.isNull() | (F.col("turn") < stop))
        & (code == step % 2)
    )
    counted = running_count(kept, KEY, "turn", F.lit(True), "_pos", "_kept", size).where(F.col("_kept") % 2 == 0)
    pos = F.col("_pos") - 1
    pairs = (
        counted.withColumn("pair_idx", F.floor(pos / 2).cast("bigint"))
        .groupBy("conv_id", "pair_idx")
        .agg(
            F.max(F.when(pos % 2 == 0, F.col("text"))).alias("query"),
            F.max(F.when(pos % 2 == 1, F.col("text"))).alias("response"),
            F.max("_told").alias("_told"),
            F.max("_own").alias("_own"),
        )
    )
    said = F.when(F.col("_told") != "", F.col("_told")) if system_turns else F.lit(None).cast("string")
    system = F.when(F.col("pair_idx") == 0, F.coalesce(said, "_own", "_told" if system_turns else "_own"))
    return pairs.select("conv_id", "pair_idx", "query", "response", system.alias("system"))


def render_pairs(pairs: DataFrame, system: Column) -> DataFrame:
    """Add the rendered ``prompt_text`` of every pair; the rows carry their template columns."""
    return pairs.withColumn("prompt_text", render_query(F.col("pair_idx"), F.col("query"), system))


def dialog_texts(rendered: DataFrame) -> DataFrame:
    """The dialog list as rows: prompt at ``2 * pair``, response at ``2 * pair + 1``."""
    out = rendered.select(
        "conv_id", "pair_idx", F.posexplode(F.array("prompt_text", "response")).alias("side", "text")
    )
    return out.select("conv_id", (F.col("pair_idx") * 2 + F.col("side")).alias("pos"), "text")


def dialog_prompt(rendered: DataFrame) -> DataFrame:
    """The dialog list joined to one text per dialog, whatever its length."""
    return joined_text(dialog_texts(rendered), KEY, "pos", F.col("text"), "prompt")


def flatten_chat_pairs(turns: DataFrame, size: int = SEGMENT) -> DataFrame:
    """For each assistant turn the latest user text before it; ``no_input`` marks those without one."""
    heard = F.when(F.col("role") == "human", F.col("text"))
    rows = last_before(turns.select("conv_id", "turn", "role", "text"), KEY, "turn", heard, "input_text", size)
    out = rows.where(F.col("role") == "gpt")
    return out.select(
        "conv_id", "turn", "input_text", F.col("text").alias("target_text"), F.col("input_text").isNull().alias("no_input")
    )


def preference_prompt(df: DataFrame) -> DataFrame:
    """``system, history, question, response_chosen, response_rejected`` to ``prompt, chosen, rejected``."""
    turns = F.array(F.array(F.col("question"), F.lit("")))
    asked = F.concat(F.coalesce(F.col("history"), F.array().cast("array<array<string>>")), turns)
    return df.withColumn("prompt_text", render_history(asked, F.col("system"))).withColumnsRenamed(
        {"response_chosen": "chosen", "response_rejected": "rejected"}
    )


def preference_texts(df: DataFrame) -> DataFrame:
    """The full text of both answers, for a scorer that compares them."""

    def full(answer: str) -> Column:
        turns = F.array(F.array(F.col("question"), F.col(answer)))
        asked = F.concat(F.coalesce(F.col("history"), F.array().cast("array<array<string>>")), turns)
        return render_history(asked, F.col("system"))

    return df.withColumn("text_chosen", full("response_chosen")).withColumn("text_rejected", full("response_rejected"))


# Fixed value: the system message of verifiable-reward prompts.
REWARD_SYSTEM = (
    "A conversation between User and Assistant. The user asks a question, and the Assistant solves it. The assistant "
    "first thinks about the reasoning process in the mind and then provides the user with the answer. The reasoning "
    "process and answer are enclosed within <think> </think> and <answer> </answer> tags, respectively, i.e., "
    "<think> reasoning process here </think><answer> answer here </answer>"
)


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def reward_prompt(df: DataFrame, question: str, system: str = REWARD_SYSTEM) -> DataFrame:
    """Add the two-message ``prompt`` of a question."""
    return df.withColumn("prompt", F.array(message("system", F.lit(system)), message("user", F.col(question))))


def assemble_messages(turns: DataFrame, size: int = SEGMENT) -> DataFrame:
    """Message rows in order, renumbered after empty assistant (and empty system) turns are left out."""
    empty = F.coalesce(F.col("text"), F.lit("")) == ""
    kept = turns.where(~(F.col("role").isin("assistant", "system") & empty)).select("conv_id", "turn", "role", "text")
    rows = running_count(kept, KEY, "turn", F.lit(True), "_pos", size=size)
    return rows.select("conv_id", (F.col("_pos") - 1).alias("pos"), "role", F.col("text").alias("content"))


# Wording of the tool prompts.
TOOL_DESC = (
    "%s: Call this tool to interact with the %s API. What is the %s API useful for? %s Parameters: %s"
)
REACT_INSTRUCTION = """Answer the following questions as best you can. You have access to the following APIs:

%s

Use the following format:

Question: the input question you must answer
Thought: you should always think about what to do
Action: the action to take, should be one of [%s]
Action Input: the input to the action
Observation: the result of the action
... (this Thought/Action/Action Input/Observation can be repeated zero or more times)
Thought: I now know the final answer
Final Answer: the final answer to the original input question

Begin!"""
TOOL_FIELDS = ("name", "name_for_model", "name_for_human", "description", "description_for_model")


def tool_array(tools: Sequence[dict]) -> Column:
    """Tool descriptions as an array of structs, parameters as JSON text."""
    def entry(tool: dict) -> Column:
        fields = [F.lit(tool.get(f)).cast("string").alias(f) for f in TOOL_FIELDS]
        return F.struct(*fields, F.lit(json.dumps(tool.get("parameters", {}), ensure_ascii=False)).alias("parameters"))

    return F.array(*map(entry, tools))


def tool_instruction(tools: Column) -> Column:
    """The instruction text for an array of tool descriptions; a general field stands in for a missing special one."""
    def field(t: Column, special: str, general: str) -> Column:
        return F.coalesce(t[special], t[general], F.lit(""))

    listed = F.transform(tools, lambda t: F.struct(
        field(t, "name_for_model", "name").alias("called"), field(t, "name_for_human", "name").alias("shown"),
        field(t, "description_for_model", "description").alias("about"), t["parameters"].alias("takes"),
    ))
    lines = F.transform(listed, lambda t: F.format_string(TOOL_DESC, t["called"], t["shown"], t["shown"], t["about"], t["takes"]))
    names = F.transform(listed, lambda t: t["called"])
    return F.format_string(REACT_INSTRUCTION, F.array_join(lines, "\n\n"), F.array_join(names, ", "))


def trimmed(c: Column) -> Column:
    """Leading newlines and trailing white space removed."""
    return rstrip(lstrip_newlines(c))


def react_flatten(messages: DataFrame, tools: Sequence[dict] = (), size: int = SEGMENT) -> DataFrame:
    """Tool transcripts to question/answer history.

    ``messages`` has ``conv_id, turn, role, content, tool_name, tool_args``, ``turn`` increasing from 0. Output rows:
    one per user message with the merged assistant text that follows it (``is_query`` marks a last, unanswered one),
    or one row with ``invalid_reason`` for a transcript that breaks the order rules; the system text stands on the
    first row. Rows are the same for every ``size`` of the pieces that a long transcript is cut into.
    """
    is_user = F.col("role") == "user"
    rows = scan(
        messages,
        KEY,
        "turn",
        counts={"island": is_user},
        totals={"_users": is_user},
        highest={"_last": F.col("turn")},
        previous={"_prev": F.col("role")},
        following={"_next": F.col("role")},
        size=size,
    )
    lead = (F.col("turn") == 0) & (F.col("role") == "system")
    answering = ("assistant", "function")
    answered = F.coalesce(F.col("_prev").isin(*answering), F.lit(False))
    error = (
        F.when(lead, None)
        .when(~F.col("role").isin("user", *answering), "incorrect_role")
        .when((F.col("role") == "function") & ~answered, "function_before_assistant")
        .when((F.col("role") == "assistant") & (F.col("island") == 0), "assistant_before_user")
    )
    body = trimmed(F.coalesce(F.col("content"), F.lit("")))
    plain = F.concat(F.lit("Thought: I now know the final answer.\nFinal Answer: "), "_body") if tools else F.col("_body")
    thought = F.when(F.col("_body").startswith("Thought:"), F.col("_body")).otherwise(F.concat(F.lit("Thought: "), "_body"))
    called = F.concat(thought, F.lit("\nAction: "), "tool_name", F.lit("\nAction Input: "), "tool_args")
    said = F.when(F.col("tool_name").isNull(), plain).otherwise(called)
    closing = F.when(F.col("turn") == F.col("_last"), "\nThought:").otherwise("")
    piece = (
        F.when(F.col("role") == "function", F.concat(F.lit("\nObservation: "), "_body", closing))
        .when(F.col("_prev") == "user", trimmed(said))
        .when(F.col("role") == "assistant", F.concat(F.lit("\n"), said))
    )
    rows = rows.withColumn("_body", body)
    rows = rows.withColumn("_err", error).withColumn("_piece", piece).withColumn("_asked", is_user).withColumn("_lead", lead)

    # One row per user message: its text, the answer pieces in order, the first rule it breaks.
    texts = F.transform(
        F.array_sort(F.collect_list(F.when(~F.col("_asked") & F.col("_piece").isNotNull(), F.struct("turn", "_piece")))),
        lambda x: x["_piece"],
    )
    islands = rows.groupBy("conv_id", "island").agg(
        F.first("_users").alias("_users"),
        F.max(F.when(F.col("_asked"), F.col("_body"))).alias("_q"),
        F.max(F.when(F.col("_asked"), F.coalesce(F.col("_next").isin(*answering), F.lit(False)))).alias("_answered"),
        F.max(F.when(F.col("_lead"), F.col("_body"))).alias("_system"),
        texts.alias("_texts"),
        F.min(F.when(F.col("_err").isNotNull(), F.struct("turn", "_err"))).alias("_broken"),
    )
    open_ = ~F.col("_answered") & (F.col("island") < F.col("_users"))
    facts = [
        F.min("_broken").alias("_first"),
        F.count_if(open_).alias("_open"),
        F.coalesce(F.max(F.when(F.col("_answered"), F.col("island"))), F.lit(0)).alias("_last_answered"),
        F.min("island").alias("_head"),
        F.max("_system").alias("_told"),
    ]
    islands = attach_facts(islands, KEY, "island", facts, size)
    reason = (
        F.when(F.col("_users") == 0, "no_user")
        .when(F.col("_first").isNotNull(), F.col("_first._err"))
        .when(F.col("_open") % 2 == 1, "odd_messages")
        .when(F.col("_open") > 0, "unpaired_user")
    )
    islands = islands.withColumn("invalid_reason", reason)
    valid = F.col("invalid_reason").isNull()
    head = F.col("island") == F.col("_head")
    shown = islands.where((valid & (F.col("island") > 0)) | (~valid & head))

    answer = trimmed(F.array_join("_texts", ""))
    silent = F.coalesce(~F.col("_answered"), F.lit(False))
    question = F.col("_q")
    if tools:
        target = F.greatest(F.col("_last_answered"), F.lit(1))
        told = F.concat(tool_instruction(tool_array(tools)), F.lit("\n\nQuestion: "), question)
        question = F.when(F.col("island") == target, told).otherwise(question)
    first_row = (F.col("island") == 1) & F.col("_q").isNotNull()
    return shown.select(
        "conv_id",
        F.when(valid, F.col("island") - 1).otherwise(F.lit(-1).cast("bigint")).alias("pair_idx"),
        F.when(valid, question).alias("user_text"),
        F.when(valid & ~silent, answer).alias("assistant_text"),
        (valid & silent).alias("is_query"),
        F.when(valid & first_row, F.coalesce("_told", F.lit(""))).otherwise(F.lit("")).alias("system"),
        "invalid_reason",
    )
