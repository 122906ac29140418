"""Dialog operators against plain loops, on random dialogs and with pieces far shorter than the dialogs."""

import random

import pytest
from pyspark.sql import functions as F

from quern.operators import dialog, roleplay, segments, templates


def random_dialogs(seed, n=60, longest=23):
    rng = random.Random(seed)
    out = {}
    for c in range(n):
        roles = []
        for i in range(rng.randrange(1, longest)):
            usual = ["human", "gpt"][(i + (c % 3 == 0)) % 2]
            roles.append(rng.choices([usual, "human", "gpt", "system", "robot"], [20, 2, 2, 1, 1])[0])
        if rng.random() < 0.4:
            roles[0] = "system"
        out[c] = [(r, f"{r}-{c}-{i}") for i, r in enumerate(roles)]
    return out


def turn_table(spark, dialogs):
    rows = [(c, i, r, t) for c, turns in dialogs.items() for i, (r, t) in enumerate(turns)]
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def expected_pairs(turns, system_turns):
    told = None
    if len(turns) < 2:
        return []
    if system_turns and turns[0][0] == "system":
        told, turns = turns[0][1], turns[1:]
    if turns and turns[0][0] != "human":
        turns = turns[1:]
    if len(turns) < 2:
        return []
    kept = []
    for place, (role, text) in enumerate(turns):
        if role not in ("human", "gpt"):
            break
        if (role == "human") == (place % 2 == 0):
            kept.append(text)
    if len(kept) % 2:
        return []
    return [(p, kept[2 * p], kept[2 * p + 1], told if p == 0 else None) for p in range(len(kept) // 2)]


@pytest.mark.parametrize("size", [2, 5, 4096])
@pytest.mark.parametrize("system_turns", [True, False])
def test_pairs(spark, size, system_turns):
    dialogs = random_dialogs(1)
    out = dialog.dialog_pairs(turn_table(spark, dialogs), system_turns, size)
    got = sorted(
        (r["conv_id"], r["pair_idx"], r["query"], r["response"], r["system"] if system_turns else None)
        for r in out.collect()
    )
    want = sorted((c, *p) for c, t in dialogs.items() for p in expected_pairs(t, system_turns))
    assert got == [w if system_turns else (*w[:4], None) for w in want]


@pytest.mark.parametrize("size", [2, 4096])
def test_latest_question_before_each_answer(spark, size):
    dialogs = random_dialogs(2)
    want = []
    for c, turns in dialogs.items():
        asked = None
        for i, (r, t) in enumerate(turns):
            if r == "human":
                asked = t
            elif r == "gpt":
                want.append((c, i, asked, t, asked is None))
    got = dialog.flatten_chat_pairs(turn_table(spark, dialogs), size).collect()
    assert sorted(map(tuple, got), key=lambda r: r[:2]) == sorted(want, key=lambda r: r[:2])


@pytest.mark.parametrize("size", [4, 4096])
def test_turn_prompts_see_only_the_last_lines(spark, size):
    dialogs = {c: [t for t in turns if t[0] in ("human", "gpt")] for c, turns in random_dialogs(3).items()}
    dialogs = {c: t for c, t in dialogs.items() if t}
    got = {(r["conv_id"], r["pos"]): r["prompt"] for r in roleplay.turn_prompts(turn_table(spark, dialogs), 3, size).collect()}
    for c, turns in dialogs.items():
        lines = [("患者:" if r == "human" else "护士: ") + t + "\n" for r, t in turns]
        for i, (r, _) in enumerate(turns):
            human = r == "human"
            want = (roleplay.PATIENT_ASK if human else roleplay.NURSE_ASK) + "".join(lines[max(0, i - 3) : i])
            assert got[c, i] == want + ("患者:" if human else "护士:")


def test_a_dialog_is_one_text(spark):
    dialogs = random_dialogs(4)
    rows = turn_table(spark, dialogs)
    got = {r["conv_id"]: r["t"] for r in segments.joined_text(rows, ["conv_id"], "turn", F.col("text"), "t").collect()}
    assert got == {c: "".join(t for _, t in turns) for c, turns in dialogs.items()}


def test_turn_numbers_only_give_the_order(spark):
    rows = [(1, 2 * i + 5, r, t) for i, (r, t) in enumerate([("human", "q"), ("gpt", "a"), ("human", "q2"), ("gpt", "a2")])]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = sorted((r["query"], r["response"]) for r in dialog.dialog_pairs(df).collect())
    assert got == [("q", "a"), ("q2", "a2")]


def test_record_level_system_prompts(spark):
    turns = {1: [("system", "told"), ("human", "q"), ("gpt", "a")], 2: [("human", "q"), ("gpt", "a")], 3: [("system", ""), ("human", "q"), ("gpt", "a"), ("human", "r"), ("gpt", "b")]}
    df = turn_table(spark, turns).withColumn("system_prompt", F.lit("own"))
    told = {(r["conv_id"], r["pair_idx"]): r["system"] for r in dialog.dialog_pairs(df).collect()}
    assert told == {(1, 0): "told", (2, 0): "own", (3, 0): "own", (3, 1): None}
    rl = {r["conv_id"]: r["system"] for r in dialog.dialog_pairs(df, system_turns=False).where("pair_idx = 0").collect()}
    assert rl == {1: "own", 2: "own", 3: "own"}


def test_tool_fields_fall_back_to_general_ones(spark):
    tools = [{"name": "n"}, {"name": "m", "name_for_model": "mm", "name_for_human": "mh", "description": "d", "description_for_model": "dm", "parameters": {"ü": [1, 2]}}]
    text = spark.range(1).select(dialog.tool_instruction(dialog.tool_array(tools)).alias("t")).first()["t"]
    assert "\n\nn: Call this tool to interact with the n API. What is the n API useful for?  Parameters: {}\n\n" in text
    assert 'mm: Call this tool to interact with the mh API. What is the mh API useful for? dm Parameters: {"ü": [1, 2]}' in text
    assert "one of [n, mm]" in text


def transcripts(spark, seed):
    rng = random.Random(seed)
    rows = []
    for c in range(80):
        turn, roles = 0, ["system"] if rng.random() < 0.3 else []
        for _ in range(rng.randrange(1, 6)):
            roles += ["user"] + rng.choice([["assistant"], ["call", "function", "assistant"], ["call", "function"], []])
        if rng.random() < 0.2:
            roles.insert(rng.randrange(len(roles)), rng.choice(["function", "critic", "assistant"]))
        for r in roles:
            call = r == "call"
            rows.append((c, turn, "assistant" if call else r, f"\n{r}{turn} ", "calc" if call else None, "{}" if call else None))
            turn += 1
    schema = "conv_id bigint, turn bigint, role string, content string, tool_name string, tool_args string"
    return spark.createDataFrame(rows, schema)


def test_transcripts_do_not_depend_on_the_piece_size(spark):
    rows = transcripts(spark, 6)
    whole = dialog.react_flatten(rows, [{"name": "calc"}]).collect()
    cut = dialog.react_flatten(rows, [{"name": "calc"}], size=2).collect()

    def by_pair(out):
        merged = {}
        for r in sorted(out, key=lambda r: (r["conv_id"], r["pair_idx"])):
            m = merged.setdefault((r["conv_id"], r["pair_idx"]), ["", "", False, "", None])
            m[0] += r["user_text"] or ""
            m[1] += r["assistant_text"] or ""
            m[2] = m[2] or r["is_query"]
            m[3] += r["system"]
            m[4] = r["invalid_reason"]
        return merged

    assert by_pair(whole) == by_pair(cut)
    reasons = {r["invalid_reason"] for r in whole}
    assert {None, "incorrect_role", "function_before_assistant"} <= reasons


def test_transcript_text(spark):
    rows = [
        (1, 0, "system", "\nBe brief. ", None, None),
        (1, 1, "user", "2+2?", None, None),
        (1, 2, "assistant", "I add", "calc", '{"x": 1}'),
        (1, 3, "function", "4", None, None),
        (1, 4, "assistant", "Four", None, None),
        (1, 5, "user", "sure?", None, None),
        (2, 0, "user", "a", None, None),
        (2, 1, "assistant", "b", "calc", "1"),
        (2, 2, "function", "c", None, None),
    ]
    schema = "conv_id bigint, turn bigint, role string, content string, tool_name string, tool_args string"
    out = dialog.react_flatten(spark.createDataFrame(rows, schema)).collect()
    got = {(r["conv_id"], r["pair_idx"]): r for r in out}
    assert got[1, 0]["assistant_text"] == (
        'Thought: I add\nAction: calc\nAction Input: {"x": 1}\nObservation: 4\nFour'
    )
    assert got[1, 0]["system"] == "Be brief."
    assert got[1, 1]["is_query"] and got[1, 1]["assistant_text"] is None
    assert got[2, 0]["assistant_text"].endswith("\nObservation: c\nThought:")


def test_template_registry_facts(spark):
    rows = {r["name"]: r for r in templates.template_table(spark).collect()}
    assert len(rows) == 29
    assert rows["deepseek"]["template_system"] == "<BOS_TOKEN>"
    assert sum(r["stop_str"] != "</s>" for r in rows.values()) == 9
    lossy = {r["name"]: r["prompt"] for r in templates.template_table(spark, compat=True).collect()}
    assert "{content}" in lossy["deepseekcoder"] and "{query}" in rows["deepseekcoder"]["prompt"]


def test_caller_system_prompt_is_used_as_it_is(spark):
    df = spark.createDataFrame([(0, "hi", "Own"), (0, "hi", ""), (1, "hi", "Own")], "i int, q string, s string")
    out = templates.with_named_template(df, "qwen").select(
        templates.render_query(F.col("i"), F.col("q"), F.col("s")).alias("t")
    )
    got = [r["t"] for r in out.collect()]
    ask = "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n"
    own = "<|im_start|>system\nYou are a helpful assistant.<|im_end|>\n"
    assert got == ["Own\n" + ask, own + "\n" + ask, "\n" + ask]
