"""Edge cases of the text, reply and answer columns."""

import pytest
from pyspark.sql import functions as F

from quern.functions import answers, replies, text
from quern.operators import convert, filters


def one(spark, value, column, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(column(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "value, want",
    [
        (r"so \boxed{12}", 12.0),
        (r"\boxed{1} then \boxed{ 2,500 }", 2500.0),
        (r"\boxed{\frac{1}{2}}", 2.0),
        (r"\boxed{abc} #### -3.5", -3.5),
        (r"\boxed{1d} #### 7", 7.0),
        (r"\boxed{1_000}", 1000.0),
        (r"\boxed{inf}", float("inf")),
        ("#### 1,200 apples", 1200.0),
        ("The final answer is: $42$.", 42.0),
        ("first 3 then 4", 4.0),
        ("<think>9\n9</think>none", None),
        ("", None),
        (None, None),
    ],
)
def test_extract_number(spark, value, want):
    assert one(spark, value, answers.extract_number) == want


@pytest.mark.parametrize(
    "value, want",
    [
        (r"a \boxed{\frac{1}{2}} b", r"\frac{1}{2}"),
        (r"\boxed{a{b{c{d}}}}", "a{b{c{d}}}"),
        (r"\boxed{1} and \boxed{2}", "2"),
        (r"\boxed 5$ rest", "5"),
        (r"\boxed{open", None),
        (r"\fbox{3}", None),
        ("none", None),
    ],
)
def test_boxed_balanced(spark, value, want):
    assert one(spark, value, answers.boxed_balanced) == want


@pytest.mark.parametrize(
    "value, want",
    [
        ("<think>a</think><answer>b</answer>", 1.0),
        ("<think>a</think><answer>b</answer>\n", 1.0),
        ("<think>a\nb</think><answer>b</answer>", 0.0),
        ("<think>a\rb</think><answer>b</answer>", 1.0),
        (" <think>a</think><answer>b</answer>", 0.0),
    ],
)
def test_format_reward(spark, value, want):
    assert one(spark, value, answers.format_reward) == want


def test_answer_tag_and_gold(spark):
    assert one(spark, "x<answer> 1\n2 </answer>", answers.answer_tag) == "1\n2"
    assert one(spark, " plain　", answers.answer_tag) == "plain"
    assert one(spark, None, answers.answer_tag) == ""
    assert one(spark, "a #### 1 #### 2", answers.gold_answer) == "1 #### 2"
    assert one(spark, None, answers.normalize_spaces) == ""
    assert one(spark, " A \n b ", answers.normalize_spaces) == "a b"


@pytest.mark.parametrize(
    "said, truth, want",
    [
        (r"\boxed{1/2}", r"\boxed{\frac{1}{2}}", "text"),
        (r"\boxed{0.5}", r"\boxed{\frac{1}{2}}", "value"),
        (r"\boxed{1{,}000}", "#### 1000", "differ"),
        (r"\boxed{1,000}", "#### 1000", "text"),
        (r"\boxed{5 \text{ cm}}", "5", "text"),
        ("no answer", "5", "unparsed"),
    ],
)
def test_verify_path(spark, said, truth, want):
    df = spark.createDataFrame([(said, truth)], "p string, g string")
    assert df.select(answers.verify_path(F.col("p"), F.col("g")).alias("y")).first()["y"] == want


def test_strip_covers_unicode_space(spark):
    assert one(spark, " \x1c a b \x85　", text.strip) == "a b"
    assert one(spark, "a", lambda c: text.find(c, "b")) == -1
    assert one(spark, "aab", lambda c: text.find(c, "a", 1)) == 1


def test_cjk_bounds(spark):
    assert one(spark, "龦", text.has_cjk) is True
    assert one(spark, "龦", text.all_cjk) is False
    assert one(spark, "中文", text.all_cjk) is True
    assert one(spark, "", text.all_cjk) is True
    assert one(spark, "中a", text.all_cjk) is False


@pytest.mark.parametrize("body", ["y" * 50 + "\n\n" + "z" * 400, "y" * 60 + ". " + "z" * 400, "y" * 60 + "\n" + "z" * 400, "y" * 500])
def test_split_point(spark, body):
    low, high = int(len(body) * 0.1), int(len(body) * 0.4)
    places = [i for i in range(low, high) if body[i : i + 2] == "\n\n"]
    places = places or [i + 1 for i in range(low, high) if body[i] == "." and body[i + 1 : i + 2] in (" ", "\n")]
    places = places or [i for i in range(low, high) if body[i] == "\n"]
    want = places[0] if places else max(100, int(len(body) * 0.2))
    assert one(spark, body, convert.context_cut) == want


def test_math_pattern(spark):
    for s in ("$x$", r"\[a\]", r"\frac{", r"\sum", "= 3", "1 + 2", "a\r$b$"):
        assert one(spark, s, filters.has_math) is True, s
    for s in ("$x\n$", "= x", "one + two"):
        assert one(spark, s, filters.has_math) is False, s


@pytest.mark.parametrize(
    "line, want",
    [
        ('{"conversations": [{"from": "human", "value": "a"}]}', []),
        ('{"conversations": []}', []),
        ('{"conversations": [{"from": "system", "value": null}]}', []),
        ('{"conversations": [{"from": "human"}, {"from": "x", "value": "b"}]}', ["missing_turn_key", "bad_role"]),
        ('{"conversations": [{"from": "x"}]}', ["missing_turn_key"]),
        ('{"conversations": "a"}', ["not_a_list"]),
        ('{"a": 1}', ["missing_conversations"]),
        ("[1]", ["not_object"]),
        ("{", ["bad_json"]),
        ("", ["bad_json"]),
    ],
)
def test_validator(spark, line, want):
    out = filters.validate_chat_lines(spark.createDataFrame([(line,)], "line string"), "line").first()
    assert out["reasons"] == want and out["valid"] == (not want)


def test_replies(spark):
    df = spark.createDataFrame([("Thought: go\nAction: s\nAction Input: {1} ",), ("x\nFinal Answer: a\nFinal Answer: b",), ("\nAction:\nAction Input: q",)], "r string")
    rows = df.select(*[c.alias(n) for n, c in replies.parse_reply(F.col("r")).items()]).collect()
    assert tuple(rows[0]) == ("s", "{1}", "go", "tool_calls")
    assert tuple(rows[1]) == ("", "", "b", "stop")
    assert rows[2]["finish_reason"] == "stop" and rows[2]["content"].endswith("\nObservation:")
    assert replies.extend_stop_words(["\nA", "A", "\n"]) == ["\nA", "A", "\n"]
    assert one(spark, "x A y\nB", lambda c: replies.trim_stop_words(c, ["\nB", "A"])) == "x "
    assert one(spark, "1. a\n\n2.b.c\n\nnone\n\n", replies.parse_numbered) == [" a", "b.c"]
    turns = one(spark, "患者: hi\n其他\n护士：yes护士no\n", replies.parse_dialogue)
    assert [tuple(t) for t in turns] == [("human", " hi"), ("gpt", "yes")]
