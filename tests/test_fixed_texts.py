"""Fixed wordings, typed here a second time or held by digest, so that a change in the code does not go unnoticed."""

import hashlib
import re

import pytest

from quern.functions import answers
from quern.operators import convert, dialog, filters, retrieval, templates


def digest(value):
    return hashlib.md5(repr(value).encode()).hexdigest()


def test_web_wordings():
    assert convert.WEB_TEMPLATES == [
        "Please explain the following mathematical content step by step:\n\n{context}",
        "Read the following math text and provide a detailed explanation:\n\n{context}",
        "Explain and elaborate on the following mathematical concepts:\n\n{context}",
        "Continue the following mathematical discussion with detailed reasoning:\n\n{context}",
        "Provide a thorough explanation of the math described below:\n\n{context}",
    ]
    assert (convert.WEB_ID_PREFIX, convert.NO_SOLUTION) == ("openwebmath-", "No solution available.")


@pytest.mark.parametrize(
    ("text", "math"),
    [("$x$", True), (r"\[x\]", True), (r"\frac{1}{2}", True), (r"\sqrt", True), (r"\sum", True), (r"\int", True), (r"\begin{a}", True), ("x = 3", True),
     ("3 * 4", True), ("2^10", True), ("$x", False), (r"\frac", False), ("= x", False), ("3 4", False), ("plain", False)],
)
def test_mathematical_patterns(text, math):
    assert any(re.search(p, text) for p in filters.MATH_PATTERNS) == math


def test_chat_templates():
    by_name = {t[0]: t[1:] for t in templates.TEMPLATES}
    assert len(templates.TEMPLATES) == 29 and digest(templates.TEMPLATES) == "6b37dca13501e1e7067cdbff2c88572c"
    assert by_name["qwen"] == (
        "<|im_start|>system\nYou are a helpful assistant.<|im_end|>\n", "user", "assistant",
        "<|im_start|>user\n{query}<|im_end|>\n<|im_start|>assistant\n", "\n", "<|im_end|>",
    )
    assert by_name["vicuna"][3:] == ("USER: {query} ASSISTANT:", "</s>", "</s>")


def test_reward_and_retrieval_wordings():
    assert dialog.REWARD_SYSTEM.startswith("A conversation between User and Assistant. The user asks a question, and the Assistant solves it. ")
    assert dialog.REWARD_SYSTEM.endswith("<think> reasoning process here </think><answer> answer here </answer>")
    assert retrieval.NO_HITS == "没有提供足够的相关信息"
    assert retrieval.RAG_PROMPT.splitlines()[3:] == ["已知内容:", "{context_str}", "", "问题:", "{query_str}"]
    assert digest(retrieval.LINE_ENDINGS) == "a9ec5900b919e94bf0a0f381c6db9481"


@pytest.mark.parametrize(
    ("pattern", "text", "number"),
    [(answers.HASHES, "so\n#### 1,234.5", "1,234.5"), (answers.SPOKEN, "The final answer is: $-7$", "-7"), (answers.SPOKEN, "the answer is 12", "12")],
)
def test_answer_patterns(pattern, text, number):
    assert re.search(pattern, text)[1] == number
    assert re.findall(answers.ANY_NUMBER, "a 1,200 b -3.5") == ["1,200", "-3.5"]
