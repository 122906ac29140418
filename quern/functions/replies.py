"""Columns that take generated replies apart: tool calls, stop words, dialogues, numbered lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions.text import find, from_pos, left, rstrip, strip

# Markers of a tool-using reply and of a generated two-speaker dialogue.
ACTION, ACTION_INPUT, OBSERVATION = "\nAction:", "\nAction Input:", "\nObservation:"
THOUGHT, FINAL_ANSWER = "Thought: ", "\nFinal Answer: "
PATIENT, NURSE = "患者", "护士"


def _between(c: Column, start: Column, end: Column) -> Column:
    return F.substr(c, (start + 1).cast("int"), F.greatest(end - start, F.lit(0)).cast("int"))


def parse_reply(reply: Column) -> dict[str, Column]:
    """``tool_name, tool_args, content, finish_reason`` of a reply."""
    i, j = find(reply, ACTION), find(reply, ACTION_INPUT)
    acts = (i >= 0) & (i < j)
    text = F.when(acts & (find(reply, OBSERVATION) < j), F.concat(rstrip(reply), F.lit(OBSERVATION))).otherwise(reply)
    k = find(text, OBSERVATION)
    name = F.when(acts, strip(_between(text, i + len(ACTION), j))).otherwise(F.lit(""))
    args = F.when(acts, strip(_between(text, j + len(ACTION_INPUT), k))).otherwise(F.lit(""))
    before = left(text, F.greatest(i, F.lit(0)))
    thought = find(before, THOUGHT)
    spoken = strip(F.when(thought >= 0, from_pos(before, thought + len(THOUGHT))).otherwise(before))
    calls = name != ""
    return {
        "tool_name": name,
        "tool_args": F.when(calls, args).otherwise(F.lit("")),
        "content": F.when(calls, spoken).otherwise(F.substring_index(text, FINAL_ANSWER, -1)),
        "finish_reason": F.when(calls, "tool_calls").otherwise("stop"),
    }


def extend_stop_words(stops: Sequence[str]) -> list[str]:
    """The stop words, then those that appear when leading newlines are removed."""
    out = list(stops)
    for s in stops:
        bare = s.lstrip("\n")
        if bare and bare not in out:
            out.append(bare)
    return out


def trim_stop_words(c: Column, stops: Sequence[str]) -> Column:
    """Cut at the first occurrence of each stop word in turn."""
    for s in stops:
        c = F.substring_index(c, s, 1) if s else c
    return c


def parse_dialogue(reply: Column) -> Column:
    """Array of ``(from, value)`` for the lines of a generated patient/nurse dialogue."""

    def turn(line: Column, marker: str, role: str) -> Column:
        said = strip(F.split_part(line, F.lit(marker), F.lit(2)))
        return F.struct(F.lit(role).alias("from"), from_pos(said, F.lit(1)).alias("value"))

    parsed = F.transform(
        F.split(strip(reply), "\n"),
        lambda line: F.when(line.startswith(PATIENT), turn(line, PATIENT, "human")).when(
            line.startswith(NURSE), turn(line, NURSE, "gpt")
        ),
    )
    return F.array_compact(parsed)


def alternation_breaks(turns: Column) -> Column:
    """How many neighbouring turns have the same speaker."""
    pairs = F.zip_with(
        turns,
        F.slice(turns, F.lit(2), F.greatest(F.size(turns) - 1, F.lit(0))),
        lambda a, b: F.when(a["from"] == b["from"], 1).otherwise(0),
    )
    return F.aggregate(pairs, F.lit(0), lambda acc, x: acc + x)


def parse_numbered(reply: Column) -> Column:
    """Items of a numbered list whose entries are separated by blank lines."""
    items = F.transform(
        F.split(reply, "\n\n"),
        lambda x: from_pos(strip(x), F.length(F.split_part(strip(x), F.lit("."), F.lit(1))) + 1),
    )
    return F.filter(items, lambda x: x != "")
