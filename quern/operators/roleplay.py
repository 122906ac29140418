"""Prompts for generating role-played dialogues and more seeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import strip
from quern.operators.ordering import dense_index, hash_key
from quern.operators.segments import SEGMENT, running_count, trailing_lines

# Wording of the prompts (the second speaker's cue in the history has a blank, the first's has none).
PATIENT_ASK = "要求你扮演患者，并且根据角色的设定内容模仿角色相应的对话口吻和风格。你说一句话，完成本轮对话即可。"
NURSE_ASK = "要求你扮演护士，并且根据角色的设定内容模仿角色相应的对话口吻和风格。你说一句话,完成本轮对话即可。\n"
PATIENT_CUE, NURSE_CUE = "患者:", "护士:"
PATIENT_LINE, NURSE_LINE = "患者:", "护士: "
EXPAND_ASK = "请续写下面内容，不少于10条，增加些多样性。\n\n"
SEEDS_PER_PROMPT = 5


def turn_prompts(turns: DataFrame, max_history: int = 10, size: int = SEGMENT) -> DataFrame:
    """The prompt that asks for each turn, given the last ``max_history`` turns before it."""
    spoken = turns.where(F.col("role").isin("human", "gpt")).select("conv_id", "turn", "role", "text")
    spoken = running_count(spoken, ["conv_id"], "turn", F.lit(True), "_n", size=size)
    spoken = spoken.withColumn("pos", F.col("_n") - 1).drop("_n", "_seg")
    patient = F.col("role") == "human"
    line = F.concat(F.when(patient, PATIENT_LINE).otherwise(NURSE_LINE), strip(F.col("text")))
    rows = trailing_lines(spoken, ["conv_id"], "pos", line, max_history, "_lines", size)
    told = F.array_join(F.transform("_lines", lambda x: F.concat(x, F.lit("\n"))), "")
    prompt = F.concat(
        F.when(patient, PATIENT_ASK).otherwise(NURSE_ASK), told, F.when(patient, PATIENT_CUE).otherwise(NURSE_CUE)
    )
    return rows.select("conv_id", "pos", "role", prompt.alias("prompt"))


def seed_prompts(lines: DataFrame, key: str, line: str, seed: int | str = 0) -> DataFrame:
    """Seeds in seeded order, five to a prompt.

    ``line`` is a JSON object with ``system_prompt``. An unreadable line keeps its number but adds no text; a batch
    whose last line is missing or unreadable gives no prompt.
    """
    hashed = lines.withColumn("_h", hash_key(seed, F.col(key)))
    rows = dense_index(hashed, "_h", name="_i", ties=[key], hashed=True)
    text = F.try_variant_get(F.try_parse_json(F.col(line)), "$.system_prompt", "string")
    number = F.col("_i") % SEEDS_PER_PROMPT + 1
    rows = rows.select(F.floor(F.col("_i") / SEEDS_PER_PROMPT).alias("batch_id"), number.alias("n"), text.alias("t"))
    entry = F.when(F.col("t").isNotNull(), F.concat(F.col("n").cast("string"), F.lit("."), "t", F.lit("\n\n")))
    batches = rows.groupBy("batch_id").agg(
        F.array_sort(F.collect_list(F.struct("n", F.coalesce(entry, F.lit("")).alias("e")))).alias("_e"),
        F.max(F.when(F.col("n") == SEEDS_PER_PROMPT, F.col("t").isNotNull())).alias("_full"),
    )
    prompt = F.concat(F.lit(EXPAND_ASK), F.array_join(F.transform("_e", lambda x: x["e"]), ""))
    return batches.where("_full").select("batch_id", prompt.alias("prompt"))


def role_prompt(nurse: Column, patient: Column) -> Column:
    """The system prompt naming both roles."""
    return F.concat(F.lit("护士角色："), nurse, F.lit("\n患者角色："), patient, F.lit("\n"))
