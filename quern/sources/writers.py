"""Sinks. Every writer produces a folder of part files, one per task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines in UTF-8, null keys kept."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_results(df: DataFrame, path: str, resume: bool) -> None:
    """Fresh runs replace the result folder, resumed runs add to it."""
    write_jsonl(df, path, "append" if resume else "overwrite")


def run_identity(summary: DataFrame, base_model: Column, lora_model: Column) -> DataFrame:
    """A summary with the models of its run: the base and the adapter on it, null without one."""
    return summary.withColumns({"base_model": base_model, "lora_model": lora_model})


def write_summary(summary: DataFrame, path: str) -> None:
    """One summary object per model and dataset, in folders named after them; only the folders of these are replaced."""
    out = summary.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", False)
    out.partitionBy("model_label", "eval_dataset").json(path)
