"""Scoring of predictions, accuracy tables, rewards, losses and perplexities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import answers
from quern.functions.text import tokens
from quern.operators.filters import IGNORE

RUN = ["model_label", "eval_dataset"]


def score_predictions(samples: DataFrame, predictions: DataFrame) -> DataFrame:
    """Join predictions to samples by id and mark each as correct or not.

    Normalised equality decides first where there is a gold text; whenever it does not say yes, the numbers decide
    if the sample has a value. ``verify_path`` names the rule that settled the row.
    """
    rows = predictions.join(samples, ["sample_id", "eval_dataset"])
    has_text = F.coalesce(F.col("ground_truth"), F.lit("")) != ""
    path = F.when(has_text, answers.verify_path(F.col("prediction"), F.col("ground_truth"))).otherwise("unparsed")
    rows = rows.withColumn("_p", path)  # used three times below, so it stays a column of its own
    equal = F.col("_p").isin("text", "value")
    by_value = ~equal & F.col("ground_truth_value").isNotNull()
    number = answers.verify_numeric(F.col("prediction"), F.col("ground_truth_value"))
    score = F.when(equal, 1.0).when(by_value, number).otherwise(0.0)
    rows = rows.withColumn("correct", score > 0.5).withColumn(
        "verify_path", F.when(by_value, "number").otherwise(F.col("_p"))
    )
    return rows.select(
        "sample_id", *RUN, "question", "ground_truth", "ground_truth_value", "prediction", "verify_path", "correct"
    )


def accuracy_summary(results: DataFrame, by: Sequence[str] = RUN) -> DataFrame:
    """``total, correct, accuracy`` (percent, two places, half even) per run."""
    share = F.coalesce(F.try_divide(100.0 * F.col("correct"), F.col("total")), F.lit(0.0))
    out = results.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("correct")).alias("correct"))
    return out.withColumn("accuracy", F.bround(share, 2))


def compare_models(summary: DataFrame, datasets: Sequence[str]) -> DataFrame:
    """One row per model, one percentage column per dataset, ``N/A`` where a run is missing."""
    wide = summary.groupBy("model_label").pivot("eval_dataset", list(datasets)).agg(F.first("accuracy"))
    shown = [
        F.when(F.col(f"`{d}`").isNull(), "N/A").otherwise(F.format_string("%.2f%%", F.col(f"`{d}`"))).alias(d)
        for d in datasets
    ]
    return wide.select("model_label", *shown)


def pending_predictions(predictions: DataFrame, results: DataFrame) -> DataFrame:
    """Predictions that have no result yet."""
    return predictions.join(results.select("sample_id", *RUN), ["sample_id", *RUN], "left_anti")


def resume_scoring(samples: DataFrame, predictions: DataFrame, results: DataFrame) -> DataFrame:
    """Old results and those of the not yet scored predictions; running it again adds nothing."""
    fresh = score_predictions(samples, pending_predictions(predictions, results))
    return results.unionByName(fresh)


def reward_table(df: DataFrame, keys: Sequence[str], rewards: dict[str, Column]) -> DataFrame:
    """One row per completion and reward function."""
    cells = F.array(
        *[F.struct(F.lit(name).alias("reward"), value.alias("value")) for name, value in rewards.items()]
    )
    return df.select(*keys, F.inline(cells))


def token_accuracy(pairs: DataFrame, pair_col: str, mask_ignored: bool = False) -> DataFrame:
    """Share of equal ``(pred, label)`` pairs over all rows; ignored labels count unless masked."""
    used = F.filter(pair_col, lambda x: x["label"] != IGNORE) if mask_ignored else F.col(pair_col)
    per_row = pairs.select(
        F.size(used).alias("n"), F.size(F.filter(used, lambda x: x["pred"] == x["label"])).alias("hits")
    )
    out = per_row.agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
    return out.withColumn("accuracy", F.coalesce(F.try_divide(F.col("hits"), F.col("n")), F.lit(0.0)))


def reward_errors(chosen: Column, rejected: Column) -> list[Column]:
    """Mean squared and mean absolute difference of the two scores."""
    return [F.avg(F.pow(chosen - rejected, 2)).alias("mse"), F.avg(F.abs(chosen - rejected)).alias("mae")]


def pairwise_logloss(chosen: Column, rejected: Column) -> Column:
    """Mean of ``-log(sigmoid(chosen - rejected))``, safe for large differences."""
    x = chosen - rejected
    return F.avg(F.greatest(-x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x))))


def perplexity(loss: Column) -> Column:
    """exp of the mean loss; infinite on overflow."""
    return F.exp(F.avg(loss))


def mean_of_batch_losses(df: DataFrame, batch: str, loss: str) -> DataFrame:
    """Average of the batches' mean losses, with its perplexity."""
    per_batch = df.groupBy(batch).agg(F.avg(loss).alias("_m"))
    mean = per_batch.agg(F.avg("_m").alias("eval_loss"), F.count(F.lit(1)).alias("n_batches"))
    return mean.withColumn("perplexity", F.exp("eval_loss"))


def pair_perplexity(loss: Column, seq_len: Column, target_chars: Column) -> Column:
    """exp of the summed, length-weighted losses over rows times total target characters.

    The denominator counts the rows and the characters; it is kept because results are compared under this formula.
    """
    total = F.sum(loss * seq_len)
    return F.exp(total / (F.count(F.lit(1)) * F.sum(target_chars)))


HEAVY_SHARE = 1 / 65_536


def unigram_perplexity(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``n_tokens, nll, perplexity`` of every document under the corpus's own unigram model with add-one smoothing.

    Words that make up at least ``HEAVY_SHARE`` of the corpus number at most 65 536, so they are priced by a broadcast
    join and added up where they are. Only the rarer ones are shuffled, counted per document first, so that none is more
    than a small part of what a task reads. Documents without words stay, with no perplexity. Keys are unique.
    """
    words = docs.select(key, F.explode(tokens(F.col(text))).alias("piece"))
    counts = words.groupBy("piece").agg(F.count(F.lit(1)).alias("c"))
    sizes = counts.select(F.struct(F.sum("c").alias("total"), F.count(F.lit(1)).alias("kinds"))).scalar()
    nll = -F.log((F.col("c") + 1) / (sizes["total"] + sizes["kinds"]))
    heavy = F.col("c") >= sizes["total"] * F.lit(HEAVY_SHARE)
    held = words.join(F.broadcast(counts.where(heavy).select("piece", nll.alias("nll"))), "piece", "left")
    rare = F.when(F.col("nll").isNull(), F.col("piece"))
    held = held.select(key, rare.alias("rare"), "nll").groupBy(key, "rare").agg(F.count(F.lit(1)).alias("n"), F.sum("nll").alias("s"))
    light = counts.where(~heavy).select(F.col("piece").alias("rare"), nll.alias("nll"))
    others = held.where(F.col("rare").isNotNull()).select(key, "rare", "n").join(light, "rare")
    sums = held.where(F.col("rare").isNull()).select(key, "n", "s").unionByName(others.select(key, "n", (F.col("n") * F.col("nll")).alias("s")))
    scored = sums.groupBy(key).agg(F.sum("n").alias("n_tokens"), (F.sum("s") / F.sum("n")).alias("nll"))
    out = docs.select(key).join(scored, key, "left").withColumn("n_tokens", F.coalesce("n_tokens", F.lit(0)))
    return out.withColumn("perplexity", F.exp("nll"))


def usage(df: DataFrame, key: str, role: str, text: str) -> DataFrame:
    """Prompt, completion and total token counts."""
    n = F.size(tokens(F.col(text)))
    rows = df.select(key, F.when(F.col(role) == "assistant", 0).otherwise(n).alias("p"), F.when(F.col(role) == "assistant", n).otherwise(0).alias("c"))
    out = rows.groupBy(key).agg(F.sum("p").alias("prompt_tokens"), F.sum("c").alias("completion_tokens"))
    return out.withColumn("total_tokens", F.col("prompt_tokens") + F.col("completion_tokens"))
