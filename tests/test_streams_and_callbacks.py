"""Listener counters, running accuracy, dialog callbacks and length sketches."""

import random

from pyspark.sql import functions as F

from quern.operators import dialog, expand, scoring
from quern.operators import tokens as tok
from quern.session import scratch_dir
from quern.streaming import progress


def test_counters_follow_what_has_come_since(spark):
    src, base = scratch_dir(spark, "in"), scratch_dir(spark, "out")
    spark.range(100).write.parquet(src)
    stream = lambda: spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 3).parquet(src)
    kept, seen = progress.collect_accepted(stream(), F.col("id") % 4 == 0, "quarter", base)
    assert kept.count() == 25 and (seen.scanned, seen.collected) == (100, 25) and seen.batches > 1
    spark.range(100, 140).write.mode("append").parquet(src)
    kept, seen = progress.collect_accepted(stream(), F.col("id") % 4 == 0, "quarter", base)
    assert kept.count() == 35 and (seen.scanned, seen.collected) == (40, 10) and seen.summary()["yield_pct"] == 25.0
    kept, seen = progress.collect_accepted(stream(), F.col("id") % 4 == 0, "quarter", base)
    assert kept.count() == 35 and seen.summary() == {"scanned": 0, "collected": 0, "yield_pct": 0.0, "rows_per_second": 0.0}


def test_running_accuracy_equals_batch_after_each_call(spark):
    samples = spark.createDataFrame([(i, "e", f"q{i}", str(i), float(i)) for i in range(30)], "sample_id bigint, eval_dataset string, question string, ground_truth string, ground_truth_value double")
    schema = "sample_id bigint, model_label string, eval_dataset string, prediction string"
    path, base = scratch_dir(spark, "said"), scratch_dir(spark, "state")
    rng = random.Random(4)
    every = []
    for _ in range(3):
        more = [(i, rng.choice("ab"), "e", str(i + rng.randrange(2))) for i in range(30)]
        every += more
        spark.createDataFrame(more, schema).repartition(3).write.mode("append").parquet(path)
        got = progress.stream_accuracy(samples, path, schema, base, files=2)
        want = scoring.accuracy_summary(scoring.score_predictions(samples, spark.createDataFrame(every, schema)))
        assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    again = progress.stream_accuracy(samples, path, schema, base)  # nothing has come
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got.collect()))


def test_callbacks_make_the_pairs_of_dialogs(spark):
    rng = random.Random(11)
    rows = []
    for c in range(150):
        for t in range(rng.randrange(0, 9)):
            role = rng.choices([("human", "gpt")[t % 2], "human", "gpt", "system", "robot", None], [12, 2, 2, 1, 1, 0.5])[0]
            rows.append((c, t, role, rng.choice(["", "x", f"{c}-{t}"]), "own" if c % 3 == 0 else None))
    turns = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string, system_prompt string").repartition(7)
    schema = "pair_idx bigint, query string, response string, system string"
    got = expand.expand_dialogs(turns, "conv_id", "turn", schema, expand.prompts_of_dialog)
    want = dialog.dialog_pairs(turns, system_turns=False)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect())) and want.count() > 50
    three = expand.expand_dialogs(turns, "conv_id", "turn", "n int, said string", lambda rows: [(len(rows), r["text"]) for r in rows[:3]])
    assert three.groupBy("conv_id").count().agg(F.max("count")).first()[0] == 3
    assert expand.expand_dialogs(turns.limit(0), "conv_id", "turn", schema, expand.prompts_of_dialog).count() == 0


def test_length_sketches_merge_to_the_percentiles_of_any_union(spark):
    df = spark.range(60_000).select((F.col("id") % 5).alias("source"), (F.col("id") * 7919 % 10_007).alias("n"))
    path = scratch_dir(spark, "sketches")
    tok.length_sketches(df, "n", ["source"]).write.parquet(path)
    for some in ([0], [1, 3], [0, 1, 2, 3, 4]):
        lengths = sorted(r["n"] for r in df.where(F.col("source").isin(some)).collect())
        got = tok.merged_profile(spark.read.parquet(path).where(F.col("source").isin(some)), [0.5, 0.9]).first()
        assert got["n"] == len(lengths)
        for q in (0.5, 0.9):
            rank = sum(x <= got[f"q_{round(100 * q)}"] for x in lengths) / len(lengths)
            assert abs(rank - q) <= tok.SKETCH_ERROR + 0.001  # equal lengths
