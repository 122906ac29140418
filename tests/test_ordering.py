"""Positions and caps against a plain sort, whatever the partitioning or the skew."""

import decimal
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from quern.operators import ordering, sampling, selection
from quern.operators.ordering import dense_index, first_n


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(5)
    keys = rng.sample(range(10_000_000), 3000)
    rows = [(k, "hot" if rng.random() < 0.6 else f"g{k % 7}", "x" * (k % 5)) for k in keys]
    return rows, spark.createDataFrame(rows, "k bigint, g string, t string")


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_dense_index_global(skewed, parts):
    rows, df = skewed
    got = {r["k"]: r["idx"] for r in dense_index(df.repartition(parts), "k").collect()}
    assert got == {k: i for i, k in enumerate(sorted(r[0] for r in rows))}


def test_dense_index_in_groups_with_a_hot_one(skewed):
    rows, df = skewed
    want = {}
    for g in {r[1] for r in rows}:
        for i, k in enumerate(sorted(r[0] for r in rows if r[1] == g)):
            want[k] = i
    assert {r["k"]: r["idx"] for r in dense_index(df, "k", by=["g"]).collect()} == want


def test_first_n_is_the_head_of_the_sort(skewed):
    rows, df = skewed
    got = sorted(r["k"] for r in first_n(df, 137, "k").collect())
    assert got == sorted(r[0] for r in rows)[:137]


def test_a_null_group_is_a_group(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "k bigint, g string")
    got = sorted((r["k"], r["idx"]) for r in dense_index(df, "k", by=["g"]).collect())
    assert got == [(1, 0), (2, 1), (3, 0)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "k bigint")
    assert dense_index(df, "k").count() == 0


@pytest.mark.parametrize("parts", [1, 7])
def test_seeded_shuffle_is_a_fixed_permutation(skewed, parts):
    rows, df = skewed
    order = sorted((hashlib.md5(f"42:{k}".encode()).hexdigest(), k) for k, _, _ in rows)
    got = {r["k"]: r["shuffle_pos"] for r in sampling.seeded_shuffle(df.repartition(parts), "k").collect()}
    assert got == {k: i for i, (_, k) in enumerate(order)}


def test_splits_are_disjoint_and_complete(skewed):
    rows, df = skewed
    out = sampling.split_head_percent(df, "k", 10)
    sides = {r["split"]: r["n"] for r in out.groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert sides == {"validation": 300, "train": 2700}
    tail = sampling.split_tail_holdout(df, "k", 100).where("split = 'eval'")
    assert sorted(r["k"] for r in tail.collect()) == sorted(r[0] for r in rows)[-100:]


def test_rank_by_value_with_few_values(skewed):
    rows, df = skewed
    df = df.withColumn("n", F.length("t"))
    got = {r["k"]: r["idx"] for r in sampling.rank_by_value(df, "n", "k").collect()}
    order = sorted((len(t), k) for k, _, t in rows)
    assert got == {k: i for i, (_, k) in enumerate(order)}


def test_null_keys_come_first_and_keep_positions_gapless(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c"), (None, "d")], "k bigint, t string")
    got = {r["t"]: r["idx"] for r in ordering.dense_index(df, "k", ties=["t"]).collect()}
    assert got == {"b": 0, "d": 1, "a": 2, "c": 3}
    hashed = df.withColumn("h", F.when(F.col("k").isNotNull(), ordering.hash_key(1, F.col("k"))))
    assert sorted(r["idx"] for r in ordering.dense_index(hashed, "h", ties=["t"], hashed=True).collect()) == [0, 1, 2, 3]


def test_positions_do_not_depend_on_the_number_of_buckets(skewed, monkeypatch):
    _, df = skewed
    once = {r["k"]: r["shuffle_pos"] for r in sampling.seeded_shuffle(df, "k").collect()}
    monkeypatch.setattr(ordering, "MIN_BUCKETS", 5000)
    assert once == {r["k"]: r["shuffle_pos"] for r in sampling.seeded_shuffle(df, "k").collect()}


def test_rows_without_a_length_stay(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None), (3, "a")], "k bigint, t string")
    got = {r["k"]: (r["batch_id"], r["padding"]) for r in sampling.length_batches(df, "k", "t", 2).collect()}
    assert got == {2: (0, None), 3: (0, 0), 1: (1, 0)}


def test_mix_takes_whole_small_sources(skewed):
    rows, df = skewed
    out = sampling.mix_sources(df, "g", "k", {"hot": 50, "g1": 10_000})
    sizes = {r["g"]: r["n"] for r in out.groupBy("g").agg(F.count("*").alias("n")).collect()}
    assert sizes == {"hot": 50, "g1": sum(1 for r in rows if r[1] == "g1")}


def test_shards_hold_each_row_once(skewed):
    rows, df = skewed
    out = sampling.shard_assign(df, "k", 8).collect()
    assert len(out) == len(rows)
    assert max(sum(r["shard"] == s for r in out) for s in range(8)) == 375


@pytest.mark.parametrize("kind", ["long", "text", "double", "decimal", "hot"])
def test_key_at_equals_sorting(spark, kind, monkeypatch):
    monkeypatch.setattr(selection, "FEW", 3)
    monkeypatch.setattr(selection, "BUCKETS", 16)
    rng = random.Random(kind)
    keys = {
        "long": [rng.randrange(-(2**63), 2**63) for _ in range(300)] + [-(2**63), 2**63 - 1],
        "text": ["".join(rng.choices("abé", k=rng.randrange(0, 12))) for _ in range(300)] + ["a" * 40 + c for c in "xyz"],
        "double": [rng.gauss(0, 10.0 ** rng.randrange(-5, 5)) for _ in range(300)],
        "decimal": [decimal.Decimal(rng.randrange(10**9)).scaleb(-3) for _ in range(300)],
        "hot": [7] * 5000 + list(range(40)),
    }[kind]
    schema = {"text": "string", "double": "double", "decimal": "decimal(20,3)"}.get(kind, "long")
    df = spark.createDataFrame([(k,) for k in keys] + [(None,)] * 3, f"k {schema}")
    order = sorted(keys, key=lambda k: k.encode() if isinstance(k, str) else k)
    for place in (0, 1, len(order) // 2, len(order) - 1):
        assert selection.key_at(df, "k", place) == order[place]
    assert selection.key_at(df, "k", len(order)) is None and selection.key_at(df, "k", -1) is None


def test_splits_of_ids_beyond_double_precision(spark):
    df = spark.range(2**53, 2**53 + 2000).withColumnRenamed("id", "k")
    assert sampling.split_head_percent(df, "k", 1).where("split = 'validation'").agg(F.count("*"), F.max("k")).first() == (20, 2**53 + 19)
    assert sampling.split_tail_holdout(df, "k", 7).where("split = 'eval'").agg(F.count("*"), F.min("k")).first() == (7, 2**53 + 1993)
    assert sampling.cap_samples(df, "k", 11).agg(F.count("*"), F.max("k")).first() == (11, 2**53 + 10)
    text = df.select(F.concat(F.lit("id"), F.col("k").cast("string")).alias("k")).unionByName(spark.createDataFrame([(None,)], "k string"))
    assert sampling.cap_samples(text, "k", 3).agg(F.count("*"), F.max("k")).first() == (3, f"id{2**53 + 1}")
    assert sampling.split_head_percent(df.limit(0), "k", 1).count() == 0 and sampling.cap_samples(df, "k", 99_999).count() == 2000


@pytest.mark.parametrize("step, base", [(1, 0), (3, 2**53 - 700), (1, 2**62)])
@pytest.mark.parametrize("rows", [1, 7, 5000])
def test_runs_are_whole_in_their_part(spark, step, base, rows):
    keys = [None, *range(base, base + 2000 * step, step)]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(5)
    got = ordering.dense_runs(df, "k", rows).collect()
    assert sorted((r["idx"], r["k"]) for r in got) == list(enumerate(keys))
    assert all(r["run"] == r["idx"] // rows for r in got)
    parts = {}
    for r in got:
        parts.setdefault(r["run"], set()).add(r["part"])
    assert all(len(p) == 1 for p in parts.values())
    assert ordering.dense_runs(df.limit(0), "k", rows).count() == 0


def test_rows_in_runs_are_shuffled_once(spark):
    from quern.operators import tokens as tok

    df = spark.range(3000).select(F.col("id").alias("k"), F.expr("sequence(0, int(id % 40))").alias("ids"))
    grouped = tok.pack_groups(df, "k", 10)
    batches = ordering.dense_runs(df, "k", 8).withColumn("labels", F.col("ids"))
    plans = [
        tok.pack_eos_blocks(grouped, "ids", 16), tok.pack_boundary_blocks(grouped, "ids", 16),
        tok.pad_batches(batches, ["part", "run"], "ids", "labels"),
    ]
    for p in plans:
        assert p._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
