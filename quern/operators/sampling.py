"""Deterministic shuffles, splits, caps, mixes and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from quern.operators.ordering import dense_index, first_n, hash_key
from quern.operators.selection import key_at


def row_total(df: DataFrame) -> Column:
    """The row count as a scalar subquery."""
    return df.select(F.count(F.lit(1))).scalar()


def seeded_shuffle(df: DataFrame, key: str, seed: int = 42, name: str = "shuffle_pos") -> DataFrame:
    """Position of every row in a seeded permutation."""
    hashed = df.withColumn("_h", hash_key(seed, F.col(key)))
    return dense_index(hashed, "_h", name=name, ties=[key], hashed=True).drop("_h")


def buffered_shuffle(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """Shuffle inside each partition only: no exchange."""
    h = hash_key(seed, F.col(key))
    return df.sortWithinPartitions(h, key)


def _first_keys(df: DataFrame, key: str, n: int) -> Column:
    """Whether a row is among the first ``n`` in key order; keys are unique, null ones come first."""
    nulls = df.where(F.col(key).isNull()).count()
    last = key_at(df, key, n - nulls - 1)
    if last is None:
        return F.lit(True) if n > nulls else F.col(key).isNull() if n else F.lit(False)
    return F.col(key).isNull() | (F.col(key) <= F.lit(last))


def split_head_percent(df: DataFrame, key: str, percent: int = 1) -> DataFrame:
    """``validation`` for the first ``percent`` % in key order (half up), else ``train``. Keys are unique.

    The last key of the head is found by :func:`quern.operators.selection.key_at`, which compares keys on their own type
    and sorts nothing; rows are compared with that key where they are. Null keys come first.
    """
    cut = (df.count() * percent * 2 + 100) // 200
    return df.withColumn("split", F.when(_first_keys(df, key, cut), "validation").otherwise("train"))


def split_random_percent(df: DataFrame, key: str, percent: float, seed: int = 42) -> DataFrame:
    """Hash split: a row's side depends on nothing but its key, and nothing is shuffled."""
    bucket = F.pmod(F.conv(F.substring(hash_key(seed, F.col(key)), 1, 8), 16, 10).cast("bigint"), F.lit(10000))
    return df.withColumn("split", F.when(bucket < int(round(percent * 100)), "validation").otherwise("train"))


def split_tail_holdout(df: DataFrame, key: str, holdout: int = 100) -> DataFrame:
    """The last ``holdout`` rows in key order are ``eval``, the rest ``train``; nothing is sorted. Null keys come first."""
    held = ~_first_keys(df, key, max(0, df.count() - holdout))
    return df.withColumn("split", F.when(held, "eval").otherwise("train"))


def cap_samples(df: DataFrame, key: str, cap: int | None) -> DataFrame:
    """First ``cap`` rows in key order, null keys first; no cap or a cap below one keeps all. Nothing is sorted."""
    if cap is None or cap <= 0:
        return df
    return df.where(_first_keys(df, key, cap))


def shuffle_then_cap(df: DataFrame, key: str, cap: int, seed: int = 42) -> DataFrame:
    hashed = df.withColumn("_h", hash_key(seed, F.col(key)))
    return first_n(hashed, cap, "_h", name="_i", ties=[key], hashed=True).drop("_i", "_h")


def mix_sources(df: DataFrame, source: str, key: str, quotas: dict[str, int], seed: int = 42) -> DataFrame:
    """Up to ``quotas[s]`` rows of each named source ``s`` in seeded order, with ``pick`` as the position."""
    pairs = [x for s, q in quotas.items() for x in (F.lit(s), F.lit(q))]
    quota = F.try_element_at(F.create_map(*pairs), F.col(source))
    hashed = df.where(F.col(source).isin(list(quotas))).withColumn("_h", hash_key(seed, F.col(key)))
    return first_n(hashed, quota, "_h", by=[source], name="pick", ties=[key], hashed=True).drop("_h")


def source_shares(mixed: DataFrame, source: str) -> DataFrame:
    """Rows per source and their share of the mix."""
    counts = mixed.groupBy(source).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.round(F.col("n") / row_total(mixed), 6))


def sample_until_quota(df: DataFrame, key: str, accept: Column, quota: int, seed: int = 42) -> DataFrame:
    """The first ``quota`` accepted rows of a seeded scan, with their place in the scan and among the accepted.

    The hash of the last accepted row bounds the scan, so only the rows up to there are placed.
    """
    hashed = df.withColumn("_h", hash_key(seed, F.col(key)))
    taken = hashed.where(accept).select("_h").orderBy("_h").limit(quota)
    scanned = hashed.where(F.col("_h") <= taken.select(F.max("_h")).scalar())
    placed = dense_index(scanned, "_h", name="scan_pos", ties=[key], hashed=True)
    accepted = dense_index(placed.where(accept), "_h", name="pick", ties=[key], hashed=True)
    return accepted.where(F.col("pick") < quota).drop("_h")


def watched(df: DataFrame, accept: Column, name: str = "scan") -> tuple[DataFrame, Observation]:
    """``df`` with counters that fill while an action reads it: rows ``scanned`` and ``collected``, ``first`` and
    ``last`` microsecond of the scan. :func:`throughput` reads them."""
    seen = Observation(name)
    now = F.unix_micros(F.timestamp_micros(F.reflect(F.lit("java.lang.System"), F.lit("currentTimeMillis")).cast("bigint") * 1000))
    timed = df.withColumn("_at", now)
    out = timed.observe(
        seen, F.count(F.lit(1)).alias("scanned"), F.count_if(accept).alias("collected"),
        F.min("_at").alias("first"), F.max("_at").alias("last"),
    )
    return out.drop("_at"), seen


def throughput(seen: Observation) -> dict[str, float]:
    """Counters of a finished scan with the share collected in percent and the rows scanned per second."""
    got = seen.get
    seconds = max((got["last"] or 0) - (got["first"] or 0), 1) / 1e6
    share = 100.0 * got["collected"] / got["scanned"] if got["scanned"] else 0.0
    return {"scanned": got["scanned"], "collected": got["collected"], "yield_pct": share, "rows_per_second": got["scanned"] / seconds}


def scan_counters(sample: DataFrame) -> DataFrame:
    """Rows scanned until the quota was met, rows collected, and the yield."""
    scanned = F.coalesce(F.max("scan_pos") + 1, F.lit(0))
    return sample.agg(scanned.alias("scanned"), F.count(F.lit(1)).alias("collected")).withColumn(
        "yield_pct", F.round(F.coalesce(F.try_divide(100.0 * F.col("collected"), F.col("scanned")), F.lit(0.0)), 6)
    )


def rank_by_value(df: DataFrame, value: str, key: str, name: str = "idx") -> DataFrame:
    """Position in ``(value, key)`` order where ``value`` has a bounded set of values (such as a text length).

    Each value is indexed in key buckets, so a value shared by very many rows is spread out; the offsets of the
    values come from one row per value. Rows without a value come first.
    """
    inner = dense_index(df, key, by=[value], name="_in")
    totals = df.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy(F.col(value).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    offs = totals.select(F.col(value).alias("_v"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    placed = inner.join(offs, F.col(value).eqNullSafe(F.col("_v")))
    return placed.withColumn(name, (F.col("_in") + F.col("_o")).cast("bigint")).drop("_in", "_o", "_v")


def length_batches(df: DataFrame, key: str, text: str, batch: int) -> DataFrame:
    """Batches of ``batch`` rows of similar length, each row with the padding it would need."""
    sized = df.withColumn("n_chars", F.length(text).cast("bigint"))
    ranked = rank_by_value(sized, "n_chars", key, "_i").withColumn("batch_id", F.floor(F.col("_i") / batch))
    widest = F.max("n_chars").over(Window.partitionBy("batch_id"))
    return ranked.withColumn("padding", widest - F.col("n_chars")).drop("_i")


def shard_assign(df: DataFrame, key: str, world: int) -> DataFrame:
    """Round-robin shard of every row, each row exactly once."""
    return dense_index(df, key, name="_i").withColumn("shard", F.pmod("_i", F.lit(world))).drop("_i")


def seed_pairs(draws: DataFrame, draw_key: str, first: DataFrame, second: DataFrame, key: str, text: str) -> DataFrame:
    """For every draw one hashed pick from each seed table, joined by seed position."""

    def pick(salt: str, seeds: DataFrame) -> Column:
        h = F.conv(F.substring(hash_key(salt, F.col(draw_key)), 1, 8), 16, 10).cast("bigint")
        return F.pmod(h, row_total(seeds))

    a = dense_index(first, key, name="_ia").select("_ia", F.col(text).alias("first_text"))
    b = dense_index(second, key, name="_ib").select("_ib", F.col(text).alias("second_text"))
    drawn = draws.withColumn("_ia", pick("a", first)).withColumn("_ib", pick("b", second))
    return drawn.join(a, "_ia").join(b, "_ib").drop("_ia", "_ib")


def union_shuffle(parts: dict[str, DataFrame], key: str, text: str, seed: int = 42) -> DataFrame:
    """Several corpora as one, with the position of each row in a seeded permutation."""
    out = None
    for origin, df in parts.items():
        part = df.select(F.lit(origin).alias("origin"), F.col(key).cast("string").alias("row_key"), F.col(text).alias("text"))
        out = part if out is None else out.unionByName(part)
    hashed = out.withColumn("_h", hash_key(seed, F.col("origin"), F.col("row_key")))
    return dense_index(hashed, "_h", name="shuffle_pos", ties=["origin", "row_key"], hashed=True).drop("_h")
