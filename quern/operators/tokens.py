"""Vocabularies, encoding, truncation, padding and packing of token sequences."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.text import all_cjk, let, nfkc, relisted, starts, tokens
from quern.operators.filters import IGNORE
from quern.operators.ordering import dense_runs
from quern.session import ensure_checkpoint_dir, scratch_dir, shuffle_width

# Reserved ids and the default vocabulary size.
UNK, BOS, EOS, PAD = 0, 1, 2, 3
RESERVED, BYTES = 4, 256
VOCAB_SIZE = 2236

MAX_LOOKUP = 200_000  # largest vocabulary that is shipped to every task
HOT_SHARE = 1 / 16_777_216  # pieces above this share of the tokens are hot, ``MAX_LOOKUP`` of them at most


# ---------------------------------------------------------------- vocabularies


def piece_counts(df: DataFrame, text: str = "text", normalize: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """Frequency of every token of a corpus (for each value of ``by``, if given), in compatibility form if asked; counts
    are combined before the exchange."""
    c = nfkc(F.col(text)) if normalize else F.col(text)
    return df.select(*by, F.explode(tokens(c)).alias("piece")).groupBy(*by, "piece").agg(F.count(F.lit(1)).alias("freq"))


def build_vocab(counts: DataFrame, size: int = VOCAB_SIZE, byte_fallback: bool = False) -> DataFrame:
    """The ``size`` most frequent pieces with ids after the reserved ones; ties in piece order.

    With ``byte_fallback`` the 256 ids after the reserved ones stand for single bytes, see :func:`encode_or_bytes`.
    """
    if size > MAX_LOOKUP:
        raise ValueError(f"a vocabulary holds at most {MAX_LOOKUP} pieces")
    first = RESERVED + (BYTES if byte_fallback else 0)
    top = counts.orderBy(F.desc("freq"), "piece").limit(size)
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("freq"), "piece"))
    return top.select((rank + first - 1).alias("id"), "piece", "freq")


def merge_vocab(
    base: DataFrame, domain: DataFrame, listed: DataFrame, frequent: DataFrame, top_n: int = 20_000
) -> DataFrame:
    """``id, piece, stage, score``: the base vocabulary, then what each further list adds to it.

    A piece belongs to the first list that has it: base, domain, the CJK-only pieces of ``listed``, the ``top_n`` most
    frequent of ``frequent``. Added pieces score zero, base pieces keep their score. Ids follow the reserved ones: the
    base in the order of its scores, then the added pieces list by list, so base ids stay when lists are added.
    """
    top = frequent.orderBy(F.desc("freq"), "piece").limit(top_n)
    none = F.lit(None).cast("double")
    parts = [
        base.select("piece", F.lit(0).alias("stage"), F.col("score").cast("double").alias("score")),
        domain.select("piece", F.lit(1).alias("stage"), none.alias("score")),
        listed.where(all_cjk(F.col("piece"))).select("piece", F.lit(2).alias("stage"), none.alias("score")),
        top.select("piece", F.lit(3).alias("stage"), none.alias("score")),
    ]
    pieces = parts[0]
    for p in parts[1:]:
        pieces = pieces.unionByName(p)
    merged = pieces.groupBy("piece").agg(F.min("stage").alias("stage"), F.max("score").alias("_s"))
    scored = merged.select("piece", "stage", F.when(F.col("stage") == 0, F.col("_s")).otherwise(0.0).alias("score"))
    order = Window.partitionBy(F.lit(0)).orderBy("stage", F.desc("score"), "piece")  # a vocabulary fits a task
    return scored.select((F.row_number().over(order) + RESERVED - 1).alias("id"), "piece", "stage", "score")


SYMBOL_GAP = "  "


def _spaced(symbols: Column) -> Column:
    """Symbols as text, each between its own blanks, so that neighbours can be replaced as a unit."""
    return F.concat(F.lit(" "), F.array_join(symbols, SYMBOL_GAP), F.lit(" "))


def _symbols(w: Column) -> Column:
    return F.split(F.btrim(w), SYMBOL_GAP)


def _pairs(symbols: str, weight: Column) -> Column:
    """Neighbouring symbols of a symbol column with the word's weight, as an array."""
    return F.zip_with(
        symbols,
        F.slice(symbols, F.lit(2), F.greatest(F.size(symbols) - 1, F.lit(0))),
        lambda a, b: F.struct(a.alias("a"), b.alias("b"), weight.alias("k")),
    )


def _pair_sums(found: DataFrame) -> DataFrame:
    """Summed weights of the exploded pairs; a word's last symbol has no neighbour and is left out."""
    return found.where("p.b is not null").groupBy("p.a", "p.b").agg(F.sum("p.k").alias("n"))


#: Most frequent pairs that a round of training looks at, and pairs that it joins at most.
TOP_PAIRS, MAX_BATCH = 64, 32


def merge_batch(top: list[tuple[str, str, int]], whole: bool, formed: set[str], room: int = MAX_BATCH) -> list[tuple[str, str, int]]:
    """The first pairs of ``top`` (most frequent first, ties in order; ``whole`` if these are all) that can be joined in
    one round with the result of joining one after another.

    No symbol is the first of one pair and the second of another, so no join changes another's count. A pair that a join
    makes is at most as frequent as a pair that overlaps the joined one, and the first such pair ends the list: what
    comes before it and is more frequent stays ahead of all new pairs. At equal counts a new pair comes later if the
    joined symbols, which may stand first in it, come behind the pair's own first symbol. A symbol that was ``formed``
    before ends the list, as its pairs are counted together with older ones.
    """
    firsts: set[str] = set()
    seconds: set[str] = set()
    apart = []
    cut = 0 if whole else top[-1][2]
    for a, b, n in top:
        if a in seconds or b in firsts or a == b:
            cut = n
            break
        firsts.add(a)
        seconds.add(b)
        apart.append((a, b, n))
    out: list[tuple[str, str, int]] = []
    known = set(formed)
    for a, b, n in apart[: min(room, MAX_BATCH)] or top[:1]:
        if out and n <= cut and any(x + y <= a for x, y, _ in out):
            break
        out.append((a, b, n))
        if a + b in known:
            break
        known.add(a + b)
    return out


def merges_to_size(counts: DataFrame, size: int = VOCAB_SIZE) -> int:
    """Merges that fill a vocabulary of ``size`` pieces beside the reserved ids and the alphabet."""
    letters = counts.select(F.explode(F.split("piece", "")).alias("c")).where("c <> ''").distinct().count()
    return max(0, size - RESERVED - letters)


def train_bpe_merges(
    spark: SparkSession, counts: DataFrame, n_merges: int | None = None, rewrite_every: int = 8, size: int = VOCAB_SIZE
) -> DataFrame:
    """``round, first, second, freq``: the most frequent neighbouring pair of each round, joined before the next.

    Works on the word-frequency table; without ``n_merges`` up to a vocabulary of ``size`` pieces. Pair counts are taken
    once. A pass joins all pairs of :func:`merge_batch`, so several rounds are one pass; it recounts only the words that
    hold one of them and adds the difference. Word and pair tables are cut from their lineage through the checkpoint
    folder, and the few most frequent pairs are all that reaches the driver. Ties go to the smaller pair.
    """
    ensure_checkpoint_dir(spark)
    n_merges = merges_to_size(counts, size) if n_merges is None else n_merges
    spread = counts.repartition(shuffle_width(spark), "piece")
    words = spread.select(_spaced(F.split("piece", "")).alias("w"), "freq").checkpoint()
    every = words.select(_symbols(F.col("w")).alias("s"), "freq")
    pairs = _pair_sums(every.select(F.explode(_pairs("s", F.col("freq"))).alias("p"))).checkpoint()
    merges: list[tuple[int, str, str, int]] = []
    formed: set[str] = set()
    since = 0
    while len(merges) < n_merges:
        top = [tuple(r) for r in pairs.orderBy(F.desc("n"), "a", "b").limit(TOP_PAIRS).collect()]
        if not top:
            break
        batch = merge_batch(top, len(top) < TOP_PAIRS, formed, n_merges - len(merges))
        merges += [(len(merges) + i, a, b, n) for i, (a, b, n) in enumerate(batch)]
        formed |= {a + b for a, b, _ in batch}
        if len(merges) >= n_merges:
            break
        held, joined = F.lit(False), F.col("w")
        for a, b, _ in batch:
            apart = F.lit(f" {a}{SYMBOL_GAP}{b} ")
            held = held | F.col("w").contains(apart)
            joined = F.replace(joined, apart, F.lit(f" {a}{b} "))
        changed = words.where(held).select("freq", _symbols(F.col("w")).alias("s"), _symbols(joined).alias("t"))
        change = F.concat(_pairs("s", -F.col("freq")), _pairs("t", F.col("freq")))
        delta = _pair_sums(changed.select(F.explode(change).alias("p")))
        pairs = pairs.unionByName(delta).groupBy("a", "b").agg(F.sum("n").alias("n")).where("n > 0").checkpoint()
        words = words.withColumn("w", joined)
        since += len(batch)
        if since >= rewrite_every:
            words, since = words.checkpoint(), 0
    return spark.createDataFrame(merges, "round int, first string, second string, freq bigint")


# ---------------------------------------------------------------- encoding


def lookup_table(vocab: DataFrame, buckets: int = 1024, kind: str = "int") -> Column:
    """The vocabulary (``piece, id``) as one small hash table (an array of maps), read by every task as a scalar.

    More than ``MAX_LOOKUP`` pieces are an error, raised before they are gathered. Looking a token up costs one array
    access and a map of a few entries, so texts are encoded in place, without exploding or shuffling tokens.
    """
    b = F.pmod(F.xxhash64("piece"), F.lit(buckets)).cast("int")
    n = vocab.select(F.count(F.lit(1))).scalar()
    few = F.when(n <= MAX_LOOKUP, F.col("id").cast(kind)).otherwise(
        F.raise_error(F.lit(f"a vocabulary of more than {MAX_LOOKUP} pieces")).cast(kind)
    )
    entries = vocab.select(b.alias("b"), "piece", few.alias("id"))
    filled = entries.groupBy("b").agg(F.array_sort(F.collect_list(F.struct("piece", "id"))).alias("e"))
    every = vocab.sparkSession.range(buckets).select(F.col("id").cast("int").alias("b"))
    none = F.array().cast(f"array<struct<piece:string,id:{kind}>>")
    rows = every.join(filled, "b", "left").select("b", F.coalesce("e", none).alias("e"))
    table = rows.agg(F.array_sort(F.collect_list(F.struct("b", "e"))).alias("t"))
    return table.select(F.transform("t", lambda x: F.map_from_entries(x["e"])).alias("t")).scalar()


def encode(token_array: Column, table: Column, buckets: int = 1024, unknown: int = UNK) -> Column:
    """Ids of a token array through :func:`lookup_table`."""
    return F.transform(
        token_array,
        lambda t: F.coalesce(
            F.try_element_at(F.get(table, F.pmod(F.xxhash64(t), F.lit(buckets)).cast("int")), t), F.lit(unknown)
        ),
    )


def encode_or_bytes(token_array: Column, table: Column, buckets: int = 1024) -> Column:
    """Ids of a token array where an unknown token becomes the ids of its UTF-8 bytes; an empty or null one is a null id.

    Bytes are spelt out a batch of rows at a time, and stand in where the table has no id.
    """
    ids = T.ArrayType(T.IntegerType())

    @F.arrow_udf(T.StructType([T.StructField("t", T.ArrayType(T.StringType())), T.StructField("b", T.ArrayType(ids))]))
    def spelt(rows: pa.Array) -> pa.Array:
        raw = rows.flatten().cast(pa.large_binary())
        size = pc.fill_null(pc.binary_length(raw), 0).to_numpy(zero_copy_only=False)
        at = starts(np.maximum(size, 1))
        void = np.zeros(at[-1], bool)
        void[at[:-1][size == 0]] = True
        out = np.zeros(at[-1], np.int32)
        out[~void] = np.frombuffer(b"".join(raw.drop_null().to_pylist()), np.uint8).astype(np.int32) + RESERVED
        spelling = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(out, mask=void))
        return pa.StructArray.from_arrays([rows, relisted(rows, spelling)], ["t", "b"])

    return let(
        spelt(token_array),
        lambda x: F.flatten(F.zip_with(encode(x["t"], table, buckets, -1), x["b"], lambda i, b: F.when(i >= 0, F.array(i)).otherwise(b))),
    )


def encode_columns(df: DataFrame, texts: dict[str, str], vocab: DataFrame) -> DataFrame:
    """Add the id arrays ``{name: text column}``."""
    with_table = df.withColumn("_table", lookup_table(vocab))
    ids = [encode(tokens(F.col(text)), F.col("_table")).alias(name) for name, text in texts.items()]
    return with_table.select(*df.columns, *ids)


def encode_column(df: DataFrame, text: str, vocab: DataFrame, name: str = "ids") -> DataFrame:
    """Add the id array of a text column."""
    return encode_columns(df, {name: text}, vocab)


def encode_joined(
    df: DataFrame, key: str, text: str, vocab: DataFrame, name: str = "ids", counts: DataFrame | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add the id array of a text column under a vocabulary of any size; null texts stay null.

    The most frequent pieces of the texts, ``MAX_LOOKUP`` at most, are hot and looked up in place. Texts are cut into
    tokens once for that and the result is written. The other tokens meet the vocabulary by a shuffle on the piece, where
    none is more than a small part of the tokens, and are put back into their row. ``counts`` may hold the
    :func:`piece_counts` of the texts, ``keep`` the columns wanted beside the key (by default all).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    entries = vocab.select("piece", F.col("id").cast("int").alias("id"))
    counts = piece_counts(df, text).checkpoint() if counts is None else counts
    often = F.col("freq") >= counts.select(F.sum("freq")).scalar() * F.lit(HOT_SHARE)
    heavy = counts.where(often).orderBy(F.desc("freq"), "piece").limit(MAX_LOOKUP).select("piece")
    hot = heavy.join(entries, "piece", "left").select("piece", F.coalesce("id", F.lit(UNK)).alias("id")).toArrow()
    pieces, hot_ids = (hot[c].combine_chunks() for c in ("piece", "id"))
    kept = df.columns if keep is None else [key, *keep]
    parts = T.StructType([T.StructField("h", T.ArrayType(T.IntegerType())), T.StructField("r", T.ArrayType(T.StringType()))])

    @F.arrow_udf(parts)
    def looked_up(rows: pa.Array) -> pa.Array:
        words = rows.flatten()
        ids = pc.fill_null(hot_ids.take(pc.index_in(words, pieces)), -1)
        rare = ids.to_numpy(zero_copy_only=False) < 0
        others = relisted(rows, words.filter(pa.array(rare)), starts(rare))
        return pa.StructArray.from_arrays([relisted(rows, ids), others], ["h", "r"])

    met = df.select(*kept, looked_up(tokens(F.col(text))).alias("_x"))
    met = met.select(*kept, F.monotonically_increasing_id().alias("_i"), F.col("_x.h").alias("_h"), F.col("_x.r").alias("_r"))
    path = scratch_dir(spark, "looked-up")
    met.write.parquet(path)
    met = spark.read.schema(met.schema).parquet(path)
    asked = met.select("_i", F.posexplode("_r").alias("pos", "piece"))
    place = F.struct("pos", F.coalesce("id", F.lit(UNK)).alias("id"))
    back = asked.join(entries.hint("merge"), "piece", "left").groupBy("_i").agg(F.array_sort(F.collect_list(place)).alias("_p"))

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def filled(hot_ids: pa.Array, others: pa.Array) -> pa.Array:
        ids = hot_ids.flatten().to_numpy(zero_copy_only=False).copy()
        ids[ids < 0] = others.flatten().to_numpy(zero_copy_only=False)
        return relisted(hot_ids, pa.array(ids, pa.int32()))

    others = F.coalesce(F.transform("_p", lambda x: x["id"]), F.array().cast("array<int>"))
    return met.join(back.hint("merge"), "_i", "left").select(*kept, filled("_h", others).alias(name))


def encode_dialogs(
    pairs: DataFrame, source_ids: str, target_ids: str, max_length: int, train_on_inputs: bool = False
) -> DataFrame:
    """``conv_id, input_ids, attention_mask, labels`` of dialogs given as encoded pairs.

    Each pair is cut in proportion to its two lengths, an end mark follows each answer, and the dialog ends before
    the first pair that would exceed ``max_length``; a dialog whose first pair does has empty arrays. Every pair takes at least one place, so only the first
    ``max_length`` pairs of a dialog can be part of the result; nothing longer is ever gathered.
    """
    src, tgt = F.col(source_ids), F.col(target_ids)
    rows = pairs.where(F.col("pair_idx") < max_length)
    total = (F.size(src) + F.size(tgt)).cast("double")
    share = F.lit(float(max_length))
    max_src = F.coalesce((share * F.try_divide(F.size(src), total)).cast("int"), F.lit(0))
    max_tgt = F.coalesce((share * F.try_divide(F.size(tgt), total)).cast("int"), F.lit(0)) - 1
    keep_tgt = F.when(max_tgt >= 0, max_tgt).otherwise(F.greatest(F.size(tgt) + max_tgt, F.lit(0)))
    cut_src = F.when(F.size(src) > max_src, F.slice(src, F.lit(1), max_src)).otherwise(src)
    cut_tgt = F.when(F.size(tgt) > max_tgt, F.slice(tgt, F.lit(1), keep_tgt)).otherwise(tgt)
    rows = rows.select("conv_id", "pair_idx", cut_src.alias("_s"), cut_tgt.alias("_t"))
    s, t = F.col("_s"), F.col("_t")
    s = F.when(F.get(s, F.lit(0)) == EOS, F.slice(s, F.lit(2), F.greatest(F.size(s) - 1, F.lit(0)))).otherwise(s)
    t = F.when(F.get(t, F.size(t) - 1) == EOS, F.slice(t, F.lit(1), F.greatest(F.size(t) - 1, F.lit(0)))).otherwise(t)
    rows = rows.select("conv_id", "pair_idx", s.alias("s"), t.alias("t"))
    w = Window.partitionBy("conv_id").orderBy("pair_idx").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_used", F.sum(F.size("s") + F.size("t") + 1).over(w))
    end = F.array(F.lit(EOS))
    ids = F.concat("s", "t", end)
    learn = ids if train_on_inputs else F.concat(F.array_repeat(F.lit(IGNORE), F.size("s")), F.col("t"), end)
    piece = F.when(F.col("_used") <= max_length, F.struct("pair_idx", ids.alias("i"), learn.alias("l")))
    out = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(piece)).alias("p"))
    return out.select(
        "conv_id",
        F.flatten(F.transform("p", lambda x: x["i"])).alias("input_ids"),
        F.flatten(F.transform("p", lambda x: F.array_repeat(F.lit(1), F.size(x["i"])))).alias("attention_mask"),
        F.flatten(F.transform("p", lambda x: x["l"])).alias("labels"),
    )


def pad_fixed(ids: Column, block: int, left: bool = False, pad: int = PAD) -> Column:
    """Cut to ``block`` tokens, then pad to ``block``."""
    cut = F.slice(ids, 1, block)
    fill = F.array_repeat(F.lit(pad), block - F.size(cut))
    return F.concat(fill, cut) if left else F.concat(cut, fill)


# ---------------------------------------------------------------- packing


def _pieces(offset: Column, ids: Column, block: int) -> Column:
    """A document's tokens cut at block borders: ``(block, offset, ids)`` per block it touches."""
    first = F.floor(offset / block).cast("bigint")
    last = F.floor((offset + F.size(ids) - 1) / block).cast("bigint")

    def piece(b: Column) -> Column:
        start = F.greatest(b * block, offset)
        end = F.least((b + 1) * block, offset + F.size(ids))
        return F.struct(
            b.alias("block"),
            start.cast("bigint").alias("offset"),
            F.slice(ids, (start - offset + 1).cast("int"), (end - start).cast("int")).alias("ids"),
        )

    return F.when(F.size(ids) > 0, F.transform(F.sequence(first, last), piece))


def _blocks(rows: DataFrame, block: int, kept: Sequence[str] = ()) -> DataFrame:
    """``pack_group, block, input_ids`` from rows with ``pack_part, pack_group, idx, ids``, and the columns ``kept``, which
    are the same in all rows of a group.

    A group is a fixed number of documents, a part whole groups. Offsets come from a running sum inside the group; each
    block then gathers at most ``block`` tokens. Rows that are dealt by part stay where they are.
    """
    on = ["pack_part", "pack_group"]
    in_order = Window.partitionBy(*on).orderBy("idx")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*on)
    n = F.size("ids").cast("bigint")
    placed = rows.withColumn("_off", F.coalesce(F.sum(n).over(before), F.lit(0))).withColumn(
        "_total", F.sum(n).over(whole)
    )
    cut = placed.select(*on, *kept, "_total", F.explode(_pieces(F.col("_off"), F.col("ids"), block)).alias("p"))
    full = (F.col("p.block") + 1) * block <= F.col("_total")
    left = cut.where(full | (F.col("_total") < block))
    parts = F.array_sort(F.collect_list(F.struct("p.offset", "p.ids")))
    out = left.groupBy(*on, F.col("p.block").alias("block")).agg(parts.alias("x"), *(F.first(c).alias(c) for c in kept))
    return out.select("pack_group", "block", F.flatten(F.transform("x", lambda p: p["ids"])).alias("input_ids"), *kept)


def pack_groups(df: DataFrame, key: str, group_rows: int = 1000) -> DataFrame:
    """Add ``idx``, ``pack_group`` (consecutive runs of ``group_rows`` documents in key order) and ``pack_part``, by which
    the rows are dealt out; keys are unique."""
    return dense_runs(df, key, group_rows, run="pack_group", part="pack_part")


def pack_eos_blocks(grouped: DataFrame, ids: str, block: int) -> DataFrame:
    """Documents of each group joined with end marks between and cut into blocks; labels equal the input.

    The remainder of a group is dropped, unless the group is shorter than one block.
    """
    doc = F.col(ids)
    ended = F.coalesce(F.get(doc, F.size(doc) - 1) == EOS, F.lit(False))
    closed = F.when(ended, doc).otherwise(F.concat(doc, F.array(F.lit(EOS))))
    return _blocks(grouped.select("pack_part", "pack_group", "idx", closed.alias("ids")), block)


def pack_boundary_blocks(grouped: DataFrame, ids: str, block: int) -> DataFrame:
    """Documents without their first and last token, joined and cut to ``block - 2``, each block wrapped again in
    the boundary tokens of its group's first document."""
    doc = F.col(ids)
    inner = F.slice(doc, F.lit(2), F.greatest(F.size(doc) - 2, F.lit(0)))
    ends = F.struct(F.get(doc, F.lit(0)).alias("a"), F.get(doc, F.size(doc) - 1).alias("z"))
    first = F.first(ends).over(Window.partitionBy("pack_part", "pack_group").orderBy("idx"))
    rows = grouped.select("pack_part", "pack_group", "idx", inner.alias("ids"), first.alias("_w"))
    blocks = _blocks(rows, block - 2, ["_w"])
    wrapped = F.concat(F.array("_w.a"), F.col("input_ids"), F.array("_w.z"))
    return blocks.select("pack_group", "block", wrapped.alias("input_ids"))


def pad_batches(
    df: DataFrame, batch: str | list[str], ids: str, labels: str, multiple: int = 4, max_length: int | None = None
) -> DataFrame:
    """Pad every row to its batch's width: the longest row rounded up to ``multiple``, or ``max_length``.

    Batches of :func:`dense_runs` are named by part and run; their rows then stay where they are.
    """
    widest = F.max(F.size(ids)).over(Window.partitionBy(batch))
    width = F.lit(max_length) if max_length else (F.ceil(widest / multiple) * multiple).cast("int")
    rows = df.withColumn("width", width)
    gap = F.greatest(F.col("width") - F.size(ids), F.lit(0))
    mask = F.concat(F.array_repeat(F.lit(1), F.size(ids)), F.array_repeat(F.lit(0), gap))
    return (
        rows.withColumn("attention_mask", mask)
        .withColumn(labels, F.concat(F.col(labels), F.array_repeat(F.lit(IGNORE), gap)))
        .withColumn(ids, F.concat(F.col(ids), F.array_repeat(F.lit(PAD), gap)))
    )


def length_profile(df: DataFrame, length: str, limits: list[int], exact: bool = True) -> DataFrame:
    """P50, P90 and maximum of a length, and the share of rows within each limit.

    The exact percentile keeps one counter per distinct length, which text lengths bound; ``exact=False`` uses the
    approximate sketch.
    """
    c = F.col(length)
    pct = F.percentile if exact else F.percentile_approx
    return df.agg(
        pct(c, 0.5).cast("double").alias("p50"),
        pct(c, 0.9).cast("double").alias("p90"),
        F.max(c).alias("longest"),
        *[F.round(F.avg((c <= n).cast("double")), 6).alias(f"within_{n}") for n in limits],
    )


def left_truncate(ids: Column, context: int, max_new: int) -> Column:
    """The last ``context - max_new - 8`` tokens."""
    n = max(context - max_new - 8, 0)
    return F.slice(ids, F.greatest(F.size(ids) - n, F.lit(0)) + 1, F.lit(n))


def shift_pairs(preds: Column, labels: Column) -> Column:
    """``(pred, label)`` pairs: the prediction at each place with the label of the next."""
    n = F.greatest(F.size(labels) - 1, F.lit(0))
    return F.zip_with(
        F.slice(preds, F.lit(1), n),
        F.slice(labels, F.lit(2), n),
        lambda p, y: F.struct(p.alias("pred"), y.alias("label")),
    )


# ---------------------------------------------------------------- length sketches

#: Size parameter of the length sketches, whose ranks are then off by some 0.7 % of the rows, and twice that as the error
#: that is promised.
SKETCH_K, SKETCH_ERROR = 800, 0.0133


def length_sketches(df: DataFrame, length: str, by: list[str]) -> DataFrame:
    """``by, sketch``: a mergeable quantile sketch of the lengths of each group, some kilobytes each.

    A stored table of them gives the percentiles of any union of groups without the texts being read again. Null
    lengths take no part.
    """
    return df.groupBy(*by).agg(F.kll_sketch_agg_bigint(F.col(length).cast("bigint"), SKETCH_K).alias("sketch"))


def merged_profile(sketches: DataFrame, quantiles: list[float]) -> DataFrame:
    """One row: ``n`` lengths under all given sketches and their approximate quantiles ``q_<percent>``."""
    merged = sketches.agg(F.kll_merge_agg_bigint("sketch").alias("s"))
    found = [F.kll_sketch_get_quantile_bigint("s", F.lit(q)).alias(f"q_{round(100 * q)}") for q in quantiles]
    return merged.select(F.kll_sketch_get_n_bigint("s").alias("n"), *found)
