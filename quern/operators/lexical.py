"""A lexical index as Spark tables, and exact top-k by BM25 that skips blocks of postings.

The index is three written tables:

* ``documents``: id, length and the document's terms with their counts;
* ``terms``: term, document frequency, corpus frequency, largest impact, inverse document frequency, and the number of
  salts of its key;
* ``blocks``: a term's postings in a range of documents, with the largest impact among them. A posting's impact is its
  BM25 weight without the inverse document frequency. Ranges hold documents of like length, the shortest and so the
  strongest first, and bounded numbers of them, so that a block's largest impact says much about all of its postings.

A search is one plan for all queries. From the largest impacts alone, without reading a posting, each range gets a bound
for the scores in it. The most promising ranges of a query are scored; their k-th score is what an answer has to reach.
Terms that together cannot lift a document by half of that are weak, as frequent words are. Blocks are then read of the
other terms only, and only in ranges whose bound reaches the k-th score; documents that could still reach it with all
weak terms get those added from their own row. A term that every document holds is many blocks under several salts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.text import starts, tokens
from quern.session import scratch_dir

# The ranking constants.
K1, B = 1.5, 0.75

#: Ranges hold documents whose lengths differ by an eighth at most, and about this many of them.
RANGE = 256
STEPS = 8
#: A term with more than this share of the postings (and this many) gets a salt for each so many of its postings, so
#: that at most 65 536 terms do.
HOT_SHARE, HOT_LEAST = 1 / 65_536, 4096
#: Ranges per query that are scored to find what an answer has to reach, and the share of it that weak terms may make.
SEEDS, WEAK = 4, 0.5
#: Sums in another order differ by less than this.
SLACK = 1e-7
#: Query terms, and pairs of a query and a range, that may be sent to every task; more of them meet blocks by a shuffle.
MAX_SENT = 500_000


def term_counts(words: Column) -> Column:
    """``(term, tf)`` of a token array in the order of the terms, none of a null one; rows are counted a batch at a time."""

    @F.arrow_udf(T.ArrayType(T.StructType([T.StructField("term", T.StringType()), T.StructField("tf", T.IntegerType())])))
    def counted(rows: pa.Array) -> pa.Array:
        found = rows.flatten().dictionary_encode()
        by_name = pc.sort_indices(found.dictionary)
        place = np.empty(len(by_name), np.int64)
        place[by_name.to_numpy()] = np.arange(len(by_name))
        sizes = pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False)
        width = max(len(by_name), 1)
        cells = np.repeat(np.arange(len(rows)) * width, sizes) + place[found.indices.to_numpy(zero_copy_only=False)]
        held, tf = np.unique(cells, return_counts=True)
        terms = found.dictionary.take(by_name).take(pa.array(held % width))
        entries = pa.StructArray.from_arrays([terms, pa.array(tf, pa.int32())], ["term", "tf"])
        return pa.ListArray.from_arrays(pa.array(starts(np.bincount(held // width, minlength=len(rows))), pa.int32()), entries)

    return counted(words)


def impact(tf: Column, length: Column, average: Column) -> Column:
    """BM25 weight of a posting without the inverse document frequency."""
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / F.greatest(average, F.lit(1e-9))))


@dataclass
class LexicalIndex:
    """The tables of an index and its two figures."""

    documents: DataFrame
    terms: DataFrame
    blocks: DataFrame
    n: int
    average: float

    def postings(self, *figures: str) -> DataFrame:
        """``term, doc_id, tf, length``, a row per document and term, with ``figures`` of the term.

        Whole blocks meet the figures, by term and salt, and are unfolded after that.
        """
        blocks = self.blocks
        if figures:
            salt = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
            blocks = blocks.join(self.terms.select("term", *figures, salt), ["term", "salt"])
        p = blocks.select("term", *figures, F.explode_outer("postings").alias("p"))
        return p.select("term", "p.doc_id", "p.tf", "p.length", *figures)


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _ranges(documents: DataFrame) -> Column:
    """The range of a document: by its length, and of many documents of like length by the hash of its id."""
    level = F.floor(F.log(F.col("length") + 1.0) * STEPS).cast("int")
    counts = {r["level"]: r["count"] for r in documents.groupBy(level.alias("level")).count().collect()}  # some hundred rows
    parts = [max(1, -(-counts.get(i, 0) // RANGE)) for i in range(max(counts, default=0) + 1)]
    first = [sum(parts[:i]) for i in range(len(parts))]

    def of(values: list[int]) -> Column:
        return F.get(F.array(*(F.lit(x).cast("long") for x in values)), level)

    return of(first) + F.pmod(F.xxhash64("doc_id"), of(parts))


def build_index(docs: DataFrame, key: str, text: str, path: str | None = None, only: DataFrame | None = None) -> LexicalIndex:
    """Index the texts below ``path``, by default a new folder in the shared scratch folder.

    Keys are unique and not null, of any type. Null texts are documents without words. Texts are read once. ``only``
    may name the ``term``s that will ever be asked for; no postings of others are made then.
    """
    spark = docs.sparkSession
    path = path or scratch_dir(spark, "lexical")
    words = F.coalesce(tokens(F.col(text)), F.array().cast("array<string>"))
    rows = docs.select(F.col(key).alias("doc_id"), words.alias("_w"))
    rows = rows.select("doc_id", F.size("_w").cast("long").alias("length"), F.map_from_entries(term_counts(F.col("_w"))).alias("terms"))
    documents = _stored(rows, f"{path}/documents")
    n, total, entries = documents.agg(F.count(F.lit(1)), F.sum("length"), F.sum(F.size("terms"))).first()
    average = (total or 0) / n if n else 0.0

    def unfolded(rows: DataFrame) -> DataFrame:
        flat = rows.select("doc_id", "length", "range", F.explode("terms").alias("term", "tf"))
        flat = flat if only is None else flat.join(only.select("term").distinct(), "term", "left_semi")
        return flat.withColumn("tf", F.col("tf").cast("long")).withColumn("w", impact(F.col("tf"), F.col("length"), F.lit(average)))

    ranged = documents.withColumn("range", _ranges(documents))
    flat = unfolded(ranged)
    idf = F.log(1 + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    terms = flat.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"), F.max("w").alias("top"))
    most = max(HOT_LEAST, int((entries or 0) * HOT_SHARE))
    terms = terms.withColumns({"idf": idf, "salts": F.ceil(F.col("df") / most).cast("int")})
    terms = _stored(terms, f"{path}/terms")

    hot = F.broadcast(terms.where("salts > 1").select("term", "salts"))  # at most 65 536
    salt = F.pmod("range", F.coalesce("salts", F.lit(1))).cast("int")
    posting = F.struct("doc_id", "tf", "length", "w")
    # Dealt by range, so that a task that reads blocks later has all terms of its documents and adds them up there: whole
    # documents, or the few postings that are asked for.
    dealt = unfolded(ranged.repartition("range")) if only is None else flat.repartition("range")
    cut = dealt.join(hot, "term", "left").withColumn("salt", salt)
    blocks = cut.groupBy("term", "salt", "range").agg(F.max("w").alias("top"), F.collect_list(posting).alias("postings"))
    return LexicalIndex(documents, terms, _stored(blocks, f"{path}/blocks"), n, average)


def open_index(spark: SparkSession, path: str) -> LexicalIndex:
    """An index written before."""
    documents, terms, blocks = (spark.read.parquet(f"{path}/{t}") for t in ("documents", "terms", "blocks"))
    n, total = documents.agg(F.count(F.lit(1)), F.sum("length")).first()
    return LexicalIndex(documents, terms, blocks, n, (total or 0) / n if n else 0.0)


def query_terms(queries: DataFrame, key: str, text: str) -> DataFrame:
    """``query_id, term, tf``."""
    asked = queries.select(F.col(key).alias("query_id"), F.explode(term_counts(tokens(F.col(text)))).alias("t"))
    return asked.select("query_id", "t.term", "t.tf")


def search(index: LexicalIndex, queries: DataFrame, key: str, text: str, k: int = 5) -> DataFrame:
    """``query_id, doc_id, score, rank``: the ``k`` best documents per query, ties to the smaller id.

    Query keys are unique and not null, of any type. Documents that hold no term of the query are not answers; a query
    without words, or with a null text, has none.
    """
    spark = queries.sparkSession
    met = query_terms(queries, key, text).join(index.terms, "term")
    weight = F.col("tf") * F.col("idf")
    q = met.select("query_id", "term", weight.alias("weight"), (weight * F.col("top")).alias("most"), "salts")
    q = _stored(q, scratch_dir(spark, "asked"))
    blocks = index.blocks.join(q.select("term").distinct(), "term", "left_semi")
    few_terms = q.count() <= MAX_SENT

    salted = q.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    tops = salted.join(index.blocks.select("term", "salt", "range", "top"), ["term", "salt"])
    bounds = tops.groupBy("query_id", "range").agg(F.sum(F.col("weight") * F.col("top")).alias("reach"))
    bounds = _stored(bounds, scratch_dir(spark, "bounds"))

    def sums(terms: DataFrame, ranges: DataFrame) -> DataFrame:
        """Weights of postings of ``terms`` in ``ranges``, added up per query and document."""
        if few_terms and ranges.count() <= MAX_SENT:
            met = index.blocks.join(F.broadcast(terms.drop("salts")), "term")
            read = met.join(F.broadcast(ranges), ["query_id", "range"])
        else:
            wanted = terms.join(ranges, "query_id").withColumn("salt", F.pmod("range", "salts").cast("int"))
            read = wanted.join(blocks, ["term", "salt", "range"])
        parts = read.select("query_id", "weight", F.explode("postings").alias("p"))
        added = F.sum(F.col("weight") * F.col("p.w")).alias("s")
        return parts.groupBy("query_id", F.col("p.doc_id").alias("doc_id")).agg(added)

    promising = Window.partitionBy("query_id").orderBy(F.desc("reach"), "range")
    seeds = bounds.withColumn("_i", F.row_number().over(promising)).where(F.col("_i") <= SEEDS).select("query_id", "range")
    found = sums(q.select("query_id", "term", "weight", "salts"), seeds)
    order = Window.partitionBy("query_id").orderBy(F.desc("s"))
    kth = found.withColumn("_i", F.row_number().over(order)).where(F.col("_i") == k)
    kth = _stored(kth.select("query_id", (F.col("s") - SLACK).alias("kth")), scratch_dir(spark, "kth"))

    up = Window.partitionBy("query_id").orderBy("most", "term").rowsBetween(Window.unboundedPreceding, 0)
    judged = q.join(kth, "query_id", "left").withColumn("kth", F.coalesce("kth", F.lit(0.0)))
    judged = judged.withColumn("up", F.sum("most").over(up)).withColumn("weak", F.col("up") < F.col("kth") * WEAK)
    judged = _stored(judged, scratch_dir(spark, "judged"))
    entry = F.struct("term", "weight")
    few = judged.groupBy("query_id").agg(
        F.first("kth").alias("kth"), F.coalesce(F.max(F.when(F.col("weak"), F.col("up"))), F.lit(0.0)).alias("rest"),
        F.collect_list(F.when(F.col("weak"), entry)).alias("others"),
    )
    few = _stored(few, scratch_dir(spark, "weak"))
    left = bounds.join(few.select("query_id", "kth"), "query_id").where("reach >= kth").select("query_id", "range")
    strong = judged.where("NOT weak").select("query_id", "term", "weight", "salts")
    near = sums(strong, left).join(few, "query_id").where("s + rest >= kth").select("query_id", "doc_id", "s", "others")

    # Each of the query's few weak terms is looked up in the document's own row.
    rows = near.join(index.documents, "doc_id")

    def add(total: Column, t: Column) -> Column:
        tf = F.try_element_at(F.col("terms"), t["term"])
        return total + F.coalesce(t["weight"] * impact(tf, F.col("length"), F.lit(index.average)), F.lit(0.0))

    out = rows.select("query_id", "doc_id", F.round(F.aggregate("others", F.col("s"), add), 9).alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
