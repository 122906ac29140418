"""Structured Streaming jobs: the batch expressions over ``readStream``, run until the input is used up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.text import strip
from quern.operators import convert, filters, scoring
from quern.operators import tokens as tok
from quern.session import scratch_dir

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def stream_table(spark: SparkSession, sf_dir: str, name: str, schema: str) -> DataFrame:
    """A table as a stream, be it one file or a folder of files; a missing table is an error."""
    spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet")
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def drain(stream: DataFrame, name: str, base: str | None = None) -> DataFrame:
    """Run the stream to the end of its input into a parquet folder and read that folder back.

    With a ``base`` folder of its own a later call goes on where the last one ended.
    """
    spark = stream.sparkSession
    base = base or scratch_dir(spark, name)
    q = (
        stream.writeStream.format("parquet")
        .option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/state")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def stream_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lazy one-pass text source: non-empty texts, stripped."""
    docs = stream_table(spark, sf_dir, "documents", DOCUMENTS)
    kept = docs.where(filters.non_empty(F.col("text"))).select("doc_id", strip(F.col("text")).alias("text"))
    return drain(kept, "stream-text")


def stream_web_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The web conversion as a stateless stream: ids and wordings follow the content's hash, not a position."""
    docs = convert.select_web_math(stream_table(spark, sf_dir, "documents", DOCUMENTS))
    digest = F.md5("text")
    idx = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    ident = F.concat(F.lit(convert.WEB_ID_PREFIX), digest)
    return drain(docs.select(*convert.web_math_row(F.col("text"), idx, ident)), "stream-web")


def each_batch(stream: DataFrame, name: str, work, base: str | None = None) -> str:
    """Run ``work(batch)`` on every micro-batch and write its result below the returned folder.

    The folder of a batch is named by its number and replaced on a repeat, so a restarted batch is not counted twice.
    With a ``base`` folder of its own a later call goes on where the last one ended.
    """
    base = base or scratch_dir(stream.sparkSession, name)

    def write(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{base}/out/batch={number}")

    q = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{base}/state")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return f"{base}/out"


def stream_tokenise(spark: SparkSession, sf_dir: str, vocab: DataFrame, block: int) -> DataFrame:
    """Encoding and fixed-width padding of a text stream with a given vocabulary."""
    docs = stream_table(spark, sf_dir, "documents", DOCUMENTS).select("doc_id", "text")

    def work(batch: DataFrame) -> DataFrame:
        ids = tok.encode_column(batch, "text", vocab)
        return ids.select("doc_id", tok.pad_fixed(F.col("ids"), block).alias("input_ids"))

    return spark.read.parquet(each_batch(docs, "stream-tokens", work)).drop("batch")


def stream_pack(spark: SparkSession, sf_dir: str, vocab: DataFrame, block: int, group_rows: int) -> DataFrame:
    """Packing of a text stream; groups never reach beyond their micro-batch."""
    docs = stream_table(spark, sf_dir, "documents", DOCUMENTS).select("doc_id", "text")

    def work(batch: DataFrame) -> DataFrame:
        ids = tok.encode_column(batch, "text", vocab).select("doc_id", "ids")
        return tok.pack_eos_blocks(tok.pack_groups(ids, "doc_id", group_rows), "ids", block)

    return spark.read.parquet(each_batch(docs, "stream-pack", work))


def stream_scores(samples: DataFrame, prediction_dir: str, schema: str, base: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Score prediction files as they arrive: ``(results, summary)``.

    ``base`` holds the checkpoint and the results. Called again with the same folder, only files that have come since
    are scored; the summary is that of all results so far.
    """
    spark = samples.sparkSession
    arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", 8).parquet(prediction_dir)
    out = each_batch(arriving, "stream-scores", lambda batch: scoring.score_predictions(samples, batch), base)
    results = spark.read.parquet(out).drop("batch")
    return results, scoring.accuracy_summary(results)
