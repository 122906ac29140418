"""Progress of streams: counters taken by a listener, and a running accuracy kept in the state store."""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from quern.operators import scoring
from quern.session import scratch_dir

#: Seconds that the last events of a finished stream are waited for.
PATIENCE = 60


class Counters(StreamingQueryListener):
    """Adds up the observed rows ``scanned`` and ``collected`` of one stream, batch by batch, with the time it took."""

    def __init__(self, name: str):
        self.name = name
        self.run = None
        self.batches = self.scanned = self.collected = 0
        self.seconds = 0.0
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.run = event.runId

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self.name) if event.progress.name == self.name else None
        if seen is not None:
            self.batches += 1
            self.scanned += seen["scanned"]
            self.collected += seen["collected"]
            self.seconds += event.progress.batchDuration / 1000

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId == self.run:
            self.ended.set()

    def summary(self) -> dict[str, float]:
        """Rows scanned and collected, the yield in percent, and rows a second."""
        share = 100.0 * self.collected / self.scanned if self.scanned else 0.0
        return {"scanned": self.scanned, "collected": self.collected, "yield_pct": share, "rows_per_second": self.scanned / max(self.seconds, 1e-3)}


def collect_accepted(stream: DataFrame, accept: Column, name: str, base: str | None = None) -> tuple[DataFrame, Counters]:
    """The accepted rows of a stream, run to the end of its input into a folder, and the counters of that run.

    The counters come from the listener, so they cost no pass of their own. With a ``base`` folder of its own a later
    call goes on where the last one ended and counts what has come since.
    """
    spark = stream.sparkSession
    base = base or scratch_dir(spark, name)
    counters = Counters(f"{name}-{uuid.uuid4().hex}")
    fits = F.coalesce(accept, F.lit(False))
    watched = stream.withColumn("_fits", fits).observe(
        counters.name, F.count(F.lit(1)).alias("scanned"), F.count_if("_fits").alias("collected")
    )
    spark.streams.addListener(counters)
    try:
        q = (
            watched.where("_fits").drop("_fits").writeStream.format("parquet").queryName(counters.name)
            .option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
        )
        q.awaitTermination()
        counters.ended.wait(PATIENCE)
    finally:
        spark.streams.removeListener(counters)
    return spark.read.schema(stream.schema).parquet(f"{base}/out"), counters


def stream_accuracy(samples: DataFrame, prediction_dir: str, schema: str, base: str, files: int = 8) -> DataFrame:
    """Accuracy per run of all predictions that have come so far: ``model_label, eval_dataset, total, correct, accuracy``.

    Totals live in the state store and every batch puts out the whole table (complete mode), so nothing that was scored
    is read again. Called again with the same ``base`` folder, only files that have come since are scored. The table of a
    batch is named by its number and replaced on a repeat.
    """
    spark: SparkSession = samples.sparkSession
    arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(prediction_dir)
    totals = scoring.accuracy_summary(scoring.score_predictions(samples, arriving))

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={number}")

    q = (
        totals.writeStream.outputMode("complete").foreachBatch(write)
        .option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    tables = spark.read.parquet(f"{base}/out")
    last = tables.select(F.max("batch")).scalar()
    return tables.where(F.col("batch") == last).drop("batch")
