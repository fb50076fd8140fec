"""Incremental runs: new files are read as a stream, each once, and a stage's results are appended with a manifest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery


def run_new_files(spark: SparkSession, source: str, schema: str, stage: Callable[[DataFrame], DataFrame], target: str, checkpoint: str) -> StreamingQuery:
    """Apply `stage` to the Parquet files that were not read before and append its rows with the batch they came in.

    The checkpoint remembers the files, so a second run without new files writes nothing. A repeated batch replaces its own output,
    so a failure between write and commit doesn't double rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        out = stage(batch).withColumn("batch_id", F.lit(batch_id))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(target)

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, time: str, kind: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events per window and kind; events later than `late` behind the newest are dropped by the watermark."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), kind).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), kind, "n")


def pending(documents: DataFrame, manifest: DataFrame, stage: str) -> DataFrame:
    """Documents whose (doc_id, input_hash) the stage hasn't done yet."""
    return documents.join(manifest.filter(F.col("stage") == stage).select("doc_id", "input_hash"), ["doc_id", "input_hash"], "left_anti")
