"""Structured Streaming runs of the read and pipeline operators. Checkpoints lie in a folder that the caller names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def source(spark: SparkSession, folder: str, schema: T.StructType, files_a_batch: int = 1, pattern: str = "*.parquet") -> DataFrame:
    """New Parquet files of a folder, a few a batch (back pressure)."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).option("pathGlobFilter", pattern).parquet(folder)


def fastq_source(spark: SparkSession, folder: str, files_a_batch: int = 1) -> DataFrame:
    """(read_id, seq) of new FASTQ files of a folder, a few a batch; records are cut as in ``sources.fastq_sequences``."""
    parts = spark.readStream.format("text").option("lineSep", "\n+\n").option("maxFilesPerTrigger", files_a_batch).load(folder)
    head, seq = (F.regexp_extract("value", r"(?:^|\n)@([^\n]*)\n([^\n]+)$", k) for k in (1, 2))
    return parts.select(head.alias("read_id"), seq.alias("seq")).where("seq <> ''")


def landed(counts: DataFrame, keys: list[str], out: str, checkpoint: str) -> DataFrame:
    """The latest n of each key of a stream of counts, each batch's changed keys landed with its number.

    A batch that is repeated after a failure overwrites its own folder.
    """

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(put).trigger(availableNow=True).start().awaitTermination()
    done = counts.sparkSession.read.parquet(out)
    return done.groupBy(*keys).agg(F.max_by("n", "batch").alias("n"))


def running_counts(stream: DataFrame, keys: list[str], out: str, checkpoint: str) -> DataFrame:
    """Counts by key over all files so far, with state between the batches; the latest count of each key."""
    return landed(stream.groupBy(*keys).agg(F.count("*").alias("n")), keys, out, checkpoint)


def append_then_compact(stream: DataFrame, keys: list[str], out: str, checkpoint: str) -> DataFrame:
    """Partial collapses of each batch landed one after another, then summed."""

    def put(batch: DataFrame, number: int) -> None:
        batch.groupBy(*keys).agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(put).trigger(availableNow=True).start().awaitTermination()
    parts = stream.sparkSession.read.parquet(out)
    return parts.groupBy(*keys).agg(F.sum("n").cast("long").alias("n"))


def windowed_counts(stream: DataFrame, ts: str, width: str, late: str, keys: list[str]) -> DataFrame:
    """Counts by event-time window; rows later than ``late`` behind the newest are dropped."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, width), *keys).agg(F.count("*").alias("n"))


def polled(stream: DataFrame, put, checkpoint: str, seconds: float = 100):
    """The running query that calls put(batch, number) on what is new every so many seconds; the caller stops it."""
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(put).trigger(processingTime=f"{seconds} seconds").start()


def batch_progress(query, spark: SparkSession) -> DataFrame:
    """(batch, rows, at) of a query's recent batches, for views that are refreshed while it runs."""
    done = [(p["batchId"], p["numInputRows"], p["timestamp"]) for p in query.recentProgress]  # Spark keeps the last 100
    return spark.createDataFrame(done, "batch long, rows long, at string").withColumn("at", F.to_timestamp("at"))
