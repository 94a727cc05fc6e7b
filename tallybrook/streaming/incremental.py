"""Incremental loads as streams: an optional extension, for the monthly batches that the ledger takes in.

Each micro-batch goes through the same insert-if-absent as a batch load; windows over events carry a watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tallybrook.operators import merge


def append_new(stream: DataFrame, path: str, checkpoint: str, keys: list[str], seq: str) -> StreamingQuery:
    """Appends each batch's new keys to a Parquet table. A batch id is written once: a rerun replaces its own folder."""

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        try:
            existing = spark.read.parquet(path).where(F.col("_batch") < batch_id).drop("_batch")
        except Exception as e:  # the first batch: there is no table yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            existing = spark.createDataFrame([], batch.schema)
        merge.insert_if_absent(existing, batch, keys, seq).write.mode("overwrite").parquet(f"{path}/_batch={batch_id}")

    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def events(spark: SparkSession, path: str) -> DataFrame:
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    return spark.readStream.schema(schema).parquet(path)


def windowed(stream: DataFrame, every: str = "1 hour", slide: str | None = None, late: str = "2 hours") -> DataFrame:
    """Counts and values of each window and type; rows later than `late` are left out."""
    timed = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return timed.groupBy(F.window("ts", every, slide) if slide else F.window("ts", every), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def sessions(stream: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    timed = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return timed.groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))
