"""Keyed state kept by a stream: landed files are read once, each micro-batch is merged into a written state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.session import scratch_path
from lexmill.sources.files import is_folder


def run_seen(spark: SparkSession, path: str, schema, keys: list[str], at: str, per_batch: int = 1) -> DataFrame:
    """First and last sight of each key, by a stream over the files of ``path`` that runs until all are read.

    Each micro-batch is aggregated first and its partial state appended under its batch number; a batch that is
    run again after a failure overwrites its own folder, so nothing counts twice. Reading the state merges the parts.
    """
    parts = scratch_path(spark, "stream-state")

    def merge(batch: DataFrame, number: int) -> None:
        batch.groupBy(*keys).agg(F.min(at).alias("first_seen_at"), F.max(at).alias("last_seen_at"), F.count("*").alias("times")).write.mode("overwrite").parquet(f"{parts}/batch={number}")

    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch)
    folder, _, name = path.rstrip("/").rpartition("/")
    source = reader.parquet(path) if is_folder(spark, path) else reader.option("pathGlobFilter", name).parquet(folder)
    q = source.writeStream.foreachBatch(merge).option("checkpointLocation", scratch_path(spark, "stream-log")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(parts).groupBy(*keys).agg(F.min("first_seen_at").alias("first_seen_at"), F.max("last_seen_at").alias("last_seen_at"), F.sum("times").alias("times"))
