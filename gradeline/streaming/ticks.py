"""Trade ticks from landing files: append to bronze, keep one current row per key in silver."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gradeline.sources.schemas import TRADE_TICK
from gradeline.sources.tables import keep, merge_partitions, replace_partitions


def read_ticks(spark: SparkSession, path: str, schema: str = TRADE_TICK, files_per_batch: int = 1000) -> DataFrame:
    """Tick files, one JSON object per line, as a stream with event time ``ts``."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
        .withColumn("ts", F.timestamp_millis("t"))
    )


def land_ticks(ticks: DataFrame, path: str, checkpoint: str, ingested_at: Column) -> StreamingQuery:
    """Append every tick with a load stamp to Parquet, by day; stops when the input is read."""
    return (
        ticks.withColumn("_ingested_at", ingested_at)
        .withColumn("day", F.to_date("ts"))
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("day")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def upsert_by_day(
    path: str, keys: Sequence[str], newest_first: Sequence[str], schema: str, day: str = "day"
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that merges a batch into a table stored by day.

    Only days that occur in the batch are read and rewritten, so a batch costs its own days and not
    the table. The merge goes by key, so it needs no state of its own: repeats change nothing, and
    a tick counts however late it comes.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Read more than once below; a table that all executors see saves reading the files again.
        batch = keep(batch, "ticks_batch")
        stored = spark.read.schema(schema).parquet(path) if _exists(spark, path) else None
        merged = merge_partitions(stored, batch, keys, newest_first, day)
        if merged is not None:
            replace_partitions(merged, path, [day])

    return merge


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        return bool(spark.read.parquet(path).columns)
    except Exception as error:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return False
        raise


def merge_ticks(
    ticks: DataFrame, path: str, checkpoint: str, keys: Sequence[str], newest_first: Sequence[str], schema: str
) -> StreamingQuery:
    """Keep the newest tick per key in a table stored by day; stops when the input is read."""
    return (
        ticks.withColumn("day", F.to_date("ts"))
        .writeStream.foreachBatch(upsert_by_day(path, keys, newest_first, schema))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
