"""The streaming path, run over the events until the input is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeline.catalog.fixtures import INGESTED_AT, table
from gradeline.catalog.registry import query
from gradeline.session import shared_folder
from gradeline.streaming.distinct import distinct_ticks
from gradeline.streaming.ticks import land_ticks, merge_ticks, read_ticks

SILVER_TICK = "s string, p double, t bigint, v double, c array<string>, ts timestamp, day date"


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as trade ticks: user, value, milliseconds, event number, type."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("s"),
        F.col("value").alias("p"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("t"),
        F.col("event_id").cast("double").alias("v"),
        F.array("event_type").alias("c"),
    )


@query("x1_tick_landing", """
SELECT 'U' || user_id AS s, value AS p, epoch_us(ts) // 1000 AS t, CAST(event_id AS DOUBLE) AS v, event_type AS c,
  strftime(ts, '%Y-%m-%d %H:%M:%S.%g000') AS ts, '2024-02-01 07:00:00.000000' AS _ingested_at,
  CAST(CAST(ts AS DATE) AS VARCHAR) AS day
FROM events""")
def tick_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tick files streamed to Parquet, one row per tick."""
    landed, path, checkpoint = (shared_folder(spark, n) for n in ("ticks", "bronze_ticks", "bronze_checkpoint"))
    ticks(spark, sf_dir).write.json(landed)
    stream = read_ticks(spark, landed)
    land_ticks(stream, path, checkpoint, F.lit(INGESTED_AT).cast("timestamp")).awaitTermination()
    return spark.read.parquet(path).withColumn("c", F.array_join("c", ","))


@query("x2_tick_merge", """
SELECT 'U' || user_id AS s, value AS p, CAST(event_id AS DOUBLE) AS v, event_type AS c, CAST(day AS VARCHAR) AS day
FROM (SELECT *, CAST(ts AS DATE) AS day,
        row_number() OVER (PARTITION BY CAST(ts AS DATE), user_id, event_type ORDER BY epoch_us(ts) // 1000 DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""")
def tick_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks in two runs of one stream, the second with repeats and late ones; the newest per symbol,
    type and day stays."""
    landed, path, checkpoint = (shared_folder(spark, n) for n in ("ticks", "silver_ticks", "silver_checkpoint"))
    every = ticks(spark, sf_dir)
    # The first run gets the newest half of the month, the second everything.
    for part in (every.where(F.timestamp_millis("t") >= F.lit("2024-01-16").cast("timestamp")), every):
        part.write.mode("append").json(landed)
        stream = read_ticks(spark, landed)
        merge_ticks(stream, path, checkpoint, ["s", "c"], ["t", "v"], SILVER_TICK).awaitTermination()
    return spark.read.parquet(path).select("s", "p", "v", F.array_join("c", ",").alias("c"), "day")


STORED_TICK = "s string, p double, t bigint, v double, ts timestamp, day date, batch bigint"


@query("x3_tick_distinct", """
SELECT 'U' || user_id AS s, value AS p, epoch_us(ts) // 1000 AS t, CAST(event_id AS DOUBLE) AS v,
  CAST(CAST(ts AS DATE) AS VARCHAR) AS day
FROM events""")
def tick_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeats within a run, within the watermark of two days and beyond it, and news that come late; each tick stays once.

    Runs: the second half of the month, doubled, without every fifth tick; its last day, doubled; everything.
    """
    landed, path, marks, checkpoint = (shared_folder(spark, n) for n in ("ticks", "ticks_distinct", "ticks_marks", "ticks_state"))
    every = ticks(spark, sf_dir).drop("c")
    at = F.timestamp_millis("t")
    second = every.where((at >= F.lit("2024-01-16").cast("timestamp")) & (F.col("v") % 5 != 0))
    last = every.where(at >= F.lit("2024-01-30").cast("timestamp"))
    for part in (second.unionAll(second), last.unionAll(last), every):
        part.write.mode("append").json(landed)
        stream = read_ticks(spark, landed, "s string, p double, t bigint, v double")
        distinct_ticks(stream, path, marks, checkpoint, ["s", "t", "v"], "2 days", STORED_TICK).awaitTermination()
    return spark.read.schema(STORED_TICK).parquet(path).select("s", "p", "t", "v", "day")
