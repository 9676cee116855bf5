"""Repeated ticks are dropped by state where the watermark reaches, and by stored keys beyond it.

A tick that comes in time meets the state store and is appended without a look at the table. Only ticks
older than the watermark may have left the state; those alone are compared with the days they belong
to. Stored files are never rewritten: a batch writes its own folders, and a batch that is run again
replaces just these.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gradeline.sources.tables import discard, keep, replace_partitions
from gradeline.streaming.ticks import _exists

#: Columns that a stored table has beside those of the ticks.
DAY, BATCH = "day", "batch"


def flagged(ticks: DataFrame, keys: Sequence[str], delay: str, time: str = "ts") -> DataFrame:
    """A stream of all ticks (``_first`` false) and of those the state store sees first (``_first`` true).

    The state forgets a tick once the watermark is ``delay`` beyond it, so it holds that span of time
    and not the history. Spark drops what is older than the watermark from the second kind without a
    word; the first kind is there to find it again.
    """
    every = ticks.withColumn("_first", F.lit(False))
    timed = ticks.where(F.col(time).isNotNull()).withWatermark(time, delay)
    return every.unionByName(timed.dropDuplicatesWithinWatermark(list(keys)).withColumn("_first", F.lit(True)))


def append_distinct(
    path: str, marks: str, keys: Sequence[str], delay: str, schema: str, time: str = "ts"
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for a ``flagged`` stream that appends each key once to a table by day and batch.

    ``marks`` is a folder with the newest time seen up to every batch. What Spark drops as late lies ``delay`` or more before the
    newest time of earlier batches (or before 1970), so only such ticks, and those without a time, are kept and looked up in the
    stored days; younger ones that the state did not let through are repeats. Before the first mark the batch's own newest time counts.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = None
        if _exists(spark, marks):
            earlier = spark.read.schema(f"newest timestamp, {BATCH} bigint").parquet(marks).where(F.col(BATCH) < batch_id)
            newest = earlier.agg(F.unix_micros(F.max("newest"))).first()[0]

        def late(newest: Column) -> Column:
            reach = F.greatest(newest - F.expr(f"INTERVAL {delay}"), F.timestamp_seconds(F.lit(0)))
            return ~F.col("_first") & (F.col(time).isNull() | (F.col(time) <= reach))

        # The newest tick of a batch is let through, or came with an earlier batch; no repeat is newer.
        marked = F.timestamp_micros(F.lit(newest).cast("long"))
        rows = keep(batch if newest is None else batch.where(F.col("_first") | late(marked)), "distinct_batch")
        reached = keep(rows.agg(F.greatest(F.max(time), marked).alias("newest")).coalesce(1), "distinct_newest")
        first = rows.where("_first").drop("_first").withColumn(DAY, F.to_date(time))
        old = rows.where(late(reached.scalar() if newest is None else marked)).drop("_first")
        both, seen = first, first.select(*keys)
        days = [row[0] for row in old.select(F.to_date(time)).distinct().collect()]
        if days:
            if _exists(spark, path):
                known = F.col(DAY).isin([d for d in days if d is not None])
                touched = known | F.col(DAY).isNull() if None in days else known
                seen = seen.unionByName(spark.read.schema(schema).parquet(path).where((F.col(BATCH) < batch_id) & touched).select(*keys))
            # Equal keys meet in one aggregate, and copies combine before the shuffle, whatever their number.
            others = [c for c in old.columns if c not in keys]
            pool = old.withColumn("_seen", F.lit(False)).unionByName(seen.withColumn("_seen", F.lit(True)), allowMissingColumns=True)
            met = pool.groupBy(*keys).agg(F.max("_seen").alias("_seen"), *[F.first(c).alias(c) for c in others])
            both = first.unionByName(met.where("NOT _seen").drop("_seen").withColumn(DAY, F.to_date(time)))
        replace_partitions(both.withColumn(BATCH, F.lit(batch_id).cast("bigint")), path, [DAY, BATCH])
        reached.withColumn(BATCH, F.lit(batch_id).cast("bigint")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(BATCH).parquet(marks)
        discard(rows, reached)

    return add


def distinct_ticks(
    ticks: DataFrame, path: str, marks: str, checkpoint: str, keys: Sequence[str], delay: str, schema: str, time: str = "ts"
) -> StreamingQuery:
    """Store each tick once, however often and however late it comes; stops when the input is read.

    ``keys`` say which ticks are the same and have to settle ``time``: of rows with equal keys any one
    stays. NULL is a key as any other; ticks without time are stored under the NULL day. ``schema`` is that of the table,
    with ``day date, batch bigint`` at its end.
    """
    return (
        flagged(ticks, keys, delay, time)
        .writeStream.foreachBatch(append_distinct(path, marks, keys, delay, schema, time))
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
