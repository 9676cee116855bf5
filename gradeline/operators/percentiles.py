"""Exact interpolated percentiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeline.sources.tables import keep


def value_counts(df: DataFrame, value: str, *aggregates: Column) -> DataFrame:
    """One row per distinct value, combined before the shuffle."""
    return df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n"), *aggregates)


def weighted_percentiles(value: str, weight: str, probabilities: Sequence[float]) -> list[Column]:
    """``percentile_cont`` of a counted value, one column per probability.

    The last step holds one entry per distinct value, so this is for values of a small domain. Chart
    scores are whole numbers: changes of them have at most ``2 * chart_size - 1`` distinct values,
    whatever the number of rows. Use ``percentile_table`` for values without such a bound.
    """
    return [F.percentile(F.col(value), F.lit(p), F.col(weight)) for p in probabilities]


def percentile_table(
    df: DataFrame, value: str, probabilities: Sequence[float], parts: int | None = None
) -> DataFrame:
    """(p, percentile) of a column with any number of distinct values; no task sees them all.

    Counted values are range-partitioned and kept, so each part is a known run of the sorted values.
    The totals of the parts (a row each) say which part holds a position, and only those parts are
    numbered. The percentile lies between two neighbouring positions, as in ``percentile_cont``.
    Without ``parts`` the session's shuffle partitions are used, small ones merged at run time.
    """
    counts = value_counts(df.select(F.col(value).cast("double").alias("v")), "v")
    ranges = counts.repartitionByRange(parts, "v") if parts else counts.repartitionByRange("v")
    sorted_runs = keep(ranges.withColumn("part", F.spark_partition_id()), "sorted_runs")
    totals = sorted_runs.groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = totals.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    wanted = F.inline(F.array(*[F.struct(F.lit(p).cast("double").alias("p")) for p in probabilities]))
    size = totals.agg(F.sum("n")).scalar()
    exact = F.col("p") * (size - 1)
    positions = df.sparkSession.range(1).select(wanted).select("p", exact.alias("exact")).select(
        "p", "exact", F.explode(F.array_distinct(F.array(F.floor("exact"), F.ceil("exact")))).alias("position")
    )
    # A part is found in the array of parts, which is as long as there are parts.
    all_runs = runs.agg(F.collect_list(F.struct("part", "start", "n"))).scalar()
    located = positions.select("*", F.explode(all_runs).alias("run")).where(
        (F.col("position") >= F.col("run.start")) & (F.col("position") < F.col("run.start") + F.col("run.n"))
    )
    chosen = keep(located.select("p", "exact", "position", "run.part", "run.start"), "positions")
    up_to = Window.partitionBy("part").orderBy("v")
    numbered = (
        sorted_runs.join(chosen.select("part").distinct(), "part", "left_semi")
        .withColumn("last", F.sum("n").over(up_to))
    )
    found = (
        numbered.join(chosen, "part")
        .where((F.col("position") < F.col("start") + F.col("last")) & (F.col("position") >= F.col("start") + F.col("last") - F.col("n")))
        .groupBy("p", "exact")
        .agg(F.min("v").alias("low"), F.max("v").alias("high"))
    )
    share = F.col("exact") - F.floor("exact")
    return found.select("p", (F.col("low") + (F.col("high") - F.col("low")) * share).alias("percentile"))
