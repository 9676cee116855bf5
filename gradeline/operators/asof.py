"""Point-in-time lookups for many (entity, date) requests at once.

Facts and requests are put into one relation and read by a window per entity: one shuffle, no range
join. Facts are first reduced to one row per entity and date and requests to distinct pairs, so the
rows of an entity, however hot, are bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeline.operators.latest import latest_per_key


def timeline(
    requests: DataFrame,
    facts: DataFrame,
    entity: str,
    as_of: str,
    fact_date: str,
    values: Sequence[str],
    newest_first: Sequence[Column | str],
) -> DataFrame:
    """Facts, one per entity and date, and distinct requests as (_entity, _at, _request, _fact); requests have no fact."""
    daily = latest_per_key(
        facts.where(F.col(fact_date).isNotNull()), [entity, fact_date], newest_first, tie_break=list(values)
    )
    fact_rows = daily.select(
        F.col(entity).alias("_entity"),
        F.col(fact_date).alias("_at"),
        F.lit(0).alias("_request"),
        F.struct(F.col(fact_date), *[F.col(v) for v in values]).alias("_fact"),
    )
    fact_type = fact_rows.schema["_fact"].dataType
    request_rows = requests.select(entity, as_of).distinct().select(
        F.col(entity).alias("_entity"),
        F.col(as_of).alias("_at"),
        F.lit(1).alias("_request"),
        F.lit(None).cast(fact_type).alias("_fact"),
    )
    return fact_rows.unionByName(request_rows)


def latest_as_of(
    requests: DataFrame,
    facts: DataFrame,
    entity: str,
    as_of: str,
    fact_date: str,
    values: Sequence[str],
    newest_first: Sequence[Column | str] = (),
) -> DataFrame:
    """The newest fact dated on or before each request; NULLs where there is none yet."""
    line = timeline(requests, facts, entity, as_of, fact_date, values, newest_first)
    window = Window.partitionBy("_entity").orderBy("_at", "_request").rowsBetween(Window.unboundedPreceding, 0)
    return (
        line.withColumn("_fact", F.last("_fact", ignorenulls=True).over(window))
        .where(F.col("_request") == 1)
        .select(F.col("_entity").alias(entity), F.col("_at").alias(as_of), "_fact.*")
    )


def trailing_as_of(
    requests: DataFrame,
    facts: DataFrame,
    entity: str,
    as_of: str,
    fact_date: str,
    values: Sequence[str],
    n: int,
    into: str,
) -> DataFrame:
    """The ``n`` newest facts on or before each request as an array, oldest first."""
    line = timeline(requests, facts, entity, as_of, fact_date, values, ())
    running = Window.partitionBy("_entity").orderBy("_at", "_request").rowsBetween(Window.unboundedPreceding, 0)
    # A request carries the number of the newest fact before it, so a range of numbers is n facts.
    numbered = line.withColumn("_seq", F.count("_fact").over(running))
    newest = Window.partitionBy("_entity").orderBy("_seq").rangeBetween(-(n - 1), 0)
    return (
        numbered.withColumn(into, F.sort_array(F.collect_list("_fact").over(newest)))
        .where(F.col("_request") == 1)
        .select(F.col("_entity").alias(entity), F.col("_at").alias(as_of), into)
    )
