"""As-of lookups whose entities may have any number of rows, at any resolution of time.

``asof`` reads an entity with one window, which is bounded while its column is a day. Here facts and
requests are sorted into ranges of (entity, time), the stretches, which Spark makes about equally
large whatever the entities are: a hot one covers many stretches, many small ones share one. Windows
run within (stretch, entity), so no task holds more than a stretch. What a stretch needs from those
before it is carried by one row per (stretch, entity), read by a window over an entity's stretches.

Facts without time are never found, requests without time find nothing, and NULL is an entity as any
other, as in ``asof``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeline.operators.asof import timeline
from gradeline.sources.tables import discard, keep


def stretched(df: DataFrame, stretches: int | None = None) -> DataFrame:
    """A timeline as a kept table, with the number of each row's stretch.

    Rows of one entity and time are in one stretch; stretches follow each other in the order of
    (entity, time). Their number is Spark's choice of partitions unless it is given.
    """
    number = [stretches] if stretches else []
    ranges = df.repartitionByRange(*number, "_entity", "_at", "_request")
    return keep(ranges.withColumn("_stretch", F.spark_partition_id()), "stretches")


def _within() -> tuple[Window, Window]:
    """Windows up to a row of a stretch, and over the stretches of an entity before one."""
    row = Window.partitionBy("_stretch", "_entity").orderBy("_at", "_request")
    stretch = Window.partitionBy("_entity").orderBy("_stretch")
    return (
        row.rowsBetween(Window.unboundedPreceding, Window.currentRow),
        stretch.rowsBetween(Window.unboundedPreceding, -1),
    )


def _carried(df: DataFrame, carried: DataFrame) -> DataFrame:
    """Rows with what their (stretch, entity) takes over; at most one row per stretch takes over anything."""
    over = carried.select(F.col("_stretch").alias("_s"), F.col("_entity").alias("_e"), "_before")
    return df.join(over, (F.col("_stretch") == F.col("_s")) & F.col("_entity").eqNullSafe(F.col("_e")), "left")


def latest_in_stretches(
    requests: DataFrame,
    facts: DataFrame,
    entity: str,
    as_of: str,
    fact_time: str,
    values: Sequence[str],
    newest_first: Sequence[Column | str] = (),
    stretches: int | None = None,
) -> DataFrame:
    """The rows of ``asof.latest_as_of``: the newest fact at or before each request, NULLs where there is none."""
    line = stretched(timeline(requests, facts, entity, as_of, fact_time, values, newest_first), stretches)
    to_row, to_stretch = _within()
    ends = line.where(F.col("_request") == 0).groupBy("_stretch", "_entity").agg(F.max_by("_fact", "_at").alias("_end"))
    # Stretches with requests alone hand on what came before them.
    every = line.select("_stretch", "_entity").distinct().alias("l")
    same = (F.col("l._stretch") == F.col("r._stretch")) & F.col("l._entity").eqNullSafe(F.col("r._entity"))
    chain = every.join(ends.alias("r"), same, "left").select("l._stretch", "l._entity", "_end")
    before = chain.withColumn("_before", F.last("_end", ignorenulls=True).over(to_stretch))
    carried = keep(before.where(F.col("_before").isNotNull()).drop("_end"), "carried")
    found = line.withColumn("_here", F.last("_fact", ignorenulls=True).over(to_row)).where(F.col("_request") == 1)
    # No time, no answer: such requests come first of their entity, so nothing precedes them.
    return _carried(found, carried).select(
        F.col("_entity").alias(entity), F.col("_at").alias(as_of), F.coalesce("_here", "_before").alias("_fact")
    ).select(entity, as_of, "_fact.*")


def trailing_in_stretches(
    requests: DataFrame,
    facts: DataFrame,
    entity: str,
    as_of: str,
    fact_time: str,
    values: Sequence[str],
    n: int,
    into: str,
    stretches: int | None = None,
) -> DataFrame:
    """The rows of ``asof.trailing_as_of``: the ``n`` newest facts at or before each request, oldest first.

    Facts are numbered per entity, by numbers within stretches and the totals of those before. Every
    ``n`` consecutive ones are a block; a request needs the block of the newest fact before it and
    the one before that, which two equalities find. Blocks, not entities, are the keys of that join.
    """
    line = stretched(timeline(requests, facts, entity, as_of, fact_time, values, ()), stretches)
    to_row, to_stretch = _within()
    counts = line.groupBy("_stretch", "_entity").agg(F.count("_fact").alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(to_stretch), F.lit(0)))
    carried = keep(before.where(F.col("_before") > 0).drop("_n"), "carried")
    here = line.withColumn("_here", F.count("_fact").over(to_row))
    numbered = _carried(here, carried).withColumn("_seq", F.col("_here") + F.coalesce("_before", F.lit(0)))
    numbered = keep(numbered.select("_entity", "_at", "_request", "_fact", "_seq"), "numbered")
    discard(line, carried)

    # Facts are numbered from 1, so a block of n ends at a multiple of n; requests before any fact have 0.
    block = F.ceil(F.col("_seq") / n)
    blocks = numbered.where(F.col("_request") == 0).groupBy("_entity", block.alias("_block")).agg(
        F.collect_list(F.struct("_seq", "_fact")).alias("_facts")
    )
    asked = numbered.where(F.col("_request") == 1).select("_entity", "_at", "_seq", block.alias("_last"))
    wanted = asked.withColumn("_want", F.explode(F.array("_last", F.col("_last") - 1))).where(F.col("_want") > 0)
    found = wanted.alias("w").join(
        blocks.alias("b"), F.col("w._entity").eqNullSafe(F.col("b._entity")) & (F.col("_want") == F.col("_block"))
    )
    part = F.filter("_facts", lambda f: (f["_seq"] <= F.col("w._seq")) & (f["_seq"] > F.col("w._seq") - n))
    halves = found.select("w._entity", "w._at", part.alias("_part"))
    none = asked.where(F.col("_last") == 0).select("_entity", "_at", F.lit(None).cast(halves.schema["_part"].dataType).alias("_part"))
    both = halves.unionByName(none).groupBy("_entity", "_at").agg(F.flatten(F.collect_list("_part")).alias("_both"))
    return both.select(
        F.col("_entity").alias(entity), F.col("_at").alias(as_of),
        F.transform(F.sort_array("_both"), lambda f: f["_fact"]).alias(into),
    )
