"""Approximate percentiles that merge: a quantile sketch per slice, any range of slices from the stored sketches.

The exact forms are in ``operators.percentiles``. A sketch holds some tens of kilobytes whatever the number of rows
behind it, and merging loses nothing: a range read from slices errs no more than one sketch of all its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from gradeline.sources.tables import Database

#: Size of a sketch. Spark takes 8 to 65,535.
K = 1_600


def rank_error(k: int = K) -> float:
    """By how much the rank of an answer differs from the one asked for, as a share of the rows, in 99 cases of 100.

    The published bound of the sketch for single ranks; its double lies five standard deviations out.
    """
    return 2.296 / k**0.9723


def slice_sketches(df: DataFrame, slices: str, value: str, k: int = K) -> DataFrame:
    """(slice, n, sketch) with the slice column first; one small row per task and slice goes through the shuffle.

    NULL and NaN have no rank: they are in no sketch and not in ``n``. A slice with nothing else has ``n`` = 0.
    """
    number = F.col(value).cast("double")
    number = F.when(~F.isnan(number), number)
    return df.groupBy(slices).agg(F.count(number).alias("n"), F.kll_sketch_agg_double(number, k).alias("sketch"))


def percentiles(sketch: Column | str, probabilities: Sequence[float]) -> Column:
    """One value per probability, NULL of an empty sketch; 0 and 1 give the exact least and greatest value."""
    sketch = F.col(sketch) if isinstance(sketch, str) else sketch
    found = F.array(*[F.kll_sketch_get_quantile_double(sketch, F.lit(float(p))) for p in probabilities])
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, found)


def approximate_percentile_table(df: DataFrame, value: str, probabilities: Sequence[float], k: int = K) -> DataFrame:
    """(p, percentile) as ``percentile_table`` gives them, in one pass and within ``rank_error(k)``; no rows, no result."""
    whole = slice_sketches(df.select(F.lit(0).alias("all"), F.col(value)), "all", value, k).where(F.col("n") > 0)
    asked = F.array(*[F.lit(float(p)) for p in probabilities])
    return whole.select(F.inline(F.arrays_zip(asked.alias("p"), percentiles("sketch", probabilities).alias("percentile"))))


class StoredSketches:
    """Sketches of one column by slices such as days or loads; a slice that comes again replaces its sketch."""

    def __init__(self, database: Database, table: str, slices: str, value: str, k: int = K):
        self.database, self.name, self.slices, self.value, self.k = database, table, slices, value, k

    def load(self, rows: DataFrame) -> None:
        """Sketch the slices that occur in ``rows``, which are read once. A row without slice is an error."""
        self.database.load_slice(self.name, slice_sketches(rows, self.slices, self.value, self.k), self.slices)

    def table(self) -> DataFrame:
        return self.database.table(self.name)

    def over(self, ranges: DataFrame, low: str, high: str) -> DataFrame:
        """``ranges`` with (n, sketch) of the slices from ``low`` to ``high``, both included; NULLs where there are none.

        The slices there are, as many as days or loads, are put into the plan, so that ranges meet sketches by equality.
        The other columns of ``ranges`` name a range; those that are equal are one.
        """
        stored = self.table()
        known = F.lit(stored.agg(F.collect_set(self.slices)).first()[0]).cast(ArrayType(stored.schema[self.slices].dataType))
        inside = F.filter(known, lambda s: (s >= F.col(low)) & (s <= F.col(high)))
        named = ranges.distinct().select("*", F.explode_outer(inside).alias("_slice"))
        sketches = stored.select(F.col(self.slices).alias("_slice"), F.col("n").alias("_n"), F.col("sketch").alias("_sketch"))
        return (
            named.join(sketches, "_slice", "left")
            .groupBy(*ranges.columns)
            .agg(F.sum("_n").alias("n"), F.kll_merge_agg_double("_sketch").alias("sketch"))
        )
