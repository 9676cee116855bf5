"""Scoring expressions shared by the metric, popularity and scorecard plans."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from gradeline.functions.dates import as_column

# Fixed values
RISE, HOLD, FALL = "rise", "hold", "fall"
CALLS = (RISE, HOLD, FALL)
CHART_SIZE = 100
HORIZON_DAYS = 7
Z_95 = 1.96


def weighted_mean(counts: Sequence[Column | str]) -> Column:
    """Mean of the positions 1..n weighted by their counts; NULL when every count is zero."""
    columns = [as_column(c).cast("long") for c in counts]
    total = reduce(add, columns)
    weighted = reduce(add, [c * F.lit(weight) for weight, c in enumerate(columns, start=1)])
    return F.try_divide(weighted.cast("double"), total.cast("double"))


def growth_pct(current: Column | str, prior: Column | str, digits: int = 2) -> Column:
    """Change against the prior value in percent; NULL without a prior value or with a zero one."""
    current, prior = as_column(current), as_column(prior)
    return F.round(F.try_divide(current - prior, prior) * F.lit(100), digits)


def rank_score(rank: Column | str, chart_size: int = CHART_SIZE) -> Column:
    """Rank 1 scores ``chart_size``, the last rank scores 1."""
    return (F.lit(chart_size + 1) - as_column(rank)).cast("double")


def classify_move(delta: Column | str, fall_below: Column, rise_above: Column) -> Column:
    """Rise and fall are strict, the edges count as hold; an unknown change or cutoff gives NULL."""
    delta = as_column(delta)
    return (
        F.when(delta.isNull() | fall_below.isNull() | rise_above.isNull(), F.lit(None).cast("string"))
        .when(delta > rise_above, F.lit(RISE))
        .when(delta < fall_below, F.lit(FALL))
        .otherwise(F.lit(HOLD))
    )


def wilson_bounds(hits: Column | str, n: Column | str, z: float = Z_95) -> tuple[Column, Column]:
    """Lower and upper end of the Wilson score interval; both NULL when ``n`` is 0."""
    trials = F.nullif(as_column(n).cast("double"), F.lit(0.0))
    rate = as_column(hits).cast("double") / trials
    shift = F.lit(z * z) / trials
    middle = rate + shift / 2
    spread = F.lit(z) * F.sqrt((rate * (1 - rate) + shift / 4) / trials)
    return (middle - spread) / (1 + shift), (middle + spread) / (1 + shift)
