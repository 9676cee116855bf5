"""Data-quality rules. Every check is a row; a suite fails once and names all that failed.

Rules on one table that need no grouping share a single pass over it. Uniqueness groups by its key,
which combines before the shuffle, so a key with most of the rows costs one row per partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeline.functions.dates import age_hours, as_column
from gradeline.functions.scores import CALLS

PASS, FAIL, SKIP = "PASS", "FAIL", "SKIP"

# limits
FRESHNESS_HOURS = 36
SKIP_RATE_DAYS, SKIP_RATE_LIMIT = 7, 0.20
COLLAPSE_DAYS, COLLAPSE_MIN_ROWS, COLLAPSE_MAX_SHARE = 14, 20, 0.90


@dataclass(frozen=True)
class RowCount:
    """At least ``minimum`` rows."""

    minimum: int = 1


@dataclass(frozen=True)
class NoNulls:
    """No NULL in any of the columns."""

    columns: tuple[str, ...]


@dataclass(frozen=True)
class Allowed:
    """No value outside the list. A NULL is not outside it; ``NoNulls`` finds that."""

    column: str
    values: tuple[str, ...]


@dataclass(frozen=True)
class Unique:
    """No key twice. NULLs count as values."""

    keys: tuple[str, ...]


Rule = RowCount | NoNulls | Allowed | Unique


def _result(check: str, target: Column, observed: Column, limit: float, passed: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check_name"),
        target.alias("target"),
        F.when(passed, F.lit(PASS)).otherwise(F.lit(FAIL)).alias("status"),
        observed.cast("double").alias("observed"),
        F.lit(float(limit)).alias("limit_value"),
    )


def _one_pass(df: DataFrame, rules: Sequence[Rule]) -> DataFrame | None:
    measures: list[Column] = []
    results: list[Column] = []

    def add(check: str, target: str, measure: Column, limit: float, low: bool) -> None:
        name = f"_m{len(measures)}"
        measures.append(measure.alias(name))
        observed = F.col(name)
        passed = observed <= limit if low else observed >= limit
        results.append(_result(check, F.lit(target), observed, limit, passed))

    for rule in rules:
        if isinstance(rule, RowCount):
            add("row_count", "*", F.count(F.lit(1)), rule.minimum, low=False)
        elif isinstance(rule, NoNulls):
            for column in rule.columns:
                add("no_nulls", column, F.count_if(F.col(column).isNull()), 0, low=True)
        elif isinstance(rule, Allowed):
            outside = ~F.col(rule.column).isin(*rule.values)
            add("allowed_values", rule.column, F.count_if(outside), 0, low=True)
    if not measures:
        return None
    return df.agg(*measures).select(F.inline(F.array(*results)))


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows in all, distinct keys, and rows beyond the first of their key."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
            F.count(F.lit(1)).alias("n_keys"),
            F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_duplicates"),
        )
    )


def check_table(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Results (check_name, target, status, observed, limit_value) of all rules on one table."""
    parts = [p for p in [_one_pass(df, rules)] if p is not None]
    for rule in rules:
        if isinstance(rule, Unique):
            observed = F.col("n_duplicates")
            result = _result("unique_key", F.lit(",".join(rule.keys)), observed, 0, observed <= 0)
            parts.append(duplicate_rows(df, rule.keys).select(F.inline(F.array(result))))
    return reduce(DataFrame.unionByName, parts)


def run_suite(suite: str, tables: dict[str, tuple[DataFrame, Sequence[Rule]]]) -> DataFrame:
    """Results of a whole layer."""
    parts = [
        check_table(df, rules).select(F.lit(suite).alias("suite"), F.lit(name).alias("table_name"), "*")
        for name, (df, rules) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def freshness(
    sources: dict[str, tuple[DataFrame, Column | str]], now: Column, max_hours: float = FRESHNESS_HOURS
) -> DataFrame:
    """Newest moment and age of every source; a source without rows is stale."""
    parts = []
    for name, (df, moment) in sources.items():
        newest = df.agg(F.max(as_column(moment)).cast("timestamp").alias("newest"))
        age = age_hours("newest", now)
        fresh = F.coalesce(age <= max_hours, F.lit(False))
        parts.append(
            newest.select(
                F.lit(name).alias("source"),
                F.col("newest").cast("string").alias("newest"),
                age.alias("age_h"),
                F.when(fresh, F.lit(PASS)).otherwise(F.lit(FAIL)).alias("status"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def skip_rate(
    predictions: DataFrame,
    skips: DataFrame,
    today: Column,
    days: int = SKIP_RATE_DAYS,
    limit: float = SKIP_RATE_LIMIT,
) -> DataFrame:
    """One row: the share of skipped calls since ``days`` days ago; no calls at all is no verdict."""
    recent = F.col("prediction_date") >= F.date_sub(today, days)
    calls = predictions.where(recent).select(F.lit(0).alias("skipped")).unionAll(
        skips.where(recent).select(F.lit(1).alias("skipped"))
    )
    totals = calls.agg(
        F.coalesce(F.sum("skipped"), F.lit(0)).alias("skips"), F.count(F.lit(1)).alias("total")
    )
    rate = F.try_divide(F.col("skips"), F.col("total"))
    status = F.when(rate.isNull(), F.lit(SKIP)).when(rate < limit, F.lit(PASS)).otherwise(F.lit(FAIL))
    return totals.select("skips", "total", rate.alias("rate"), status.alias("status"))


def call_collapse(
    predictions: DataFrame,
    today: Column,
    days: int = COLLAPSE_DAYS,
    min_rows: int = COLLAPSE_MIN_ROWS,
    max_share: float = COLLAPSE_MAX_SHARE,
) -> DataFrame:
    """Per variant the most frequent live call and its share; few rows are no verdict.

    Calls are counted first, so the windows see one row per variant and call.
    """
    live = (F.col("source") == "live") & (F.col("prediction_date") >= F.date_sub(today, days))
    counted = predictions.where(live).groupBy("variant", "call").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("variant"))
    order = Window.partitionBy("variant").orderBy(F.col("n").desc(), F.col("call").asc())
    top = (
        counted.withColumn("total", total)
        .withColumn("_rn", F.row_number().over(order))
        .where(F.col("_rn") == 1)
    )
    share = F.col("n") / F.col("total")
    status = (
        F.when(F.col("total") < min_rows, F.lit(SKIP))
        .when(share > max_share, F.lit(FAIL))
        .otherwise(F.lit(PASS))
    )
    return top.select("variant", F.col("call").alias("top_call"), "n", "total", share.alias("share"), status.alias("status"))


# The limits and columns of the product's own suites, table -> rules. The keys are the columns that identify a row of that table.
BRONZE: dict[str, tuple[Rule, ...]] = {
    "recommendation_trends": (RowCount(), NoNulls(("symbol", "period"))),
    "app_chart": (RowCount(), Unique(("id", "_storefront", "_ingested_at"))),
    "shows": (RowCount(),),
    "reviews": (RowCount(),),
}
SILVER: dict[str, tuple[Rule, ...]] = {
    "recommendation_trends": (RowCount(), Unique(("symbol", "period"))),
    "app_chart": (RowCount(), Unique(("id", "_storefront"))),
    "news": (RowCount(), Unique(("id",))),
}
GOLD: dict[str, tuple[Rule, ...]] = {
    "analyst_sentiment": (RowCount(8), NoNulls(("mean_recommendation_score", "news_count"))),
    "forward_estimates": (RowCount(), NoNulls(("revenueAvg", "epsAvg"))),
    "rankings_by_brand": (RowCount(),),
    "show_engagement": (RowCount(), NoNulls(("review_count",))),
}
PREDICTIONS: dict[str, tuple[Rule, ...]] = {
    "predictions": (
        RowCount(),
        NoNulls(("symbol", "prediction_date", "source", "variant", "call")),
        Allowed("call", CALLS),
    ),
}


def raise_if_failed(*results: DataFrame) -> None:
    """Fail once with every failed check of all results. A result has one row per check, whatever the data size."""
    failed = [
        row["row"] for found in results
        for row in found.where(F.col("status") == FAIL).select(F.to_json(F.struct("*")).alias("row")).collect()
    ]
    if failed:
        raise AssertionError(f"{len(failed)} check(s) failed: " + "; ".join(failed))
