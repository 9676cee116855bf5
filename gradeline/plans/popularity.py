"""Chart ranks to popularity series, frozen cutoffs and point-in-time signals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeline.functions.scores import CHART_SIZE, HORIZON_DAYS, rank_score
from gradeline.operators.asof import latest_as_of, trailing_as_of
from gradeline.operators.latest import latest_per_key, newest_day
from gradeline.operators.offsets import offset_values
from gradeline.operators.percentiles import percentile_table
from gradeline.operators.topk import top_k
from gradeline.sources.tables import keep

# Fixed values
STOREFRONT = "us"
BRANDS = ("Netflix", "Disney+")
SYMBOL_BRANDS = (("NFLX", "Netflix"), ("DIS", "Disney+"))
RECENT_SNAPSHOTS = 7
# A decimal 1.0 / 3 keeps six digits, so these are the terciles the cutoffs are frozen at.
TERCILES = (0.333333, 0.666667)


def daily_chart(
    activity: DataFrame, day: Column, entity: str, amount: str, size: int = CHART_SIZE, within: Sequence[str] = ()
) -> DataFrame:
    """Rank entities by a day's total amount; the chart is the first ``size`` of each day, and of each
    value of the ``within`` columns."""
    totals = activity.groupBy(day.alias("snapshot_date"), *within, F.col(entity)).agg(
        F.round(F.sum(amount), 2).alias("total")
    )
    return top_k(totals, ["snapshot_date", *within], [F.col("total").desc(), F.col(entity).asc()], size)


def chart_snapshot(bronze_chart: DataFrame, ingested_at: str = "_ingested_at") -> DataFrame:
    """The newest loaded day as rows of the rank history."""
    day = F.to_date(ingested_at)
    current = latest_per_key(newest_day(bronze_chart, ingested_at, of_moment=True), ["id", "_storefront"], [ingested_at])
    return current.select(
        "id", "_storefront", "name", F.col("_rank").alias("rank"), day.alias("snapshot_date")
    )


def brand_popularity(
    history: DataFrame, storefront: str = STOREFRONT, brands: Sequence[str] = BRANDS, chart_size: int = CHART_SIZE
) -> DataFrame:
    """Popularity of the listed brands in one storefront; other storefronts come and go.

    One row per brand and day: of two apps with the brand's name the better placed one counts.
    """
    listed = history.where((F.col("_storefront") == storefront) & F.col("name").isin(*brands))
    best = listed.groupBy(F.col("name").alias("brand"), F.col("snapshot_date").alias("d")).agg(F.min("rank").alias("rank"))
    return best.select("brand", "d", rank_score("rank", chart_size).alias("popularity"))


def brand_popularity_sql(
    history: str, storefront: str = STOREFRONT, brands: Sequence[str] = BRANDS, chart_size: int = CHART_SIZE
) -> str:
    """``brand_popularity`` as the text of a view, for sessions to come."""
    listed = ", ".join("'" + b.replace("'", "''") + "'" for b in brands)
    return (
        f"SELECT name AS brand, snapshot_date AS d, CAST({chart_size + 1} - min(rank) AS DOUBLE) AS popularity "
        f"FROM {history} WHERE _storefront = '{storefront}' AND name IN ({listed}) GROUP BY name, snapshot_date"
    )


def moves(popularity: DataFrame, horizon: Column | int = HORIZON_DAYS) -> DataFrame:
    """Per brand and day: popularity then, ``horizon`` days later and before, and both changes."""
    horizon = F.lit(horizon) if isinstance(horizon, int) else horizon
    values = offset_values(popularity, "brand", "d", "popularity", horizon)
    return values.select(
        "brand",
        "d",
        F.col("value_then").alias("pop_then"),
        F.col("value_future").alias("pop_future"),
        (F.col("value_future") - F.col("value_then")).alias("delta"),
        (F.col("value_then") - F.col("value_prior")).alias("prior_delta"),
    )


def cutoffs(
    popularity: DataFrame,
    frozen_at: Column,
    horizon_days: int = HORIZON_DAYS,
    probabilities: tuple[float, float] = TERCILES,
) -> DataFrame:
    """One row of thresholds: the terciles of all changes over the horizon, pooled over brands.

    The changes are kept as a table and their percentiles found by ``percentile_table``, which asks
    nothing of the number of distinct values. Without any change the thresholds are NULL.
    """
    changes = keep(moves(popularity, horizon_days).where(F.col("delta").isNotNull()).select("d", "delta"), "changes")
    found = percentile_table(changes, "delta", probabilities)
    low, high = (found.where(F.col("p") == p).select("percentile").scalar() for p in probabilities)
    return changes.agg(
        F.count("delta").alias("n_deltas"), F.min("d").alias("first_d"), F.max("d").alias("last_d")
    ).select(
        F.lit(horizon_days).alias("horizon_days"), low.alias("fall_below"), high.alias("rise_above"),
        "n_deltas", "first_d", "last_d", frozen_at.alias("frozen_at"),
    )


def scorable_dates(
    popularity: DataFrame, horizon: Column | int, start: Column, end: Column
) -> DataFrame:
    """Days in a range whose later snapshot exists, so a call made on them can be graded."""
    return (
        moves(popularity, horizon)
        .where(F.col("delta").isNotNull() & F.col("d").between(start, end))
        .select("brand", "d")
    )


def recent_popularity(requests: DataFrame, popularity: DataFrame, n: int = RECENT_SNAPSHOTS) -> DataFrame:
    """The newest ``n`` snapshots on or before each (brand, as_of), oldest first."""
    return trailing_as_of(requests, popularity, "brand", "as_of", "d", ["popularity"], n, "recent")


def latest_sentiment(requests: DataFrame, sentiment: DataFrame) -> DataFrame:
    """The newest month of ratings that had begun by each (symbol, as_of)."""
    dated = sentiment.withColumn("_period_date", F.to_date("period"))
    values = [c for c in sentiment.columns if c != "symbol"]
    found = latest_as_of(requests, dated, "symbol", "as_of", "_period_date", values, [F.col("period")])
    known = F.col("_period_date").isNotNull()
    return found.select("symbol", "as_of", F.when(known, F.struct("symbol", *values)).alias("sentiment"))


def latest_estimate(
    requests: DataFrame, estimates: DataFrame, order: str = "date", loaded_at: str = "_ingested_at"
) -> DataFrame:
    """The estimate with the highest ``order`` among those loaded by the end of each as_of day.

    Estimates carry no publication date, so the load time is the guard. With ``order`` = date this
    is the farthest forecast year, not the next one.
    """
    columns = [order, *[c for c in estimates.columns if c != order]]
    daily = (
        estimates.select("symbol", F.to_date(loaded_at).alias("_at"), F.struct(*columns).alias("_row"))
        .groupBy("symbol", "_at")
        .agg(F.max("_row").alias("_row"))
    )
    found = best_so_far(requests, daily)
    row = F.struct(*[F.col("_row")[c].alias(c) for c in estimates.columns])
    return found.select("symbol", "as_of", F.when(F.col("_row").isNotNull(), row).alias("estimates"))


def best_so_far(requests: DataFrame, daily: DataFrame) -> DataFrame:
    """The largest ``_row`` of the days on or before each (symbol, as_of); one row per symbol and day."""
    row_type = daily.schema["_row"].dataType
    facts = daily.select("symbol", "_at", F.lit(0).alias("_request"), "_row")
    asked = requests.select("symbol", "as_of").distinct().select(
        "symbol", F.col("as_of").alias("_at"), F.lit(1).alias("_request"), F.lit(None).cast(row_type).alias("_row")
    )
    window = Window.partitionBy("symbol").orderBy("_at", "_request").rowsBetween(Window.unboundedPreceding, 0)
    return (
        facts.unionByName(asked)
        .withColumn("_row", F.max("_row").over(window))
        .where(F.col("_request") == 1)
        .select("symbol", F.col("_at").alias("as_of"), "_row")
    )
