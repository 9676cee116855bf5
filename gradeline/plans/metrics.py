"""Aggregates over curated tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeline.functions.dates import as_column, month_key
from gradeline.functions.scores import growth_pct, weighted_mean

# Fixed value: rating columns from best (weight 1) to worst (weight 5)
RATING_COLUMNS = ("strongBuy", "buy", "hold", "sell", "strongSell")


def monthly_counts(
    rows: DataFrame, entity: str, day: Column | str, entity_as: str = "symbol", count_as: str = "news_count"
) -> DataFrame:
    """Rows per entity and calendar month."""
    return rows.groupBy(as_column(entity).alias(entity_as), month_key(day).alias("period")).agg(
        F.count(F.lit(1)).alias(count_as)
    )


def analyst_sentiment(
    recommendations: DataFrame,
    counts: DataFrame,
    keys: Sequence[str] = ("symbol", "period"),
    ratings: Sequence[str] = RATING_COLUMNS,
    count: str = "news_count",
) -> DataFrame:
    """Weighted mean rating beside the month's number of texts, 0 where there were none."""
    scored = recommendations.withColumn("mean_recommendation_score", weighted_mean(ratings))
    return scored.join(counts, list(keys), "left").fillna(0, subset=[count])


def growth_by_row(
    rows: DataFrame, entity: str, order: str, measures: dict[str, str], digits: int = 2
) -> DataFrame:
    """Growth of each measure against the entity's previous row, in percent.

    The previous row is the previous date there is, not the previous year. The table has one row per
    entity and date, so the rows of an entity are bounded by its dates.
    """
    window = Window.partitionBy(entity).orderBy(order)
    grown = {out: growth_pct(m, F.lag(m).over(window), digits) for m, out in measures.items()}
    return rows.withColumns(grown)


def forward_growth(estimates: DataFrame) -> DataFrame:
    """Yearly growth of expected revenue and earnings per share."""
    return growth_by_row(
        estimates,
        "symbol",
        "date",
        {"revenueAvg": "revenue_yoy_growth_pct", "epsAvg": "eps_yoy_growth_pct"},
    )


def rankings_by_brand(chart: DataFrame) -> DataFrame:
    """Chart rows of apps that belong to a brand."""
    return chart.where(F.col("brand").isNotNull()).select(
        "brand", "name", "_storefront", "_rank", F.to_date("_ingested_at").alias("snapshot_date")
    )


def engagement(
    reviews: DataFrame, catalogue: DataFrame, key: str, catalogue_key: str, rating: Column | str
) -> DataFrame:
    """Reviews and mean rating per title, one output row per catalogue entry of the title.

    Reviews are counted before the join, so a title with most of them is one row by then.
    """
    counted = reviews.groupBy(key).agg(
        F.count(F.lit(1)).alias("review_count"), F.avg(as_column(rating)).alias("avg_rating")
    )
    entries = catalogue.distinct().withColumnRenamed(catalogue_key, "_entry")
    return counted.join(entries, F.col(key) == F.col("_entry"), "left").drop("_entry")


def show_engagement(reviews: DataFrame, shows: DataFrame) -> DataFrame:
    """Review count and mean rating of every reviewed show, per platform it is listed on."""
    return engagement(
        reviews, shows.select("show_id", "name", "platform"), "_show_id", "show_id", "author_details.rating"
    )
