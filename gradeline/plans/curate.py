"""Raw tables to one typed row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeline.functions.dates import epoch_date
from gradeline.functions.text import joined
from gradeline.operators.latest import latest_per_key, newest_day
from gradeline.operators.literals import literal_rows

INGESTED = "_ingested_at"

# App names that belong to a brand
BRAND_ALIASES = (
    ("Netflix", "Netflix"),
    ("Disney+", "Disney+"),
    ("Disney+", "Disney Plus"),
    ("Disney+", "Hotstar"),
    ("Disney+", "JioHotstar"),
)


def current_rows(bronze: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last loaded row of every key."""
    return latest_per_key(bronze, keys, [INGESTED])


def type_news(
    bronze: DataFrame,
    keys: Sequence[str] = ("id",),
    epoch: str = "datetime",
    unused: Sequence[str] = ("category", "image"),
) -> DataFrame:
    """Current news with the Unix time turned into a date.

    An article can come back for several symbols under one id; on the default key one of them wins.
    Pass ``("id", "related")`` to keep one row per article and symbol.
    """
    return current_rows(bronze, keys).withColumn("news_date", epoch_date(epoch)).drop(epoch, *unused)


def type_estimates(bronze: DataFrame) -> DataFrame:
    """Current estimates with a proper date."""
    return current_rows(bronze, ["symbol", "date"]).withColumn("date", F.to_date("date"))


def name_reviews(bronze: DataFrame, shows: DataFrame, key: str = "id", show: str = "_show_id") -> DataFrame:
    """Current reviews with the name of their show; a show spelled two ways yields two rows.

    The reviews of one show may be most of the table. No side is hinted: Spark broadcasts the names
    when they are small and otherwise splits the hot show's partition at run time.
    """
    names = shows.select(F.col("show_id").alias(show), "name").distinct()
    reviews = current_rows(bronze, [key])
    joined_rows = reviews.join(names, show, "left")
    return joined_rows.select(*reviews.columns, "name")


def brand_aliases(spark: SparkSession, rows: Sequence[tuple[str, str]] = BRAND_ALIASES) -> DataFrame:
    """Lookup (brand, name) with at most one row per name."""
    names = [name for _, name in rows]
    if len(set(names)) != len(names):
        raise ValueError("an alias may belong to one brand only")
    return literal_rows(spark, rows, "brand string, name string")


def attach_brand(rows: DataFrame, aliases: DataFrame, name: str = "name") -> DataFrame:
    """Add the brand of a name, NULL where the name is nobody's alias."""
    lookup = aliases.select(F.col("name").alias(name), "brand")
    return rows.join(lookup, name, "left")


def newest_chart(bronze: DataFrame, aliases: DataFrame) -> DataFrame:
    """The newest day's chart, one row per app and storefront, with brands."""
    today = newest_day(bronze, INGESTED, of_moment=True)
    current = latest_per_key(today, ["id", "_storefront"], [INGESTED])
    return attach_brand(current, aliases).drop("_fetched_at")


def corpus_part(
    rows: DataFrame, doc_id: list[Column], source_type: str, entity: Column, text: Column, published: Column
) -> DataFrame:
    """One source in the shape of the text corpus."""
    return rows.select(
        joined([part.cast("string") for part in doc_id]).alias("doc_id"),
        F.lit(source_type).alias("source_type"),
        entity.cast("string").alias("entity"),
        text.alias("text_content"),
        published.cast("date").alias("published_date"),
    )


def text_corpus(news: DataFrame, reviews: DataFrame, symbols: Sequence[str], skip_null: bool = False) -> DataFrame:
    """News about the symbols and all reviews that have text, in one table.

    A headline without a summary has no text unless ``skip_null`` is set; its row stays either way. An
    id has one row, the latest published, also where a show or an article comes under two names.
    """
    articles = corpus_part(
        news.where(F.col("related").isin(*symbols)),
        [F.lit("news_"), F.col("id")],  # fixed value: the prefixes of ids
        "news",
        F.col("related"),
        joined([F.col("headline"), F.col("summary")], ". ", skip_null),
        F.col("news_date"),
    )
    opinions = corpus_part(
        reviews.where(F.col("content").isNotNull()),
        [F.lit("review_"), F.col("_show_id"), F.lit("_"), F.col("id")],
        "review",
        F.col("_show_id"),
        F.col("content"),
        F.to_date("created_at"),
    )
    return latest_per_key(articles.unionByName(opinions), ["doc_id"], ["published_date"])


def reconcile(total: DataFrame, parts: dict[str, DataFrame], spark: SparkSession) -> DataFrame:
    """One row of counts: the whole beside the parts it should be the sum of."""

    def rows(df: DataFrame) -> Column:
        return df.agg(F.count(F.lit(1))).scalar()

    counts = [rows(total).alias("corpus_total"), *[rows(df).alias(name) for name, df in parts.items()]]
    return spark.range(1).select(*counts)
