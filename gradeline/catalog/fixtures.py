"""The given tables in the shape of the product's own, and the same in SQL.

==================  ==========================================================================
product table       given table
==================  ==========================================================================
app chart           users ranked per day by the sum of their event values, first 100
storefront charts   the same in groups of 100 users, so that no user is cut off
popularity          the storefront charts, brand = user id
predictions, skips  one reply per chart row and variant, parsed; the unreadable ones are skips
recommendations     orders per nation and month, counted by priority digit 1 to 5
estimates           order value per nation and year
news, reviews       documents in two languages, conversation turns
questions           one per embedding label: the label's mean vector, a benchmark text
==================  ==========================================================================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeline.functions.scores import CALLS, rank_score
from gradeline.functions.picks import pick
from gradeline.plans.calls import first_parsed, route_answers
from gradeline.plans.curate import corpus_part
from gradeline.plans.popularity import daily_chart
from gradeline.sources.tables import keep

LIVE_FROM_DAY = 16
FETCHED_AT = "2024-02-01 06:00:00"
INGESTED_AT = "2024-02-01 07:00:00"
NOW = "2024-02-01 00:00:00"
CORPUS_START = "2024-01-01"
CORPUS_DAYS = 30
CORPUS_LANGUAGES = ("en", "de")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(snapshot_date, user_id, total, rank)"""
    return daily_chart(table(spark, sf_dir, "events"), F.col("ts").cast("date"), "user_id", "value")


CHART_SQL = """
chart AS (
  SELECT snapshot_date, user_id, total, CAST(rank AS INT) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY snapshot_date ORDER BY total DESC, user_id) AS rank
    FROM (SELECT CAST(ts AS DATE) AS snapshot_date, user_id, round(sum(value), 2) AS total
          FROM events GROUP BY 1, 2))
  WHERE rank <= 100)"""


STOREFRONT_USERS = 100


def storefront_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(snapshot_date, _storefront, user_id, total, rank): every user of a day has a place."""
    events = table(spark, sf_dir, "events").withColumn("_storefront", F.expr(f"user_id div {STOREFRONT_USERS}"))
    return daily_chart(events, F.col("ts").cast("date"), "user_id", "value", within=["_storefront"])


STOREFRONT_SQL = """
chart AS (
  SELECT snapshot_date, storefront, user_id, total,
    CAST(rank() OVER (PARTITION BY storefront, snapshot_date ORDER BY total DESC, user_id) AS INT) AS rank
  FROM (SELECT CAST(ts AS DATE) AS snapshot_date, user_id // 100 AS storefront, user_id, round(sum(value), 2) AS total
        FROM events GROUP BY ALL))"""


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The storefront charts as a stored table, which is what popularity and predictions read in use."""
    return keep(storefront_chart(spark, sf_dir), "history")


def popularity(spark: SparkSession, sf_dir: str, ranked: DataFrame | None = None) -> DataFrame:
    """(brand, d, popularity)"""
    return (ranked or storefront_chart(spark, sf_dir)).select(
        F.col("user_id").cast("string").alias("brand"),
        F.col("snapshot_date").alias("d"),
        rank_score("rank").alias("popularity"),
    )


POPULARITY_SQL = STOREFRONT_SQL + """,
pop AS (
  SELECT CAST(user_id AS VARCHAR) AS brand, snapshot_date AS d, CAST(101 - rank AS DOUBLE) AS popularity
  FROM chart)"""


def symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(symbol, brand) of every user with an event."""
    users = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("brand")).distinct()
    return users.select(F.concat(F.lit("U"), "brand").alias("symbol"), "brand")


def replies(spark: SparkSession, sf_dir: str, ranked: DataFrame | None = None) -> DataFrame:
    """One reply per chart row and variant, some of them without an answer in it."""
    day = F.dayofmonth("snapshot_date")
    user = F.col("user_id")
    rows = (ranked or storefront_chart(spark, sf_dir)).select(
        F.concat(F.lit("U"), user.cast("string")).alias("symbol"),
        F.col("snapshot_date").alias("prediction_date"),
        F.when(day >= LIVE_FROM_DAY, F.lit("live")).otherwise(F.lit("backfill")).alias("source"),
        F.inline(F.array(
            F.struct(F.lit("rag").alias("variant"), ((user + day) % 3).alias("call_index")),
            F.struct(F.lit("no_rag").alias("variant"), ((user * 7 + day) % 3).alias("call_index")),
        )),
        ((user * 13 + day) % 11 == 0).alias("unreadable"),
        "rank",
    )
    answer = F.concat(
        F.lit('My answer:\n{"call": "'), F.upper(pick(CALLS, F.col("call_index"))),
        F.lit('", "confidence": "medium", "reasoning": "rank '), F.col("rank").cast("string"), F.lit('"}\nDone.'),
    )
    return rows.select(
        "symbol", "prediction_date", "source", "variant", F.lit(1).alias("attempt"),
        F.when(F.col("unreadable"), F.lit("I cannot tell.")).otherwise(answer).alias("reply"),
    )


def prediction_log(
    spark: SparkSession, sf_dir: str, ranked: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(predictions, skips) out of one kept table of parsed answers."""
    keys = ["symbol", "prediction_date", "source", "variant"]
    answered = keep(first_parsed(replies(spark, sf_dir, ranked), keys), "answers")
    return route_answers(answered, moment(INGESTED_AT))


REPLY_KEYS_SQL = POPULARITY_SQL + """,
asked AS (
  SELECT 'U' || user_id AS symbol, CAST(user_id AS VARCHAR) AS brand, snapshot_date AS prediction_date, rank,
    CASE WHEN day(snapshot_date) >= 16 THEN 'live' ELSE 'backfill' END AS source, v.variant,
    list_extract(['rise', 'hold', 'fall'],
      CAST((CASE v.variant WHEN 'rag' THEN user_id ELSE user_id * 7 END + day(snapshot_date)) % 3 AS INT) + 1) AS call,
    (user_id * 13 + day(snapshot_date)) % 11 = 0 AS unreadable
  FROM chart CROSS JOIN (VALUES ('rag'), ('no_rag')) v(variant)),
predictions AS (
  SELECT symbol, brand, prediction_date, source, variant, call, 'medium' AS confidence,
    'rank ' || rank AS reasoning FROM asked WHERE NOT unreadable),
skips AS (SELECT symbol, prediction_date, source, variant FROM asked WHERE unreadable)"""


def publication_date(number: Column) -> Column:
    """A date for tables that carry none: 30 days in turn."""
    return F.date_add(F.lit(CORPUS_START).cast("date"), (number % CORPUS_DAYS).cast("int"))


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, source_type, entity, text_content, published_date)"""
    documents = table(spark, sf_dir, "documents")
    turns = table(spark, sf_dir, "conversations")
    articles = corpus_part(
        documents.where(F.col("lang").isin(*CORPUS_LANGUAGES)),
        [F.lit("doc_"), F.col("doc_id")],
        "document",
        F.col("source"),
        F.concat("source", F.lit(". "), "text"),
        publication_date(F.col("doc_id")),
    )
    opinions = corpus_part(
        turns.where(F.col("text").isNotNull()),
        [F.lit("conv_"), F.col("conv_id"), F.lit("_"), F.col("turn")],
        "conversation",
        F.col("conv_id"),
        F.col("text"),
        publication_date(F.col("conv_id")),
    )
    return articles.unionByName(opinions)


CORPUS_SQL = """
corpus AS (
  SELECT 'doc_' || doc_id AS doc_id, 'document' AS source_type, source AS entity,
    source || '. ' || text AS text_content, DATE '2024-01-01' + CAST(doc_id % 30 AS INT) AS published_date
  FROM documents WHERE lang IN ('en', 'de')
  UNION ALL
  SELECT 'conv_' || conv_id || '_' || turn, 'conversation', CAST(conv_id AS VARCHAR), text,
    DATE '2024-01-01' + CAST(conv_id % 30 AS INT)
  FROM conversations WHERE text IS NOT NULL)"""


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding as a dated document."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"), "embedding", publication_date(F.col("vec_id")).alias("published_date")
    )


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity, query_vector) per label: the mean of its vectors, six digits of each part.

    Kept as a table, as questions are in use: they are read several times and few.
    """
    parts = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    means = parts.groupBy("label", "i").agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("x"))
    ordered = F.sort_array(F.collect_list(F.struct("i", "x")))
    vectors_ = means.groupBy("label").agg(F.transform(ordered, lambda p: p["x"]).alias("query_vector"))
    return keep(vectors_.select(F.col("label").alias("entity"), "query_vector"), "questions")


QUESTIONS_SQL = """
means AS (
  SELECT label, i, round(avg(CAST(x AS DOUBLE)), 6) AS x
  FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)
  GROUP BY label, i),
questions AS (SELECT label AS entity, list(x ORDER BY i) AS q FROM means GROUP BY label),
docs AS (
  SELECT vec_id AS doc_id, CAST(embedding AS DOUBLE[]) AS e,
    DATE '2024-01-01' + CAST(vec_id % 30 AS INT) AS published_date
  FROM embeddings),
scores AS (
  SELECT entity, doc_id, published_date,
    round(list_dot_product(e, q) / (sqrt(list_dot_product(e, e)) * sqrt(list_dot_product(q, q))), 9) AS score
  FROM docs CROSS JOIN questions)"""
