"""One row per key, typed values, aliases, enrichment, corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeline.catalog.fixtures import CORPUS_LANGUAGES, CORPUS_SQL, NOW, corpus, moment, table
from gradeline.catalog.registry import query
from gradeline.functions.dates import age_hours, epoch_date, month_key
from gradeline.functions.picks import digest_index, hashed_index, pick
from gradeline.functions.scores import CALLS
from gradeline.functions.text import joined, normalised
from gradeline.operators.latest import latest_per_key
from gradeline.plans.curate import attach_brand, brand_aliases, reconcile
from gradeline.plans.metrics import rankings_by_brand

# Part brands that share an owner
PART_ALIASES = (
    ("Alpha", "Brand#1"), ("Alpha", "Brand#2"), ("Beta", "Brand#7"), ("Beta", "Brand#11"), ("Gamma", "Brand#17"),
)


@query("q09_latest_per_key", """
SELECT o_custkey, o_orderpriority, o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_totalprice
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority
        ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1""")
def latest_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest order of every customer and priority."""
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderpriority", "o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_totalprice"
    )
    return latest_per_key(orders, ["o_custkey", "o_orderpriority"], ["o_orderdate"], ["o_orderkey"])


@query("q09b_typed_latest", """
SELECT user_id, event_type, event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date,
  CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""")
def typed_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with Unix seconds and JSON text, typed and reduced to the newest per user and type."""
    epoch = F.unix_seconds(F.col("ts").cast("timestamp"))
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts", epoch.alias("datetime"), "props")
    newest = latest_per_key(events, ["user_id", "event_type"], ["ts"], ["event_id"])
    return newest.select(
        "user_id", "event_type", "event_id", epoch_date("datetime").alias("event_date"),
        F.from_json("props", "k bigint")["k"].alias("k"),
    )


@query("q10_alias_rankings", """
WITH alias(brand, name) AS (VALUES ('Alpha', 'Brand#1'), ('Alpha', 'Brand#2'), ('Beta', 'Brand#7'),
  ('Beta', 'Brand#11'), ('Gamma', 'Brand#17'))
SELECT brand, p_brand AS name, p_type AS _storefront, p_size AS _rank, '2024-02-01' AS snapshot_date, count(*) AS n
FROM part JOIN alias ON name = p_brand GROUP BY ALL""")
def alias_rankings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts by owner of their brand; parts of other brands have none and drop out."""
    parts = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("name"), F.col("p_type").alias("_storefront"), F.col("p_size").alias("_rank"),
        moment(NOW).alias("_ingested_at"),
    )
    ranked = rankings_by_brand(attach_brand(parts, brand_aliases(spark, PART_ALIASES)))
    return ranked.groupBy(*ranked.columns).agg(F.count(F.lit(1)).alias("n"))


@query("q13_scalar_keys", """
SELECT event_id, strftime(ts, '%Y-%m-01') AS month_key,
  CAST(CAST(ts AS DATE) + 7 AS VARCHAR) AS week_later, CAST(CAST(ts AS DATE) - 7 AS VARCHAR) AS week_before,
  CAST(CAST(ts AS DATE) AS VARCHAR) AS day_of_epoch,
  floor(epoch(TIMESTAMP '2024-02-01') - floor(epoch(ts))) / 3600 AS age_h,
  list_extract(['rise', 'hold', 'fall'],
    CAST(CAST('0x' || substr(md5(concat_ws('|', event_id, event_type)), 1, 8) AS BIGINT) % 3 AS INT) + 1) AS drawn,
  'event_' || event_type || '_' || event_id AS label, lower(trim(' ' || upper(event_type) || ' ')) AS cleaned,
  CAST(floor(value) AS BIGINT) AS whole, CAST(value > 50 AS INT) AS is_large, coalesce(nullif(event_type, 'error'), 'none') AS kind
FROM events""")
def scalar_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date, text, array, cast and conditional expressions of the curated tables."""
    day = F.col("ts").cast("date")
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        month_key(day).alias("month_key"),
        F.date_add(day, 7).alias("week_later"),
        F.date_sub(day, 7).alias("week_before"),
        epoch_date(seconds).alias("day_of_epoch"),
        age_hours(F.col("ts").cast("timestamp"), moment(NOW).cast("timestamp")).alias("age_h"),
        pick(CALLS, digest_index(["event_id", "event_type"], len(CALLS))).alias("drawn"),
        joined([F.lit("event"), F.col("event_type"), F.col("event_id").cast("string")], "_").alias("label"),
        normalised(F.concat(F.lit(" "), F.upper("event_type"), F.lit(" "))).alias("cleaned"),
        F.floor("value").alias("whole"),
        (F.col("value") > 50).cast("int").alias("is_large"),
        F.coalesce(F.nullif("event_type", F.lit("error")), F.lit("none")).alias("kind"),
    )


@query("q13h_hashed_pick", """
SELECT CAST(ts AS DATE)::VARCHAR AS day, count(*) AS n, count(DISTINCT user_id) AS keys, CAST(0 AS BIGINT) AS keys_with_two_calls,
  count(*) FILTER (user_id IS NULL) AS outside
FROM events GROUP BY 1""")
def hashed_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds for draws by Spark's seeded hash whatever it is: one call per user and day, out of three."""
    day = F.col("ts").cast("date").alias("day")
    drawn = pick(CALLS, hashed_index(["user_id", F.col("ts").cast("date")], "baseline", len(CALLS)))
    calls = table(spark, sf_dir, "events").groupBy(day, "user_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(drawn).alias("calls"),
        F.count_if(~F.coalesce(drawn.isin(*CALLS), F.lit(False))).alias("outside"),
    )
    return calls.groupBy("day").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("keys"), F.count_if(F.col("calls") > 1).alias("keys_with_two_calls"),
        F.sum("outside").alias("outside"),
    )


@query("q17_corpus_union", "WITH" + CORPUS_SQL + """
SELECT doc_id, source_type, entity, text_content, CAST(published_date AS VARCHAR) AS published_date FROM corpus""")
def corpus_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and conversations as one dated corpus."""
    return corpus(spark, sf_dir)


@query("q17r_reconcile", "WITH" + CORPUS_SQL + """
SELECT (SELECT count(*) FROM corpus) AS corpus_total,
  (SELECT count(*) FROM documents WHERE lang IN ('en', 'de')) AS news_matching,
  (SELECT count(*) FROM conversations WHERE text IS NOT NULL) AS reviews_matching""")
def corpus_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus holds every matching row of its sources."""
    parts = {
        "news_matching": table(spark, sf_dir, "documents").where(F.col("lang").isin(*CORPUS_LANGUAGES)),
        "reviews_matching": table(spark, sf_dir, "conversations").where(F.col("text").isNotNull()),
    }
    return reconcile(corpus(spark, sf_dir), parts, spark)


@query("q17n_null_parts", """
SELECT d.doc_id, d.source || '. ' || CASE WHEN l.quality = 1 THEN d.text END AS strict_text,
  concat_ws('. ', d.source, CASE WHEN l.quality = 1 THEN d.text END) AS lenient_text
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def null_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text with a missing part: NULL as a whole, or the parts there are."""
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    summary = F.when(F.col("quality") == 1, F.col("text"))
    return rows.select(
        "doc_id",
        joined([F.col("source"), summary], ". ").alias("strict_text"),
        joined([F.col("source"), summary], ". ", skip_null=True).alias("lenient_text"),
    )
