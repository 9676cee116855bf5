"""Data-quality reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeline.catalog.fixtures import NOW, REPLY_KEYS_SQL, moment, prediction_log, publication_date, table
from gradeline.catalog.measures import RATINGS_SQL, nation_ratings, source_engagement, weighted_sentiment
from gradeline.catalog.registry import query
from gradeline.functions.scores import CALLS
from gradeline.plans.quality import (
    GOLD, PREDICTIONS, SILVER, Allowed, NoNulls, RowCount, Unique, call_collapse, duplicate_rows, freshness, run_suite, skip_rate,
)
from gradeline.plans.quality_state import QualityState
from gradeline.session import shared_folder
from gradeline.sources.tables import Database

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query("q24_freshness", """
WITH newest AS (
  SELECT 'events' AS source, max(ts) AS newest FROM events
  UNION ALL SELECT 'events [purchase]', max(ts) FROM events WHERE event_type = 'purchase'
  UNION ALL SELECT 'events [refund]', max(ts) FROM events WHERE event_type = 'refund'
  UNION ALL SELECT 'orders', max(o_orderdate) FROM orders)
SELECT source, strftime(newest, '%Y-%m-%d %H:%M:%S') AS newest,
  (epoch(TIMESTAMP '2024-02-01') - floor(epoch(newest))) / 3600 AS age_h,
  CASE WHEN (epoch(TIMESTAMP '2024-02-01') - floor(epoch(newest))) / 3600 <= 36 THEN 'PASS' ELSE 'FAIL' END AS status
FROM newest""")
def source_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest row of every source against a fixed now; one source has none."""
    events, orders = table(spark, sf_dir, "events"), table(spark, sf_dir, "orders")
    sources = {
        "events": (events, "ts"),
        "events [purchase]": (events.where(F.col("event_type") == "purchase"), "ts"),
        "events [refund]": (events.where(F.col("event_type") == "refund"), "ts"),
        "orders": (orders, "o_orderdate"),
    }
    result = freshness(sources, moment(NOW).cast("timestamp"))
    return result.withColumn("newest", F.substring("newest", 1, 19))


@query("q25_quality_report", """
WITH dup AS (SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS n FROM lineitem),
missing AS (SELECT count(*) AS n FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE quality IS NULL),
r AS (
  SELECT 'raw' AS suite, 'lineitem' AS table_name, 'row_count' AS check_name, '*' AS target, (SELECT count(*) FROM lineitem) AS observed, 1 AS lim, TRUE AS low
  UNION ALL SELECT 'raw', 'lineitem', 'no_nulls', 'l_orderkey', (SELECT count(*) FROM lineitem WHERE l_orderkey IS NULL), 0, FALSE
  UNION ALL SELECT 'raw', 'lineitem', 'no_nulls', 'l_shipdate', (SELECT count(*) FROM lineitem WHERE l_shipdate IS NULL), 0, FALSE
  UNION ALL SELECT 'raw', 'lineitem', 'unique_key', 'l_orderkey,l_linenumber', (SELECT n FROM dup), 0, FALSE
  UNION ALL SELECT 'raw', 'orders', 'row_count', '*', (SELECT count(*) FROM orders), 1, TRUE
  UNION ALL SELECT 'raw', 'orders', 'unique_key', 'o_orderkey', (SELECT count(*) - count(DISTINCT o_orderkey) FROM orders), 0, FALSE
  UNION ALL SELECT 'raw', 'region', 'row_count', '*', (SELECT count(*) FROM region), 8, TRUE
  UNION ALL SELECT 'raw', 'rated', 'no_nulls', 'quality', (SELECT n FROM missing), 0, FALSE
  UNION ALL SELECT 'raw', 'conversations', 'unique_key', 'conv_id,turn',
    (SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT conv_id, turn FROM conversations)) FROM conversations), 0, FALSE)
SELECT suite, table_name, check_name, target, CASE WHEN CASE WHEN low THEN observed >= lim ELSE observed <= lim END THEN 'PASS' ELSE 'FAIL' END AS status,
  CAST(observed AS DOUBLE) AS observed, CAST(lim AS DOUBLE) AS limit_value FROM r""")
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, NULLs and duplicate keys of several tables as one report."""
    rated = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return run_suite("raw", {
        "lineitem": (
            table(spark, sf_dir, "lineitem"),
            [RowCount(), NoNulls(("l_orderkey", "l_shipdate")), Unique(("l_orderkey", "l_linenumber"))],
        ),
        "orders": (table(spark, sf_dir, "orders"), [RowCount(), Unique(("o_orderkey",))]),
        "region": (table(spark, sf_dir, "region"), [RowCount(8)]),
        "rated": (rated, [NoNulls(("quality",))]),
        "conversations": (table(spark, sf_dir, "conversations"), [Unique(("conv_id", "turn"))]),
    })


@query("q25i_incremental_quality", """
SELECT unnest(['row_count', 'no_nulls', 'no_nulls', 'allowed_values', 'unique_key', 'unique_key']) AS check_name,
  unnest(['*', 'text', 'lang', 'lang', 'doc_id', 'lang,text']) AS target,
  unnest(['PASS', CASE WHEN t = 0 THEN 'PASS' ELSE 'FAIL' END, CASE WHEN l = 0 THEN 'PASS' ELSE 'FAIL' END,
    CASE WHEN o = 0 THEN 'PASS' ELSE 'FAIL' END, CASE WHEN n = ids THEN 'PASS' ELSE 'FAIL' END, CASE WHEN n = texts THEN 'PASS' ELSE 'FAIL' END]) AS status,
  unnest([n, t, l, o, n - ids, n - texts]::DOUBLE[]) AS observed, unnest([1, 0, 0, 0, 0, 0]::DOUBLE[]) AS limit_value
FROM (SELECT count(*) AS n, count(*) FILTER (text IS NULL) AS t, count(*) FILTER (lang IS NULL) AS l,
    count(*) FILTER (lang NOT IN ('de', 'en')) AS o, count(DISTINCT doc_id) AS ids, count(DISTINCT (lang, text)) AS texts FROM documents)""")
def incremental_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report on all documents, measured in three loads of days, one of which comes again; copies of texts lie on many days."""
    documents = table(spark, sf_dir, "documents").withColumn("day", publication_date(F.col("doc_id")))
    folder = shared_folder(spark, "quality")
    state = QualityState(
        Database(spark, f"quality_{folder.rsplit('-', 1)[1]}", folder), "documents",
        [RowCount(), NoNulls(("text", "lang")), Allowed("lang", ("de", "en")), Unique(("doc_id",)), Unique(("lang", "text"))],
        "day", lambda days: documents.where(F.col("day").isin(days)),
    )
    day = F.dayofmonth("day")
    for part in (day <= 20, day > 20, day == 5):
        state.load(documents.where(part))
    return state.report()


@query("q25s_layer_suites", "WITH" + RATINGS_SQL + "," + REPLY_KEYS_SQL + """,
engaged AS (SELECT source, lang, count(*) AS review_count FROM documents GROUP BY 1, 2),
facts AS (
  SELECT 'silver' AS suite, 'recommendation_trends' AS table_name, unnest([('row_count', '*', count(*), 1),
    ('unique_key', 'symbol,period', count(*) - count(DISTINCT (symbol, period)), 0)]) AS x FROM ratings
  UNION ALL
  SELECT 'silver', 'news', unnest([('row_count', '*', count(*), 1), ('unique_key', 'id', count(*) - count(DISTINCT doc_id), 0)]) FROM documents
  UNION ALL
  SELECT 'gold', 'analyst_sentiment', unnest([('row_count', '*', count(*), 8),
    ('no_nulls', 'mean_recommendation_score', count(*) FILTER (r1 + r2 + r3 + r4 + r5 = 0), 0),
    ('no_nulls', 'news_count', count(*) FILTER (period IS NULL), 0)]) FROM ratings
  UNION ALL
  SELECT 'gold', 'show_engagement', unnest([('row_count', '*', count(*), 1),
    ('no_nulls', 'review_count', count(*) FILTER (review_count IS NULL), 0)]) FROM engaged
  UNION ALL
  SELECT 'predictions', 'predictions', unnest([('row_count', '*', count(*), 1), ('no_nulls', 'symbol', count(*) - count(symbol), 0),
    ('no_nulls', 'prediction_date', count(*) - count(prediction_date), 0), ('no_nulls', 'source', count(*) - count(source), 0),
    ('no_nulls', 'variant', count(*) - count(variant), 0), ('no_nulls', 'call', count(*) - count(call), 0),
    ('allowed_values', 'call', count(*) FILTER (call NOT IN ('rise', 'hold', 'fall')), 0)]) FROM predictions)
SELECT suite, table_name, x[1] AS check_name, x[2] AS target,
  CASE WHEN x[3] = x[4] OR x[1] = 'row_count' AND x[3] > x[4] THEN 'PASS' ELSE 'FAIL' END AS status,
  CAST(x[3] AS DOUBLE) AS observed, CAST(x[4] AS DOUBLE) AS limit_value
FROM facts""")
def layer_suites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suites the job runs, on tables in the shape of its own."""
    predictions, _ = prediction_log(spark, sf_dir)
    tables = {
        "silver": {
            "recommendation_trends": nation_ratings(spark, sf_dir),
            "news": table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id")),
        },
        "gold": {"analyst_sentiment": weighted_sentiment(spark, sf_dir), "show_engagement": source_engagement(spark, sf_dir)},
        "predictions": {"predictions": predictions},
    }
    rules = {"silver": SILVER, "gold": GOLD, "predictions": PREDICTIONS}
    suites = [
        run_suite(layer, {name: (df, rules[layer][name]) for name, df in found.items()}) for layer, found in tables.items()
    ]
    return reduce(DataFrame.unionByName, suites)


@query("q25d_duplicate_keys", """
WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys, CAST(sum(n - 1) AS BIGINT) AS n_duplicates FROM k""")
def duplicate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, keys and surplus rows of the order lines."""
    return duplicate_rows(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("q26_allowed_values", """
SELECT 'values' AS suite, 'orders' AS table_name, 'allowed_values' AS check_name, 'o_orderpriority' AS target,
  'PASS' AS status, 0.0::DOUBLE AS observed, 0.0::DOUBLE AS limit_value
FROM orders HAVING count(*) FILTER (o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')) = 0
UNION ALL
SELECT 'values', 'events', 'allowed_values', 'event_type', 'FAIL', CAST(count(*) AS DOUBLE), 0.0::DOUBLE
FROM events WHERE event_type NOT IN ('click', 'purchase', 'signup', 'view')
UNION ALL
SELECT 'values', 'documents', 'allowed_values', 'reviewed', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END, n, 0.0::DOUBLE
FROM (SELECT CAST(count(*) FILTER (CASE WHEN quality IS NOT NULL THEN 'yes' END <> 'yes') AS DOUBLE) AS n
      FROM documents LEFT JOIN labels USING (doc_id))""")
def allowed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values inside and outside their lists; a column of NULLs and one value breaks no list."""
    unlabelled = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left").select(
        F.when(F.col("quality").isNotNull(), F.lit("yes")).alias("reviewed")
    )
    return run_suite("values", {
        "orders": (table(spark, sf_dir, "orders"), [Allowed("o_orderpriority", PRIORITIES)]),
        "events": (table(spark, sf_dir, "events"), [Allowed("event_type", ("click", "purchase", "signup", "view"))]),
        "documents": (unlabelled, [Allowed("reviewed", ("yes",))]),
    })


@query("q27_skip_rate", "WITH" + REPLY_KEYS_SQL + """,
t AS (
  SELECT '2024-01-31' AS today, CAST(unreadable AS INT) AS skipped FROM asked WHERE prediction_date >= DATE '2024-01-31' - 7
  UNION ALL SELECT '2025-01-31', CAST(unreadable AS INT) FROM asked WHERE prediction_date >= DATE '2025-01-31' - 7),
per_day AS (
  SELECT today, CAST(coalesce(sum(skipped), 0) AS BIGINT) AS skips, count(skipped) AS total
  FROM (VALUES ('2024-01-31'), ('2025-01-31')) v(today) LEFT JOIN t USING (today) GROUP BY 1)
SELECT today, skips, total, CASE WHEN total > 0 THEN skips / total END AS rate,
  CASE WHEN total = 0 THEN 'SKIP' WHEN skips / total < 0.2 THEN 'PASS' ELSE 'FAIL' END AS status
FROM per_day""")
def recent_skip_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of skipped calls in the week before two days, one of them after the last call."""
    predictions, skips = prediction_log(spark, sf_dir)

    def on(today: str) -> DataFrame:
        return skip_rate(predictions, skips, F.lit(today).cast("date")).select(F.lit(today).alias("today"), "*")

    return on("2024-01-31").unionByName(on("2025-01-31"))


@query("q28_call_collapse", "WITH" + REPLY_KEYS_SQL + """,
counted AS (
  SELECT variant, call, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY variant) AS BIGINT) AS total
  FROM predictions WHERE source = 'live' AND prediction_date >= DATE '2024-01-31' - 14 GROUP BY 1, 2)
SELECT variant, call AS top_call, n, total, n / total AS share,
  CASE WHEN total < 20 THEN 'SKIP' WHEN n / total > 0.9 THEN 'FAIL' ELSE 'PASS' END AS status
FROM (SELECT *, row_number() OVER (PARTITION BY variant ORDER BY n DESC, call) AS rn FROM counted) WHERE rn = 1""")
def collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent live call of each variant in the last two weeks."""
    return call_collapse(prediction_log(spark, sf_dir)[0], F.lit("2024-01-31").cast("date"))


@query("q28p_prediction_suite", "WITH" + REPLY_KEYS_SQL + """,
facts AS (
  SELECT CAST(count(*) AS DOUBLE) AS n, CAST(count(*) - count(symbol) AS DOUBLE) AS s, CAST(count(*) - count(prediction_date) AS DOUBLE) AS d,
    CAST(count(*) - count(source) AS DOUBLE) AS o, CAST(count(*) - count(variant) AS DOUBLE) AS v, CAST(count(*) - count(call) AS DOUBLE) AS c,
    CAST(count(*) FILTER (call NOT IN ('rise', 'hold')) AS DOUBLE) AS odd,
    CAST(count(*) - count(DISTINCT (symbol, source, variant)) AS DOUBLE) AS twice
  FROM predictions),
checked AS (
  SELECT unnest([('row_count', '*', n, 1.0::DOUBLE), ('no_nulls', 'symbol', s, 0.0), ('no_nulls', 'prediction_date', d, 0.0), ('no_nulls', 'source', o, 0.0),
    ('no_nulls', 'variant', v, 0.0), ('no_nulls', 'call', c, 0.0), ('allowed_values', 'call', odd, 0.0),
    ('unique_key', 'symbol,source,variant', twice, 0.0)]) AS x FROM facts)
SELECT 'predictions' AS suite, 'predictions' AS table_name, x[1] AS check_name, x[2] AS target,
  CASE WHEN x[3] = x[4] OR x[1] = 'row_count' AND x[3] > x[4] THEN 'PASS' ELSE 'FAIL' END AS status,
  x[3] AS observed, x[4] AS limit_value
FROM checked""")
def prediction_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules over a prediction log, two of them too strict for it: one call not allowed, the day not in the key."""
    predictions, _ = prediction_log(spark, sf_dir)
    filled = ("symbol", "prediction_date", "source", "variant", "call")
    return run_suite("predictions", {
        "predictions": (predictions, [
            RowCount(), NoNulls(filled), Allowed("call", CALLS[:2]), Unique(("symbol", "source", "variant")),
        ])
    })
