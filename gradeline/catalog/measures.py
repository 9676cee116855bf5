"""Sentiment, growth, engagement, intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeline.catalog.fixtures import table
from gradeline.catalog.registry import query
from gradeline.functions.dates import month_key
from gradeline.functions.scores import wilson_bounds
from gradeline.operators.latest import latest_per_key
from gradeline.plans.metrics import analyst_sentiment, engagement, growth_by_row, monthly_counts

RATINGS = [f"r{i}" for i in range(1, 6)]


def nation_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the nation key of their customer."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return table(spark, sf_dir, "orders").join(customers, "o_custkey")


def nation_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(symbol, period, r1..r5): orders of a nation and month counted by priority digit."""
    digit = F.substring("o_orderpriority", 1, 1)
    return (
        nation_orders(spark, sf_dir)
        .groupBy(F.col("c_nationkey").alias("symbol"), month_key("o_orderdate").alias("period"))
        .agg(*[F.count_if(digit == str(i)).alias(f"r{i}") for i in range(1, 6)])
    )


RATINGS_SQL = """
ratings AS (
  SELECT c_nationkey AS symbol, strftime(o_orderdate, '%Y-%m-01') AS period,
    count(*) FILTER (o_orderpriority LIKE '1%') AS r1, count(*) FILTER (o_orderpriority LIKE '2%') AS r2,
    count(*) FILTER (o_orderpriority LIKE '3%') AS r3, count(*) FILTER (o_orderpriority LIKE '4%') AS r4,
    count(*) FILTER (o_orderpriority LIKE '5%') AS r5
  FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2)"""


@query("q11_weighted_sentiment", "WITH" + RATINGS_SQL + """,
shipped AS (
  SELECT s_nationkey AS symbol, strftime(l_shipdate, '%Y-%m-01') AS period, count(*) AS news_count
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_returnflag IN ('A', 'R') GROUP BY 1, 2)
SELECT symbol, period, r1, r2, r3, r4, r5,
  (r1 + 2 * r2 + 3 * r3 + 4 * r4 + 5 * r5) / (r1 + r2 + r3 + r4 + r5) AS mean_recommendation_score,
  coalesce(news_count, 0) AS news_count
FROM ratings LEFT JOIN shipped USING (symbol, period)""")
def weighted_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean order priority per nation and month beside the month's shipments from that nation."""
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    lines = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag").isin("A", "R")).select("l_suppkey", "l_shipdate")
    # Shipments per supplier and month first: the join then sees counts, not lines.
    shipped = (
        monthly_counts(lines, "l_suppkey", "l_shipdate", "l_suppkey", "n")
        .join(suppliers, "l_suppkey")
        .groupBy(F.col("s_nationkey").alias("symbol"), "period")
        .agg(F.sum("n").alias("news_count"))
    )
    return analyst_sentiment(nation_ratings(spark, sf_dir), shipped, ratings=RATINGS)


@query("q12_growth_lag", """
WITH yearly AS (
  SELECT c_nationkey AS symbol, CAST(year(o_orderdate) AS INT) AS year, round(sum(o_totalprice), 2) AS revenue, count(*) AS n_orders
  FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2)
SELECT symbol, year, revenue, n_orders,
  round((revenue - lag(revenue) OVER w) / lag(revenue) OVER w * 100, 2) AS revenue_growth_pct,
  round((n_orders - lag(n_orders) OVER w) / lag(n_orders) OVER w * 100, 2) AS orders_growth_pct
FROM yearly WINDOW w AS (PARTITION BY symbol ORDER BY year)""")
def growth_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly growth of order value and number per nation."""
    yearly = (
        nation_orders(spark, sf_dir)
        .groupBy(F.col("c_nationkey").alias("symbol"), F.year("o_orderdate").alias("year"))
        .agg(F.round(F.sum("o_totalprice"), 2).alias("revenue"), F.count(F.lit(1)).alias("n_orders"))
    )
    return growth_by_row(yearly, "symbol", "year", {"revenue": "revenue_growth_pct", "n_orders": "orders_growth_pct"})


@query("q14_wilson", """
WITH g AS (
  SELECT n_name, count(o_orderkey) AS n, count(*) FILTER (o_orderstatus = 'F') AS hits
  FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1)
SELECT n_name, n, hits, round(hits / n, 6) AS hit_rate,
  round((hits / n + 1.96::DOUBLE * 1.96 / (2 * n)
    - 1.96::DOUBLE * sqrt(hits / n * (1 - hits / n) / n + 1.96::DOUBLE * 1.96 / (4.0::DOUBLE * n * n)))
    / (1 + 1.96::DOUBLE * 1.96 / n), 6) AS wilson_lo,
  round((hits / n + 1.96::DOUBLE * 1.96 / (2 * n)
    + 1.96::DOUBLE * sqrt(hits / n * (1 - hits / n) / n + 1.96::DOUBLE * 1.96 / (4.0::DOUBLE * n * n)))
    / (1 + 1.96::DOUBLE * 1.96 / n), 6) AS wilson_hi
FROM g""")
def wilson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of finished orders per nation with its 95% interval."""
    per_nation = (
        nation_orders(spark, sf_dir)
        .groupBy("c_nationkey")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("hits"))
    )
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    low, high = wilson_bounds("hits", "n")
    return nations.join(per_nation, "c_nationkey", "left").fillna(0, ["n", "hits"]).select(
        "n_name", "n", "hits", F.round(F.try_divide("hits", "n"), 6).alias("hit_rate"),
        F.round(low, 6).alias("wilson_lo"), F.round(high, 6).alias("wilson_hi"),
    )


@query("q15_engagement", """
WITH counted AS (
  SELECT source, count(*) AS review_count, avg(quality) AS avg_rating
  FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1)
SELECT source, review_count, round(avg_rating, 9) AS avg_rating, lang AS platform
FROM counted LEFT JOIN (SELECT DISTINCT source, lang FROM documents) USING (source)""")
def source_engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and mean quality per source, one row per language the source has."""
    rated = table(spark, sf_dir, "documents").select("doc_id", "source").join(
        table(spark, sf_dir, "labels").select("doc_id", F.struct("quality").alias("details")), "doc_id", "left"
    )
    languages = table(spark, sf_dir, "documents").select(F.col("source").alias("listed"), F.col("lang").alias("platform"))
    counted = engagement(rated, languages, "source", "listed", "details.quality")
    return counted.withColumn("avg_rating", F.round("avg_rating", 9))


@query("q15b_enriched_reviews", """
WITH newest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem)
  WHERE rn = 1)
SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate, p_name AS name
FROM newest LEFT JOIN (SELECT DISTINCT p_partkey, p_name FROM part) ON p_partkey = l_partkey""")
def enriched_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest copy of every order line with the name of its part."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.to_date("l_shipdate").alias("l_shipdate")
    )
    newest = latest_per_key(
        lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"], ["l_partkey", "l_suppkey", "l_extendedprice"]
    )
    names = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("name")).distinct()
    return newest.join(names, "l_partkey", "left").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "name")
