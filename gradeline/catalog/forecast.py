"""Popularity, cutoffs, signals, prompts, answers and their grades."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeline.catalog.fixtures import (
    INGESTED_AT, POPULARITY_SQL, REPLY_KEYS_SQL, history, moment, popularity, prediction_log, symbols, table,
)
from gradeline.catalog.measures import RATINGS_SQL, nation_ratings
from gradeline.catalog.registry import query
from gradeline.functions.replies import parse_reply
from gradeline.functions.scores import HORIZON_DAYS
from gradeline.operators.asof import latest_as_of
from gradeline.operators.percentiles import percentile_table
from gradeline.operators.sketches import StoredSketches, percentiles, rank_error
from gradeline.operators.stretches import latest_in_stretches, trailing_in_stretches
from gradeline.operators.topk import top_k
from gradeline.plans import popularity as pop
from gradeline.plans.calls import first_parsed
from gradeline.plans.metrics import analyst_sentiment
from gradeline.plans.scorecard import grade, summarise
from gradeline.session import shared_folder
from gradeline.sources.tables import Database, keep


@query("q19_popularity", "WITH" + POPULARITY_SQL + """
SELECT brand, CAST(d AS VARCHAR) AS d, popularity FROM pop""")
def popularity_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day's chart as a score per brand."""
    return popularity(spark, sf_dir)


@query("q19b_storefront_view", "WITH" + POPULARITY_SQL + """
SELECT CAST(r_regionkey AS VARCHAR) || ':' || c_mktsegment AS brand, CAST(d AS VARCHAR) AS d, popularity FROM (
  SELECT r_regionkey, c_mktsegment, d, CAST(101 - row_number() OVER (PARTITION BY r_regionkey, d ORDER BY total DESC, c_mktsegment) AS DOUBLE) AS popularity
  FROM (SELECT n_regionkey AS r_regionkey, c_mktsegment, CAST(o_orderdate AS DATE) AS d, round(sum(o_totalprice), 2) AS total
        FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2, 3))
WHERE r_regionkey = 1 AND c_mktsegment IN ('BUILDING', 'MACHINERY')""")
def storefront_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A named view: two market segments in one region's daily ranking, the others left out."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    totals = (
        table(spark, sf_dir, "orders").join(customers, "o_custkey").join(nations, "c_nationkey")
        .groupBy(F.col("n_regionkey").cast("string").alias("_storefront"), F.col("c_mktsegment").alias("name"),
                 F.to_date("o_orderdate").alias("snapshot_date"))
        .agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    )
    history = top_k(totals, ["_storefront", "snapshot_date"], [F.col("total").desc(), F.col("name").asc()], 100)
    pop.brand_popularity(history, "1", ("BUILDING", "MACHINERY")).createOrReplaceTempView("brand_popularity")
    return spark.table("brand_popularity").withColumn("brand", F.concat(F.lit("1:"), "brand"))


# A brand's series as a look-up by day; a change is the score a week on less the score of the day.
MOVES_SQL = POPULARITY_SQL + """,
by_day AS (SELECT brand, map_from_entries(list((d, popularity))) AS score FROM pop GROUP BY brand),
deltas AS (
  SELECT brand, d, delta FROM (SELECT brand, d, score[d + 7] - popularity AS delta FROM pop JOIN by_day USING (brand))
  WHERE delta IS NOT NULL),
cut AS (
  SELECT 7 AS horizon_days, t[1] AS fall_below, t[2] AS rise_above, n_deltas, first_d, last_d
  FROM (SELECT quantile_cont(delta, [0.333333, 0.666667]) AS t, count(*) AS n_deltas, min(d) AS first_d, max(d) AS last_d
        FROM deltas))"""


@query("q20_cutoffs", "WITH" + MOVES_SQL + """
SELECT horizon_days, round(fall_below, 9) AS fall_below, round(rise_above, 9) AS rise_above, n_deltas,
  CAST(first_d AS VARCHAR) AS first_d, CAST(last_d AS VARCHAR) AS last_d,
  '2024-02-01 07:00:00.000000' AS frozen_at FROM cut""")
def cutoff_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The terciles, written once: the second attempt, with another horizon, keeps the first row."""
    folder = shared_folder(spark, "cutoffs")
    db = Database(spark, f"cutoffs_{folder.rsplit('-', 1)[1]}", folder)
    series = popularity(spark, sf_dir)
    db.freeze("cutoffs", lambda: pop.cutoffs(series, moment(INGESTED_AT)))
    return db.freeze("cutoffs", lambda: pop.cutoffs(series, moment(INGESTED_AT), 3)).withColumns(
        {"fall_below": F.round("fall_below", 9), "rise_above": F.round("rise_above", 9)}
    )


@query("q20p_percentiles", """
SELECT p, round(v, 6) AS percentile FROM (
  SELECT unnest([0.0, 0.333333, 0.5, 0.666667, 0.99, 1.0]::DOUBLE[]) AS p,
    unnest(quantile_cont(l_extendedprice, [0.0, 0.333333, 0.5, 0.666667, 0.99, 1.0])) AS v FROM lineitem)""")
def price_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of line prices, which have nearly as many distinct values as there are lines."""
    probabilities = (0.0, *pop.TERCILES, 0.5, 0.99, 1.0)
    found = percentile_table(table(spark, sf_dir, "lineitem"), "l_extendedprice", probabilities)
    return found.select("p", F.round("percentile", 6).alias("percentile"))


@query("q20k_sketched_percentiles", """
WITH lines AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, l_extendedprice AS price FROM lineitem),
ranges AS (SELECT DISTINCT month AS last, CAST(month - INTERVAL 11 MONTH AS DATE) AS first FROM lines)
SELECT CAST(last AS VARCHAR) AS last, p, count(*) AS n, min(price) AS lowest, max(price) AS highest, TRUE AS within
FROM ranges JOIN lines ON month BETWEEN first AND last CROSS JOIN (SELECT unnest([0.333333, 0.5, 0.666667, 0.99]::DOUBLE[]) AS p)
GROUP BY ALL""")
def sketched_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of line prices over the twelve months up to every month, out of sketches by month that are loaded in two turns.

    ``within``: the rank of the answer, counted over all lines, is no farther from p than double the error stated for 99 of 100.
    """
    probabilities = (*pop.TERCILES, 0.5, 0.99)
    lines = table(spark, sf_dir, "lineitem").select(
        F.trunc("l_shipdate", "month").alias("month"), F.col("l_extendedprice").cast("double").alias("price")
    )
    folder = shared_folder(spark, "sketches")
    db = Database(spark, f"sketches_{folder.rsplit('-', 1)[1]}", folder)
    stored = StoredSketches(db, "prices", "month", "price")
    half = F.lit("1995-06-01").cast("date")
    stored.load(lines.where(F.col("month") <= half))
    stored.load(lines.where(F.col("month") >= half))  # one month comes again
    ranges = stored.table().select(F.col("month").alias("last"), F.add_months("month", -11).alias("first"))
    asked = F.array(*[F.lit(p) for p in probabilities])
    found = keep(
        stored.over(ranges, "first", "last").select(
            "first", "last", "n", percentiles("sketch", (0, 1)).alias("ends"),
            F.inline(F.arrays_zip(asked.alias("p"), percentiles("sketch", probabilities).alias("answer"))),
        ),
        "answers",
    )
    # Every line meets the answers of the twelve ranges that hold its month; counts are combined before the shuffle.
    met = lines.select("price", F.explode(F.sequence("month", F.add_months("month", 11), F.expr("INTERVAL 1 MONTH"))).alias("last"))
    ranks = met.join(found.select("last", "p", "answer"), "last").groupBy("last", "p").agg(
        (F.count_if(F.col("price") < F.col("answer")) / F.count("price")).alias("below"),
        (F.count_if(F.col("price") <= F.col("answer")) / F.count("price")).alias("up_to"),
    )
    off = 2 * rank_error()
    within = (F.col("below") <= F.col("p") + off) & (F.col("up_to") >= F.col("p") - off)
    return found.join(ranks, ["last", "p"]).select(
        "last", "p", "n", F.col("ends")[0].alias("lowest"), F.col("ends")[1].alias("highest"), within.alias("within")
    )


@query("q20b_offset_join", "WITH" + MOVES_SQL + """
SELECT brand, CAST(d AS VARCHAR) AS d, popularity AS pop_then, score[d + 7] AS pop_future,
  score[d + 7] - popularity AS delta, popularity - score[d - 7] AS prior_delta
FROM pop JOIN by_day USING (brand)""")
def offset_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Popularity a week later and a week before, by calendar day and not by row."""
    return pop.moves(popularity(spark, sf_dir)).where(F.col("pop_then").isNotNull())


@query("q21_signals_topk", "WITH" + POPULARITY_SQL + """,
requests AS (SELECT DISTINCT brand, days.d AS as_of FROM pop CROSS JOIN (SELECT DISTINCT d FROM pop) days),
recent AS (
  SELECT r.brand, as_of, p.d, p.popularity, row_number() OVER (PARTITION BY r.brand, as_of ORDER BY p.d DESC) AS rn
  FROM requests r JOIN pop p ON p.brand = r.brand AND p.d <= as_of)
SELECT r.brand, CAST(r.as_of AS VARCHAR) AS as_of, count(rn) AS n,
  string_agg(d || '=' || CAST(popularity AS INT), ',' ORDER BY d) AS recent
FROM requests r LEFT JOIN recent x ON x.brand = r.brand AND x.as_of = r.as_of AND rn <= 7
GROUP BY 1, 2""")
def recent_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest seven snapshots on or before every day, for every brand, oldest first."""
    series = popularity(spark, sf_dir)
    days = series.agg(F.array_sort(F.collect_set("d"))).scalar()
    requests = series.select("brand").distinct().select("brand", F.explode(days).alias("as_of"))
    found = pop.recent_popularity(requests, series)
    text = F.transform(
        "recent", lambda r: F.concat_ws("=", r["d"].cast("string"), r["popularity"].cast("int").cast("string"))
    )
    joined = F.when(F.size("recent") > 0, F.array_join(text, ","))
    return found.select("brand", "as_of", F.size("recent").cast("bigint").alias("n"), joined.alias("recent"))


@query("q21a_latest_asof", """
WITH requests AS (SELECT DISTINCT o_custkey, date_trunc('month', o_orderdate) AS as_of FROM orders),
found AS (
  SELECT r.o_custkey, r.as_of, o.o_orderkey, o.o_totalprice, o.o_orderdate,
    row_number() OVER (PARTITION BY r.o_custkey, r.as_of ORDER BY o.o_orderdate DESC, o.o_orderkey DESC) AS rn
  FROM requests r LEFT JOIN orders o ON o.o_custkey = r.o_custkey AND o.o_orderdate <= r.as_of)
SELECT o_custkey, CAST(CAST(as_of AS DATE) AS VARCHAR) AS as_of, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate,
  o_orderkey, o_totalprice
FROM found WHERE rn = 1""")
def latest_order_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's last order as of the first day of every month they order in."""
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_orderkey", "o_totalprice"
    )
    requests = orders.select("o_custkey", F.trunc("o_orderdate", "MM").alias("as_of"))
    return latest_as_of(requests, orders, "o_custkey", "as_of", "o_orderdate", ["o_orderkey", "o_totalprice"], ["o_orderkey"])


# Customers with even numbers share one account, so half of all events belong to it.
ACCOUNTS_SQL = """
accounts AS (SELECT CASE WHEN user_id % 2 = 0 THEN 0 ELSE user_id END AS account, ts, event_id, event_type, value FROM events),
requests AS (SELECT DISTINCT account, ts FROM accounts WHERE event_type = 'error'),
facts AS (SELECT account, ts, max(event_id) AS event_id FROM accounts WHERE event_type = 'purchase' GROUP BY 1, 2)"""


def account_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(requests, facts) of accounts, at the microsecond: errors and purchases."""
    account = F.when(F.col("user_id") % 2 == 0, 0).otherwise(F.col("user_id"))
    events = table(spark, sf_dir, "events").select(account.alias("account"), "ts", "event_id", "event_type")
    bought = F.col("event_type") == "purchase"
    return (
        events.where(F.col("event_type") == "error").select("account", "ts"),
        events.where(bought).select("account", F.col("ts").alias("bought_at"), "event_id"),
    )


@query("q21s_stretched_asof", "WITH" + ACCOUNTS_SQL + """
SELECT r.account, strftime(r.ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, strftime(f.ts, '%Y-%m-%d %H:%M:%S.%f') AS bought_at, f.event_id
FROM requests r ASOF LEFT JOIN facts f ON r.account = f.account AND r.ts >= f.ts""")
def latest_purchase_at_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last purchase of an account at the moment of each of its errors; one account has half of all rows."""
    requests, facts = account_events(spark, sf_dir)
    return latest_in_stretches(requests, facts, "account", "ts", "bought_at", ["event_id"], ["event_id"])


@query("q21t_stretched_trailing", "WITH" + ACCOUNTS_SQL + """,
numbered AS (SELECT *, row_number() OVER (PARTITION BY account ORDER BY ts) AS seq FROM facts),
newest AS (SELECT r.account, r.ts, seq FROM requests r ASOF LEFT JOIN numbered f ON r.account = f.account AND r.ts >= f.ts)
SELECT n.account, strftime(n.ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, string_agg(f.event_id, ',' ORDER BY f.seq) AS event_ids
FROM newest n LEFT JOIN numbered f ON f.account = n.account AND f.seq BETWEEN n.seq - 4 AND n.seq
GROUP BY n.account, n.ts""")
def trailing_purchases_at_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last five purchases of an account at each of its errors, oldest first."""
    requests, facts = account_events(spark, sf_dir)
    # One purchase per account and moment, that of the largest number.
    facts = facts.groupBy("account", "bought_at").agg(F.max("event_id").alias("event_id"))
    found = trailing_in_stretches(requests, facts, "account", "ts", "bought_at", ["event_id"], 5, "recent")
    ids = F.transform("recent", lambda f: f["event_id"].cast("string"))
    return found.select("account", "ts", F.when(F.size(ids) > 0, F.array_join(ids, ",")).alias("event_ids"))


@query("q21b_scorable", "WITH" + MOVES_SQL + """
SELECT brand, CAST(d AS VARCHAR) AS d FROM deltas WHERE d BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""")
def scorable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days in a range on which a call can be graded a week later."""
    return pop.scorable_dates(
        popularity(spark, sf_dir), HORIZON_DAYS, F.lit("2024-01-05").cast("date"), F.lit("2024-01-20").cast("date")
    )


@query("q21c_signal_pack", "WITH" + RATINGS_SQL + """,
yearly AS (
  SELECT c_nationkey AS symbol, CAST(year(o_orderdate) AS INT) AS year, min(o_orderdate) AS loaded, round(sum(o_totalprice), 2) AS revenue
  FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2),
requests AS (SELECT DISTINCT c_nationkey AS symbol, last_day(CAST(o_orderdate AS DATE)) AS as_of
  FROM orders JOIN customer ON c_custkey = o_custkey),
sentiment AS (
  SELECT r.symbol, as_of, period, (r1 + 2 * r2 + 3 * r3 + 4 * r4 + 5 * r5) / (r1 + r2 + r3 + r4 + r5) AS score,
    row_number() OVER (PARTITION BY r.symbol, as_of ORDER BY period DESC) AS rn
  FROM requests r LEFT JOIN ratings t ON t.symbol = r.symbol AND CAST(period AS DATE) <= as_of),
estimate AS (
  SELECT r.symbol, as_of, year, revenue, row_number() OVER (PARTITION BY r.symbol, as_of ORDER BY year DESC) AS rn
  FROM requests r LEFT JOIN yearly y ON y.symbol = r.symbol AND y.loaded < as_of + 1)
SELECT s.symbol, CAST(s.as_of AS VARCHAR) AS as_of, period, round(score, 9) AS score, year, revenue
FROM sentiment s JOIN estimate e ON e.symbol = s.symbol AND e.as_of = s.as_of WHERE s.rn = 1 AND e.rn = 1""")
def signal_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings and estimate known at the end of every month, per nation."""
    no_counts = nation_ratings(spark, sf_dir).select("symbol", "period", F.lit(0).alias("news_count"))
    sentiment = analyst_sentiment(nation_ratings(spark, sf_dir), no_counts, ratings=[f"r{i}" for i in range(1, 6)])
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("symbol"))
    orders = table(spark, sf_dir, "orders").join(customers, "o_custkey")
    estimates = orders.groupBy("symbol", F.year("o_orderdate").alias("date")).agg(
        F.min("o_orderdate").alias("_ingested_at"), F.round(F.sum("o_totalprice"), 2).alias("revenue")
    )
    requests = orders.select("symbol", F.last_day(F.to_date("o_orderdate")).alias("as_of"))
    both = pop.latest_sentiment(requests, sentiment).join(pop.latest_estimate(requests, estimates), ["symbol", "as_of"])
    return both.select(
        "symbol", "as_of", "sentiment.period", F.round("sentiment.mean_recommendation_score", 9).alias("score"),
        F.col("estimates.date").alias("year"), "estimates.revenue",
    )


# A move is a place in (fall, hold, rise): the middle, one up beyond the upper cutoff, one down below the lower.
SCORECARD_SQL = REPLY_KEYS_SQL + MOVES_SQL.removeprefix(POPULARITY_SQL) + """,
windows AS (
  SELECT predictions.*, score[prediction_date] AS pop_then, score[prediction_date + 7] AS pop_future,
    score[prediction_date - 7] AS pop_before
  FROM predictions LEFT JOIN by_day USING (brand)),
card AS (
  SELECT symbol, brand, prediction_date, source, variant, call, pop_then, pop_future, pop_future - pop_then AS delta,
    ['fall', 'hold', 'rise'][2 + CAST(pop_future - pop_then > high AS INT) - CAST(pop_future - pop_then < low AS INT)] AS actual_move,
    ['fall', 'hold', 'rise'][2 + CAST(pop_then - pop_before > high AS INT) - CAST(pop_then - pop_before < low AS INT)] AS prior_move,
    CAST(call = actual_move AS INT) AS hit
  FROM windows, (SELECT fall_below AS low, rise_above AS high FROM cut))"""


def scorecard(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(scorecard, skips)"""
    ranked = history(spark, sf_dir)
    predictions, skips = prediction_log(spark, sf_dir, ranked)
    series = popularity(spark, sf_dir, ranked)
    card = grade(predictions, symbols(spark, sf_dir), series, pop.cutoffs(series, moment(INGESTED_AT)))
    return card, skips


@query("q22_scorecard", "WITH" + SCORECARD_SQL + """
SELECT symbol, brand, CAST(prediction_date AS VARCHAR) AS prediction_date, source, variant, call, pop_then, pop_future,
  delta, actual_move, prior_move, hit FROM card""")
def scorecard_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every call beside what happened."""
    return scorecard(spark, sf_dir)[0]


def _tally(model: str, hit: str, given: str) -> str:
    """One entry of a source's list of models: how many rows count, and how many of them hit."""
    return f"{{'model': '{model}', 'n': count(*) FILTER ({given}), 'hits': count(*) FILTER ({given} AND {hit})}}"


_AGENTS = ("rag", "no_rag", "no_rag_big")
_DRAWN = "['rise', 'hold', 'fall'][1 + ('0x' || left(md5(brand || '|' || prediction_date), 8))::BIGINT % 3]"
_BASELINES = {
    "always_hold": ("actual_move = 'hold'", "actual_move IS NOT NULL"),
    "always_rise": ("actual_move = 'rise'", "actual_move IS NOT NULL"),
    "persistence": ("actual_move = prior_move", "actual_move IS NOT NULL AND prior_move IS NOT NULL"),
    "random": (f"actual_move = {_DRAWN}", "actual_move IS NOT NULL"),
}
_AGENT_LIST = ", ".join(_tally(f"agent_{v}", "hit = 1", f"hit IS NOT NULL AND variant = '{v}'") for v in _AGENTS)
_BASELINE_LIST = ", ".join(_tally(model, hit, given) for model, (hit, given) in _BASELINES.items())

# A list of tallies per source, agents over calls and baselines over brand-days, is unnested into models.
# The interval in counts: middle (hits + z2 / 2) / (n + z2), half width z * sqrt(hits * misses / n + z2 / 4) / (n + z2).
TALLIES_SQL = SCORECARD_SQL + f""",
brand_days AS (
  SELECT source, brand, prediction_date, any_value(actual_move) AS actual_move, any_value(prior_move) AS prior_move
  FROM card GROUP BY ALL),
tallies AS (
  SELECT source, unnest(list_concat(agents, baselines), recursive := true)
  FROM (SELECT source, [{_AGENT_LIST}] AS agents FROM card GROUP BY source)
  FULL JOIN (SELECT source, [{_BASELINE_LIST}] AS baselines FROM brand_days GROUP BY source) USING (source)),
passed AS (SELECT source, 'agent_' || variant AS model, count(*) AS skipped FROM skips GROUP BY ALL),
bounds AS (
  SELECT source, model, n, hits, nullif(n, 0)::DOUBLE AS trials, 1.96::DOUBLE * 1.96::DOUBLE AS z2,
    1.96::DOUBLE * sqrt(hits * (trials - hits) / trials + z2 / 4) / (trials + z2) AS half,
    (hits + z2 / 2) / (trials + z2) AS middle
  FROM tallies)"""
SUMMARY_SQL = TALLIES_SQL + """
SELECT source, model, n, hits, round(hits / trials, 3) AS hit_rate, round(middle - half, 3) AS wilson_lo,
  round(middle + half, 3) AS wilson_hi, CASE WHEN starts_with(model, 'agent_') THEN coalesce(skipped, 0) END AS skipped
FROM bounds LEFT JOIN passed USING (source, model)"""


@query("q23_scorecard_summary", "WITH" + SUMMARY_SQL)
def scorecard_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both agents and four baselines, live and in backfill, with intervals."""
    return summarise(*scorecard(spark, sf_dir))


@query("q23x_scorecard_hashed", "WITH" + TALLIES_SQL + """
SELECT source, model, n, CASE WHEN model <> 'random' THEN hits END AS hits, TRUE AS hits_in_range FROM tallies""")
def scorecard_hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report with the random baseline drawn by Spark's own hash, as far as SQL can tell: all
    other models, and that the random one hits no more often than it draws."""
    found = summarise(*scorecard(spark, sf_dir), seed="baseline")
    return found.select(
        "source", "model", "n", F.when(F.col("model") != "random", F.col("hits")).alias("hits"),
        F.col("hits").between(0, F.col("n")).alias("hits_in_range"),
    )


@query("q30_parse_replies", """
SELECT event_id,
  CASE WHEN event_id % 8 IN (0, 1, 2, 3) THEN list_extract(['rise', 'hold', 'fall'], CAST(event_id % 3 AS INT) + 1)
       WHEN event_type = 'view' THEN 'hold' END AS call,
  CASE WHEN event_id % 8 = 0 THEN 'high' WHEN event_id % 8 = 1 THEN event_type WHEN event_id % 8 = 2 THEN 'low'
       WHEN event_id % 8 = 3 THEN NULL WHEN event_type = 'view' THEN 'low' END AS confidence,
  CASE WHEN event_id % 8 = 0 THEN 'value ' || event_type WHEN event_id % 8 IN (1, 2) THEN ''
       WHEN event_id % 8 = 3 THEN '{in braces}' WHEN event_type = 'view' THEN 'second try' END AS reasoning
FROM events""")
def parse_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean, upper-case, chatty, nested, quoted, wrong, cut-off and missing replies, then a second try."""
    call = F.element_at(F.array(F.lit("rise"), F.lit("hold"), F.lit("fall")), (F.col("event_id") % 3 + 1).cast("int"))
    kind = F.col("event_type")
    forms = [
        F.concat(F.lit('{"call": "'), call, F.lit('", "confidence": "high", "reasoning": "value '), kind, F.lit('"}')),
        F.concat(F.lit('{"call": " '), F.upper(call), F.lit(' ", "confidence": "'), kind, F.lit('"}')),
        F.concat(F.lit('Sure! Here it is:\n{\n "call": "'), call, F.lit('"\n}\nHope this helps.')),
        F.concat(F.lit('{"signals": {"k": 1}, "call": "'), call, F.lit('", "confidence": null, "reasoning": "{in braces}"}')),
        F.concat(F.lit("{'call': '"), call, F.lit("'}")),
        F.lit('{"call": "buy", "confidence": "high"}'),
        F.concat(F.lit('{"call": "'), call),
        F.lit(None).cast("string"),
    ]
    reply = F.element_at(F.array(*forms), (F.col("event_id") % 8 + 1).cast("int"))
    second = F.when(kind == "view", F.lit('{"call": "hold", "reasoning": "second try"}')).otherwise(F.lit("{}"))
    attempts = table(spark, sf_dir, "events").select(
        "event_id",
        F.inline(F.array(
            F.struct(F.lit(1).alias("attempt"), reply.alias("reply")),
            F.struct(F.lit(2).alias("attempt"), second.alias("reply")),
        )),
    )
    return first_parsed(attempts, ["event_id"]).select("event_id", "parsed.call", "parsed.confidence", "parsed.reasoning")


@query("q30b_parse_texts", """
SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN ['rise', 'hold', 'fall'][1 + doc_id % 3] END AS call FROM documents""")
def parse_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long texts, every other one with an answer at its end: those without one yield no call."""
    call = F.element_at(F.array(F.lit("rise"), F.lit("hold"), F.lit("fall")), (F.col("doc_id") % 3 + 1).cast("int"))
    answer = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit('\n{"call": "'), call, F.lit('"}'))).otherwise(F.lit(""))
    return table(spark, sf_dir, "documents").select("doc_id", parse_reply(F.concat("text", answer))["call"].alias("call"))
