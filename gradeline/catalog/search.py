"""Retrieval as of a date, prompts, look-ahead audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeline.catalog.fixtures import (
    INGESTED_AT, QUESTIONS_SQL, history, moment, popularity, publication_date, questions, symbols, table, vectors,
)
from gradeline.catalog.forecast import MOVES_SQL
from gradeline.catalog.registry import query
from gradeline.functions.dates import month_key
from gradeline.operators.cells import CellIndex
from gradeline.operators.diff import snapshot_diff
from gradeline.operators.postings import Postings
from gradeline.plans import popularity as pop
from gradeline.plans.calls import backfill_plan, live_plan, prompt_rows
from gradeline.plans.dated_search import hybrid_top_k_as_of
from gradeline.plans.metrics import analyst_sentiment
from gradeline.plans.retrieval import cosine_top_k, cosine_top_k_as_of, hybrid_top_k, lookahead_audit, retrieved_context
from gradeline.session import shared_folder
from gradeline.sources.tables import keep

AS_OF = "2024-01-20"
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def every_day(spark: SparkSession, sf_dir: str, asked: DataFrame) -> DataFrame:
    """(entity, as_of): every question on every day that published something."""
    days = vectors(spark, sf_dir).agg(F.array_sort(F.collect_set("published_date"))).scalar()
    return asked.select("entity", F.explode(days).alias("as_of"))


@query("q16_topk_cosine_asof", "WITH" + QUESTIONS_SQL + """,
days AS (SELECT DISTINCT published_date AS as_of FROM docs)
SELECT entity, CAST(as_of AS VARCHAR) AS as_of, doc_id, round(score, 6) AS score, CAST(rank AS INT) AS rank FROM (
  SELECT entity, as_of, doc_id, score, row_number() OVER (PARTITION BY entity, as_of ORDER BY score DESC, doc_id) AS rank
  FROM scores JOIN days ON published_date <= as_of)
WHERE rank <= 5""")
def cosine_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors published by each day, for every question and every day at once."""
    asked = questions(spark, sf_dir)
    found = cosine_top_k_as_of(vectors(spark, sf_dir), asked, every_day(spark, sf_dir, asked))
    return found.select("entity", "as_of", "doc_id", F.round("score", 6).alias("score"), "rank")


@query("q16a_topk_cosine", "WITH" + QUESTIONS_SQL + """
SELECT entity, doc_id, round(score, 6) AS score, CAST(rank AS INT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY entity ORDER BY score DESC, doc_id) AS rank FROM scores)
WHERE rank <= 5""")
def cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every question, whatever their date."""
    found = cosine_top_k(vectors(spark, sf_dir), questions(spark, sf_dir))
    return found.select("entity", "doc_id", F.round("score", 6).alias("score"), "rank")


def worded_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity, query_text, query_vector)"""
    return questions(spark, sf_dir).join(
        table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("int").alias("entity"), F.col("text").alias("query_text")),
        "entity",
    )


def embedded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text_content, embedding, published_date); either of text and embedding may be missing."""
    embedded = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    return (
        table(spark, sf_dir, "documents")
        .join(embedded, "doc_id", "full_outer")
        .select("doc_id", F.col("text").alias("text_content"), "embedding", publication_date(F.col("doc_id")).alias("published_date"))
    )


@query("q16b_hybrid_topk", "WITH" + QUESTIONS_SQL + r""",
texts AS (
  SELECT doc_id, published_date, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w
  FROM (SELECT doc_id, text, DATE '2024-01-01' + CAST(doc_id % 30 AS INT) AS published_date FROM documents)
  WHERE published_date <= DATE '2024-01-20'),
tf AS (SELECT doc_id, word, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS word FROM texts) GROUP BY 1, 2),
df AS (SELECT word, count(*) AS df FROM tf GROUP BY 1),
corpus AS (SELECT count(*) AS n, avg(len(w)) AS mean FROM texts),
asked AS (
  SELECT DISTINCT entity, word FROM (
    SELECT entity, unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')) AS word
    FROM questions JOIN benchmark ON item_id = entity) WHERE word <> ''),
bm25 AS (
  SELECT entity, doc_id, round(sum(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE
    / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * len(w) / mean))), 9) AS score
  FROM asked JOIN tf USING (word) JOIN df USING (word) JOIN texts USING (doc_id) CROSS JOIN corpus GROUP BY 1, 2),
semantic AS (
  SELECT entity, doc_id, row_number() OVER (PARTITION BY entity ORDER BY score DESC, doc_id) AS semantic_rank
  FROM scores WHERE published_date <= DATE '2024-01-20'),
lexical AS (SELECT entity, doc_id, row_number() OVER (PARTITION BY entity ORDER BY score DESC, doc_id) AS lexical_rank FROM bm25),
fused AS (
  SELECT entity, doc_id, semantic_rank, lexical_rank,
    round(coalesce(1.0::DOUBLE / (60 + semantic_rank), 0) + coalesce(1.0::DOUBLE / (60 + lexical_rank), 0), 9) AS score
  FROM semantic FULL OUTER JOIN lexical USING (entity, doc_id))
SELECT entity, doc_id, CAST(semantic_rank AS INT) AS semantic_rank, CAST(lexical_rank AS INT) AS lexical_rank,
  round(score, 6) AS score, CAST(rank AS INT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY entity ORDER BY score DESC, doc_id) AS rank FROM fused)
WHERE rank <= 5""")
def hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vector and word search over whole documents up to a day, fused by rank."""
    asked, documents = worded_questions(spark, sf_dir), embedded_documents(spark, sf_dir)
    found = hybrid_top_k(documents, asked, F.lit(AS_OF).cast("date"))
    return found.select("entity", "doc_id", "semantic_rank", "lexical_rank", F.round("score", 6).alias("score"), "rank")


PROMPTS_SQL = MOVES_SQL + QUESTIONS_SQL.replace("\nmeans AS", ",\nmeans AS", 1) + """,
users AS (SELECT DISTINCT user_id, 'U' || user_id AS symbol, CAST(user_id AS VARCHAR) AS brand FROM events),
plan AS (
  SELECT user_id, symbol, brand, DATE '2024-01-20' AS as_of, 'live' AS source, variant
  FROM users CROSS JOIN (VALUES ('rag'), ('no_rag')) v(variant)
  UNION ALL
  SELECT user_id, symbol, brand, d, 'backfill', 'no_rag' FROM users JOIN deltas USING (brand)
  WHERE d BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'),
recent AS (
  SELECT brand, as_of, list({'d': CAST(d AS VARCHAR), 'popularity': popularity} ORDER BY d) AS recent FROM (
    SELECT p.brand, r.as_of, p.d, p.popularity, row_number() OVER (PARTITION BY p.brand, r.as_of ORDER BY p.d DESC) AS rn
    FROM (SELECT DISTINCT brand, as_of FROM plan) r JOIN pop p ON p.brand = r.brand AND p.d <= r.as_of)
  WHERE rn <= 7 GROUP BY 1, 2),
months AS (
  SELECT 'U' || user_id AS symbol, strftime(ts, '%Y-%m-01') AS period,
    count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'error') AS error,
    count(*) FILTER (event_type = 'purchase') AS purchase, count(*) FILTER (event_type = 'signup') AS signup,
    count(*) FILTER (event_type = 'view') AS view, count(*) AS news_count
  FROM events GROUP BY 1, 2),
sentiment AS (
  SELECT symbol, as_of, {'symbol': symbol, 'period': period, 'mean_score': round((click + 2 * error + 3 * purchase
    + 4 * signup + 5 * view) / (click + error + purchase + signup + view), 6), 'news_count': news_count} AS sentiment FROM (
    SELECT m.*, as_of, row_number() OVER (PARTITION BY r.symbol, as_of ORDER BY period DESC) AS rn
    FROM (SELECT DISTINCT symbol, as_of FROM plan) r JOIN months m ON m.symbol = r.symbol AND CAST(period AS DATE) <= as_of)
  WHERE rn = 1),
weeks AS (
  SELECT 'U' || user_id AS symbol, CAST(date_trunc('week', ts) AS DATE) AS week, min(ts) AS loaded, count(*) AS n_events
  FROM events GROUP BY 1, 2),
estimates AS (
  SELECT symbol, as_of, {'symbol': symbol, 'date': CAST(week AS VARCHAR), 'n_events': n_events} AS estimates FROM (
    SELECT w.*, as_of, row_number() OVER (PARTITION BY r.symbol, as_of ORDER BY week DESC) AS rn
    FROM (SELECT DISTINCT symbol, as_of FROM plan) r JOIN weeks w ON w.symbol = r.symbol AND loaded < as_of + 1)
  WHERE rn = 1),
hits AS (
  SELECT entity, doc_id, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY entity ORDER BY score DESC, doc_id) AS rank
    FROM scores WHERE published_date <= DATE '2024-01-20')
  WHERE rank <= 5),
context AS (
  SELECT entity, list(CAST(doc_id AS VARCHAR) ORDER BY rank) AS ids,
    string_agg('<<' || doc_id || '>>' || chr(10) || substr(text, 1, 500), chr(10) ORDER BY rank) AS excerpts
  FROM hits JOIN documents USING (doc_id) GROUP BY 1)
SELECT p.symbol, p.brand, CAST(p.as_of AS VARCHAR) AS as_of, source, variant,
  CASE WHEN variant = 'rag' THEN coalesce(array_to_string(ids, ','), '') ELSE '' END AS retrieved,
  concat_ws(chr(10) || chr(10),
    printf('TASK%sToday is %s. Let P be the popularity of %s: 100 for first place in the chart, one less for each place below. '
      'Say what P on %s will be compared with P today.', chr(10), CAST(p.as_of AS VARCHAR), p.brand, CAST(p.as_of + 7 AS VARCHAR)),
    printf('ANSWERS%srise: P gains more than %.2f%sfall: P ends below today''s value plus %.2f%shold: every other case',
      chr(10), rise_above, chr(10), fall_below, chr(10)),
    'EVIDENCE (JSON, oldest day first)' || chr(10)
      || to_json({'brand': p.brand, 'as_of': CAST(p.as_of AS VARCHAR), 'recent': coalesce(recent, []), 'sentiment': sentiment, 'estimates': estimates}),
    CASE WHEN variant = 'rag' THEN 'TEXTS (published by today; name the ones you rely on)' || chr(10) || excerpts END,
    'FORM' || chr(10) || 'Reply with a single JSON object that has three fields. call: one of the answers. '
      || 'confidence: low, medium or high. reasoning: a short remark on what decided it.') AS prompt
FROM plan p CROSS JOIN cut
LEFT JOIN recent r ON r.brand = p.brand AND r.as_of = p.as_of
LEFT JOIN sentiment s ON s.symbol = p.symbol AND s.as_of = p.as_of
LEFT JOIN estimates e ON e.symbol = p.symbol AND e.as_of = p.as_of
LEFT JOIN context c ON c.entity = p.user_id % 10"""


@query("q29_prompt_rows", "WITH" + PROMPTS_SQL)
def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All prompts of one live run and one backfill, with everything known by each call's day."""
    known, series = symbols(spark, sf_dir), popularity(spark, sf_dir, history(spark, sf_dir))

    def day(text: str) -> F.Column:
        return F.lit(text).cast("date")

    # Kept: every kind of signal is looked up for the same planned calls.
    plan = keep(
        live_plan(known, day(AS_OF)).unionByName(backfill_plan(known, series, day("2024-01-05"), day("2024-01-12"))), "plan"
    )
    events = table(spark, sf_dir, "events").withColumn("symbol", F.concat(F.lit("U"), F.col("user_id").cast("string")))
    monthly = events.groupBy("symbol", month_key("ts").alias("period")).agg(
        *[F.count_if(F.col("event_type") == t).alias(t) for t in EVENT_TYPES]
    )
    counts = events.groupBy("symbol", month_key("ts").alias("period")).agg(F.count(F.lit(1)).alias("news_count"))
    sentiment = analyst_sentiment(monthly, counts, ratings=EVENT_TYPES).select(
        "symbol", "period", F.round("mean_recommendation_score", 6).alias("mean_score"), "news_count"
    )
    weekly = events.groupBy("symbol", F.date_trunc("week", "ts").cast("date").alias("date")).agg(
        F.min("ts").alias("_ingested_at"), F.count(F.lit(1)).alias("n_events")
    )
    asked = plan.select("symbol", "brand", "as_of").distinct()
    estimates = pop.latest_estimate(asked, weekly).withColumn(
        "estimates", F.when(F.col("estimates").isNotNull(), F.struct("estimates.symbol", "estimates.date", "estimates.n_events"))
    )
    entity = (F.substring("symbol", 2, 20).cast("bigint") % 10).cast("int")
    requests = known.select(entity.alias("entity"), day(AS_OF).alias("as_of"))
    hits = cosine_top_k_as_of(vectors(spark, sf_dir), questions(spark, sf_dir), requests)
    texts = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("text_content"))
    found = retrieved_context(hits, texts, ["entity", "as_of"]).select(
        "entity", "as_of",
        F.transform("chunks", lambda c: F.struct(c["doc_id"].cast("string").alias("doc_id"), c["text"].alias("text"))).alias("chunks"),
    )
    context = known.select("symbol", entity.alias("entity")).join(found, "entity").select("symbol", "as_of", "chunks")
    rows = prompt_rows(
        plan, pop.recent_popularity(asked, series), pop.latest_sentiment(asked, sentiment), estimates, context,
        pop.cutoffs(series, moment(INGESTED_AT)),
    )
    return rows.select(
        "symbol", "brand", "as_of", "source", "variant", F.array_join("retrieved_doc_ids", ",").alias("retrieved"), "prompt"
    )


@query("q31_lookahead_audit", "WITH" + QUESTIONS_SQL + """,
hits AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY entity ORDER BY score DESC, doc_id) AS rank FROM scores) WHERE rank <= 5),
cited AS (
  SELECT entity, d.published_date AS prediction_date, CASE WHEN day(d.published_date) >= 16 THEN 'live' ELSE 'backfill' END AS source,
    h.published_date > d.published_date AS late
  FROM hits h CROSS JOIN (SELECT DISTINCT published_date FROM docs) d)
SELECT source, count(DISTINCT (entity, prediction_date)) AS calls, count(*) AS docs,
  count(*) FILTER (late) AS late_docs, CAST(0 AS BIGINT) AS unknown_docs,
  count(DISTINCT CASE WHEN late THEN (entity, prediction_date) END) AS calls_affected
FROM cited GROUP BY 1""")
def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often retrieval without a date limit would have shown a call its own future."""
    asked = questions(spark, sf_dir)
    hits = cosine_top_k(vectors(spark, sf_dir), asked)
    ids = hits.groupBy("entity").agg(F.collect_list("doc_id").alias("retrieved_doc_ids"))
    live = F.dayofmonth("as_of") >= 16
    calls = every_day(spark, sf_dir, asked).join(ids, "entity").select(
        F.col("entity").cast("string").alias("symbol"), F.col("as_of").alias("prediction_date"),
        F.when(live, F.lit("live")).otherwise(F.lit("backfill")).alias("source"),
        F.lit("rag").alias("variant"), "retrieved_doc_ids",
    )
    return lookahead_audit(calls, vectors(spark, sf_dir), ["source"])


@query("q16c_cell_index_asof", "WITH" + QUESTIONS_SQL + """,
days AS (SELECT DISTINCT published_date AS as_of FROM docs)
SELECT entity, CAST(as_of AS VARCHAR) AS as_of, doc_id, round(score, 6) AS score, CAST(rank AS INT) AS rank FROM (
  SELECT entity, as_of, doc_id, score, row_number() OVER (PARTITION BY entity, as_of ORDER BY score DESC, doc_id) AS rank
  FROM scores JOIN days ON published_date <= as_of)
WHERE rank <= 5""")
def cell_index_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors published by each day, by a stored index of cells searched until nothing better is left."""
    index = CellIndex(spark, shared_folder(spark, "cell_index"))
    index.build(vectors(spark, sf_dir))
    asked = questions(spark, sf_dir)
    found = index.search(asked, every_day(spark, sf_dir, asked), 5, exact=True).rows
    return found.select("entity", "as_of", "doc_id", F.round("score", 6).alias("score"), "rank")


@query("q18i_index_upkeep", "WITH" + QUESTIONS_SQL + """,
best AS (
  SELECT entity, doc_id, score, row_number() OVER (PARTITION BY entity ORDER BY score DESC, doc_id) AS rank FROM scores)
SELECT entity, doc_id, round(score, 6) AS score, CAST(rank AS INT) AS rank,
  (SELECT count(*) FROM docs) AS entries, CAST(2 AS INT) AS version FROM best WHERE rank <= 5""")
def index_upkeep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors by an index of an earlier version of the table that took over what changed since.

    In the earlier version a seventh of the vectors was missing, an eleventh pointed elsewhere and there were some more.
    """
    new = vectors(spark, sf_dir)
    doc_id = F.col("doc_id")
    altered = F.when(doc_id % 11 == 0, F.reverse("embedding")).otherwise(F.col("embedding"))
    old = new.where(doc_id % 7 != 0).withColumn("embedding", altered).unionByName(
        new.where(doc_id % 13 == 0).withColumn("doc_id", (-1 - doc_id).cast(new.schema["doc_id"].dataType))
    )
    index = CellIndex(spark, shared_folder(spark, "cell_index"))
    index.build(old, version=1)
    for version in (2, 2):  # the second time there is nothing to do
        index.apply(snapshot_diff(old, new, ["doc_id"], ["published_date", "embedding"]), new, version)
    asked = questions(spark, sf_dir)
    newest = new.agg(F.max("published_date")).scalar()
    found = index.search(asked, asked.select("entity", newest.alias("as_of")), 5, exact=True).rows
    return found.select(
        "entity", "doc_id", F.round("score", 6).alias("score"), "rank",
        index.entries().agg(F.count("*")).scalar().alias("entries"), F.lit(index.version()).alias("version"),
    )


DATED_SQL = QUESTIONS_SQL + r""",
days AS (SELECT DISTINCT published_date AS as_of FROM docs),
texts AS (
  SELECT doc_id, published_date, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w
  FROM (SELECT doc_id, text, DATE '2024-01-01' + CAST(doc_id % 30 AS INT) AS published_date FROM documents)
  WHERE text IS NOT NULL),
tf AS (SELECT doc_id, word, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS word FROM texts) GROUP BY 1, 2),
asked AS (
  SELECT DISTINCT entity, word FROM (
    SELECT entity, unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')) AS word
    FROM questions JOIN benchmark ON item_id = entity) WHERE word <> ''),
matched AS (SELECT word, doc_id, tf, len(w) AS size, published_date FROM tf SEMI JOIN asked USING (word) JOIN texts USING (doc_id)),
df AS (SELECT word, as_of, count(*) AS df FROM matched JOIN days ON published_date <= as_of GROUP BY 1, 2),
corpus AS (SELECT as_of, count(*) AS n, avg(len(w)) AS mean FROM texts JOIN days ON published_date <= as_of GROUP BY 1),
bm25 AS (
  SELECT entity, as_of, doc_id, round(sum(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE
    / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * size / mean))), 9) AS score
  FROM asked JOIN matched USING (word) JOIN df USING (word) JOIN corpus USING (as_of)
  WHERE published_date <= as_of GROUP BY 1, 2, 3),
semantic AS (
  SELECT entity, as_of, doc_id, row_number() OVER (PARTITION BY entity, as_of ORDER BY score DESC, doc_id) AS semantic_rank
  FROM scores JOIN days ON published_date <= as_of WHERE entity IN (SELECT item_id FROM benchmark)),
lexical AS (
  SELECT entity, as_of, doc_id, row_number() OVER (PARTITION BY entity, as_of ORDER BY score DESC, doc_id) AS lexical_rank FROM bm25),
fused AS (
  SELECT entity, as_of, doc_id, semantic_rank, lexical_rank,
    round(coalesce(1.0::DOUBLE / (60 + semantic_rank), 0) + coalesce(1.0::DOUBLE / (60 + lexical_rank), 0), 9) AS score
  FROM semantic FULL OUTER JOIN lexical USING (entity, as_of, doc_id)),
best AS (SELECT *, row_number() OVER (PARTITION BY entity, as_of ORDER BY score DESC, doc_id) AS rank FROM fused)"""


@query("q16d_hybrid_every_day", "WITH" + DATED_SQL + """
SELECT entity, CAST(as_of AS VARCHAR) AS as_of, doc_id, CAST(semantic_rank AS INT) AS semantic_rank,
  CAST(lexical_rank AS INT) AS lexical_rank, round(score, 6) AS score, CAST(rank AS INT) AS rank FROM best WHERE rank <= 5""")
def hybrid_every_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vector and word search fused by rank, for every question and every day at once; texts are split once, into postings."""
    asked, documents = worded_questions(spark, sf_dir), embedded_documents(spark, sf_dir)
    postings = Postings(spark, shared_folder(spark, "postings"))
    # Straight from their table: texts need not be moved to meet their vectors.
    dated = publication_date(F.col("doc_id")).alias("published_date")
    postings.build(table(spark, sf_dir, "documents").select("doc_id", dated, F.col("text").alias("text_content")))
    found = hybrid_top_k_as_of(documents, postings, asked, every_day(spark, sf_dir, asked))
    return found.select("entity", "as_of", "doc_id", "semantic_rank", "lexical_rank", F.round("score", 6).alias("score"), "rank")


@query("q18p_postings_upkeep", r"""
WITH texts AS (
  SELECT DATE '2024-01-01' + CAST(doc_id % 30 AS INT) AS day,
    list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w
  FROM documents WHERE text IS NOT NULL)
SELECT CAST(day AS VARCHAR) AS day, sum(count(*)) OVER (ORDER BY day) AS n, sum(sum(len(w))) OVER (ORDER BY day) AS n_words,
  CAST(sum(len(list_distinct(w))) AS BIGINT) AS n_postings, CAST(2 AS INT) AS version
FROM texts GROUP BY day""")
def postings_upkeep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts, words and postings by day in an index of an earlier version of the documents that took over what changed since."""
    documents = table(spark, sf_dir, "documents")
    doc_id, day = F.col("doc_id"), publication_date(F.col("doc_id")).alias("published_date")
    new = documents.select("doc_id", day, F.col("text").alias("text_content"))
    altered = F.when(doc_id % 11 == 0, F.concat(F.lit("an earlier text "), "text_content")).otherwise(F.col("text_content"))
    old = new.where(doc_id % 7 != 0).withColumn("text_content", altered).unionByName(
        new.where(doc_id % 13 == 0).withColumn("doc_id", (-1 - doc_id).cast(new.schema["doc_id"].dataType))
    )
    index = Postings(spark, shared_folder(spark, "postings"))
    index.build(old, version=1)
    for version in (2, 2):  # the second time there is nothing to do
        index.apply(snapshot_diff(old, new, ["doc_id"], ["published_date", "text_content"]), new, version)
    held = index.postings()
    counts = held.where("word <> ''").groupBy("published_date").agg(F.count("*").alias("n_postings"))
    corpus = index.corpus(held.select(F.col("published_date").alias("as_of")).distinct())
    return corpus.join(counts, F.col("as_of") == F.col("published_date")).select(
        F.col("as_of").alias("day"), "n", F.round(F.col("n") * F.col("mean")).cast("long").alias("n_words"), "n_postings",
        F.lit(index.version()).alias("version"),
    )
