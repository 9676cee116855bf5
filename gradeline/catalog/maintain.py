"""Tables over time: appends, refreshes, merges, slices, write-once values, change capture."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeline.catalog.fixtures import (
    CHART_SQL, CORPUS_SQL, INGESTED_AT, REPLY_KEYS_SQL, chart, corpus, moment, replies, storefront_chart, table,
)
from gradeline.catalog.registry import query
from gradeline.operators.diff import snapshot_diff, sync_gate
from gradeline.operators.latest import newest_day
from gradeline.operators.merge import add_missing_columns, replace_slice, upsert
from gradeline.plans import daily
from gradeline.plans.calls import answer_rows
from gradeline.plans.popularity import daily_chart
from gradeline.session import shared_folder
from gradeline.sources.schemas import PREDICTION_KEY
from gradeline.sources.tables import Database, GuardedRefresh, append_rows, keep, read_table, replace_partitions

CHANGE_DAY = "1998-01-01"
CHANGE_TIME = "2024-01-20"


@query("q04_append_evolve", """
SELECT o_orderkey, o_custkey, o_totalprice,
  CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderpriority END AS o_orderpriority,
  CAST(NULL AS VARCHAR) AS variant
FROM orders""")
def append_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders appended in two batches, the later one with a column more; old rows read as NULL."""
    path = shared_folder(spark, "orders")
    orders = table(spark, sf_dir, "orders")
    later = F.col("o_orderdate") >= F.lit(CHANGE_DAY).cast("timestamp_ntz")
    append_rows(orders.where(~later).select("o_orderkey", "o_custkey", "o_totalprice"), path)
    append_rows(orders.where(later).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"), path)
    return add_missing_columns(read_table(spark, path), {"variant": "string"})


@query("q04w_schema_widening", """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN floor(o_totalprice) ELSE o_totalprice END AS price,
  CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderpriority END AS o_orderpriority,
  CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN CAST(o_orderdate AS DATE) || ' 00:00:00.000000' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') END AS ordered
FROM orders""")
def schema_widening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders appended with narrow types, then with wider ones, a column more and another name for one of them."""
    orders = table(spark, sf_dir, "orders").withColumn("o_orderpriority", F.col("o_orderpriority").cast("string"))
    later = F.col("o_orderdate") >= F.lit(CHANGE_DAY).cast("timestamp_ntz")
    folder = shared_folder(spark, "widening")
    db = Database(spark, f"widening_{folder.rsplit('-', 1)[1]}", folder)
    db.append("orders", orders.where(~later).select(
        F.col("o_orderkey").cast("int").alias("o_orderkey"), F.col("o_custkey").cast("int").alias("o_custkey"),
        F.floor("o_totalprice").cast("int").alias("o_totalprice"), F.col("o_orderdate").cast("date").alias("ordered"),
    ))
    wide = orders.where(later).select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"), F.col("o_custkey").cast("bigint").alias("o_custkey"),
        F.col("o_totalprice").cast("double").alias("o_totalprice"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("ordered"), "o_orderpriority",
    )
    db.append("orders", wide)
    db.evolve("orders", wide.withColumnRenamed("o_totalprice", "price").schema, {"o_totalprice": "price"})
    return db.table("orders")


@query("q05_guarded_refresh", """
SELECT 'customer' AS table_name, c_custkey AS key, c_acctbal AS balance, 'kept' AS outcome FROM customer
UNION ALL
SELECT 'supplier', s_suppkey, s_acctbal + 100, 'replaced' FROM supplier""")
def guarded_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tables are loaded, then refreshed: one with an empty load, which leaves it as it was."""
    paths: dict[str, str] = {}

    def write(name: str, df: DataFrame) -> None:
        paths[name] = shared_folder(spark, name)
        df.write.parquet(paths[name])

    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance"))
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance"))
    first, second = GuardedRefresh(write), GuardedRefresh(write)
    first.load("customer", customer)
    first.load("supplier", supplier)
    first.finish()
    second.load("customer", customer.where(F.col("key").isNull()))
    second.load("supplier", supplier.withColumn("balance", F.col("balance") + 100))

    def outcome(name: str) -> DataFrame:
        verdict = "kept" if name in second.failed else "replaced"
        return spark.read.parquet(paths[name]).select(F.lit(name).alias("table_name"), "*", F.lit(verdict).alias("outcome"))

    return outcome("customer").unionByName(outcome("supplier"))


@query("q06_upsert", """
SELECT o_orderkey, o_custkey, CASE o_orderstatus WHEN 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
  CASE o_orderstatus WHEN 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
FROM orders
UNION ALL
SELECT o_orderkey + 1000000000, o_custkey, 'O', o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'""")
def upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that closes every pending order and repeats every urgent one under a new key."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    closed = orders.where(F.col("o_orderstatus") == "P").withColumns(
        {"o_orderstatus": F.lit("F"), "o_totalprice": F.col("o_totalprice") + 1}
    )
    urgent = table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    repeated = urgent.select(
        (F.col("o_orderkey") + 1_000_000_000).alias("o_orderkey"), "o_custkey",
        F.lit("O").alias("o_orderstatus"), "o_totalprice",
    )
    return upsert(orders, closed.unionByName(repeated), ["o_orderkey"])


@query("q07_route_and_delete", "WITH" + REPLY_KEYS_SQL + """,
second AS (SELECT *, user_rank > 50 AS unreadable2 FROM (SELECT *, rank AS user_rank FROM asked) WHERE source = 'live')
SELECT 'predictions' AS log, symbol, CAST(prediction_date AS VARCHAR) AS prediction_date, source, variant,
  call, 'medium' AS confidence, 'rank ' || rank AS reasoning
FROM asked WHERE source = 'backfill' AND NOT unreadable
UNION ALL
SELECT 'predictions', symbol, CAST(prediction_date AS VARCHAR), source, variant, 'hold', 'low', ''
FROM second WHERE NOT unreadable2
UNION ALL
SELECT 'skips', symbol, CAST(prediction_date AS VARCHAR), source, variant, NULL, NULL, NULL
FROM asked WHERE source = 'backfill' AND unreadable
UNION ALL
SELECT 'skips', symbol, CAST(prediction_date AS VARCHAR), source, variant, NULL, NULL, NULL
FROM second WHERE unreadable2""")
def route_and_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job's own storing: a first run of all calls, then a second run of the live ones; each key is one answer."""
    key = list(PREDICTION_KEY)
    at = moment(INGESTED_AT).cast("timestamp")
    first = keep(replies(spark, sf_dir), "replies")
    ranked = storefront_chart(spark, sf_dir).select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"),
        F.col("snapshot_date").alias("prediction_date"), F.col("rank").alias("place"),
    )
    readable = F.when(F.col("place") <= 50, F.lit('{"call": "hold"}')).otherwise(F.lit("no idea"))
    second = keep(
        first.where(F.col("source") == "live").join(ranked, ["symbol", "prediction_date"]).withColumn("reply", readable),
        "replies",
    )
    folder = shared_folder(spark, "answers")
    gold = Database(spark, f"answers_{uuid.uuid4().hex}", folder)
    for hour, run in enumerate((first, second)):
        asked = run.select(*key, F.array().cast("array<string>").alias("retrieved_doc_ids"))
        daily.store_answers(gold, answer_rows(asked, run, "model", at + F.make_dt_interval(hours=F.lit(hour))))
    return (
        daily.predictions(gold).select(F.lit("predictions").alias("log"), *key, "call", "confidence", "reasoning")
        .unionByName(daily.skips(gold).select(F.lit("skips").alias("log"), *key), allowMissingColumns=True)
    )


@query("q08_rank_history", "WITH" + CHART_SQL + """,
newest AS (SELECT max(CAST(ts AS DATE)) AS d FROM events),
fresh AS (
  SELECT snapshot_date, user_id, CAST(rank AS INT) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY snapshot_date ORDER BY total DESC, user_id) AS rank
    FROM (SELECT CAST(ts AS DATE) AS snapshot_date, user_id, round(sum(value), 2) AS total FROM events
          WHERE event_type <> 'error' AND CAST(ts AS DATE) = (SELECT d FROM newest) GROUP BY 1, 2))
  WHERE rank <= 100)
SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date, user_id, rank FROM chart
WHERE snapshot_date <> (SELECT d FROM newest)
UNION ALL SELECT CAST(snapshot_date AS VARCHAR), user_id, rank FROM fresh""")
def rank_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History by day; the newest day is computed again without errors and replaces its partition."""
    path = shared_folder(spark, "history")
    day = F.col("ts").cast("date")
    replace_partitions(chart(spark, sf_dir).select("user_id", "rank", "snapshot_date"), path, ["snapshot_date"])
    today = newest_day(table(spark, sf_dir, "events"), "ts", of_moment=True).where(F.col("event_type") != "error")
    fresh = daily_chart(today, day, "user_id", "value").select("user_id", "rank", "snapshot_date")
    for _ in range(2):  # a rerun changes nothing
        replace_partitions(fresh, path, ["snapshot_date"])
    return spark.read.parquet(path).select("snapshot_date", "user_id", "rank")


@query("q08b_replace_slice", """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate,
  CASE WHEN o_orderdate = (SELECT max(o_orderdate) FROM orders) THEN 0 ELSE o_totalprice END AS o_totalprice
FROM orders""")
def replace_newest_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same replacement as one plan, for tables that are not stored by day."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_totalprice")
    newest = orders.select(F.max("o_orderdate")).scalar()
    batch = newest_day(orders, "o_orderdate").withColumn("o_totalprice", F.lit(0.0))
    return replace_slice(orders, batch, "o_orderdate", newest)


VERSIONS_SQL = CORPUS_SQL + """,
judged AS (SELECT 'doc_' || doc_id AS doc_id, quality, toxic FROM labels),
old AS (SELECT * FROM corpus WHERE published_date <= DATE '2024-01-20'),
new AS (
  SELECT c.doc_id, source_type, entity,
    CASE WHEN quality = 0 THEN lower(text_content) ELSE text_content END AS text_content, published_date
  FROM corpus c LEFT JOIN judged j ON j.doc_id = c.doc_id WHERE coalesce(toxic, 0) = 0)"""

CORPUS_CONTENT = ["source_type", "entity", "text_content", "published_date"]


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("doc_id"), "quality", "toxic"
    )


def corpus_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """An earlier corpus, and today's with poor texts rewritten and toxic ones gone."""
    whole = corpus(spark, sf_dir)
    rewritten = F.when(F.col("quality") == 0, F.lower("text_content")).otherwise(F.col("text_content"))
    new = (
        whole.join(judged(spark, sf_dir), "doc_id", "left")
        .where(F.coalesce("toxic", F.lit(0)) == 0)
        .withColumn("text_content", rewritten)
        .select(*whole.columns)
    )
    return whole.where(F.col("published_date") <= F.lit(CHANGE_TIME).cast("date")), new


@query("q18_snapshot_diff", "WITH" + VERSIONS_SQL + """
SELECT coalesce(o.doc_id, n.doc_id) AS doc_id,
  CASE WHEN o.doc_id IS NULL THEN 'insert' WHEN n.doc_id IS NULL THEN 'delete' ELSE 'update' END AS change
FROM old o FULL OUTER JOIN new n ON o.doc_id = n.doc_id
WHERE o.doc_id IS NULL OR n.doc_id IS NULL OR o.text_content IS DISTINCT FROM n.text_content""")
def diff_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a search index over the corpus has to insert, update and delete."""
    old, new = corpus_versions(spark, sf_dir)
    return snapshot_diff(old, new, ["doc_id"], CORPUS_CONTENT)


@query("q18g_sync_gate", "WITH" + VERSIONS_SQL + """
SELECT 'old' AS indexed, (SELECT count(*) FROM old) AS n_old, (SELECT count(*) FROM new) AS n_new,
  NOT EXISTS (SELECT * FROM old EXCEPT ALL SELECT * FROM new)
  AND NOT EXISTS (SELECT * FROM new EXCEPT ALL SELECT * FROM old) AS in_sync
UNION ALL SELECT 'new', (SELECT count(*) FROM new), (SELECT count(*) FROM new), TRUE""")
def index_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether an index that holds the old, or the new, version may be queried for the new one."""
    old, new = corpus_versions(spark, sf_dir)
    gates = {"old": sync_gate(old, new, ["doc_id"], CORPUS_CONTENT), "new": sync_gate(new, new, ["doc_id"], CORPUS_CONTENT)}
    return gates["old"].select(F.lit("old").alias("indexed"), "*").unionByName(
        gates["new"].select(F.lit("new").alias("indexed"), "*")
    )
