"""Tables stored by parts and buckets of their key: merges, deletes and diffs that leave the rest alone."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeline.catalog.fixtures import corpus, table
from gradeline.catalog.maintain import CHANGE_TIME, CORPUS_CONTENT, VERSIONS_SQL, judged
from gradeline.catalog.registry import query
from gradeline.operators.diff import content_hash
from gradeline.session import shared_folder
from gradeline.sources.bucketed import BucketedTable
from gradeline.sources.tables import Database

#: Parts of a table that is merged into; it has as many buckets, and a merge as many tasks, as the session gives any shuffle.
PARTS = 8
#: Parts of a table that is only compared, which needs no buckets.
COMPARED_PARTS = 64


def bucketed(spark: SparkSession, name: str, keys: list[str], parts: int, buckets: int) -> BucketedTable:
    database = Database(spark, f"layout_{uuid.uuid4().hex}", shared_folder(spark, "layout"))
    return BucketedTable(database, name, keys, parts, buckets)


def stored_orders(spark: SparkSession) -> BucketedTable:
    return bucketed(spark, "orders", ["o_orderkey"], PARTS, int(spark.conf.get("spark.sql.shuffle.partitions")))


@query("q06b_bucketed_upsert", """
SELECT o_orderkey, o_custkey, CASE o_orderstatus WHEN 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
  CASE o_orderstatus WHEN 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
FROM orders
UNION ALL
SELECT o_orderkey + 1000000000, o_custkey, 'O', o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'""")
def bucketed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch of q06 merged, twice, into a table stored by buckets of the key, which is not shuffled for it."""
    orders = table(spark, sf_dir, "orders")
    stored = stored_orders(spark)
    stored.create(orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"))
    closed = orders.where(F.col("o_orderstatus") == "P").select(
        "o_orderkey", "o_custkey", F.lit("F").alias("o_orderstatus"), (F.col("o_totalprice") + 1).alias("o_totalprice")
    )
    repeated = orders.where(F.col("o_orderpriority") == "1-URGENT").select(
        (F.col("o_orderkey") + 1_000_000_000).alias("o_orderkey"), "o_custkey", F.lit("O").alias("o_orderstatus"), "o_totalprice"
    )
    for _ in range(2):  # a rerun changes nothing
        stored.upsert(closed.unionByName(repeated))
    return stored.rows()


@query("q06d_bucketed_delete", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def bucketed_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a returned line are deleted from a table stored by buckets of the key."""
    stored = stored_orders(spark)
    stored.create(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"))
    returned = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
    stored.delete(returned.select(F.col("l_orderkey").alias("o_orderkey")))
    return stored.rows()


@query("q18d_digest_diff", "WITH" + VERSIONS_SQL + """
SELECT coalesce(o.doc_id, n.doc_id) AS doc_id,
  CASE WHEN o.doc_id IS NULL THEN 'insert' WHEN n.doc_id IS NULL THEN 'delete' ELSE 'update' END AS change
FROM old o FULL OUTER JOIN new n ON o.doc_id = n.doc_id
WHERE o.doc_id IS NULL OR n.doc_id IS NULL OR o.text_content IS DISTINCT FROM n.text_content""")
def digest_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes of q18 between two stored versions, from the parts whose digests differ.

    A version is stored as ids and hashes of whole contents, as they are and as rewritten. Both are taken where
    the texts are read, so no text is moved to find out which of the two today's corpus has.
    """
    rewritten = ["lowered" if name == "text_content" else name for name in CORPUS_CONTENT]
    hashed = corpus(spark, sf_dir).withColumn("lowered", F.lower("text_content")).select(
        "doc_id", "published_date", content_hash(CORPUS_CONTENT).alias("content"), content_hash(rewritten).alias("rewritten")
    )
    content = F.when(F.col("quality") == 0, F.col("rewritten")).otherwise(F.col("content")).alias("content")
    fit = F.coalesce("toxic", F.lit(0)) == 0
    versions = (
        hashed.where(F.col("published_date") <= F.lit(CHANGE_TIME).cast("date")).select("doc_id", "content"),
        hashed.join(judged(spark, sf_dir), "doc_id", "left").where(fit).select("doc_id", content),
    )
    stored = []
    for version in versions:
        stored.append(bucketed(spark, "corpus", ["doc_id"], COMPARED_PARTS, 1))
        stored[-1].create(version)
    before, after = stored
    changes, _ = after.changes_since(before, ["content"])
    return changes
