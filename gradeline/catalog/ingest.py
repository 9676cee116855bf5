"""Landing files: typed scans, unnesting, stamps. The files are written by Spark from given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeline.catalog.fixtures import CHART_SQL, FETCHED_AT, INGESTED_AT, chart, moment, table
from gradeline.catalog.registry import query
from gradeline.session import shared_folder
from gradeline.sources.landing import read_records, stamp, unnest, unnest_ranked, write_documents
from gradeline.sources.ledger import LandedFiles
from gradeline.sources.tables import Database, keep

RECORDS_PER_FILE = 10_000
TURNS_PER_PAGE = 20
CONVERSATIONS_PER_FILE = 500


@query("q01_json_typed_scan", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value,
  CAST(NULL AS VARCHAR) AS never_sent, '2024-02-01 06:00:00.000000' AS _fetched_at,
  '2024-02-01 07:00:00.000000' AS _ingested_at
FROM events""")
def json_typed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array files read back through a wildcard: an undeclared field drops, an absent one is NULL."""
    landed = shared_folder(spark, "records")
    events = table(spark, sf_dir, "events")
    write_documents(
        events.withColumns({"ts": F.col("ts").cast("string"), "_fetched_at": F.lit(FETCHED_AT)}),
        landed,
        F.floor(F.col("event_id") / RECORDS_PER_FILE),
    )
    schema = (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "never_sent string, _fetched_at timestamp_ntz"
    )
    return stamp(read_records(spark, f"{landed}/batch=*/*.txt", schema), moment(INGESTED_AT))


@query("q02_envelope_unnest", """
SELECT conv_id AS _show_id, strftime(TIMESTAMP '2024-02-01 06:00:00', '%Y-%m-%d %H:%M:%S.%f') AS _fetched_at,
  turn AS id, role AS author, length(text) AS rating, text AS content
FROM conversations""")
def envelope_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paged envelopes with one fetch time each; elements carry it, nested fields are reached by name."""
    landed = shared_folder(spark, "envelopes")
    item = F.struct(
        F.col("turn").alias("id"),
        F.struct(F.col("role").alias("name"), F.length("text").cast("double").alias("rating")).alias("author_details"),
        F.col("text").alias("content"),
    )
    pages = (
        table(spark, sf_dir, "conversations")
        .groupBy(F.col("conv_id").alias("id"), F.floor(F.col("turn") / TURNS_PER_PAGE).alias("page"))
        .agg(F.collect_list(item).alias("results"))
        .withColumn("_fetched_at", F.lit(FETCHED_AT))
    )
    # By page as well, so the pages of one long conversation go to many files.
    in_file = F.concat_ws("_", F.floor(F.col("id") / CONVERSATIONS_PER_FILE), "page")
    write_documents(pages, landed, in_file)
    schema = """
        id bigint, page bigint, _fetched_at timestamp_ntz,
        results array<struct<id: bigint, author_details: struct<name: string, rating: double>, content: string>>
    """
    files = read_records(spark, f"{landed}/batch=*/*.txt", schema).withColumnRenamed("id", "_show_id")
    rows = unnest(files, "results", ["_show_id", "_fetched_at"])
    return rows.select(
        "_show_id", "_fetched_at", "id", F.col("author_details.name").alias("author"),
        F.col("author_details.rating").cast("bigint").alias("rating"), "content",
    )


@query("q03_position_rank", "WITH" + CHART_SQL + """
SELECT CAST(snapshot_date AS VARCHAR) AS _storefront, rank AS _rank, CAST(user_id AS VARCHAR) AS id, total
FROM chart""")
def position_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One chart feed per day; an app's rank is its position in the feed."""
    landed = shared_folder(spark, "feeds")
    entry = F.struct("rank", F.col("user_id").cast("string").alias("id"), "total")
    feeds = (
        chart(spark, sf_dir)
        .groupBy("snapshot_date")
        .agg(F.sort_array(F.collect_list(entry)).alias("ranked"))
        .select(
            F.struct(
                F.col("snapshot_date").cast("string").alias("country"),
                F.transform("ranked", lambda e: F.struct(e["id"].alias("id"), e["total"].alias("total"))).alias("results"),
            ).alias("feed"),
            F.lit(FETCHED_AT).alias("_fetched_at"),
        )
    )
    write_documents(feeds, landed, F.substring("feed.country", 1, 7))
    schema = """
        feed struct<country: string, results: array<struct<id: string, total: double>>>, _fetched_at timestamp_ntz
    """
    files = read_records(spark, f"{landed}/batch=*/*.txt", schema)
    rows = unnest_ranked(files, "feed.results", [F.col("feed.country").alias("_storefront")])
    return rows.select("_storefront", "_rank", "id", "total")


@query("q01l_file_ledger", """
SELECT event_id, user_id, value, CAST(event_id >= 10000 * ((SELECT max(event_id) FROM events) // 20000) AS BIGINT) AS _load, n_files, n_broken
FROM events, (SELECT max(event_id) // 10000 + 1 + 1 AS n_files, 1 AS n_broken FROM events)""")
def file_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that come in two waves, with one among the first that is cut off; each is read by one load, the last load finds none.

    The broken file repeats the rows of another, so it would show if any of its rows counted.
    """
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    batch = F.expr(f"event_id div {RECORDS_PER_FILE}")
    later = F.col("event_id") >= RECORDS_PER_FILE * (events.agg(F.expr(f"max(event_id) div {2 * RECORDS_PER_FILE}")).scalar())
    landed = shared_folder(spark, "waves")
    name = f"waves_{landed.rsplit('-', 1)[1]}"
    files = LandedFiles(
        Database(spark, name, shared_folder(spark, name)), "events", "events_files", landed,
        "event_id bigint, user_id bigint, value double",
    )
    newest = events.where(batch == events.agg(F.max(batch)).scalar())
    write_documents(newest, f"{landed}/cut", batch)
    whole = spark.read.option("wholetext", True).text(f"{landed}/cut")
    cut = keep(whole.select(F.expr("substring(value, 1, length(value) - 5)").alias("value")), "cut")
    cut.write.mode("overwrite").text(f"{landed}/cut")
    for number, wave in enumerate((~later, later)):
        write_documents(events.where(wave), f"{landed}/wave{number}", batch)
        files.load()
    if files.load():
        raise AssertionError("a file was loaded twice")
    noted = files.db.table("events_files")
    n_files, n_broken = F.count("*"), F.count_if(F.col("status") == "broken").cast("int")
    return (
        files.db.table("events").drop("_file")
        .withColumns({"n_files": noted.agg(n_files).scalar(), "n_broken": noted.agg(n_broken).scalar()})
    )
