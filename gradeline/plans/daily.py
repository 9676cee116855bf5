"""The daily job, step by step, over catalog tables.

Each step reads tables and writes tables, can be run again with the same arguments, and leaves the
same result. "Now" and every date are arguments.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeline.operators.literals import literal_rows
from gradeline.operators.merge import upsert
from gradeline.plans import calls, curate, metrics, popularity, quality, scorecard
from gradeline.plans.retrieval import hybrid_top_k, retrieved_context
from gradeline.sources import schemas
from gradeline.sources.landing import read_records, stamp, unnest, unnest_ranked
from gradeline.sources.tables import Database, GuardedRefresh, keep


LOAD_DAY = "_load_day"


@dataclass(frozen=True)
class Warehouse:
    """The three layers, as databases under one shared folder."""

    spark: SparkSession
    bronze: Database
    silver: Database
    gold: Database

    @classmethod
    def at(cls, spark: SparkSession, folder: str, prefix: str = "forecast") -> Warehouse:
        layers = {layer: Database(spark, f"{prefix}_{layer}", folder) for layer in ("bronze", "silver", "gold")}
        return cls(spark, **layers)

    def symbols(self) -> DataFrame:
        return literal_rows(self.spark, popularity.SYMBOL_BRANDS, "symbol string, brand string")


def as_timestamp(moment: dt.datetime) -> Column:
    return F.lit(moment.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def as_date(day: dt.date) -> Column:
    return F.lit(day.isoformat()).cast("date")


def ingest(wh: Warehouse, landing: str, now: dt.datetime) -> None:
    """Land every file into bronze. Two tables grow by the slice of the load's day, which a rerun replaces;
    the others are replaced unless the load is empty. A broken file fails before its table is touched."""
    bronze, files = wh.bronze, schemas.LANDING_FILES

    def records(table: str, schema: str) -> DataFrame:
        return read_records(wh.spark, f"{landing}/{files[table]}", schema)

    loaded = as_timestamp(now)
    for table, schema in (("recommendation_trends", schemas.RECOMMENDATIONS), ("estimates", schemas.ESTIMATES)):
        rows = stamp(records(table, schema), loaded)
        bronze.load_slice(table, rows.withColumn(LOAD_DAY, F.to_date("_ingested_at")), LOAD_DAY)

    refresh = GuardedRefresh(bronze.replace)
    refresh.load("news", stamp(records("news", schemas.NEWS), loaded))
    pages = records("reviews", schemas.REVIEW_PAGE).withColumnRenamed("id", "_show_id")
    refresh.load("reviews", stamp(unnest(pages, "results", ["_show_id", "_fetched_at"]), loaded))
    refresh.load("shows", stamp(records("shows", schemas.SHOW_REGISTRY), loaded))
    refresh.load("providers", stamp(unnest(records("providers", schemas.PROVIDER_LIST), "results", ["_fetched_at"]), loaded))
    feeds = records("app_chart", schemas.APP_CHART)
    ranked = unnest_ranked(feeds, "feed.results", [F.col("feed.country").alias("_storefront"), "_fetched_at"])
    refresh.load("app_chart", stamp(ranked, loaded))
    refresh.finish()


def clean(wh: Warehouse) -> None:
    """Bronze to silver, and the text corpus."""
    bronze, silver = wh.bronze, wh.silver
    trends, estimates = (bronze.table(name).drop(LOAD_DAY) for name in ("recommendation_trends", "estimates"))
    silver.replace("recommendation_trends", curate.current_rows(trends, ["symbol", "period"]))
    silver.replace("news", curate.type_news(bronze.table("news")))
    silver.replace("estimates", curate.type_estimates(estimates))
    silver.replace("shows", curate.current_rows(bronze.table("shows"), ["show_id", "platform"]))
    silver.replace("reviews", curate.name_reviews(bronze.table("reviews"), silver.table("shows")))
    silver.replace("providers", curate.current_rows(bronze.table("providers"), ["provider_id"]))

    today = curate.newest_chart(bronze.table("app_chart"), curate.brand_aliases(wh.spark))
    if silver.exists("app_chart"):
        today = upsert(silver.table("app_chart"), today, ["id", "_storefront"])
    silver.replace("app_chart", today)

    symbols = [symbol for symbol, _ in popularity.SYMBOL_BRANDS]
    wh.gold.replace("corpus", curate.text_corpus(silver.table("news"), silver.table("reviews"), symbols))


def aggregate(wh: Warehouse) -> None:
    """Silver to gold, and today's slice of the rank history."""
    silver, gold = wh.silver, wh.gold
    symbols = [symbol for symbol, _ in popularity.SYMBOL_BRANDS]
    about = silver.table("news").where(F.col("related").isin(*symbols))
    counts = metrics.monthly_counts(about, "related", "news_date")
    gold.replace("analyst_sentiment", metrics.analyst_sentiment(silver.table("recommendation_trends"), counts))
    gold.replace("forward_estimates", metrics.forward_growth(silver.table("estimates")))
    gold.replace("rankings_by_brand", metrics.rankings_by_brand(silver.table("app_chart")))
    gold.replace("show_engagement", metrics.show_engagement(silver.table("reviews"), silver.table("shows")))
    gold.create_if_absent("rank_history", schemas.RANK_HISTORY, partition_by="snapshot_date")
    gold.replace_partitions("rank_history", popularity.chart_snapshot(wh.bronze.table("app_chart")), "snapshot_date")


def series(wh: Warehouse) -> DataFrame:
    """Popularity of the brands, from the view ``brand_popularity`` of the gold database, made on first use."""
    if not wh.gold.exists("brand_popularity"):
        wh.gold.create_view("brand_popularity", popularity.brand_popularity_sql(wh.gold.full_name("rank_history")))
    return wh.gold.table("brand_popularity")


def freeze_cutoffs(wh: Warehouse, now: dt.datetime) -> DataFrame:
    """The cutoffs of the first run that has changes to measure; later runs read that row."""

    def first() -> DataFrame:
        row = keep(popularity.cutoffs(series(wh), as_timestamp(now)), "cutoffs")
        if row.where(F.col("n_deltas") > 0).isEmpty():
            raise RuntimeError("no brand has two scores a horizon apart yet; there are no cutoffs to freeze")
        return row

    return wh.gold.freeze("move_cutoffs", first)


def ask(
    wh: Warehouse,
    as_of: dt.date,
    backfill_from: dt.date | None = None,
    use_rag: str = "",
    model: str = "",
    embeddings: DataFrame | None = None,
    questions: DataFrame | None = None,
) -> DataFrame:
    """Prompts of one live run, or of a backfill when a start is given.

    Retrieval needs ``embeddings`` (doc_id, embedding) of the corpus and ``questions`` (entity = symbol,
    query_vector), the embedded texts of ``calls.question_rows``, or texts of the caller's own as
    query_text; a live run that plans retrieval fails without them, or with a symbol without a vector.
    """
    gold, known, popular, day = wh.gold, wh.symbols(), series(wh), as_date(as_of)
    cutoffs = gold.table("move_cutoffs")
    if backfill_from is not None:
        horizon = cutoffs.select("horizon_days").scalar()
        plan = calls.backfill_plan(known, popular, as_date(backfill_from), day, horizon, use_rag, model)
    else:
        plan = calls.live_plan(known, day, use_rag, model)
    with_texts = embeddings is not None and questions is not None
    variants = calls.planned_variants(backfill_from is not None, use_rag, model)
    if not with_texts and any(v.startswith(calls.RAG) for v in variants):
        raise ValueError("a live run with retrieval needs embeddings and questions; pass use_rag=false to do without")
    # Kept: every kind of signal is looked up for the same planned calls.
    plan = keep(plan, "plan")
    asked = plan.select("symbol", "brand", "as_of").distinct()
    if backfill_from is None and with_texts:
        if "query_text" not in questions.columns:
            questions = questions.join(calls.question_rows(known), "entity")
        missing = known.join(questions, F.col("symbol") == F.col("entity"), "left_anti").select("symbol")
        if not missing.isEmpty():
            raise ValueError(f"no question for {[row['symbol'] for row in missing.collect()]}")
        documents = gold.table("corpus").join(embeddings, "doc_id", "left")
        context = retrieved_context(hybrid_top_k(documents, questions, day), documents, ["entity"]).select(
            F.col("entity").alias("symbol"), day.alias("as_of"), "chunks"
        )
    else:
        context = literal_rows(wh.spark, [], "symbol string, as_of date, chunks array<struct<doc_id: string, text: string>>")
    return calls.prompt_rows(
        plan,
        popularity.recent_popularity(asked, popular),
        popularity.latest_sentiment(asked, gold.table("analyst_sentiment")),
        popularity.latest_estimate(asked, gold.table("forward_estimates")),
        context,
        cutoffs,
    )


def record(wh: Warehouse, prompts: DataFrame, replies: DataFrame, model_endpoint: str, now: dt.datetime) -> None:
    """Parse the replies to the prompts and store one answer per key, replacing an earlier one.

    ``replies`` has (symbol, prediction_date, source, variant, attempt, reply). A prompt without a
    readable reply is stored as a skip.
    """
    asked = prompts.withColumnRenamed("as_of", "prediction_date").select(*schemas.PREDICTION_KEY, "retrieved_doc_ids")
    store_answers(wh.gold, calls.answer_rows(asked, replies, model_endpoint, as_timestamp(now)))


def store_answers(gold: Database, answers: DataFrame) -> None:
    """Upsert answers, predictions and skips alike, by key into the table stored by day."""
    gold.create_if_absent("answers", schemas.ANSWERS, partition_by="prediction_date")
    gold.merge("answers", keep(answers, "answers"), ["symbol", "source", "variant"], ["created_at"], "prediction_date")


def predictions(gold: Database) -> DataFrame:
    return gold.table("answers").where(F.col("call").isNotNull())


def skips(gold: Database) -> DataFrame:
    return gold.table("answers").where(F.col("call").isNull()).select(*schemas.PREDICTION_KEY, "created_at")


def score(wh: Warehouse, seed: str | None = "baseline") -> None:
    """The scorecard and its summary."""
    card = scorecard.grade(predictions(wh.gold), wh.symbols(), series(wh), wh.gold.table("move_cutoffs"))
    wh.gold.replace("scorecard", card)
    wh.gold.replace("scorecard_summary", scorecard.summarise(wh.gold.table("scorecard"), skips(wh.gold), seed))


def check(wh: Warehouse, layer: str, now: dt.datetime) -> None:
    """Run the rules of a layer; raises once with every failed check."""
    layers: dict[str, Callable[[], list[DataFrame]]] = {
        "bronze": lambda: [_suite(layer, wh.bronze, quality.BRONZE), _freshness(wh, as_timestamp(now))],
        "silver": lambda: [_suite(layer, wh.silver, quality.SILVER)],
        "gold": lambda: [_suite(layer, wh.gold, quality.GOLD)],
        "predictions": lambda: [
            quality.run_suite(layer, {"predictions": (predictions(wh.gold), quality.PREDICTIONS["predictions"])}),
            quality.skip_rate(predictions(wh.gold), skips(wh.gold), as_date(now.date())),
            quality.call_collapse(predictions(wh.gold), as_date(now.date())),
        ],
    }
    quality.raise_if_failed(*layers[layer]())


def _suite(layer: str, database: Database, rules: dict[str, tuple]) -> DataFrame:
    return quality.run_suite(layer, {name: (database.table(name), checks) for name, checks in rules.items()})


def _freshness(wh: Warehouse, now: Column) -> DataFrame:
    sources: dict[str, tuple[DataFrame, Column | str]] = {}
    for name in schemas.LANDING_FILES:
        rows = wh.bronze.table(name)
        if name == "app_chart":
            sources["app_chart [us]"] = (rows.where(F.col("_storefront") == popularity.STOREFRONT), "_fetched_at")
        else:
            sources[name] = (rows, "_fetched_at")
    return quality.freshness(sources, now)
