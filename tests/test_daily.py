"""The daily job from landing files to the graded report, run twice where reruns must not matter."""

import datetime as dt
import json

import pytest
from conftest import bag
from pyspark.sql import functions as F

from gradeline.plans import daily, popularity, quality
from gradeline.sources import schemas

FIRST = dt.date(2024, 1, 1)
BRANDS = {"Netflix": "1", "Disney+": "2", "Hotstar": "3"}


def day(n):
    return FIRST + dt.timedelta(days=n)


def at(n, hour=7):
    return dt.datetime.combine(day(n), dt.time(hour))


def write(folder, name, value):
    (folder / name).write_text(json.dumps(value, indent=2))


def land(folder, n):
    """The files of day ``n``: ranks move by two places a day."""
    folder.mkdir(exist_ok=True)
    fetched = at(n, 6).isoformat()
    ratings = [
        {"symbol": s, "period": f"2024-0{m}-01", "strongBuy": 1 + n, "buy": 2, "hold": 3, "sell": 0, "strongSell": 0, "_fetched_at": fetched}
        for s in ("NFLX", "DIS") for m in (1, 2, 3, 4)
    ]
    write(folder, "finnhub_recommendation_trends_all.json", ratings)
    write(folder, "finnhub_company_news_all.json", [
        {"category": "c", "datetime": 1704067200 + 86400 * i, "headline": f"h{i}", "id": i, "image": "", "related": s,
         "source": "x", "summary": f"viewers like {s}", "url": "u", "_fetched_at": fetched}
        for i, s in enumerate(["NFLX", "DIS", "OTHER"] * (n + 1))
    ])
    write(folder, "fmp_analyst_estimates_all.json", [
        {"symbol": s, "date": f"20{y}-12-31", "revenueAvg": 100.0 * (y - 20), "epsAvg": 1.0 * (y - 20), "_fetched_at": fetched}
        for s in ("NFLX", "DIS") for y in (24, 25, 26)
    ])
    write(folder, "tmdb_reviews_1.json", {
        "id": 77, "page": 1, "total_pages": 1, "total_results": 2, "_fetched_at": fetched,
        "results": [
            {"id": "ra", "author": "u", "author_details": {"rating": 8.0}, "content": "good", "created_at": "2024-01-01T01:02:03.000Z"},
            {"id": "rb", "author": "u", "author_details": {"rating": None}, "content": None, "created_at": "2024-01-01T01:02:03.000Z"},
        ],
    })
    write(folder, "tmdb_trending_show_registry.json", [
        {"show_id": 77, "name": "Show", "platform": p, "_fetched_at": fetched} for p in ("p", "q")
    ])
    write(folder, "tmdb_watch_providers.json", {
        "results": [{"provider_id": 8, "provider_name": "Netflix", "display_priorities": {"US": 1}, "display_priority": 1}], "_fetched_at": fetched,
    })
    places = {"Netflix": 90 - 2 * n, "Disney+": 10 + 2 * n, "Hotstar": 50}
    results = [{"id": f"x{i}", "name": f"Other {i}", "genres": []} for i in range(100)]
    for name, place in places.items():
        results[place - 1] = {"id": BRANDS[name], "name": name, "genres": ["tv"]}
    write(folder, "appstore_top_free_100_us.json", {"feed": {"country": "us", "results": results}, "_fetched_at": fetched})


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    landing = tmp_path_factory.mktemp("landing")
    wh = daily.Warehouse.at(spark, str(tmp_path_factory.mktemp("tables")), "daily_test")
    for n in (0, 7, 14):
        land(landing, n)
        for _ in range(2):
            daily.ingest(wh, str(landing), at(n))
        daily.clean(wh)
        daily.aggregate(wh)
    daily.aggregate(wh)  # a rerun of the last day
    return wh


def test_layers(spark, warehouse):
    wh = warehouse
    for layer in ("bronze", "silver", "gold"):
        daily.check(wh, layer, at(14, 8))
    # A slice every day, current once; a load that is run again replaces its slice.
    assert wh.bronze.table("estimates").count() == 3 * 6 and wh.silver.table("estimates").count() == 6
    history = wh.gold.table("rank_history")
    assert history.count() == 3 * 100 and history.select("snapshot_date").distinct().count() == 3
    assert bag(history.where("name = 'Netflix'").select("rank")) == [(62,), (76,), (90,)]
    # The chart in silver keeps apps that have left it; today's brands carry today's rank.
    assert bag(wh.gold.table("rankings_by_brand").select("brand", "name", "_rank")) == [
        ("Disney+", "Disney+", 38), ("Disney+", "Hotstar", 50), ("Netflix", "Netflix", 62),
    ]
    assert bag(wh.gold.table("show_engagement").select("review_count", "avg_rating", "platform")) == [(2, 8.0, "p"), (2, 8.0, "q")]
    assert wh.gold.table("corpus").count() == 2 * 15 + 1
    sentiment = wh.gold.table("analyst_sentiment").where("symbol = 'NFLX' and period = '2024-01-01'").first()
    assert sentiment.strongBuy == 15 and sentiment.news_count == 11
    assert bag(wh.gold.table("forward_estimates").select("revenue_yoy_growth_pct").distinct()) == [(20.0,), (25.0,), (None,)]


def test_stale_and_empty_loads(spark, warehouse, tmp_path):
    with pytest.raises(AssertionError, match="app_chart"):
        daily.check(warehouse, "bronze", at(20))
    land(tmp_path, 14)
    write(tmp_path, "finnhub_company_news_all.json", [])
    before = warehouse.bronze.table("news").count()
    with pytest.raises(RuntimeError, match="news"):
        daily.ingest(warehouse, str(tmp_path), at(14))
    assert warehouse.bronze.table("news").count() == before > 0


def test_a_half_written_file_replaces_nothing(spark, warehouse, tmp_path):
    land(tmp_path, 14)
    whole = (tmp_path / "finnhub_company_news_all.json").read_text()
    (tmp_path / "finnhub_company_news_all.json").write_text(whole[: len(whole) // 2])
    before = bag(warehouse.bronze.table("news"))
    with pytest.raises(Exception, match="finnhub_company_news_all.json"):
        daily.ingest(warehouse, str(tmp_path), at(14))
    assert bag(warehouse.bronze.table("news")) == before


def test_checks_fail_together(spark, warehouse):
    with pytest.raises(AssertionError, match="(?s)row_count.*app_chart|app_chart.*row_count"):
        empty = warehouse.silver.table("news").limit(0)
        stale = daily._freshness(warehouse, daily.as_timestamp(at(30)))
        quality.raise_if_failed(quality.run_suite("s", {"news": (empty, quality.SILVER["news"])}), stale)


def test_nothing_is_frozen_without_changes(spark, tmp_path):
    wh = daily.Warehouse.at(spark, str(tmp_path), "no_changes")
    wh.gold.create_if_absent("rank_history", schemas.RANK_HISTORY, partition_by="snapshot_date")
    with pytest.raises(RuntimeError, match="no cutoffs"):
        daily.freeze_cutoffs(wh, at(0))
    assert not wh.gold.exists("move_cutoffs")


def test_forecast(spark, rows, warehouse):
    wh = warehouse
    frozen = daily.freeze_cutoffs(wh, at(8)).collect()
    assert daily.freeze_cutoffs(wh, at(9)).collect() == frozen
    # Days 0 to 7 and 7 to 14 of both brands: +14 for one, -14 for the other.
    assert frozen[0].n_deltas == 4 and frozen[0].fall_below == pytest.approx(-14.0) and frozen[0].rise_above == pytest.approx(14.0)

    embeddings = wh.gold.table("corpus").select("doc_id", F.array(F.lit(1.0), F.length("doc_id").cast("double")).alias("embedding"))
    questions = rows("entity string, query_text string, query_vector array<double>", ("NFLX", "viewers NFLX", [1.0, 1.0]), ("DIS", "viewers DIS", [1.0, 2.0]))
    live = daily.ask(wh, day(7), embeddings=embeddings, questions=questions)
    with pytest.raises(ValueError, match="needs embeddings"):
        daily.ask(wh, day(7))
    with pytest.raises(ValueError, match="no question for \\['DIS'\\]"):
        daily.ask(wh, day(7), embeddings=embeddings, questions=questions.where("entity = 'NFLX'"))
    own = daily.ask(wh, day(7), embeddings=embeddings, questions=questions.drop("query_text"))
    assert bag(own.where("variant = 'rag'").select("symbol", F.size("retrieved_doc_ids"))) == [("DIS", 5), ("NFLX", 5)]
    # The view is in the catalog and says what the plan says.
    assert bag(spark.table("daily_test_gold.brand_popularity")) == bag(popularity.brand_popularity(wh.gold.table("rank_history")))
    backfill = daily.ask(wh, day(14), backfill_from=FIRST)
    assert bag(live.select("symbol", "variant", F.size("retrieved_doc_ids"))) == [
        (s, v, n) for s in ("DIS", "NFLX") for v, n in (("no_rag", 0), ("rag", 5))
    ]
    published = wh.gold.table("corpus").select("doc_id", "published_date")
    cited = live.select(F.explode("retrieved_doc_ids").alias("doc_id")).join(published, "doc_id")
    assert cited.agg(F.max("published_date")).first()[0] <= day(7)
    assert bag(backfill.select("symbol", "as_of", "variant")) == sorted(
        (s, day(n), "no_rag") for s in ("NFLX", "DIS") for n in (0, 7)
    )
    prompt = live.where("symbol = 'NFLX' and variant = 'no_rag'").first().prompt
    # The estimates held now were loaded on day 14, so a call of day 7 must not see them.
    assert '"d":"2024-01-08","popularity":25.0' in prompt and '"estimates":null' in prompt
    assert '"date":"2026-12-31"' in daily.ask(wh, day(14), use_rag="false").where("symbol = 'NFLX' and variant = 'no_rag'").first().prompt

    prompts = live.unionByName(backfill)
    answer = F.when((F.col("symbol") == "DIS") & (F.col("variant") == "rag"), F.lit("?")).otherwise(F.lit('{"call": "rise"}'))
    replies = prompts.select("symbol", F.col("as_of").alias("prediction_date"), "source", "variant", F.lit(1).alias("attempt"), answer.alias("reply"))
    for _ in range(2):
        daily.record(wh, prompts, replies, "model", at(14))
    assert daily.predictions(wh.gold).count() == 7 and bag(daily.skips(wh.gold).select("symbol", "variant")) == [("DIS", "rag")]
    # Answered now: the key moves from the skips to the predictions.
    daily.record(wh, live, replies.withColumn("reply", F.lit('{"call": "hold"}')), "model", at(14, 9))
    assert daily.skips(wh.gold).count() == 0 and daily.predictions(wh.gold).count() == 8

    daily.score(wh)
    summary = {(r.source, r.model): r for r in wh.gold.table("scorecard_summary").collect()}
    # Every change equals its cutoff, and edges hold.
    assert (summary[("live", "agent_rag")].n, summary[("live", "agent_rag")].hits) == (2, 2)
    assert (summary[("backfill", "agent_no_rag")].n, summary[("backfill", "agent_no_rag")].hits) == (4, 0)
    assert summary[("backfill", "always_hold")].hits == 4
    # Day 7 has a window before it, day 0 has none.
    assert summary[("backfill", "persistence")].n == 2
    daily.check(wh, "predictions", at(14))
