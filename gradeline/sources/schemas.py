"""Declared schemas. Nothing is inferred: a field a file lacks is NULL, an extra one is dropped."""

# Field names and types of the landing files
RECOMMENDATIONS = """
    symbol string, period string,
    strongBuy int, buy int, hold int, sell int, strongSell int,
    _fetched_at timestamp
"""

NEWS = """
    category string, datetime bigint, headline string, id bigint, image string, related string,
    source string, summary string, url string,
    _fetched_at timestamp
"""

ESTIMATES = """
    symbol string, date string,
    revenueLow double, revenueHigh double, revenueAvg double,
    ebitdaLow double, ebitdaHigh double, ebitdaAvg double,
    ebitLow double, ebitHigh double, ebitAvg double,
    netIncomeLow double, netIncomeHigh double, netIncomeAvg double,
    sgaExpenseLow double, sgaExpenseHigh double, sgaExpenseAvg double,
    epsAvg double, epsHigh double, epsLow double,
    numAnalystsRevenue int, numAnalystsEps int,
    _fetched_at timestamp
"""

REVIEW_PAGE = """
    id bigint, page bigint,
    results array<struct<
        id: string, author: string,
        author_details: struct<name: string, username: string, avatar_path: string, rating: double>,
        content: string, created_at: string, updated_at: string, url: string>>,
    total_pages bigint, total_results bigint,
    _fetched_at timestamp
"""

SHOW_REGISTRY = "show_id bigint, name string, platform string, _fetched_at timestamp"

PROVIDER_LIST = """
    results array<struct<
        display_priorities: map<string, bigint>, display_priority: bigint, logo_path: string,
        provider_name: string, provider_id: bigint>>,
    _fetched_at timestamp
"""

APP_CHART = """
    feed struct<
        country: string,
        results: array<struct<
            artistName: string, id: string, name: string, releaseDate: string, kind: string,
            artworkUrl100: string, genres: array<string>, url: string>>>,
    _fetched_at timestamp
"""

TRADE_TICK = "s string, p double, t bigint, v double, c array<string>"

# Landing files of each raw table
LANDING_FILES = {
    "recommendation_trends": "finnhub_recommendation_trends_*.json",
    "news": "finnhub_company_news_*.json",
    "estimates": "fmp_analyst_estimates_*.json",
    "reviews": "tmdb_reviews_*.json",
    "shows": "tmdb_trending_show_registry.json",
    "providers": "tmdb_watch_providers.json",
    "app_chart": "appstore_top_free_100_*.json",
}

# Columns of the derived tables
RANK_HISTORY = "id string, _storefront string, name string, rank int, snapshot_date date"

CUTOFFS = """
    horizon_days int, fall_below double, rise_above double, n_deltas bigint,
    first_d date, last_d date, frozen_at timestamp
"""

PREDICTIONS = """
    symbol string, prediction_date date, source string, variant string,
    call string, confidence string, reasoning string, retrieved_doc_ids array<string>,
    model_endpoint string, created_at timestamp
"""

SKIPS = "symbol string, prediction_date date, source string, variant string, created_at timestamp"

PREDICTION_KEY = ("symbol", "prediction_date", "source", "variant")

# Predictions and skips are the rows of this table with and without a call: a key has one row.
ANSWERS = """
    symbol string, source string, variant string,
    call string, confidence string, reasoning string, retrieved_doc_ids array<string>,
    model_endpoint string, created_at timestamp, prediction_date date
"""
