import datetime as dt
import math
import random
import re

import pytest
from conftest import bag
from pyspark.sql import functions as F

from gradeline.functions.scores import wilson_bounds
from gradeline.operators import nearest
from gradeline.plans import calls, curate, metrics, popularity, quality, retrieval, scorecard
from gradeline.sources.schemas import PREDICTION_KEY

START = dt.date(2024, 1, 1)
T0, T1 = dt.datetime(2024, 1, 1, 6), dt.datetime(2024, 1, 2, 6)


def day(n):
    return START + dt.timedelta(days=n)


def lit_day(n):
    return F.lit(day(n))


# curation

def test_news_are_typed_once_per_id(spark, rows):
    ddl = "category string, datetime bigint, headline string, id bigint, image string, related string, _ingested_at timestamp"
    bronze = rows(
        ddl,
        ("c", 1704067200, "old", 1, "i", "AAA", T0), ("c", 1704153599, "new", 1, "i", "AAA", T1),
        ("c", 1704153600, "x", 2, "i", "AAA", T0), ("c", 1704153600, "x", 2, "i", "BBB", T0),
    )
    got = curate.type_news(bronze)
    assert got.columns == ["headline", "id", "related", "_ingested_at", "news_date"]
    assert bag(got.select("id", "headline", "news_date")) == [(1, "new", day(0)), (2, "x", day(1))]
    assert curate.type_news(bronze, ["id", "related"]).count() == 3


def test_reviews_fan_out_over_spellings(spark, rows):
    reviews = rows("id string, _show_id bigint, content string, _ingested_at timestamp",
                   ("r1", 1, "old", T0), ("r1", 1, "new", T1), ("r2", 2, "t", T0))
    shows = rows("show_id bigint, name string, platform string", (1, "A", "p"), (1, "A", "q"), (1, "a", "q"))
    got = curate.name_reviews(reviews, shows)
    assert bag(got.select("id", "content", "name")) == [("r1", "new", "A"), ("r1", "new", "a"), ("r2", "t", None)]


def test_newest_chart_and_aliases(spark, rows):
    ddl = "id string, _storefront string, name string, _rank int, _fetched_at timestamp, _ingested_at timestamp"
    bronze = rows(
        ddl,
        ("1", "us", "Netflix", 9, T0, T0), ("1", "us", "Netflix", 3, T1, T1), ("1", "us", "Netflix", 2, T1, T1 + dt.timedelta(hours=1)),
        ("2", "us", "Hotstar", 5, T1, T1), ("3", "de", "Other", 1, T1, T1),
    )
    today = curate.newest_chart(bronze, curate.brand_aliases(spark))
    assert "_fetched_at" not in today.columns
    assert bag(today.select("id", "_rank", "brand")) == [("1", 2, "Netflix"), ("2", 5, "Disney+"), ("3", 1, None)]
    assert bag(metrics.rankings_by_brand(today).select("brand", "_rank", "snapshot_date")) == [("Disney+", 5, day(1)), ("Netflix", 2, day(1))]
    snapshot = popularity.chart_snapshot(bronze)
    assert bag(snapshot.select("id", "rank", "snapshot_date")) == [("1", 2, day(1)), ("2", 5, day(1)), ("3", 1, day(1))]
    with pytest.raises(ValueError, match="one brand"):
        curate.brand_aliases(spark, [("A", "x"), ("B", "x")])


def test_corpus_keeps_news_without_summary(spark, rows):
    news = rows("id bigint, related string, headline string, summary string, news_date date",
                (1, "NFLX", "h", "s", day(0)), (2, "NFLX", "h", None, day(0)), (3, "XXX", "h", "s", day(0)))
    reviews = rows("id string, _show_id bigint, content string, created_at string",
                   ("a", 7, "text", "2024-01-02T03:04:05.000Z"), ("b", 7, None, "2024-01-02T03:04:05.000Z"))
    got = curate.text_corpus(news, reviews, ["NFLX", "DIS"])
    assert bag(got) == [
        ("news_1", "news", "NFLX", "h. s", day(0)), ("news_2", "news", "NFLX", None, day(0)),
        ("review_7_a", "review", "7", "text", day(1)),
    ]
    lenient = curate.text_corpus(news, reviews, ["NFLX"], skip_null=True)
    assert bag(lenient.where("doc_id = 'news_2'").select("text_content")) == [("h",)]


# metrics

def test_sentiment_fills_months_without_news(spark, rows):
    ratings = rows("symbol string, period string, strongBuy int, buy int, hold int, sell int, strongSell int",
                   ("A", "2024-01-01", 1, 0, 0, 0, 1), ("A", "2024-02-01", 0, 0, 0, 0, 0))
    news = rows("related string, news_date date", ("A", day(0)), ("A", day(30)), ("B", day(0)))
    got = metrics.analyst_sentiment(ratings, metrics.monthly_counts(news, "related", "news_date"))
    assert bag(got.select("period", "mean_recommendation_score", "news_count")) == [("2024-01-01", 3.0, 2), ("2024-02-01", None, 0)]


def test_growth_is_against_the_previous_row(spark, rows):
    estimates = rows("symbol string, date date, revenueAvg double, epsAvg double",
                     ("A", day(0), 100.0, 0.0), ("A", day(900), 150.0, 1.0), ("A", day(1300), 75.0, 2.0))
    got = metrics.forward_growth(estimates).orderBy("date").select("revenue_yoy_growth_pct", "eps_yoy_growth_pct")
    assert got._jdf.queryExecution().executedPlan().toString().count("Window [") == 1
    assert [tuple(r) for r in got.collect()] == [(None, None), (50.0, None), (-50.0, 100.0)]


def test_engagement_has_a_row_per_platform(spark, rows):
    reviews = rows("_show_id bigint, author_details struct<rating: double>", (1, (8.0,)), (1, (None,)), (1, (9.0,)), (2, None))
    shows = rows("show_id bigint, name string, platform string", (1, "A", "p"), (1, "A", "q"), (1, "A", "q"))
    got = metrics.show_engagement(reviews, shows)
    assert bag(got.select("_show_id", "review_count", "avg_rating", "platform")) == [(1, 3, 8.5, "p"), (1, 3, 8.5, "q"), (2, 1, None, None)]


# popularity

def series(rows, *values):
    return rows("brand string, d date, popularity double", *[(b, day(n), float(v)) for b, n, v in values])


def test_cutoffs_pool_brands_and_skip_gaps(spark, rows):
    pop = series(rows, ("a", 0, 50), ("a", 7, 60), ("a", 8, 99), ("b", 0, 50), ("b", 7, 44), ("b", 14, 45), ("c", 3, 1))
    row = popularity.cutoffs(pop, F.lit(T0)).first()
    # changes 10, -6, 1 in order -6, 1, 10
    assert row.n_deltas == 3 and (row.first_d, row.last_d) == (day(0), day(7)) and row.horizon_days == 7
    assert row.fall_below == pytest.approx(-6 + 7 * 2 * 0.333333) and row.rise_above == pytest.approx(1 + 9 * (2 * 0.666667 - 1))
    empty = popularity.cutoffs(pop.limit(0), F.lit(T0)).first()
    assert (empty.n_deltas, empty.fall_below) == (0, None)
    assert bag(popularity.scorable_dates(pop, 7, lit_day(1), lit_day(20))) == [("b", day(7))]


def test_signals_hold_nothing_from_the_future(spark, rows):
    requests = rows("symbol string, as_of date", ("S", day(5)), ("S", day(40)), ("T", day(5)))
    sentiment = rows("symbol string, period string, score double", ("S", "2024-01-01", 1.0), ("S", "2024-02-01", 2.0))
    got = {(r.symbol, r.as_of): r.sentiment for r in popularity.latest_sentiment(requests, sentiment).collect()}
    assert got[("S", day(5))].score == 1.0 and got[("S", day(40))].period == "2024-02-01" and got[("T", day(5))] is None

    ddl = "symbol string, date date, revenueAvg double, _ingested_at timestamp"
    late = dt.datetime(2024, 1, 6, 0, 0, 1)
    estimates = rows(ddl, ("S", day(400), 1.0, dt.datetime(2024, 1, 5)), ("S", day(30), 2.0, dt.datetime(2024, 1, 6, 23, 59)), ("S", day(800), 3.0, late + dt.timedelta(days=1)))
    got = {(r.symbol, r.as_of): r.estimates for r in popularity.latest_estimate(requests, estimates).collect()}
    # The farthest forecast among those loaded by the end of the day.
    assert got[("S", day(5))].revenueAvg == 1.0 and got[("S", day(40))].revenueAvg == 3.0 and got[("T", day(5))] is None
    assert got[("S", day(5))].__fields__ == ["symbol", "date", "revenueAvg", "_ingested_at"]


# retrieval

def brute_force_hybrid(docs, questions, as_of, k):
    def tokens(text):
        return [w for w in re.split(r"[^\w]+", text.lower()) if w]

    docs = [d for d in docs if d["published_date"] <= as_of]
    texts = {d["doc_id"]: tokens(d["text_content"]) for d in docs if d["text_content"] is not None}
    n, mean = len(texts), sum(map(len, texts.values())) / len(texts)
    out = []
    for q in questions:
        cosine = {}
        for d in docs:
            if d["embedding"] is None or not any(d["embedding"]):
                continue
            dot = sum(x * y for x, y in zip(d["embedding"], q["query_vector"]))
            norms = math.sqrt(sum(x * x for x in d["embedding"])) * math.sqrt(sum(x * x for x in q["query_vector"]))
            cosine[d["doc_id"]] = round(dot / norms, 9)
        bm25 = {}
        for word in set(tokens(q["query_text"])):
            df = sum(word in t for t in texts.values())
            for doc, t in texts.items():
                tf = t.count(word)
                if tf:
                    idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
                    bm25[doc] = bm25.get(doc, 0) + idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(t) / mean))
        ranks = []
        for scores in (cosine, {d: round(s, 9) for d, s in bm25.items()}):
            ranks.append({d: i for i, d in enumerate(sorted(scores, key=lambda d: (-scores[d], d)), 1)})
        fused = {d: round(sum(1 / (60 + r[d]) for r in ranks if d in r), 9) for d in {*ranks[0], *ranks[1]}}
        for rank, d in enumerate(sorted(fused, key=lambda d: (-fused[d], d))[:k], 1):
            out.append((q["entity"], d, ranks[0].get(d), ranks[1].get(d), rank))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_hybrid_ranks_are_exact_beyond_the_first_places(spark, rows, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(12)]
    docs = [
        {
            "doc_id": f"d{i:03}",
            "published_date": day(rng.randrange(20)),
            "text_content": None if rng.random() < 0.1 else " ".join(rng.choices(vocabulary, k=rng.randrange(1, 9))),
            "embedding": None if rng.random() < 0.1 else [float(rng.randrange(-2, 3)) for _ in range(4)],
        }
        for i in range(500)
    ]
    questions = [
        {"entity": e, "query_text": f"{rng.choice(vocabulary)}, {rng.choice(vocabulary)}!", "query_vector": [rng.random() for _ in range(4)]}
        for e in ("x", "y")
    ]
    documents = rows("doc_id string, published_date date, text_content string, embedding array<float>",
                     *[(d["doc_id"], d["published_date"], d["text_content"], d["embedding"]) for d in docs])
    asked = rows("entity string, query_text string, query_vector array<double>",
                 *[(q["entity"], q["query_text"], q["query_vector"]) for q in questions])
    got = retrieval.hybrid_top_k(documents, asked, lit_day(15), 5).select("entity", "doc_id", "semantic_rank", "lexical_rank", "rank")
    assert bag(got) == brute_force_hybrid(docs, questions, day(15), 5)


def test_many_questions_read_the_documents_once(spark, rows, monkeypatch):
    monkeypatch.setattr(nearest, "CHUNK", 64)
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(30)]
    questions = [
        {"entity": i, "query_text": rng.choice(vocabulary), "query_vector": [float(rng.randrange(-3, 4)) or 1.0 for _ in range(3)]}
        for i in range(1100)
    ]
    docs = [
        {"doc_id": f"d{i:03}", "published_date": day(rng.randrange(20)), "text_content": " ".join(rng.choices(vocabulary, k=4)),
         "embedding": [float(rng.randrange(-2, 3)) for _ in range(3)]}
        for i in range(150)
    ]
    documents = rows("doc_id string, published_date date, text_content string, embedding array<float>",
                     *[tuple(d.values()) for d in docs])
    asked = rows("entity int, query_text string, query_vector array<double>", *[tuple(q.values()) for q in questions])
    assert retrieval.packed_questions(asked).count() > 10
    got = retrieval.hybrid_top_k(documents, asked, lit_day(15), 3).select("entity", "doc_id", "semantic_rank", "lexical_rank", "rank")
    some = [q for q in questions if q["entity"] % 110 == 0]
    assert bag(got.where("entity % 110 = 0")) == brute_force_hybrid(docs, some, day(15), 3)
    assert got.select("entity").distinct().count() == 1100


def test_lookahead_audit(spark, rows):
    ddl = "symbol string, prediction_date date, source string, variant string, retrieved_doc_ids array<string>"
    predictions = rows(ddl, ("A", day(1), "live", "rag", ["d0", "d5"]), ("A", day(5), "live", "rag", ["d5", "gone"]), ("A", day(5), "live", "no_rag", []))
    corpus = rows("doc_id string, published_date date", ("d0", day(0)), ("d5", day(5)))
    assert bag(retrieval.lookahead_audit(predictions, corpus, ["source"])) == [("live", 3, 4, 1, 1, 1)]


# calls

def test_variants_of_a_run():
    assert calls.planned_variants(False) == ["rag", "no_rag"]
    assert calls.planned_variants(False, "true") == ["rag"]
    assert calls.planned_variants(False, "False", "BIG") == ["no_rag_big"]
    assert calls.planned_variants(True) == ["no_rag"] and calls.planned_variants(True, "false", "big") == ["no_rag_big"]
    for backfill, use_rag, model in ((True, "true", ""), (False, "maybe", ""), (False, "", "huge")):
        with pytest.raises(ValueError):
            calls.planned_variants(backfill, use_rag, model)


def test_prompts(spark, rows):
    known = rows("symbol string, brand string", ("S", "s"), ("T", "t"))
    pop = series(rows, *[("s", n, 50 + n) for n in range(10)])
    plan = calls.live_plan(known, lit_day(9)).unionByName(calls.backfill_plan(known, pop, lit_day(0), lit_day(9)))
    assert bag(plan.where("source = 'backfill'").select("symbol", "as_of", "variant")) == [("S", day(n), "no_rag") for n in range(3)]
    asked = plan.select("symbol", "brand", "as_of").distinct()
    cutoffs = popularity.cutoffs(pop, F.lit(T0))
    sentiment = rows("symbol string, as_of date, sentiment struct<score: double>", ("S", day(9), (None,)))
    estimates = rows("symbol string, as_of date, estimates struct<eps: double>")
    context = rows("symbol string, as_of date, chunks array<struct<doc_id: string, text: string>>", ("S", day(9), [("d1", "x" * 600), ("d2", "short")]))
    got = calls.prompt_rows(plan, popularity.recent_popularity(asked, pop), sentiment, estimates, context, cutoffs)
    prompts = {(r.symbol, r.as_of, r.variant): r for r in got.collect()}
    rag = prompts[("S", day(9), "rag")]
    assert rag.retrieved_doc_ids == ["d1", "d2"]
    assert "<<d1>>\n" + "x" * 500 + "\n<<d2>>\nshort" in rag.prompt and "x" * 501 not in rag.prompt
    assert '"recent":[{"d":"2024-01-04","popularity":53.0}' in rag.prompt
    assert '"sentiment":{"score":null},"estimates":null' in rag.prompt and "more than 7.00" in rag.prompt
    plain = prompts[("S", day(9), "no_rag")]
    assert plain.retrieved_doc_ids == [] and "TEXTS" not in plain.prompt
    longer = calls.prompt_rows(plan, popularity.recent_popularity(asked, pop), sentiment, estimates, context, cutoffs, 600)
    assert longer.where(F.col("prompt").contains("x" * 600)).count() == 1
    assert '"recent":[]' in prompts[("T", day(9), "rag")].prompt
    # Nothing dated after the call is in its prompt.
    assert "2024-01-03" not in prompts[("S", day(1), "no_rag")].prompt


def test_first_reply_that_parses_wins(spark, rows):
    replies = rows("k int, attempt int, reply string", (1, 1, "?"), (1, 2, '{"call": "fall"}'), (2, 2, '{"call": "rise"}'),
                   (2, 1, '{"call": "hold"}'), (3, 1, "?"), (3, 2, None), (4, 3, '{"call": "rise"}'))
    got = {r.k: r.parsed and r.parsed.call for r in calls.first_parsed(replies, ["k"]).collect()}
    assert got == {1: "fall", 2: "hold", 3: None, 4: "rise"}


def test_every_asked_key_gets_one_row(spark, rows):
    key = "symbol string, prediction_date date, source string, variant string"
    asked = rows(f"{key}, retrieved_doc_ids array<string>", *[(s, day(0), "live", "rag", ["d"]) for s in "ABC"])
    replies = rows(f"{key}, attempt int, reply string", *[
        (s, day(0), "live", "rag", n, text)
        for s, n, text in (("A", 1, "?"), ("A", 2, None), ("A", 3, '{"call": "rise"}'), ("B", 1, "?"), ("X", 1, '{"call": "fall"}'))
    ])
    got = {r.symbol: (r.call, r.retrieved_doc_ids, r.model_endpoint) for r in calls.answer_rows(asked, replies, "m", F.lit(T0)).collect()}
    assert got == {"A": ("rise", ["d"], "m"), "B": (None, None, None), "C": (None, None, None)}


# scorecard

def graded(spark, rows, predictions):
    symbols = rows("symbol string, brand string", ("S", "s"))
    pop = series(rows, ("s", 0, 50), ("s", 7, 60), ("s", 14, 60))
    cut = rows("horizon_days int, fall_below double, rise_above double", (7, -5.0, 5.0))
    ddl = "symbol string, prediction_date date, source string, variant string, call string"
    return scorecard.grade(rows(ddl, *predictions), symbols, pop, cut)


def test_grades(spark, rows):
    card = graded(spark, rows, [
        ("S", day(0), "live", "rag", "rise"), ("S", day(7), "live", "rag", "fall"), ("S", day(14), "live", "rag", "hold"),
        ("S", day(3), "live", "rag", "hold"), ("S", day(7), "live", "no_rag", None), ("X", day(0), "live", "rag", "rise"),
    ])
    got = {(r.prediction_date, r.variant): (r.delta, r.actual_move, r.prior_move, r.hit) for r in card.collect()}
    assert got == {
        (day(0), "rag"): (10.0, "rise", None, 1), (day(7), "rag"): (0.0, "hold", "rise", 0),
        (day(14), "rag"): (None, None, "hold", None), (day(3), "rag"): (None, None, None, None),
        (day(7), "no_rag"): (0.0, "hold", "rise", 0),
    }


def test_without_cutoffs_nothing_is_graded(spark, rows):
    symbols, pop = rows("symbol string, brand string", ("S", "s")), series(rows, ("s", 0, 50))
    cut = rows("horizon_days int, fall_below double, rise_above double")
    predictions = rows("symbol string, prediction_date date, source string, variant string, call string", ("S", day(0), "live", "rag", "rise"))
    assert scorecard.grade(predictions, symbols, pop, cut).count() == 0


def test_summary(spark, rows):
    card = graded(spark, rows, [
        ("S", day(0), "live", "rag", "rise"), ("S", day(0), "live", "no_rag", "hold"), ("S", day(7), "live", "rag", "hold"),
        ("S", day(7), "live", "rag_big", "hold"), ("S", day(14), "live", "rag", "hold"),
    ])
    skips = rows("symbol string, prediction_date date, source string, variant string", ("S", day(1), "live", "rag"), ("S", day(1), "backfill", "odd"))
    summary = scorecard.summarise(card, skips, seed="s")
    got = {(r.source, r.model): r for r in summary.collect()}
    assert len(got) == 16  # 2 x 7 declared cells and two that only the data has
    assert (got[("live", "agent_rag")].n, got[("live", "agent_rag")].hits, got[("live", "agent_rag")].skipped) == (2, 2, 1)
    assert got[("live", "agent_rag_big")].n == 1 and got[("backfill", "agent_odd")].skipped == 1
    # Baselines count days, not predictions; persistence only days with a window before them.
    assert [got[("live", m)].n for m in ("always_hold", "always_rise", "persistence", "random")] == [2, 2, 1, 2]
    assert [got[("live", m)].hits for m in ("always_hold", "always_rise", "persistence")] == [1, 1, 0]
    empty = got[("backfill", "always_hold")]
    assert (empty.n, empty.hits, empty.hit_rate, empty.wilson_lo, empty.skipped) == (0, 0, None, None, None)
    assert scorecard.summarise(card, skips, "s", declared_only=True).count() == 14


# quality

def test_rules(spark, rows):
    df = rows("k int, v string", (1, "a"), (1, "b"), (None, None), (None, "z"))
    rules = [quality.RowCount(5), quality.NoNulls(("k", "v")), quality.Allowed("v", ("a", "b", "z")), quality.Unique(("k",))]
    got = {(r.check_name, r.target): (r.status, r.observed) for r in quality.check_table(df, rules).collect()}
    assert got == {
        ("row_count", "*"): ("FAIL", 4.0), ("no_nulls", "k"): ("FAIL", 2.0), ("no_nulls", "v"): ("FAIL", 1.0),
        ("allowed_values", "v"): ("PASS", 0.0), ("unique_key", "k"): ("FAIL", 2.0),
    }
    report = quality.run_suite("s", {"t": (df, rules)})
    with pytest.raises(AssertionError, match="4 check"):
        quality.raise_if_failed(report)
    quality.raise_if_failed(report.where("status = 'PASS'"))
    empty = {r.check_name: r.status for r in quality.check_table(df.limit(0), [quality.RowCount(), quality.Unique(("k",))]).collect()}
    assert empty == {"row_count": "FAIL", "unique_key": "PASS"}


def test_one_table_is_read_once_for_plain_rules(spark, rows):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    rules = [quality.RowCount(), quality.NoNulls(("o_orderkey", "o_custkey")), quality.Allowed("o_orderstatus", ("F", "O", "P"))]
    text = quality.check_table(df, rules)._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "o_totalprice" not in text


def test_freshness(spark, rows):
    now = F.lit(dt.datetime(2024, 1, 2, 18))
    sources = {
        "fresh": (rows("at timestamp", (T0,), (None,)), "at"),
        "stale": (rows("at timestamp", (T0 - dt.timedelta(seconds=1),)), "at"),
        "empty": (rows("at timestamp"), "at"),
    }
    got = {r.source: (r.status, r.age_h) for r in quality.freshness(sources, now).collect()}
    assert got["fresh"] == ("PASS", 36.0) and got["stale"][0] == "FAIL" and got["empty"] == ("FAIL", None)


def test_skip_rate_edges(spark, rows):
    def rate(n_predictions, n_skips, at=0):
        made = spark.range(n_predictions).select(lit_day(at).alias("prediction_date"))
        return quality.skip_rate(made, spark.range(n_skips).select(lit_day(at).alias("prediction_date")), lit_day(7)).first()

    assert rate(8, 2).status == "FAIL" and rate(9, 2).status == "PASS"  # below the limit, not at it
    assert rate(8, 2, at=-1).status == "SKIP" and rate(0, 0).rate is None


def test_collapse_edges(spark, rows):
    def collapse(*counts):
        values = [(v, c, "live", day(0)) for v, c, n in counts for _ in range(n)]
        values.append(("rag", "fall", "backfill", day(0)))
        df = rows("variant string, call string, source string, prediction_date date", *values)
        return {r.variant: (r.top_call, r.status) for r in quality.call_collapse(df, lit_day(14)).collect()}

    assert collapse(("rag", "rise", 18), ("rag", "hold", 2)) == {"rag": ("rise", "PASS")}
    assert collapse(("rag", "rise", 19), ("rag", "hold", 1), ("no_rag", "hold", 19)) == {"rag": ("rise", "FAIL"), "no_rag": ("hold", "SKIP")}
    assert collapse(("rag", "rise", 10), ("rag", "hold", 10)) == {"rag": ("hold", "PASS")}


def test_wilson_in_a_grouped_plan(spark, rows):
    low, _ = wilson_bounds("hits", "n")
    df = rows("hit int", *[(1,)] * 27, *[(0,)] * 57).agg(F.sum("hit").alias("hits"), F.count("*").alias("n"))
    assert df.select(low).first()[0] == pytest.approx(0.231, abs=0.002)
