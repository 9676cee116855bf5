import datetime as dt
import math

import pytest
from conftest import bag
from pyspark.sql import functions as F

from gradeline.functions.dates import age_hours, epoch_date, month_key
from gradeline.functions.picks import digest_index, hashed_index, pick
from gradeline.functions.replies import parse_reply
from gradeline.functions.scores import classify_move, growth_pct, rank_score, weighted_mean, wilson_bounds
from gradeline.functions.text import joined, normalised, words
from gradeline.functions.vectors import cosine, length


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


# reply, then (call, confidence, reasoning) or None
REPLIES = [
    ('{"reasoning": "two weeks of gains", "call": "Rise", "confidence": "medium"}', ("rise", "medium", "two weeks of gains")),
    ('Thinking it over...\n\n{"confidence": "high",\n "call": "FALL"} -- that is all', ("fall", "high", "")),
    ('{"call": "sideways", "confidence": "medium"}', None),
    (None, None),
    ("", None),
    ("no braces", None),
    ('{"call": " Fall\\n"}', ("fall", "low", "")),
    ('{"signals": {"a": 1}, "call": "rise"}', ("rise", "low", "")),
    ('{"call": "rise"} and {"call": "fall"}', ("rise", "low", "")),
    ('{"call": "buy"} and {"call": "fall"}', None),
    ("{'call': 'rise'}", None),
    ('{"call": "rise"', None),
    ('{"call": "rise", "confidence": null}', ("rise", None, "")),
    ('{"call": "hold", "reasoning": "a } in text"}', ("hold", "low", "a } in text")),
    ('{"call": ["rise"]}', None),
    ('{"call": "rise",}', None),
    ('{"note": "x"}', None),
    ("{}", None),
    ('{"call": "hold"}\n{"call": "rise"', ("hold", "low", "")),
]


@pytest.mark.parametrize("at", range(len(REPLIES)))
def test_reply(spark, at):
    text, expected = REPLIES[at]
    got = one(spark, parse_reply(F.lit(text).cast("string")).alias("r")).r
    assert (None if got is None else tuple(got)) == expected


def test_reply_column_matches_literals(spark, rows):
    df = rows("i int, reply string", *[(i, r) for i, (r, _) in enumerate(REPLIES)])
    got = {r.i: None if r.p is None else tuple(r.p) for r in df.select("i", parse_reply("reply").alias("p")).collect()}
    assert got == {i: expected for i, (_, expected) in enumerate(REPLIES)}


# hits, n, interval in percent
INTERVALS = [(30, 120, 18.1, 33.4), (8, 40, 10.5, 34.8), (50, 100, 40.4, 59.6), (1, 10, 1.8, 40.4), (63, 70, 80.8, 95.1)]


@pytest.mark.parametrize("hits,n,low,high", INTERVALS)
def test_wilson_intervals(spark, hits, n, low, high):
    got = one(spark, *wilson_bounds(F.lit(hits), F.lit(n)))
    assert (round(got[0] * 100, 1), round(got[1] * 100, 1)) == (low, high)


def test_wilson_without_trials_is_null(spark):
    assert tuple(one(spark, *wilson_bounds(F.lit(0), F.lit(0)))) == (None, None)


def test_wilson_contains_the_rate(spark, rows):
    pairs = [(hits, n) for n in (1, 2, 3, 10, 97, 10_000) for hits in {0, 1, n // 2, n}]
    low, high = wilson_bounds("hits", "n")
    for r in rows("hits int, n int", *pairs).select("hits", "n", low.alias("lo"), high.alias("hi")).collect():
        assert -1e-12 <= r.lo <= r.hits / r.n + 1e-12 and r.hits / r.n - 1e-12 <= r.hi <= 1 + 1e-12


def test_weighted_mean(spark, rows):
    df = rows("a int, b int, c int", (1, 0, 1), (0, 0, 0), (None, 1, 1))
    assert [r[0] for r in df.select(weighted_mean(["a", "b", "c"])).collect()] == [2.0, None, None]


def test_weighted_mean_does_not_overflow(spark, rows):
    big = 2**31 - 1
    assert rows("a int, b int", (big, big)).select(weighted_mean(["a", "b"])).first()[0] == 1.5


def test_growth_edges(spark, rows):
    df = rows("now double, before double", (110.0, 100.0), (1.0, 0.0), (1.0, None), (-5.0, -10.0), (1.0, 3.0))
    assert [r[0] for r in df.select(growth_pct("now", "before")).collect()] == [10.0, None, None, -50.0, -66.67]


def test_classes_have_strict_edges(spark, rows):
    df = rows("d double", (5.0,), (5.1,), (-8.33,), (-8.4,), (0.0,), (None,))
    got = [r[0] for r in df.select(classify_move("d", F.lit(-8.33), F.lit(5.0))).collect()]
    assert got == ["hold", "rise", "hold", "fall", "hold", None]


def test_rank_score(spark, rows):
    assert [r[0] for r in rows("r int", (1,), (100,)).select(rank_score("r")).collect()] == [100.0, 1.0]


def test_dates_do_not_follow_the_session_time_zone(spark):
    late = F.lit(1704067200 + 86399)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert one(spark, epoch_date(late))[0] == dt.date(2024, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert one(spark, epoch_date(F.lit(-1)))[0] == dt.date(1969, 12, 31)
    assert one(spark, month_key(F.lit("2024-02-29").cast("date")))[0] == "2024-02-01"


def test_age_in_hours(spark):
    def at(text):
        return F.lit(text).cast("timestamp")

    assert one(spark, age_hours(at("2024-01-01 12:30:00"), at("2024-01-02 00:00:00")))[0] == 11.5


def test_words_and_text(spark):
    got = one(
        spark, words(F.lit(" Été du--soir 12! ")).alias("w"), words(F.lit(None).cast("string")).alias("n"),
        normalised(F.lit("\n Rise\t")).alias("s"),
        joined([F.lit("a"), F.lit(None).cast("string")], ". ").alias("strict"),
        joined([F.lit("a"), F.lit(None).cast("string")], ". ", skip_null=True).alias("lenient"),
    )
    assert (got.w, got.n, got.s, got.strict, got.lenient) == (["été", "du", "soir", "12"], [], "rise", None, "a")


def test_picks_are_seeded_and_even(spark):
    base = spark.range(30_000).withColumn("d", F.lit("2024-01-01").cast("date"))
    for index in (hashed_index(["id", "d"], "s", 3), digest_index(["id", "d"], 3)):
        drawn = base.select(pick(("rise", "hold", "fall"), index).alias("c"))
        counts = {r.c: r["count"] for r in drawn.groupBy("c").count().collect()}
        assert set(counts) == {"rise", "hold", "fall"} and min(counts.values()) > 9_500
        assert bag(drawn.limit(100)) == bag(drawn.limit(100))


def test_cosine(spark, rows):
    df = rows("a array<double>, b array<double>", ([1.0, 0.0], [1.0, 1.0]), ([3.0, 4.0], [3.0, 4.0]))
    got = [r[0] for r in df.select(cosine(F.col("a"), length(F.col("a")), F.col("b"), length(F.col("b")))).collect()]
    assert got == pytest.approx([1 / math.sqrt(2), 1.0])
