import datetime as dt
import random

import pytest
from conftest import bag
from pyspark.sql import functions as F

from gradeline.operators.asof import latest_as_of, trailing_as_of
from gradeline.operators.diff import snapshot_diff, sync_gate
from gradeline.operators.latest import latest_per_key, newest_day
from gradeline.operators.literals import empty_table, literal_rows
from gradeline.operators.merge import (
    add_missing_columns, append_evolving, delete_keys, replace_slice, upsert,
)
from gradeline.operators.offsets import offset_values
from gradeline.operators.percentiles import percentile_table, value_counts, weighted_percentiles
from gradeline.operators.topk import as_of_top_k, top_k

START = dt.date(2024, 1, 1)


def day(n):
    return START + dt.timedelta(days=n)


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_settles_ties_the_same_way(spark, rows):
    data = [("a", 1, "x", {"k": 1}), ("a", 1, "z", {"k": 1}), ("a", 1, "y", None), ("b", None, "q", None)]
    forward = latest_per_key(rows("k string, at int, v string, m map<string,int>", *data), ["k"], ["at"])
    backward = latest_per_key(rows("k string, at int, v string, m map<string,int>", *data[::-1]), ["k"], ["at"])
    assert [(r.k, r.v) for r in forward.orderBy("k").collect()] == [("a", "z"), ("b", "q")]
    assert bag(forward.select("k", "v")) == bag(backward.select("k", "v"))


def test_latest_drops_rows_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("at"))
    text = plan_text(latest_per_key(df, ["k"], ["at"]))
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_newest_day_stays_in_the_plan(spark, rows):
    df = rows("k int, d date", (1, day(0)), (2, day(3)), (3, day(3)), (4, None))
    assert bag(newest_day(df, "d").select("k")) == [(2,), (3,)]
    assert newest_day(df.limit(0), "d").count() == 0
    timed = rows("k int, t timestamp", (1, dt.datetime(2024, 1, 1, 9)), (2, dt.datetime(2024, 1, 2)), (3, dt.datetime(2024, 1, 2, 23, 59)), (4, None))
    assert bag(newest_day(timed, "t", of_moment=True).select("k")) == [(2,), (3,)]
    assert newest_day(timed.limit(0), "t", of_moment=True).count() == 0


def test_upsert_replaces_inserts_and_keeps(spark, rows):
    target = rows("k int, v string", (1, "a"), (2, "b"), (None, "n"))
    source = rows("k int, v string", (2, "B"), (3, "c"), (None, "N"))
    once = upsert(target, source, ["k"])
    # NULL keys match nothing: the row is kept and the new one inserted.
    assert bag(once) == [(1, "a"), (2, "B"), (3, "c"), (None, "N"), (None, "n")]
    keyed = source.where("k is not null")
    assert bag(upsert(upsert(target, keyed, ["k"]), keyed, ["k"])) == bag(upsert(target, keyed, ["k"]))


def test_upsert_with_repeated_source_keys(spark, rows):
    target = rows("k int, at int, v string", (1, 0, "a"))
    source = rows("k int, at int, v string", (1, 1, "b"), (1, 2, "c"))
    with pytest.raises(Exception, match="two source rows match"):
        upsert(target, source, ["k"]).collect()
    assert bag(upsert(target, source, ["k"], ["at"])) == [(1, 2, "c")]


def test_upsert_adds_columns(spark, rows):
    merged = upsert(rows("k int, v string", (1, "a"), (2, "b")), rows("k int, w int", (2, 7)), ["k"])
    assert bag(merged) == [(1, "a", None), (2, None, 7)]


def test_delete_and_replace_slice(spark, rows):
    target = rows("k int, d date", (1, day(0)), (2, day(1)), (3, None))
    assert bag(delete_keys(target, rows("k int", (2,), (2,), (9,)), ["k"])) == [(1, day(0)), (3, None)]
    batch = rows("k int, d date", (7, day(1)))
    once = replace_slice(target, batch, "d", F.lit(day(1)))
    assert bag(once) == [(1, day(0)), (3, None), (7, day(1))]
    assert bag(replace_slice(once, batch, "d", F.lit(day(1)))) == bag(once)


def test_evolving_columns(spark, rows):
    grown = append_evolving(rows("k int", (1,)), rows("k int, v string", (2, "b")))
    assert bag(grown) == [(1, None), (2, "b")]
    assert add_missing_columns(grown, {"v": "string", "w": "date"}).columns == ["k", "v", "w"]


def test_literals(spark):
    pairs = literal_rows(spark, [("a", 1), ("b", None)], "name string, n int")
    assert bag(pairs) == [("a", 1), ("b", None)]
    assert "Broadcast" in plan_text(spark.range(10).join(pairs, F.col("id") == F.col("n")))
    assert literal_rows(spark, [], "name string, n int").columns == ["name", "n"]
    assert empty_table(spark, "a array<string>, t timestamp").count() == 0
    many = literal_rows(spark, [(f"n{i}", i) for i in range(1001)], "name string, n int")
    assert many.count() == 1001 and "ResolvedHint" not in many._jdf.queryExecution().analyzed().toString()


def test_diff_sees_moves_of_nulls_and_copies(spark, rows):
    ddl = "k int, a string, b string"
    old = rows(ddl, (1, "x", None), (2, "same", "same"), (3, "gone", None), (4, "c", "c"), (4, "c", "c"), (None, "n", None))
    new = rows(ddl, (1, None, "x"), (2, "same", "same"), (4, "c", "c"), (5, "new", None), (None, "n", None))
    changes = snapshot_diff(old, new, ["k"], ["a", "b"])
    assert bag(changes) == [(1, "update"), (3, "delete"), (4, "update"), (5, "insert")]
    assert not sync_gate(old, new, ["k"], ["a", "b"]).first().in_sync
    gate = sync_gate(new, new.orderBy(F.rand()), ["k"], ["a", "b"]).first()
    assert (gate.n_old, gate.n_new, gate.in_sync) == (5, 5, True)
    assert sync_gate(old.limit(0), new.limit(0), ["k"], ["a", "b"]).first().in_sync


def random_facts(rng, entities=4, days=40, per_day=2):
    return [
        (f"e{rng.randrange(entities)}", day(rng.randrange(days)), i, round(rng.random(), 3))
        for i in range(entities * days * per_day // 3)
    ]


def test_latest_as_of_against_brute_force(spark, rows):
    rng = random.Random(1)
    facts = random_facts(rng)
    requests = [(f"e{rng.randrange(5)}", day(rng.randrange(-3, 45))) for _ in range(60)]
    got = latest_as_of(
        rows("e string, as_of date", *requests), rows("e string, d date, id int, v double", *facts),
        "e", "as_of", "d", ["id", "v"], ["id"],
    )
    expected = []
    for e, at in set(requests):
        known = [(d, i, v) for f, d, i, v in facts if f == e and d <= at]
        expected.append((e, at, *(max(known) if known else (None, None, None))))
    assert bag(got) == sorted(expected, key=str)
    assert "Join" not in plan_text(got)


def test_trailing_as_of_against_brute_force(spark, rows):
    rng = random.Random(2)
    facts = sorted({(e, d): (e, d, v) for e, d, _, v in random_facts(rng)}.values())
    requests = [(f"e{rng.randrange(5)}", day(rng.randrange(-3, 45))) for _ in range(60)]
    got = trailing_as_of(
        rows("e string, as_of date", *requests), rows("e string, d date, v double", *facts), "e", "as_of", "d", ["v"], 7, "recent"
    )
    expected = {
        (e, at): [(d, v) for f, d, v in facts if f == e and d <= at][-7:] for e, at in requests
    }
    assert {(r.e, r.as_of): [tuple(x) for x in r.recent] for r in got.collect()} == expected


def test_offsets_follow_the_calendar(spark, rows):
    # Day 8 is missing: a row offset would pair day 1 with the wrong day.
    series = rows("b string, d date, v double", ("x", day(0), 10.0), ("x", day(1), 11.0), ("x", day(7), 20.0), ("y", day(7), 5.0))
    got = {(r.b, r.d): (r.value_then, r.value_future, r.value_prior) for r in offset_values(series, "b", "d", "v", F.lit(7)).collect()}
    assert got[("x", day(0))] == (10.0, 20.0, None)
    assert got[("x", day(1))] == (11.0, None, None)
    assert got[("x", day(7))] == (20.0, None, 10.0)
    assert got[("y", day(7))] == (5.0, None, None)
    assert got[("x", day(8))] == (None, None, 11.0)


def test_percentiles_interpolate(spark, rows):
    counted = value_counts(rows("v double", *[(float(v),) for v in (1, 2, 2, 10, 4)], (None,)), "v")
    low, high = weighted_percentiles("v", "n", (1 / 3, 0.5))
    assert tuple(counted.agg(low, high).first()) == pytest.approx((2.0, 2.0))
    even = value_counts(rows("v double", (1.0,), (2.0,)), "v")
    assert even.agg(*weighted_percentiles("v", "n", (0.25,))).first()[0] == pytest.approx(1.25)


@pytest.mark.parametrize("parts", [None, 1, 20])
def test_percentile_table_is_exact(spark, rows, parts):
    rng = random.Random(5)
    # A third of the values is the same one.
    values = [7.5 if rng.random() < 0.34 else rng.choice([-1e9, 1e9, rng.random() * 100]) for _ in range(1001)] + [0.25]
    probabilities = (0.0, 0.1, 1 / 3, 0.5, 2 / 3, 0.999, 1.0)
    got = percentile_table(rows("v double", *[(v,) for v in values], (None,)), "v", probabilities, parts)
    ordered, expected = sorted(values), {}
    for p in probabilities:
        at = p * (len(values) - 1)
        low, high = ordered[int(at)], ordered[min(int(at) + 1, len(values) - 1)]
        expected[p] = low + (high - low) * (at - int(at))
    assert {r.p: r.percentile for r in got.collect()} == pytest.approx(expected)


def test_top_k_in_parts_is_the_same(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), "id", F.pmod(F.hash("id"), F.lit(50)).alias("score"))
    order = [F.col("score").desc(), F.col("id")]
    assert bag(top_k(df, ["g"], order, 9)) == bag(top_k(df, ["g"], order, 9, spread_by="id", spread=8))


def test_as_of_top_k_at_the_ends_of_the_calendar(spark, rows):
    first, old, last = dt.date(1, 1, 1), dt.date(1899, 12, 31), dt.date(9999, 12, 31)
    candidates = rows("g string, d date, id int, score int", ("a", first, 1, 5), ("a", old, 2, 9), ("a", last, 3, 7))
    requests = rows("g string, as_of date", *[("a", d) for d in (first, old, dt.date(2024, 1, 5), last)])
    got = as_of_top_k(candidates, requests, "g", "d", "as_of", [F.col("score").desc(), F.col("id")], 2)
    found = {}
    for r in got.orderBy("as_of", "rank").collect():
        found.setdefault(r.as_of, []).append(r.id)
    assert found == {first: [1], old: [2, 1], dt.date(2024, 1, 5): [2, 1], last: [2, 3]}


def test_as_of_top_k_against_brute_force(spark, rows):
    rng = random.Random(3)
    # One group holds most of the rows.
    candidates = [
        ("hot" if rng.random() < 0.7 else rng.choice("ab"), day(rng.randrange(-400, 400)), i, rng.randrange(30))
        for i in range(900)
    ]
    requests = [(g, day(rng.randrange(-450, 450))) for g in ("hot", "a", "b", "none") for _ in range(25)]
    got = as_of_top_k(
        rows("g string, d date, id int, score int", *candidates), rows("g string, as_of date", *requests),
        "g", "d", "as_of", [F.col("score").desc(), F.col("id")], 5,
    )
    expected = []
    for g, at in set(requests):
        best = sorted((-s, i, d) for h, d, i, s in candidates if h == g and d <= at)[:5]
        expected += [(g, at, d, i, -s, rank) for rank, (s, i, d) in enumerate(best, 1)]
    assert bag(got.select("g", "as_of", "d", "id", "score", "rank")) == sorted(expected, key=str)
    text = plan_text(got)
    assert "Cartesian" not in text and "NestedLoop" not in text
