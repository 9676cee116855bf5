"""As-of lookups by stretches: the rows of the plain ones, wherever ranges are cut."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import bag
from pyspark.sql import functions as F

from gradeline.operators.asof import latest_as_of, timeline, trailing_as_of
from gradeline.operators.stretches import latest_in_stretches, stretched, trailing_in_stretches

FACTS, ASKED = "e string, at timestamp_ntz, v int, w string", "e string, asked timestamp_ntz"


@pytest.fixture
def case(rows):
    rng = random.Random(3)
    start = datetime(2024, 1, 1)
    moment = lambda: start + timedelta(microseconds=rng.randrange(5000))
    # "hot" has two thirds of all rows, "quiet" has facts only before many stretches of requests, "late" none at first.
    entity = lambda: rng.choice(["hot"] * 8 + ["a", "b", None, "c"])
    facts = [(entity(), moment(), n, rng.choice(["x", None])) for n in range(400)]
    facts += [("quiet", start, 1, "q"), ("late", start + timedelta(seconds=1), 2, None), ("hot", None, 9, "never"), (None, None, 9, "never")]
    asked = [(entity(), moment()) for _ in range(300)] + [("quiet", moment()) for _ in range(100)]
    asked += [("late", start), ("nobody", start), ("hot", None), (None, None), (None, start)] + [("hot", start)] * 3
    return rows(FACTS, *facts), rows(ASKED, *asked)


@pytest.mark.parametrize("stretches", [1, 7, 40, None])
def test_latest(case, stretches):
    facts, asked = case
    how = ("e", "asked", "at", ["v", "w"], ["v"])
    found = latest_in_stretches(asked, facts, *how, stretches=stretches)
    assert bag(found) == bag(latest_as_of(asked, facts, *how))
    known = {}
    for e, at, v, w in facts.collect():
        if at is not None:
            known.setdefault(e, []).append((at, v, w))
    for e, t, at, v, w in found.collect():
        before = [f for f in known.get(e, ()) if t is not None and f[0] <= t]
        assert (at, v) == (max(before, key=lambda f: f[:2])[:2] if before else (None, None))


@pytest.mark.parametrize("stretches", [1, 40])
@pytest.mark.parametrize("n", [1, 4, 1000])
def test_trailing(case, n, stretches):
    facts, asked = case
    facts = facts.dropDuplicates(["e", "at"])
    facts = facts.withColumn("v", F.xxhash64("e", "at"))
    how = ("e", "asked", "at", ["v"], n, "recent")
    assert bag(trailing_in_stretches(asked, facts, *how, stretches=stretches)) == bag(trailing_as_of(asked, facts, *how))


def test_nothing_to_ask_or_to_find(case):
    facts, asked = case
    how = ("e", "asked", "at", ["v"])
    assert latest_in_stretches(asked.limit(0), facts, *how).count() == 0
    assert {r.v for r in latest_in_stretches(asked, facts.limit(0), *how).collect()} == {None}
    assert {len(r.recent) for r in trailing_in_stretches(asked, facts.limit(0), *how, 3, "recent").collect()} == {0}


def test_a_hot_entity_is_cut(case):
    facts, asked = case
    line = stretched(timeline(asked, facts, "e", "asked", "at", ["v", "w"], ["v"]), 20)
    sizes = line.groupBy("_stretch").count().collect()
    hot = line.where("_entity = 'hot'").select("_stretch").distinct().count()
    assert hot >= 8 and max(r["count"] for r in sizes) < line.count() / 5
    times = line.groupBy("_entity", "_stretch").agg(F.min("_at").alias("first"), F.max("_at").alias("last")).where("_entity = 'hot'")
    ordered = [(r["first"], r["last"]) for r in times.orderBy("_stretch").collect() if r["first"]]
    assert all(a[1] <= b[0] for a, b in zip(ordered, ordered[1:]))
