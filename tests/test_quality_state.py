"""Reports kept up by slices equal those of the whole table, and read only what they must."""

import random
from datetime import date

import pytest
from conftest import bag
from pyspark.sql import functions as F

from gradeline.plans.quality import Allowed, NoNulls, RowCount, Unique, check_table
from gradeline.plans.quality_state import QualityState
from gradeline.sources.tables import Database

RULES = [
    RowCount(5), NoNulls(("a", "b")), Allowed("b", ("x", "y")), Unique(("a",)), Unique(("a", "b")),
]
DDL = "day date, a int, b string"


def state_of(spark, tmp_path, name, whole, asked):
    def read(days):
        asked.append(days)
        return whole().where(F.col("day").isin(days))

    return QualityState(Database(spark, name, str(tmp_path)), "t", RULES, "day", read)


def test_equals_the_whole_table_after_every_load(spark, rows, tmp_path):
    chance = random.Random(3)
    held: dict = {}
    state = state_of(spark, tmp_path, "quality_loads", lambda: rows(DDL, *[r for part in held.values() for r in part]), [])
    for days in ([1, 2], [3], [2], [1, 4]):  # two of them come again with other rows
        for n in days:
            held[n] = [
                (date(2024, 1, n), chance.choice([None, *range(12)]), chance.choice([None, "x", "y", "z"])) for _ in range(8)
            ]
        state.load(rows(DDL, *[r for n in days for r in held[n]]))
        assert bag(state.report()) == bag(check_table(rows(DDL, *[r for part in held.values() for r in part]), RULES))


def test_reads_nothing_but_the_slice_without_suspicion(spark, rows, tmp_path):
    asked: list = []
    held: list = []
    state = state_of(spark, tmp_path, "quality_reads", lambda: rows(DDL, *held), asked)
    for n in (1, 2, 3):
        fresh = [(date(2024, 1, n), 10 * n + i, "x") for i in range(3)]
        held += fresh
        assert state.load(rows(DDL, *fresh)) == []
    assert asked == []
    again = [(date(2024, 1, 4), 10, "x")]
    held += again
    assert state.load(rows(DDL, *again)) == [date(2024, 1, 1), date(2024, 1, 4)]
    assert asked == [[date(2024, 1, 1), date(2024, 1, 4)]]  # the day that has the key, not the others
    observed = {(r["check_name"], r["target"]): r["observed"] for r in state.report().collect()}
    assert (observed["row_count", "*"], observed["unique_key", "a"], observed["unique_key", "a,b"]) == (10.0, 1.0, 1.0)


def test_equal_hashes_of_unequal_keys_are_no_duplicates(spark, rows, tmp_path):
    """NULLs leave no trace in the hash, so (NULL, 'x') and ('x', NULL) are suspected of being equal."""
    held = [(1, None, "x"), (2, "x", None)]
    asked: list = []
    state = QualityState(
        Database(spark, "quality_hashes", str(tmp_path)), "t", [Unique(("a", "b"))], "load",
        lambda loads: asked.append(loads) or rows("load bigint, a string, b string", *held),
    )
    for row in held:
        state.load(rows("load bigint, a string, b string", row))
    assert asked == [[1, 2]]
    assert [(r["status"], r["observed"]) for r in state.report().collect()] == [("PASS", 0.0)]


def test_empty_loads_and_refused_slices(spark, rows, tmp_path):
    state = state_of(spark, tmp_path, "quality_odd", lambda: rows(DDL, (date(2024, 1, 1), 1, "x")), [])
    assert state.load(rows(DDL, (date(2024, 1, 1), 1, "x"))) == []
    before = bag(state.report())
    assert state.load(rows(DDL, (None, 1, "x")).where("day IS NOT NULL")) == []
    with pytest.raises(ValueError, match="belongs to no slice"):
        state.load(rows(DDL, (None, 1, "x")))
    with pytest.raises(TypeError, match="slices are dates"):
        state.load(rows("day string, a int, b string", ("2024-01-01", 1, "x")))
    assert bag(state.report()) == before
