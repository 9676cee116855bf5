"""Percentile sketches: merged from slices, replaced by slice, against exact percentiles."""

import math
from datetime import date

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from gradeline.operators.percentiles import percentile_table
from gradeline.operators.sketches import StoredSketches, approximate_percentile_table, percentiles, rank_error, slice_sketches
from gradeline.sources.tables import Database

ASKED = (0.01, 1 / 3, 0.5, 2 / 3, 0.99)


def shares(df, value, answer):
    """Shares of the rows below the answer, and up to it."""
    return df.agg(F.avg((F.col(value) < answer).cast("int")), F.avg((F.col(value) <= answer).cast("int"))).first()


@pytest.mark.parametrize("k", [200, 1600])
def test_within_the_stated_error_of_the_exact_percentiles(spark, k):
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    exact = {r["p"]: r["percentile"] for r in percentile_table(lines, "l_extendedprice", ASKED).collect()}
    off = 2 * rank_error(k)
    for p, answer in approximate_percentile_table(lines, "l_extendedprice", ASKED, k).collect():
        below, up_to = shares(lines, "l_extendedprice", answer)
        assert p - off <= up_to and below <= p + off
        low, high = (shares(lines, "l_extendedprice", x)[i] for x, i in ((min(answer, exact[p]), 1), (max(answer, exact[p]), 0)))
        assert high - low <= off  # so few rows lie between the two answers


def test_ranges_of_slices(spark, rows, tmp_path):
    db = Database(spark, "sketch_ranges", str(tmp_path))
    stored = StoredSketches(db, "prices", "d", "v", k=8)
    days = [date(2024, 1, n) for n in range(1, 5)]
    stored.load(rows("d date, v double", (days[0], 1.0), (days[0], None), (days[1], 5.0), (days[1], float("nan")), (days[2], None)))
    stored.load(rows("d date, v double", (days[1], 7.0), (days[1], 9.0), (days[3], -2.0)))  # the second day comes again
    ranges = rows(
        "name string, a date, b date", ("all", days[0], days[3]), ("all", days[0], days[3]), ("middle", days[1], days[2]),
        ("third", days[2], days[2]), ("none", date(2025, 1, 1), date(2026, 1, 1)), ("open", None, days[1]), (None, days[0], days[0]),
    )
    found = stored.over(ranges, "a", "b").select("name", "n", percentiles("sketch", (0, 1)).alias("ends")).collect()
    assert {r["name"]: (r["n"], r["ends"]) for r in found} == {
        "all": (4, [-2.0, 9.0]), "middle": (2, [7.0, 9.0]), "third": (0, None), "none": (None, None), "open": (None, None),
        None: (1, [1.0, 1.0]),
    }
    with pytest.raises(ValueError, match="no partition"):
        stored.load(rows("d date, v double", (None, 1.0)))


def test_empty_and_single(spark, rows):
    nothing = rows("v double", (1.0,)).where("v < 0")
    assert approximate_percentile_table(nothing, "v", (0.5,)).collect() == []
    assert approximate_percentile_table(rows("v int", (3,)), "v", (0.0, 0.5, 1.0)).collect() == [(0.0, 3.0), (0.5, 3.0), (1.0, 3.0)]
    assert math.isclose(rank_error(200), 0.0133, abs_tol=1e-4)


def test_rows_combine_before_the_shuffle(spark):
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    plan = slice_sketches(lines, "l_shipdate", "l_tax")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_kll_sketch_agg_double" in plan
