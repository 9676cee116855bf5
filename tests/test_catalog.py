"""Every registered query beside its SQL, and the shape of the plans."""

import importlib
import re

import pytest
from compare import connect, differences
from conftest import SF_DIR

from gradeline import catalog

entry_module = importlib.import_module("__spark_entry__")
QUERIES, ORACLES = catalog.queries(), catalog.oracles()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in ORACLES:
        n, notes = differences(df, duck, ORACLES[name])
        assert not notes
    else:
        n = df.count()
    assert n > 0


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["source", "model", "n", "hits", "hit_rate", "wilson_lo", "wilson_hi", "skipped"]
    assert df.count() == 14
    assert entry_module.queries().keys() >= QUERIES.keys() and entry_module.oracle_sql().items() >= ORACLES.items()


def test_texts_and_dates_are_the_only_date_types(spark):
    for name in ("q01_json_typed_scan", "q08_rank_history", "q20_cutoffs"):
        assert not {t for _, t in QUERIES[name](spark, SF_DIR).dtypes} & {"date", "timestamp", "timestamp_ntz"}


PLANNED = [
    "q06_upsert", "q08b_replace_slice", "q09_latest_per_key", "q11_weighted_sentiment", "q15_engagement",
    "q18_snapshot_diff", "q20b_offset_join", "q21_signals_topk", "q21a_latest_asof", "q21c_signal_pack", "q22_scorecard",
    "q23_scorecard_summary", "q25_quality_report", "q28_call_collapse", "q30_parse_replies",
]


@pytest.mark.parametrize("name", PLANNED)
def test_plans_have_no_cross_join_and_no_python(spark, name):
    text = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Cartesian|NestedLoop|Python|MapInPandas|ExistingRDD", text)


def test_scans_read_only_the_columns_in_use(spark):
    text = QUERIES["q25d_duplicate_keys"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in text
    text = QUERIES["q11_weighted_sentiment"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(l_returnflag, [A,R])" in text
