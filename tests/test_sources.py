import datetime as dt
import json

import pytest
from conftest import bag
from pyspark.sql import functions as F

from gradeline.session import shared_folder
from gradeline.sources import schemas
from gradeline.sources.landing import read_records, stamp, unnest, unnest_ranked, write_documents
from gradeline.sources.tables import Database, GuardedRefresh, append_rows, keep, read_table, replace_partitions
from gradeline.streaming.ticks import land_ticks, merge_ticks, read_ticks

NOW = dt.datetime(2024, 2, 1, 7)


def test_shared_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first.startswith(base) and first != second


def test_pretty_files_are_read_through_a_wildcard(spark, tmp_path):
    for symbol in ("AAA", "BBB"):
        rows = [{"symbol": symbol, "period": "2024-01-01", "buy": 3, "extra": 1, "_fetched_at": "2024-01-02T03:04:05"}]
        (tmp_path / f"trends_{symbol}.json").write_text(json.dumps(rows * 2, indent=2))
    (tmp_path / "other.json").write_text("[]")
    df = stamp(read_records(spark, f"{tmp_path}/trends_*.json", schemas.RECOMMENDATIONS), F.lit(NOW))
    got = df.select("symbol", "buy", "sell", "_fetched_at", "_ingested_at").distinct()
    assert bag(got) == [(s, 3, None, dt.datetime(2024, 1, 2, 3, 4, 5), NOW) for s in ("AAA", "BBB")]
    assert df.count() == 4 and "extra" not in df.columns


def test_envelopes(spark, tmp_path):
    chart = {"feed": {"country": "us", "results": [{"id": "9", "name": "n", "genres": ["g"]}, {"id": "3"}]}, "_fetched_at": "2024-01-02T00:00:00"}
    (tmp_path / "chart_us.json").write_text(json.dumps(chart, indent=2))
    (tmp_path / "chart_de.json").write_text(json.dumps({"feed": {"country": "de", "results": []}}))
    files = read_records(spark, f"{tmp_path}/chart_*.json", schemas.APP_CHART)
    ranked = unnest_ranked(files, "feed.results", [F.col("feed.country").alias("_storefront"), "_fetched_at"])
    got = ranked.select("_storefront", "_rank", "id", "genres", "_fetched_at").orderBy("_rank").collect()
    at = dt.datetime(2024, 1, 2)
    assert [tuple(r) for r in got] == [("us", 1, "9", ["g"], at), ("us", 2, "3", None, at)]

    provider = {"results": [{"provider_id": 8, "display_priorities": {"US": 1}}], "_fetched_at": "2024-01-02T00:00:00"}
    (tmp_path / "providers.json").write_text(json.dumps(provider, indent=2))
    rows = unnest(read_records(spark, f"{tmp_path}/providers.json", schemas.PROVIDER_LIST), "results", ["_fetched_at"])
    assert rows.select("provider_id", "display_priorities").first() == (8, {"US": 1})


def test_documents_land_in_bounded_files(spark, tmp_path):
    df = spark.range(25).withColumn("text", F.lit('a "quoted"\nline'))
    write_documents(df, f"{tmp_path}/out", F.floor(F.col("id") / 10))
    files = list((tmp_path / "out").glob("batch=*/*.txt"))
    assert len(files) == 3
    assert sorted(len(json.loads(f.read_text())) for f in files) == [5, 10, 10]
    assert bag(read_records(spark, f"{tmp_path}/out/batch=*/*.txt", "id bigint, text string")) == bag(df)


def test_append_and_partitions(spark, rows, tmp_path):
    path = f"{tmp_path}/t"
    append_rows(rows("k int", (1,)), path)
    append_rows(rows("k int, v string", (2, "b")), path)
    assert bag(read_table(spark, path).select("k", "v")) == [(1, None), (2, "b")]

    path = f"{tmp_path}/p"
    replace_partitions(rows("k int, d string", (1, "a"), (2, "b")), path, ["d"])
    for _ in range(2):
        replace_partitions(rows("k int, d string", (3, "b")), path, ["d"])
    assert bag(spark.read.parquet(path)) == [(1, "a"), (3, "b")]


def test_keep_has_a_known_size(spark):
    kept = keep(spark.range(100), "kept")
    assert bag(kept) == [(i,) for i in sorted(range(100), key=lambda i: str((i,)))]
    joined = spark.range(10**7).join(kept.where("id % 2 = 0"), "id")
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()


def test_guarded_refresh_fails_once_at_the_end(spark, rows):
    stored = {}
    refresh = GuardedRefresh(lambda name, df: stored.__setitem__(name, df.count()))
    full = rows("k int", (1,))
    assert refresh.load("a", full) and not refresh.load("b", full.limit(0)) and refresh.load("c", full)
    assert not refresh.load("d", full.limit(0))
    assert stored == {"a": 1, "c": 1}
    with pytest.raises(RuntimeError, match="b, d"):
        refresh.finish()


def test_database(spark, rows, tmp_path):
    db = Database(spark, "unit_db", str(tmp_path))
    db.replace("t", rows("k int, v string", (1, "a"), (2, "b")))
    # A table may be replaced by something computed from it.
    db.replace("t", db.table("t").where("k > 1"))
    assert bag(db.table("t")) == [(2, "b")]
    db.append("t", rows("v string, k int, w int", ("c", 3, 9)))
    assert bag(db.table("t")) == [(2, "b", None), (3, "c", 9)]
    db.replace("t", rows("other double", (1.5,)))
    assert db.table("t").columns == ["other"]

    made = []
    for value in (1, 2):
        frozen = db.freeze("once", lambda v=value: made.append(v) or rows("v int", (v,)))
    assert made == [1] and bag(frozen) == [(1,)]

    db.create_if_absent("h", schemas.RANK_HISTORY, "snapshot_date")
    db.create_if_absent("h", "other int")
    day = dt.date(2024, 1, 1)
    ddl = "id string, _storefront string, name string, rank int, snapshot_date date"
    db.replace_partitions("h", rows(ddl, ("1", "us", "n", 1, day), ("2", "us", "m", 1, day + dt.timedelta(1))), "snapshot_date")
    db.replace_partitions("h", rows(ddl, ("3", "us", "o", 2, day)), "snapshot_date")
    assert bag(db.table("h").select("id", "rank")) == [("2", 1), ("3", 2)]
    for _ in range(2):
        db.merge("h", rows(ddl, ("3", "us", "p", 7, day), ("4", "us", "q", 8, day)), ["id"], ["rank"], "snapshot_date")
    assert bag(db.table("h").select("id", "name", "rank")) == [("2", "m", 1), ("3", "p", 7), ("4", "q", 8)]


TICKS = [
    {"s": "A", "p": 1.0, "t": 1704067200000, "v": 1.0, "c": ["1"]},
    {"s": "A", "p": 2.0, "t": 1704067201000, "v": 1.0, "c": ["1"]},
    {"s": "B", "p": 3.0, "t": 1704153600000, "v": 1.0},
]


def land(folder, name, ticks):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(json.dumps(t) for t in ticks))


def test_ticks_land_once_each(spark, tmp_path):
    files = tmp_path / "in"
    out, checkpoint = f"{tmp_path}/out", f"{tmp_path}/cp"
    for name, ticks in (("one", TICKS[:2]), ("two", TICKS[2:])):
        land(files, name, ticks)
        land_ticks(read_ticks(spark, str(files)), out, checkpoint, F.lit(NOW)).awaitTermination()
    got = spark.read.parquet(out)
    assert bag(got.select("s", "p", "day")) == [
        ("A", 1.0, dt.date(2024, 1, 1)), ("A", 2.0, dt.date(2024, 1, 1)), ("B", 3.0, dt.date(2024, 1, 2)),
    ]
    assert got.where(F.col("_ingested_at") == F.lit(NOW)).count() == 3


def test_repeated_and_late_ticks(spark, tmp_path):
    files = tmp_path / "in"
    out, checkpoint = f"{tmp_path}/out", f"{tmp_path}/cp"
    schema = "s string, p double, t bigint, v double, c array<string>, ts timestamp, day date"

    def run():
        merge_ticks(read_ticks(spark, str(files)), out, checkpoint, ["s"], ["t", "p"], schema).awaitTermination()
        return bag(spark.read.parquet(out).select("s", "p", "day"))

    land(files, "one", TICKS)
    day1, day2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    assert run() == [("A", 2.0, day1), ("B", 3.0, day2)]
    # A newer tick replaces, an older one does not.
    newer = {"s": "B", "p": 5.0, "t": 1704153605000, "v": 1.0}
    repeat = {"s": "B", "p": 9.0, "t": 1704153600000, "v": 1.0}
    land(files, "two", [newer, repeat])
    assert run() == [("A", 2.0, day1), ("B", 5.0, day2)]
    # Late ticks of a day and of one not seen yet count, and ticks delivered again change nothing.
    late = [{"s": "A", "p": 7.0, "t": 1704067300000, "v": 1.0}, {"s": "C", "p": 1.0, "t": 1703980800000, "v": 1.0}]
    land(files, "three", [*late, newer, *TICKS])
    assert run() == [("A", 7.0, day1), ("B", 5.0, day2), ("C", 1.0, dt.date(2023, 12, 31))]


def test_ticks_without_time_of_several_batches_all_stay(spark, tmp_path):
    files, out, checkpoint = tmp_path / "landing", str(tmp_path / "silver"), str(tmp_path / "checkpoint")
    schema = "s string, p double, t bigint, v double, c array<string>, ts timestamp, day date"
    for name, ticks in (("one", [{"s": "A", "p": 1.0}, {"s": "B", "p": 2.0}]), ("two", [{"s": "C", "p": 3.0}, {"s": "B", "p": 4.0}])):
        land(files, name, ticks)
        merge_ticks(read_ticks(spark, str(files)), out, checkpoint, ["s"], ["t", "p"], schema).awaitTermination()
    got = sorted((r["s"], r["p"], r["day"]) for r in spark.read.parquet(out).collect())
    assert got == [("A", 1.0, None), ("B", 4.0, None), ("C", 3.0, None)]
