"""Distinct ticks: repeats in and beyond the watermark, late news, NULLs, batches run again."""

import random

from conftest import bag
from pyspark.sql import functions as F

from gradeline.sources.tables import keep
from gradeline.streaming import distinct
from gradeline.streaming.distinct import append_distinct, distinct_ticks
from gradeline.streaming.ticks import read_ticks

HOUR = 3_600_000
LANDED = "s string, p double, t bigint, v double"
STORED = f"{LANDED}, ts timestamp, day date, batch bigint"
KEYS = ["s", "t", "v"]


def run(spark, folder, frame):
    frame.coalesce(2).write.mode("append").json(f"{folder}/landed")
    stream = read_ticks(spark, f"{folder}/landed", LANDED, files_per_batch=1)
    query = distinct_ticks(stream, f"{folder}/stored", f"{folder}/marks", f"{folder}/state", KEYS, "2 hours", STORED)
    query.awaitTermination()
    return spark.read.schema(STORED).parquet(f"{folder}/stored")


def test_each_tick_once(spark, rows, tmp_path):
    rng = random.Random(11)
    seen = set()
    for number in range(4):
        # The clock goes on by 5 hours a run; ticks lie up to 40 hours back, and half of the old ones come again.
        fresh = [(rng.choice(["A", "B", None]), 1.0, (100 + 5 * number - rng.randrange(40)) * HOUR, float(rng.randrange(3))) for _ in range(60)]
        fresh += [("N", 1.0, None, float(rng.randrange(3))), (None, 1.0, None, None)]
        again = rng.sample(sorted(seen, key=str), len(seen) // 2)
        batch = fresh + again + again[:9]
        rng.shuffle(batch)
        seen |= set(batch)
        stored = run(spark, str(tmp_path), rows(LANDED, *batch))
        assert bag(stored.select("s", "p", "t", "v")) == sorted(seen, key=str)
    assert stored.where("day IS NULL").count() == len([r for r in seen if r[2] is None])


def test_files_of_earlier_batches_stay(spark, rows, tmp_path):
    folder = str(tmp_path)
    first = run(spark, folder, rows(LANDED, ("A", 1.0, 100 * HOUR, 1.0), ("A", 1.0, 2 * HOUR, 1.0)))
    before = set(first.inputFiles())
    late = run(spark, folder, rows(LANDED, ("A", 1.0, 2 * HOUR, 1.0), ("A", 1.0, 2 * HOUR, 2.0), ("A", 1.0, 100 * HOUR, 1.0)))
    assert before < set(late.inputFiles()) and late.count() == 3


def test_a_batch_run_again_changes_nothing(spark, rows, tmp_path):
    add = append_distinct(f"{tmp_path}/stored", f"{tmp_path}/marks", KEYS, "2 hours", STORED)
    batch = rows(f"{LANDED}, _first boolean", *[("A", 1.0, t * HOUR, 1.0, f) for t, f in [(50, True), (50, False), (3, False), (3, False)]])
    batch = batch.withColumn("ts", F.timestamp_millis("t"))
    for number in (0, 0, 1, 1):
        add(batch if number == 0 else batch.where("NOT _first"), number)
        assert spark.read.schema(STORED).parquet(f"{tmp_path}/stored").count() == 2


def test_only_old_ticks_are_looked_up(spark, rows, tmp_path):
    """A repeat that is younger than the watermark is dropped by state alone: the table is not asked."""
    add = append_distinct(f"{tmp_path}/stored", f"{tmp_path}/marks", KEYS, "2 hours", STORED)
    ddl = f"{LANDED}, _first boolean"
    add(rows(ddl, ("A", 1.0, 50 * HOUR, 1.0, True)).withColumn("ts", F.timestamp_millis("t")), 0)
    young = rows(ddl, ("A", 1.0, 49 * HOUR, 7.0, False), ("A", 1.0, 47 * HOUR, 7.0, False))
    add(young.withColumn("ts", F.timestamp_millis("t")), 1)
    stored = spark.read.schema(STORED).parquet(f"{tmp_path}/stored")
    assert sorted(r.t // HOUR for r in stored.collect()) == [47, 50]


def test_a_late_tick_as_old_as_the_watermark_is_stored(spark, rows, tmp_path):
    folder = str(tmp_path)
    run(spark, folder, rows(LANDED, ("A", 1.0, 50 * HOUR, 1.0)))
    for _ in range(2):
        stored = run(spark, folder, rows(LANDED, ("A", 1.0, 48 * HOUR, 1.0), ("A", 1.0, 47 * HOUR, 1.0)))
    assert sorted(r.t // HOUR for r in stored.collect()) == [47, 48, 50]


def test_ticks_before_1970_are_stored(spark, rows, tmp_path):
    stored = run(spark, str(tmp_path), rows(LANDED, ("A", 1.0, -50 * HOUR, 1.0), ("A", 1.0, -49 * HOUR, 1.0), ("A", 1.0, -49 * HOUR, 1.0)))
    assert sorted(r.t // HOUR for r in stored.collect()) == [-50, -49]


def test_repeats_in_time_are_not_kept(spark, rows, tmp_path, monkeypatch):
    """Of a later batch only what the state let through or dropped as late is written at all."""
    kept = {}
    monkeypatch.setattr(distinct, "keep", lambda df, name: kept.setdefault(name, []).append(keep(df, name)) or kept[name][-1])
    monkeypatch.setattr(distinct, "discard", lambda *_: None)
    add = append_distinct(f"{tmp_path}/stored", f"{tmp_path}/marks", KEYS, "2 hours", STORED)
    ddl = f"{LANDED}, _first boolean"
    add(rows(ddl, ("A", 1.0, 50 * HOUR, 1.0, True)).withColumn("ts", F.timestamp_millis("t")), 0)
    ticks = [("A", 1.0, t * HOUR, 1.0, f) for t, f in [(50, False), (49, True), (49, False), (49, False), (60, True), (60, False), (3, False)]]
    add(rows(ddl, *ticks).withColumn("ts", F.timestamp_millis("t")), 1)
    assert kept["distinct_batch"][1].count() == 3
    stored = spark.read.schema(STORED).parquet(f"{tmp_path}/stored")
    assert sorted(r.t // HOUR for r in stored.collect()) == [3, 49, 50, 60]
