"""Tables by parts and buckets: what merges read, move and write, and what digests spare a diff."""

import random
import re

import pytest
from conftest import bag

from gradeline.operators.diff import snapshot_diff
from gradeline.operators.merge import delete_keys, upsert
from gradeline.sources import bucketed
from gradeline.sources.bucketed import NO_KEY, PART, BucketedTable
from gradeline.sources.tables import Database

DDL = "a int, b string, v string"
KEYS = ["a", "b"]


@pytest.fixture
def stored(spark, tmp_path):
    made = []

    def make(df, name="t", parts=7, buckets=3):
        made.append(BucketedTable(Database(spark, f"bucketed_{tmp_path.name}_{len(made)}".replace("-", "_"), f"{tmp_path}/{len(made)}"), name, KEYS, parts, buckets))
        made[-1].create(df)
        return made[-1]

    return make


def files(table):
    found = {}
    for file in table._stored().inputFiles():
        found.setdefault(int(re.search(rf"{PART}=(-?\d+)", file)[1]), set()).add(file)
    return found


def fresh_digests(table):
    """The leaves as they would be if counted anew."""
    return bag(table._digests_of(table._stored()))


def test_merges_agree_with_those_of_plain_frames(rows, stored):
    rng = random.Random(5)
    row = lambda n, v: (n, rng.choice(["x", "y"]), v)
    base = list({r[:2]: r for r in [row(n, f"old{n}") for n in range(300)]}.values())
    base += [(None, "x", "n1"), (None, "x", "n1"), (5, None, "n2")]
    batch = list({r[:2]: r for r in [row(n, f"new{n}") for n in range(250, 330)]}.values()) + [(None, "x", "n3")]
    target, source = rows(DDL, *base), rows(DDL, *batch)
    table = stored(target)
    assert bag(table.rows()) == bag(target)
    assert NO_KEY in table.upsert(source)
    merged = upsert(target, source, KEYS)
    assert bag(table.rows().select("a", "b", "v")) == bag(merged.select("a", "b", "v"))
    assert bag(table._leaves()) == fresh_digests(table)
    gone = rows("a bigint, b string", *[(n, b) for n in range(0, 300, 3) for b in "xy"], (None, "x"), (5, None))
    table.delete(gone)
    assert bag(table.rows().select("a", "b", "v")) == bag(delete_keys(merged, gone, KEYS).select("a", "b", "v"))
    assert bag(table._leaves()) == fresh_digests(table)


def test_only_touched_parts_are_written_and_the_table_is_not_shuffled(rows, stored, monkeypatch):
    table = stored(rows(DDL, *[(n, "x", str(n)) for n in range(400)]))
    before, plans = files(table), []
    move = table._move
    monkeypatch.setattr(table, "_move", lambda df, touched: (plans.append(df._jdf.queryExecution().executedPlan().toString()), move(df, touched)))
    touched = table.upsert(rows(DDL, (3, "x", "new"), (999, "x", "more")))
    after = files(table)
    assert 1 <= len(touched) <= 2 < len(after)
    assert {p for p in after if after[p] != before[p]} == set(touched)
    assert table.delete(rows("a int, b string", (3, "x"))) == [p for p in touched if p in files(table) and files(table)[p] != after[p]]
    for plan in plans:
        # What is exchanged comes from the batch's own folder; the table's scan is bucketed and pruned.
        scan = next(line for line in plan.split("\n") if "v#" in line and "FileScan" in line and "Bucketed: true" in line)
        assert re.search(rf"PartitionFilters: \[[^\]]*{PART}", scan)
        lines = plan.split("\n")
        at = lines.index(scan)
        depth = lines[at].index("FileScan")
        above = []
        for line in reversed(lines[:at]):
            name = re.search(r"[A-Za-z]", line.replace(":", " "))
            if name and name.start() < depth:
                depth = name.start()
                above.append(line)
        assert above and not [line for line in above if "Exchange" in line], above


def test_a_part_that_loses_its_rows_goes(rows, stored):
    table = stored(rows(DDL, *[(n, "x", str(n)) for n in range(40)]))
    table.delete(rows("a int, b string", *[(n, "x") for n in range(40)]))
    assert table.rows().count() == 0 and table.digests().count() == 0
    table.upsert(rows(DDL, (1, "x", "back")))
    assert bag(table.rows()) == [(1, "x", "back")]
    assert table.upsert(rows(DDL)) == [] and table.delete(rows("a int, b string")) == []


def test_batches_that_do_not_fit(rows, stored):
    table = stored(rows(DDL, (1, "x", "one")))
    with pytest.raises(Exception, match="two source rows"):
        table.upsert(rows(DDL, (2, "x", "p"), (2, "x", "q")))
    with pytest.raises(ValueError, match="no columns"):
        table.upsert(rows("a int, b string, w string", (2, "x", "p")))
    with pytest.raises(ValueError, match="reserved"):
        stored(rows(f"a int, b string, {PART} int", (1, "x", 2)))
    with pytest.raises(ValueError, match="already"):
        table.create(rows(DDL, (1, "x", "one")))
    table.upsert(rows("a bigint, b string, v string", (1, "x", "p"), (1, "x", "q")), ["v"])
    table.upsert(rows("b string, a int", ("x", 2)))
    assert bag(table.rows()) == [(1, "x", "q"), (2, "x", None)]


def test_a_diff_reads_only_parts_with_other_digests(spark, rows, stored, monkeypatch):
    monkeypatch.setattr(bucketed, "FAN", 3)
    data = [(n, "x", str(n)) for n in range(600)] + [(None, "x", "n"), (None, "x", "n")]
    old, new = stored(rows(DDL, *data), parts=20), stored(rows(DDL, *data), parts=20)
    changes, read = new.changes_since(old, ["v"])
    assert read == [] and changes.count() == 0 and not changes.inputFiles()
    touched = new.upsert(rows(DDL, (7, "x", "other"), (1000, "x", "more"))) + new.delete(rows("a int, b string", (11, "x")))
    changes, read = new.changes_since(old, ["v"])
    assert read == sorted(set(touched)) and len(read) <= 3
    assert bag(changes) == bag(snapshot_diff(old.rows(), new.rows(), KEYS, ["v"]))
    assert len(changes.collect()) == 3
    assert {int(re.search(rf"{PART}=(-?\d+)", file)[1]) for file in changes.inputFiles()} == set(read)
    new.upsert(rows(DDL, (None, "y", "n")))
    assert NO_KEY in new.changes_since(old, ["v"])[1]
    # Digests that were blanked on both sides, as by merges that failed, equal nothing.
    for table in (old, new):
        table._forget([4])
    assert 4 in new.changes_since(old, ["v"])[1]
    with pytest.raises(ValueError, match="same keys"):
        new.changes_since(stored(rows(DDL, *data), parts=4), ["v"])


def test_a_merge_that_fails_leaves_no_digest_that_lies(rows, stored, monkeypatch):
    data = [(n, "x", str(n)) for n in range(60)]
    old, new = stored(rows(DDL, *data)), stored(rows(DDL, *data))
    write = new._write_digests
    calls = []

    def fails(leaves):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        write(leaves)

    monkeypatch.setattr(new, "_write_digests", fails)
    with pytest.raises(RuntimeError, match="lost"):
        new.upsert(rows(DDL, (7, "x", "other")))
    assert [tuple(r) for r in new.changes_since(old, ["v"])[0].collect()] == [(7, "x", "update")]
    monkeypatch.undo()
    new.upsert(rows(DDL, (7, "x", "other")))
    assert bag(new._leaves()) == fresh_digests(new)
