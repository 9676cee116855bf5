"""Landed files: each version read once, broken ones set aside, failed loads repeated."""

import os

import pytest
from conftest import bag
from pyspark.sql import functions as F

from gradeline.sources.ledger import LandedFiles
from gradeline.sources.tables import Database

SCHEMA = "k int, v string"


@pytest.fixture
def landed(spark, tmp_path):
    folder = tmp_path / "in box"
    folder.mkdir()

    def put(name, text):
        file = folder / name
        file.parent.mkdir(exist_ok=True, parents=True)
        stamp = (file.stat().st_mtime if file.exists() else 1_700_000_000) + 7
        file.write_text(text, encoding="utf-8")
        os.utime(file, (stamp, stamp))

    def files(**how):
        name = "ledger_" + tmp_path.name.replace("-", "_")
        return LandedFiles(Database(spark, name, str(tmp_path)), "t", "t_files", str(folder), SCHEMA, **how)

    return put, files


def status(files):
    found = files.db.table("t_files").select(F.regexp_extract("file", "[^/]+$", 0), "status", "n_rows", "_load")
    return bag(found)


def test_new_files_only_and_broken_ones_aside(landed):
    put, make = landed
    files = make()
    put("a.json", '[{"k": 1, "v": "a"}, {"k": null}]')
    put("sub/b 2%.json", '{"k": 2, "v": "é", "more": [1]}')
    put("cut.json", '[{"k": 3, "v": "lost"}, {"k": 4, "v"')
    put("kind.json", '[{"k": 5, "v": "lost"}, {"k": "no number", "v": "lost"}]')
    put("none.json", "[]")
    put("empty.json", "")
    assert files.load() == 5  # a file of no bytes is not there yet
    assert bag(files.db.table("t").select("k", "v", "_load")) == sorted([(1, "a", 0), (None, None, 0), (2, "é", 0)], key=str)
    noted = {row[0]: row[1:3] for row in status(files)}
    assert noted["a.json"] == ("loaded", 2) and noted["cut.json"] == noted["kind.json"] == ("broken", 0)
    assert noted["none.json"] == ("loaded", 0)
    reasons = files.db.table("t_files").where("status = 'broken'").select("reason").collect()
    assert all(r[0].startswith("does not fit: ") and "lost" in r[0] for r in reasons)
    assert files.load() == 0

    put("cut.json", '[{"k": 3, "v": "mended"}]')
    put("empty.json", '[{"k": 6}]')
    assert files.load() == 2
    assert bag(files.db.table("t").where("_load = 1").select("k", "v")) == [(3, "mended"), (6, None)]
    assert files.db.table("t").count() == 5 and len(status(files)) == 7


def test_loads_of_bounded_size(landed):
    put, make = landed
    files = make(files_per_load=2, pretty=False)
    for n in range(5):
        put(f"{n}.json", f'{{"k": {n}}}\n{{"k": {n}}}\n')
    assert files.load() == 5
    assert sorted({row[3] for row in status(files)}) == [0, 1, 2]
    assert files.db.table("t").count() == 10


def test_a_load_that_fails_before_its_note_is_repeated(landed, monkeypatch):
    put, make = landed
    files = make()
    put("a.json", '[{"k": 1}]')
    with monkeypatch.context() as patch:
        patch.setattr(files.db, "append", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            files.load()
    put("b.json", '[{"k": 2}]')
    assert files.load() == 2
    assert bag(files.db.table("t").select("k", "_load")) == [(1, 0), (2, 0)]


def test_only_broken_files_and_no_files(landed):
    put, make = landed
    files = make()
    assert files.load() == 0
    put("a.json", "[{")
    assert files.load() == 1
    assert files.db.table("t").count() == 0 and status(files) == [("a.json", "broken", 0, 0)]
