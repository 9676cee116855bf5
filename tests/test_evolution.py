"""Schemas that change: what the planner decides, and what stored tables then hold."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import bag
from pyspark.sql.types import ArrayType, StructType

from gradeline.sources.evolution import SchemaRefused, common_type, plan_schema, schema_after
from gradeline.sources.tables import Database


def kind(ddl):
    return StructType.fromDDL(f"c {ddl}")["c"].dataType


@pytest.mark.parametrize("left, right, both", [
    ("tinyint", "smallint", "smallint"), ("int", "bigint", "bigint"), ("float", "double", "double"), ("int", "float", "double"),
    ("smallint", "double", "double"), ("bigint", "double", None), ("int", "decimal(12,2)", "decimal(12,2)"),
    ("bigint", "decimal(5,4)", "decimal(24,4)"), ("decimal(38,0)", "decimal(10,5)", None), ("decimal(10,2)", "double", None),
    ("date", "timestamp_ntz", "timestamp_ntz"), ("date", "timestamp", None), ("string", "int", None), ("boolean", "int", None),
    ("struct<a:int,b:string>", "struct<B:string,a:bigint,c:date>", "struct<a:bigint,b:string,c:date>"),
    ("struct<a:int>", "struct<a:string>", None), ("array<int>", "array<bigint>", "array<bigint>"), ("array<int>", "int", None),
    ("map<string,int>", "map<string,double>", "map<string,double>"), ("map<string,int>", "map<int,int>", None), ("void", "date", "date"),
])
def test_common_types(left, right, both):
    found = common_type(kind(left), kind(right))
    assert (found and found.simpleString()) == both
    backwards = common_type(kind(right), kind(left))
    assert (found is None) == (backwards is None)
    if found is not None and not left.startswith("struct"):
        assert backwards == found


def test_plans_and_refusals():
    stored = StructType.fromDDL("k int, v string, old double, kept date")
    changes = plan_schema(stored, StructType.fromDDL("K bigint, v void, fresh float, added string"), {"OLD": "fresh"})
    assert [(c.kind, c.column) for c in changes] == [
        ("widen", "k"), ("keep", "v"), ("rename", "fresh"), ("keep", "kept"), ("add", "added"),
    ]
    assert schema_after(changes).simpleString() == "struct<k:bigint,v:string,fresh:double,kept:date,added:string>"
    bad = StructType.fromDDL("k string, added void, old double, w int, W int")
    with pytest.raises(SchemaRefused) as refused:
        schema_after(plan_schema(stored, bad, {"old": "v", "gone": "x"}))
    for part in ("k: int and string", "added: it has no type", "v: the name is taken", "no gone", "W: the batch has it twice"):
        assert part in str(refused.value)
    with pytest.raises(SchemaRefused, match="still has old"):
        schema_after(plan_schema(stored, StructType.fromDDL("old double"), {"old": "renamed"}))
    assert schema_after(plan_schema(stored, StructType())) == stored


def test_widened_files_stay(spark, rows, tmp_path):
    db = Database(spark, "widened", str(tmp_path))
    narrow = "i int, f float, d date, m decimal(6,2), s struct<a:int>, l array<int>"
    db.append("t", rows(narrow, (1, 1.5, date(2024, 1, 2), Decimal("12.34"), (7,), [1, None]), (None,) * 6))
    files = set(db.table("t").inputFiles())
    wide = "i bigint, f double, d timestamp_ntz, m decimal(10,4), s struct<a:bigint,b:string>, l array<bigint>, x string"
    moment = datetime(2024, 1, 3, 4, 5)
    db.append("t", rows(wide, (2**40, 0.1, moment, Decimal("1.2345"), (2**40, "b"), [2**40], "x")))
    assert files < set(db.table("t").inputFiles())
    assert bag(db.table("t")) == sorted([
        (1, 1.5, datetime(2024, 1, 2), Decimal("12.3400"), (7, None), [1, None], None), (None,) * 7,
        (2**40, 0.1, moment, Decimal("1.2345"), (2**40, "b"), [2**40], "x"),
    ], key=str)
    before = bag(db.table("t"))
    with pytest.raises(SchemaRefused, match="i: bigint and string"):
        db.append("t", rows("i string, y int", ("a", 1)))
    assert bag(db.table("t")) == before and "y" not in db.table("t").columns
    db.append("t", rows("f int, i int", (3, 4)))  # narrower rows, in another order, with columns missing
    assert db.table("t").where("i = 4").first()["f"] == 3.0


def test_slices_widen_and_rename(spark, rows, tmp_path):
    db = Database(spark, "slices", str(tmp_path))
    db.load_slice("t", rows("v int, day int", (1, 1), (2, 2), (None, 2)), "day")
    db.load_slice("t", rows("v bigint, day int, w array<string>", (2**40, 2, ["a"]), (5, 3, None)), "day")
    assert bag(db.table("t").select("day", "v", "w")) == [(1, 1, None), (2, 2**40, ["a"]), (3, 5, None)]
    assert db.table("t").schema["w"].dataType == ArrayType(kind("string"))
    db.evolve("t", StructType.fromDDL("total double, day int"), {"w": "words"})
    assert set(db.table("t").columns) == {"v", "words", "total", "day"}
    db.load_slice("t", rows("total double, day int", (0.5, 3)), "day")
    assert bag(db.table("t").select("day", "v", "words", "total")) == [
        (1, 1, None, None), (2, 2**40, ["a"], None), (3, None, None, 0.5),
    ]
    assert db.table("t").where("day = 2").count() == 1
    with pytest.raises(SchemaRefused, match="keeps its name"):
        db.evolve("t", StructType.fromDDL("d int"), {"day": "d"})
