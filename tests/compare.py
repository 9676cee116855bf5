"""Runs registered queries beside their SQL in DuckDB and compares the rows.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def differences(df, connection, sql):
    """(row count, list of what differs)"""
    rows = [tuple(r) for r in df.collect()]
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return len(rows), [f"columns {sorted(df.columns)} != {sorted(names)}"]
    ours, theirs = bag(df.columns, rows), bag(names, expected)
    missing, extra = list((theirs - ours).items()), list((ours - theirs).items())
    notes = [f"{len(rows)} rows, expected {len(expected)}"] if len(rows) != len(expected) else []
    if missing or extra:
        notes.append(f"{sum(n for _, n in missing)} missing, {sum(n for _, n in extra)} extra; {sorted(names)}")
        notes += [f"expected {r}"[:700] for r, _ in sorted(missing, key=str)[:2]]
        notes += [f"got      {r}"[:700] for r, _ in sorted(extra, key=str)[:2]]
    return len(rows), notes


def main(argv):
    from gradeline import catalog
    from gradeline.session import get_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    queries, oracles = catalog.queries(), catalog.oracles()
    bad = 0
    for name in argv[2:] or queries:
        start = time.time()
        try:
            if name in oracles:
                n, notes = differences(queries[name](spark, sf_dir), connection, oracles[name])
            else:
                n, notes = len(queries[name](spark, sf_dir).collect()), []
        except Exception as error:  # noqa: BLE001
            n, notes = -1, [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(notes)
        print(f"{'BAD ' if notes else 'ok  '} {name:28} {n:8} rows {time.time() - start:6.2f}s {'' if name in oracles else '(rows only)'}", flush=True)
        for note in notes:
            print("      " + note, flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
