"""Stored indexes: vectors by cells, dated postings, their upkeep."""

import datetime as dt
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from conftest import bag
from pyspark.sql import functions as F

from gradeline.catalog import fixtures
from gradeline.operators import cells, postings
from gradeline.operators.cells import CellIndex
from gradeline.operators.diff import snapshot_diff
from gradeline.operators.postings import Postings
from gradeline.plans import dated_search
from gradeline.plans.dated_search import hybrid_top_k_as_of
from gradeline.plans.retrieval import cosine_top_k_as_of, hybrid_top_k

START = dt.date(2024, 1, 1)


def day(n):
    return START + dt.timedelta(days=n)


def requests(asked, days):
    return asked.select("entity", F.explode(F.array(*[F.lit(day(n)) for n in days])).alias("as_of"))


def hits(df):
    return bag(df.select("entity", "as_of", "doc_id", F.round("score", 6), "rank"))


def test_recall_over_all_embeddings_and_exact_search(spark, tmp_path):
    sf = "/root/testdata/sf0.1"
    vectors = fixtures.vectors(spark, sf)
    index = CellIndex(spark, f"{tmp_path}/index")
    index.build(vectors)
    assert index.entries().count() == vectors.count()
    every = vectors.select(F.col("doc_id").alias("entity"), F.col("embedding").alias("query_vector"))
    asked, examples = every.where("entity % 20 = 0"), every.where("entity % 20 = 7")
    wanted = requests(asked, (4, 12, 29))
    probes = index.probes_for(examples, requests(examples, (4, 12, 29)), 5)
    assert probes < len(index.centroids())
    truth = {r[:3] for r in hits(cosine_top_k_as_of(vectors, asked, wanted))}
    found = index.search(asked, wanted, 5, probes)
    near = {r[:3] for r in hits(found.rows)}
    recall = len(truth & near) / len(truth)
    assert recall >= 0.9, recall
    exact = index.search(asked, wanted, 5, probes=4, exact=True)
    assert hits(exact.rows) == hits(cosine_top_k_as_of(vectors, asked, wanted))


def test_a_search_reads_only_the_folders_of_its_cells(spark, rows, tmp_path):
    rng = random.Random(3)
    corners = np.eye(6)
    data = [(i, day(i % 9), [float(x) for x in corners[i % 6] + [rng.gauss(0, 0.02) for _ in range(6)]]) for i in range(300)]
    odd = [(900, day(1), None), (901, day(1), [0.0] * 6), (902, day(1), [1.0, 0.0]), (903, None, [1.0] * 6), (904, day(1), [1.0, None] * 3)]
    vectors = rows("doc_id int, published_date date, embedding array<double>", *data, *odd)
    index = CellIndex(spark, f"{tmp_path}/index")
    index.build(vectors, cells=6)
    assert index.entries().count() == 302
    asked = rows("entity string, query_vector array<double>", ("a", [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]), ("b", [0.0, 1.0, 0.0, 0.0, 0.0, 0.0]), ("c", [1.0, 0.1]), ("d", None))
    wanted = requests(asked, (0, 5, 8))
    exact = index.search(asked, wanted, 4, probes=1, exact=True)
    assert hits(exact.rows) == hits(cosine_top_k_as_of(vectors, asked, wanted, 4))
    late = requests(asked, (8,))
    pruned = index.search(asked, late, 4, probes=1, exact=True)
    assert hits(pruned.rows) == hits(cosine_top_k_as_of(vectors, asked, late, 4))
    assert len(pruned.cells) == 3 and cells.OTHER in pruned.cells  # two corners and what has another size
    plan = index.entries(pruned.cells)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*cell#\d+ IN \(" + ",".join(map(str, pruned.cells)), plan)
    empty = CellIndex(spark, f"{tmp_path}/empty")
    empty.build(vectors.limit(0))
    assert empty.search(asked, wanted, 4, exact=True).rows.count() == 0


def test_upkeep_leaves_the_index_as_one_built_anew(spark, rows, tmp_path):
    rng = random.Random(4)
    ddl = "doc_id int, published_date date, embedding array<double>"
    vector = lambda: [rng.gauss(0, 1) for _ in range(8)]
    old = [(i, day(i % 20), vector()) for i in range(200)]
    new = [(i, d, vector() if i % 5 == 0 else v) for i, d, v in old if i % 7] + [(500 + i, day(i), vector()) for i in range(10)]
    before, after = rows(ddl, *old), rows(ddl, *new)
    asked = rows("entity int, query_vector array<double>", *[(i, vector()) for i in range(12)])
    wanted = requests(asked, (3, 19))
    index = CellIndex(spark, f"{tmp_path}/index")
    index.build(before, version=3)
    changes = snapshot_diff(before, after, ["doc_id"], ["published_date", "embedding"])
    assert not index.apply(changes, after, 3) and index.version() == 3
    assert index.apply(changes, after, 4) and index.version() == 4
    assert not index.apply(changes, after, 4)
    assert bag(index.entries().select("doc_id", "published_date", "embedding")) == bag(after.select("doc_id", "published_date", "embedding"))
    assert hits(index.search(asked, wanted, 5, exact=True).rows) == hits(cosine_top_k_as_of(after, asked, wanted))
    # A version whose number was never written does not count.
    index._add(before, 5)
    assert index.entries().count() == len(new)


def fused(df):
    return bag(df.select("entity", "doc_id", "semantic_rank", "lexical_rank", F.round("score", 9), "rank"))


def test_fused_search_of_every_day_is_that_of_each_day(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(dated_search, "DOCUMENTS", 40)
    monkeypatch.setattr(dated_search, "DAYS", 3)
    rng = random.Random(9)
    words = [f"w{i}" for i in range(200)]  # more than there are buckets
    text = lambda: " ".join(rng.choice(words) for _ in range(rng.randrange(12)))
    vector = lambda: [rng.gauss(0, 1) for _ in range(4)]
    data = [(i, day(rng.randrange(12)), rng.choice([text(), text(), None]), rng.choice([vector(), vector(), None])) for i in range(260)]
    data += [(900, None, "w1 w2", vector()), (901, day(3), "", None), (902, day(4), "w1 w1", [0.0] * 4)]
    ddl = "doc_id int, published_date date, text_content string, embedding array<double>"
    documents = rows(ddl, *data)
    asked = rows("entity int, query_text string, query_vector array<double>",
                 *[(i, text() + " W3", vector()) for i in range(5)], (5, "unheard of", vector()), (6, "w1", None))
    index = Postings(spark, f"{tmp_path}/postings")
    old = [(i, d, text() if i % 4 == 0 else t, v) for i, d, t, v in data if i % 5] + [(950, day(2), "w1 w2", None)]
    before = rows(ddl, *old)
    index.build(before, version=7)
    changes = snapshot_diff(before, documents, ["doc_id"], ["published_date", "text_content"])
    assert not index.apply(changes, documents, 7) and index.apply(changes, documents, 8)
    anew = Postings(spark, f"{tmp_path}/anew")
    anew.build(documents)
    assert bag(index.postings()) == bag(anew.postings())
    wanted = requests(asked, (0, 3, 5, 11, 20))
    assert bag(index.corpus(wanted)) == bag(anew.corpus(wanted))
    found = hybrid_top_k_as_of(documents, index, asked, wanted, k=4, offset=3)
    for n in (0, 3, 5, 11, 20):
        one = hybrid_top_k(documents, asked, F.lit(day(n)).cast("date"), k=4, offset=3)
        assert fused(found.where(F.col("as_of") == F.lit(day(n)))) == fused(one), n
    assert index.matches(rows("entity int, word string", (1, "w1"))).count() == sum((t or "").split().count("w1") > 0 for _, d, t, _ in data if d)
    plan = index.matches(rows("entity int, word string", (1, "w1")))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan)


def test_postings_are_stored_by_words_of_blocks(spark, rows, tmp_path):
    """What is moved and sorted has a row for a word of a block, not one for each text that has the word."""
    texts = [(i, day(i % 5), "a b b " + ("c" if i % 2 else "")) for i in range(40)] + [(99, day(1), "")]
    index = Postings(spark, f"{tmp_path}/postings")
    index.build(rows("doc_id int, published_date date, text_content string", *texts).coalesce(1))
    assert spark.read.parquet(f"{tmp_path}/postings/postings").count() == 4  # a, b, c and ''
    held = {tuple(r) for r in index.postings().select("doc_id", "word", "tf", "length").collect()}
    assert len(held) == 40 * 2 + 20 + 41 and (3, "b", 2, 4) in held and (99, "", 1, 0) in held


def test_blocks_hold_every_text_once(monkeypatch):
    monkeypatch.setattr(postings, "BLOCK_WORDS", 20)
    rng = random.Random(12)
    texts = [(f"t{i}", day(i % 3), [rng.choice("xyz") for _ in range(rng.choice([0, 1, 7, 45]))]) for i in range(60)]
    kind = pa.schema([("doc_id", pa.string()), ("published_date", pa.date32()), ("words", pa.list_(pa.string()))])
    whole = pa.RecordBatch.from_pylist([dict(zip(kind.names, t)) for t in texts], schema=kind)
    blocks = [b.to_pylist() for b in postings.posting_blocks(iter([whole.slice(0, 25), whole.slice(25, 0), whole.slice(25)]))]
    assert len(blocks) > 10 and all(len(b) == len({r["word"] for r in b}) for b in blocks)
    found = sorted((r["word"], d["doc_id"], d["published_date"], d["tf"], d["length"]) for b in blocks for r in b for d in r["docs"])
    assert found == sorted((w, i, d, t.count(w) if w else 1, len(t)) for i, d, t in texts for w in {*t, ""})


def test_word_scores_rank_and_place_ties_by_id():
    hits = [(i, day(n), w, tf, 4) for i, n, w, tf in [(5, 0, "a", 1), (3, 0, "a", 1), (9, 1, "a", 2), (9, 1, "b", 1), (4, 2, "b", 1), (1, 0, "b", 1)]]
    names = ["doc_id", "published_date", "word", "tf", "length"]
    weights = [{"as_of": day(n), "word": w, "idf": 0.5, "mean": 4.0} for n in (0, 1) for w in "ab"]
    found = dated_search.WordScores(pa.array([dict(zip(names, h)) for h in hits], pa.struct(
        [("doc_id", pa.int32()), ("published_date", pa.date32()), ("word", pa.string()), ("tf", pa.int32()), ("length", pa.int32())]
    )), [day(0), day(1)], weights)
    assert found.ids.to_pylist() == [1, 3, 4, 5, 9]
    assert [[found.ids[i].as_py() for i in found.best(j, 3)] for j in (0, 1)] == [[1, 3, 5], [9, 1, 3]]
    one = 0.5 * 2.2 / 2.2
    marks = [{"loss": -one, "doc_id": 2}, {"loss": -one, "doc_id": 5}]
    assert found.places(0, marks).tolist() == [0, 1, 1]  # of 1, 3 and 5
    assert found.places(1, marks).tolist() == [0, 1, 1, 0]  # 9 is better than both
