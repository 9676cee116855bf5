"""Fused retrieval for many dates at once: each request (entity, as_of) sees the corpus of its day.

Word scores differ from day to day, since rarities and mean lengths do. They are worked out as products of a block of
documents and a block of days, which leave the best documents of each day; scores of pairs are never rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeline.functions.vectors import cosine, length
from gradeline.operators.nearest import cosine_of, dated_places, nearest, pack
from gradeline.operators.postings import Postings
from gradeline.operators.topk import as_of_top_k, top_k
from gradeline.plans.retrieval import (
    BM25_B, BM25_K1, FUSION_OFFSET, SCORE_DIGITS, TOP_K, asked_words, best_first, packed_documents, packed_questions, score_key,
)
from gradeline.session import reach_package
from gradeline.sources.tables import discard, keep

KEYS = ["entity", "as_of"]
#: Documents and days in one product.
DOCUMENTS, DAYS = 4096, 64


def packed_matches(matches: DataFrame, n_documents: int) -> DataFrame:
    """(entity, part, hits): the word hits of a question in parts of about DOCUMENTS documents of the corpus, kept."""
    part = F.pmod(F.xxhash64("doc_id"), F.lit(max(1, -(-n_documents // DOCUMENTS)))).cast("int")
    hit = F.struct("doc_id", "published_date", "word", "tf", "length")
    return keep(matches.groupBy("entity", part.alias("part")).agg(F.collect_list(hit).alias("hits")), "packed_matches")


def packed_days(rarities: DataFrame, requests: DataFrame) -> DataFrame:
    """(entity, block, days, weights): the days asked of a question, DAYS at a time, with the weights of its words on each.

    A question has few words and a day once, so what is gathered is bounded by the calendar.
    """
    start = F.lit("1970-01-01").cast("date")
    block = F.floor(F.datediff("as_of", start) / DAYS).cast("int")
    days = requests.groupBy("entity", block.alias("block")).agg(F.array_sort(F.collect_set("as_of")).alias("days"))
    weights = rarities.groupBy("entity", block.alias("block")).agg(F.collect_list(F.struct("as_of", "word", "idf", "mean")).alias("weights"))
    return days.join(weights, ["entity", "block"])


class WordScores:
    """Scores of the hits (doc_id, published_date, word, tf, length) of a question on some days, column by column.

    ``ids`` are its documents in ascending order, ``dates`` theirs, ``scores`` has a row a day and a column a document; a document of
    a later day scores minus infinity.
    """

    def __init__(self, hits: pa.StructArray, days: list, weights: list[dict]):
        id_, date, word, tf, size = hits.flatten()
        coded = id_.dictionary_encode()
        order = pc.array_sort_indices(coded.dictionary).to_numpy()
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        doc = number[coded.indices.to_numpy()]
        self.ids = coded.dictionary.take(pa.array(order))
        at = date.cast(pa.int32()).to_numpy()
        self.dates = np.zeros(len(order), np.int32)
        self.dates[doc] = at

        place = {d: i for i, d in enumerate(days)}
        spelt = word.dictionary_encode()
        words = {w: i for i, w in enumerate(spelt.dictionary.to_pylist())}
        idf, mean = np.zeros((len(days), len(words))), np.ones(len(days))
        for x in weights:
            mean[place[x["as_of"]]] = x["mean"]
            if x["word"] in words:
                idf[place[x["as_of"]], words[x["word"]]] = x["idf"]
        # By date, so that the hits of a day's corpus come first.
        by_date = np.argsort(at, kind="stable")
        at, doc, word = at[by_date], doc[by_date], spelt.indices.to_numpy()[by_date]
        tf, size = (x.to_numpy()[by_date].astype(np.float64) for x in (tf, size))
        limits = np.array(days, "datetime64[D]").astype(np.int64)
        self.scores = np.full((len(days), len(order)), -np.inf)
        for j, n in enumerate(np.searchsorted(at, limits, "right").tolist()):
            damping = BM25_K1 * (1 - BM25_B + BM25_B * size[:n] / mean[j])
            gain = idf[j][word[:n]] * tf[:n] * (BM25_K1 + 1) / (tf[:n] + damping)
            sums = np.bincount(doc[:n], gain, len(order))
            known = self.dates <= limits[j]
            self.scores[j, known] = np.round(sums[known], SCORE_DIGITS) + 0.0

    def best(self, day: int, k: int) -> np.ndarray:
        """Numbers of the ``k`` best documents of a day, the best first; ids ascend, so equal scores go by id."""
        loss = -self.scores[day]
        some = np.flatnonzero(loss < np.inf)
        if len(some) > k:
            some = some[loss[some] <= np.partition(loss[some], k - 1)[k - 1]]
        return some[np.argsort(loss[some], kind="stable")[:k]]

    def places(self, day: int, marks: list[dict]) -> np.ndarray:
        """How many of the marks, (loss, doc_id) in ascending order, come before each document of a day."""
        here = np.flatnonzero(self.scores[day] > -np.inf)
        losses = np.array([m["loss"] for m in marks])
        loss = -self.scores[day][here]
        place = np.searchsorted(losses, loss, "left")
        tied = np.flatnonzero(place < np.searchsorted(losses, loss, "right"))
        if len(tied):  # equal scores: the ids decide
            ids = self.ids.to_numpy(zero_copy_only=False)
            for m in marks:
                equal = tied[loss[tied] == m["loss"]]
                place[equal] += here[equal] >= np.searchsorted(ids, m["doc_id"], "right")
        return place


def by_part(packed: DataFrame, asked: DataFrame, use: Callable[[dict, WordScores], list], schema: pa.Schema, ddl: str) -> DataFrame:
    """``use(row, scores)``, columns, for every part of the hits and block of days of a question."""
    reach_package(packed.sparkSession)
    met = packed.join(asked, "entity")
    entity = schema.field("entity").type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names if c != "hits"}
                columns = use(row, WordScores(batch.column("hits")[i].values, row["days"], row["weights"]))
                entities = pa.array([row["entity"]], entity).take(pa.array(np.zeros(len(columns[0]), np.int64)))
                yield pa.RecordBatch.from_arrays([entities, *columns], schema=schema)

    return met.mapInArrow(run, ddl)


def kinds(packed: DataFrame) -> tuple[tuple[pa.DataType, str], tuple[pa.DataType, str]]:
    """Arrow type and name of the types of the entity and of the ids."""
    from pyspark.sql.pandas.types import to_arrow_type

    id_ = packed.schema["hits"].dataType.elementType["doc_id"].dataType
    entity = packed.schema["entity"].dataType
    return (to_arrow_type(entity), entity.simpleString()), (to_arrow_type(id_), id_.simpleString())


def by_day(days: list, parts: list[np.ndarray]) -> pa.Array:
    """The days, each as often as its part has members."""
    return pa.array(days, pa.date32()).take(pa.array(np.repeat(np.arange(len(parts)), [len(p) for p in parts])))


def joined(parts: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *parts]).astype(kind)


def best_by_words(packed: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(entity, as_of, doc_id, score): the ``k`` best of every part for each day asked."""

    def use(row: dict, found: WordScores) -> list:
        best = [found.best(j, k) for j in range(len(row["days"]))]
        scores = [found.scores[j][at] for j, at in enumerate(best)]
        return [by_day(row["days"], best), found.ids.take(pa.array(joined(best, np.int64))), pa.array(joined(scores, np.float64))]

    (entity, entity_ddl), (id_, id_ddl) = kinds(packed)
    schema = pa.schema([("entity", entity), ("as_of", pa.date32()), ("doc_id", id_), ("score", pa.float64())])
    return by_part(packed, asked, use, schema, f"entity {entity_ddl}, as_of date, doc_id {id_ddl}, score double")


def word_places(packed: DataFrame, asked: DataFrame) -> DataFrame:
    """(entity, as_of, place, n): how many documents of the day have exactly ``place`` of the request's marks before them."""

    def use(row: dict, found: WordScores) -> list:
        marks = {m["as_of"]: m["marks"] for m in row["dated_marks"]}
        counted = [
            np.unique(found.places(j, marks[day]) if day in marks else np.zeros(0, np.int64), return_counts=True)
            for j, day in enumerate(row["days"])
        ]
        places, counts = ([c[i] for c in counted] for i in (0, 1))
        return [by_day(row["days"], places), pa.array(joined(places, np.int32)), pa.array(joined(counts, np.int64))]

    (entity, entity_ddl), _ = kinds(packed)
    schema = pa.schema([("entity", entity), ("as_of", pa.date32()), ("place", pa.int32()), ("n", pa.int64())])
    return by_part(packed, asked, use, schema, f"entity {entity_ddl}, as_of date, place int, n long")


def _marks(some: DataFrame) -> DataFrame:
    return some.groupBy(*KEYS).agg(F.sort_array(F.collect_list(score_key())).alias("marks"))


def _by_entity(marks: DataFrame) -> DataFrame:
    return marks.groupBy("entity").agg(F.collect_list(F.struct("as_of", "marks")).alias("dated_marks"))


def _ranks(marks: DataFrame, placed: DataFrame) -> DataFrame:
    """(entity, as_of, doc_id, rank): exact ranks of the marks, from how many rows lie at each place among them."""
    totals = placed.groupBy(*KEYS, "place").agg(F.sum("n").alias("n"))
    counts = totals.groupBy(*KEYS).agg(F.collect_list(F.struct("place", "n")).alias("counts"))
    up_to = F.aggregate(F.filter("counts", lambda c: c["place"] <= F.col("i")), F.lit(0).cast("bigint"), lambda acc, c: acc + c["n"])
    return marks.select(*KEYS, F.posexplode("marks").alias("i", "mark")).join(counts, KEYS).select(
        *KEYS, F.col("mark.doc_id").alias("doc_id"), up_to.cast("int").alias("rank")
    )


def hybrid_top_k_as_of(
    documents: DataFrame, postings: Postings, questions: DataFrame, requests: DataFrame, k: int = TOP_K, offset: int = FUSION_OFFSET
) -> DataFrame:
    """The ``k`` best documents of every requested (entity, as_of) under reciprocal rank fusion.

    As ``hybrid_top_k``, for any number of days: ``documents`` give vectors and dates, words come from their ``postings``. Word
    weights are those of the corpus of the day. Only first places and the few documents that are first in one list alone are ever
    rows; ranks in the other list are counted exactly.
    """
    pair = [*KEYS, "doc_id"]
    depth = offset + 2 * k
    requests = keep(requests.select(*KEYS).distinct(), "requests")
    questions = keep(questions.select("entity", "query_text", "query_vector"), "questions")
    matches = keep(postings.matches(asked_words(questions)), "matches")
    rarities = keep(postings.rarities(matches, requests), "rarities")
    n_documents = postings.corpus(requests).agg(F.max("n")).first()[0] or 0
    hits = packed_matches(matches, n_documents)
    days = keep(packed_days(rarities, requests), "packed_days")
    packed = packed_documents(documents, by_day=True)

    by_vector = nearest(packed, packed_questions(questions), depth, per_day=True)
    first_by_vector = keep(as_of_top_k(by_vector, requests, "entity", "published_date", "as_of", best_first(), depth).select(*pair, "score", "rank"), "first_by_vector")
    first_by_word = keep(top_k(best_by_words(hits, days, depth), KEYS, best_first(), depth, spread_by="doc_id"), "first_by_word")
    only_by_word = first_by_word.select(*pair).join(first_by_vector, pair, "left_anti")
    only_by_vector = first_by_vector.select(*pair).join(first_by_word, pair, "left_anti")

    angle = cosine_of(only_by_word.select("entity", "doc_id").distinct(), documents, questions, lambda d, q: cosine(d, length(d), q, length(q)))
    deep_by_vector = only_by_word.join(angle, ["entity", "doc_id"])
    damping = BM25_K1 * (1 - BM25_B + BM25_B * F.col("length") / F.col("mean"))
    gain = F.col("idf") * F.col("tf") * (BM25_K1 + 1) / (F.col("tf") + damping)
    deep_by_word = (
        only_by_vector.join(matches, ["entity", "doc_id"]).join(rarities, [*KEYS, "word"])
        .groupBy(*pair).agg(F.round(F.sum(gain), SCORE_DIGITS).alias("score"))
    )
    vector_marks, word_marks = keep(_marks(deep_by_vector), "vector_marks"), keep(_marks(deep_by_word), "word_marks")
    marked = pack(questions.select("entity", "query_vector").join(_by_entity(vector_marks), "entity"), "query_vector", ["entity", "dated_marks"], "marked_questions")
    semantic = first_by_vector.select(*pair, "rank").unionByName(_ranks(vector_marks, dated_places(packed, marked)))
    placed_words = word_places(hits, days.join(_by_entity(word_marks), "entity"))
    lexical = first_by_word.select(*pair, "rank").unionByName(_ranks(word_marks, placed_words))
    none = F.lit(None).cast("int")
    fused = (
        semantic.select(*pair, F.col("rank").alias("semantic_rank"), none.alias("lexical_rank"))
        .unionByName(lexical.select(*pair, none.alias("semantic_rank"), F.col("rank").alias("lexical_rank")))
        .groupBy(*pair).agg(F.max("semantic_rank").alias("semantic_rank"), F.max("lexical_rank").alias("lexical_rank"))
    )
    parts = [F.coalesce(1.0 / (offset + F.col(c)), F.lit(0.0)) for c in ("semantic_rank", "lexical_rank")]
    best = keep(top_k(fused.withColumn("score", F.round(parts[0] + parts[1], SCORE_DIGITS)), KEYS, best_first(), k), "fused")
    discard(matches, rarities, hits, days, packed, first_by_vector, first_by_word, vector_marks, word_marks, marked)
    return best
