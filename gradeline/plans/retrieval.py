"""Top-k retrieval over the text corpus, limited to what was published by a date.

Vectors are compared by matrix products of packed blocks (``operators.nearest``): documents are read
once for any number of questions, and only the best rows of every product are ever rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeline.functions.text import words
from gradeline.functions.vectors import cosine, length
from gradeline.operators.nearest import cosine_of, nearest, pack, places
from gradeline.operators.topk import as_of_top_k, top_k
from gradeline.sources.tables import keep

# Fixed values
TOP_K = 5
FUSION_OFFSET = 60
BM25_K1 = 1.2
BM25_B = 0.75
SCORE_DIGITS = 9


def packed_documents(documents: DataFrame, by_day: bool = False) -> DataFrame:
    """The vectors of the documents, read once and packed; ``by_day`` packs those of near dates together."""
    rows = documents.select("doc_id", "published_date", "embedding")
    return pack(rows, "embedding", ["doc_id", "published_date"], "packed_documents", "published_date" if by_day else None)


def packed_questions(questions: DataFrame) -> DataFrame:
    return pack(questions.select("entity", "query_vector"), "query_vector", ["entity"], "packed_questions")


def best_first() -> list[Column]:
    return [F.col("score").desc(), F.col("doc_id").asc()]


def cosine_top_k(documents: DataFrame, questions: DataFrame, k: int = TOP_K) -> DataFrame:
    """The ``k`` nearest documents of every question, whatever their date."""
    found = nearest(packed_documents(documents), packed_questions(questions), k, per_day=False)
    return top_k(found, ["entity"], best_first(), k, spread_by="doc_id")


def cosine_top_k_as_of(
    documents: DataFrame, questions: DataFrame, requests: DataFrame, k: int = TOP_K
) -> DataFrame:
    """The ``k`` nearest documents published by each requested (entity, as_of)."""
    found = nearest(packed_documents(documents, by_day=True), packed_questions(questions), k, per_day=True)
    return as_of_top_k(found, requests, "entity", "published_date", "as_of", best_first(), k)


def asked_words(questions: DataFrame) -> DataFrame:
    """(entity, word) of every question."""
    return questions.select("entity", F.explode(F.array_distinct(words("query_text"))).alias("word"))


def word_matches(documents: DataFrame, asked: DataFrame) -> DataFrame:
    """(doc_id, length, word, tf) of the asked words in whole texts.

    Every text also has one row for the word ``''``, so the number of texts and their mean length
    come out of the same pass. Other words are dropped before anything is shuffled.
    """
    texts = documents.where(F.col("text_content").isNotNull()).select("doc_id", words("text_content").alias("_words"))
    wanted = asked.select("word").unionByName(asked.sparkSession.range(1).select(F.lit("").alias("word"))).distinct()
    # The outer explode: a plain one adds a filter on the array, and texts are split a second time.
    occurrences = texts.select(
        "doc_id", F.size("_words").alias("length"), F.explode_outer(F.array_append("_words", F.lit(""))).alias("word")
    )
    return (
        occurrences.join(wanted, "word", "left_semi")
        .groupBy("doc_id", "length", "word")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def word_weights(matches: DataFrame, asked: DataFrame) -> DataFrame:
    """(entity, word, idf, mean_length): a row per question word that some document has.

    The numbers are those of the matched corpus, so a corpus cut at a date has that date's numbers.
    """
    totals = matches.where(F.col("word") == "").agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("mean"))
    n_docs, mean_length = totals.select("n").scalar(), totals.select("mean").scalar()
    spread = matches.where(F.col("word") != "").groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    rarity = F.log(1 + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    return asked.join(spread, "word").select("entity", "word", rarity.alias("idf"), mean_length.alias("mean_length"))


def bm25_scores(matches: DataFrame, weights: DataFrame) -> DataFrame:
    """(entity, doc_id, score) of the documents that contain a word of the question."""
    damping = BM25_K1 * (1 - BM25_B + BM25_B * F.col("length") / F.col("mean_length"))
    gain = F.col("idf") * F.col("tf") * (BM25_K1 + 1) / (F.col("tf") + damping)
    return (
        matches.join(weights, "word")
        .groupBy("entity", "doc_id")
        .agg(F.round(F.sum(gain), SCORE_DIGITS).alias("score"))
    )


def score_key() -> Column:
    """Orders like ``best_first``: the smaller key is the better row."""
    return F.struct((-F.col("score")).alias("loss"), F.col("doc_id").alias("doc_id"))


def _marks(some: DataFrame) -> DataFrame:
    return some.groupBy("entity").agg(F.sort_array(F.collect_list(score_key())).alias("marks"))


def _word_places(scores: DataFrame, marks: DataFrame) -> DataFrame:
    """(entity, place, n): each row of the list is placed among the few marks of its entity where it is read."""
    place = F.size(F.filter("marks", lambda m: m < F.col("_key")))
    return scores.select("entity", score_key().alias("_key")).join(marks, "entity").select(
        "entity", place.alias("place"), F.lit(1).cast("long").alias("n")
    )


def _ranks(marks: DataFrame, placed: DataFrame) -> DataFrame:
    """(entity, doc_id, rank): exact ranks of the marks, from how many rows lie at each place among them.

    No list is sorted; only counts per place are shuffled.
    """
    counts = (
        placed.groupBy("entity", "place").agg(F.sum("n").alias("n"))
        .groupBy("entity").agg(F.collect_list(F.struct("place", "n")).alias("counts"))
    )
    # Places 0..i hold the i-th key itself and every row that is better.
    up_to = F.aggregate(
        F.filter("counts", lambda c: c["place"] <= F.col("i")), F.lit(0).cast("bigint"), lambda sum_, c: sum_ + c["n"]
    )
    return (
        marks.select("entity", F.posexplode("marks").alias("i", "mark"))
        .join(counts, "entity")
        .select("entity", F.col("mark.doc_id").alias("doc_id"), up_to.cast("int").alias("rank"))
    )


def hybrid_top_k(
    documents: DataFrame,
    questions: DataFrame,
    as_of: Column,
    k: int = TOP_K,
    offset: int = FUSION_OFFSET,
) -> DataFrame:
    """The ``k`` best documents published by ``as_of`` under reciprocal rank fusion.

    A document scores ``1 / (offset + rank)`` in the cosine list and again in the word list if it is
    in it. Below the first ``offset + 2k`` places of both lists a document scores less than the k-th
    place of one list alone, so those places hold every possible answer. Where such a document lies
    deeper in the other list, its rank there is counted exactly.

    Questions, their words and the first places are kept as tables: they are needed several times,
    and Spark then knows they are small enough to broadcast, or that they are not.
    """
    eligible = documents.where(F.col("published_date") <= as_of)
    depth = offset + 2 * k
    id_pair = ["entity", "doc_id"]

    questions = keep(questions.select("entity", "query_text", "query_vector"), "questions")
    asked = keep(asked_words(questions), "asked_words")
    matches = keep(word_matches(eligible, asked), "word_matches")
    packed = packed_documents(eligible)
    by_vector = nearest(packed, packed_questions(questions), depth, per_day=False).select(*id_pair, "score")
    by_word = bm25_scores(matches, keep(word_weights(matches, asked), "word_weights"))

    first = keep(
        top_k(by_vector, ["entity"], best_first(), depth, spread_by="doc_id").withColumn("list", F.lit("vector"))
        .unionByName(top_k(by_word, ["entity"], best_first(), depth, spread_by="doc_id").withColumn("list", F.lit("word"))),
        "first_places",
    )
    first_by_vector = first.where(F.col("list") == "vector").drop("list")
    first_by_word = first.where(F.col("list") == "word").drop("list")
    only_by_word = first_by_word.select(*id_pair).join(first_by_vector, id_pair, "left_anti")
    only_by_vector = first_by_vector.select(*id_pair).join(first_by_word, id_pair, "left_anti")
    # The few pairs are scored again instead of being looked up in a scored copy of the corpus.
    deep = keep(
        cosine_of(only_by_word, eligible, questions, lambda d, q: cosine(d, length(d), q, length(q)))
        .withColumn("list", F.lit("vector"))
        .unionByName(by_word.join(only_by_vector, id_pair, "left_semi").withColumn("list", F.lit("word"))),
        "deep_places",
    )
    vector_marks = keep(_marks(deep.where(F.col("list") == "vector")), "vector_marks")
    word_marks = keep(_marks(deep.where(F.col("list") == "word")), "word_marks")
    marked = pack(
        questions.select("entity", "query_vector").join(vector_marks, "entity"), "query_vector", ["entity", "marks"], "marked_questions"
    )

    semantic = first_by_vector.select(*id_pair, "rank").unionByName(_ranks(vector_marks, places(packed, marked)))
    lexical = first_by_word.select(*id_pair, "rank").unionByName(_ranks(word_marks, _word_places(by_word, word_marks)))
    none = F.lit(None).cast("int")
    fused = (
        semantic.select(*id_pair, F.col("rank").alias("semantic_rank"), none.alias("lexical_rank"))
        .unionByName(lexical.select(*id_pair, none.alias("semantic_rank"), F.col("rank").alias("lexical_rank")))
        .groupBy(*id_pair)
        .agg(F.max("semantic_rank").alias("semantic_rank"), F.max("lexical_rank").alias("lexical_rank"))
    )
    parts = [F.coalesce(1.0 / (offset + F.col(c)), F.lit(0.0)) for c in ("semantic_rank", "lexical_rank")]
    return top_k(
        fused.withColumn("score", F.round(parts[0] + parts[1], SCORE_DIGITS)), ["entity"], best_first(), k
    )


def retrieved_context(hits: DataFrame, documents: DataFrame, keys: list[str]) -> DataFrame:
    """Per question the hits in rank order: ids, and (doc_id, text) pairs for the prompt.

    Texts are joined after the top k, so only k texts per question leave the corpus.
    """
    with_text = hits.join(documents.select("doc_id", F.col("text_content").alias("text")), "doc_id")
    ordered = F.sort_array(F.collect_list(F.struct("rank", "doc_id", "text")))
    return (
        with_text.groupBy(*keys)
        .agg(ordered.alias("_hits"))
        .select(
            *keys,
            F.transform("_hits", lambda h: h["doc_id"]).alias("retrieved_doc_ids"),
            F.transform("_hits", lambda h: F.struct(h["doc_id"].alias("doc_id"), h["text"].alias("text"))).alias("chunks"),
        )
    )


def lookahead_audit(predictions: DataFrame, corpus: DataFrame, by: list[str]) -> DataFrame:
    """How many retrieved documents, in how many calls, were published after the call's date.

    The call key is (symbol, prediction_date, source, variant). Only ids and dates are joined.
    """
    call = ["symbol", "prediction_date", "source", "variant"]
    cited = predictions.select(*call, F.explode_outer("retrieved_doc_ids").alias("doc_id"))
    dated = cited.join(corpus.select("doc_id", "published_date"), "doc_id", "left")
    late = F.col("published_date") > F.col("prediction_date")
    per_call = dated.groupBy(*call).agg(
        F.count("doc_id").alias("docs"),
        F.count_if(late).alias("late"),
        F.count_if(F.col("doc_id").isNotNull() & F.col("published_date").isNull()).alias("unknown"),
    )
    return per_call.groupBy(*by).agg(
        F.count(F.lit(1)).alias("calls"),
        F.sum("docs").alias("docs"),
        F.sum("late").alias("late_docs"),
        F.sum("unknown").alias("unknown_docs"),
        F.count_if(F.col("late") > 0).alias("calls_affected"),
    )
