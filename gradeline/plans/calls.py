"""Which calls to ask for, what to ask, and where the answers go."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeline.functions.replies import parse_reply
from gradeline.functions.scores import HORIZON_DAYS
from gradeline.plans.popularity import scorable_dates
from gradeline.sources.schemas import PREDICTION_KEY

# Fixed values
RAG, NO_RAG, BIG_SUFFIX = "rag", "no_rag", "_big"
#: How much of each retrieved text a prompt quotes unless told otherwise; search reads whole texts.
EXCERPT_CHARS = 500


def planned_variants(backfill: bool, use_rag: str = "", model: str = "") -> list[str]:
    """The variants one run asks for: both when live, only the one without retrieval in a backfill."""
    use_rag, model = use_rag.strip().lower(), model.strip().lower()
    if use_rag not in ("", "true", "false"):
        raise ValueError(f"use_rag is empty, true or false, not {use_rag!r}")
    if model not in ("", "big"):
        raise ValueError(f"model is empty or big, not {model!r}")
    if backfill and use_rag == "true":
        raise ValueError("a backfill has no texts to retrieve: leave use_rag empty or false")
    suffix = BIG_SUFFIX if model == "big" else ""
    if backfill or use_rag == "false":
        return [NO_RAG + suffix]
    if use_rag == "true":
        return [RAG + suffix]
    return [RAG + suffix, NO_RAG + suffix]


def _with_variants(pairs: DataFrame, source: str, variants: Sequence[str]) -> DataFrame:
    return pairs.select(
        "symbol", "brand", "as_of", F.lit(source).alias("source"),
        F.explode(F.array(*[F.lit(v) for v in variants])).alias("variant"),
    )


def live_plan(symbols: DataFrame, as_of: Column, use_rag: str = "", model: str = "") -> DataFrame:
    """Every symbol on one day, for each variant."""
    pairs = symbols.select("symbol", "brand", as_of.alias("as_of"))
    return _with_variants(pairs, "live", planned_variants(False, use_rag, model))


def backfill_plan(
    symbols: DataFrame,
    popularity: DataFrame,
    start: Column,
    end: Column,
    horizon: Column | int = HORIZON_DAYS,
    use_rag: str = "",
    model: str = "",
) -> DataFrame:
    """Every symbol on every day of the range that can be graded."""
    days = scorable_dates(popularity, horizon, start, end)
    pairs = symbols.join(days, "brand").select("symbol", "brand", F.col("d").alias("as_of"))
    return _with_variants(pairs, "backfill", planned_variants(True, use_rag, model))


def question_rows(symbols: DataFrame) -> DataFrame:
    """(entity, query_text): what is looked up in the corpus for each symbol."""
    text = F.concat(F.lit("What do news and viewers say about "), F.col("brand"), F.lit(" and its shows?"))
    return symbols.select(F.col("symbol").alias("entity"), text.alias("query_text"))


def signal_json(recent: Column, sentiment: Column, estimates: Column) -> Column:
    """The signals as one JSON object under this package's column names; what is unknown is null."""
    signals = F.struct("brand", "as_of", recent.alias("recent"), sentiment.alias("sentiment"), estimates.alias("estimates"))
    return F.to_json(signals, {"ignoreNullFields": "false"})


def excerpt(chunk: Column, size: int) -> Column:
    return F.concat_ws("\n", F.concat(F.lit("<<"), chunk["doc_id"], F.lit(">>")), F.substring(chunk["text"], 1, size))


def prompt_text(signals: Column, cutoffs: DataFrame, chunks: Column, excerpt_chars: int = EXCERPT_CHARS) -> Column:
    """What the model is asked: the task, the three answers and their limits, the signals, the form.

    Texts have a section of their own, which is there only when something was retrieved.
    """
    horizon = cutoffs.select("horizon_days").scalar()
    low, high = cutoffs.select("fall_below").scalar(), cutoffs.select("rise_above").scalar()
    due = F.date_add("as_of", horizon)
    task = F.format_string(
        "TASK\nToday is %s. Let P be the popularity of %s: 100 for first place in the chart, one less for each place "
        "below. Say what P on %s will be compared with P today.", F.col("as_of").cast("string"), F.col("brand"), due.cast("string"),
    )
    answers = F.format_string(
        "ANSWERS\nrise: P gains more than %.2f\nfall: P ends below today's value plus %.2f\nhold: every other case", high, low
    )
    evidence = F.concat(F.lit("EVIDENCE (JSON, oldest day first)\n"), signals)
    texts = F.when(
        F.size(chunks) > 0,
        F.concat(F.lit("TEXTS (published by today; name the ones you rely on)\n"),
                 F.array_join(F.transform(chunks, lambda c: excerpt(c, excerpt_chars)), "\n")),
    )
    form = F.lit(
        "FORM\nReply with a single JSON object that has three fields. call: one of the answers. "
        "confidence: low, medium or high. reasoning: a short remark on what decided it."
    )
    return F.concat_ws("\n\n", task, answers, evidence, texts, form)


def prompt_rows(
    plan: DataFrame,
    recent: DataFrame,
    sentiment: DataFrame,
    estimates: DataFrame,
    context: DataFrame,
    cutoffs: DataFrame,
    excerpt_chars: int = EXCERPT_CHARS,
) -> DataFrame:
    """One prompt per planned call, all in one plan.

    Signals are keyed by (symbol or brand, as_of) and context by (symbol, as_of); only the variants
    with retrieval get context. Texts are cut to ``excerpt_chars`` before they are joined.
    """
    context = context.withColumn("chunks", F.transform("chunks", lambda c: F.struct(
        c["doc_id"].alias("doc_id"), F.substring(c["text"], 1, excerpt_chars).alias("text")
    )))
    with_retrieval = F.col("variant").startswith(RAG)
    no_chunks = F.array().cast(context.schema["chunks"].dataType)
    rows = (
        plan.join(recent, ["brand", "as_of"], "left")
        .join(sentiment, ["symbol", "as_of"], "left")
        .join(estimates, ["symbol", "as_of"], "left")
        .join(context, ["symbol", "as_of"], "left")
        .withColumn("chunks", F.when(with_retrieval & F.col("chunks").isNotNull(), F.col("chunks")).otherwise(no_chunks))
        .withColumn("retrieved_doc_ids", F.transform("chunks", lambda c: c["doc_id"]))
    )
    no_recent = F.array().cast(recent.schema["recent"].dataType)
    signals = signal_json(F.coalesce("recent", no_recent), F.col("sentiment"), F.col("estimates"))
    return rows.select(
        "symbol", "brand", "as_of", "source", "variant", "retrieved_doc_ids",
        prompt_text(signals, cutoffs, F.col("chunks"), excerpt_chars).alias("prompt"),
    )


def first_parsed(replies: DataFrame, keys: Sequence[str], attempt: str = "attempt", reply: str = "reply") -> DataFrame:
    """Per key the first of all replies that parses, as ``parsed``; NULL when none does."""
    tried = replies.select(*keys, F.col(attempt).alias("_attempt"), parse_reply(reply).alias("_answer"))
    order = F.when(F.col("_answer").isNotNull(), F.col("_attempt"))
    return tried.groupBy(*keys).agg(F.min_by("_answer", order).alias("parsed"))


def answer_rows(asked: DataFrame, replies: DataFrame, model_endpoint: str, created_at: Column) -> DataFrame:
    """One row per key of ``asked`` (the key, retrieved_doc_ids): the answer, or NULLs for a skip."""
    key = list(PREDICTION_KEY)
    done = F.col("parsed").isNotNull()
    return asked.join(first_parsed(replies, key), key, "left").select(
        *key, "parsed.call", "parsed.confidence", "parsed.reasoning",
        F.when(done, F.col("retrieved_doc_ids")).alias("retrieved_doc_ids"),
        F.when(done, F.lit(model_endpoint)).alias("model_endpoint"), created_at.alias("created_at"),
    )


def route_answers(answered: DataFrame, created_at: Column) -> tuple[DataFrame, DataFrame]:
    """Answers that parsed as prediction rows, the other keys as skip rows."""
    key = list(PREDICTION_KEY)
    done = answered.where(F.col("parsed").isNotNull()).select(
        *key, "parsed.call", "parsed.confidence", "parsed.reasoning",
        *[c for c in answered.columns if c not in (*key, "parsed")],
        created_at.alias("created_at"),
    )
    skipped = answered.where(F.col("parsed").isNull()).select(*key, created_at.alias("created_at"))
    return done, skipped
