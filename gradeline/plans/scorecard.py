"""Grading calls against what happened, and against simple baselines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeline.functions.picks import digest_index, hashed_index, pick
from gradeline.functions.scores import CALLS, HOLD, RISE, Z_95, classify_move, wilson_bounds
from gradeline.plans.popularity import moves

# The cells of the report that are shown even when empty
SOURCES = ("backfill", "live")
AGENT_PREFIX = "agent_"
MODELS = (
    "agent_rag", "agent_no_rag", "agent_no_rag_big",
    "always_hold", "always_rise", "persistence", "random",
)


def grade(predictions: DataFrame, symbols: DataFrame, popularity: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """One row per prediction; the actual move and the hit stay NULL until the future is known.

    The cutoffs are one row, read as scalar subqueries. The three popularity look-ups (that day, the
    horizon later, the horizon before) are one grouped table keyed like the predictions, so
    predictions are shuffled once. Without a cutoff row nothing can be graded and nothing returned.
    """
    horizon = cutoffs.select("horizon_days").scalar()
    low, high = cutoffs.select("fall_below").scalar(), cutoffs.select("rise_above").scalar()
    around = moves(popularity, horizon).withColumnRenamed("d", "prediction_date")
    graded = (
        predictions.join(symbols, "symbol")
        .where(horizon.isNotNull())
        .join(around, ["brand", "prediction_date"], "left")
        .withColumn("actual_move", classify_move("delta", low, high))
        .withColumn("prior_move", classify_move("prior_delta", low, high))
    )
    hit = F.when(F.col("actual_move").isNotNull(), F.coalesce(F.col("call") == F.col("actual_move"), F.lit(False)))
    return graded.select(
        "symbol", "brand", "prediction_date", "source", "variant", "call",
        "pop_then", "pop_future", "delta", "actual_move", "prior_move",
        hit.cast("int").alias("hit"),
    )


def random_call(seed: str | None) -> Column:
    """A call drawn per brand and day: by Spark's hash of a seed, or by MD5 when there is none."""
    columns = ["brand", "prediction_date"]
    index = digest_index(columns, len(CALLS)) if seed is None else hashed_index(columns, seed, len(CALLS))
    return pick(CALLS, index)


def graded_counts(scorecard: DataFrame, seed: str | None) -> DataFrame:
    """(source, model, n, hits) of the agents and of every baseline, in one pass over the scorecard.

    Agents are graded per prediction, baselines once per brand and day. Predictions are counted per
    brand, day and variant first; the second grouping puts a day's few variants beside the baselines.
    """
    day = ["source", "brand", "prediction_date", "actual_move", "prior_move"]
    actual, prior = F.col("actual_move"), F.col("prior_move")
    rules = {
        "always_hold": actual == HOLD,
        "always_rise": actual == RISE,
        "persistence": actual == prior,
        "random": actual == random_call(seed),
    }
    one = F.lit(1).cast("bigint")
    # Without a prior window persistence has no answer, so its cell counts fewer days.
    baselines = F.filter(
        F.array(*[
            F.struct(F.lit(name).alias("model"), one.alias("n"), rule.cast("bigint").alias("hits"))
            for name, rule in rules.items()
        ]),
        lambda b: b["hits"].isNotNull(),
    )
    return (
        scorecard.where(actual.isNotNull())
        .groupBy(*day, F.concat(F.lit(AGENT_PREFIX), "variant").alias("model"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("hit").alias("hits"))
        .groupBy(*day)
        .agg(F.collect_list(F.struct("model", "n", "hits")).alias("agents"))
        .select("source", F.inline(F.concat(F.col("agents"), baselines)))
        .groupBy("source", "model")
        .agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
    )


def summarise(
    scorecard: DataFrame,
    skips: DataFrame,
    seed: str | None = None,
    sources: Sequence[str] = SOURCES,
    models: Sequence[str] = MODELS,
    declared_only: bool = False,
) -> DataFrame:
    """Hits, hit rate and Wilson interval per source and model, with skipped calls for agents.

    ``declared_only`` keeps the report to the declared cells.
    """
    zero = F.lit(0).cast("bigint")
    counted = graded_counts(scorecard, seed).withColumn("skipped", zero)
    skipped = (
        skips.groupBy("source", F.concat(F.lit(AGENT_PREFIX), "variant").alias("model"))
        .agg(F.count(F.lit(1)).alias("skipped"))
        .withColumns({"n": zero, "hits": zero})
    )
    declared = (
        scorecard.sparkSession.range(1)
        .select(F.explode(F.array(*[F.lit(s) for s in sources])).alias("source"))
        .select("source", F.explode(F.array(*[F.lit(m) for m in models])).alias("model"))
        .select("source", "model", zero.alias("n"), zero.alias("hits"), zero.alias("skipped"))
    )
    # Counts, skips and the empty grid have one shape, so the dense report is their sum, not a join.
    cells = declared.unionByName(counted).unionByName(skipped)
    if declared_only:
        cells = cells.where(F.col("source").isin(*sources) & F.col("model").isin(*models))
    totals = cells.groupBy("source", "model").agg(
        F.sum("n").alias("n"), F.sum("hits").alias("hits"), F.sum("skipped").alias("skipped")
    )
    low, high = wilson_bounds("hits", "n", Z_95)
    rate = F.try_divide(F.col("hits").cast("double"), F.col("n").cast("double"))
    return totals.select(
        "source", "model", "n", "hits",
        F.round(rate, 3).alias("hit_rate"),
        F.round(low, 3).alias("wilson_lo"),
        F.round(high, 3).alias("wilson_hi"),
        F.when(F.col("model").startswith(AGENT_PREFIX), F.col("skipped")).alias("skipped"),
    )
