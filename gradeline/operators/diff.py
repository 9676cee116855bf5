"""What changed between two versions of a keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def content_hash(columns: Sequence[str]) -> Column:
    """64-bit hash of a row; NULL and the value that follows it cannot change places unnoticed."""
    parts: list[Column] = []
    for name in columns:
        parts += [F.col(name).isNull(), F.col(name)]
    return F.xxhash64(*parts)


def _versions(old: DataFrame, new: DataFrame, keys: Sequence[str], content: Sequence[str]) -> DataFrame:
    # Decimal sums of the hashes: no overflow, no order, and equal copies are counted.
    hashed = content_hash(content).cast("decimal(20,0)")
    none = F.lit(None).cast("decimal(20,0)")
    before = old.select(*keys, hashed.alias("_old"), none.alias("_new"))
    after = new.select(*keys, none.alias("_old"), hashed.alias("_new"))
    return before.unionAll(after)


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], content: Sequence[str]) -> DataFrame:
    """Keys with ``change`` = insert, update or delete; unchanged keys are left out.

    Texts are hashed in the scan, so only keys and hashes are shuffled, and the grouping combines
    before the shuffle, so a key repeated in either version never meets its copies row by row.
    """
    totals = (
        _versions(old, new, keys, content)
        .groupBy(*keys)
        .agg(
            F.count("_old").alias("_n_old"),
            F.count("_new").alias("_n_new"),
            F.sum("_old").alias("_h_old"),
            F.sum("_new").alias("_h_new"),
        )
    )
    change = (
        F.when(F.col("_n_old") == 0, F.lit("insert"))
        .when(F.col("_n_new") == 0, F.lit("delete"))
        .when((F.col("_n_old") != F.col("_n_new")) | (F.col("_h_old") != F.col("_h_new")), F.lit("update"))
    )
    return totals.withColumn("change", change).where(F.col("change").isNotNull()).select(*keys, "change")


def sync_gate(old: DataFrame, new: DataFrame, keys: Sequence[str], content: Sequence[str]) -> DataFrame:
    """One row: rows on both sides and whether their contents are the same."""
    row_hash = [*keys, *content]
    return _versions(old, new, [], row_hash).agg(
        F.count("_old").alias("n_old"),
        F.count("_new").alias("n_new"),
        (
            (F.count("_old") == F.count("_new"))
            & F.coalesce(F.sum("_old"), F.lit(0)).eqNullSafe(F.coalesce(F.sum("_new"), F.lit(0)))
        ).alias("in_sync"),
    )
