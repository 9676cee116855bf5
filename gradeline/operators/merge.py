"""Keyed merges as joins, for table formats without MERGE.

None of these hints a broadcast. Spark measures the source side itself: a small batch is broadcast
and the target is not shuffled at all, a large one falls back to a sort-merge join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeline.functions.dates import as_column
from gradeline.operators.latest import latest_per_key


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail the job at run time when two rows share a key; NULL keys are left alone.

    Rows with a NULL in the key match nothing, so they are spread out instead of meeting in one task.
    """
    has_null = reduce(or_, [F.col(key).isNull() for key in keys])
    spread = F.when(has_null, F.pmod(F.monotonically_increasing_id(), F.lit(1009)))
    window = Window.partitionBy(*keys, "_spread").orderBy(F.lit(1))
    repeated = ~has_null & (F.row_number().over(window) > 1)
    message = F.lit(f"two source rows match one target row on {list(keys)}")
    flag = F.when(repeated, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return df.withColumn("_spread", spread).withColumn("_unique", flag).where(F.col("_unique")).drop("_unique", "_spread")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    newest_first: Sequence[Column | str] | None = None,
) -> DataFrame:
    """Replace matched rows, insert the others, keep what the source does not name.

    Several source rows with one key are reduced to the newest when ``newest_first`` is given and
    fail the job otherwise. As in an equality merge, a NULL key matches nothing and is inserted.
    Columns that only one side has are NULL on the other.
    """
    source = latest_per_key(source, keys, newest_first) if newest_first else assert_unique(source, keys)
    kept = target.join(source.select(*keys), list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(source, allowMissingColumns=True)


def delete_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop the target rows whose key occurs in the source."""
    return target.join(source.select(*keys), list(keys), "left_anti").select(*target.columns)


def replace_slice(target: DataFrame, batch: DataFrame, column: str, value: Column) -> DataFrame:
    """Drop one slice of the target (one day, say) and append the new rows of it."""
    kept = target.where(~as_column(column).eqNullSafe(value))
    return kept.unionByName(batch, allowMissingColumns=True)


def append_evolving(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Append a batch that may have more or fewer columns; absent ones are NULL."""
    return target.unionByName(batch, allowMissingColumns=True)


def add_missing_columns(df: DataFrame, ddl_types: dict[str, str]) -> DataFrame:
    """Add the named columns as NULL where the table does not have them yet."""
    missing = {c: F.lit(None).cast(t) for c, t in ddl_types.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df
