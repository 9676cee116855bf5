"""One row per key, and the newest day of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from gradeline.functions.dates import as_column


def _orderable(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, MapType):
        return F.array_sort(F.map_entries(F.col(f"`{name}`")))
    return F.col(f"`{name}`")


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    newest_first: Sequence[Column | str],
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the newest row of every key.

    Ties are settled by ``tie_break``, by default every other column, so a rerun keeps the same row.
    The ``row_number = 1`` filter lets Spark drop older rows before the shuffle as well
    (``WindowGroupLimit``): a key with a third of all rows sends one row per input partition.
    """
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in keys]
    order = [as_column(c).desc_nulls_last() for c in newest_first]
    order += [_orderable(df, c).desc_nulls_last() for c in tie_break]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") == 1).drop("_rn")


def newest_day(df: DataFrame, day: Column | str, of_moment: bool = False) -> DataFrame:
    """Rows of the table's newest day. The maximum stays in the plan as a scalar subquery.

    With ``of_moment`` the column holds times: they are compared with the day's ends as they are, a range
    that files can be skipped by.
    """
    day = as_column(day)
    newest = df.select(F.max(day)).scalar()
    if not of_moment:
        return df.where(day == newest)
    start = F.date_trunc("day", newest)
    return df.where((day >= start) & (day < start + F.expr("INTERVAL 1 DAY")))
