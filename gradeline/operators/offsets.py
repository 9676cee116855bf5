"""Values a fixed number of calendar days apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def offset_values(series: DataFrame, entity: str, day: str, value: str, horizon: Column) -> DataFrame:
    """Per (entity, day): the value then, ``horizon`` days later and ``horizon`` days before.

    The series has one row per (entity, day); days may be missing. Every row is sent to the three
    days it belongs to and grouped there, so three offset joins become one shuffle on
    (entity, day), which spreads even an entity that holds most of the series.
    """
    nothing = F.lit(None).cast("double")
    current = F.col(value).cast("double")
    places = F.array(
        F.struct(F.col(day).alias("day"), current.alias("then"), nothing.alias("future"), nothing.alias("prior")),
        F.struct(
            F.date_sub(F.col(day), horizon).alias("day"),
            nothing.alias("then"), current.alias("future"), nothing.alias("prior"),
        ),
        F.struct(
            F.date_add(F.col(day), horizon).alias("day"),
            nothing.alias("then"), nothing.alias("future"), current.alias("prior"),
        ),
    )
    return (
        series.select(F.col(entity), F.inline(places))
        .groupBy(F.col(entity), F.col("day").alias(day))
        .agg(
            F.max("then").alias("value_then"),
            F.max("future").alias("value_future"),
            F.max("prior").alias("value_prior"),
        )
    )
