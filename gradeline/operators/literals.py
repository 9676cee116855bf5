"""Short relations written in the program: alias tables, symbol maps, reporting grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MAX_LITERAL_ROWS = 1_000


def literal_rows(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """Rows typed by a DDL string; up to MAX_LITERAL_ROWS of them are marked for broadcast."""
    if not rows:
        return empty_table(spark, ddl)
    fields = StructType.fromDDL(ddl).fields
    typed = [
        F.struct(*[F.lit(value).cast(f.dataType).alias(f.name) for value, f in zip(row, fields, strict=True)])
        for row in rows
    ]
    made = spark.range(1).select(F.inline(F.array(*typed)))
    return F.broadcast(made) if len(rows) <= MAX_LITERAL_ROWS else made


def empty_table(spark: SparkSession, ddl: str) -> DataFrame:
    """A typed table without rows."""
    fields = StructType.fromDDL(ddl).fields
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
