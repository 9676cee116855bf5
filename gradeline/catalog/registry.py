"""Collects the queries and their SQL."""

from __future__ import annotations

import functools
import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from gradeline.session import use_utc

MODULES = ("ingest", "maintain", "layouts", "curation", "measures", "forecast", "search", "checks", "streams")

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def as_text(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, which every engine compares alike."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, (TimestampType, TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(make: Query) -> Query:
        @functools.wraps(make)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return as_text(make(use_utc(spark), sf_dir))

        _queries[name] = run
        if sql is not None:
            _oracles[name] = sql
        return run

    return register


def _load() -> None:
    for module in MODULES:
        importlib.import_module(f"gradeline.catalog.{module}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def oracles() -> dict[str, str]:
    _load()
    return dict(_oracles)
