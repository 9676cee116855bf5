"""What the operators share: table access, text primitives, Arrow batch sizes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeline.session import reach_package

#: The six ASCII white-space characters, ``[\x20\x09-\x0D]``.
WHITE = " \t\n\x0b\x0c\r"
LAST_ID = 2**63 - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_key(column: str = "doc_id") -> Column:
    """The id to compare rows by; a row without id sorts after all others."""
    return F.coalesce(F.col(f"`{column}`").cast("long"), F.lit(LAST_ID))


def held_out(column: str = "doc_id") -> Column:
    """Whether a row is for testing only: crc32 of the id as text leaves 1 on division by 3."""
    return F.coalesce(F.crc32(F.col(f"`{column}`").cast("string")) % 3 == 1, F.lit(False))


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also where lambdas inside refer to it."""
    return F.transform(F.array(value), use)[0]


def trim_white(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; texts that are all ASCII take the fast way to the same result."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    translated = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(ascii_only, F.lower(text)).otherwise(translated)


def words(text: Column) -> Column:
    """The maximal runs of characters outside WHITE; none for NULL.

    Replacing bytes and splitting at one character needs no regular expression.
    """
    spaced = F.coalesce(text, F.lit(""))
    for character in WHITE[1:]:
        spaced = F.replace(spaced, F.lit(character), F.lit(" "))
    return F.array_remove(F.split(spaced, " ", -1), "")


def map_batches(
    df: DataFrame, columns: list[str], make: Callable[[pa.RecordBatch], pa.RecordBatch], ddl: str, rows: int = 64
) -> DataFrame:
    """``make`` over Arrow batches of the chosen columns, a bounded number of rows at a time.

    The number of records that Spark sends to Python in one batch is a session setting; it is
    lowered here, since a batch of whole texts may otherwise outgrow a worker.
    """
    spark = df.sparkSession
    reach_package(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > 256:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                yield make(batch.slice(start, rows))

    return df.select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(run, ddl)
