"""JSON landing files to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_records(
    spark: SparkSession, path: str | Sequence[str], schema: str, pretty: bool = True, source_file: str | None = None
) -> DataFrame:
    """Rows of all files that a path or wildcard names, under a declared schema.

    A file that is cut off or does not fit the schema fails the read, and the error names the file: half
    a file must not replace a good table. ``source_file`` adds the path of each row's file.

    Pretty-printed files hold one document each and are read whole, one file per task, so they have
    to be landed in bounded sizes. Files with one document per line (``pretty=False``) are split.
    """
    paths = [path] if isinstance(path, str) else list(path)
    rows = (
        spark.read.schema(schema)
        .option("multiLine", pretty)
        .option("recursiveFileLookup", True)
        .option("mode", "FAILFAST")
        .json(paths)
    )
    return rows.withColumn(source_file, F.col("_metadata.file_path")) if source_file else rows


def stamp(df: DataFrame, ingested_at: Column) -> DataFrame:
    """Add the load time, the same for the whole batch."""
    return df.withColumn("_ingested_at", ingested_at)


def unnest(df: DataFrame, array: str, carry: Sequence[Column | str]) -> DataFrame:
    """One row per array element with its fields as columns, beside columns of the document.

    A document with an empty or missing array yields no rows.
    """
    return df.select(*carry, F.explode(array).alias("_item")).select("*", "_item.*").drop("_item")


def unnest_ranked(df: DataFrame, array: str, carry: Sequence[Column | str], rank: str = "_rank") -> DataFrame:
    """As ``unnest``, with the 1-based position in the array as a rank."""
    return (
        df.select(*carry, F.posexplode(array).alias("_position", "_item"))
        .withColumn(rank, F.col("_position") + 1)
        .select("*", "_item.*")
        .drop("_position", "_item")
    )


def write_documents(df: DataFrame, path: str, batch: Column) -> None:
    """Land rows as JSON array files, one file per ``batch``.

    The batch expression has to bound the rows per file (a range of ids, a page, a day of a chart):
    a batch is one document and is put together in one task.
    """
    row = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    (
        df.select(batch.alias("batch"), row.alias("row"))
        .groupBy("batch")
        .agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list("row"), ",\n"), F.lit("\n]")).alias("value"))
        .write.mode("errorifexists")
        .partitionBy("batch")
        .text(path)
    )
