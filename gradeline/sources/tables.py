"""Parquet tables: append, guarded refresh, slice replacement, write-once values.

A table is replaced by writing a fresh folder and then pointing the catalog entry at it, so readers
and failed jobs never see half a table, and a job may read the table it replaces.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gradeline.operators.latest import latest_per_key
from gradeline.session import shared_folder
from gradeline.sources.evolution import ADD, RENAME, WIDEN, Change, SchemaRefused, plan_schema, schema_after


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A Parquet folder with all columns that any of its files has."""
    reader = spark.read.option("mergeSchema", True)
    return (reader.schema(schema) if schema else reader).parquet(path)


def append_rows(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append a batch; its columns may differ from earlier ones (read with ``read_table``)."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Overwrite only the partitions that occur in ``df``; safe to run again.

    Spark moves the new folders into place one by one at the end, so a failure in that moment can leave
    a partition missing until the rerun. ``Database.replace_partitions`` has no such gap.

    Rows of one partition are brought together before the write, which saves small files; Spark
    splits a partition that is much larger than the others over several tasks.
    """
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def merge_partitions(
    stored: DataFrame | None, batch: DataFrame, keys: Sequence[str], newest_first: Sequence[str], partition: str
) -> DataFrame | None:
    """The partitions a batch touches, with its rows merged in; None when the batch is empty.

    A key belongs to one partition. The batch's partition values, one per day or the like, are read
    first: known values prune the stored table's folders, so a batch costs its own partitions. Rows
    without a value are a partition of their own.
    """
    fresh = latest_per_key(batch, [partition, *keys], newest_first)
    values = [row[0] for row in fresh.select(partition).distinct().collect()]
    if not values:
        return None
    if stored is None:
        return fresh
    day = F.col(partition)
    known = day.isin([v for v in values if v is not None])
    touched = stored.where(known | day.isNull() if None in values else known).select(*fresh.columns)
    both = touched.withColumn("_new", F.lit(0)).unionByName(fresh.withColumn("_new", F.lit(1)))
    return latest_per_key(both, [partition, *keys], [*newest_first, "_new"]).drop("_new")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write a step's result to the shared folder and go on from there.

    What follows does not compute the step again, survives lost executors, and Spark knows the
    result's size, so it broadcasts a small one and shuffles a large one by itself.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*kept: DataFrame) -> None:
    """Remove tables that ``keep`` wrote, once what was made of them is itself written."""
    for df in kept:
        spark = df.sparkSession
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def has_rows(df: DataFrame) -> bool:
    """Whether there is a row at all, without counting them."""
    return not df.isEmpty()


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


class Database:
    """The tables of one catalog database, kept as Parquet under one shared folder."""

    def __init__(self, spark: SparkSession, name: str, folder: str):
        self.spark, self.name, self.folder = spark, name, folder
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{folder}/{name}.db'")

    def full_name(self, table: str) -> str:
        return f"`{self.name}`.`{table}`"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.name}.{table}")

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.full_name(table))

    def create_if_absent(self, table: str, ddl: str, partition_by: str | None = None) -> None:
        stored_by = f"PARTITIONED BY ({partition_by})" if partition_by else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.full_name(table)} ({ddl}) USING parquet {stored_by} "
            f"LOCATION '{self.fresh(table)}'"
        )

    def replace_partitions(self, table: str, df: DataFrame, partition_by: str) -> None:
        """Overwrite the partitions that occur in ``df``.

        The new files are written beside the old ones, then each partition's entry is moved to its new
        folder. A failure before that changes nothing; a failure during it leaves every partition
        either old or new, and a rerun finishes the rest. Old folders are left for ``vacuum``.
        """
        location = self.fresh(table)
        columns = self.table(table).columns
        df.select(*columns).hint("rebalance", partition_by).write.partitionBy(partition_by).parquet(location)
        written = self.spark.read.schema(self.table(table).schema).parquet(location)
        values = [row[0] for row in written.select(F.col(partition_by).cast("string")).distinct().collect()]
        if None in values:
            raise ValueError(f"{table}: a row without {partition_by} has no partition")
        self.point_partitions(table, partition_by, location, values)

    def point_partitions(self, table: str, partition_by: str, location: str, values: Sequence[str]) -> None:
        """Let the entries of partitions lead to their folders under ``location``, new entries all at once."""
        known = {row[0] for row in self.spark.sql(f"SHOW PARTITIONS {self.full_name(table)}").collect()}
        parts = {v: (f"PARTITION (`{partition_by}` = '{v}')", f"'{location}/{partition_by}={v}'") for v in values}
        fresh = [f"{part} LOCATION {at}" for v, (part, at) in parts.items() if f"{partition_by}={v}" not in known]
        if fresh:
            self.spark.sql(f"ALTER TABLE {self.full_name(table)} ADD IF NOT EXISTS {' '.join(fresh)}")
        for v, (part, at) in parts.items():
            if f"{partition_by}={v}" in known:
                self.spark.sql(f"ALTER TABLE {self.full_name(table)} {part} SET LOCATION {at}")
        self.spark.catalog.refreshTable(self.full_name(table))

    def load_slice(self, table: str, df: DataFrame, partition_by: str) -> None:
        """Replace the slices that occur in ``df``; the table takes on its schema as ``evolve`` does."""
        if not self.exists(table):
            self.create_if_absent(table, _ddl(df.schema), partition_by)
        self.evolve(table, df.schema)
        self.replace_partitions(table, df.to(self.table(table).schema), partition_by)

    def evolve(self, table: str, schema: StructType, renames: Mapping[str, str] | None = None) -> list[Change]:
        """Let the table hold rows of ``schema`` too: columns are added, widened or renamed, or ``SchemaRefused`` is raised.

        Added and widened columns change the entry alone: the stored files are read as the wider type. Parquet finds
        columns by name, so a renaming writes the table anew, once. A refusal changes nothing.
        """
        changes = plan_schema(self.table(table).schema, schema, renames)
        after = schema_after(changes)
        kinds = {c.kind for c in changes}
        if not kinds & {ADD, WIDEN, RENAME}:
            return changes
        if kinds.isdisjoint({WIDEN, RENAME}):
            added = StructType([f for f, c in zip(after, changes) if c.kind == ADD])
            self.spark.sql(f"ALTER TABLE {self.full_name(table)} ADD COLUMNS ({_ddl(added)})")
            return changes
        details = self._details(f"DESCRIBE EXTENDED {self.full_name(table)}")
        if details.get("Num Buckets", "0") not in ("0", "-1"):
            raise SchemaRefused(f"{table} is stored by buckets, which go by the types of its columns")
        by = [c.name for c in self.spark.catalog.listColumns(f"{self.name}.{table}") if c.isPartition]
        if any(c.kind == RENAME and c.before in by for c in changes):
            raise SchemaRefused(f"{table} is stored by {by[0]}, which keeps its name")
        if RENAME in kinds:
            location = self.fresh(table)
            named = self.table(table).withColumnsRenamed({c.before: c.column for c in changes if c.kind == RENAME})
            named.to(after).write.partitionBy(*by).parquet(location)
        else:
            location = details["Location"]
        self._swap(table, after, location, by, RENAME in kinds)
        return changes

    def _swap(self, table: str, schema: StructType, location: str, by: Sequence[str], rewritten: bool) -> None:
        """Give the table another schema over files that are there; with partitions, over the folders of theirs."""
        fresh = f"{table}_{uuid.uuid4().hex[:8]}"
        stored_by = f"PARTITIONED BY (`{by[0]}`)" if by else ""
        self.spark.sql(f"CREATE TABLE {self.full_name(fresh)} ({_ddl(schema)}) USING parquet {stored_by} LOCATION '{location}'")
        places = []
        for row in self.spark.sql(f"SHOW PARTITIONS {self.full_name(table)}").collect() if by else []:
            part = f"PARTITION (`{by[0]}` = '{row[0].split('=', 1)[1]}')"
            at = f"{location}/{row[0]}" if rewritten else self._details(f"DESCRIBE EXTENDED {self.full_name(table)} {part}")["Location"]
            places.append(f"{part} LOCATION '{at}'")
        if places:
            self.spark.sql(f"ALTER TABLE {self.full_name(fresh)} ADD {' '.join(places)}")
        self.spark.sql(f"DROP TABLE {self.full_name(table)}")
        self.spark.sql(f"ALTER TABLE {self.full_name(fresh)} RENAME TO {self.full_name(table)}")
        self.spark.catalog.refreshTable(self.full_name(table))

    def _details(self, statement: str) -> dict[str, str]:
        """What a DESCRIBE tells; the first of equal names counts, which is a partition's before its table's."""
        told: dict[str, str] = {}
        for name, value, _ in self.spark.sql(statement).collect():
            told.setdefault(name, value)
        return told

    def merge(
        self, table: str, batch: DataFrame, keys: Sequence[str], newest_first: Sequence[str], partition_by: str
    ) -> None:
        """Upsert a batch into a table stored by a column that is part of the key."""
        merged = merge_partitions(self.table(table), batch, keys, newest_first, partition_by)
        if merged is not None:
            self.replace_partitions(table, merged, partition_by)

    def replace(self, table: str, df: DataFrame) -> None:
        """Overwrite the table, schema included."""
        location = self.fresh(table)
        df.write.parquet(location)
        schema = self.spark.read.parquet(location).schema
        if self.exists(table) and self._same_columns(self.table(table).schema, schema):
            self.spark.sql(f"ALTER TABLE {self.full_name(table)} SET LOCATION '{location}'")
        else:
            # The tables are external: entries go and come, files stay. The new entry is made and read
            # before the old one goes, so only the renaming lies between the two.
            fresh = f"`{self.name}`.`{table}_{uuid.uuid4().hex[:8]}`"
            self.spark.sql(f"CREATE TABLE {fresh} USING parquet LOCATION '{location}'")
            self.spark.sql(f"DROP TABLE IF EXISTS {self.full_name(table)}")
            self.spark.sql(f"ALTER TABLE {fresh} RENAME TO {self.full_name(table)}")
        self.spark.catalog.refreshTable(self.full_name(table))

    def append(self, table: str, df: DataFrame) -> None:
        """Append a batch; the table takes on its schema as ``evolve`` does."""
        if not self.exists(table):
            self.replace(table, df)
            return
        self.evolve(table, df.schema)
        df.to(self.table(table).schema).write.insertInto(self.full_name(table))

    def create_view(self, view: str, sql: str) -> None:
        """A view of the catalog, which later sessions see as well."""
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.full_name(view)} AS {sql}")

    def freeze(self, table: str, make: Callable[[], DataFrame]) -> DataFrame:
        """Write the result of ``make`` the first time; later calls keep what is there."""
        if not self.exists(table):
            self.replace(table, make())
        return self.table(table)

    def fresh(self, table: str) -> str:
        """A path for files of the table that no reader sees yet."""
        return f"{self.folder}/{self.name}/{table}/{uuid.uuid4().hex}"

    @staticmethod
    def _same_columns(left: StructType, right: StructType) -> bool:
        return [(f.name, f.dataType) for f in left] == [(f.name, f.dataType) for f in right]


class GuardedRefresh:
    """Full refreshes that keep the old table when a new load turns out empty.

    All loads run; ``finish`` then fails once and names every load that had no rows.
    """

    def __init__(self, replace: Callable[[str, DataFrame], None]):
        self.replace = replace
        self.failed: list[str] = []

    def load(self, table: str, df: DataFrame) -> bool:
        if not has_rows(df):
            self.failed.append(table)
            return False
        self.replace(table, df)
        return True

    def finish(self) -> None:
        if self.failed:
            raise RuntimeError(f"kept the old table, the new load had no rows: {', '.join(self.failed)}")
