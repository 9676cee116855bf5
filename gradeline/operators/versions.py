"""Folders of versioned entries: each version adds entries and tombstones, and counts once its number is written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeline.sources.tables import keep


class Versioned:
    """What stored indexes share. A failed upkeep leaves the index as it was; a rerun replaces what it left behind."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def _exists(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._path(name))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def version(self) -> int:
        """The newest version that is wholly in the index; 0 before the first."""
        if not self._exists("versions"):
            return 0
        return self.spark.read.schema("version int").parquet(self._path("versions")).agg(F.max("version")).first()[0] or 0

    def _commit(self, version: int) -> None:
        self.spark.range(1).select(F.lit(version).cast("int").alias("version")).write.mode("append").parquet(self._path("versions"))

    def _remember_ids(self, rows: DataFrame) -> None:
        """Keep the type of the ids, for indexes without entries."""
        rows.select("doc_id").limit(0).write.mode("overwrite").parquet(self._path("ids"))

    def _read(self, name: str, ddl: str) -> DataFrame:
        """Committed rows of one kind; ``{id}`` in the schema is the type of the ids."""
        kind = self.spark.read.parquet(self._path("ids")).schema["doc_id"].dataType.simpleString()
        stored = self.spark.read.schema(ddl.format(id=kind)).parquet(self._path(name))
        return stored.where(F.col("version") <= self.version())

    def _live(self, stored: DataFrame) -> DataFrame:
        """The rows that no later version has a tombstone for."""
        if not self._exists("removed"):
            return stored
        gone = self._read("removed", "doc_id {id}, version int")
        last = gone.groupBy("doc_id").agg(F.max("version").alias("gone"))
        return stored.join(last, "doc_id", "left").where(F.col("gone").isNull() | (F.col("version") >= F.col("gone"))).drop("gone")

    def _add(self, rows: DataFrame, version: int) -> None:
        """Write the entries of a version."""
        raise NotImplementedError

    def _taken_out(self, gone: DataFrame, version: int) -> None:
        """Whatever else a version needs when the ids ``gone`` (doc_id) lose their entries."""

    def apply(self, changes: DataFrame, fresh: DataFrame, version: int) -> bool:
        """Bring the index to ``version``; False, and nothing done, if it is there already.

        ``changes`` has (doc_id, change) with change = insert, update or delete, as ``snapshot_diff`` gives them, ``fresh`` the
        rows now. Changed ids that had entries get a tombstone; what is inserted or updated gets new entries.
        """
        if version <= self.version():
            return False
        changes = keep(changes.select("doc_id", "change"), "changes")
        gone = changes.where(F.col("change") != "insert").select("doc_id")
        self._taken_out(gone, version)
        self._add(fresh.join(changes.where(F.col("change") != "delete").select("doc_id"), "doc_id", "left_semi"), version)
        gone.write.mode("overwrite").parquet(self._path(f"removed/version={version}"))
        self._commit(version)
        return True
