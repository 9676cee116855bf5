"""Keyed tables stored by parts and buckets of the key: merges that do not move the table, diffs that skip equal parts.

A part is a folder, so a merge reads and writes only the parts its batch touches; inside each part rows
lie in Spark's own buckets, so the join with the batch shuffles the batch alone. ``buckets`` decides how
many tasks a merge has, ``parts`` how finely it is pruned. Each part has a digest, and groups of parts have
digests of those: two tables with the same layout compare rows only where digests differ.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeline.operators.diff import content_hash, snapshot_diff
from gradeline.operators.latest import latest_per_key
from gradeline.operators.merge import assert_unique
from gradeline.sources.tables import Database, discard, keep

PART = "_part"
#: The part of rows with a NULL in the key. No merge matches them, so none reads this part.
NO_KEY = -1
#: Parts, or groups of them, under one digest of the level above.
FAN = 32


class BucketedTable:
    """A table of one database with unique keys; rows with a NULL in the key, or repeated ones, are kept as they are.

    A merge writes beside what is there and then moves the entries of the parts, as ``Database`` does:
    a failure leaves every part old or new, and a rerun of the same merge finishes the rest. Rows without key
    are appended last, so only a failure after that would repeat them in a rerun. Digests of touched parts are
    blanked before the parts move and come back after; a blank one equals no other. Map columns have no digest.
    """

    def __init__(self, database: Database, name: str, keys: Sequence[str], parts: int = 64, buckets: int = 64):
        if parts < 1 or buckets < 1:
            raise ValueError("a table has at least one part and one bucket")
        self.database, self.spark, self.name = database, database.spark, name
        self.keys, self.parts, self.buckets = list(keys), parts, buckets

    def rows(self, parts: Sequence[int] | None = None) -> DataFrame:
        """The stored rows, or those of some parts, whose folders alone are read."""
        return self._stored(parts).drop(PART)

    def create(self, df: DataFrame) -> None:
        """Store the first rows. Their columns are the table's from then on."""
        if PART in df.columns:
            raise ValueError(f"the column name {PART} is reserved")
        if self.database.exists(f"{self.name}_digests"):  # written last: without it, an earlier attempt did not end
            raise ValueError(f"{self.name} is there already")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        keys = ", ".join(f"`{key}`" for key in self.keys)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.database.full_name(self.name)} ({columns}, {PART} INT) USING parquet PARTITIONED BY ({PART}) "
            f"CLUSTERED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{self.database.fresh(self.name)}'"
        )
        # One file per part and bucket, split where it is much larger than the others.
        rows = self._placed(df).withColumn("_bucket", F.pmod(F.hash(*self.keys), F.lit(self.buckets)))
        self._move(rows.hint("rebalance", PART, "_bucket").drop("_bucket"), [])
        self._write_digests(self._digests_of(self._stored()))

    def upsert(self, batch: DataFrame, newest_first: Sequence[Column | str] | None = None) -> list[int]:
        """Replace matched rows and insert the others, as ``operators.merge.upsert`` does; returns the touched parts.

        Columns the batch does not have are NULL in its rows; columns the table does not have are an error.
        Values are cast to the table's types first, as keys of another type would lie elsewhere.
        """
        fields = self.rows().schema
        unknown = set(batch.columns) - set(fields.names)
        if unknown:
            raise ValueError(f"{self.name} has no columns {sorted(unknown)}")
        batch = batch.select(*[
            (F.col(f"`{f.name}`") if f.name in batch.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields
        ])
        batch = latest_per_key(batch, self.keys, newest_first) if newest_first else assert_unique(batch, self.keys)
        placed = keep(self._placed(batch), "batch")
        keyed = placed.where(F.col(PART) != NO_KEY)
        touched = self._merge(keyed, keyed)
        keyless = placed.where(F.col(PART) == NO_KEY)
        if not keyless.isEmpty():
            touched.append(NO_KEY)
            before = self.digests().where((F.col("level") == 0) & (F.col("node") == NO_KEY))
            known = keep(before.select(F.col("node").alias(PART), "n", "h"), "digests")
            self._forget([NO_KEY])
            keyless.write.mode("append").insertInto(self.database.full_name(self.name))
            both = known.unionByName(self._digests_of(keyless)).groupBy(PART).agg(_total("n", "bigint"), _total("h"))
            self._write_digests(self._leaves().where(F.col(PART) != NO_KEY).unionByName(both))
            discard(known)
        discard(placed)
        return touched

    def delete(self, batch: DataFrame) -> list[int]:
        """Drop the rows whose key occurs in the batch; returns the parts that were read and written."""
        kinds = self.rows().schema
        keys = batch.select(*[F.col(key).cast(kinds[key].dataType).alias(key) for key in self.keys])
        placed = keep(self._placed(keys).where(F.col(PART) != NO_KEY).distinct(), "batch")
        touched = self._merge(placed, None)
        discard(placed)
        return touched

    def digests(self) -> DataFrame:
        """(level, node, n, h): parts are level 0, ``FAN`` nodes of a level one of the next, the root has no other beside it."""
        return self.database.table(f"{self.name}_digests")

    def changes_since(self, old: BucketedTable, content: Sequence[str]) -> tuple[DataFrame, list[int]]:
        """``snapshot_diff`` from ``old`` to this table, and the parts that had to be read for it."""
        if (self.keys, self.parts) != (old.keys, old.parts):
            raise ValueError("digests compare tables with the same keys and parts")
        parts = self._differing(old)
        return snapshot_diff(old.rows(parts), self.rows(parts), self.keys, content), parts

    def _stored(self, parts: Sequence[int] | None = None) -> DataFrame:
        stored = self.database.table(self.name)
        return stored if parts is None else stored.where(F.col(PART).isin(list(parts)))

    def _placed(self, df: DataFrame) -> DataFrame:
        """With the part as last column. Parts go by another hash than Spark's buckets, so each part has all buckets."""
        has_key = reduce(and_, [F.col(key).isNotNull() for key in self.keys])
        part = F.when(has_key, F.pmod(F.xxhash64(*self.keys), F.lit(self.parts))).otherwise(F.lit(NO_KEY))
        return df.withColumn(PART, part.cast("int"))

    def _merge(self, batch: DataFrame, inserted: DataFrame | None) -> list[int]:
        """Write the touched parts without the rows that ``batch`` matches and with those ``inserted``."""
        touched = sorted(row[0] for row in batch.select(PART).distinct().collect())  # at most ``parts`` numbers
        if not touched:
            return []
        # Stored rows stay in their buckets, which a broadcast of the batch would tear apart.
        keys = batch.select(*self.keys).repartition(self.buckets, *self.keys).hint("merge")
        rows = self._stored(touched).join(keys, self.keys, "left_anti")
        if inserted is not None:
            rows = rows.unionByName(inserted.repartition(self.buckets, *self.keys))
        self._move(rows, touched)
        fresh = self._digests_of(self._stored(touched))
        self._write_digests(self._leaves().where(~F.col(PART).isin(touched)).unionByName(fresh))
        return touched

    def _move(self, rows: DataFrame, touched: Sequence[int]) -> None:
        """Write rows in the table's layout to a new folder and point the entries of their parts at it."""
        location, scratch = self.database.fresh(self.name), f"{self.name}_{uuid.uuid4().hex[:8]}"
        writer = rows.write.format("parquet").partitionBy(PART).bucketBy(self.buckets, *self.keys)
        writer.option("path", location).saveAsTable(self.database.full_name(scratch))
        written = [row[0] for row in self.database.table(scratch).select(PART).distinct().collect()]
        self.spark.sql(f"DROP TABLE {self.database.full_name(scratch)}")  # the entry; files in a given path stay
        if touched:
            self._forget(touched)
        self.database.point_partitions(self.name, PART, location, [str(part) for part in written])
        empty = [f"PARTITION ({PART} = {part})" for part in touched if part not in written]
        if empty:
            self.spark.sql(f"ALTER TABLE {self.database.full_name(self.name)} DROP IF EXISTS {', '.join(empty)}")
            self.spark.catalog.refreshTable(self.database.full_name(self.name))

    def _digests_of(self, rows: DataFrame) -> DataFrame:
        """(part, n, h): equal rows count, their order does not."""
        hashed = content_hash(sorted(c for c in rows.columns if c != PART)).cast("decimal(20,0)")
        return rows.select(PART, hashed.alias("h")).groupBy(PART).agg(F.count("*").alias("n"), _total("h"))

    def _leaves(self) -> DataFrame:
        return self.digests().where("level = 0").select(F.col("node").alias(PART), "n", "h")

    def _forget(self, parts: Sequence[int]) -> None:
        """Blank the digests of parts that are about to change."""
        listed = F.explode(F.lit(list(parts))).alias(PART)
        blank = self.spark.range(1).select(listed, F.lit(None).cast("bigint").alias("n"), F.lit(None).cast("decimal(38,0)").alias("h"))
        self._write_digests(self._leaves().where(~F.col(PART).isin(list(parts))).unionByName(blank))

    def _write_digests(self, leaves: DataFrame) -> None:
        """Write the tree over the leaves, a row per part and per group of them."""
        kept = level = tree = keep(leaves.select(F.lit(0).alias("level"), F.col(PART).alias("node"), "n", "h"), "digests")
        for height in range(1, self._height() + 1):
            node = F.floor(F.col("node") / FAN).cast("int")
            sealed = F.when(F.col("h").isNotNull(), F.xxhash64("node", "n", "h")).cast("decimal(20,0)")
            level = level.select(F.lit(height).alias("level"), node.alias("node"), "n", sealed.alias("h"))
            level = level.groupBy("level", "node").agg(_total("n", "bigint"), _total("h"))
            tree = tree.unionByName(level)
        self.database.replace(f"{self.name}_digests", tree.coalesce(1))
        discard(kept)

    def _height(self) -> int:
        height, nodes = 0, self.parts
        while nodes > 1:
            height, nodes = height + 1, -(-nodes // FAN)
        return height

    def _differing(self, old: BucketedTable) -> list[int]:
        """Parts with different digests, found from the root down: nothing below equal nodes is looked at."""
        nodes: list[int] | None = None
        for level in range(self._height(), -1, -1):
            asked = F.col("level") == level
            if nodes is not None:
                asked = asked & F.floor(F.col("node") / FAN).isin(nodes)
            ours, theirs = (t.digests().where(asked).select("node", "n", "h") for t in (self, old))
            both = ours.alias("a").join(theirs.alias("b"), "node", "full_outer")
            same = (F.col("a.n") == F.col("b.n")) & (F.col("a.h") == F.col("b.h"))
            nodes = sorted(row[0] for row in both.where(~F.coalesce(same, F.lit(False))).select("node").collect())
            if not nodes:
                break
        return nodes or []


def _total(column: str, kind: str = "decimal(38,0)") -> Column:
    """The sum, blank if a value is blank."""
    return F.when(F.count(column) == F.count("*"), F.sum(column)).cast(kind).alias(column)
