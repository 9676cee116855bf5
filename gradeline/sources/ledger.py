"""Landing files read once: a ledger of what was loaded, and broken files set aside while good ones load.

The ledger has one row per file and version (path, size, time of change). A load reads the files whose
version the ledger does not have, stores the rows of the good ones as a slice of its own and then notes all
of them, the broken ones with their reason. A load that fails before its note is repeated under the
same number, so its slice is replaced and no file counts twice. A file that changes is another version:
mended files load again without further ado.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeline.sources.tables import Database, discard, keep

LOADED, BROKEN = "loaded", "broken"
#: Column of a loaded table that names the load, and the one that takes what does not parse.
LOAD, UNPARSED = "_load", "_unparsed"
VERSION = ("file", "bytes", "changed_at")
LEDGER = "file string, bytes bigint, changed_at timestamp, status string, reason string, n_rows bigint, _load bigint"

#: Files of one load. Their paths are named to Spark's reader by the driver, so there is a bound to them; what is
#: beyond it goes to the next load of the same call.
FILES_PER_LOAD = 10_000
REASON_CHARS = 200


class LandedFiles:
    """The files under a folder, loaded into a table as they come."""

    def __init__(
        self, db: Database, table: str, ledger: str, path: str, schema: str, pretty: bool = True,
        files_per_load: int = FILES_PER_LOAD,
    ):
        """``schema`` is that of the records; fields a file does not have are NULL, others are not read."""
        self.db, self.table, self.ledger, self.path, self.schema, self.pretty = db, table, ledger, path, schema, pretty
        self.files_per_load = files_per_load
        db.create_if_absent(ledger, LEDGER)

    def listed(self) -> DataFrame:
        """(path, file, bytes, changed_at) of all files that have content, which is not read for it.

        Spark lists no files of zero bytes; they count once something is written to them. ``file`` is the name that rows give as their origin, ``path`` the one readers take.
        """
        meta = F.col("_metadata")
        return (
            self.db.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(self.path)
            .select(
                "path", meta["file_path"].alias("file"), meta["file_size"].alias("bytes"),
                meta["file_modification_time"].alias("changed_at"),
            )
        )

    def pending(self) -> DataFrame:
        """Listed files whose version no load has noted."""
        return self.listed().join(self.db.table(self.ledger).select(*VERSION), list(VERSION), "left_anti")

    def load(self) -> int:
        """Load all pending files, in as many loads as they need; returns how many files were noted.

        A broken file, one with a record that is cut off or does not fit the schema, gives no rows at all. Empty arrays
        are loaded with no rows. Without pending files nothing is read or written.
        """
        noted = 0
        while files := self.pending().orderBy("changed_at", "file").limit(self.files_per_load).collect():
            self._load_files(files)
            noted += len(files)
        return noted

    def _load_files(self, files: list) -> None:
        spark, db = self.db.spark, self.db
        number = db.table(self.ledger).agg(F.coalesce(F.max(LOAD) + 1, F.lit(0))).first()[0]
        rows = keep(
            spark.read.schema(f"{self.schema}, {UNPARSED} string")
            .option("multiLine", self.pretty)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", UNPARSED)
            .json([f["path"] for f in files])
            .withColumn("_file", F.col("_metadata.file_path")),
            "parsed",
        )
        counts = rows.groupBy(F.col("_file").alias("file")).agg(
            F.count("*").alias("n"), F.min(F.substring(UNPARSED, 1, REASON_CHARS)).alias("unparsed")
        )
        batch = spark.createDataFrame([tuple(f[c] for c in VERSION) for f in files], "file string, bytes bigint, changed_at timestamp")
        broken = F.col("unparsed").isNotNull()
        notes = keep(
            batch.join(counts, "file", "left").select(
                *VERSION,
                F.when(broken, BROKEN).otherwise(LOADED).alias("status"),
                F.when(broken, F.concat(F.lit("does not fit: "), "unparsed")).alias("reason"),
                F.when(broken, 0).otherwise(F.coalesce("n", F.lit(0))).cast("bigint").alias("n_rows"),
                F.lit(number).cast("bigint").alias(LOAD),
            ),
            "notes",
        )
        bad = notes.where(F.col("status") == BROKEN).select(F.col("file").alias("_file"))
        good = rows.join(bad, "_file", "left_anti").drop(UNPARSED).withColumn(LOAD, F.lit(number).cast("bigint"))
        db.load_slice(self.table, good, LOAD)
        db.append(self.ledger, notes)
        discard(rows, notes)
