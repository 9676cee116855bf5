"""Data-quality reports kept up slice by slice: a load measures its own slices, the report adds up what is stored.

Counts of rows, NULLs and values outside a list simply add up. Repeated keys are exact inside a slice; across
slices the 64-bit hashes of keys are compared, and only where a hash occurs in two slices are the rows
of those slices read again to see whether the keys themselves are equal.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DateType, IntegerType, LongType, ShortType

from gradeline.plans.quality import FAIL, PASS, Allowed, NoNulls, RowCount, Rule, Unique
from gradeline.sources.tables import Database, discard, keep

SLICE = "_slice"
#: Rule number of the row that says a slice has been looked at.
SEEN = -1


class QualityState:
    """The rules of one table and what its slices have measured, in three tables of a database.

    ``slices`` is a column of dates or whole numbers, a day or a load; rows without it are an error. ``read`` returns
    rows of the table for a list of slices and is called on suspicion only. A slice that comes
    again replaces what it measured. Counts are written last: a load that fails before is repeated as it was.
    """

    def __init__(
        self, database: Database, name: str, rules: Sequence[Rule], slices: str, read: Callable[[list], DataFrame]
    ):
        self.database, self.rules, self.slices, self.read = database, tuple(rules), slices, read
        self.counts, self.keys, self.shared = f"{name}_counts", f"{name}_keys", f"{name}_shared"
        self.unique = [(i, rule) for i, rule in enumerate(self._flat()) if isinstance(rule, Unique)]

    def load(self, rows: DataFrame) -> list:
        """Measure the slices that occur in ``rows``, all rows of each; returns those that were read again on suspicion."""
        kind = rows.schema[self.slices].dataType
        if not isinstance(kind, (DateType, ByteType, ShortType, IntegerType, LongType)):
            raise TypeError(f"slices are dates or whole numbers, {self.slices} is {kind.simpleString()}")
        rows = rows.withColumn(SLICE, F.col(self.slices))
        keys = [keep(self._keys_of(rows, number, rule), "keys") for number, rule in self.unique]
        counts = keep(self._counts_of(rows, keys), "counts")
        loaded = [row[0] for row in counts.select(SLICE).distinct().collect()]  # as many as a load has slices
        if None in loaded:
            discard(counts, *keys)
            raise ValueError(f"{self.counts}: a row without {self.slices} belongs to no slice")
        suspects: list = []
        if loaded and keys:
            fresh = reduce(DataFrame.unionByName, keys).select("rule", "h", SLICE).distinct()
            seen = counts.select(F.lit(SEEN).alias("rule"), F.lit(None).cast("bigint").alias("h"), SLICE).distinct()
            self.database.load_slice(self.keys, fresh.unionByName(seen), SLICE)
            suspects = self._share(fresh, seen, loaded)
        if loaded:
            self.database.load_slice(self.counts, counts, SLICE)
        discard(counts, *keys)
        return suspects

    def report(self) -> DataFrame:
        """Results (check_name, target, status, observed, limit_value) as ``check_table`` gives them for the whole table."""
        measured = self.database.table(self.counts).groupBy("rule").agg(F.sum("measure").alias("measure"))
        if self.unique:
            held = self.database.table(self.shared).where(F.col("rule") != SEEN).groupBy("rule", "key").agg(F.count("*").alias("n"))
            again = held.groupBy("rule").agg(F.sum(F.col("n") - 1).alias("again"))
            measured = measured.join(again, "rule", "left").select(
                "rule", (F.col("measure") + F.coalesce("again", F.lit(0))).alias("measure")
            )
        declared = F.lit([i for i, _ in enumerate(self._flat())])
        listed = self.database.spark.range(1).select(F.explode(declared).alias("rule"))
        both = listed.join(measured, "rule", "left").withColumn("observed", F.coalesce("measure", F.lit(0)).cast("double"))
        shown = F.create_map(*[x for i, rule in enumerate(self._flat()) for x in (F.lit(i), self._shown(rule))])[F.col("rule")]
        passed = F.when(shown["low"], F.col("observed") <= shown["limit"]).otherwise(F.col("observed") >= shown["limit"])
        return both.select(
            shown["check"].alias("check_name"), shown["target"].alias("target"),
            F.when(passed, F.lit(PASS)).otherwise(F.lit(FAIL)).alias("status"), "observed", shown["limit"].alias("limit_value"),
        )

    def _flat(self) -> list[Rule]:
        """The rules as the report lists them, one per column where a rule names several."""
        flat: list[Rule] = []
        for rule in self.rules:
            flat += [NoNulls((column,)) for column in rule.columns] if isinstance(rule, NoNulls) else [rule]
        return flat

    @staticmethod
    def _shown(rule: Rule) -> Column:
        check, target, limit = {
            RowCount: lambda: ("row_count", "*", rule.minimum),
            NoNulls: lambda: ("no_nulls", rule.columns[0], 0),
            Allowed: lambda: ("allowed_values", rule.column, 0),
            Unique: lambda: ("unique_key", ",".join(rule.keys), 0),
        }[type(rule)]()
        return F.struct(
            F.lit(check).alias("check"), F.lit(target).alias("target"),
            F.lit(float(limit)).alias("limit"), F.lit(not isinstance(rule, RowCount)).alias("low"),
        )

    @staticmethod
    def _keys_of(rows: DataFrame, number: int, rule: Unique) -> DataFrame:
        """(rule, h, _slice, n): a row per key and slice, combined before the shuffle."""
        counted = rows.groupBy(SLICE, *rule.keys).agg(F.count("*").alias("n"))
        return counted.select(F.lit(number).alias("rule"), F.xxhash64(*rule.keys).alias("h"), SLICE, "n")

    def _counts_of(self, rows: DataFrame, keys: Sequence[DataFrame]) -> DataFrame:
        """(rule, measure, _slice). Rows are read once for all rules without keys, which always tell the slices."""
        plain = [(SEEN, F.count(F.lit(1)))]
        for number, rule in enumerate(self._flat()):
            if isinstance(rule, RowCount):
                plain.append((number, F.count(F.lit(1))))
            elif isinstance(rule, NoNulls):
                plain.append((number, F.count_if(F.col(rule.columns[0]).isNull())))
            elif isinstance(rule, Allowed):
                plain.append((number, F.count_if(~F.col(rule.column).isin(*rule.values))))
        measures = rows.groupBy(SLICE).agg(*[m.alias(f"m{i}") for i, (_, m) in enumerate(plain)])
        listed = F.array(*[
            F.struct(F.lit(number).alias("rule"), F.col(f"m{i}").alias("measure")) for i, (number, _) in enumerate(plain)
        ])
        parts = [measures.select(F.inline(listed), SLICE)]
        parts += [k.groupBy("rule", SLICE).agg(F.sum(F.col("n") - 1).alias("measure")).select("rule", "measure", SLICE) for k in keys]
        return reduce(DataFrame.unionByName, parts)

    def _share(self, fresh: DataFrame, seen: DataFrame, loaded: list) -> list:
        """Note the keys that the loaded slices share with others, and forget what they shared before.

        A suspicious hash is one row per slice that has it, never one per pair of slices.
        """
        met = self.database.table(self.keys).join(fresh.select("rule", "h").distinct(), ["rule", "h"], "left_semi")
        several = met.groupBy("rule", "h").agg(F.collect_set(SLICE).alias("slices")).where(F.size("slices") > 1)
        suspects = keep(several.select("rule", "h", F.explode("slices").alias(SLICE)), "suspects")
        read_again = sorted(row[0] for row in suspects.select(SLICE).distinct().collect())
        notes = [seen.select("rule", F.lit(None).cast("string").alias("key"), SLICE)]
        if read_again:
            again = self.read(read_again).withColumn(SLICE, F.col(self.slices))
            for number, rule in self.unique:
                wanted = suspects.where(F.col("rule") == number).select("h", SLICE)
                hashed = again.select(SLICE, *rule.keys, F.xxhash64(*rule.keys).alias("h"))
                found = hashed.join(wanted, ["h", SLICE], "left_semi").groupBy(SLICE, *rule.keys).agg(F.lit(number).alias("rule"))
                notes.append(found.select("rule", F.sha2(F.to_json(F.struct(*rule.keys)), 256).alias("key"), SLICE))
            if self.database.exists(self.shared):
                others = [s for s in read_again if s not in loaded]
                notes.append(self.database.table(self.shared).where(F.col(SLICE).isin(others)).select("rule", "key", SLICE))
        noted = keep(reduce(DataFrame.unionByName, notes).distinct(), "shared")
        self.database.load_slice(self.shared, noted, SLICE)
        discard(suspects, noted)
        return read_again
