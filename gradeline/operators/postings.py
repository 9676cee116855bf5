"""Stored postings: texts split once, their words by bucket, so that a search reads the buckets of its words only.

A row is a word with its postings in a block of texts, so rows that are moved, sorted and read grow with the words of
blocks and not with the postings; those become rows once a search has picked its words. Statistics are those of any day asked for. How many texts there are and how long they are is kept as sums by day, which upkeep
adds to and takes from; in how many texts a word is follows from its own postings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeline.functions.text import words
from gradeline.operators.asof import latest_as_of
from gradeline.operators.versions import Versioned
from gradeline.session import reach_package

BUCKETS = 64
#: Words of texts that make a block; a longer text is a block of its own.
BLOCK_WORDS = 1 << 20
DOCS = "docs array<struct<doc_id: {id}, published_date: date, tf: int, length: int>>"
POSTING = f"word string, {DOCS}, version int, bucket int"
DAY = "published_date date, n bigint, total bigint, version int"


def bucket_of(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def block_postings(texts: list[pa.RecordBatch]) -> pa.RecordBatch:
    """(word, docs): the words of texts (doc_id, published_date, words), each with its texts and how often they have it.

    Each text has the word '' once as well: a row with its length, also if it has no other words.
    """
    id_, date, lists = (pa.concat_arrays([batch.column(i) for batch in texts]) for i in range(3))
    length = lists.value_lengths().to_numpy().astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    row = np.repeat(np.arange(len(lists)), length)
    empty = len(coded.dictionary)  # the number of the word ''
    each = np.append(coded.indices.to_numpy().astype(np.int64) * len(lists) + row, empty * len(lists) + np.arange(len(lists)))
    pairs, tf = np.unique(each, return_counts=True)
    word, row = np.divmod(pairs, len(lists))
    heads = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
    docs = pa.StructArray.from_arrays(
        [id_.take(pa.array(row)), date.take(pa.array(row)), pa.array(tf.astype(np.int32)), pa.array(length[row].astype(np.int32))],
        names=["doc_id", "published_date", "tf", "length"],
    )
    names = pa.concat_arrays([coded.dictionary, pa.array([""], coded.dictionary.type)])
    offsets = pa.array(np.append(heads, len(word)).astype(np.int32))
    return pa.RecordBatch.from_arrays([names.take(pa.array(word[heads])), pa.ListArray.from_arrays(offsets, docs)], names=["word", "docs"])


def posting_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``block_postings`` of BLOCK_WORDS words at a time."""
    held, size = [], 0
    for batch in batches:
        lengths = batch.column(2).value_lengths().to_numpy()
        low = 0
        for i, n in enumerate(lengths.tolist()):
            if size and size + n > BLOCK_WORDS:
                yield block_postings([*held, batch.slice(low, i - low)] if i > low else held)
                held, size, low = [], 0, i
            size += n + 1
        if low < batch.num_rows:
            held.append(batch.slice(low))
    if held:
        yield block_postings(held)


class Postings(Versioned):
    """Texts (doc_id, published_date, text_content) by words. NULL texts and texts without date have no postings."""

    def build(self, texts: DataFrame, version: int = 1) -> None:
        self._remember_ids(texts)
        self._add(texts, version)
        self._commit(version)

    def _add(self, rows: DataFrame, version: int) -> None:
        dated = rows.where(F.col("text_content").isNotNull() & F.col("published_date").isNotNull())
        kind = rows.schema["doc_id"].dataType.simpleString()
        reach_package(self.spark)
        split = dated.select("doc_id", "published_date", words("text_content").alias("words"))
        blocks = split.mapInArrow(posting_blocks, "word string, " + DOCS.format(id=kind))
        placed = blocks.withColumn("bucket", bucket_of(F.col("word")))
        path = self._path(f"postings/version={version}")
        placed.hint("rebalance", "bucket").sortWithinPartitions("bucket", "word").write.mode("overwrite").partitionBy("bucket").parquet(path)
        stored = self.spark.read.schema(POSTING.format(id=kind)).parquet(path)
        own = stored.where((F.col("bucket") == bucket_of(F.lit(""))) & (F.col("word") == ""))
        self._days(own.select(F.inline("docs")), 1, f"days/version={version}/kind=in")

    def _days(self, lengths: DataFrame, sign: int, name: str) -> None:
        sums = lengths.groupBy("published_date").agg(
            (sign * F.count("*")).alias("n"), (sign * F.sum("length")).cast("long").alias("total")
        )
        sums.coalesce(1).write.mode("overwrite").parquet(self._path(name))

    def _taken_out(self, gone: DataFrame, version: int) -> None:
        own = self._in_buckets_of(self.spark.range(1).select(F.lit("").alias("word"))).where(F.col("word") == "")
        held = self._live(own.select("version", F.inline("docs"))).join(gone, "doc_id", "left_semi")
        self._days(held.select("published_date", "length"), -1, f"days/version={version}/kind=out")

    def postings(self) -> DataFrame:
        """All live (doc_id, published_date, word, tf, length); the word '' is every text's."""
        every = self._read("postings", POSTING).select("word", "version", F.inline("docs"))
        return self._live(every).select("doc_id", "published_date", "word", "tf", "length")

    def _in_buckets_of(self, asked: DataFrame) -> DataFrame:
        buckets = [r["b"] for r in asked.select(bucket_of(F.col("word")).alias("b")).distinct().collect()]  # at most BUCKETS
        return self._read("postings", POSTING).where(F.col("bucket").isin(buckets))

    def matches(self, asked: DataFrame) -> DataFrame:
        """(entity, word, doc_id, published_date, tf, length) of the asked (entity, word); only their buckets are read."""
        asked = asked.select("entity", "word").distinct()
        met = asked.join(self._in_buckets_of(asked), "word").select("entity", "word", "version", F.inline("docs"))
        return self._live(met).select("entity", "word", "doc_id", "published_date", "tf", "length")

    def corpus(self, days: DataFrame) -> DataFrame:
        """(as_of, n, mean): how many texts there are by each day and their mean length; 0 and NULL before the first.

        Texts and requests are both reduced to days, so the window has a row for each day of the calendar.
        """
        daily = self._read("days", DAY).groupBy("published_date").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        zero = F.lit(0).cast("long")
        both = daily.select(F.col("published_date").alias("at"), F.lit(0).alias("asked"), "n", "total").unionByName(
            days.select(F.col("as_of").alias("at"), F.lit(1).alias("asked"), zero.alias("n"), zero.alias("total")).distinct()
        )
        running = Window.orderBy("at", "asked").rowsBetween(Window.unboundedPreceding, 0)
        n, total = F.sum("n").over(running), F.sum("total").over(running)
        summed = both.select("at", "asked", n.alias("n"), F.try_divide(total, n).alias("mean"))
        return summed.where("asked = 1").select(F.col("at").alias("as_of"), "n", "mean")

    def rarities(self, matches: DataFrame, requests: DataFrame) -> DataFrame:
        """(entity, as_of, word, idf, mean): the weight of each word of a question in the corpus of each day asked for."""
        # Counted where they are read: each question with a word has all its texts.
        found = matches.groupBy("entity", "word", "published_date").agg(F.count("*").alias("n"))
        daily = found.groupBy("word", "published_date").agg(F.max("n").alias("n"))
        running = Window.partitionBy("word").orderBy("published_date").rowsBetween(Window.unboundedPreceding, 0)
        df = daily.select("word", "published_date", F.sum("n").over(running).alias("df"))
        wanted = matches.select("entity", "word").distinct().join(requests.select("entity", "as_of").distinct(), "entity")
        held = latest_as_of(wanted.select("word", "as_of"), df, "word", "as_of", "published_date", ["df"]).where(F.col("df").isNotNull())
        rarity = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
        return wanted.join(held.select("word", "as_of", "df"), ["word", "as_of"]).join(self.corpus(requests), "as_of").select(
            "entity", "as_of", "word", rarity.alias("idf"), "mean"
        )
