"""Line dedup: a normalised line that several documents share stays only in the first of them.

Lines are exploded and hashed, the documents of a hash are compared by their smallest and largest id,
and texts are put together again from the positions that stay. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeline.llm.frames import bind, id_key, lower_ascii, trim_white
from gradeline.sources.tables import keep

MIN_CODE_POINTS = 10
#: A key with more than this share of all lines is hot; so there are fewer than 1,000 of them.
HOT_SHARE = 1_000


def split_lines(text: Column) -> Column:
    """Pieces between line feeds; one empty line for NULL or an empty text."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return lower_ascii(trim_white(line))


def shared_lines(docs: DataFrame, text: str, doc_id: str, min_code_points: int) -> DataFrame:
    """(__id, __text, __drop): the positions each text loses; texts that lose none are absent.

    Documents are identified by id and by the hash of their text, so rows that repeat an id with
    another text are handled apart. Keys are compared by two 64-bit hashes of different seeds.
    """
    located = docs.select(
        id_key(doc_id).alias("__id"),
        F.xxhash64(F.col(f"`{text}`")).alias("__text"),
        F.posexplode(split_lines(F.col(f"`{text}`"))).alias("_pos", "_line"),
    ).select("__id", "__text", "_pos", line_key(F.col("_line")).alias("_key"))
    hashed = keep(
        located.where(F.char_length("_key") >= min_code_points).select(
            "__id", "__text", "_pos", F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(1), "_key").alias("_h2")
        ),
        "lines",
    )
    # Two ids differ exactly when the smallest and the largest do, which combines before the shuffle.
    keys = hashed.groupBy("_h1", "_h2").agg(
        F.min("__id").alias("_first"), F.max("__id").alias("_last"), F.count("*").alias("_n")
    )
    repeated = keep(keys.where(F.col("_first") < F.col("_last")).drop("_last"), "repeated")
    limit = hashed.count() // HOT_SHARE
    # At most HOT_SHARE keys can each hold more than a HOT_SHARE-th of the lines: a proven bound.
    hot = F.broadcast(repeated.where(F.col("_n") > limit).select("_h1", "_h2", F.col("_first").alias("_hot")))
    marked = hashed.join(hot, ["_h1", "_h2"], "left")
    other = repeated.where(F.col("_n") <= limit).select("_h1", "_h2", "_first")
    hits = (
        marked.where(F.col("_hot") < F.col("__id")).select("__id", "__text", "_pos")
        .unionByName(
            marked.where(F.col("_hot").isNull()).join(other, ["_h1", "_h2"])
            .where(F.col("_first") < F.col("__id")).select("__id", "__text", "_pos")
        )
    )
    # Bounded by the lines of one text; equal rows of one document give each position once.
    return hits.groupBy("__id", "__text").agg(F.collect_set("_pos").alias("__drop"))


def dedup_lines(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_code_points: int = MIN_CODE_POINTS
) -> DataFrame:
    """All columns of ``docs`` with ``text`` reduced to the lines that stay, plus n_lines and n_dropped.

    A line's key is the line without white space (space, tab to carriage return) at either end and
    with A-Z lowered. Keys of at least ``min_code_points`` that at least two documents hold lose all
    their lines except those in the document of the smallest id, where repeats stay as well.

    NULL and empty texts have one empty line, which always stays; NULL stays NULL. Rows without id
    count as one document after all others. Rows that repeat an id are one document: its lines are
    never dropped for its own sake. An empty table gives an empty table. Columns named n_lines or
    n_dropped are replaced; names with two leading underscores must be free.
    """
    drops = shared_lines(docs, text, doc_id, min_code_points)
    t = F.col(f"`{text}`")
    joined = docs.withColumns({"__id": id_key(doc_id), "__text": F.xxhash64(t)}).join(drops, ["__id", "__text"], "left")

    def rest(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__drop"))
        return F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")

    out = joined.withColumns({
        "n_lines": F.size(split_lines(t)).cast("long"),
        "n_dropped": F.coalesce(F.size("__drop"), F.lit(0)).cast("long"),
        text: F.when(F.col("__drop").isNull(), t).otherwise(bind(split_lines(t), rest)),
    })
    return out.drop("__id", "__text", "__drop")


def line_report(docs: DataFrame) -> DataFrame:
    """One row per document: n_lines before dropping, n_dropped, SHA-256 of the text that stays."""
    return dedup_lines(docs.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


REPORT_SQL = r"""
WITH lines AS (
  SELECT doc_id, pos, lines[pos] AS line,
    translate(trim(lines[pos], concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS pos
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))),
shared AS (
  SELECT key, min(doc_id) AS first_id FROM lines WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
judged AS (
  SELECT l.*, coalesce(l.doc_id <> s.first_id, FALSE) AS dropped FROM lines l LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""
