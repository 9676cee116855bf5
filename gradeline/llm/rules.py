"""Quality rules: a table of thresholds compiled into one projection, without user functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeline.llm.frames import bind, trim_white, words

MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30
SYMBOLS = r"[#*$%&|<>]"

#: Common words of the four languages the rules are written for.
STOP_WORDS = {
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "was", "for", "it", "with", "as", "on", "be", "at", "by"),
    "de": ("der", "die", "und", "das", "zu", "den", "von", "ist", "ein", "mit", "im", "nicht", "eine", "auf", "als"),
    "fr": ("le", "la", "de", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "dans", "qui"),
    "es": ("el", "la", "de", "que", "y", "en", "los", "del", "se", "las", "un", "por", "con", "no", "una"),
}

#: (measure, least, most), bounds included; None leaves a side open. A document is kept if all hold.
THRESHOLDS = (
    ("mean_word_chars", 1.5, 25.0),
    ("symbols_per_word", None, 0.25),
    ("stop_word_share", 0.02, None),
    ("dup_line_share", None, 0.5),
)


def repeat_words(tokens: Column, window: int = REPEAT_WINDOW) -> Column:
    """How many words lie in windows of ``window`` words that occur twice or more in the list.

    Windows are compared by 64-bit hashes. Most lists have no repeat, which a set of the hashes tells;
    the others are sorted, and the union of the repeated windows is measured in one pass.
    """

    def measure(hashes: Column) -> Column:
        n = F.size(hashes) - (window - 1)

        def windows(i: Column) -> Column:
            return F.xxhash64(*[F.get(hashes, i + k) for k in range(window)])

        def covered(found: Column) -> Column:
            def starts(ordered: Column) -> Column:
                def repeated(e: Column, k: Column) -> Column:
                    near = (F.get(ordered, k - 1)["h"] == e["h"]) | (F.get(ordered, k + 1)["h"] == e["h"])
                    return F.when(F.coalesce(near, F.lit(False)), e["i"]).otherwise(F.lit(-1))

                return F.filter(F.transform(ordered, repeated), lambda i: i >= 0)

            located = F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
            first = F.struct(F.lit(0).alias("n"), F.lit(-window).alias("at"))
            union = F.aggregate(
                F.sort_array(bind(F.sort_array(located), starts)), first,
                lambda acc, i: F.struct(
                    (acc["n"] + F.least(F.lit(window), i - acc["at"])).alias("n"), i.alias("at")
                ),
            )
            same = F.size(F.array_distinct(found)) == F.size(found)
            return F.when(same, F.lit(0)).otherwise(union["n"])

        return F.when(n < 2, F.lit(0)).otherwise(bind(F.transform(F.sequence(F.lit(0), n - 1), windows), covered))

    return bind(F.transform(tokens, lambda w: F.xxhash64(w)), measure)


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs`` plus everything the rules look at."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    stop = sorted({form for group in STOP_WORDS.values() for w in group for form in (w, w.capitalize())})
    split = docs.withColumn("__words", words(F.col(f"`{text}`"))).withColumn(
        "__lines", F.filter(F.split(t, "\n", -1), lambda line: trim_white(line) != "")
    )
    return split.withColumns({
        "n_words": F.size("__words").cast("long"),
        "word_chars": F.char_length(F.array_join("__words", "")).cast("long"),
        "n_symbols": (F.char_length(t) - F.char_length(F.regexp_replace(t, SYMBOLS, ""))).cast("long"),
        "n_lines": F.size("__lines").cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": repeat_words(F.col("__words")).cast("long"),
        "n_stop_words": F.size(F.filter("__words", lambda w: w.isin(stop))).cast("long"),
    }).drop("__words", "__lines")


def ratio(part: str, whole: str) -> Column:
    """0 where the whole is 0."""
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


RATIOS = {
    "mean_word_chars": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "stop_word_share": ("n_stop_words", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
}


def verdict(thresholds: tuple = THRESHOLDS) -> Column:
    """The threshold table as one boolean expression over the measures."""
    tests = []
    for name, least, most in thresholds:
        value = ratio(*RATIOS[name])
        tests += [value >= least] if least is not None else []
        tests += [value <= most] if most is not None else []
    return reduce(Column.__and__, tests, F.lit(True))


def judge(docs: DataFrame, text: str = "text", thresholds: tuple = THRESHOLDS) -> DataFrame:
    """The columns of ``docs`` plus the measures, base_failed and kept.

    base_failed: fewer than 20 words, or more than 30 % of the words in repeated 8-word windows.
    kept: not base_failed, and every threshold holds. NULL, empty and blank texts have no words and
    fail. Each row is judged by itself, so repeated rows get equal verdicts; an empty table stays
    empty. Columns with the names of measures are replaced. Memory grows with one text.
    """
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return measures(docs, text).withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & verdict(thresholds)
    )


def rule_report(docs: DataFrame) -> DataFrame:
    return judge(docs.select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def _bounds_sql() -> str:
    tests = []
    for name, least, most in THRESHOLDS:
        part, whole = RATIOS[name]
        value = f"CASE WHEN {whole} > 0 THEN {part}::DOUBLE / {whole} ELSE 0 END"
        tests += [f"{value} >= {least}::DOUBLE"] if least is not None else []
        tests += [f"{value} <= {most}::DOUBLE"] if most is not None else []
    return " AND ".join(tests)


_STOP_SQL = ", ".join(f"'{w}', '{w.capitalize()}'" for w in sorted({w for group in STOP_WORDS.values() for w in group}))

REPORT_SQL = rf"""
WITH texts AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, shown) AS times
  FROM (SELECT doc_id, i, array_to_string(w[i : i + 7], ' ') AS shown
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM texts WHERE len(w) >= 8))),
repeats AS (
  SELECT doc_id, count(DISTINCT place) AS n
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS place FROM windows WHERE times > 1) GROUP BY doc_id),
measured AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '{SYMBOLS}', '', 'g')) AS n_symbols, len(l) AS n_lines,
    len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
    len(list_filter(w, lambda x: x IN ({_STOP_SQL}))) AS n_stop_words
  FROM texts LEFT JOIN repeats USING (doc_id)),
judged AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {_bounds_sql()} AS kept
FROM judged"""
