"""A corpus pipeline of the operators in ``gradeline.llm``: documents in, token ids out.

Every stage takes (spark, docs, sf_dir) and returns a frame; stages are joined by Parquet tables in
the shared folder, so a lost executor costs no finished stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeline.llm import bpe, decontaminate, lines, rules, simhash
from gradeline.llm.frames import table
from gradeline.sources.tables import keep

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, each row by itself; NULL and empty texts have no words and go."""
    return rules.judge(docs.select(*COLUMNS)).where("kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a document of a smaller id has; every row stays, with an empty text if all lines go."""
    reduced = lines.dedup_lines(docs.select(*COLUMNS))
    return reduced.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each component of fingerprints at most 4 of 64 bits apart.

    Texts without words are one component; equal rows count once; rows without id stay if no row with one is like them.
    """
    return simhash.first_of_each(docs.select(*COLUMNS), distance=simhash.DISTANCE, size=simhash.SHINGLE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item, by the text of each row whatever its id; NULL and empty texts hold none."""
    return decontaminate.without_leaks(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, checked by what they decode to; NULL and empty texts have none."""
    return bpe.token_report(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", byte_bpe),
]

#: SQL has no tokenizer; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = keep(docs, f"stage{number}")
    return docs
