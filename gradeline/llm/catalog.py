"""The operators' registered queries, each over a whole table, and their SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gradeline.llm import (
    bpe, decontaminate, langid, lines, merkle, periodic, quality, rules, shards, shared_strings, simhash, token_counts,
    warc,
)
from gradeline.llm.frames import table

Query = Callable[[SparkSession, str], DataFrame]


def over_documents(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(table(spark, sf_dir, "documents"))


def leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("tiles")


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {
    "op1_warc": lambda spark, sf_dir: warc.archive_report(table(spark, sf_dir, "pages")),
    "op2_line_dedup": over_documents(lines.line_report),
    "op3_quality_rules": over_documents(rules.rule_report),
    "op4_sharding": over_documents(shards.assign_shards),
    "op5_simhash": over_documents(simhash.near_duplicates),
    "op6_decontamination": leaks,
    "op7_byte_bpe": over_documents(bpe.token_report),
    "op8_language_id": over_documents(langid.language_report),
    "op9_token_counts": over_documents(token_counts.count_tokens),
    "op10_quality_classifier": quality_scores,
    "op11_periodic_runs": over_documents(periodic.run_report),
    "op12_suffix_array_dedup": over_documents(shared_strings.removal_report),
    "op13_merkle_manifest": over_documents(merkle.manifest_report),
}

ORACLES: dict[str, str] = {
    "op1_warc": warc.REPORT_SQL,
    "op2_line_dedup": lines.REPORT_SQL,
    "op3_quality_rules": rules.REPORT_SQL,
    "op4_sharding": shards.REPORT_SQL,
    "op13_merkle_manifest": merkle.REPORT_SQL,
}
