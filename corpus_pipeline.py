"""A training corpus from `documents`: known languages, one of each group of near copies, no benchmark items, no secrets, mixed sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedmart.llm import decontaminate, language_id, mixing, near_duplicates, secrets
from feedmart.llm.common import pick, settle, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6. Drops texts that are null, have no letter, or look like no learned language."""
    return language_id.keep_known(pick(docs, *COLUMNS))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10, on shingles of five words. Keeps the smallest doc_id of each group; repeated rows once."""
    return near_duplicates.one_of_each(pick(docs, *COLUMNS), near_duplicates.Settings(shingle=5))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1. Drops documents that hold a benchmark item, also with other numbers or names."""
    return decontaminate.clean(pick(docs, *COLUMNS), table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5. Keeps every document and replaces secrets in its text by marks; n_chars follows."""
    return secrets.redact_secrets(pick(docs, *COLUMNS))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2, by words. Adds tokens, epoch, block, start and weight; a row per copy that the mix takes."""
    counted = settle(pick(docs, *COLUMNS).withColumn("tokens", mixing.word_count()), "mix-tokens")
    return mixing.mix(counted, "tokens")


STAGES = [
    ("language_id", known_language),
    ("near_duplicates", one_of_near_copies),
    ("decontamination", without_benchmark),
    ("secret_scan", without_secrets),
    ("mixing", mixed_sources),
]

# Neither the network nor the token vocabulary can be written in SQL; tests/llm/test_pipeline.py has the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage keeps is written and read again for the next one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
