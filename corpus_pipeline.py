"""From raw documents to packed sequences: clean, deduplicate, decontaminate, pack.

Each stage works on all that the stage before it kept, written as Parquet and read again, so a stage lost
with its executors is repeated from there. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from charlake.llm.decontamination import clean_of
from charlake.llm.fuzzy_lines import without_fuzzy_lines
from charlake.llm.ngram_join import one_of_each
from charlake.llm.packing import pack_documents
from charlake.llm.quality import clean_documents
from charlake.llm.registry import ship, table
from charlake.llm.tokens import vocabulary
from charlake.operators.scratch import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and documents that are rejected."""
    ship(spark)
    return clean_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines much like an earlier line go, and documents that have no line left."""
    return without_fuzzy_lines(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones stays."""
    ship(spark)
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark item in them go."""
    ship(spark)
    return clean_of(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents left, each with its sequence and place there."""
    ship(spark)
    return pack_documents(docs, vocabulary("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_join", ngram_join),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Edit matching and tokenizing have no SQL form; tests hold run() against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
