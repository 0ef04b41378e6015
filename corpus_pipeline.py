"""Corpus pipeline: quality, near-duplicates, decontamination, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next one's ``docs``. All but the last return the columns of ``docs``.

Cases: null and empty texts are scored like any others, are no near-duplicates, hold no item and
count no words, so that the mix takes them by their source's whole repetitions and keys; rows of a
null id are never near-duplicates and are removed as contaminated by their own text; repeated rows go
or stay together, but for near-duplicates, where all rows of the kept id stay; an empty table passes
through every stage; extra columns, whatever their names, pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridrefs.llm import decontam, mixing, neardup, quality, tokenout
from gridrefs.llm.queries import END_ID, table, tokenizer_path
from gridrefs.llm.shared import stored


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of the smallest id."""
    return neardup.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.sample_mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each document of the mix, from its token-ID files."""
    return tokenout.token_ids(docs, tokenizer_path(), END_ID)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("token_ids", token_ids),
]

#: Compression, MinHash and tokenizing have no SQL; the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
