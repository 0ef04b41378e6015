"""The operators' queries on the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import on_workers
from . import decontam, exactdup, mixing, neardup, pii, quality, tokencount, tokenout, urlfilter, warc

#: Id that closes a document in flat token files, and in the indexed files.
SEPARATOR, END_ID = 50256, 2


def tokenizer_path() -> str:
    """The public byte-level BPE file; executors have it installed at the same place."""
    return public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the items."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(quality.labelled_texts(docs, table(spark, sf_dir, "labels")))
    scored = quality.score(docs, model)
    return scored.select(
        F.col("doc.doc_id").alias("doc_id"),
        quality.held_out(F.col("doc.doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted from flat files."""
    return tokencount.token_counts(table(spark, sf_dir, "documents"), tokenizer_path(), SEPARATOR)


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the mix takes every document."""
    return mixing.mix_sizes(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as read back from WARC archives."""
    return warc.warc_round_trip(table(spark, sf_dir, "pages"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts of every document."""
    return exactdup.exact_dedup(table(spark, sf_dir, "documents"))


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as read back from token-ID files."""
    return tokenout.token_ids(table(spark, sf_dir, "documents"), tokenizer_path(), END_ID)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    return urlfilter.filter_urls(table(spark, sf_dir, "pages"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.personal_data(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_decontamination, op2_quality, op3_token_counts, op4_near_duplicates, op5_mixing, op6_warc, op7_exact_dedup, op8_token_ids, op9_url_filter, op10_personal_data)
}
