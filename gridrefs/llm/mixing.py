"""Mixing sources to target weights by capped water-filling.

Each source asks for its weight's share of the wanted total; a source can give at most
``max_epochs`` times its size. Sources that would exceed that are clamped, and what they
can't give is shared among the others by weight until nobody exceeds. In closed form: sort
sources by cap / weight; the water level after clamping the first i sources is what is left of
the total over what is left of the weights; clamping ends at the first source whose cap is
above the level. Only one row a source takes part in that.

A source's target is met by whole repetitions of all its documents and by a seeded sample for
the fraction: documents are ordered by an MD5 key of seed and id, and those below a cut value
are taken once more. The cut comes from sums over 4096 key ranges and an exact pass over the
one range in which the target falls, so no source is ever sorted as a whole, and applying it
takes a broadcast of one row a source and no shuffle of documents.

Cases: null text has size 0; null is a source of its own, ranked last; repeated rows share one
key, so they are taken alike; a null id is a key of its own; sources of size 0 get target 0;
an empty table gives an empty result; columns with clashing names pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import maybe_broadcast, stored, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2.0
SEED = 17


def sample_key(id_col: Column, seed: int) -> Column:
    """32 hex digits that order documents at random, the same at each run."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null"))))


def water_fill(sources: DataFrame, share: float = SHARE, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` to (source, source_size, weight): one row a source."""
    everything = Window.partitionBy()
    rising = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    earlier = rising.rowsBetween(Window.unboundedPreceding, -1)
    return (
        sources.withColumn("cap", max_epochs * F.col("source_size"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("total", share * F.sum("source_size").over(everything))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0)))
        .withColumn("weights", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0)))
        .withColumn("level", F.col("left") / F.col("weights"))
        .withColumn("fill", F.max(F.when(F.col("ratio") > F.col("level"), F.col("level"))).over(everything))
        .withColumn("target", F.when(F.col("fill").isNull() | (F.col("ratio") <= F.col("fill")), F.col("cap")).otherwise(F.col("fill") * F.col("weight")))
        .select("source", "source_size", "weight", "target")
    )


def mixing_plan(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """One row a source from (source, size, key): target, whole repetitions, and the cut of the fraction.

    A document is taken once more if its key's first three digits are below ``cut_bin``, or equal
    to it and the key is at most ``cut_key``.
    """
    bins = sizes.groupBy("source", F.substring("key", 1, 3).alias("bin")).agg(F.sum("size").alias("bin_size"))
    by_source = bins.groupBy("source").agg(F.sum("bin_size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.lit(list(weights)), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    plan = (
        water_fill(by_source.withColumn("weight", weight), share, max_epochs)
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    )
    plan = stored(plan, "mixing-targets")
    # The range in which the fraction ends, with the sum of the ranges below it.
    below = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    named = plan.select(F.col("source").alias("plan_source"), "rest")
    at = (
        bins.withColumn("below", F.coalesce(F.sum("bin_size").over(below), F.lit(0)))
        .join(maybe_broadcast(named), F.col("source").eqNullSafe(F.col("plan_source")))
        .where((F.col("below") <= F.col("rest")) & (F.col("rest") < F.col("below") + F.col("bin_size")))
        .select("plan_source", F.col("bin").alias("cut_bin"), "below", "rest")
    )
    at = stored(at, "mixing-cuts")
    inside = (
        sizes.join(maybe_broadcast(at), F.col("source").eqNullSafe(F.col("plan_source")) & (F.substring("key", 1, 3) == F.col("cut_bin")))
        .groupBy("plan_source", "key")
        .agg(F.sum("size").alias("size"), F.first("below").alias("below"), F.first("rest").alias("rest"))
    )
    upto = Window.partitionBy("plan_source").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        inside.withColumn("low", F.col("below") + F.coalesce(F.sum("size").over(upto), F.lit(0)))
        .where(F.col("low") + F.col("size") / 2 <= F.col("rest"))
        .groupBy("plan_source")
        .agg(F.max("key").alias("cut_key"))
    )
    cuts = at.select("plan_source", "cut_bin").join(cut.withColumnRenamed("plan_source", "cut_source"), F.col("plan_source").eqNullSafe(F.col("cut_source")), "left")
    return plan.join(cuts.select("plan_source", "cut_bin", "cut_key"), F.col("source").eqNullSafe(F.col("plan_source")), "left").select("source", "source_size", "weight", "target", "whole", "cut_bin", F.coalesce("cut_key", F.lit("")).alias("cut_key"))


def _planned(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple[int, ...], share: float, max_epochs: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """Sizes (doc_id, source, size, key) of all documents, whose words are counted here and only here, and the plan of each source."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), sample_key(F.col(id_col), seed).alias("key"))
    sizes = stored(rows, "mixing-sizes")
    return sizes, stored(mixing_plan(sizes, weights, share, max_epochs), "mixing-plan").withColumnRenamed("source", "plan_source")


def _times(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (with source and key) and their source's plan, with how often each is taken."""
    bin_ = F.substring("key", 1, 3)
    once_more = F.coalesce((bin_ < F.col("cut_bin")) | ((bin_ == F.col("cut_bin")) & (F.col("key") <= F.col("cut_key"))), F.lit(False))
    return rows.join(maybe_broadcast(plan), F.col("source").eqNullSafe(F.col("plan_source"))).withColumn("times", F.col("whole") + once_more.cast("long"))


def mix_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """What the mix takes, a row a document, without its text: doc_id, source, size, source_size, target, times, taken."""
    sizes, plan = _planned(docs, id_col, text_col, source_col, weights, share, max_epochs, seed)
    return _times(sizes, plan).select("doc_id", "source", "size", "source_size", "target", "times", (F.col("times") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """Every document, as struct ``doc`` with all its columns, and how often it is taken: doc, source, times."""
    _, plan = _planned(docs, id_col, text_col, source_col, weights, share, max_epochs, seed)
    rows = docs.select(F.struct("*").alias("doc")).select("doc", F.col(f"doc.{source_col}").alias("source"), sample_key(F.col(f"doc.{id_col}"), seed).alias("key"))
    return _times(rows, plan).select("doc", "source", "times")


def sample_mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document's row as many times as it is taken, with the input's columns."""
    return mix(docs, **options).where("times > 0").select("doc", F.explode(F.expr("sequence(1L, times)")).alias("turn")).select("doc.*")
