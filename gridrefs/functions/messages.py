"""Texts of errors about whole projects, as Column expressions over tables of findings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def chunk_sizes(var: Column, first: Column, other: Column) -> Column:
    """Chunk sizes of a variable that differ between files; sizes may be null."""
    sizes = F.when(first.isNotNull(), F.format_string(" %s vs %s", first.cast("string"), other.cast("string"))).otherwise("")
    return F.concat(F.lit("Chunk sizes differ between refs for "), var, sizes, F.lit(" - files cannot be concatenated"))


def missing_data(reason: Column, followup: Column | str = "Kerchunk product incomplete") -> Column:
    """What a product lacks, and what follows from it."""
    return F.concat(F.lit("Data missing: "), reason, F.lit(" - "), F.lit(followup) if isinstance(followup, str) else followup)


def wrong_order(dims: Column) -> Column:
    """Dims along which files are not in order."""
    return F.concat(F.lit("Aggregation is incorrectly ordered for dimension(s): "), dims)


def no_source(uri: Column) -> Column:
    """A source file that isn't there."""
    return F.concat(F.lit("Source file could not be located: "), uri)


def errors_of(chunk_errors: DataFrame, missing_files: DataFrame, unordered: DataFrame) -> DataFrame:
    """(project_id, error, text), a row for each error of a combined project.

    ``chunk_errors``: project_id, var, low, high; ``missing_files``: project_id, uri; ``unordered``:
    project_id, dim. A project's missing files are counted, its dims listed.
    """
    chunks = chunk_errors.select("project_id", F.lit("ConcatFatalError").alias("error"), chunk_sizes(F.col("var"), F.col("low"), F.col("high")).alias("text"))
    files = missing_files.groupBy("project_id").agg(F.count("*").alias("n"), F.min("uri").alias("uri"))
    reason = F.format_string("%d file(s), %s first", F.col("n"), F.col("uri"))
    lost = files.select("project_id", F.lit("MissingDataError").alias("error"), missing_data(reason).alias("text"))
    dims = unordered.groupBy("project_id").agg(F.array_join(F.array_sort(F.collect_set("dim")), ", ").alias("dims"))
    order = dims.select("project_id", F.lit("AggregationError").alias("error"), wrong_order(F.col("dims")).alias("text"))
    return chunks.unionByName(lost).unionByName(order)
