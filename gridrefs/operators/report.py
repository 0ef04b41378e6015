"""Validation reports as long tables, and their verdict.

report: project_id, part ('metadata' or 'data'), section, error, parent, name, detail, skipped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import broadcast_if_small

#: The order in which errors of the data part decide, with the kind of verdict.
DATA_PRIORITY = ("size_errors", "dim_size_errors", "data_errors", "dim_errors", "growbox", "bypassed", "dtype/precision")
FATAL = DATA_PRIORITY[:4]


def _priority() -> tuple[Column, Column]:
    """Rank and label of a report row; null label where it never decides."""
    kind = F.when(F.col("error").isin(*FATAL), "Fatal").otherwise("Warn")
    rank = F.lit(None).cast("int")
    for k, e in enumerate(DATA_PRIORITY):
        rank = F.when(F.col("error") == e, 2 * k + F.when(F.col("section") == "variables", 0).otherwise(1)).otherwise(rank)
    data = F.col("part") == "data"
    base = 2 * len(DATA_PRIORITY)
    names = F.when(F.col("section") == "variables", base).when(F.col("section") == "dimensions", base + 1).otherwise(base + 2)
    label = F.when(data, F.concat_ws("-", kind, F.col("error"))).when(F.col("section") == "attributes", F.concat(F.lit("Warn-"), F.concat_ws("_", "parent", "name", "error"))).otherwise(F.concat(F.lit("Warn-"), F.concat_ws("_", "name", "error")))
    return F.when(data, rank).otherwise(names), label


def bypass(report: DataFrame, known: DataFrame) -> DataFrame:
    """Mark known issues as skipped; they stay in the report.

    ``known`` has (section, error, parent, name); a null parent or name, or ``skip_all`` as name,
    fits all. It is broadcast if it is counted to be short; else its sections deal out the join.
    """
    k = known.select(*[F.col(c).alias(f"k_{c}") for c in ("section", "error", "parent", "name")]).distinct()
    k = broadcast_if_small(k, F.lit(200))
    any_ = lambda c: F.col(f"k_{c}").isNull() | F.col(f"k_{c}").eqNullSafe(F.col(c))
    fits = (F.col("k_section") == F.col("section")) & any_("error") & any_("parent") & (any_("name") | (F.col("k_name") == "skip_all"))
    hits = report.join(k, fits, "left_semi").withColumn("skipped", F.lit(True))
    return hits.unionByName(report.join(k, fits, "left_anti"))


def worst_errors(report: DataFrame, projects: DataFrame) -> DataFrame:
    """(project_id, worst, result) for every project: the first error by priority that isn't skipped or ignored."""
    rank, label = _priority()
    rows = report.where(~F.coalesce("skipped", F.lit(False)) & (F.col("error") != "ignored")).select("project_id", rank.alias("rank"), label.alias("label")).where("rank is not null")
    worst = rows.groupBy("project_id").agg(F.min(F.struct("rank", "label")).getField("label").alias("label"))
    text = F.coalesce("label", F.lit("Success"))
    return projects.select("project_id").distinct().join(worst, "project_id", "left").select("project_id", text.alias("worst"), F.when(F.contains(text, F.lit("Fatal")), "Fatal").when(F.contains(text, F.lit("Warn")), "Warning").otherwise("Success").alias("result"))


def matched_reports(report: DataFrame, sample: DataFrame) -> DataFrame:
    """Projects whose data reports hold no key that a sample report lacks."""
    keys = ["section", "error", "name"]
    data = report.where("part = 'data'")
    odd = data.join(sample.where("part = 'data'").select(*keys).distinct(), keys, "left_anti").select("project_id").distinct()
    return data.select("project_id").distinct().join(odd, "project_id", "left_anti")


def nest(report: DataFrame) -> DataFrame:
    """(project_id, value): a project's report as one JSON tree, part -> section -> error -> list of entries with parent, name, detail and skipped.

    A report has a few entries for each variable, dimension or attribute, so a project's is one row.
    """
    entry = F.struct("parent", "name", F.map_from_entries(F.array_sort(F.map_entries("detail"))).alias("detail"), F.coalesce("skipped", F.lit(False)).alias("skipped"))
    text = F.to_json(entry)
    key = lambda c, v: F.concat(F.to_json(F.array(c)).substr(F.lit(2), F.length(F.to_json(F.array(c))) - 2), F.lit(":"), v)
    tree = lambda items: F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list(items)), ","), F.lit("}"))
    by_error = report.groupBy("project_id", "part", "section", "error").agg(F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_list(text)), ","), F.lit("]")).alias("v"))
    by_section = by_error.groupBy("project_id", "part", "section").agg(tree(key(F.col("error"), F.col("v"))).alias("v"))
    by_part = by_section.groupBy("project_id", "part").agg(tree(key(F.col("section"), F.col("v"))).alias("v"))
    return by_part.groupBy("project_id").agg(tree(key(F.col("part"), F.col("v"))).alias("value"))


def unnest(reports: DataFrame) -> DataFrame:
    """Report rows from (project_id, value), the JSON trees of :func:`nest`."""
    kind = "map<string,map<string,map<string,array<struct<parent:string,name:string,detail:map<string,string>,skipped:boolean>>>>>"
    rows = reports.select("project_id", F.explode(F.from_json("value", kind)).alias("part", "v"))
    for level in ("section", "error"):
        rows = rows.select(*[c for c in rows.columns if c != "v"], F.explode("v").alias(level, "v"))
    return rows.select("project_id", "part", "section", "error", F.inline("v"))
