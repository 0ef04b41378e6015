"""Project attributes, catalogue records and group summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import format_bytes, parse_bytes, revision, typed_literal


def attribute(name: str, detail: str = "detail", base: str = "base") -> Column:
    """A dotted attribute of JSON configs: the detail config's, else the base config's."""
    return F.coalesce(F.get_json_object(detail, f"$.{name}"), F.get_json_object(base, f"$.{name}"))


def set_json(text: Column, path: list[str], value: Column) -> Column:
    """A JSON object's text with the value, JSON text too, at a path of keys; other keys stay, at every level.

    What stands on the path and is no object becomes one. The key that is set comes last.
    """
    whole = F.coalesce(F.from_json(text, "map<string,variant>"), F.from_json(F.lit("{}"), "map<string,variant>"))
    key, *rest = path
    inner = set_json(F.to_json(F.element_at(whole, key)), rest, value) if rest else value
    return F.to_json(F.map_concat(F.map_filter(whole, lambda k, v: k != key), F.create_map(F.lit(key), F.parse_json(inner))))


def set_attribute(projects: DataFrame, name: str, value: str, chosen: DataFrame | None = None, config: str = "base") -> DataFrame:
    """Set a dotted attribute of a JSON config for all or chosen projects; True, False and None are typed."""
    new = set_json(F.col(config), name.split("."), typed_literal(F.lit(value)))
    if chosen is None:
        return projects.withColumn(config, new)
    marked = projects.join(chosen.select("project_id", F.lit(True).alias("__set")).distinct(), "project_id", "left")
    return marked.withColumn(config, F.when(F.col("__set"), new).otherwise(F.col(config))).drop("__set").select(*projects.columns)


def record(fields: dict[str, tuple[list[Column], object]]) -> Column:
    """Struct of output fields, each the first of its sources that is not null, else its default. Nested dicts nest."""
    out = []
    for name, spec in fields.items():
        value = record(spec) if isinstance(spec, dict) else F.coalesce(*spec[0], F.lit(spec[1]))
        out.append(value.alias(name))
    return F.struct(*out)


def catalogue_items(products: DataFrame, reports: DataFrame) -> DataFrame:
    """Items with their assets; ``OK`` for products with a remote revision, a warning where no report is found.

    ``products``: project_id, cloud_format, remote, version, href; ``reports``: project_id, report_href.
    """
    rows = products.join(reports, "project_id", "left")
    rev = revision(F.col("cloud_format"), F.col("remote"), F.col("version"))
    remote = F.substring(rev, 2, 1) == "r"
    return rows.select(
        "project_id",
        rev.alias("revision"),
        F.when(remote, "OK").otherwise("local").alias("status"),
        F.col("href").alias("reference"),
        "report_href",
        F.when(F.col("report_href").isNull(), "no report").alias("warning"),
    )


def data_summary(projects: DataFrame) -> DataFrame:
    """Sum and mean of files, sizes and chunks of each group, with the formats; skipped projects are left out.

    Sizes are texts such as ``447.10 GB``.
    """
    rows = projects.where(~F.coalesce("skipped", F.lit(False))).select("group_id", "num_files", "total_chunks", "cloud_format", parse_bytes(F.col("source_data")).alias("source"), parse_bytes(F.col("cloud_data")).alias("cloud"))
    sums = [F.sum(c).alias(f"{c}_sum") for c in ("num_files", "total_chunks", "source", "cloud")]
    means = [F.avg(c).alias(f"{c}_mean") for c in ("num_files", "total_chunks", "source", "cloud")]
    out = rows.groupBy("group_id").agg(F.count("*").alias("projects"), *sums, *means, F.array_join(F.array_sort(F.collect_set("cloud_format")), "/").alias("formats"))
    return out.withColumns({"source_text": format_bytes(F.col("source_sum")), "cloud_text": format_bytes(F.col("cloud_sum"))})
