"""Groups of projects and their named subsets: project_sets (group_id, set_id, project_id, pos)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def block(projects: DataFrame, size: int, n: int) -> DataFrame:
    """The n-th block of ``size`` projects of each group, by position."""
    return projects.where(F.col("pos").between(n * size, (n + 1) * size - 1))


def by_index(projects: DataFrame, positions: list[int]) -> DataFrame:
    """Projects at given positions."""
    return projects.where(F.col("pos").isin(positions))


def merge_subsets(sets: DataFrame, names: list[str], new: str, distinct: bool = False, remove: bool = False) -> DataFrame:
    """Sets with a new one that strings others together; order and repeats stay unless ``distinct``."""
    place = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("set_id"))
    rows = sets.where(F.col("set_id").isin(names)).withColumn("place", place)
    if distinct:
        rows = rows.groupBy("group_id", "project_id").agg(F.min(F.struct("place", "pos")).alias("m")).select("group_id", "project_id", "m.place", "m.pos")
    pos = F.row_number().over(Window.partitionBy("group_id").orderBy("place", "pos")) - 1
    made = rows.select("group_id", F.lit(new).alias("set_id"), "project_id", pos.cast("int").alias("pos"))
    return (sets.where(~F.col("set_id").isin(names)) if remove else sets).select("group_id", "set_id", "project_id", "pos").unionByName(made)


def merge_groups(sets: DataFrame, a: str, b: str, new: str) -> DataFrame:
    """Two groups as one: projects and subsets of equal names united, each project once, a's first."""
    rows = sets.where(F.col("group_id").isin(a, b)).withColumn("side", F.when(F.col("group_id") == a, 0).otherwise(1))
    once = rows.groupBy("set_id", "project_id").agg(F.min(F.struct("side", "pos")).alias("m"))
    pos = F.row_number().over(Window.partitionBy("set_id").orderBy("m.side", "m.pos", "project_id")) - 1
    made = once.select(F.lit(new).alias("group_id"), "set_id", "project_id", pos.cast("int").alias("pos"))
    return sets.where(~F.col("group_id").isin(a, b)).select("group_id", "set_id", "project_id", "pos").unionByName(made)


def merge_group_tables(table: DataFrame, a: str, b: str, new: str, key: str | None = None) -> DataFrame:
    """Rows of two groups under the new group's name: manifests, fault lists, logs. Of rows with one ``key``, a's stays."""
    rows = table.where(F.col("group_id").isin(a, b))
    if key is not None:
        twice = rows.where(F.col("group_id") == a).select(key)
        rows = rows.where(F.col("group_id") == a).unionByName(rows.where(F.col("group_id") == b).join(twice, key, "left_anti").select(*table.columns))
    return table.where(~F.col("group_id").isin(a, b)).unionByName(rows.withColumn("group_id", F.lit(new)).select(*table.columns))


def split_group(sets: DataFrame, moved: DataFrame, group: str, new: str) -> DataFrame:
    """Projects ``moved`` leave a group and all its subsets for a new group's main set."""
    here = sets.where(F.col("group_id") == group)
    ids = moved.select("project_id").distinct()
    stay = here.join(ids, "project_id", "left_anti")
    pos = F.row_number().over(Window.partitionBy("set_id").orderBy("pos")) - 1
    gone = here.where("set_id = 'main'").join(ids, "project_id", "left_semi")
    cols = ["group_id", "set_id", "project_id", "pos"]
    out = stay.withColumn("pos", pos.cast("int")).select(*cols).unionByName(gone.withColumn("pos", pos.cast("int")).withColumn("group_id", F.lit(new)).select(*cols))
    return sets.where(F.col("group_id") != group).select(*cols).unionByName(out)


def transfer(sets: DataFrame, moved: DataFrame, source: str, target: str) -> DataFrame:
    """Move projects between groups' main sets; those that the target already has are refused and stay."""
    there = sets.where((F.col("group_id") == target) & (F.col("set_id") == "main")).select("project_id")
    ids = moved.select("project_id").distinct().join(there, "project_id", "left_anti")
    cols = ["group_id", "set_id", "project_id", "pos"]
    leaving = (F.col("group_id") == source)
    stay = sets.where(~leaving).select(*cols).unionByName(sets.where(leaving).join(ids, "project_id", "left_anti").select(*cols))
    top = sets.where((F.col("group_id") == target) & (F.col("set_id") == "main")).agg(F.coalesce(F.max("pos"), F.lit(-1)).alias("top"))
    new = sets.where(leaving & (F.col("set_id") == "main")).join(ids, "project_id", "left_semi")
    rank = F.row_number().over(Window.partitionBy("group_id").orderBy("pos", "project_id"))  # of one group
    ranked = new.withColumn("rank", rank).join(F.broadcast(top), F.lit(True))  # one row
    return stay.unionByName(ranked.select(F.lit(target).alias("group_id"), F.lit("main").alias("set_id"), "project_id", (F.col("top") + F.col("rank")).cast("int").alias("pos")))


def remove_projects(sets: DataFrame, gone: DataFrame) -> DataFrame:
    """Sets without some projects, wherever they stand."""
    return sets.join(gone.select("group_id", "project_id").distinct(), ["group_id", "project_id"], "left_anti").select("group_id", "set_id", "project_id", "pos")


def save_subset(sets: DataFrame, chosen: DataFrame, name: str) -> DataFrame:
    """Sets with a selection (group_id, project_id) as a named subset, in the main set's order."""
    main = sets.where("set_id = 'main'").join(chosen.select("group_id", "project_id").distinct(), ["group_id", "project_id"], "left_semi")
    pos = F.row_number().over(Window.partitionBy("group_id").orderBy("pos")) - 1
    return sets.select("group_id", "set_id", "project_id", "pos").unionByName(main.select("group_id", F.lit(name).alias("set_id"), "project_id", pos.cast("int").alias("pos")))


def redo(log: DataFrame, chosen: DataFrame, status: str, now) -> DataFrame:
    """Log with a line more for each chosen project: its last phase with a new status."""
    from .status import last_status

    lines = log.groupBy("group_id", "project_id").agg(F.max("line_no").alias("line"))
    rows = last_status(log).join(chosen.select("group_id", "project_id").distinct(), ["group_id", "project_id"], "left_semi").join(lines, ["group_id", "project_id"])
    new = rows.select("group_id", "project_id", (F.col("line") + 1).alias("line_no"), "phase", F.lit(status).alias("status"), now.alias("ts"), F.lit("").alias("job_id"))
    return log.unionByName(new.select(*log.columns))


def scrub(log: DataFrame, chosen: DataFrame) -> DataFrame:
    """Log in which chosen projects keep their first line only."""
    ids = chosen.select("group_id", "project_id").distinct()
    first = log.join(ids, ["group_id", "project_id"], "left_semi").groupBy("group_id", "project_id").agg(F.min("line_no").alias("line_no"))
    kept = log.join(first, ["group_id", "project_id", "line_no"], "left_semi")
    return log.join(ids, ["group_id", "project_id"], "left_anti").unionByName(kept.select(*log.columns))


def group_sizes(groups: DataFrame, projects: DataFrame) -> DataFrame:
    """Projects of every group; a group without any is marked empty."""
    n = projects.groupBy("group_id").agg(F.count("*").alias("projects"))
    return groups.select("group_id").distinct().join(n, "group_id", "left").select("group_id", F.coalesce("projects", F.lit(0)).alias("projects"), F.col("projects").isNull().alias("empty"))
