"""Status of projects from their logs: status_log rows, one a line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import age_seconds, short_status, without_prefix
from ..schemas import PHASES

#: Seconds after which a pending project counts as cancelled.
STALE = 86_400


def phase_number(phase: Column) -> Column:
    """Place of a phase in the pipeline, from 0."""
    return F.array_position(F.array(*[F.lit(p) for p in PHASES]), phase).cast("int") - 1


def last_status(log: DataFrame) -> DataFrame:
    """The last line of each project; line order decides, as times are only minutes. Combined on the map side."""
    last = F.max_by(F.struct("phase", "status", "ts", "job_id"), "line_no")
    return log.groupBy("group_id", "project_id").agg(last.alias("s")).select("group_id", "project_id", "s.phase", "s.status", "s.ts", "s.job_id")


def phase_reached(log: DataFrame) -> DataFrame:
    """The furthest phase with a success; the first phase without any."""
    top = F.coalesce(F.max(F.when(F.col("status") == "Success", phase_number(F.col("phase")))), F.lit(0))
    names = F.array(*[F.lit(p) for p in PHASES])
    return log.groupBy("group_id", "project_id").agg(top.alias("k")).select("group_id", "project_id", F.get(names, F.col("k")).alias("phase"))


def cancel_stale(last: DataFrame, now: Column) -> DataFrame:
    """Pending for more than a day becomes JobCancelled."""
    stale = (F.col("status") == "Pending") & (age_seconds(F.col("ts"), now) > STALE)
    return last.withColumn("status", F.when(stale, "JobCancelled").otherwise(F.col("status")))


def next_steps(last: DataFrame) -> DataFrame:
    """(group_id, phase, kind, projects): Redo and JobCancelled repeat the phase, Success moves on except from validate."""
    names = F.array(*[F.lit(p) for p in PHASES])
    again = F.col("status").isin("Redo", "JobCancelled")
    forward = (F.col("status") == "Success") & ~F.col("phase").isin("validate", "complete")
    phase = F.when(again, F.col("phase")).when(forward, F.get(names, phase_number(F.col("phase")) + 1))
    rows = last.withColumns({"next": phase, "kind": F.when(again, F.col("status")).otherwise("Progress")}).where("next is not null")
    return rows.groupBy("group_id", F.col("next").alias("phase"), "kind").agg(F.count("*").alias("projects"))


def status_table(last: DataFrame, ids_below: int = 10, faults: DataFrame | None = None) -> DataFrame:
    """(phase, status, n, percent, variety, place, ids): how many projects stand where, faulted ones left out.

    ``percent`` of all projects that the phase holds; ids are listed for rare statuses only;
    place orders a phase's statuses by count.
    """
    if faults is not None:
        last = last.join(faults.select("project_id"), "project_id", "left_anti")
    counts = last.groupBy("phase", "status").agg(F.count("*").alias("n"))
    rare = counts.where(F.col("n") < ids_below).select("phase", "status")
    ids = last.join(rare, ["phase", "status"], "left_semi").groupBy("phase", "status").agg(F.array_join(F.array_sort(F.collect_list("project_id")), ",").alias("ids"))
    whole = Window.partitionBy("phase")
    place = F.row_number().over(whole.orderBy(F.desc("n"), "status"))
    total = F.sum("n").over(Window.partitionBy())
    rows = counts.withColumns({"in_phase": F.sum("n").over(whole), "variety": F.count("*").over(whole), "place": place, "total": total})
    return rows.join(ids, ["phase", "status"], "left").select("phase", "status", "n", F.round(100 * F.col("in_phase") / F.col("total"), 1).alias("percent"), "variety", "place", "ids")


def validate_split(last: DataFrame) -> DataFrame:
    """Validated projects as Success (with warnings) and Error, with percentages."""
    kind = F.when(F.col("status").rlike("Warn|Success"), "Success").otherwise("Error")
    rows = last.where("phase = 'validate'").groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))
    return rows.withColumn("percent", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy()), 1))


def bucket(status: Column) -> Column:
    """errored, pending or successful."""
    return F.when(status.rlike("Failed|Cancelled|Error"), "errored").when(status.rlike("Pending|Redo"), "pending").otherwise("successful")


def group_overview(last: DataFrame) -> DataFrame:
    """Errored, pending and successful projects by group and phase, with totals of groups and of all (nulls)."""
    is_ = lambda b: F.sum(F.when(bucket(F.col("status")) == b, 1).otherwise(0)).alias(b)
    return last.rollup("group_id", "phase").agg(is_("errored"), is_("pending"), is_("successful"), F.count("*").alias("projects"))


def ready_groups(last: DataFrame) -> DataFrame:
    """Whether every project of a group is complete or passed validation."""
    bad = F.col("status").rlike("Fatal|Pending|Failed|ValidationError|AggregationError")
    ready = (F.col("phase") == "complete") | ((F.col("phase") == "validate") & ~bad)
    return last.groupBy("group_id").agg(F.bool_and(ready).alias("ready"), F.count("*").alias("projects"))


def method_counts(last: DataFrame, methods: DataFrame) -> DataFrame:
    """Projects by combine method (project_id, method); those not yet computed are Incomplete."""
    done = (F.col("phase").isin("validate", "complete")) | ((F.col("phase") == "compute") & (F.col("status") == "Success"))
    rows = last.join(methods, "project_id", "left")
    return rows.groupBy(F.when(~done, "Incomplete").otherwise(F.coalesce("method", F.lit("unable"))).alias("method")).agg(F.count("*").alias("projects"))


def fault_counts(faults: DataFrame) -> DataFrame:
    """Faulted projects by reason."""
    return faults.groupBy("reason").agg(F.count("*").alias("projects"))


def select_by_status(last: DataFrame, phase: str, expression: str) -> DataFrame:
    """Projects of a phase whose status fits an expression.

    Terms joined by ``&`` must all hold. ``Any`` fits all, ``!X`` all but X (exact or short form),
    ``X`` an exact status or, if no project of the phase has it, the short form.
    """
    rows = last.where(F.col("phase") == phase).withColumn("plain", without_prefix(F.col("status")))
    terms = [t.strip() for t in expression.split("&")]
    # Which terms some project has exactly: one row, counted on the map side.
    exact_terms = [t for t in terms if t != "Any" and not t.startswith("!")]
    if exact_terms:
        seen = rows.agg(*[F.coalesce(F.bool_or(F.col("plain") == t), F.lit(False)).alias(f"__seen{k}") for k, t in enumerate(exact_terms)])
        rows = rows.join(F.broadcast(seen), F.lit(True))  # one row
    keep = F.lit(True)
    for term in terms:
        name = term.removeprefix("!")
        exact, short = F.col("plain") == name, short_status(F.col("plain")) == name
        if term.startswith("!"):
            keep = keep & ~(exact | short)
        elif term != "Any":
            keep = keep & F.when(F.col(f"__seen{exact_terms.index(term)}"), exact).otherwise(short)
    return rows.where(keep).select("group_id", "project_id", "phase", "status")


def select_by_phases(last: DataFrame, expressions: dict[str, str]) -> DataFrame:
    """Union of the selections of several phases; ``complete`` is passed over."""
    parts = [select_by_status(last, p, e) for p, e in expressions.items() if p != "complete"]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
