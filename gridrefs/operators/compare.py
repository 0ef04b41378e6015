"""Comparing a combined dataset (test) with its sources (control)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import close
from ..storage import stored


def compare_names(test: DataFrame, control: DataFrame, ignored: tuple[str, ...] = ()) -> DataFrame:
    """Names (project_id, name) missing on a side: (project_id, name, problem, side)."""
    t, c = test.select("project_id", "name").distinct().withColumn("t", F.lit(True)), control.select("project_id", "name").distinct().withColumn("c", F.lit(True))
    rows = t.join(c, ["project_id", "name"], "full_outer").where("t is null or c is null")
    problem = F.when(F.col("name").isin(list(ignored)), "ignored").otherwise("missing") if ignored else F.lit("missing")
    return rows.select("project_id", "name", problem.alias("problem"), F.when(F.col("t").isNull(), "test").otherwise("control").alias("side"))


def compare_order(test: DataFrame, control: DataFrame) -> DataFrame:
    """Projects whose names (project_id, pos, name) stand in another order or number."""
    t, c = test.select("project_id", "pos", F.col("name").alias("t")), control.select("project_id", "pos", F.col("name").alias("c"))
    rows = t.join(c, ["project_id", "pos"], "full_outer")
    return rows.groupBy("project_id").agg(F.bool_or(~F.col("t").eqNullSafe(F.col("c"))).alias("differs")).where("differs").select("project_id")


def compare_attrs(test: DataFrame, control: DataFrame, ignored: tuple[str, ...] = ("aggregation",)) -> DataFrame:
    """Attributes (project_id, scope, attr, value) that differ: problem ignored, missing or not_equal, with both values."""
    keys = ["project_id", "scope", "attr"]
    rows = test.select(*keys, F.col("value").alias("test"), F.lit(1).alias("t")).join(control.select(*keys, F.col("value").alias("control"), F.lit(1).alias("c")), keys, "full_outer")
    problem = F.when(F.col("attr").isin(list(ignored)) & (F.col("scope") == "global"), "ignored").when(F.col("t").isNull() | F.col("c").isNull(), "missing").when(~F.col("test").eqNullSafe(F.col("control")), "not_equal")
    return rows.withColumn("problem", problem).where("problem is not null").select(*keys, "problem", "test", "control")


def align(samples: DataFrame, test: DataFrame, rtol: float = 1e-5, atol: float = 1e-8) -> DataFrame:
    """Window of each sample in the dataset: (dataset, sample, dim, start, length); start is null where it is not found.

    ``samples`` has (dataset, sample, dim, first, length); ``test`` coords. Values are put in cells
    of a logarithmic grid coarser than the tolerance, so the tolerance join is an equality join on
    the cells in which the ends of a sample's interval lie.
    """
    grid = lambda v: F.when(F.abs(v) <= 1e-3, F.lit(0).cast("bigint")).otherwise(F.signum(v) * F.floor(F.log(F.abs(v)) / 1e-3 + 100_000)).cast("bigint")
    reach = atol + rtol * F.abs("first")
    left = samples.withColumn("cell", F.explode(F.array_distinct(F.array(grid(F.col("first") - reach), grid(F.col("first")), grid(F.col("first") + reach)))))
    found = left.join(test.select("dataset", "dim", "pos", "value", grid(F.col("value")).alias("cell")), ["dataset", "dim", "cell"])
    near = F.abs(F.col("value") - F.col("first")) <= atol + rtol * F.abs(F.col("first"))
    hit = F.when(F.col("length") < 2, F.col("value") == F.col("first")).otherwise(near)
    starts = found.where(hit).groupBy("dataset", "sample", "dim").agg(F.min("pos").alias("start"))
    return samples.join(starts, ["dataset", "sample", "dim"], "left").select("dataset", "sample", "dim", "start", "length")


def shift_cells(cells: DataFrame, starts: DataFrame) -> DataFrame:
    """Cells of the test that lie in the window (dataset, starts, lengths), on the sample's coordinates."""
    inside = F.forall(F.zip_with(F.zip_with("idx", "starts", lambda i, s: i - s), "lengths", lambda d, n: (d >= 0) & (d < n)), lambda ok: ok)
    return cells.join(starts, "dataset").where(inside).withColumn("idx", F.zip_with("idx", "starts", lambda i, s: i - s)).drop("starts", "lengths")


def windows(test_meta: DataFrame, control_meta: DataFrame, starts: DataFrame, file_number: int = 0) -> DataFrame:
    """Where a sample's variables lie in the dataset: (project_id, var, starts, lengths, keep), by axis of the dataset's variable.

    ``starts`` (project_id, dim, start) comes from :func:`align`; a dim without a row starts at 0, and
    variables with a dim whose start is null, as it was not found, are left out. A dim that the
    sample's variable lacks is cut at the file's number and not kept.
    """
    axes = test_meta.select("project_id", "var", F.posexplode("dims").alias("axis", "dim"))
    own = control_meta.select("project_id", "var", F.posexplode("dims").alias("own", "dim"), "shape").select("project_id", "var", "dim", F.get("shape", F.col("own")).alias("length"))
    known = control_meta.select("project_id", "var")
    rows = axes.join(known, ["project_id", "var"], "left_semi").join(own, ["project_id", "var", "dim"], "left").join(starts.select("project_id", "dim", "start", F.col("start").isNull().alias("lost")), ["project_id", "dim"], "left")
    has = F.col("length").isNotNull()
    one = F.struct("axis", F.when(has, F.coalesce("start", F.lit(0))).otherwise(file_number).cast("int").alias("start"), F.coalesce("length", F.lit(1)).alias("length"), has.alias("keep"))
    lost = F.bool_or(has & F.coalesce("lost", F.lit(False)))
    out = rows.groupBy("project_id", "var").agg(F.array_sort(F.collect_list(one)).alias("a"), lost.alias("lost")).where("not lost")
    return out.select("project_id", "var", F.col("a.start").alias("starts"), F.col("a.length").alias("lengths"), F.col("a.keep").alias("keep"))


def aligned_cells(cells: DataFrame, placed: DataFrame) -> DataFrame:
    """Cells of the dataset that lie in the windows (project_id, var, starts, lengths, keep), on the sample's axes and coordinates."""
    at = placed.withColumnRenamed("project_id", "dataset")
    moved = F.zip_with("idx", "starts", lambda i, s: i - s)
    inside = F.forall(F.zip_with(moved, F.col("lengths"), lambda d, n: (d >= 0) & (d < n)), lambda ok: ok)
    idx = F.filter(moved, lambda c, i: F.get("keep", i))
    return cells.join(at, ["dataset", "var"]).where(inside).select("dataset", "var", idx.alias("idx"), "value")


def same_grids(test: DataFrame, control: DataFrame) -> DataFrame:
    """Variables (dataset, var) whose chunks have the same places, origins and shapes on both sides."""
    mark = lambda d: d.groupBy("dataset", "var").agg(F.count("*").alias("n"), F.sum(F.xxhash64("chunk", "origin", "shape").cast("decimal(38,0)")).alias("h"))
    return mark(test).intersect(mark(control)).select("dataset", "var")


def side_stats(cells: DataFrame, side: str) -> DataFrame:
    """Count, mean and extremes of one side's cells by variable, NaN left out, and whether all are NaN."""
    v = _number("value")
    return cells.groupBy("dataset", "var").agg(F.count("*").alias(f"n_{side}"), F.avg(v).alias(f"mean_{side}"), F.min(v).alias(f"min_{side}"), F.max(v).alias(f"max_{side}"), F.bool_and(F.isnan("value")).alias(f"nan_{side}"))


def side_stats_of_chunks(chunks: DataFrame, side: str) -> DataFrame:
    """The same from chunks, a row a chunk."""
    numbers = F.filter("values", lambda v: ~F.isnan(v))
    rows = chunks.select("dataset", "var", F.size("values").alias("n"), F.size(numbers).alias("k"), F.aggregate(numbers, F.lit(0.0), lambda a, x: a + x).alias("s"), F.array_min(numbers).alias("low"), F.array_max(numbers).alias("high"))
    sums = rows.groupBy("dataset", "var").agg(F.sum("n").alias(f"n_{side}"), F.sum("k").alias("k"), F.sum("s").alias("s"), F.min("low").alias(f"min_{side}"), F.max("high").alias(f"max_{side}"))
    return sums.select("dataset", "var", f"n_{side}", F.when(F.col("k") > 0, F.col("s") / F.col("k")).alias(f"mean_{side}"), f"min_{side}", f"max_{side}", (F.col("k") == 0).alias(f"nan_{side}"))


def _differing(pairs: DataFrame, stats: DataFrame, off: Column) -> DataFrame:
    """(dataset, var, pairs, differing) of joined pairs, by the tolerance of their variable."""
    tol = stats.select("dataset", "var", "atol")
    return pairs.join(tol, ["dataset", "var"]).groupBy("dataset", "var").agg(F.sum("n").alias("pairs"), F.sum(off.cast("long")).alias("differing"))


def compare_values(test: DataFrame, control: DataFrame, placed: DataFrame | None = None) -> DataFrame:
    """Verdict of every variable that both sides have: (dataset, var, n_test, n_control, nan_control, differing, problems).

    Chunks are joined where both sides share a grid and the sample is the whole; else cells are, in the
    sample's window. Statistics come from each side alone, so the join is made once. ``problems`` is
    empty, ``size``, ``1D-nan``, or the failing comparisons joined by commas.
    """
    from .rechunk import to_cells

    whole = same_grids(test, control)
    if placed is not None:
        cut = placed.where(F.exists("starts", lambda x: x != 0) | F.exists("keep", lambda x: ~x)).select(F.col("project_id").alias("dataset"), "var")
        whole = whole.join(cut, ["dataset", "var"], "left_anti")
    whole = stored(whole, "same-grids")
    both = test.select("dataset", "var").distinct().intersect(control.select("dataset", "var").distinct())
    rest = stored(both.join(whole, ["dataset", "var"], "left_anti"), "other-grids")
    pick = lambda d, names: d.join(names, ["dataset", "var"], "left_semi")
    t_chunks, c_chunks = pick(test, whole), pick(control, whole)
    t_cells, c_cells = to_cells(pick(test, rest)), to_cells(pick(control, rest))
    if placed is not None:
        t_cells = aligned_cells(t_cells, placed)
    keys = ["dataset", "var"]
    stats = side_stats_of_chunks(t_chunks, "test").unionByName(side_stats(t_cells, "test")).join(side_stats_of_chunks(c_chunks, "control").unionByName(side_stats(c_cells, "control")), keys, "full_outer")
    stats = stored(stats.withColumn("atol", F.coalesce(F.abs("mean_test") / 1000, F.lit(float("nan")))), "cell-stats")
    by_chunk = t_chunks.select(*keys, "chunk", F.col("values").alias("t")).join(c_chunks.select(*keys, "chunk", F.col("values").alias("c")), [*keys, "chunk"]).withColumn("n", F.size("t").cast("long"))
    off = F.size(F.filter(F.zip_with("t", "c", lambda t, c: close(c, t, F.col("atol"))), lambda ok: ~ok))
    by_cell = t_cells.select(*keys, "idx", F.col("value").alias("t")).join(c_cells.select(*keys, "idx", F.col("value").alias("c")), [*keys, "idx"]).withColumn("n", F.lit(1).cast("long"))
    found = _differing(by_chunk, stats, off).unionByName(_differing(by_cell, stats, ~close(F.col("c"), F.col("t"), F.col("atol"))))
    rows = stats.join(found, keys, "left").withColumns({"differing": F.coalesce("differing", F.lit(0)), "pairs": F.coalesce("pairs", F.lit(0))})
    apart = lambda k: F.when(F.abs(F.col(f"{k}_control") - F.col(f"{k}_test")) > F.col("atol"), f"{k}_not_equal")
    text = F.concat_ws(",", F.when(F.col("differing") > 0, "not_equal"), apart("max"), apart("min"), apart("mean"))
    uneven = (F.coalesce("n_test", F.lit(0)) != F.coalesce("n_control", F.lit(0))) | (F.col("pairs") != F.col("n_control"))
    problems = F.when(uneven, "size").when((F.col("n_control") == 1) & (F.col("differing") > 0), "1D-nan").otherwise(text)
    return rows.select(*keys, "n_test", "n_control", F.coalesce("nan_control", F.lit(False)).alias("nan_control"), "differing", problems.alias("problems"))


def _number(c: str):
    """A value that averages and extremes may use: NaN is no value."""
    return F.when(~F.isnan(c), F.col(c))


def cell_stats(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Means, extremes and the tolerance of aligned cells (keys, test, control), NaN left out."""
    aggs = [f(_number(side)).alias(f"{name}_{side}") for side in ("test", "control") for name, f in (("mean", F.avg), ("min", F.min), ("max", F.max))]
    all_nan = [F.bool_and(F.isnan(side)).alias(f"nan_{side}") for side in ("test", "control")]
    return pairs.groupBy(*keys).agg(F.count("*").alias("n"), *aggs, *all_nan).withColumn("atol", F.coalesce(F.abs("mean_test") / 1000, F.lit(float("nan"))))


def pair_cells(test: DataFrame, control: DataFrame) -> DataFrame:
    """Aligned cells of both sides."""
    keys = ["dataset", "var", "idx"]
    return test.select(*keys, F.col("value").alias("test")).join(control.select(*keys, F.col("value").alias("control")), keys)


def differing_cells(pairs: DataFrame, stats: DataFrame) -> DataFrame:
    """Cells that are not close, by the tolerance of their variable."""
    tol = stats.select("dataset", "var", "atol")
    return pairs.join(tol, ["dataset", "var"]).where(~close(F.col("control"), F.col("test"), F.col("atol"))).drop("atol")


def verdicts(pairs: DataFrame, stats: DataFrame) -> DataFrame:
    """Problems of each variable, joined by commas; empty if none. A single failing value is ``1D-nan``."""
    tol = stats.select("dataset", "var", "atol")
    equal = pairs.join(tol, ["dataset", "var"]).groupBy("dataset", "var").agg(F.bool_and(close(F.col("control"), F.col("test"), F.col("atol"))).alias("all_close"))
    rows = stats.join(equal, ["dataset", "var"])
    apart = lambda k: F.when(F.abs(F.col(f"{k}_control") - F.col(f"{k}_test")) > F.col("atol"), f"{k}_not_equal")
    text = F.concat_ws(",", F.when(~F.col("all_close"), "not_equal"), apart("max"), apart("min"), apart("mean"))
    return rows.select("dataset", "var", "n", F.when((F.col("n") == 1) & ~F.col("all_close"), "1D-nan").otherwise(text).alias("problems"))


def compare_chunks(test: DataFrame, control: DataFrame, rtol: float = 1e-5) -> DataFrame:
    """Differing values of each chunk where both sides share a chunk grid: one row a chunk is joined, not a row a cell.

    All values of a chunk that a side lacks differ.
    """
    keys = ["dataset", "var", "chunk"]
    both = test.select(*keys, F.col("values").alias("t")).join(control.select(*keys, F.col("values").alias("c")), keys, "full_outer")
    sums = side_stats_of_chunks(test, "test").select("dataset", "var", (F.abs("mean_test") / 1000).alias("atol"))
    off = F.size(F.filter(F.zip_with("t", "c", lambda t, c: close(c, t, F.col("atol"), rtol)), lambda ok: ~F.coalesce(ok, F.lit(False))))
    lone = F.greatest(F.size(F.coalesce("t", F.array().cast("array<double>"))), F.size(F.coalesce("c", F.array().cast("array<double>"))))
    return both.join(sums, ["dataset", "var"], "left").select(*keys, F.when(F.col("t").isNull() | F.col("c").isNull(), lone).otherwise(off).alias("differing"))


def box_level(idx, shape, top: int):
    """Largest k from ``top`` down to 2 for which a cell lies in the centred box of level k; null if in none.

    A dimension shorter than 8 is whole; else the box is [mid - step, mid + step) with mid half the
    size and step the size over 2k.
    """

    def inside(k):
        def one(i, d):
            mid, step = F.floor(d / 2), F.floor(d / (2 * k))
            step = F.when(step == 0, 0.51).otherwise(step)
            return (d < 8) | ((i >= F.floor(mid - step)) & (i < F.floor(mid + step)))

        return F.forall(F.zip_with(idx, shape, one), lambda ok: ok)

    return F.array_max(F.filter(F.sequence(F.lit(2), F.lit(top)), inside))


def growing_box(control: DataFrame, shapes: DataFrame, top: int = 100) -> DataFrame:
    """Level of the smallest centred box with a value that is not NaN: one pass; null level means all NaN.

    ``control`` cells; ``shapes`` (dataset, var, shape).
    """
    start = F.greatest(F.lit(2), F.least(F.array_max("shape"), F.lit(top)))
    cells = control.join(shapes, ["dataset", "var"])
    level = cells.select("dataset", "var", "value", box_level(F.col("idx"), F.col("shape"), top).alias("level"), start.alias("start"))
    seen = F.when(~F.isnan("value") & F.col("level").isNotNull(), F.least("level", "start"))
    return level.groupBy("dataset", "var").agg(F.max(seen).alias("level"))


def compare_meta(test: DataFrame, control: DataFrame) -> DataFrame:
    """Differences of variables' number of dims, sizes and dtype between two var_meta."""
    keys = ["project_id", "var"]
    rows = test.select(*keys, F.col("shape").alias("ts"), F.col("dtype").alias("td")).join(control.select(*keys, F.col("shape").alias("cs"), F.col("dtype").alias("cd")), keys)
    size = lambda s: F.aggregate(s, F.lit(1).cast("bigint"), lambda a, x: a * x)
    problems = F.concat_ws(
        ",",
        F.when(F.size("ts") != F.size("cs"), "dims"),
        F.when(size(F.col("ts")) != size(F.col("cs")), "size"),
        F.when((F.size("ts") == F.size("cs")) & F.exists(F.zip_with("ts", "cs", lambda a, b: a != b), lambda x: x), "dim_size"),
        F.when(~F.col("td").eqNullSafe(F.col("cd")), "dtype/precision"),
    )
    return rows.select(*keys, problems.alias("problems")).where("problems <> ''")


def compare_dims(test: DataFrame, control: DataFrame) -> DataFrame:
    """Dimensions (dataset, dim) whose lengths or values differ; NaN equals NaN. Reports the first value of each side."""
    keys = ["dataset", "dim"]
    rows = test.select(*keys, "pos", F.col("value").alias("t")).join(control.select(*keys, "pos", F.col("value").alias("c")), [*keys, "pos"], "full_outer")
    out = rows.groupBy(*keys).agg(F.bool_or(F.col("t").isNull() | F.col("c").isNull()).alias("sizes"), F.bool_or(~F.col("t").eqNullSafe(F.col("c"))).alias("differs"), F.min_by("t", "pos").alias("first_test"), F.min_by("c", "pos").alias("first_control"))
    return out.where("differs").select(*keys, F.when(F.col("sizes"), "dim_size_errors").otherwise("dim_errors").alias("problem"), "first_test", "first_control")


def control_files(files: DataFrame, seed: int = 0) -> DataFrame:
    """First, last and one other file of each project, the one of the smallest MD5 of seed and uri."""
    whole = Window.partitionBy("project_id")
    ends = (F.col("file_ord") == F.min("file_ord").over(whole)) | (F.col("file_ord") == F.max("file_ord").over(whole))
    marked = files.withColumn("ends", ends)
    by_hash = F.row_number().over(Window.partitionBy("project_id", "ends").orderBy(F.md5(F.concat(F.lit(f"{seed}:"), "uri")), "uri"))
    return marked.withColumn("pick", by_hash).where("ends or pick = 1").drop("ends", "pick")


def time_encoding(test: DataFrame, control: DataFrame) -> DataFrame:
    """Projects whose time coordinate has another dtype on each side: (project_id, test, control)."""
    side = lambda d, name: d.where("var = 'time'").select("project_id", F.col("dtype").alias(name))
    return side(test, "test").join(side(control, "control"), "project_id").where("not (test <=> control)")
