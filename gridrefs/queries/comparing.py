"""Queries on two datasets: names, attributes, coordinates, cells, reports, chunks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import combine as cb
from ..operators import compare as cp
from ..operators import rechunk as rc
from ..operators import report as rp
from . import derive as dv


def _attr_sides(s, d):
    a = dv.attrs(s, d)
    test = a.where("file_ord % 2 = 0").groupBy("project_id", "scope", "attr").agg(F.min_by("value", "file_ord").alias("value"))
    control = a.where("file_ord % 2 = 1 and not (attr = 'brand' and file_ord % 5 = 1)").groupBy("project_id", "scope", "attr").agg(F.min_by("value", "file_ord").alias("value"))
    return test, control


def attr_diff(s, d):
    test, control = _attr_sides(s, d)
    return cp.compare_attrs(test, control, ignored=("type",))


def _name_sides(s, d):
    m = dv.var_meta(s, d).select("project_id", "file_ord", F.col("var").alias("name"))
    # A hash of project and name leaves a name out of a side.
    left_out = F.substring(F.md5(F.concat_ws(":", "project_id", "name")), 1, 1)
    names = lambda odd, digit: m.where((F.pmod("file_ord", F.lit(2)) == odd) & (left_out != digit)).groupBy("project_id", "name").agg(F.min("file_ord").alias("first"))
    return names(0, "a"), names(1, "b")


def name_diff(s, d):
    test, control = _name_sides(s, d)
    return cp.compare_names(test, control, ignored=("NO",))


def order_diff(s, d):
    from pyspark.sql import Window

    pos = F.row_number().over(Window.partitionBy("project_id").orderBy("first", "name"))
    return cp.compare_order(*[x.select("project_id", pos.alias("pos"), "name") for x in _name_sides(s, d)])


def monotonic_dims(s, d):
    return cb.not_monotonic(dv.coords(s, d))


def aligned_windows(s, d):
    c = dv.coords(s, d)
    samples = c.groupBy("dataset", F.col("uri").alias("sample"), "dim").agg(F.min("value").alias("first"), F.count("*").alias("length"))
    return cp.align(samples, c)


def cell_diff(s, d):
    pairs = cp.pair_cells(*dv.cells(s, d))
    return cp.differing_cells(pairs, cp.cell_stats(pairs, ["dataset", "var"])).select("dataset", "var", F.get("idx", 0).alias("idx"), F.round("test", 4).alias("test"), F.round("control", 4).alias("control"))


def cell_stats(s, d):
    test, control = dv.cells(s, d)
    blank = lambda c: c.withColumn("value", F.when(F.col("dataset") == "7", float("nan")).otherwise(F.col("value")))
    x = cp.cell_stats(cp.pair_cells(test, blank(control)), ["dataset", "var"])
    return x.select("dataset", "var", "n", "nan_test", "nan_control", *[F.round(c, 3).alias(c) for c in ("mean_test", "min_test", "max_test", "mean_control", "min_control", "max_control")])


def cell_verdict(s, d):
    pairs = cp.pair_cells(*dv.cells(s, d))
    return cp.verdicts(pairs, cp.cell_stats(pairs, ["dataset", "var"]))


def growbox(s, d):
    _, control = dv.cells(s, d)
    mostly = control.withColumn("value", F.when(F.get("idx", 0) % 6 == 0, F.col("value")).otherwise(float("nan")))
    shapes = control.groupBy("dataset", "var").agg(F.array((F.max(F.get("idx", 0)) + 1).cast("int")).alias("shape"))
    return cp.growing_box(mostly, shapes)


def dim_diff(s, d):
    c = dv.coords(s, d)
    other = c.withColumn("value", F.when((F.col("dataset").cast("int") % 7 == 0) & (F.col("pos") == 3), F.col("value") + 1).otherwise(F.col("value"))).where("not (dataset % 9 = 0 and pos < 2)")
    return cp.compare_dims(c, other)


def meta_diff(s, d):
    m = dv.var_meta(s, d)
    side = lambda odd: m.where(F.pmod("file_ord", F.lit(2)) == odd).groupBy("project_id", "var").agg(F.array(F.sum(F.get("shape", 0)).cast("int")).alias("shape"), F.min("dtype").alias("dtype"))
    return cp.compare_meta(side(0), side(1))


def _report(s, d):
    log = dv.status_log(s, d)
    k = F.col("line_no") % 9
    error = F.get(F.array(*[F.lit(e) for e in ("size_errors", "data_errors", "dim_errors", "growbox", "bypassed", "missing", "order", "not_equal", "ignored")]), k.cast("int"))
    part = F.when(k <= 4, "data").otherwise("metadata")
    section = F.when(k == 7, "attributes").when(F.col("line_no") % 2 == 0, "variables").otherwise("dimensions")
    return log.where("status <> 'Success'").select("project_id", part.alias("part"), section.alias("section"), error.alias("error"), F.when(k == 7, "global").alias("parent"), F.concat(F.lit("v"), F.col("line_no") % 4).alias("name"), F.create_map(F.lit("line"), F.col("line_no").cast("string")).alias("detail"), F.lit(False).alias("skipped"))


def worst_errors(s, d):
    return rp.worst_errors(_report(s, d), dv.status_log(s, d))


def bypassed_report(s, d):
    known = s.range(1).select(F.lit("variables").alias("section"), F.lit("data_errors").alias("error"), F.lit(None).cast("string").alias("parent"), F.lit("v2").alias("name"))
    known = known.unionByName(s.range(1).select(F.lit("attributes").alias("section"), F.lit(None).cast("string").alias("error"), F.lit("global").alias("parent"), F.lit("skip_all").alias("name")))
    return rp.bypass(_report(s, d), known).groupBy("section", "error", "name", "skipped").agg(F.count("*").alias("n"))


def matched_reports(s, d):
    r = _report(s, d).where("not (error = 'bypassed' and project_id % 2 = 0)")  # even projects have no such errors
    return rp.matched_reports(r, r.where("project_id % 3 = 0 and error <> 'bypassed'"))


def control_files(s, d):
    return cp.control_files(dv.files(s, d))


def _chunks(s, d):
    e = dv.table(s, d, "embeddings")
    return e.select(F.lit("e").alias("dataset"), F.lit("v").alias("var"), F.array(F.col("vec_id").cast("int"), F.lit(0)).alias("chunk"), F.array(F.col("vec_id").cast("int"), F.lit(0)).alias("origin"), F.array(F.lit(1), F.size("embedding")).alias("shape"), F.col("embedding").cast("array<double>").alias("values"))


def rechunked(s, d):
    out = rc.rechunk(_chunks(s, d), [10, 16])
    total = F.aggregate("values", F.lit(0.0), lambda a, x: a + x)
    return out.select(F.get("chunk", 0).alias("row"), F.get("chunk", 1).alias("col"), F.size("values").alias("n"), F.round(total, 4).alias("total"))


def chunk_cells(s, d):
    cells = rc.to_cells(_chunks(s, d))
    return cells.select(F.get("idx", 0).alias("row"), F.get("idx", 1).alias("col"), F.round("value", 6).alias("value"))


def concat_cells(s, d):
    cells = rc.to_cells(_chunks(s, d)).withColumn("file_ord", F.floor(F.get("idx", 0) / 100).cast("int"))
    local = cells.withColumn("idx", F.array(F.get("idx", 0) % 100, F.get("idx", 1)))
    lengths = dv.table(s, d, "embeddings").groupBy(F.lit("e").alias("dataset"), F.floor(F.col("vec_id") / 100).cast("int").alias("file_ord")).agg(F.count("*").alias("length"))
    out = rc.concatenate(local, lengths)
    return out.groupBy(F.get("idx", 0).alias("row")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


def chunk_diff(s, d):
    c = _chunks(s, d)
    other = c.withColumn("values", F.transform("values", lambda v, i: F.when((F.get("chunk", 0) % 50 == 0) & (i < 5), v + 1).otherwise(v)))
    return cp.compare_chunks(c, other).select(F.get("chunk", 0).alias("row"), "differing")


def rechunk_scheme(s, d):
    dims = dv.coords(s, d).groupBy("dataset", "dim").agg(F.count("*").cast("int").alias("size"))
    more = dims.withColumn("dim", F.lit("x")).withColumn("size", (F.col("size") * 36).cast("int"))
    return rc.rechunk_scheme(dims.unionByName(more))


def shifted_cells(s, d):
    c = dv.coords(s, d)
    cells = c.select("dataset", F.lit("time").alias("var"), F.array("pos").alias("idx"), "value")
    window = c.select("dataset").distinct().select("dataset", F.array(F.lit(2)).alias("starts"), F.array(F.lit(5)).alias("lengths"))
    return cp.shift_cells(cells, window).select("dataset", F.get("idx", 0).alias("pos"), "value")


QUERIES = {f.__name__: f for f in (attr_diff, name_diff, order_diff, monotonic_dims, aligned_windows, cell_diff, cell_stats, cell_verdict, growbox, dim_diff, meta_diff, worst_errors, bypassed_report, matched_reports, control_files, rechunked, chunk_cells, concat_cells, chunk_diff, rechunk_scheme, shifted_cells)}

_SIDES = """,
t AS (SELECT project_id, attr, arg_min(value, file_ord) AS test FROM attrs WHERE file_ord % 2 = 0 GROUP BY 1, 2),
c AS (SELECT project_id, attr, arg_min(value, file_ord) AS control FROM attrs WHERE file_ord % 2 = 1 AND NOT (attr = 'brand' AND file_ord % 5 = 1) GROUP BY 1, 2)"""
_NAMES = """,
t AS (SELECT project_id, var AS name, min(file_ord) AS first FROM meta WHERE file_ord % 2 = 0 AND left(md5(project_id || ':' || var), 1) <> 'a' GROUP BY 1, 2),
c AS (SELECT project_id, var AS name, min(file_ord) AS first FROM meta WHERE abs(file_ord % 2) = 1 AND left(md5(project_id || ':' || var), 1) <> 'b' GROUP BY 1, 2)"""
_REPORT = """,
report AS (SELECT project_id, CAST(line_no AS VARCHAR) AS line, line_no % 9 AS k, CASE WHEN line_no % 9 <= 4 THEN 'data' ELSE 'metadata' END AS part,
  CASE WHEN line_no % 9 = 7 THEN 'attributes' WHEN line_no % 2 = 0 THEN 'variables' ELSE 'dimensions' END AS section,
  (['size_errors','data_errors','dim_errors','growbox','bypassed','missing','order','not_equal','ignored'])[line_no % 9 + 1] AS error, 'v' || (line_no % 4) AS name
  FROM log WHERE status <> 'Success'),
ranked AS (SELECT project_id, CASE WHEN part = 'data' THEN 2 * CASE error WHEN 'size_errors' THEN 0 WHEN 'data_errors' THEN 2 WHEN 'dim_errors' THEN 3 WHEN 'growbox' THEN 4 ELSE 5 END + CASE WHEN section = 'variables' THEN 0 ELSE 1 END
  WHEN section = 'variables' THEN 14 WHEN section = 'dimensions' THEN 15 ELSE 16 END AS rank,
  CASE WHEN part = 'data' THEN CASE WHEN error IN ('size_errors','data_errors','dim_errors') THEN 'Fatal-' ELSE 'Warn-' END || error WHEN section = 'attributes' THEN 'Warn-global_' || name || '_' || error ELSE 'Warn-' || name || '_' || error END AS label
  FROM report WHERE error <> 'ignored'),
worst AS (SELECT project_id, label FROM (SELECT *, row_number() OVER (PARTITION BY project_id ORDER BY rank, label) AS rn FROM ranked) WHERE rn = 1)"""
_CLOSE = "(test IS NULL AND control IS NULL) OR coalesce(abs(control - test) <= atol + 1e-5 * abs(test), FALSE)"
_EMB = "e AS (SELECT vec_id, unnest(embedding) AS v, unnest(range(len(embedding))) AS col FROM embeddings)"

SQL = {
    "attr_diff": f"WITH {dv.ATTRS}{_SIDES} SELECT project_id, 'global' AS scope, attr, CASE WHEN attr = 'type' THEN 'ignored' WHEN test IS NULL OR control IS NULL THEN 'missing' ELSE 'not_equal' END AS problem, test, control FROM t FULL OUTER JOIN c USING (project_id, attr) WHERE attr = 'type' OR test IS DISTINCT FROM control",
    "name_diff": f"WITH {dv.META}{_NAMES} SELECT project_id, name, CASE WHEN name = 'NO' THEN 'ignored' ELSE 'missing' END AS problem, CASE WHEN t.first IS NULL THEN 'test' ELSE 'control' END AS side FROM t FULL OUTER JOIN c USING (project_id, name) WHERE t.first IS NULL OR c.first IS NULL",
    "order_diff": f"WITH {dv.META}{_NAMES}, tp AS (SELECT project_id, name AS a, row_number() OVER (PARTITION BY project_id ORDER BY first, name) AS pos FROM t), cp AS (SELECT project_id, name AS b, row_number() OVER (PARTITION BY project_id ORDER BY first, name) AS pos FROM c) SELECT project_id FROM tp FULL OUTER JOIN cp USING (project_id, pos) GROUP BY 1 HAVING bool_or(a IS DISTINCT FROM b)",
    "monotonic_dims": f"WITH {dv.COORDS}, l AS (SELECT dataset, value, lag(value) OVER (PARTITION BY dataset ORDER BY pos) AS b FROM coords) SELECT dataset, 'time' AS dim, bool_and(b IS NULL OR value > b) AS rises, bool_and(b IS NULL OR value < b) AS falls, count(*) AS n FROM l GROUP BY 1 HAVING NOT bool_and(b IS NULL OR value > b) AND NOT bool_and(b IS NULL OR value < b)",
    "aligned_windows": f"WITH {dv.COORDS}, sm AS (SELECT dataset, uri AS sample, min(value) AS first, count(*) AS length FROM coords GROUP BY 1, 2) SELECT sm.dataset, sample, 'time' AS dim, CAST(min(pos) AS INTEGER) AS start, any_value(length) AS length FROM sm JOIN coords c ON c.dataset = sm.dataset AND CASE WHEN length < 2 THEN value = first ELSE abs(value - first) <= 1e-8 + 1e-5 * abs(first) END GROUP BY 1, 2",
    "cell_diff": f"WITH {dv.CELLS} SELECT dataset, var, CAST(k AS INTEGER) AS idx, round(test, 4) AS test, round(control, 4) AS control FROM pairs JOIN stats USING (dataset, var) WHERE NOT ({_CLOSE})",
    "cell_stats": f"WITH {dv.CELLS} SELECT dataset, var, n, FALSE AS nan_test, dataset = '7' AS nan_control, round(mean_test, 3) AS mean_test, round(min_test, 3) AS min_test, round(max_test, 3) AS max_test, CASE WHEN dataset <> '7' THEN round(mean_control, 3) END AS mean_control, CASE WHEN dataset <> '7' THEN round(min_control, 3) END AS min_control, CASE WHEN dataset <> '7' THEN round(max_control, 3) END AS max_control FROM stats",
    "cell_verdict": f"WITH {dv.CELLS}, eq AS (SELECT dataset, var, bool_and({_CLOSE}) AS ok FROM pairs JOIN stats USING (dataset, var) GROUP BY 1, 2) SELECT dataset, var, n, CASE WHEN n = 1 AND NOT ok THEN '1D-nan' ELSE concat_ws(',', CASE WHEN NOT ok THEN 'not_equal' END, CASE WHEN abs(max_control - max_test) > atol THEN 'max_not_equal' END, CASE WHEN abs(min_control - min_test) > atol THEN 'min_not_equal' END, CASE WHEN abs(mean_control - mean_test) > atol THEN 'mean_not_equal' END) END AS problems FROM stats JOIN eq USING (dataset, var)",
    "growbox": f"""WITH {dv.CELLS}, sh AS (SELECT dataset, max(k) + 1 AS d FROM pairs GROUP BY 1),
lv AS (SELECT unnest(range(2, 101)) AS lv),
bx AS (SELECT dataset, d, lv, floor(floor(d/2) - CASE WHEN floor(d/(2*lv)) = 0 THEN 0.51 ELSE floor(d/(2*lv)) END) AS lo, floor(floor(d/2) + CASE WHEN floor(d/(2*lv)) = 0 THEN 0.51 ELSE floor(d/(2*lv)) END) AS hi FROM sh, lv),
ok AS (SELECT dataset, k FROM pairs WHERE control IS NOT NULL AND k % 6 = 0),
best AS (SELECT ok.dataset, max(least(lv, greatest(2, least(d, 100)))) AS level FROM ok JOIN bx ON ok.dataset = bx.dataset AND (d < 8 OR (k >= lo AND k < hi)) GROUP BY 1)
SELECT sh.dataset, 'price' AS var, CAST(level AS INTEGER) AS level FROM sh LEFT JOIN best USING (dataset)""",
    "dim_diff": f"""WITH {dv.COORDS}, o AS (SELECT dataset, pos, CASE WHEN CAST(dataset AS INTEGER) % 7 = 0 AND pos = 3 THEN value + 1 ELSE value END AS c FROM coords WHERE NOT (CAST(dataset AS INTEGER) % 9 = 0 AND pos < 2)),
j AS (SELECT dataset, pos, value AS t, c FROM coords FULL OUTER JOIN o USING (dataset, pos))
SELECT dataset, 'time' AS dim, CASE WHEN bool_or(t IS NULL OR c IS NULL) THEN 'dim_size_errors' ELSE 'dim_errors' END AS problem, min(t) FILTER (pos = 0) AS first_test, min(c) FILTER (pos = 0) AS first_control FROM j GROUP BY 1 HAVING bool_or(t IS DISTINCT FROM c)""",
    "meta_diff": f"WITH {dv.META}, t AS (SELECT project_id, var, sum(n) AS ts, min(dtype) AS td FROM meta WHERE file_ord % 2 = 0 GROUP BY 1, 2), c AS (SELECT project_id, var, sum(n) AS cs, min(dtype) AS cd FROM meta WHERE abs(file_ord % 2) = 1 GROUP BY 1, 2) SELECT project_id, var, concat_ws(',', CASE WHEN ts <> cs THEN 'size,dim_size' END, CASE WHEN td <> cd THEN 'dtype/precision' END) AS problems FROM t JOIN c USING (project_id, var) WHERE ts <> cs OR td <> cd",
    "worst_errors": f"WITH {dv.LOG}{_REPORT} SELECT project_id, coalesce(label, 'Success') AS worst, CASE WHEN label LIKE '%Fatal%' THEN 'Fatal' WHEN label LIKE '%Warn%' THEN 'Warning' ELSE 'Success' END AS result FROM (SELECT DISTINCT project_id FROM log) LEFT JOIN worst USING (project_id)",
    "bypassed_report": f"WITH {dv.LOG}{_REPORT} SELECT section, error, name, (section = 'variables' AND error = 'data_errors' AND name = 'v2') OR section = 'attributes' AS skipped, count(*) AS n FROM report GROUP BY 1, 2, 3, 4",
    "matched_reports": f"WITH {dv.LOG}{_REPORT}, dr AS (SELECT * FROM report WHERE part = 'data' AND NOT (error = 'bypassed' AND CAST(project_id AS INTEGER) % 2 = 0)), sk AS (SELECT DISTINCT section, error, name FROM dr WHERE CAST(project_id AS INTEGER) % 3 = 0 AND error <> 'bypassed') SELECT DISTINCT project_id FROM dr EXCEPT SELECT project_id FROM dr LEFT JOIN sk ON dr.section = sk.section AND dr.error = sk.error AND dr.name = sk.name WHERE sk.name IS NULL",
    "control_files": f"WITH {dv.FILES}, m AS (SELECT *, file_ord = min(file_ord) OVER p OR file_ord = max(file_ord) OVER p AS ends FROM files WINDOW p AS (PARTITION BY project_id)) SELECT project_id, file_ord, uri FROM (SELECT *, row_number() OVER (PARTITION BY project_id, ends ORDER BY md5('0:' || uri), uri) AS pick FROM m) WHERE ends OR pick = 1",
    "rechunked": f"WITH {_EMB} SELECT CAST(floor(vec_id / 10) AS INTEGER) AS row, CAST(floor(col / 16) AS INTEGER) AS col, CAST(count(*) AS INTEGER) AS n, round(sum(CAST(v AS DOUBLE)), 4) AS total FROM e GROUP BY CAST(floor(vec_id / 10) AS INTEGER), CAST(floor(col / 16) AS INTEGER)",
    "chunk_cells": f"WITH {_EMB} SELECT CAST(vec_id AS INTEGER) AS row, CAST(col AS INTEGER) AS col, round(CAST(v AS DOUBLE), 6) AS value FROM e",
    "concat_cells": f"WITH {_EMB} SELECT CAST(vec_id AS INTEGER) AS row, count(*) AS n, round(sum(CAST(v AS DOUBLE)), 4) AS total FROM e GROUP BY 1",
    "chunk_diff": "SELECT CAST(vec_id AS INTEGER) AS row, CAST(CASE WHEN vec_id % 50 = 0 THEN 5 ELSE 0 END AS INTEGER) AS differing FROM embeddings",
    "rechunk_scheme": f"""WITH {dv.COORDS}, d0 AS (SELECT dataset, 'time' AS dim, count(*) AS size FROM coords GROUP BY 1), dm AS (SELECT * FROM d0 UNION ALL SELECT dataset, 'x', size * 36 FROM d0),
tg AS (SELECT dataset, dim, size, CASE WHEN sum(size) OVER (PARTITION BY dataset) > 20000 THEN 10000.0 * size / sum(size) OVER (PARTITION BY dataset) ELSE size / 10 END AS target FROM dm),
dv AS (SELECT dataset, dim, size, target, unnest(range(1, size + 1)) AS x FROM tg)
SELECT dataset, dim, CAST(size AS INTEGER) AS size, CAST(x AS INTEGER) AS chunk FROM (SELECT *, row_number() OVER (PARTITION BY dataset, dim ORDER BY abs(x - target), x) AS rn FROM dv WHERE size % x = 0) WHERE rn = 1""",
    "shifted_cells": f"WITH {dv.COORDS} SELECT dataset, CAST(pos - 2 AS INTEGER) AS pos, value FROM coords WHERE pos BETWEEN 2 AND 6",
}
