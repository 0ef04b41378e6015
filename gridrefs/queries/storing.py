"""Queries that write stores, documents, reports and logs, and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import combine as cb
from ..operators import report as rp
from ..operators import udf
from ..sources import readers, writers
from ..storage import shared_folder
from . import comparing
from . import derive as dv


def status_log_round_trip(s, d):
    """Status lines, written as text logs and read back; times are minutes."""
    path = f"{shared_folder(s, 'log')}/log"
    writers.append_status(dv.status_log(s, d), path)
    return readers.read_status_log(s, path)


def store_round_trip(s, d):
    """Combined references, written to a Parquet store and read back; ids that look like numbers stay texts."""
    refs = dv.refs(s, d)
    path = shared_folder(s, "store")
    writers.write_store(cb.combined_refs(refs, cb.along(cb.chunk_offsets(cb.chunk_counts(dv.var_meta(s, d))))), path)
    back = writers.read_store(s, path)
    return back.groupBy(F.concat(F.lit("0"), "project_id").alias("code"), "var").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), F.max(F.get("coords", 0)).alias("last"))


def chunk_store_round_trip(s, d):
    """Chunks, written to an array store and read back."""
    path = shared_folder(s, "chunks")
    writers.write_chunks(comparing._chunks(s, d), path)
    back = writers.read_chunks(s, path)
    return back.select("dataset", "var", F.get("chunk", 0).alias("row"), F.size("values").alias("n"), F.round(F.aggregate("values", F.lit(0.0), lambda a, x: a + x), 4).alias("total"))


def report_round_trip(s, d):
    """Reports, written as JSON trees and read back, with their details."""
    path = shared_folder(s, "reports")
    writers.write_report(comparing._report(s, d), path)
    back = rp.unnest(writers.read_reports(s, path))
    return back.select("project_id", "part", "section", "error", "parent", "name", F.col("detail")["line"].alias("line"), "skipped")


def manifest_round_trip(s, d):
    """Manifest lines with quoted patterns and up to twenty variables, written as text and read back."""
    p = dv.projects(s, d).withColumn("k", F.col("project_id").cast("int"))
    names = F.transform(F.sequence(F.lit(1), F.col("k") % 20 + 1), lambda i: F.concat(F.lit("v"), i.cast("string")))
    line = F.concat_ws(",", F.concat(F.lit("p "), "project_id"), F.format_string('"/a/%d/*.nc, /b/%d.nc"', "k", "k"), F.lit("updates.json"), F.lit(""), F.array_join(names, ","))
    path = shared_folder(s, "manifest")
    header = s.range(1).select(F.lit("proj_code,pattern,updates,removals").alias("value"))
    p.select(line.alias("value")).unionByName(header).write.text(path)
    rows = readers.read_manifest(s, path, (("/a/", "/archive/"),))
    return rows.withColumn("keep", F.array_join("keep", " "))


def json_projects(s, d):
    """Projects given as JSON, one alone or several in a list, with those of unknown extensions left out."""
    p = dv.projects(s, d).withColumn("k", F.col("project_id").cast("int"))
    one = F.format_string('{"proj_code":"j%d","pattern":["/x/%d.nc","/x/%d.%s"]}', "k", "k", "k", F.when(F.col("k") % 3 == 0, "csv").otherwise("tif"))
    pair = F.format_string('[{"proj_code":"l%d","pattern":"/y/%d.nc, /z/%d.nc"},%s]', "k", "k", "k", one)
    texts = p.select(F.when(F.col("k") % 2 == 0, pair).otherwise(one).alias("value"))
    old = s.range(1).select(F.lit("j1").alias("project_id"), F.array(F.lit("/old.nc")).alias("uris"), F.lit(None).cast("string").alias("config"))
    return readers.add_projects(old, readers.projects_from_json(texts)).select("project_id", F.array_join("uris", " ").alias("uris"))


def virtual_numbers(s, d):
    """Numbers of the virtual dimension, decoded from its inline chunks."""
    files = dv.files(s, d)
    refs, meta, _ = cb.virtual_dimension(files.select("project_id", "file_ord"))
    each = meta.join(files.select("project_id", "file_ord"), "project_id")
    return udf.decode_chunks(refs, each).select("project_id", "file_ord", F.get("values", 0).cast("long").alias("number"))


def project_function(s, d):
    """A user function over each project's files."""
    fn = lambda p: p.groupby("project_id", as_index=False).agg(files=("file_ord", "size"), total=("file_ord", "sum"))
    return udf.apply_to_projects(dv.files(s, d).select("project_id", "file_ord"), fn, "project_id string, files long, total long")


QUERIES = {f.__name__: f for f in (status_log_round_trip, store_round_trip, chunk_store_round_trip, report_round_trip, manifest_round_trip, json_projects, virtual_numbers, project_function)}

SQL = {
    "status_log_round_trip": f"WITH {dv.LOG} SELECT group_id, project_id, row_number() OVER (PARTITION BY group_id, project_id ORDER BY line_no) - 1 AS line_no, phase, status, date_trunc('minute', ts) AS ts, '' AS job_id FROM log",
    "store_round_trip": f"WITH {dv.REFS} SELECT '0' || project_id AS code, var, count(*) AS n, CAST(sum(size) AS BIGINT) AS bytes, CAST(count(*) - 1 AS INTEGER) AS last FROM refs GROUP BY project_id, var",
    "chunk_store_round_trip": "SELECT 'e' AS dataset, 'v' AS var, CAST(vec_id AS INTEGER) AS row, CAST(len(embedding) AS INTEGER) AS n, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 4) AS total FROM embeddings",
    "report_round_trip": f"WITH {dv.LOG}{comparing._REPORT} SELECT project_id, part, section, error, CASE WHEN k = 7 THEN 'global' END AS parent, name, line, FALSE AS skipped FROM report",
    "manifest_round_trip": f"WITH {dv.PROJECTS} SELECT 'p' || k AS project_id, '/archive/' || k || '/*.nc,/b/' || k || '.nc' AS pattern, 'updates.json' AS updates, CAST(NULL AS VARCHAR) AS removals, array_to_string(list_transform(range(1, k % 20 + 2), lambda i: 'v' || i), ' ') AS keep, CAST(NULL AS VARCHAR) AS problem FROM projects",
    "json_projects": f"WITH {dv.PROJECTS} SELECT 'j1' AS project_id, '/old.nc' AS uris UNION ALL SELECT 'j' || k, '/x/' || k || '.nc /x/' || k || '.tif' FROM projects WHERE k % 3 <> 0 AND k <> 1 UNION ALL SELECT 'l' || k, '/y/' || k || '.nc /z/' || k || '.nc' FROM projects WHERE k % 2 = 0",
    "virtual_numbers": f"WITH {dv.FILES} SELECT project_id, file_ord, CAST(file_ord AS BIGINT) AS number FROM files",
    "project_function": f"WITH {dv.FILES} SELECT project_id, count(*) AS files, CAST(sum(file_ord) AS BIGINT) AS total FROM files GROUP BY 1",
}
