"""Queries on references: scan, order, combine, attributes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import format_bytes, substitute
from ..operators import attrs as at
from ..operators import combine as cb
from ..operators import refs as rf
from ..schemas import REFS
from ..sources import readers, writers
from ..storage import shared_folder, stored
from . import derive as dv


def file_summary(s, d):
    return rf.file_summary(dv.refs(s, d))


def project_scan(s, d):
    x = rf.project_scan(dv.refs(s, d))
    r = lambda c: F.round(c, 4).alias(c)
    return x.select("project_id", "n_files", "num_vars", *[r(c) for c in ("avg_cpf", "avg_vol", "avg_chunk", "spatial_res", "source_bytes", "total_chunks", "addition", "cloud_bytes")], "output_type", "skipped")


def output_type(s, d):
    refs = dv.refs(s, d)
    drivers = dv.files(s, d).select("project_id", F.when(F.pmod("file_ord", F.lit(3)) == 1, "hdf5").otherwise("netcdf3").alias("driver"))
    out = rf.scan_details(rf.project_scan(refs), rf.chunks_per_variable(refs), drivers)
    return out.withColumn("variables", F.to_json("variables"))


def chunks_per_var(s, d):
    return rf.chunks_per_variable(dv.refs(s, d)).withColumn("mean_chunks", F.round("mean_chunks", 4))


def scan_sample(s, d):
    return rf.sample_files(dv.files(s, d))


def file_ranges(s, d):
    return rf.file_ranges(dv.files(s, d), 7)


def first_files(s, d):
    return rf.first_files(dv.files(s, d), 3)


def missing_ranges(s, d):
    done = F.substring(F.md5(F.concat_ws(":", "project_id", "part")), 1, 1) > "4"
    parts = rf.file_ranges(dv.files(s, d), 7).where(done).select("project_id", "part").distinct()
    totals = dv.files(s, d).groupBy("project_id").agg(F.lit(7).alias("total"))
    return rf.missing_ranges(parts, totals)


def file_order(s, d):
    return cb.order_files(dv.coords(s, d))


def chunk_offsets(s, d):
    return cb.chunk_offsets(cb.chunk_counts(dv.var_meta(s, d)))


def grid_placement(s, d):
    m = dv.files(s, d)
    month = F.regexp_extract("uri", r"f(-?\d+)$", 1).cast("int")
    year = m.select("project_id", "file_ord", F.lit("year").alias("dim"), F.floor(month / 12).cast("int").alias("first"))
    in_year = m.select("project_id", "file_ord", F.lit("month").alias("dim"), F.pmod(month, F.lit(12)).cast("int").alias("first"))
    return cb.grid_placement(year.unionByName(in_year))


def combined_refs(s, d):
    refs = dv.refs(s, d)
    out = cb.combined_refs(refs, cb.along(cb.chunk_offsets(cb.chunk_counts(dv.var_meta(s, d)))))
    return out.select("project_id", "file_ord", "var", F.get("coords", 0).alias("coord"), "path", "size")


def overlaps(s, d):
    return cb.overlaps(dv.refs(s, d)).select("project_id", "var", F.get("coords", 0).alias("coord"), "n")


def missing_files(s, d):
    kept = dv.refs(s, d).where("size > 2000 and var = 'RF'")
    return rf.missing_files(dv.files(s, d).select("project_id", "uri"), kept)


def refs_per_file(s, d):
    return rf.refs_per_file(dv.refs(s, d))


def merged_chunks(s, d):
    one = dv.refs(s, d).groupBy("project_id", "var", "coords").agg(F.sum("size").alias("size"))
    inline = one.withColumn("inline", F.encode(F.lpad(F.col("size").cast("string"), 8, "0"), "UTF-8"))
    out = rf.merge_inline(inline, ideal=4)
    return out.select("project_id", "var", F.get("coords", 0).alias("coord"), F.decode("inline", "UTF-8").alias("bytes"))


def chunk_consistency(s, d):
    meta = dv.var_meta(s, d).withColumn("chunks", F.array(F.when(F.pmod("file_ord", F.lit(40)) == 7, 2).otherwise(1)))
    return rf.inconsistent_chunks(meta)


def variable_consistency(s, d):
    return rf.inconsistent_variables(dv.refs(s, d))


def unit_conflicts(s, d):
    return rf.conflicting_units(dv.var_meta(s, d))


def dim_roles(s, d):
    m = dv.var_meta(s, d)
    size = F.get("shape", 0)
    var = m.select("project_id", "file_ord", F.col("var").alias("name"), F.lit("var").alias("kind"), F.when(F.col("var") == "NO", F.array().cast("array<string>")).otherwise(F.col("dims")).alias("dims"), F.when(F.col("var") == "NO", "same").otherwise(size.cast("string")).alias("print"))
    dims = m.groupBy("project_id", "file_ord").agg(F.sum(size).cast("string").alias("print")).select("project_id", "file_ord", F.lit("time").alias("name"), F.lit("dim").alias("kind"), F.array().cast("array<string>").alias("dims"), "print")
    return cb.classify(var.unionByName(dims))


def merged_attrs(s, d):
    return at.merge_attrs(dv.attrs(s, d).where("file_ord % 3 <> 1 or attr <> 'type'"))


def corrected_attrs(s, d):
    merged = at.merge_attrs(dv.attrs(s, d)).select("project_id", "attr", "value")
    ids = merged.select("project_id").distinct()
    updates = ids.where("project_id % 2 = 0").select("project_id", F.lit("brand").alias("attr"), F.lit("own").alias("value"))
    removals = ids.where("project_id % 3 = 0").select("project_id", F.lit("type").alias("attr"))
    defaults = ids.select("project_id", F.lit("title").alias("attr"), F.lit("untitled").alias("value"))
    return at.correct_attrs(merged, updates, removals, defaults)


def history(s, d):
    merged = at.merge_attrs(dv.attrs(s, d)).select("project_id", "attr", "value")
    return at.add_history(merged, "version raised", F.lit("2024-05-01 12:30:00").cast("timestamp")).where("attr in ('history', 'last_changed')")


def links(s, d):
    return rf.relink(dv.refs(s, d), "/d1", "https://data.example.org/d1").groupBy("path").agg(F.count("*").alias("n"))


def substitutions(s, d):
    return dv.table(s, d, "pages").select("page_id", substitute(F.col("url"), [("http://", "https://"), ("example", "archive"), ("/en/", "/english/")]).alias("url"))


def byte_texts(s, d):
    return dv.refs(s, d).groupBy("project_id").agg(F.sum("size").alias("bytes")).select("project_id", format_bytes(F.col("bytes") * 997).alias("text"))


def document_round_trip(s, d):
    """Whole combined documents, written for projects small enough and read back, united with a store of the others."""
    refs = dv.refs(s, d)
    meta = stored(dv.var_meta(s, d), "meta")
    offsets = cb.along(cb.chunk_offsets(cb.chunk_counts(meta)))
    whole = stored(cb.combined_refs(refs, offsets), "combined")
    places = meta.select("project_id", "file_ord", F.lit("time").alias("dim"), F.col("file_ord").alias("place")).distinct()
    docs, large = writers.documents(whole, cb.combined_meta(meta, places))
    top = shared_folder(s, "documents")
    writers.write_documents(docs, f"{top}/json")
    writers.write_store(whole.join(large, "project_id", "left_semi").select(*[c.split()[0] for c in REFS.split(", ")]), f"{top}/store")
    back = writers.read_documents(s, f"{top}/json").select(F.col("project_id").alias("uri"), "value")
    rows = readers.explode_documents(back).select(F.col("uri").alias("project_id"), F.lit(0).alias("file_ord"), "key", "value")
    parsed = rf.parse_refs(rows)
    found = parsed.unionByName(writers.read_store(s, f"{top}/store").select(*parsed.columns)).groupBy("project_id", "var").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), F.countDistinct("path").alias("paths"))
    about = rf.parse_var_meta(rows).select("project_id", "var", F.get("shape", 0).alias("length"), F.array_join("dims", ",").alias("dims"), "dtype")
    return found.join(about, ["project_id", "var"], "left")


def config_defaults(s, d):
    conf = readers.with_defaults(dv.projects(s, d).select("project_id", F.col("base").alias("value")))
    return conf.select("project_id", F.col("conf")["version_no"].alias("version_no"), F.get_json_object(F.col("conf")["override"], "$.file_type").alias("file_type"), F.get_json_object(F.col("conf")["data_properties"], "$.pure_dims").alias("pure_dims"), F.size("conf").alias("keys"))


def virtual_dimension(s, d):
    out = cb.virtual_refs(dv.refs(s, d))
    return out.groupBy("project_id", "var", F.get("coords", 0).alias("file_number")).agg(F.count("*").alias("n"), F.max(F.get("coords", 1)).alias("top"))


def kept_variables(s, d):
    meta = dv.var_meta(s, d).withColumn("dims", F.when(F.col("var") == "RF", F.array(F.lit("NO"))).otherwise(F.col("dims")))
    wanted = meta.where("var = 'RF'").select("project_id", "var")
    return rf.keep_variables(meta, wanted).groupBy("project_id", "var").agg(F.count("*").alias("n"))


def combined_meta(s, d):
    meta = dv.var_meta(s, d)
    places = meta.select("project_id", "file_ord", F.lit("time").alias("dim"), F.col("file_ord").alias("place")).distinct()
    return cb.combined_meta(meta, places).select("project_id", "var", F.get("shape", 0).alias("length"), "dtype", "units")


def _sql(tables: str, select: str) -> str:
    return f"WITH {tables}\n{select}"


_SCAN = """,
pf AS (SELECT project_id, file_ord, sum(size) AS bytes, count(*) AS chunks FROM refs GROUP BY 1, 2),
ps AS (SELECT project_id, avg(chunks) AS avg_cpf, avg(bytes) AS avg_vol, count(*) AS n_files FROM pf GROUP BY 1),
nv AS (SELECT project_id, count(DISTINCT var) AS num_vars FROM refs GROUP BY 1),
sc AS (SELECT project_id, n_files, num_vars, avg_cpf, avg_vol, avg_vol/avg_cpf AS avg_chunk, 180*sqrt(2*num_vars/avg_cpf) AS spatial_res, avg_vol*n_files AS source_bytes, avg_cpf*n_files AS total_chunks,
  167*100/(avg_vol/avg_cpf) AS addition, avg_cpf*n_files*167 AS cloud_bytes, CASE WHEN avg_cpf*n_files*167 > 500e6 OR avg_cpf*n_files > 1e8 THEN 'parq' ELSE 'json' END AS output_type FROM ps JOIN nv USING (project_id))"""


_DETAILS = """,
vs AS (SELECT project_id, '{' || string_agg('"' || var || '":"' || printf('%.1f', n / n_files) || '"', ',' ORDER BY var) || '}' AS variables FROM (SELECT project_id, var, count(*) AS n FROM refs GROUP BY 1, 2) JOIN sc USING (project_id) GROUP BY 1),
dr AS (SELECT project_id, string_agg(DISTINCT CASE WHEN file_ord % 3 = 1 THEN 'hdf5' ELSE 'netcdf3' END, '/' ORDER BY CASE WHEN file_ord % 3 = 1 THEN 'hdf5' ELSE 'netcdf3' END) AS driver FROM files GROUP BY 1)"""


def _bytes_sql(x: str) -> str:
    return f"""CASE WHEN {x} <= 1000 THEN printf('%.2f B', {x}) WHEN {x}/1e3 <= 1000 THEN printf('%.2f KB', {x}/1e3) WHEN {x}/1e6 <= 1000 THEN printf('%.2f MB', {x}/1e6)
  WHEN {x}/1e9 <= 1000 THEN printf('%.2f GB', {x}/1e9) WHEN {x}/1e12 <= 1000 THEN printf('%.2f TB', {x}/1e12) ELSE printf('%.2f PB', {x}/1e15) END"""


_PARTS = """,
fn AS (SELECT *, floor(count(*) OVER (PARTITION BY project_id) / 7) AS size FROM files),
parts AS (SELECT project_id, file_ord, uri, CAST(CASE WHEN size = 0 THEN 6 ELSE least(floor(file_ord / size), 6) END AS INTEGER) AS part FROM fn)"""

_MERGED = """,
nf AS (SELECT project_id, count(DISTINCT file_ord) AS files, min(file_ord) AS first_file FROM attrs GROUP BY 1),
ba AS (SELECT project_id, attr, min(value) AS low, max(value) AS high, arg_min(value, file_ord) AS first, min(file_ord) AS first_ord, count(DISTINCT value) AS versions FROM attrs GROUP BY 1, 2),
merged AS (SELECT project_id, attr,
  CASE WHEN attr = 'time_start' THEN low WHEN attr = 'time_end' THEN high WHEN attr = 'time_duration' THEN first
       WHEN versions <> 1 OR first_ord <> first_file THEN 'See individual files for more details' ELSE first END AS value,
  attr NOT LIKE '%time%' AND (versions <> 1 OR first_ord <> first_file) AS special FROM ba JOIN nf USING (project_id))"""

QUERIES = {f.__name__: f for f in (file_summary, project_scan, output_type, chunks_per_var, scan_sample, file_ranges, first_files, missing_ranges, file_order, chunk_offsets, grid_placement, combined_refs, overlaps, missing_files, refs_per_file, merged_chunks, chunk_consistency, variable_consistency, unit_conflicts, dim_roles, merged_attrs, corrected_attrs, history, links, substitutions, byte_texts, document_round_trip, config_defaults, virtual_dimension, kept_variables, combined_meta)}

SQL = {
    "file_summary": _sql(dv.REFS, "SELECT project_id, file_ord, CAST(sum(size) AS BIGINT) AS bytes, count(*) AS chunks FROM refs GROUP BY 1, 2"),
    "project_scan": _sql(dv.REFS + _SCAN, "SELECT project_id, n_files, num_vars, round(avg_cpf,4) AS avg_cpf, round(avg_vol,4) AS avg_vol, round(avg_chunk,4) AS avg_chunk, round(spatial_res,4) AS spatial_res, round(source_bytes,4) AS source_bytes, round(total_chunks,4) AS total_chunks, round(addition,4) AS addition, round(cloud_bytes,4) AS cloud_bytes, output_type, n_files < 3 AS skipped FROM sc"),
    "output_type": _sql(dv.FILES + _SCAN + _DETAILS, f"SELECT project_id, n_files, {_bytes_sql('source_bytes')} AS source_data, {_bytes_sql('cloud_bytes')} AS cloud_data, printf('%.1f', avg_cpf) AS chunks_per_file, printf('%.2f', total_chunks) AS total_chunks, {_bytes_sql('avg_chunk')} AS estm_chunksize, printf('%.2f deg', spatial_res) AS estm_spatial_res, printf('%.3f', addition) || ' %' AS addition, output_type, variables, driver FROM sc JOIN vs USING (project_id) JOIN dr USING (project_id)"),
    "chunks_per_var": _sql(dv.REFS, "SELECT project_id, var, round(count(*) / any_value(files), 4) AS mean_chunks FROM refs JOIN (SELECT project_id, count(DISTINCT file_ord) AS files FROM refs GROUP BY 1) USING (project_id) GROUP BY 1, 2"),
    "scan_sample": _sql(dv.FILES, "SELECT project_id, file_ord, uri FROM (SELECT *, count(*) OVER (PARTITION BY project_id) AS n, row_number() OVER (PARTITION BY project_id ORDER BY file_ord) AS rank FROM files) WHERE n >= 3 AND rank <= least(100, greatest(2, floor(n / 20)))"),
    "file_ranges": _sql(dv.FILES + _PARTS, "SELECT * FROM parts"),
    "first_files": _sql(dv.FILES, "SELECT * FROM files WHERE file_ord < 3"),
    "missing_ranges": _sql(dv.FILES + _PARTS, "SELECT project_id, CAST(part AS INTEGER) AS part FROM (SELECT DISTINCT project_id FROM files), (SELECT unnest(range(7)) AS part) EXCEPT SELECT project_id, part FROM parts WHERE left(md5(project_id || ':' || part), 1) > '4'"),
    "file_order": _sql(dv.COORDS, "SELECT dataset, uri, CAST(row_number() OVER (PARTITION BY dataset ORDER BY first, uri) - 1 AS INTEGER) AS file_ord, first FROM (SELECT dataset, uri, min(value) AS first FROM coords GROUP BY 1, 2)"),
    "chunk_offsets": _sql(dv.META, "SELECT project_id, file_ord, var, n, CAST(coalesce(sum(n) OVER (PARTITION BY project_id, var ORDER BY file_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM meta"),
    "grid_placement": _sql(dv.FILES + ", g AS (SELECT project_id, file_ord, CAST(regexp_extract(uri, 'f(-?[0-9]+)$', 1) AS INTEGER) AS m FROM files), u AS (SELECT project_id, file_ord, 'year' AS dim, floor(m / 12) AS first FROM g UNION ALL SELECT project_id, file_ord, 'month', ((m % 12) + 12) % 12 FROM g)", "SELECT project_id, file_ord, dim, CAST(dense_rank() OVER (PARTITION BY project_id, dim ORDER BY first) - 1 AS INTEGER) AS place FROM u"),
    "combined_refs": _sql(dv.META + ", o AS (SELECT project_id, file_ord, var, coalesce(sum(n) OVER (PARTITION BY project_id, var ORDER BY file_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM meta)", "SELECT project_id, file_ord, var, CAST(coord + start AS INTEGER) AS coord, path, size FROM refs JOIN o USING (project_id, file_ord, var)"),
    "overlaps": _sql(dv.REFS, "SELECT project_id, var, coord, count(*) AS n FROM refs GROUP BY 1, 2, 3 HAVING count(*) > 1"),
    "missing_files": _sql(dv.FILES, "SELECT project_id, uri FROM files WHERE NOT EXISTS (SELECT 1 FROM refs r WHERE r.project_id = files.project_id AND r.path = files.uri AND r.size > 2000 AND r.var = 'RF')"),
    "refs_per_file": _sql(dv.REFS, "SELECT project_id, path, count(*) AS refs FROM refs GROUP BY 1, 2"),
    "merged_chunks": _sql(
        dv.REFS + """,
one AS (SELECT project_id, var, coord, lpad(CAST(sum(size) AS VARCHAR), 8, '0') AS b FROM refs GROUP BY 1, 2, 3),
cn AS (SELECT project_id, var, count(*) AS n FROM one GROUP BY 1, 2),
cb AS (SELECT project_id, var, max(c) AS comb FROM cn, (SELECT CAST(pow(2, unnest(range(40))) AS BIGINT) AS c) WHERE n % c = 0 AND (c = 1 OR n / (c / 2) > 4) GROUP BY 1, 2)""",
        "SELECT project_id, var, CAST(floor(coord / comb) AS INTEGER) AS coord, string_agg(b, '' ORDER BY one.coord) AS bytes FROM one JOIN cb USING (project_id, var) GROUP BY project_id, var, CAST(floor(coord / comb) AS INTEGER)",
    ),
    "chunk_consistency": _sql(dv.META, "SELECT project_id, var, CAST(0 AS INTEGER) AS axis, count(DISTINCT CASE WHEN ((file_ord % 40) + 40) % 40 = 7 THEN 2 ELSE 1 END) AS shapes, CAST(1 AS INTEGER) AS low, CAST(2 AS INTEGER) AS high FROM meta GROUP BY 1, 2 HAVING shapes > 1"),
    "variable_consistency": _sql(dv.REFS, "SELECT project_id, var, files - count(DISTINCT file_ord) AS missing_files FROM refs JOIN (SELECT project_id, count(DISTINCT file_ord) AS files FROM refs GROUP BY 1) USING (project_id) GROUP BY project_id, var, files HAVING count(DISTINCT file_ord) < files"),
    "unit_conflicts": _sql(dv.META, "SELECT project_id, var, count(DISTINCT units) AS units, count(DISTINCT dtype) AS dtypes FROM meta GROUP BY 1, 2 HAVING count(DISTINCT units) > 1 OR count(DISTINCT dtype) > 1"),
    "dim_roles": _sql(
        dv.META + """,
dm AS (SELECT project_id, CASE WHEN count(DISTINCT p) > 1 THEN 'concat' ELSE 'identical' END AS role FROM (SELECT project_id, file_ord, sum(n) AS p FROM meta GROUP BY 1, 2) GROUP BY 1),
vr AS (SELECT project_id, var, count(DISTINCT n) AS versions FROM meta GROUP BY 1, 2)""",
        "SELECT project_id, 'time' AS name, 'dim' AS kind, role FROM dm UNION ALL SELECT project_id, var, 'var', CASE WHEN var = 'NO' THEN 'scalar' WHEN role = 'concat' THEN 'aggregated' WHEN versions > 1 THEN 'virtual' ELSE 'identical' END FROM vr JOIN dm USING (project_id)",
    ),
    "merged_attrs": _sql(dv.ATTRS.replace("attrs AS (", "attrs0 AS (") + ", attrs AS (SELECT * FROM attrs0 WHERE file_ord % 3 <> 1 OR attr <> 'type')" + _MERGED, "SELECT project_id, attr, value, special FROM merged"),
    "corrected_attrs": _sql(dv.ATTRS + _MERGED + ", ids AS (SELECT DISTINCT project_id, CAST(project_id AS BIGINT) AS k FROM merged)", "SELECT project_id, attr, CASE WHEN attr = 'brand' AND k % 2 = 0 THEN 'own' ELSE value END AS value FROM merged JOIN ids USING (project_id) WHERE NOT (attr = 'type' AND k % 3 = 0) UNION ALL SELECT project_id, 'title', 'untitled' FROM ids"),
    "history": _sql(dv.ATTRS, "SELECT DISTINCT project_id, 'history' AS attr, '010524T123000: version raised' AS value FROM attrs UNION ALL SELECT DISTINCT project_id, 'last_changed', '010524T123000' FROM attrs"),
    "links": _sql(dv.REFS, "SELECT CASE WHEN starts_with(path, '/d1') THEN 'https://data.example.org/d1' || substr(path, 4) ELSE path END AS path, count(*) AS n FROM refs GROUP BY 1"),
    "substitutions": "SELECT page_id, replace(replace(replace(url, 'http://', 'https://'), 'example', 'archive'), '/en/', '/english/') AS url FROM pages",
    "byte_texts": _sql(dv.REFS, f"SELECT project_id, {_bytes_sql('b')} AS text FROM (SELECT project_id, CAST(sum(size) * 997 AS DOUBLE) AS b FROM refs GROUP BY 1)"),
    "document_round_trip": _sql(dv.META, "SELECT project_id, var, count(*) AS n, CAST(sum(size) AS BIGINT) AS bytes, count(DISTINCT path) AS paths, CAST(count(*) AS INTEGER) AS length, 'time' AS dims, arg_min(dtype, file_ord) AS dtype FROM refs JOIN (SELECT project_id, var, file_ord, dtype FROM meta) USING (project_id, var, file_ord) GROUP BY 1, 2"),
    "config_defaults": _sql(dv.PROJECTS, "SELECT project_id, version AS version_no, 'json' AS file_type, 'Unknown' AS pure_dims, 10 AS keys FROM projects"),
    "virtual_dimension": _sql(dv.REFS, "SELECT project_id, var, file_ord AS file_number, count(*) AS n, max(coord) AS top FROM refs GROUP BY 1, 2, 3"),
    "kept_variables": _sql(dv.META, "SELECT project_id, var, count(*) AS n FROM meta WHERE var IN ('RF', 'NO') AND project_id IN (SELECT project_id FROM meta WHERE var = 'RF') GROUP BY 1, 2"),
    "combined_meta": _sql(dv.META, "SELECT project_id, var, CAST(sum(n) AS INTEGER) AS length, arg_min(dtype, file_ord) AS dtype, arg_min(units, file_ord) AS units FROM meta GROUP BY 1, 2"),
}
