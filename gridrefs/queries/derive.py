"""Domain tables derived from the driver's tables, in Spark and as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import on_workers
from ..operators.refs import parse_refs

#: Fixed mapping of event types to statuses.
STATUSES = {"purchase": "Success", "view": "Pending", "click": "Fatal-data_errors", "signup": "Warn-history_not_equal", "error": "Failed-ValueError"}
PHASES = ("init", "scan", "compute", "validate")


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A driver table."""
    on_workers(spark)
    return spark.read.parquet(f"{d}/{name}.parquet")


def _lines(spark: SparkSession, d: str, *more: str) -> DataFrame:
    """Chunks: a project a supplier, a file a month, a variable a flag and status."""
    return table(spark, d, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("project_id"),
        ((F.year("l_shipdate") - 1995) * 12 + F.month("l_shipdate") - 1).cast("int").alias("file_ord"),
        F.concat("l_returnflag", "l_linestatus").alias("var"),
        (F.col("l_quantity") * 100).cast("bigint").alias("size"),
        *more,
    )


def raw_refs(spark: SparkSession, d: str) -> DataFrame:
    """Reference rows (project_id, file_ord, key, value)."""
    rows = _lines(spark, d, "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
    order = Window.partitionBy("project_id", "file_ord", "var").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
    rows = rows.withColumn("coord", F.row_number().over(order) - 1)
    text = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    value = F.concat(F.lit('["/d'), text(F.col("project_id")), F.lit("/f"), text(F.col("file_ord")), F.lit('",'), (F.col("coord") * 1000).cast("string"), F.lit(","), text(F.col("size")), F.lit("]"))
    return rows.select("project_id", "file_ord", F.concat_ws("/", "var", F.col("coord").cast("string")).alias("key"), value.alias("value"))


def refs(spark: SparkSession, d: str) -> DataFrame:
    """Parsed references."""
    return parse_refs(raw_refs(spark, d))


REFS = """
r0 AS (SELECT CAST(l_suppkey AS VARCHAR) AS project_id, CAST((year(l_shipdate)-1995)*12+month(l_shipdate)-1 AS INTEGER) AS file_ord, l_returnflag||l_linestatus AS var,
  CAST(l_quantity*100 AS BIGINT) AS size, l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity FROM lineitem),
refs AS (SELECT project_id, file_ord, var, size, '/d'||project_id||'/f'||file_ord AS path,
  CAST(row_number() OVER (PARTITION BY project_id, file_ord, var ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity)-1 AS INTEGER) AS coord FROM r0)"""


def files(spark: SparkSession, d: str) -> DataFrame:
    """Files (project_id, file_ord, uri), numbered from 0."""
    named = table(spark, d, "lineitem").select(F.col("l_suppkey").cast("string").alias("project_id"), ((F.year("l_shipdate") - 1995) * 12 + F.month("l_shipdate") - 1).cast("int").alias("month")).distinct()
    rank = F.row_number().over(Window.partitionBy("project_id").orderBy("month")) - 1
    return named.select("project_id", rank.cast("int").alias("file_ord"), F.format_string("/d%s/f%d", "project_id", "month").alias("uri"))


FILES = (
    REFS
    + """,
files AS (SELECT project_id, CAST(row_number() OVER (PARTITION BY project_id ORDER BY file_ord)-1 AS INTEGER) AS file_ord, '/d'||project_id||'/f'||file_ord AS uri
  FROM (SELECT DISTINCT project_id, file_ord FROM refs))"""
)


def var_meta(spark: SparkSession, d: str) -> DataFrame:
    """Metadata of each file's variables: one dimension, a chunk a value. It comes from the table's rows, so references are not made and parsed for it."""
    n = _lines(spark, d).where("var <> ''").groupBy("project_id", "file_ord", "var").agg(F.count("*").cast("int").alias("n"), F.max("size").alias("top"))
    return n.select(
        "project_id",
        "file_ord",
        "var",
        F.array(F.lit("time")).alias("dims"),
        F.array("n").alias("shape"),
        F.array(F.lit(1)).alias("chunks"),
        F.when(F.col("top") == 5000, "<f4").otherwise("<f8").alias("dtype"),
        F.when(F.pmod("file_ord", F.lit(40)) == 7, "K").otherwise("C").alias("units"),
        F.lit("").alias("raw"),
    )


META = (
    REFS
    + """,
meta AS (SELECT project_id, file_ord, var, count(*) AS n, CASE WHEN max(size) = 5000 THEN '<f4' ELSE '<f8' END AS dtype,
  CASE WHEN ((file_ord % 40) + 40) % 40 = 7 THEN 'K' ELSE 'C' END AS units FROM refs GROUP BY 1, 2, 3)"""
)


def coords(spark: SparkSession, d: str) -> DataFrame:
    """Values of a time dimension of 50 datasets, in files."""
    rows = table(spark, d, "orders").select((F.col("o_custkey") % 50).cast("string").alias("dataset"), F.concat(F.lit("/c"), F.col("o_orderkey") % 37).alias("uri"), F.lit("time").alias("dim"), F.unix_date(F.to_date("o_orderdate")).cast("double").alias("value"), "o_orderkey")
    pos = F.row_number().over(Window.partitionBy("dataset").orderBy("value", "o_orderkey")) - 1
    return rows.withColumn("pos", pos.cast("int"))


COORDS = """
c0 AS (SELECT CAST(o_custkey % 50 AS VARCHAR) AS dataset, '/c'||(o_orderkey % 37) AS uri, CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) AS value, o_orderkey FROM orders),
coords AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY value, o_orderkey) - 1 AS pos FROM c0)"""


def cells(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Test and control cells: control differs by a twentieth at some keys, and both miss others."""
    rows = table(spark, d, "orders").select((F.col("o_custkey") % 50).cast("string").alias("dataset"), F.lit("price").alias("var"), F.array(F.col("o_orderkey").cast("int")).alias("idx"), "o_orderkey", "o_totalprice")
    nan = F.col("o_orderkey") % 89 == 0
    test = F.when(nan, float("nan")).otherwise(F.col("o_totalprice"))
    control = F.when(nan, float("nan")).when(F.col("o_orderkey") % 97 == 0, F.col("o_totalprice") * 1.05).otherwise(F.col("o_totalprice"))
    return rows.select("dataset", "var", "idx", test.alias("value")), rows.select("dataset", "var", "idx", control.alias("value"))


CELLS = """
pairs AS (SELECT CAST(o_custkey % 50 AS VARCHAR) AS dataset, 'price' AS var, o_orderkey AS k,
  CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE o_totalprice END AS test,
  CASE WHEN o_orderkey % 89 = 0 THEN NULL WHEN o_orderkey % 97 = 0 THEN o_totalprice * 1.05 ELSE o_totalprice END AS control FROM orders),
stats AS (SELECT dataset, var, count(*) AS n, avg(test) AS mean_test, min(test) AS min_test, max(test) AS max_test, avg(control) AS mean_control, min(control) AS min_control, max(control) AS max_control, abs(avg(test))/1000 AS atol FROM pairs GROUP BY 1, 2)"""


def attrs(spark: SparkSession, d: str) -> DataFrame:
    """Global attributes of files, from parts."""
    rows = table(spark, d, "part").select(
        F.col("p_size").cast("string").alias("project_id"),
        F.col("p_partkey").cast("int").alias("file_ord"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("type"),
        F.lpad((F.col("p_partkey") % 1000).cast("string"), 6, "0").alias("time_start"),
        F.lpad((F.col("p_partkey") % 1000 + 7).cast("string"), 6, "0").alias("time_end"),
        F.when(F.col("p_partkey") % 2 == 0, "P1D").otherwise("P2D").alias("time_duration"),
        F.lit("DW-0.1").alias("Conventions"),
    )
    names = ["brand", "type", "time_start", "time_end", "time_duration", "Conventions"]
    return rows.unpivot(["project_id", "file_ord"], names, "attr", "value").withColumn("scope", F.lit("global"))


ATTRS = """
p0 AS (SELECT CAST(p_size AS VARCHAR) AS project_id, CAST(p_partkey AS INTEGER) AS file_ord, p_brand, p_type, p_partkey FROM part),
attrs AS (SELECT project_id, file_ord, 'brand' AS attr, p_brand AS value FROM p0 UNION ALL SELECT project_id, file_ord, 'type', p_type FROM p0
 UNION ALL SELECT project_id, file_ord, 'time_start', lpad(CAST(p_partkey % 1000 AS VARCHAR), 6, '0') FROM p0
 UNION ALL SELECT project_id, file_ord, 'time_end', lpad(CAST(p_partkey % 1000 + 7 AS VARCHAR), 6, '0') FROM p0
 UNION ALL SELECT project_id, file_ord, 'time_duration', CASE WHEN p_partkey % 2 = 0 THEN 'P1D' ELSE 'P2D' END FROM p0
 UNION ALL SELECT project_id, file_ord, 'Conventions', 'DW-0.1' FROM p0)"""


def status_log(spark: SparkSession, d: str) -> DataFrame:
    """Status lines from events."""
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    status = F.create_map(*[F.lit(x) for kv in STATUSES.items() for x in kv])
    return table(spark, d, "events").select(
        (F.col("user_id") % 5).cast("string").alias("group_id"),
        F.col("user_id").cast("string").alias("project_id"),
        F.col("event_id").cast("bigint").alias("line_no"),
        F.get(F.array(*[F.lit(p) for p in PHASES]), k % 4).alias("phase"),
        F.element_at(status, F.col("event_type")).alias("status"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.lit("").alias("job_id"),
    )


LOG = """
log AS (SELECT CAST(user_id % 5 AS VARCHAR) AS group_id, CAST(user_id AS VARCHAR) AS project_id, CAST(event_id AS BIGINT) AS line_no,
  CASE CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) % 4 WHEN 0 THEN 'init' WHEN 1 THEN 'scan' WHEN 2 THEN 'compute' ELSE 'validate' END AS phase,
  CASE event_type WHEN 'purchase' THEN 'Success' WHEN 'view' THEN 'Pending' WHEN 'click' THEN 'Fatal-data_errors' WHEN 'signup' THEN 'Warn-history_not_equal' WHEN 'error' THEN 'Failed-ValueError' END AS status, ts FROM events),
last AS (SELECT group_id, project_id, phase, status, ts FROM (SELECT *, row_number() OVER (PARTITION BY group_id, project_id ORDER BY line_no DESC) AS rn FROM log) WHERE rn = 1)"""


def projects(spark: SparkSession, d: str) -> DataFrame:
    """Projects from suppliers, groups from nations, with JSON configs."""
    s, n = table(spark, d, "supplier"), table(spark, d, "nation")
    rows = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey)
    key, zarr = F.col("s_suppkey"), F.col("s_suppkey") % 3 == 0
    return rows.select(
        F.col("n_name").alias("group_id"),
        key.cast("string").alias("project_id"),
        (key % 100 + 1).cast("int").alias("num_files"),
        (key * 10).cast("bigint").alias("total_chunks"),
        F.when(zarr, "zarr").otherwise("kerchunk").alias("cloud_format"),
        (key % 2 == 0).alias("remote"),
        F.concat(F.lit("1."), (key % 7).cast("string")).alias("version"),
        F.concat((key % 900 + 1).cast("string"), F.lit(".50 GB")).alias("source_data"),
        F.concat((key % 90 + 1).cast("string"), F.lit(".25 MB")).alias("cloud_data"),
        (key % 11 == 0).alias("skipped"),
        F.concat(F.lit("s3://store/"), key.cast("string")).alias("href"),
        F.format_string('{"version_no":"1.%d","pattern":"/p%d"}', key % 7, key).alias("base"),
        F.when(key % 4 == 0, F.format_string('{"version_no":"2.%d"}', key % 7)).otherwise("{}").alias("detail"),
    )


PROJECTS = """
projects AS (SELECT n_name AS group_id, CAST(s_suppkey AS VARCHAR) AS project_id, s_suppkey AS k, CAST(s_suppkey % 100 + 1 AS INTEGER) AS num_files, CAST(s_suppkey * 10 AS BIGINT) AS total_chunks,
  CASE WHEN s_suppkey % 3 = 0 THEN 'zarr' ELSE 'kerchunk' END AS cloud_format, s_suppkey % 2 = 0 AS remote, '1.' || (s_suppkey % 7) AS version, s_suppkey % 11 = 0 AS skipped
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""


def project_sets(spark: SparkSession, d: str) -> DataFrame:
    """Main sets and a subset ``small`` of every group."""
    rows = projects(spark, d).select("group_id", "project_id", F.col("project_id").cast("bigint").alias("k"))
    pos = F.row_number().over(Window.partitionBy("group_id").orderBy("k")) - 1
    main = rows.withColumn("pos", pos.cast("int"))
    small = main.where("k % 5 = 0").withColumn("pos", (F.row_number().over(Window.partitionBy("group_id").orderBy("k")) - 1).cast("int"))
    pick = lambda f, name: f.select("group_id", F.lit(name).alias("set_id"), "project_id", "pos")
    return pick(main, "main").unionByName(pick(small, "small"))


SETS = (
    PROJECTS
    + """,
sets AS (SELECT group_id, 'main' AS set_id, project_id, k, CAST(row_number() OVER (PARTITION BY group_id ORDER BY k) - 1 AS INTEGER) AS pos FROM projects
 UNION ALL SELECT group_id, 'small', project_id, k, CAST(row_number() OVER (PARTITION BY group_id ORDER BY k) - 1 AS INTEGER) FROM projects WHERE k % 5 = 0)"""
)
