"""Parsing, filtering and describing chunk references."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import fixed, format_bytes

#: Keys of chunks: a variable, a slash, and numbers joined by full stops.
CHUNK_KEY = r"^(.+)/(\d+(?:\.\d+)*)$"
#: Fixed value: bytes of one reference, an estimate.
REF_BYTES = 167
#: Bytes of references and numbers of chunks from which a project goes to a Parquet store.
JSON_BYTES, JSON_CHUNKS = 500_000_000, 100_000_000


def parse_refs(rows: DataFrame) -> DataFrame:
    """refs from (project_id, file_ord, key, value as JSON text): chunk rows only."""
    inline = F.startswith(F.col("value"), F.lit("base64:"))
    # A text is parsed once, for all its parts; the numbers stand after the last slash.
    numbers = F.substring_index("key", "/", -1)
    cut = rows.where(F.col("key").rlike(CHUNK_KEY)).select("project_id", "file_ord", "key", "value", numbers.alias("numbers"), F.when(~inline, F.from_json("value", "array<string>")).alias("parts"))
    part = lambda k: F.get("parts", k)
    return cut.select(
        "project_id",
        "file_ord",
        F.left("key", F.length("key") - F.length("numbers") - 1).alias("var"),
        F.split("numbers", r"\.").try_cast("array<int>").alias("coords"),
        part(0).alias("path"),
        part(1).cast("bigint").alias("offset"),
        part(2).cast("bigint").alias("size"),
        F.when(inline, F.unbase64(F.substring("value", 8, 2**31 - 1))).alias("inline"),
    )


def parse_var_meta(rows: DataFrame) -> DataFrame:
    """var_meta from the same rows: each variable's array and attribute documents joined."""
    array = rows.where(F.endswith(F.col("key"), F.lit("/.zarray"))).select("project_id", "file_ord", F.left("key", F.length("key") - 8).alias("var"), F.col("value").alias("raw"))
    attrs = rows.where(F.endswith(F.col("key"), F.lit("/.zattrs"))).select("project_id", "file_ord", F.left("key", F.length("key") - 8).alias("var"), F.col("value").alias("about"))
    # A text is parsed once, for all its parts.
    array = array.withColumn("a", F.from_json("raw", "shape array<int>, chunks array<int>, dtype string"))
    attrs = attrs.select("project_id", "file_ord", "var", F.from_json("about", "_ARRAY_DIMENSIONS array<string>, units string").alias("b"))
    both = array.join(attrs, ["project_id", "file_ord", "var"], "left")
    return both.select("project_id", "file_ord", "var", F.col("b._ARRAY_DIMENSIONS").alias("dims"), "a.shape", "a.chunks", "a.dtype", "b.units", "raw")


def parse_attrs(rows: DataFrame) -> DataFrame:
    """attrs from the same rows: global attributes and those of variables."""
    about = rows.where((F.col("key") == ".zattrs") | F.endswith(F.col("key"), F.lit("/.zattrs")))
    scope = F.when(F.col("key") == ".zattrs", "global").otherwise(F.left("key", F.length("key") - 8))
    return about.select("project_id", "file_ord", scope.alias("scope"), F.explode(F.from_json("value", "map<string,string>")).alias("attr", "value"))


def keep_variables(meta: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of var_meta of wanted (project_id, var) variables and of the dimensions that they use."""
    chosen = meta.join(wanted.select("project_id", "var").distinct(), ["project_id", "var"], "left_semi")
    dims = chosen.select("project_id", F.explode("dims").alias("var")).unionByName(wanted.select("project_id", "var")).distinct()
    return meta.join(dims, ["project_id", "var"], "left_semi")


def relink(refs: DataFrame, old: str, new: str) -> DataFrame:
    """References with a path prefix swapped; inline rows have no path and stay."""
    swapped = F.concat(F.lit(new), F.substring("path", len(old) + 1, 2**31 - 1))
    return refs.withColumn("path", F.when(F.startswith(F.col("path"), F.lit(old)), swapped).otherwise(F.col("path")))


def merge_inline(refs: DataFrame, ideal: int = 1000) -> DataFrame:
    """Join neighbouring inline chunks of one-dimensional variables into at most ``ideal`` groups or so.

    The group size doubles while more than ``ideal`` groups remain and it divides the number of chunks.
    """
    one = refs.where(F.col("inline").isNotNull() & (F.size("coords") == 1)).withColumn("at", F.get("coords", 0))
    n = one.groupBy("project_id", "var").agg(F.count("*").alias("n"))
    # Powers of two that divide n and were reached while n / previous power > ideal.
    powers = F.filter(F.transform(F.sequence(F.lit(0), F.lit(40)), lambda k: F.pow(F.lit(2), k).cast("bigint")), lambda c: (F.col("n") % c == 0) & ((c == 1) | (F.col("n") / (c / 2) > ideal)))
    size = n.select("project_id", "var", F.array_max(powers).alias("comb"))
    grouped = one.join(size, ["project_id", "var"]).withColumn("group", F.floor(F.col("at") / F.col("comb")).cast("int"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("at", F.hex("inline").alias("h")))), lambda x: x["h"])
    return grouped.groupBy("project_id", "var", "group").agg(F.unhex(F.array_join(parts, "")).alias("inline")).select("project_id", "var", F.array("group").alias("coords"), "inline")


def merged_chunk_lengths(meta: DataFrame, merged: DataFrame) -> DataFrame:
    """var_meta whose merged variables (project_id, var, with a row a group) have chunks as long as a group."""
    groups = merged.groupBy("project_id", "var").agg(F.count("*").alias("groups"))
    chunks = F.when(F.col("groups").isNull(), F.col("chunks")).otherwise(F.array(F.ceil(F.get("shape", 0) / F.col("groups")).cast("int")))
    return meta.join(groups, ["project_id", "var"], "left").withColumn("chunks", chunks).drop("groups")


def variable_summary(refs: DataFrame) -> DataFrame:
    """Bytes and chunks of each file and variable: what every number of a scan is rolled up from."""
    return refs.groupBy("project_id", "file_ord", "var").agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count("*").alias("chunks"))


def file_summary(refs: DataFrame) -> DataFrame:
    """Bytes and chunks of each file; inline chunks count but add no bytes."""
    return refs.groupBy("project_id", "file_ord").agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count("*").alias("chunks"))


def chunks_per_variable(refs: DataFrame) -> DataFrame:
    """Mean number of chunks a file for each variable, over the files of the project."""
    return variables_of(refs).select("project_id", "var", (F.col("chunks") / F.col("files")).alias("mean_chunks"))


def variables_of(refs: DataFrame) -> DataFrame:
    """(project_id, var, chunks, having, files): chunks of each variable, files with it, and all files of its project.

    References are grouped once; the count of a project's files comes from the number of files that
    first occur with each variable.
    """
    by_var = variable_summary(refs)
    first = by_var.withColumn("starts", (F.col("var") == F.min("var").over(Window.partitionBy("project_id", "file_ord"))).cast("long"))
    sums = first.groupBy("project_id", "var").agg(F.sum("chunks").alias("chunks"), F.count("*").alias("having"), F.sum("starts").alias("starts"))
    return sums.select("project_id", "var", "chunks", "having", F.sum("starts").over(Window.partitionBy("project_id")).alias("files"))


def project_scan(refs: DataFrame, n_files: DataFrame | None = None, override: str | None = None) -> DataFrame:
    """Numbers of each project: means, sizes, estimated references and the output type.

    ``n_files`` (project_id, n_files) counts all files where ``refs`` covers a sample of them.
    References are grouped once, by file and variable; the rest is rolled up.
    """
    by_var = variable_summary(refs)
    per_file = by_var.groupBy("project_id", "file_ord").agg(F.sum("bytes").alias("bytes"), F.sum("chunks").alias("chunks"), F.collect_set("var").alias("vars"))
    rows = per_file.groupBy("project_id").agg(F.avg("chunks").alias("avg_cpf"), F.avg("bytes").alias("avg_vol"), F.count("*").alias("seen"), F.size(F.array_distinct(F.flatten(F.collect_set("vars")))).cast("long").alias("num_vars"))
    rows = rows.join(n_files, "project_id", "left").withColumn("n_files", F.coalesce("n_files", "seen")) if n_files is not None else rows.withColumn("n_files", F.col("seen"))
    positive = lambda c: F.when(F.col(c) > 0, F.col(c))
    rows = rows.withColumn("avg_chunk", F.col("avg_vol") / positive("avg_cpf"))
    rows = rows.withColumns(
        {
            "spatial_res": 180 * F.sqrt(2 * F.col("num_vars") / positive("avg_cpf")),
            "source_bytes": F.col("avg_vol") * F.col("n_files"),
            "total_chunks": F.col("avg_cpf") * F.col("n_files"),
            "addition": REF_BYTES * 100 / positive("avg_chunk"),
            "cloud_bytes": F.col("avg_cpf") * F.col("n_files") * REF_BYTES,
            "skipped": F.col("n_files") < 3,
        }
    )
    chosen = F.when((F.col("cloud_bytes") > JSON_BYTES) | (F.col("total_chunks") > JSON_CHUNKS), "parq").otherwise("json")
    return rows.withColumn("output_type", F.lit(override) if override else chosen).drop("seen")


def scan_details(scan: DataFrame, variables: DataFrame | None = None, drivers: DataFrame | None = None) -> DataFrame:
    """The record of a scan with formatted fields.

    ``variables`` (project_id, var, mean_chunks) adds ``variables``, a map to chunks a file;
    ``drivers`` (project_id, driver) adds the distinct ones, joined by slashes.
    """
    out = scan.select(
        "project_id",
        "n_files",
        format_bytes(F.col("source_bytes")).alias("source_data"),
        format_bytes(F.col("cloud_bytes")).alias("cloud_data"),
        fixed(F.col("avg_cpf"), 1).alias("chunks_per_file"),
        fixed(F.col("total_chunks"), 2).alias("total_chunks"),
        format_bytes(F.col("avg_chunk")).alias("estm_chunksize"),
        F.concat(fixed(F.col("spatial_res"), 2), F.lit(" deg")).alias("estm_spatial_res"),
        F.concat(fixed(F.col("addition"), 3), F.lit(" %")).alias("addition"),
        "output_type",
    )
    if variables is not None:
        each = F.map_from_entries(F.array_sort(F.collect_list(F.struct("var", fixed(F.col("mean_chunks"), 1).alias("chunks")))))
        out = out.join(variables.groupBy("project_id").agg(each.alias("variables")), "project_id", "left")
    if drivers is not None:
        out = out.join(drivers.groupBy("project_id").agg(F.concat_ws("/", F.array_sort(F.collect_set("driver"))).alias("driver")), "project_id", "left")
    return out


def inconsistent_variables(refs: DataFrame) -> DataFrame:
    """Variables that some files of their project lack: missing files by variable."""
    return variables_of(refs).where("having < files").select("project_id", "var", (F.col("files") - F.col("having")).alias("missing_files"))


def inconsistent_chunks(meta: DataFrame) -> DataFrame:
    """Variables whose chunk shape differs between files, by dimension: the number of shapes, the smallest and the largest."""
    each = meta.select("project_id", "var", F.posexplode("chunks").alias("axis", "chunk"))
    return each.groupBy("project_id", "var", "axis").agg(F.countDistinct("chunk").alias("shapes"), F.min("chunk").alias("low"), F.max("chunk").alias("high")).where("shapes > 1")


def conflicting_units(meta: DataFrame) -> DataFrame:
    """Variables whose units or dtype differ between files; a missing one counts as a value."""
    named = lambda c: F.countDistinct(F.coalesce(c, F.lit("")))
    return meta.groupBy("project_id", "var").agg(named("units").alias("units"), named("dtype").alias("dtypes")).where("units > 1 or dtypes > 1")


def refs_per_file(refs: DataFrame) -> DataFrame:
    """References to each source file."""
    return refs.where("path is not null").groupBy("project_id", "path").agg(F.count("*").alias("refs"))


def missing_files(files: DataFrame, refs: DataFrame) -> DataFrame:
    """Source files (project_id, uri) that the references never name."""
    return files.join(refs.select("project_id", F.col("path").alias("uri")).distinct(), ["project_id", "uri"], "left_anti")


def sample_files(files: DataFrame) -> DataFrame:
    """First files of each project: a twentieth of them, at least 2 and at most 100; projects with fewer than 3 are skipped."""
    n = F.count("*").over(Window.partitionBy("project_id"))
    rank = F.row_number().over(Window.partitionBy("project_id").orderBy("file_ord"))
    limit = F.least(F.lit(100), F.greatest(F.lit(2), F.floor(F.col("n") / 20)))
    return files.withColumns({"n": n, "rank": rank}).where((F.col("n") >= 3) & (F.col("rank") <= limit)).drop("n", "rank")


def file_ranges(files: DataFrame, total: int) -> DataFrame:
    """Each file's range when a project's list is cut in ``total``; the last takes the rest."""
    n = F.count("*").over(Window.partitionBy("project_id"))
    size = F.floor(n / total)
    return files.withColumn("part", F.when(size == 0, total - 1).otherwise(F.least(F.floor(F.col("file_ord") / size), F.lit(total - 1))).cast("int"))


def missing_ranges(done: DataFrame, totals: DataFrame) -> DataFrame:
    """(project_id, part) of the ``total`` ranges of each project that have no cache."""
    wanted = totals.select("project_id", F.explode(F.sequence(F.lit(0), F.col("total") - 1)).alias("part"))
    return wanted.join(done.select("project_id", "part"), ["project_id", "part"], "left_anti")


def first_files(files: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` files of each project."""
    return files.where(F.col("file_ord") < limit)
