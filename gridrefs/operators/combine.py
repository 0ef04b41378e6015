"""Ordering files and uniting their references into one dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import broadcast_if_small, stored


def order_files(coords: DataFrame) -> DataFrame:
    """Order of a dataset's files by the smallest value of the concatenated coordinate (ties by uri): (dataset, uri, file_ord, first)."""
    least = coords.groupBy("dataset", "uri").agg(F.min("value").alias("first"))
    rank = F.row_number().over(Window.partitionBy("dataset").orderBy("first", "uri")) - 1
    return least.select("dataset", "uri", rank.cast("int").alias("file_ord"), "first")


def chunk_counts(meta: DataFrame, axis: int = 0) -> DataFrame:
    """Chunks of each file and variable along an axis: (project_id, file_ord, var, n)."""
    return meta.select("project_id", "file_ord", "var", F.ceil(F.get("shape", axis) / F.get("chunks", axis)).cast("bigint").alias("n"))


def chunk_offsets(counts: DataFrame) -> DataFrame:
    """Start of each file's chunks: the sum over earlier files. Runs over metadata, never over references."""
    before = Window.partitionBy("project_id", "var").orderBy("file_ord").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("bigint"))


def grid_placement(corners: DataFrame) -> DataFrame:
    """Place of each file on an n-dimensional grid from (project_id, file_ord, dim, first): its rank among the distinct values of a dimension."""
    rank = F.dense_rank().over(Window.partitionBy("project_id", "dim").orderBy("first")) - 1
    return corners.select("project_id", "file_ord", "dim", rank.cast("int").alias("place"))


def grid_holes(placed: DataFrame) -> DataFrame:
    """Projects whose files do not fill the grid: cells of the grid and files."""
    sides = placed.groupBy("project_id", "dim").agg((F.max("place") + 1).alias("side"))
    cells = sides.groupBy("project_id").agg(F.round(F.exp(F.sum(F.log("side")))).cast("bigint").alias("cells"))
    files = placed.select("project_id", "file_ord").distinct().groupBy("project_id").agg(F.count("*").alias("files"))
    return cells.join(files, "project_id").where("cells <> files")


def along(offsets: DataFrame, axis: int = 0) -> DataFrame:
    """Offsets of one axis (project_id, file_ord, var, start) as ``starts``, a map from axis to start."""
    return offsets.select("project_id", "file_ord", "var", F.create_map(F.lit(axis), F.col("start").cast("bigint")).alias("starts"), F.lit(True).alias("first"))


def axis_places(meta: DataFrame, places: DataFrame, *more: str) -> DataFrame:
    """Each file's length and chunks along the concatenated dims of its variables, at its place: (project_id, file_ord, var, axis, dim, place, length, n).

    The axis of a dim comes from each variable's own ``dims``. ``places``: project_id, file_ord, dim, place, and ``more`` columns to keep.
    """
    each = meta.select("project_id", "file_ord", "var", "shape", "chunks", F.posexplode("dims").alias("axis", "dim"))
    length = F.get("shape", F.col("axis"))
    sized = each.select("project_id", "file_ord", "var", "axis", "dim", length.alias("length"), F.ceil(length / F.get("chunks", F.col("axis"))).cast("bigint").alias("n"))
    return sized.join(places.select("project_id", "file_ord", "dim", "place", *more), ["project_id", "file_ord", "dim"])


def place_offsets(meta: DataFrame, places: DataFrame) -> DataFrame:
    """Start of each file's chunks on every concatenated axis: (project_id, file_ord, var, starts, first), ``starts`` a map from axis to start.

    Files at one place of a dim share its start: the sum of the chunks at earlier places. A variable
    that lacks some of the concatenated dims is the same in all files at a place; ``first`` marks the
    one that counts.

    Rows are shuffled once, by project and variable, which serves every window and group after it.
    """
    dims = F.size(F.collect_set("dim").over(Window.partitionBy("project_id")))
    at = axis_places(meta, places.withColumn("dims", dims), "dims").select("project_id", "var", "axis", "place", "file_ord", "n", "dims").repartition("project_id", "var")
    here = Window.partitionBy("project_id", "var", "axis", "place")
    sides = at.withColumns({"side": F.max("n").over(here), "one": F.row_number().over(here.orderBy("file_ord")) == 1})
    before = Window.partitionBy("project_id", "var", "axis").orderBy("place").rangeBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.when(F.col("one"), F.col("side"))).over(before), F.lit(0)).cast("bigint")
    each = sides.select("project_id", "var", "file_ord", "dims", F.struct("axis", start.alias("start")).alias("at"))
    rows = each.groupBy("project_id", "var", "file_ord").agg(F.sort_array(F.collect_list("at")).alias("at"), F.first("dims").alias("dims"))
    same = Window.partitionBy("project_id", "var", "at").orderBy("file_ord")
    first = (F.size("at") == F.col("dims")) | (F.row_number().over(same) == 1)
    return rows.select("project_id", "file_ord", "var", F.map_from_entries("at").alias("starts"), first.alias("first"))


def line_offsets(at: DataFrame) -> DataFrame:
    """:func:`place_offsets` from rows of :func:`axis_places`, where projects have one concatenated dim and no variable has it twice: sums over earlier files alone."""
    before = Window.partitionBy("project_id", "var", "axis").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n").over(before), F.lit(0)).cast("bigint")
    return at.select("project_id", "file_ord", "var", F.create_map("axis", start).alias("starts"), F.lit(True).alias("first"))


def shift_refs(refs: DataFrame, offsets: DataFrame, moving: Column | None = None) -> DataFrame:
    """References of aggregated variables with their coordinates shifted by ``starts`` along the axes; only those that are ``moving``, if given.

    The offsets have a row for each file and variable; they are stored once and broadcast if their
    measured size allows, so that references never move. References without an offset stay where
    they are; :func:`unplaced` counts them.
    """
    small = stored(offsets.select("project_id", "file_ord", "var", "starts", "first"), "offsets")
    small = broadcast_if_small(small, F.length("project_id") + F.length("var") + 40 + 16 * F.size("starts"))
    moved = F.when(F.col("starts").isNull(), F.col("coords")).otherwise(F.transform("coords", lambda c, i: c + F.coalesce(F.element_at("starts", i), F.lit(0)).cast("int")))
    placed = refs.join(small, ["project_id", "file_ord", "var"], "left")
    if moving is not None:
        placed = placed.withColumns({"starts": F.when(moving, F.col("starts")), "first": F.when(moving, F.col("first"))})
    return placed.where(F.coalesce("first", F.lit(True))).withColumn("coords", moved).drop("starts", "first")


def unplaced(refs: DataFrame, offsets: DataFrame) -> DataFrame:
    """Variables with references that no offset covers: (project_id, var, refs)."""
    return refs.join(offsets.select("project_id", "file_ord", "var"), ["project_id", "file_ord", "var"], "left_anti").groupBy("project_id", "var").agg(F.count("*").alias("refs"))


def identical_refs(refs: DataFrame, variables: DataFrame) -> DataFrame:
    """References of variables that are the same in all files: those of the first file."""
    first = refs.join(variables.select("project_id", "var").distinct(), ["project_id", "var"], "left_semi")
    least = first.groupBy("project_id", "var").agg(F.min("file_ord").alias("file_ord"))
    return first.join(least, ["project_id", "var", "file_ord"], "left_semi")


def combined_refs(refs: DataFrame, offsets: DataFrame, identical: DataFrame | None = None) -> DataFrame:
    """One dataset's references: shifted ones, and identical variables from the first file."""
    if identical is None:
        return shift_refs(refs, offsets)
    names = identical.select("project_id", "var").distinct()
    moved = shift_refs(refs.join(names, ["project_id", "var"], "left_anti"), offsets)
    return moved.unionByName(identical_refs(refs, identical).select(*moved.columns))


def overlaps(refs: DataFrame) -> DataFrame:
    """Chunk keys that occur more than once in a combined dataset."""
    return refs.groupBy("project_id", "var", "coords").agg(F.count("*").alias("n")).where("n > 1")


def combined_meta(meta: DataFrame, places: DataFrame, at: DataFrame | None = None) -> DataFrame:
    """var_meta of the combined dataset: the first file's, each concatenated axis as long as all places together. ``at``: their :func:`axis_places`, if at hand."""
    whole = meta.groupBy("project_id", "var").agg(F.min_by(F.struct("dims", "shape", "chunks", "dtype", "units", "raw"), "file_ord").alias("m"))
    sides = (axis_places(meta, places) if at is None else at).groupBy("project_id", "var", "axis", "place").agg(F.max("length").alias("length"))
    lengths = sides.groupBy("project_id", "var", "axis").agg(F.sum("length").cast("int").alias("length"))
    lengths = lengths.groupBy("project_id", "var").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("axis", "length")))).alias("lengths"))
    shape = F.when(F.col("lengths").isNull(), F.col("m.shape")).otherwise(F.transform("m.shape", lambda s, i: F.coalesce(F.element_at("lengths", i), s)))
    return whole.join(lengths, ["project_id", "var"], "left").select("project_id", "var", "m.dims", shape.alias("shape"), "m.chunks", "m.dtype", "m.units", "m.raw")


def classify(prints: DataFrame) -> DataFrame:
    """Role of each dimension or variable from (project_id, file_ord, name, kind, dims, print).

    ``print`` is a hash of the content; null marks a pure dimension, one without an array, or a
    variable whose content is not known. Names whose content is the same in all files are identical;
    other dimensions are concatenated, and variables on them aggregated. Without a concatenated
    dimension, variables that differ or are not known get a virtual one.
    """
    # Equal contents are folded first, so that few rows reach the aggregates of texts and arrays, which sort.
    folded = prints.groupBy("project_id", "name", "kind", "print", "dims").agg(F.min("file_ord").alias("file_ord"))
    seen = folded.groupBy("project_id", "name", "kind").agg(F.countDistinct("print").alias("versions"), F.min_by("dims", "file_ord").alias("dims"))
    pure = F.col("versions") == 0
    dims = seen.where("kind = 'dim'").select("project_id", "name", "kind", F.when(pure, "pure").when(F.col("versions") > 1, "concat").otherwise("identical").alias("role"))
    concat = dims.where("role = 'concat'").groupBy("project_id").agg(F.collect_set("name").alias("concat"))
    variables = seen.where("kind = 'var'").join(concat, "project_id", "left")
    role = (
        F.when(F.arrays_overlap("dims", F.coalesce("concat", F.array().cast("array<string>"))), "aggregated")
        .when(F.col("versions") > 1, F.when(F.col("concat").isNull(), "virtual").otherwise("aggregated"))
        .when((F.col("versions") == 0) & F.col("concat").isNull(), "virtual")
        .when(F.size("dims") == 0, "scalar")
        .otherwise("identical")
    )
    return dims.unionByName(variables.select("project_id", "name", "kind", role.alias("role")))


def prints_of(meta: DataFrame, cells: DataFrame) -> DataFrame:
    """Input of :func:`classify`: dimensions and variables of each file with the hash of their cells.

    ``cells``: project_id, file_ord, var, idx, value, of the variables whose content is known. A
    dimension with an array of its name is that array; it is no variable of its own.
    """
    content = content_print(cells, ["project_id", "file_ord", "var"])
    known = meta.select("project_id", "file_ord", "var", "dims").join(content, ["project_id", "file_ord", "var"], "left")
    names = meta.select("project_id", "file_ord", F.explode("dims").alias("var")).distinct()
    dims = names.join(content, ["project_id", "file_ord", "var"], "left").select("project_id", "file_ord", F.col("var").alias("name"), F.lit("dim").alias("kind"), F.array().cast("array<string>").alias("dims"), "print")
    variables = known.join(names, ["project_id", "file_ord", "var"], "left_anti")
    return dims.unionByName(variables.select("project_id", "file_ord", F.col("var").alias("name"), F.lit("var").alias("kind"), "dims", "print"))


def places_of(cells: DataFrame, roles: DataFrame) -> DataFrame:
    """Place of every file on each concatenated dim: (project_id, file_ord, dim, place).

    With one such dim, files are ordered by its smallest value, ties by file; with several, a place
    is the value's rank among the distinct ones, so files fill a grid.
    """
    concat = roles.where("kind = 'dim' and role = 'concat'").select("project_id", F.col("name").alias("var"))
    several = concat.groupBy("project_id").agg((F.count("*") > 1).alias("several"))
    corners = cells.join(concat, ["project_id", "var"], "left_semi").groupBy("project_id", "file_ord", F.col("var").alias("dim")).agg(F.min("value").alias("first"))
    whole = Window.partitionBy("project_id", "dim")
    place = F.when(F.col("several"), F.dense_rank().over(whole.orderBy("first"))).otherwise(F.row_number().over(whole.orderBy("first", "file_ord"))) - 1
    return corners.join(several, "project_id").select("project_id", "file_ord", "dim", place.cast("int").alias("place"))


def content_print(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Order-free content hash of each group of cells: hashes are summed next to the data, only sums move."""
    return cells.groupBy(*keys).agg(F.sum(F.xxhash64("idx", "value").cast("decimal(38,0)")).cast("string").alias("print"))


#: Name of the virtual dimension, and its array and attributes.
FILE_NUMBER = "file_number"
VIRTUAL_ARRAY = '{"chunks":[1],"compressor":null,"dtype":"<i8","fill_value":4611686018427387904,"filters":null,"order":"C","shape":[1],"zarr_format":2}'
VIRTUAL_ATTRS = {"axis": "F", "long_name": FILE_NUMBER, "standard_name": FILE_NUMBER}


def virtual_refs(refs: DataFrame) -> DataFrame:
    """References with the file's number as a first axis, where nothing can be concatenated."""
    return refs.withColumn("coords", F.concat(F.array(F.col("file_ord").cast("int")), F.col("coords")))


def virtual_meta(meta: DataFrame, n_files: DataFrame) -> DataFrame:
    """var_meta of virtual variables (project_id, var, ..) with the file's number as a first dim; ``n_files``: project_id, n_files."""
    rows = meta.join(n_files, "project_id")
    longer = {"dims": F.concat(F.array(F.lit(FILE_NUMBER)), F.col("dims")), "shape": F.concat(F.array(F.col("n_files").cast("int")), F.col("shape")), "chunks": F.concat(F.array(F.lit(1)), F.col("chunks"))}
    return rows.withColumns(longer).drop("n_files")


def virtual_dimension(files: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """References, var_meta and attributes of the virtual dimension itself for (project_id, file_ord): inline 8-byte numbers, 0 to n - 1."""
    digits = F.lpad(F.hex(F.col("file_ord").cast("bigint")), 16, "0")
    little = F.unhex(F.concat(*[F.substring(digits, i, 2) for i in range(15, 0, -2)]))
    none = F.lit(None)
    refs = files.select("project_id", "file_ord", F.lit(FILE_NUMBER).alias("var"), F.array(F.col("file_ord").cast("int")).alias("coords"), none.cast("string").alias("path"), none.cast("bigint").alias("offset"), none.cast("bigint").alias("size"), little.alias("inline"))
    n = files.groupBy("project_id").agg(F.countDistinct("file_ord").cast("int").alias("n"))
    meta = n.select("project_id", F.lit(FILE_NUMBER).alias("var"), F.array(F.lit(FILE_NUMBER)).alias("dims"), F.array("n").alias("shape"), F.array(F.lit(1)).alias("chunks"), F.lit("<i8").alias("dtype"), none.cast("string").alias("units"), F.lit(VIRTUAL_ARRAY).alias("raw"))
    pairs = F.array(*[F.struct(F.lit(k).alias("attr"), F.lit(v).alias("value")) for k, v in VIRTUAL_ATTRS.items()])
    attrs = n.select("project_id", F.lit(FILE_NUMBER).alias("scope"), F.inline(pairs))
    return refs, meta, attrs


def not_monotonic(coords: DataFrame) -> DataFrame:
    """Dimensions (dataset, dim) whose values neither rise nor fall strictly, with the number of values."""
    before = F.lag("value").over(Window.partitionBy("dataset", "dim").orderBy("pos"))
    steps = coords.withColumn("before", before)
    rising, falling = F.col("value") > F.col("before"), F.col("value") < F.col("before")
    first = F.col("before").isNull()
    return steps.groupBy("dataset", "dim").agg(F.bool_and(first | rising).alias("rises"), F.bool_and(first | falling).alias("falls"), F.count("*").alias("n")).where("not rises and not falls")
