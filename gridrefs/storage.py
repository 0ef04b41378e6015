"""Tables and files in the folder that driver and executors share.

Everything that has to outlive a task is written below the folder that the cluster names in
``spark.checkpoint.dir``. Only in local mode, where the setting may be unset, is a folder made here.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A join side of at most so many bytes, as estimated from its stored rows, is broadcast.
BROADCAST_BYTES = 8 << 20
#: Bytes that a short row takes in a broadcast table, about.
ROW_BYTES = 160


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new, unique folder path (not yet created) in the shared checkpoint folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="gridrefs-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{_run_folder(spark, base)}/{name}-{uuid.uuid4().hex[:16]}"


def _run_folder(spark: SparkSession, base: str) -> str:
    return f"{base.rstrip('/')}/gridrefs/{spark.sparkContext.applicationId}"


def delete_all(spark: SparkSession) -> None:
    """Delete whatever was stored for this application, once its results are written elsewhere."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        delete(spark, _run_folder(spark, base))


#: Setting of the bytes of an Arrow batch.
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def stored(df: DataFrame, name: str, batch_bytes: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends here.

    ``batch_bytes`` bounds Arrow batches during this write, where Python tasks hold whole texts; the
    session's own setting holds before and after.
    """
    spark = df.sparkSession
    path, before = shared_folder(spark, name), spark.conf.get(_BATCH)
    if batch_bytes is not None:
        spark.conf.set(_BATCH, str(batch_bytes))
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_BATCH, before)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._stored_at = path
    return back


def drop(*frames: DataFrame) -> None:
    """Delete the files of frames made by :func:`stored` that nothing reads any more."""
    for df in frames:
        delete(df.sparkSession, df._stored_at)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path of the shared file system, or one that fits a glob, exists."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system, from the driver."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def shuffled_if_large(df: DataFrame) -> DataFrame:
    """A stored frame of short rows, with a hint against broadcasts where its counted rows are many: its files are far smaller than its rows in memory, and Spark goes by the files."""
    return df if df.count() * ROW_BYTES <= 2 * BROADCAST_BYTES else df.hint("merge")


def broadcast_if_small(df: DataFrame, weight: Column, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint for a stored frame whose rows' bytes, by ``weight``, add up to at most the limit; a hint against it for others."""
    size = df.agg(F.sum(weight).alias("bytes")).first()["bytes"] or 0
    return F.broadcast(df) if size <= limit else df.hint("merge")
