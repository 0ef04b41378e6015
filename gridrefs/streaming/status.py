"""Latest status of each project, kept up to date from a stream of appended log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.status import cancel_stale, last_status
from ..schemas import STATUS_LOG


def read_log_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """Stream of status lines from Parquet files that appear under a path."""
    return spark.readStream.schema(STATUS_LOG).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def latest_stream(lines: DataFrame) -> DataFrame:
    """Streaming last status; state is one row a project. Output mode update or complete."""
    return last_status(lines)


def follow(lines: DataFrame, checkpoint: str, path: str):
    """Keep the last status of each project below a path by ``foreachBatch``; read it with :func:`current` or :func:`followed`.

    Each batch writes the changed projects' rows to a folder of its own, named by the batch, so that a
    repeated batch replaces what its failed attempt left and no other row is touched.
    """

    def append(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return latest_stream(lines).writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(append).start()


def followed(spark: SparkSession, path: str) -> DataFrame:
    """The last status of each project: that of its latest batch."""
    rows = spark.read.option("basePath", path).parquet(path)
    last = F.max_by(F.struct("phase", "status", "ts", "job_id"), "epoch")
    return rows.groupBy("group_id", "project_id").agg(last.alias("s")).select("group_id", "project_id", "s.phase", "s.status", "s.ts", "s.job_id")


def compact(spark: SparkSession, path: str, target: str) -> None:
    """Write the followed statuses as one batch below another path, once a stream has left many."""
    followed(spark, path).write.parquet(f"{target}/epoch=-1")


def current(spark: SparkSession, path: str) -> DataFrame:
    """The followed statuses, with projects that pend for over a day as cancelled."""
    return cancel_stale(followed(spark, path), F.current_timestamp())
