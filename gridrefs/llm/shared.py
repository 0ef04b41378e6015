"""File-system and join helpers of the training-data operators.

Tables and files are stored by ``gridrefs.storage``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import delete, delete_all, drop, shared_folder, stored  # noqa: F401

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: A word of the operators' contracts, for Java's and DuckDB's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of an Arrow batch of texts that Python tasks get.
TEXT_BATCH = 4 << 20

#: A join side of at most so many narrow rows is broadcast.
BROADCAST_ROWS = 200_000


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """pyarrow's file system and path of a Spark-style URI (``file:/x``, ``s3a://..``)."""
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri.removeprefix("file:")
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def by_bytes(batches: Iterator[pa.RecordBatch], column: int, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut into runs of whole rows that hold about ``limit`` bytes of a text column, so that a task's memory is bounded."""
    for batch in batches:
        run = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(batch)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                yield batch.slice(a, b - a)
    pa.default_memory_pool().release_unused()


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of words in a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it (lambdas too)."""
    return F.get(F.transform(F.array(value), body), 0)


def join_unique(rows: DataFrame, groups: DataFrame, on: list[str], size: str, total: int) -> DataFrame:
    """Join ``rows`` to ``groups``, which has one row for each key with its number of rows in ``size``.

    Keys that hold over a thousandth of all rows are at most a thousand, so they are broadcast
    and their rows never shuffle; the rest cannot be skewed and is joined by a shuffle.
    """
    cut = max(1000, total // 1000)
    hot = F.broadcast(groups.where(F.col(size) > cut))
    rest = groups.where(F.col(size) <= cut)
    return rows.join(hot, on).unionByName(rows.join(hot.select(*on), on, "left_anti").join(rest, on))


def hash_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """At most ``n`` rows of distinct keys, those of the smallest hashes; the same at each run.

    Of rows with one key the smallest counts. A cut of the hash that four times as many keys should
    pass comes first, so that few rows are grouped and ordered, however large the table and however
    often a key repeats; should too few pass it, the cut is widened.
    """
    hashed = F.xxhash64(key)
    keys = df.agg(F.approx_count_distinct(key).alias("n")).first()["n"]
    share = min(1.0, 4 * n / max(1, keys))
    while True:
        few = df if share == 1.0 else df.where(hashed < int(-(1 << 63) + share * ((1 << 64) - 1)))
        first = few.groupBy(key).agg(F.min(F.struct(*[c for c in df.columns if c != key])).alias("row")).select(key, "row.*") if len(df.columns) > 1 else few.distinct()
        out = first.select(*df.columns).orderBy(hashed, key).limit(n)
        if share == 1.0 or out.count() == n:
            return out
        share = min(1.0, 8 * share)


def is_small(df: DataFrame, limit: int | None = None, weight: Column | None = None) -> bool:
    """Whether a frame (already stored, so cheap to measure) may be broadcast: at most ``limit`` narrow rows.

    ``weight`` counts the values of a row whose width varies; their sum is then held to the limit.
    """
    limit = BROADCAST_ROWS if limit is None else limit
    if weight is None:
        return df.limit(limit + 1).count() <= limit
    return (df.agg(F.sum(weight).alias("w")).first()["w"] or 0) <= limit


def maybe_broadcast(df: DataFrame, limit: int | None = None, weight: Column | None = None) -> DataFrame:
    """Broadcast hint for a frame that :func:`is_small`; a hint against it for others, as Spark goes by the bytes of their compressed files."""
    return F.broadcast(df) if is_small(df, limit, weight) else df.hint("merge")


def without(docs: DataFrame, keys: list[Column], gone: DataFrame) -> DataFrame:
    """``docs`` whose keys are not among the rows of ``gone`` (a null equals a null); those are broadcast if they are counted to be few."""
    names = [f"__gone_{k}" for k in range(len(keys))]
    ids = stored(gone.toDF(*names).distinct(), "gone")
    same = [k.eqNullSafe(F.col(c)) for k, c in zip(keys, names, strict=True)]
    return docs.join(maybe_broadcast(ids), reduce(lambda a, b: a & b, same), "left_anti")
