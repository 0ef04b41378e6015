"""Exact deduplication through an extendible-hash index on shared files.

Keys are 64-bit hashes of the normalised text. The directory maps key prefixes to buckets: it
starts with as many prefix bits as the corpus suggests and doubles while a bucket is overfull,
splitting only the overfull ones, so buckets have local depths. Bucket sizes are counts of
distinct texts' bytes, so copies never overfill a bucket. Each bucket, a contiguous key range,
has one owner task. Before texts move, every task folds its rows to their distinct texts; texts
whose key over a thousandth of all rows share are dealt out by salt and folded once more, so their
owner gets a bounded number of copies. The owner reads its range in key order, chains entries of
equal key, compares their bytes, and appends each distinct text to its bucket's file: hash, count,
kept id, chain position and the compressed text.

The groups are then read back from the bucket files, one row a distinct text with its key and
SHA-256, and joined to the documents by both; the bytes have decided the groups, and a file with
one SHA-256 for two texts would raise.

Cases: null text counts as empty and equals empty texts; repeated rows are members like any
others (all rows with the kept id are kept); ids are integers or texts, ordered as their type is;
a null id is never kept unless all of a group are null; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import TEXT_BATCH, by_bytes, drop, join_unique, lower_ascii, open_fs, shared_folder, stored

#: Bytes of distinct texts a bucket should hold at most; raised so that there are at most 2^15 buckets.
BUCKET_BYTES = 32 << 20
MAX_DEPTH = 20
#: Bytes of distinct texts that a task holds to fold its rows.
FOLD_BYTES = 16 << 20
#: Tasks that fold the copies of one frequent text before its owner gets them.
SALTS = 64
ENTRY = "<QQiII"  # key, rows, bytes of the kept id (-1: null), chain position, bytes of the packed text


@dataclass(frozen=True)
class Directory:
    """Buckets as (prefix, local depth), in key order; 2 ** depth entries point to them."""

    depth: int
    buckets: tuple[tuple[int, int], ...]

    def entries(self) -> list[tuple[int, int]]:
        """(entry, bucket number) of every directory entry."""
        return [(e, n) for n, (prefix, d) in enumerate(self.buckets) for e in range(prefix << (self.depth - d), (prefix + 1) << (self.depth - d))]


def prefix(key, depth: int):
    """The first ``depth`` bits of a key column."""
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def build_directory(keys: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> Directory:
    """Directory over a (key, bytes) table of distinct keys.

    Only sums of open buckets come to the driver: at most twice the number of buckets, which
    ``bucket_bytes`` keeps at 2^15 or so.
    """
    total = keys.agg(F.sum("bytes").alias("b")).first()["b"] or 0
    bucket_bytes = max(bucket_bytes, total >> 15)
    depth = min(MAX_DEPTH, max(0, (-(-total // bucket_bytes) - 1).bit_length()))
    leaves: list[tuple[int, int]] = []
    open_: set[int] | None = None  # None: all
    while True:
        p = prefix(F.col("key"), depth)
        rows = keys if open_ is None else keys.where(prefix(F.col("key"), depth - 1).isin(sorted(open_)))
        sums = {r["p"]: (r["b"], r["n"]) for r in rows.groupBy(p.alias("p")).agg(F.sum("bytes").alias("b"), F.count("*").alias("n")).collect()}
        here = range(1 << depth) if open_ is None else sorted(x for q in open_ for x in (2 * q, 2 * q + 1))
        over = {x for x in here if sums.get(x, (0, 0))[0] > bucket_bytes and sums[x][1] > 1 and depth < MAX_DEPTH}
        leaves += [(x, depth) for x in here if x not in over]
        if not over:
            return Directory(depth, tuple(sorted(leaves, key=lambda b: b[0] << (MAX_DEPTH - b[1]))))
        open_, depth = over, depth + 1


def _larger(a, b):
    """The larger id; null is smaller than any."""
    return a if b is None or a is not None and a >= b else b


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct texts of (bucket, key, norm, n, top) with their number of rows and largest id, while they fit FOLD_BYTES."""
    found: dict[tuple[int, str], list] = {}
    held, kind = 0, None

    def folded() -> pa.RecordBatch:
        out = [[x[0] for x in found.values()], [k for k, _ in found], [t for _, t in found], [x[1] for x in found.values()], [x[2] for x in found.values()]]
        found.clear()
        kinds = [pa.int32(), pa.int64(), pa.string(), pa.int64(), kind]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["bucket", "key", "norm", "n", "top"])

    for batch in by_bytes(batches, 2):
        kind = batch.column(4).type
        for bucket, key, text, n, top in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            x = found.get((key, text))
            if x is None:
                found[key, text] = [bucket, n, top]
                held += len(text)
            else:
                x[1] += n
                x[2] = _larger(x[2], top)
        if held > FOLD_BYTES:
            yield folded()
            held = 0
    if found:
        yield folded()


def _owner(folder: str):
    """Write the file of each bucket from rows in key order; yields (bucket, path)."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = open_fs(folder)
        pack = zstandard.ZstdCompressor(level=1)
        chain: list[list] = []  # entries of the current key: text, rows, kept id
        now, out, done = (None, None), None, []

        def flush() -> None:
            for position, (text, n, kept) in enumerate(chain):
                name, data = b"" if kept is None else str(kept).encode(), pack.compress(text.encode())
                out.write(struct.pack(ENTRY, now[1] & (1 << 64) - 1, n, -1 if kept is None else len(name), position, len(data)) + name + data)
            chain.clear()

        for batch in by_bytes(batches, 2):
            for bucket, key, text, n, kept in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (bucket, key) != now:
                    flush()
                    if bucket != now[0]:
                        if out is not None:
                            out.close()
                        done.append((bucket, f"{top}/bucket-{bucket:06d}-{uuid.uuid4().hex[:8]}.ehx"))
                        out = fs.open_output_stream(done[-1][1])
                    now = (bucket, key)
                for entry in chain:
                    if entry[0] == text:  # the bytes decide
                        entry[1] += n
                        entry[2] = _larger(entry[2], kept)
                        break
                else:
                    chain.append([text, n, kept])
        flush()
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in done], pa.int32()), pa.array([p for _, p in done], pa.string())], names=["bucket", "path"])

    return own


def _entries(folder: str):
    """Rows of the entries of bucket files, streamed."""
    names = ["key", "text_sha256", "keep_id", "group_size", "bucket", "path", "at", "position"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int32()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        fs, _ = open_fs(folder)
        unpack = zstandard.ZstdDecompressor()
        rows: list[tuple] = []

        def batch_of() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
            rows.clear()
            return out

        for batch in batches:
            for bucket, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                at, seen = 0, set()
                with fs.open_input_stream(path, buffer_size=1 << 20) as f:
                    while head := f.read(struct.calcsize(ENTRY)):
                        key, n, id_size, position, size = struct.unpack(ENTRY, head)
                        name = None if id_size < 0 else f.read(id_size).decode()
                        sha = hashlib.sha256(unpack.decompress(f.read(size))).hexdigest()
                        seen = seen if position else set()
                        if sha in seen:
                            raise ValueError("two different texts have the same SHA-256")
                        seen.add(sha)
                        rows.append((key - (1 << 64) if key >> 63 else key, sha, name, n, bucket, path, at, position))
                        at += struct.calcsize(ENTRY) + max(0, id_size) + size
                        if len(rows) == 10_000:
                            yield batch_of()
        if rows:
            yield batch_of()

    return read


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, DataFrame, int]:
    """Write the index; returns its entries as read from the files (one row a distinct text), the documents' keys, and the number of documents."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    norm = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).alias("doc_id"), norm.alias("norm")).withColumn("key", F.xxhash64("norm"))
    prints = stored(rows.select("doc_id", "key", F.sha2("norm", 256).alias("text_sha256"), F.octet_length("norm").alias("bytes")), "exact-prints")
    total = prints.count()
    keys = stored(prints.groupBy("key").agg(F.max("bytes").alias("bytes"), F.count("*").alias("n")), "exact-keys")
    directory = build_directory(keys, bucket_bytes)
    hot = stored(keys.where(F.col("n") > max(10_000, total // 1000)).select("key"), "exact-hot")  # at most a thousand
    drop(keys)
    table = spark.createDataFrame(directory.entries(), "entry long, bucket int")  # at most 2^20 short rows
    folder = shared_folder(spark, "exact-index")
    fs, path = open_fs(folder)
    fs.create_dir(path)
    fold = lambda x: x.select("bucket", "key", "norm", "n", "top").mapInArrow(_fold, f"bucket int, key long, norm string, n long, top {kind}")
    dealt = rows.join(F.broadcast(table), prefix(F.col("key"), directory.depth) == F.col("entry")).select("bucket", "key", "norm", F.lit(1).cast("long").alias("n"), F.col("doc_id").alias("top"))
    if hot.limit(1).count():
        often = fold(dealt.join(F.broadcast(hot), "key", "left_semi")).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
        folded = fold(dealt.join(F.broadcast(hot), "key", "left_anti")).unionByName(fold(often.repartition("key", "salt")))
    else:
        folded = fold(dealt)
    files = folded.repartitionById(len(directory.buckets), F.col("bucket")).sortWithinPartitions("bucket", "key").mapInArrow(_owner(folder), "bucket int, path string")
    files = stored(files, "exact-files", TEXT_BATCH)
    n = max(1, files.count())
    entries = files.repartitionById(n, F.pmod(F.col("bucket"), F.lit(n)).cast("int")).mapInArrow(_entries(folder), "key long, text_sha256 string, keep_id string, group_size long, bucket int, path string, at long, position int")
    return stored(entries.withColumn("keep_id", F.col("keep_id").cast(kind)), "exact-groups"), prints, total


def read_entry(path: str, at: int) -> tuple[int, str]:
    """Key and normalised text of an index entry."""
    fs, p = open_fs(path)
    with fs.open_input_file(p) as f:
        f.seek(at)
        key, _, id_size, _, size = struct.unpack(ENTRY, f.read(struct.calcsize(ENTRY)))
        f.seek(at + struct.calcsize(ENTRY) + max(0, id_size))
        return key, zstandard.ZstdDecompressor().decompress(f.read(size)).decode()


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row a document: doc_id, keep_id, group_size, kept, text_sha256."""
    groups, prints, total = build_index(docs, id_col, text_col, bucket_bytes)
    out = join_unique(prints.select("doc_id", "key", "text_sha256"), groups.select("key", "text_sha256", "keep_id", "group_size"), ["key", "text_sha256"], "group_size", total)
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
