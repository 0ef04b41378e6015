"""Token counts of flat token files that have no index.

A flat file is nothing but ids, each document closed by the end-of-document id. The files are
cut into blocks of a fixed number of ids. A task searches its block for the end id with one
vectorised comparison; it can't know how many documents and ids came before. One summary a
block (ids, separators, ids after the last separator) goes through a prefix scan over the
blocks of each file, and the first document of every block then gets what earlier blocks hold
of it. The last document of a file may lack its separator; it counts without one.

Cases: a null text is an empty document of one id, the separator; an empty table or file has
no documents; repeated rows are separate documents; special strings in a text are ordinary
text, so the separator never occurs inside a document; other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import BROADCAST_ROWS, TEXT_BATCH, by_bytes, open_fs, shared_folder, stored
from .tokens import encoder

#: Ids a block.
BLOCK_IDS = 4 << 20


def write_flat(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, str, int]:
    """Write one flat file for each input partition.

    Returns the files (path, n_ids), the order of documents in them (path, ordinal, doc_id), the
    folder and the bytes an id takes.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, "token-flat")
    fs, path = open_fs(folder)
    fs.create_dir(path)
    names = ["path", "ordinal", "doc_id", "n_ids"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = open_fs(folder)
        enc = encoder(tokenizer, keep_special_text=True)
        end = np.array([end_id], enc.dtype).tobytes()
        path, out, n, ids = f"{top}/flat-{uuid.uuid4().hex}.ids", None, 0, 0
        for batch in by_bytes(batches, 1):
            if out is None:
                out = fs.open_output_stream(path)
            got = enc.encode(batch.column(1))
            for x in got:
                out.write(x + end)
                ids += len(x) // enc.dtype.itemsize + 1
            keys = batch.column(0)
            yield pa.RecordBatch.from_arrays([pa.array([path] * len(got)), pa.array(range(n, n + len(got)), pa.int64()), keys, pa.nulls(len(got), pa.int64())], names=names)
            n += len(got)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.nulls(1, pa.int64()), pa.nulls(1, keys.type), pa.array([ids], pa.int64())], names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    rows = stored(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(write, f"path string, ordinal long, doc_id {kind}, n_ids long"), "token-order", TEXT_BATCH)
    files = rows.where("n_ids is not null").select("path", "n_ids")
    return files, rows.where("n_ids is null").select("path", "ordinal", "doc_id"), folder, encoder(tokenizer, keep_special_text=True).dtype.itemsize


def count_separated(spark: SparkSession, files: DataFrame, folder: str, end_id: int, width: int, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Documents of flat files: path, ordinal, start (ids before it in the file), n_tokens (with the end id).

    ``files`` has path and n_ids. Blocks are dealt to tasks singly, so one huge file is no bottleneck.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_fs(folder)
        for batch in batches:
            for path, block, first, n in zip(*(batch.column(c).to_pylist() for c in ("path", "block", "first", "n")), strict=True):
                with fs.open_input_file(path) as f:
                    f.seek(first * width)
                    ids = np.frombuffer(f.read(n * width), f"<u{width}")
                ends = np.flatnonzero(ids == end_id)
                lengths = np.diff(ends, prepend=-1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path]), pa.array([block], pa.int64()), pa.array([first], pa.int64()), pa.array([n], pa.int64()), pa.array([len(ends)], pa.int64()), pa.array([int(n - 1 - ends[-1]) if len(ends) else n], pa.int64()), pa.array([lengths.astype("i8")], pa.list_(pa.int64()))],
                    names=["path", "block", "first", "n", "seps", "tail", "lengths"],
                )

    blocks = files.where("n_ids > 0").select(
        "path",
        F.explode(F.expr(f"sequence(0L, (n_ids - 1) div {block_ids}L)")).alias("block"),
        "n_ids",
    ).selectExpr("path", "block", f"block * {block_ids}L AS first", f"least({block_ids}L, n_ids - block * {block_ids}L) AS n", "n_ids")
    n_blocks = max(1, blocks.count())
    found = stored(blocks.repartition(min(n_blocks, 100_000), "path", "block").mapInArrow(scan, "path string, block long, first long, n long, seps long, tail long, lengths array<long>"), "token-blocks")
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = Window.partitionBy("path")
    # Prefix scan: documents closed so far, and ids since the last separator of any earlier block.
    scan_of = (
        found.select("path", "block", "first", "n", "seps", "tail")
        .withColumn("docs_before", F.coalesce(F.sum("seps").over(before), F.lit(0)))
        .withColumn("open_from", F.coalesce(F.max(F.when(F.col("seps") > 0, F.col("first") + F.col("n") - F.col("tail"))).over(before), F.lit(0)))
        .withColumn("is_last", F.col("block") == F.max("block").over(last))
    )
    # A row a block is broadcast while blocks are few; lengths, a number a document, never are.
    scan_of = F.broadcast(scan_of) if n_blocks <= BROADCAST_ROWS else scan_of.hint("merge")
    joined = found.select("path", "block", "lengths").join(scan_of, ["path", "block"])
    closed = joined.select("path", "docs_before", "first", "open_from", F.posexplode("lengths").alias("k", "len"), "lengths").select(
        "path",
        (F.col("docs_before") + F.col("k")).alias("ordinal"),
        F.when(F.col("k") == 0, F.col("first") + F.col("len") - F.col("open_from")).otherwise(F.col("len")).alias("n_tokens"),
    )
    # A file that does not end with the separator.
    rest = joined.where("is_last").select(
        "path",
        (F.col("docs_before") + F.col("seps")).alias("ordinal"),
        F.when(F.col("seps") > 0, F.col("tail")).otherwise(F.col("first") + F.col("n") - F.col("open_from")).alias("n_tokens"),
    ).where("n_tokens > 0")
    return closed.unionByName(rest)


def token_counts(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the documents to flat files, count their tokens from the files, return doc_id and n_tokens."""
    files, order, folder, width = write_flat(docs, tokenizer, end_id, id_col, text_col)
    counts = count_separated(docs.sparkSession, files, folder, end_id, width)
    # Both sides have a row a document; Spark would broadcast one of them, as their stored files are small.
    return order.hint("merge").join(counts.hint("merge"), ["path", "ordinal"]).select("doc_id", "n_tokens")
