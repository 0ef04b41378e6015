"""Token-ID output: compressed id files with a shared dictionary and an offset index.

Every document's ids (little-endian, 2 or 4 bytes) are compressed on their own with one
zstandard dictionary that is trained on a bounded sample of serialized id arrays. A file is::

    magic "GTOK0001" | SHA-256 of the dictionary | id width
    compressed documents, one after the other
    index: a 32-byte entry a document (doc_id, offset, n_ids before it in the file, n_ids)
    footer: index offset, documents, ids, flags of null doc_ids

so that one short document is read by its index entry alone. Files hold ascending key ranges:
the documents of file k come before those of file k + 1.

Cases: a null text is an empty document (its ids are the end id only); rows with a null doc_id
come first; repeated rows are separate documents, ordered among each other by their bytes; an
empty table gives no files and an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import TEXT_BATCH, by_bytes, hash_sample, open_fs, shared_folder, stored
from .tokens import encoder

MAGIC = b"GTOK0001"
HEAD = "<8s32sI"
ENTRY = np.dtype([("doc_id", "<i8"), ("offset", "<u8"), ("before", "<u8"), ("n_ids", "<u4"), ("size", "<u4")])
FOOT = "<QQQQ"

#: Documents in the sample that the dictionary is trained on, and characters of each that serve for it.
SAMPLE_DOCS = 400
SAMPLE_CHARS = 50_000
DICTIONARY_BYTES = 64 << 10
#: Input text characters a file.
FILE_CHARS = 64 << 20


def train_dictionary(arrays: list[bytes]) -> bytes:
    """A zstandard dictionary from serialized id arrays; empty where they are too few to train."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, arrays).as_bytes()
    except zstandard.ZstdError:
        return b"".join(arrays)[-DICTIONARY_BYTES:]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def _compressor(data: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=3, dict_data=_dictionary(data), write_content_size=True)


def _decompressor(data: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=_dictionary(data))


def _sample(docs: DataFrame, id_col: str, text_col: str) -> list[str]:
    """Beginnings of the texts of a bounded sample of documents, one for each id, the same at each run."""
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    ids = [r["doc_id"] for r in hash_sample(named.select("doc_id"), "doc_id", SAMPLE_DOCS).collect()]
    rows = named.where(F.col("doc_id").isin(ids)).groupBy("doc_id").agg(F.min(F.substring("text", 1, SAMPLE_CHARS)).alias("text"))
    return [r["text"] for r in rows.orderBy("doc_id").collect()]


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", file_chars: int = FILE_CHARS) -> tuple[DataFrame, str]:
    """Encode and write all documents; returns the manifest (one row a file) and the folder."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "token-ids")
    sample = _sample(docs, id_col, text_col)
    size = docs.count() * sum(map(len, sample)) // max(1, len(sample))  # an estimate; it only sets the number of files
    n_files = int(min(100_000, max(2 * spark.sparkContext.defaultParallelism if size > file_chars else 1, size // file_chars + 1)))
    cuts = sorted(set(docs.approxQuantile(id_col, [i / n_files for i in range(1, n_files)], min(0.01, 0.2 / n_files)))) if n_files > 1 else []
    enc = encoder(tokenizer)
    dictionary = train_dictionary([x + np.array([end_id], enc.dtype).tobytes() for x in enc.encode(sample)])
    digest = hashlib.sha256(dictionary).digest()
    fs, path = open_fs(folder)
    fs.create_dir(path)
    with fs.open_output_stream(f"{path}/dictionary-{digest.hex()}.zdict") as out:
        out.write(dictionary)
    shared = spark.sparkContext.broadcast((dictionary, [float(c) for c in cuts]))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, bounds = shared.value
        enc, pack = encoder(tokenizer), _compressor(data)
        end = np.array([end_id], enc.dtype).tobytes()
        for batch in by_bytes(batches, 1):
            ids = [x + end for x in enc.encode(batch.column(1))]
            keys = batch.column(0)
            part = np.searchsorted(bounds, keys.to_pandas().fillna(-np.inf).to_numpy("float64"), side="left") if bounds else np.zeros(len(ids), int)
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(part, pa.int32()), pa.array([len(x) // enc.dtype.itemsize for x in ids], pa.int64()), pa.array([pack.compress(x) for x in ids], pa.binary())],
                names=["doc_id", "part", "n_ids", "data"],
            )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = open_fs(folder)
        name, stream, entries, nulls, at, before, part = "", None, [], 0, struct.calcsize(HEAD), 0, 0
        for batch in batches:
            if not len(batch):
                continue
            if stream is None:
                part = batch.column(1)[0].as_py()
                name = f"{top}/ids-{part:06d}-{uuid.uuid4().hex[:8]}.gtok"  # a failed attempt's file is never in the manifest
                stream = fs.open_output_stream(name)
                stream.write(struct.pack(HEAD, MAGIC, digest, encoder(tokenizer).dtype.itemsize))
            for key, n, data in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                nulls += key is None  # they sort first
                entries.append(np.array((key or 0, at, before, n, len(data)), ENTRY).tobytes())
                stream.write(data)
                at, before = at + len(data), before + n
        if stream is not None:
            stream.write(b"".join(entries))
            stream.write(struct.pack(FOOT, at, len(entries), before, nulls))
            stream.close()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([name]), pa.array([len(entries)], pa.int64()), pa.array([before], pa.int64())], names=["file_no", "path", "n_docs", "n_ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    done = (
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        .mapInArrow(encode, f"doc_id {kind}, part int, n_ids long, data binary")
        .repartitionById(len(cuts) + 1, F.col("part"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("data"), "n_ids")
        .mapInArrow(write, "file_no int, path string, n_docs long, n_ids long")
    )
    return stored(done, "token-manifest", TEXT_BATCH), folder


def read_index(fs, path: str) -> tuple[bytes, int, np.ndarray, int]:
    """Dictionary hash, id width, offset index and number of null doc_ids of a file."""
    with fs.open_input_file(path) as f:
        magic, digest, width = struct.unpack(HEAD, f.read(struct.calcsize(HEAD)))
        if magic != MAGIC:
            raise ValueError(f"{path} is not a token file")
        f.seek(f.size() - struct.calcsize(FOOT))
        at, n, _, nulls = struct.unpack(FOOT, f.read(struct.calcsize(FOOT)))
        f.seek(at)
        return digest, width, np.frombuffer(f.read(n * ENTRY.itemsize), ENTRY), nulls


def load_dictionary(fs, path: str, digest: bytes) -> bytes:
    """The dictionary of a token file, checked against the hash in the file."""
    with fs.open_input_file(f"{path.rsplit('/', 1)[0]}/dictionary-{digest.hex()}.zdict") as f:
        data = f.read()
    if hashlib.sha256(data).digest() != digest:
        raise ValueError(f"{path}: the dictionary does not have the hash in the file")
    return data


def read_document(path: str, n: int, uri: str = "") -> np.ndarray:
    """Ids of the n-th document of a file, through the offset index alone."""
    fs, p = open_fs(uri or path)
    digest, width, index, _ = read_index(fs, p)
    entry = index[n]
    with fs.open_input_file(p) as f:
        f.seek(int(entry["offset"]))
        data = f.read(int(entry["size"]))
    return np.frombuffer(_decompressor(load_dictionary(fs, p, digest)).decompress(data), f"<u{width}")


def read_tokens(manifest: DataFrame, folder: str, id_type: str = "bigint") -> DataFrame:
    """One row a document from the files: doc_id, start, n_tokens, ids_crc32.

    A task streams one file's documents; start adds the ids of all files before it, which a
    running sum over the manifest (one short row a file) gives.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_fs(folder)
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
                digest, width, index, nulls = read_index(fs, path)
                unpack = _decompressor(load_dictionary(fs, path, digest))
                with fs.open_input_stream(path, buffer_size=1 << 20) as f:
                    f.read(struct.calcsize(HEAD))
                    for start in range(0, len(index), 2000):
                        part = index[start : start + 2000]
                        crcs = []
                        for size, n in zip(part["size"].tolist(), part["n_ids"].tolist(), strict=True):
                            ids = np.frombuffer(unpack.decompress(f.read(size)), f"<u{width}")
                            if len(ids) != n:
                                raise ValueError(f"{path}: the index says {n} ids, the document has {len(ids)}")
                            crcs.append(zlib.crc32(ids.astype("<u4").tobytes()))
                        null = np.arange(start, start + len(part)) < nulls
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(part["doc_id"].copy(), pa.int64(), mask=null),
                                pa.array(part["before"].astype("i8") + base, pa.int64()),
                                pa.array(part["n_ids"].astype("i8"), pa.int64()),
                                pa.array(crcs, pa.int64()),
                            ],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    earlier = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("file_no", "path", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).cast("long").alias("base"))
    n = max(1, manifest.count())
    out = files.repartitionById(n, F.pmod(F.col("file_no"), F.lit(n)).cast("int")).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
    return out.withColumn("doc_id", F.col("doc_id").cast(id_type))


def token_ids(docs: DataFrame, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``docs`` as token files and read them back, a row a document."""
    manifest, folder = write_tokens(docs, tokenizer, end_id, id_col, text_col)
    return read_tokens(manifest, folder, docs.schema[id_col].dataType.simpleString())


