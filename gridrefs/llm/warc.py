"""WARC archives as a Python data source, ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Files are WARC 1.1 with one gzip member a record; a member's extra field ``SL`` holds its
compressed and plain length. The driver lists committed files and packs them, or ranges of them,
into partitions; a manifest holds where a large file may be cut. Archives of other writers, with
or without gzip, are read as well, a file a partition, where a folder has no manifest.
Filters on record_type, record_id, target_uri, refers_to and payload_digest are pushed down
(set ``spark.sql.python.filterPushdown.enabled``): a task inflates a record's headers first and
steps over the rest of a member that a filter rejects, or that is not wanted because the option
``payload`` is false.

A write goes to files with unique names; the commit lists those of successful tasks in a manifest
file, so what a lost executor left behind is never read.

Payloads: what follows the HTTP head of a response, nothing for a revisit, the whole block of other
records. payload_length is a response's Content-Length less its HTTP head; a revisit's comes from
the header X-Payload-Length, null where there is none. A truncated record raises, and so does a
folder without archives.

Cases: a null html is an empty payload; a null page_id is written as ``null`` and read back as
null; a null url gives no target URI; repeated page_ids give a record a row, all of them
responses if theirs is the largest id of their payload, and share its record id; an empty table gives an archive without
records and an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, In, InputPartition, StringStartsWith, WriterCommitMessage

from .shared import drop, is_small, join_unique, open_fs, shared_folder, stored

SCHEMA = "record_type string, record_id string, target_uri string, date string, refers_to string, payload_digest string, payload_length long, payload binary"
#: Header of each text column, in the order of a record's head.
HEADERS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "date": "WARC-Date", "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest"}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of files that make one partition.
PARTITION_BYTES = 32 << 20
BATCH_BYTES = 8 << 20
GZIP = struct.Struct("<4sIBBH2sHII")  # magic, time, flags, system, extra length, "SL", its length, compressed, plain


def member(head: bytes, body: bytes) -> bytes:
    """A gzip member of a record with its lengths in the extra field."""
    z = zlib.compressobj(4, zlib.DEFLATED, -15)
    packed = z.compress(head) + z.compress(body) + z.compress(b"\r\n\r\n") + z.flush()
    plain = len(head) + len(body) + 4
    crc = zlib.crc32(b"\r\n\r\n", zlib.crc32(body, zlib.crc32(head)))
    size = GZIP.size + len(packed) + 8
    return GZIP.pack(b"\x1f\x8b\x08\x04", 0, 0, 255, 12, b"SL", 8, size, plain & 0xFFFFFFFF) + packed + struct.pack("<II", crc, plain & 0xFFFFFFFF)


def record(row) -> bytes:
    """A WARC record of a row of SCHEMA."""
    payload = bytes(row.payload) if row.payload is not None else b""
    revisit = row.record_type == "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + (b"" if revisit else b"Content-Length: %d\r\n" % len(payload)) + b"\r\n"
    block = http if revisit else http + payload
    lines = ["WARC/1.1"]
    for column, header in HEADERS.items():
        value = getattr(row, column)
        if value is not None:
            value = value.replace("\r", "%0D").replace("\n", "%0A")
            lines.append(f"{header}: " + (f"<{value}>" if column in ("record_id", "refers_to") else f"sha1:{value}" if column == "payload_digest" else value))
    if revisit:
        lines.append(f"WARC-Profile: {PROFILE}")
    lines += [f"X-Payload-Length: {row.payload_length}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return member("\r\n".join(lines).encode(), block)


def parse_head(head: bytes) -> dict[str, str]:
    """Named fields of a record's head, names in lower case."""
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    return {name.strip().lower(): value.strip() for name, _, value in (x.partition(":") for x in lines[1:])}


@dataclass
class Ranges(InputPartition):
    """(path, first byte, end) that one task reads; both are bounds of records."""

    ranges: tuple[tuple[str, int, int], ...]


class _Record:
    """The plain bytes of the record at a position of a file, as far as they were asked for."""

    def __init__(self, f, path: str, at: int):
        self.f, self.path, self.at = f, path, at
        f.seek(at)
        start = f.read(GZIP.size)
        self.packed = start[:2] == b"\x1f\x8b"
        #: Bytes of the gzip member, where it says so.
        self.size = struct.unpack_from("<I", start, 16)[0] if self.packed and len(start) == GZIP.size and start[3] & 4 and start[12:14] == b"SL" else None
        self.z = zlib.decompressobj(31) if self.packed else None
        self.plain = bytearray(b"" if self.packed else start)
        f.seek(at + len(self.plain))

    def pull(self, n: int) -> None:
        """Some more plain bytes, not many more than n."""
        if self.z is None:
            out = self.f.read(n)
        else:
            out = b"" if self.z.eof else self.z.decompress(self.z.unconsumed_tail or self.f.read(n), n)
        if not out and not (self.z and self.z.unconsumed_tail):
            raise ValueError(f"{self.path}: the record at byte {self.at} is truncated")
        self.plain += out

    def find(self, mark: bytes, start: int = 0, end: int | None = None) -> int:
        """Place of a mark; -1 if it isn't in the first ``end`` bytes."""
        while (i := self.plain.find(mark, start)) < 0 and (end is None or len(self.plain) < end):
            self.pull(2048)
        return i if end is None or i + len(mark) <= end else -1

    def upto(self, n: int) -> bytearray:
        while len(self.plain) < n:
            self.pull(65536)
        return self.plain

    def end(self, n: int) -> int:
        """Where the next record starts, if this one has n plain bytes."""
        if self.size is not None:
            return self.at + self.size
        if self.z is None:
            return self.at + n
        while not self.z.eof:
            data = self.z.unconsumed_tail or self.f.read(65536)
            if not self.z.decompress(data, 65536) and not data:
                raise ValueError(f"{self.path}: the record at byte {self.at} is truncated")
        return self.f.tell() - len(self.z.unused_data)


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool):
        self.path, self.payload, self.filters = path, payload, []

    def pushFilters(self, filters: list) -> Iterator:
        """Keep what tests a header; Spark applies the others, and repeats nothing that is kept."""
        for f in filters:
            if isinstance(f, EqualTo | In | StringStartsWith) and len(f.attribute) == 1 and f.attribute[0] in HEADERS:
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[Ranges]:
        fs, top = open_fs(self.path)
        found: list[tuple[str, int, int]] = []
        from pyarrow.fs import FileSelector

        infos = sorted(fs.get_file_info(FileSelector(top)), key=lambda i: i.path)
        manifests = [i.path for i in infos if i.base_name.startswith("manifest-")]
        for path in manifests:
            with fs.open_input_stream(path) as f:
                for name, size, cuts in json.loads(f.read()):
                    found += [(f"{top}/{name}", a, b) for a, b in zip([0, *cuts], [*cuts, size], strict=True)]
        if not manifests:
            found = [(i.path, 0, i.size) for i in infos if i.base_name.endswith((".warc", ".warc.gz"))]
            if not found:
                raise FileNotFoundError(f"no WARC archives in {self.path}")
        packs, size = [[]], 0
        for path, start, end in found:
            if packs[-1] and size + end - start > PARTITION_BYTES:
                packs.append([])
                size = 0
            packs[-1].append((path, start, end))
            size += end - start
        return [Ranges(tuple(p)) for p in packs]

    def _wanted(self, row: dict[str, str | None]) -> bool:
        for f in self.filters:
            x = row[f.attribute[0]]
            if isinstance(f, EqualTo):
                ok = x == f.value
            elif isinstance(f, In):
                ok = x in f.value
            else:
                ok = x is not None and x.startswith(f.value)
            if not ok:
                return False
        return True

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        fs, _ = open_fs(self.path)
        kinds = {**dict.fromkeys(HEADERS, pa.string()), "payload_length": pa.int64(), "payload": pa.binary()}
        rows: list[tuple] = []
        held = 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds.values(), strict=True)], names=list(kinds))

        for place in partition.ranges:
            for row in self._records(fs, *place):
                rows.append(row)
                held += len(row[-1] or b"") + 500
                if held > BATCH_BYTES:
                    yield batch()
                    rows.clear()
                    held = 0
        if rows:
            yield batch()

    def _records(self, fs, path: str, at: int, end: int) -> Iterator[tuple]:
        with fs.open_input_file(path) as f:
            while at < end:
                # The head first: inflate only until the blank line.
                r = _Record(f, path, at)
                head = r.find(b"\r\n\r\n")
                fields = parse_head(bytes(r.plain[:head]))
                block, length = head + 4, int(fields["content-length"])
                row: dict[str, str | None] = {c: fields.get(h.lower()) for c, h in HEADERS.items()}
                for c in ("record_id", "refers_to"):
                    row[c] = row[c] and row[c].strip("<>")
                row["payload_digest"] = row["payload_digest"] and row["payload_digest"].removeprefix("sha1:")
                if self._wanted(row):
                    kind, start, given = row["record_type"], block, fields.get("x-payload-length")
                    if kind == "response":
                        http = r.find(b"\r\n\r\n", block, block + length)
                        start = block + length if http < 0 else http + 4
                    n = block + length - start if kind != "revisit" else int(given) if given else None
                    payload = bytes(r.upto(block + length)[start : block + length]) if self.payload and kind != "revisit" else None
                    yield (*row.values(), n, payload)
                at = r.end(block + length + 4)


@dataclass
class Written(WriterCommitMessage):
    """A task's file, its size, and where it may be cut for reading."""

    name: str
    size: int
    cuts: tuple[int, ...]


class WarcWriter(DataSourceWriter):
    def __init__(self, path: str):
        self.path = path
        fs, top = open_fs(path)
        fs.create_dir(top)

    def write(self, rows: Iterator) -> Written:
        fs, top = open_fs(self.path)
        name, size, out, cuts = f"part-{uuid.uuid4().hex}.warc.gz", 0, None, [0]
        for row in rows:
            data = record(row)
            if size - cuts[-1] >= PARTITION_BYTES:
                cuts.append(size)
            out = out or fs.open_output_stream(f"{top}/{name}", compression=None)
            out.write(data)
            size += len(data)
        if out is not None:
            out.close()
        return Written(name, size, tuple(cuts[1:]))

    def commit(self, messages: list[Written | None]) -> None:
        fs, top = open_fs(self.path)
        with fs.open_output_stream(f"{top}/manifest-{uuid.uuid4().hex}.json") as f:
            f.write(json.dumps([[m.name, m.size, m.cuts] for m in messages if m and m.size]).encode())

    def abort(self, messages: list[Written | None]) -> None:
        """Files without a manifest are never read."""


class WarcDataSource(DataSource):
    """Options: path; payload (default true) - false leaves payloads null and unread."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true").lower() != "false")

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    """Make the format known to a session, with filter pushdown."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def _base32(hex_digest: DataFrame, column: str) -> DataFrame:
    @F.pandas_udf("string")
    def b32(x: pd.Series) -> pd.Series:
        return x.map(lambda h: base64.b32encode(bytes.fromhex(h)).decode())

    return hex_digest.withColumn(column, b32(F.col(column)))


def write_pages(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write a record for each page; of equal payloads of at least ``min_bytes``, the page of the largest id is the response, the others revisit it."""
    register(pages.sparkSession)
    rows = pages.select(F.col(id_col).cast("string").alias("id"), F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    # Only payloads with several pages have revisits; where those are few, no payload is shuffled.
    groups = stored(rows.groupBy("digest").agg(F.max("page_id").alias("top"), F.count("*").alias("members")), "warc-groups")
    repeated = stored(groups.where("members > 1").select("digest", "top"), "warc-repeated")
    if is_small(repeated):
        known = rows.join(F.broadcast(repeated), "digest", "left")
    else:
        known = join_unique(rows, groups, ["digest"], "members", groups.agg(F.sum("members").alias("n")).first()["n"])
    revisit = (F.octet_length("payload") >= min_bytes) & F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    urn = lambda c: F.concat(F.lit("urn:x-page:"), F.coalesce(c.cast("string"), F.lit("null")))
    records = known.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        urn(F.col("page_id")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("date"),
        F.when(revisit, urn(F.col("top"))).alias("refers_to"),
        F.col("digest").alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_length"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )
    _base32(records, "payload_digest").write.format("warc").mode("append").save(path)
    drop(groups, repeated)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row a page from the archives: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Responses' payloads are inflated, measured and hashed again; of revisits only the head is read.
    """
    register(spark)
    read = spark.read.format("warc")
    response = read.load(path).where(F.col("record_type") == "response")
    response = response.select("record_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"), "record_type", "refers_to")
    revisit = read.option("payload", "false").load(path).where(F.col("record_type") == "revisit")
    revisit = revisit.select("record_id", F.col("payload_length").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
    page = lambda c: F.substring_index(c, ":", -1).try_cast("long")
    return _base32(response, "payload_digest").unionByName(revisit).select(page(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", page(F.col("refers_to")).alias("refers_to"))


def warc_round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write the pages' archive to a shared folder and read it back."""
    path = shared_folder(pages.sparkSession, "warc")
    write_pages(pages, path, **options)
    return read_pages(pages.sparkSession, path)
