"""Token files, token counts, WARC archives and the pipeline: exact round trips."""

import base64
import gzip
import hashlib
import io
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridrefs.llm import tokencount, tokenout, warc
from gridrefs.llm.shared import open_fs, shared_folder
from gridrefs.llm.tokens import PieceEncoder

BPE = public_tokenizers.path("byte_bpe_50k.json")
DATA = "/root/testdata/sf0.001"

TRICKY = ["", " ", ". a", "a.", "a,b. c", "x  y", "\n", "a\nb", "a.\nB c.", "don't. he's, x_. y", "½. a", "é́. b", "a <|endoftext|> b", "  a", "a  b", "1.2.3. 4,5 , . ..", ". , a", "a\x01b", "tab\there", "end ", "\n\nx", "a \nb", "🙂. ok"]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(BPE)


def test_pieces_give_the_librarys_ids(plain):
    got = PieceEncoder(BPE).encode(TRICKY)
    for text, ids in zip(TRICKY, got, strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_token_files_round_trip(spark, odd_docs, no_docs, plain, monkeypatch):
    monkeypatch.setattr(tokenout, "FILE_CHARS", 50_000)
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").unionByName(odd_docs.select((F.col("doc_id") + 1000).alias("doc_id"), "text")).unionByName(spark.createDataFrame([(5000 + i, t) for i, t in enumerate(TRICKY)], "doc_id long, text string"))
    rows = tokenout.token_ids(docs, BPE).collect()
    texts = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    want, start = [], 0
    for d, t in texts:
        ids = np.array([*plain.encode(t, add_special_tokens=False).ids, 2], "<u4")
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows), key=lambda r: r[1]) == want
    assert tokenout.token_ids(no_docs, BPE).count() == 0


def test_one_document_by_its_index(spark, plain):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    manifest, folder = tokenout.write_tokens(docs, BPE, 2)
    path = manifest.orderBy("file_no").first()["path"]
    first = docs.orderBy("doc_id").take(3)[2]["text"]
    assert tokenout.read_document(path, 2).tolist() == [*plain.encode(first, add_special_tokens=False).ids, 2]


def test_token_counts(spark, odd_docs, no_docs, plain):
    plain.encode_special_tokens = True
    rows = tokencount.token_counts(odd_docs, BPE, 50256).collect()
    plain.encode_special_tokens = False
    t = Tokenizer.from_file(BPE)
    t.encode_special_tokens = True
    want = sorted((str(r["doc_id"]), len(t.encode(r["text"] or "", add_special_tokens=False).ids) + 1) for r in odd_docs.collect())
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in rows) == want
    assert tokencount.token_counts(no_docs, BPE, 50256).count() == 0


def test_rows_of_documents_are_not_broadcast(spark, odd_docs):
    plan = tokencount.token_counts(odd_docs, BPE, 50256)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    joins = [x for x in plan.splitlines() if "BroadcastHashJoin" in x]
    assert joins and all("[path" in x and "block" in x and "BuildRight" in x for x in joins), joins  # only rows of blocks are


@pytest.mark.parametrize("block", [1, 3, 7, 1000])
def test_separators_across_blocks(spark, block):
    lengths = [1, 1, 9, 30, 2, 1, 17, 4]
    ids = np.concatenate([[*range(1, n), 0] for n in lengths] + [[5, 6]]).astype("<u2")  # the last has no separator
    folder = shared_folder(spark, "test-flat")
    fs, top = open_fs(folder)
    fs.create_dir(top)
    for name, data in (("a", ids), ("b", ids[:0]), ("c", ids[3:9] * 0 + 8)):
        with fs.open_output_stream(f"{top}/{name}") as f:
            f.write(data.tobytes())
    files = spark.createDataFrame([(f"{top}/a", len(ids)), (f"{top}/b", 0), (f"{top}/c", 6)], "path string, n_ids long")
    got = sorted((r["path"][-1], r["ordinal"], r["n_tokens"]) for r in tokencount.count_separated(spark, files, folder, 0, 2, block).collect())
    assert got == [("a", i, n) for i, n in enumerate([*lengths, 2])] + [("c", 0, 6)]


PAGES = [(1, "http://a/", "<p>x</p>"), (2, "http://b/\r\nX: y", "<p>x</p>"), (3, None, None), (4, "http://d/", ""), (5, "http://e/", "WARC/1.1\r\n\r\nnot a head ü🙂\r\n\r\n"), (5, "http://e/", "WARC/1.1\r\n\r\nnot a head ü🙂\r\n\r\n"), (None, "http://f/", "<p>x</p>"), (7, "http://g/", "long " * 100_000)]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "clash", "clash") for p in PAGES], "page_id long, url string, html string, digest string, payload string")


def test_warc_round_trip(pages):
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.warc_round_trip(pages).collect()), key=repr)
    top = {}
    for i, _, h in PAGES:
        top[h or ""] = max(top.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, _, h in PAGES:
        raw = (h or "").encode()
        best = top[h or ""]
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), *(("response", None) if i == best else ("revisit", best))))
    assert got == sorted(want, key=repr)
    assert warc.warc_round_trip(pages.where("false")).count() == 0


def test_warc_small_payloads_are_all_responses(pages):
    rows = warc.warc_round_trip(pages, min_bytes=100).collect()
    assert {r["record_type"] for r in rows if r["payload_bytes"] < 100} == {"response"}


def test_archives_are_standard_gzip_and_filters_are_pushed(spark, pages):
    path = shared_folder(spark, "warc-test")
    warc.write_pages(pages, path)
    _, top = open_fs(path)
    plain = b"".join(gzip.decompress(p.read_bytes()) for p in Path(top).glob("*.warc.gz"))
    assert plain.count(b"WARC-Type: ") == len(PAGES)
    one = spark.read.format("warc").load(path).where("record_id = 'urn:x-page:4' and record_type = 'response'")
    assert [r["target_uri"] for r in one.collect()] == ["http://d/"]
    out = io.StringIO()
    import contextlib

    with contextlib.redirect_stdout(out):
        one.explain()
    assert "urn:x-page:4" not in out.getvalue().split("Physical Plan")[1]  # only the tests for null are left to Spark
    assert spark.read.format("warc").option("payload", "false").load(path).where("payload is not null").count() == 0


def _row(kind="response", **more):
    return type("R", (), dict(record_type=kind, record_id="urn:x-page:1", target_uri="u", date="d", refers_to=None, payload_digest="A", payload_length=3, payload=b"abc") | more)


def test_archives_of_other_writers(spark, tmp_path):
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 9\r\n\r\nsoftware:\r\n\r\n"
    plain = gzip.decompress(warc.record(_row())).replace(b"X-Payload-Length: 3\r\n", b"")
    far = gzip.decompress(warc.record(_row("revisit", payload=None))).replace(b"X-Payload-Length: 3\r\n", b"")
    big = gzip.decompress(warc.record(_row(payload=b"z" * 300_000)))
    (tmp_path / "x.warc.gz").write_bytes(b"".join(map(gzip.compress, (info, plain, far, big, plain))))
    (tmp_path / "y.warc").write_bytes(info + plain + big + far)
    warc.register(spark)
    rows = spark.read.format("warc").load(str(tmp_path)).collect()
    want = [("warcinfo", 9, b"software:"), ("response", 3, b"abc"), ("revisit", None, None), ("response", 300_000, b"z" * 300_000)]
    got = sorted(((r["record_type"], r["payload_length"], r["payload"] and bytes(r["payload"])) for r in rows), key=repr)
    assert got == sorted([*want, want[1], *want], key=repr)
    lengths = spark.read.format("warc").option("payload", "false").load(str(tmp_path)).where("record_type = 'response'").select("payload_length").collect()
    assert sorted(r[0] for r in lengths) == [3, 3, 3, 300_000, 300_000]


@pytest.mark.parametrize("payload", ["true", "false"])
def test_truncated_archives_and_missing_ones_raise(tmp_path, payload):
    data = warc.record(_row(payload=bytes(range(256)) * 400))
    own, other = data, gzip.compress(gzip.decompress(data))
    for whole in (own, other, gzip.decompress(data)):
        for n in (1, 2, 3, 17, 30, len(whole) // 2):
            path = tmp_path / "t.warc.gz"
            path.write_bytes(whole[:n])
            if payload == "true" or n < 31:
                with pytest.raises((ValueError, zlib.error)):
                    list(warc.WarcReader(str(tmp_path), payload == "true").read(warc.Ranges(((str(path), 0, n),))))
            path.unlink()
    with pytest.raises(FileNotFoundError):
        warc.WarcReader(str(tmp_path), True).partitions()


def test_large_files_are_cut_at_records(spark, pages, monkeypatch):
    monkeypatch.setattr(warc, "PARTITION_BYTES", 300)
    folder = shared_folder(spark, "warc-cut")
    fs, top = open_fs(folder)
    writer = warc.WarcWriter(folder)
    writer.commit([writer.write(iter([_row(record_id=f"urn:x-page:{i}") for i in range(9)]))])
    parts = warc.WarcReader(folder, True).partitions()
    assert len(parts) > 3
    ids = [r for p in parts for b in warc.WarcReader(folder, True).read(p) for r in b.column(1).to_pylist()]
    assert ids == [f"urn:x-page:{i}" for i in range(9)]


def test_many_repeated_payloads(spark, monkeypatch):
    from gridrefs.llm import shared

    rows = [(i, "u", f"html {i % 7}") for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = sorted(warc.warc_round_trip(pages).collect())
    monkeypatch.setattr(shared, "BROADCAST_ROWS", 2)
    assert sorted(warc.warc_round_trip(pages).collect()) == want and len(want) == 60


def test_pipeline(spark):
    import corpus_pipeline
    from gridrefs.llm import decontam, neardup
    from gridrefs.llm.queries import table

    docs = table(spark, DATA, "documents")
    for _, stage in corpus_pipeline.STAGES[:4]:
        before = docs
        docs = stage(spark, docs, DATA).cache()
        assert docs.columns == before.columns
        assert docs.join(before, "doc_id", "left_anti").count() == 0
    assert neardup.near_duplicates(docs.dropDuplicates(["doc_id"])).where("not kept").count() == 0
    assert decontam.contaminated(docs, table(spark, DATA, "benchmark")).count() == 0
    rows = corpus_pipeline.run(spark, DATA)
    assert sorted(r["doc_id"] for r in rows.collect()) == sorted(r["doc_id"] for r in docs.collect())


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_stages_of_odd_rows(spark, odd_docs, no_docs, tmp_path, empty):
    import corpus_pipeline

    spark.createDataFrame([(i, i % 2, None) for i in range(12)] + [(None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "a b c d e f g h"), (2, None), (None, "one two")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = no_docs if empty else odd_docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        rows = out.count()
        assert rows == 0 if empty else rows > 0
        if name != "mixing":
            assert out.exceptAll(docs).count() == 0
        if name == "decontamination" and not empty:
            assert out.where("text = 'one two'").count() == 0 and out.where("doc_id is null").count() == 1
    assert corpus_pipeline.STAGES[4][1](spark, docs, str(tmp_path)).count() == docs.count()
