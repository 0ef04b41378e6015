"""Exact and near duplicates, components: against brute force and on awkward rows."""

import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridrefs.llm import components, exactdup, neardup

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_components(rows):
    sets = [neardup.shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[root(i)].append(d)
    return [(d, len(sets[i]), min(least[root(i)])) for i, (d, _) in enumerate(rows)]


def near_copies(seed):
    """A large group of near copies, some too far from all others, a chain, and unrelated texts."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = [r.choice(vocabulary) for _ in range(150)]
    rows = []
    for k in range(160):
        w = list(base)
        for _ in range(r.choice([0, 1, 2, 3, 5, 9])):
            w[r.randrange(len(w))] = r.choice(vocabulary)
        rows.append(" ".join(w))
    chain = [r.choice(vocabulary) for _ in range(200)]
    for k in range(30):
        rows.append(" ".join(chain[k * 3 : k * 3 + 90]))
    rows += [" ".join(r.choice(vocabulary) for _ in range(40)) for _ in range(40)]
    r.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("tile", [16, 1024])
def test_near_duplicates_equal_brute_force(spark, tile, monkeypatch):
    monkeypatch.setattr(neardup, "TILE", tile)
    rows = near_copies(5)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted(brute_components(rows))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicates_of_odd_rows(odd_docs, no_docs):
    got = [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(odd_docs).collect()]
    assert len(got) == odd_docs.count()
    by_id = defaultdict(list)
    for d, *rest in got:
        by_id[d].append(tuple(rest))
    assert by_id[0] == [(15, 0, True)] and by_id[1] == [(15, 0, False)] and by_id[2] == [(16, 0, False)]
    for d in (3, 4, 5):
        assert by_id[d] == [(0, d, True)]
    assert by_id[6] == [(1, 6, True)] * 2
    assert by_id[None] == [(15, None, True)]
    assert by_id[10] == [(1, 10, True)]
    assert neardup.near_duplicates(no_docs).count() == 0
    assert sorted(neardup.keep_one(odd_docs).columns) == sorted(odd_docs.columns)


def test_hashes_follow_words():
    a = neardup.shingle_hashes(neardup.words_of("A b\tc d  e f"))
    assert set(a.tolist()) == set(neardup.shingle_hashes(neardup.words_of("a B c\nd e f")).tolist()) and len(a) == 2
    words = neardup.words_of(" ".join(f"w{i}" for i in range(5000)))
    whole = neardup.shingle_hashes(words)
    step, neardup.CHUNK_WORDS = neardup.CHUNK_WORDS, 700
    try:
        assert np.array_equal(whole, neardup.shingle_hashes(words))
    finally:
        neardup.CHUNK_WORDS = step


def test_minima_estimate_similarity():
    r = np.random.default_rng(1)
    x = r.integers(0, 1 << 63, 400, dtype=np.uint64)
    y = np.concatenate([x[:300], r.integers(0, 1 << 63, 100, dtype=np.uint64)])
    agree = (neardup.minima(x) == neardup.minima(y)).mean()
    assert abs(agree - 0.6) < 0.2


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40)), max_size=60))
def test_components(spark, edges):
    df = spark.createDataFrame([(int(a), int(b)) for a, b in edges], "a long, b long")
    got = {r["node"]: r["component"] for r in components.connected_components(df).collect()}
    up = {}
    for a, b in edges:
        if a != b:
            up.setdefault(a, {a}), up.setdefault(b, {b})
            if up[a] is not up[b]:
                merged = up[a] | up[b]
                for n in merged:
                    up[n] = merged
    assert got == {n: min(s) for n, s in up.items()}


def test_long_path_has_one_component(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
    assert {r["component"] for r in components.connected_components(df).collect()} == {0}


def brute_exact(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[(t or "").translate(AZ)].append(d)
    top = {k: max((d for d in v if d is not None), default=None) for k, v in groups.items()}
    return sorted(((d, top[k], len(groups[k])) for d, t in rows for k in [(t or "").translate(AZ)]), key=repr)


@pytest.mark.parametrize("bucket_bytes", [1 << 25, 300])
def test_exact_dedup(odd_docs, no_docs, bucket_bytes):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = exactdup.exact_dedup(odd_docs, bucket_bytes=bucket_bytes).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"]) for r in got), key=repr) == brute_exact(rows)
    assert all(r["kept"] == (r["doc_id"] == r["keep_id"]) for r in got)
    assert exactdup.exact_dedup(no_docs).count() == 0


def test_directory_splits_only_overfull_buckets(spark):
    keys = [(k << 58, 10) for k in range(8)] + [((1 << 62) + k, 10) for k in range(40)]
    d = exactdup.build_directory(spark.createDataFrame(keys, "key long, bytes long"), bucket_bytes=100)
    assert len({depth for _, depth in d.buckets}) > 1
    assert len(d.entries()) == 1 << d.depth
    assert [e for e, _ in d.entries()] == sorted(e for e, _ in d.entries())


def test_index_entries_read_back(odd_docs):
    groups, _, _ = exactdup.build_index(odd_docs)
    for r in groups.collect():
        import hashlib

        key, text = exactdup.read_entry(r["path"], r["at"])
        assert key == r["key"] & (1 << 64) - 1 and hashlib.sha256(text.encode()).hexdigest() == r["text_sha256"]


def test_colliding_keys_are_chained(spark):
    import tempfile

    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([0, 0, 0], pa.int32()), pa.array([-5, -5, -5], pa.int64()), pa.array(["x", "y", "x"]), pa.array([1, 1, 2], pa.int64()), pa.array([None, -1, 3], pa.int64())], names=["bucket", "key", "norm", "n", "top"])
    folder = tempfile.mkdtemp()
    files = [b for b in exactdup._owner(folder)(iter([batch]))]
    out = [r for b in exactdup._entries(folder)(iter(files)) for r in b.to_pylist()]
    assert [(r["key"], r["keep_id"], r["group_size"], r["position"]) for r in out] == [(-5, "3", 3, 0), (-5, "-1", 1, 1)]


@pytest.mark.parametrize("hot", [False, True])
def test_exact_dedup_of_text_ids_and_hot_texts(spark, hot, monkeypatch):
    if hot:
        monkeypatch.setattr(exactdup, "max", lambda a, b=0: 3 if a == 10_000 else max(a, b), raising=False)
    rows = [(f"k{i:02d}", "Same TEXT" if i % 3 else f"text {i}") for i in range(40)] + [(None, "same text"), (None, "alone")]
    got = exactdup.exact_dedup(spark.createDataFrame(rows, "doc_id string, text string").repartition(5)).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"]) for r in got), key=repr) == brute_exact(rows)


def test_rows_are_folded_across_batches():
    import pyarrow as pa

    one = pa.RecordBatch.from_arrays([pa.array([0] * 50, pa.int32()), pa.array([7] * 50, pa.int64()), pa.array(["x"] * 50), pa.array([1] * 50, pa.int64()), pa.array(range(50), pa.int64())], names=["bucket", "key", "norm", "n", "top"])
    out = [r for b in exactdup._fold(iter([one, one])) for r in b.to_pylist()]
    assert out == [{"bucket": 0, "key": 7, "norm": "x", "n": 100, "top": 49}]
