"""Decontamination, quality, personal data, URL filters, mixing: brute force and awkward rows."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gridrefs.llm import decontam, mixing, pii, quality, shared, urlfilter

DATA = "/root/testdata/sf0.001"


def brute_similar(text, item):
    words, own = (text or "").encode().lower().split(), (item or "").encode().lower().split()
    k = min(5, len(own))
    if not own:
        return 0.0
    grams = lambda w: [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]
    want, have, n, best = Counter(grams(own)), grams(words), len(own) - k + 1, 0.0
    for i in range(len(have)):
        got = Counter(have[i : i + n])
        both = sum(min(v, want[g]) for g, v in got.items())
        best = max(best, both / (sum(got.values()) + n - both))
    return best


@pytest.mark.parametrize("limit", [None, 0])
def test_decontamination_equals_brute_force(spark, limit, monkeypatch):
    if limit is not None:  # the joins shuffle narrow rows
        monkeypatch.setattr(shared, "BROADCAST_ROWS", limit)
    item = " ".join(f"b{i}" for i in range(30))
    edited, other = item.replace("b14", "zz"), " ".join(f"c{i}" for i in range(12))
    rows = [(0, f"start {item} end"), (1, f"some {edited} words after"), (2, " ".join(item.split()[:20])), (3, "to be or not"), (4, "hey to be OR not to be"), (5, None), (6, ""), (7, "re " * 40), (8, item.upper()), (8, item), (9, " ".join(item.split()[3:])), (10, "all other words here and there"), (11, other), (None, other), (None, "a clean text without any of them"), (12, item), (12, "a clean text of the same id")]
    bench = [(1, item), (2, "To be or not"), (3, None), (4, ""), (5, "re " * 20), (6, item), (None, other), (7, other)]
    docs, items = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontam.contaminated(docs, items).collect()}
    want = defaultdict(float)
    for d, t in rows:
        for i, b in bench:
            want[d, i] = max(want[d, i], brute_similar(t, b))
    assert got == {k: round(v, 6) for k, v in want.items() if v >= 0.75}
    clean = [(d, t) for d, t in rows if all(brute_similar(t, b) < 0.75 for _, b in bench)]
    assert sorted(map(tuple, decontam.remove_contaminated(docs, items).collect()), key=repr) == sorted(clean, key=repr)


def test_copies_of_items_are_searched_once(spark, monkeypatch):
    kept, real = {}, decontam.stored
    monkeypatch.setattr(decontam, "stored", lambda df, name: kept.setdefault(name, real(df, name)))
    item = " ".join(f"b{i}" for i in range(30))
    docs = spark.createDataFrame([(0, f"start {item} end"), (1, "clean")], "doc_id long, text string")
    got = decontam.contaminated(docs, spark.range(800).select(F.col("id").alias("item_id"), F.lit(item).alias("text"))).collect()
    assert sorted(tuple(r) for r in got) == [(0, i, 1.0) for i in range(800)]
    assert kept["benchmark-index"].count() == decontam.BLOCKS * 37  # values within two bits of one item's blocks


def test_large_frames_are_not_broadcast(spark):
    many = shared.stored(spark.range(0, shared.BROADCAST_ROWS + 1, numPartitions=1).select((F.col("id") % 9).alias("k"), F.lit("v").alias("v")), "test-many")
    rows = spark.range(3).select(F.col("id").alias("k"))
    plan = lambda df: rows.join(shared.maybe_broadcast(df), "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan(many) and "BroadcastHashJoin" in plan(many.where("k = 1"))


def test_decontamination_of_nothing(odd_docs, no_docs, spark):
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontam.contaminated(odd_docs, bench.where("false")).count() == 0
    assert decontam.contaminated(no_docs, bench).count() == 0
    assert decontam.contaminated(odd_docs, bench).count() == 0
    assert decontam.remove_contaminated(odd_docs, bench).columns == odd_docs.columns


def test_blocks_guarantee_the_radius():
    assert decontam.RADIUS < decontam.BLOCKS * (decontam.NEAR + 1)


def test_simhash_is_the_majority(spark):
    hashes = [0b1011, 0b0011, 0b0110 - (1 << 63)]
    got = spark.createDataFrame([(hashes,)], "h array<long>").select(decontam.simhash(F.col("h")).alias("p")).first()["p"]
    assert got == 0b0011


def test_simhash_of_very_many_hashes(spark):
    n = 70_000
    some = spark.range(1).select(F.expr(f"transform(sequence(1, {n}), i -> if(i % 3 = 0, 5L, 6L))").alias("h"))
    assert some.select(decontam.simhash(F.col("h")).alias("p")).first()["p"] == 6
    most = spark.range(1).select(F.expr(f"transform(sequence(1, {n}), i -> -1L)").alias("h"))
    assert most.select(decontam.simhash(F.col("h")).alias("p")).first()["p"] == -1


def test_samples_of_hot_keys(spark):
    hot = spark.range(20_000).select(F.when(F.col("id") < 19_000, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    got = shared.hash_sample(hot, "k", 100).collect()
    assert len(got) == 100 == len({r["k"] for r in got}) and got == shared.hash_sample(hot, "k", 100).collect()
    one = spark.range(5000).select(F.lit(3).alias("k"), (F.col("id") % 9).alias("v"))
    assert [tuple(r) for r in shared.hash_sample(one, "k", 100).collect()] == [(3, 0)]
    assert shared.hash_sample(one.where("false"), "k", 100).count() == 0


def test_quality_tells_held_out_labels(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    scored = quality.score(docs, quality.fit(quality.labelled_texts(docs, labels))).select("doc.doc_id", "score")
    rows = scored.join(labels, "doc_id").where(quality.held_out(F.col("doc_id"))).select("quality", "score").collect()
    good = [r["score"] >= quality.THRESHOLD for r in rows if r["quality"] == 1]
    bad = [r["score"] < quality.THRESHOLD for r in rows if r["quality"] == 0]
    assert sum(good) / len(good) > 0.985 and sum(bad) / len(bad) > 0.93
    # Area under the curve: pairs of a good and a bad text in the right order.
    pairs = [(g["score"] > b["score"]) + (g["score"] == b["score"]) / 2 for g in rows if g["quality"] == 1 for b in rows if b["quality"] == 0]
    assert sum(pairs) / len(pairs) > 0.99
    # Calibration: scores and labels agree on average in tenths of the rows.
    rows.sort(key=lambda r: r["score"])
    tenths = [rows[k * len(rows) // 10 : (k + 1) * len(rows) // 10] for k in range(10)]
    gaps = [abs(sum(r["score"] - r["quality"] for r in t)) / len(t) for t in tenths]
    assert sum(gaps) / 10 < 0.03


def test_quality_scores_follow_the_sizes_of_whole_texts(odd_docs, spark):
    import math

    import zstandard

    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    model = quality.fit(quality.labelled_texts(odd_docs, labels))
    packs = [zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d), level=quality.LEVEL, write_content_size=False, write_dict_id=False) for d in (model.good, model.bad)]
    for r in quality.score(odd_docs, model).select("doc.text", "score").collect():
        raw = (r["text"] or "").encode()
        good, bad = (sum(len(p.compress(raw[i : i + quality.PART])) for i in range(0, len(raw), quality.PART)) for p in packs)
        diff, length = 20 * (bad - good) / max(1, len(raw)), min(1, len(raw) / quality.FULL)
        z = sum(w * x for w, x in zip(model.weights, (diff, diff * length, length, 1), strict=True))
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, z)))))


def test_quality_is_learnt_from_long_texts_too(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE_CHARS", 1000)
    rows = [("good words of a fine story " * 100, 1), ("bad 0101 $$$ " * 300, 0), ("good words here " * 200, 1), (None, 0)]
    model = quality.fit(spark.createDataFrame(rows, "text string, label int"))
    assert model is not None and len(quality.predict(model, ["good words", "bad $$$"], 2)) == 2


def test_query_of_quality_has_fold_and_threshold(spark):
    import zlib

    from gridrefs.llm.queries import QUERIES

    for r in QUERIES["op2_quality"](spark, DATA).collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def test_quality_of_odd_rows(odd_docs, no_docs, spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    model = quality.fit(quality.labelled_texts(odd_docs, labels))
    rows = quality.score(odd_docs, model).select("doc.doc_id", "score").collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    empty = {r["score"] for r in rows if r["doc_id"] in (3, 4)}
    assert len(empty) == 1
    assert {r["score"] for r in quality.score(odd_docs, None).select("score").collect()} == {0.5}
    assert quality.score(no_docs, model).count() == 0
    assert quality.keep_good(odd_docs, labels).columns == odd_docs.columns


def brute_spans(text):
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(d):
        total = 0
        for i, c in enumerate(reversed(d)):
            x = int(c) * (1 + i % 2)
            total += x - 9 * (x > 9)
        return total % 10 == 0

    checks = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    ]
    return {k: [(m.start(), m.end()) for m in re.finditer(p, text) if ok(m[0])] for k, p, ok in checks}


PII = [
    "mail a.b+c@x.example.com, and d@e.f_g@h.i or @x.y z@nodot 🙂 q@r.s",
    "1.2.3.4.5.6.7.8 999.1.1.1 01.002.3.255 1.2.3",
    "4539 1488 0343 6467 and 4539-1488-0343-6467 12 4539148803436468 4539  1488",
    "call +1 (212) 555-0100 or +44 20 7946 0958, +1 2 +123456789012345678",
    "IBAN: GB82 WEST 1234 5698 7654 32, bank DE89370400440532013000, DE00370400440532013000",
    'token = "9233a8ecf7c5b09fe594", password: hunter2hunter2',
    "account number 123456789 is mine" + " " * 60 + "order 987654321 came",
    None,
    "",
    "a" * 50_000 + "@" + "b." * 20_000,
    "7 " * 30_000 + "." * 1000,
    "+" + "1(" * 30_000,
]


def test_personal_data_equals_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(PII)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in pii.personal_data(docs).collect()}
    for i, text in enumerate(PII):
        want = brute_spans(text)
        r = rows[i]
        assert {k: r[f"n_{k}"] for k in want} == {k: len(v) for k, v in want.items()}, text and text[:60]
        joined = ",".join(f"{k}:{a}:{b}" for k, v in want.items() for a, b in v)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))
    assert rows[4]["spans"].count("iban:") == 2
    assert "secret:" in rows[5]["spans"] and "account:15:24" in rows[6]["spans"] and rows[6]["spans"].count("account:") == 1


def test_personal_data_of_whole_tables(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for r in pii.personal_data(docs).join(docs, "doc_id").collect():
        joined = ",".join(f"{k}:{a}:{b}" for k, v in brute_spans(r["text"]).items() for a, b in v)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
    assert pii.personal_data(odd_docs).count() == odd_docs.count()
    assert pii.personal_data(no_docs).count() == 0


ZEROS = ["0.0.0.0 and 10.0.0.1, 127.000.0.1", "8.8.8.0 192.168.0.1 0.0.0.256 1000.0.0.1 00255.0.010.0300", "0" * 4000 + ".0.0." + "0" * 4000 + " 0.0.0." + "0" * 4000 + "256"]


def test_ip_parts_of_zeros_equal_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(ZEROS)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in pii.personal_data(docs).collect()}
    for i, text in enumerate(ZEROS):
        want = brute_spans(text)
        assert rows[i]["n_ip"] == len(want["ip"])
        joined = ",".join(f"{k}:{a}:{b}" for k, v in want.items() for a, b in v)
        assert rows[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
    assert [rows[i]["n_ip"] for i in range(3)] == [3, 2, 1]
    long = spark.createDataFrame([(0, "0" * 200_000 + ".0.0." + "0" * 200_000)], "doc_id long, text string")
    assert pii.personal_data(long).first()["n_ip"] == 1


def test_long_secrets_are_whole(spark):
    tokens = ["aB3_" * 75, "x9/+" * 50_000]
    docs = spark.createDataFrame([(i, f"my token: {t} end") for i, t in enumerate(tokens)], "doc_id long, text string")
    spans = {r["doc_id"]: r["spans"] for r in pii.personal_data(docs).collect()}
    for i, t in enumerate(tokens):
        assert f"secret:3:{10 + len(t)}" in spans[i].split(",")
    assert {r["text"] for r in pii.redact(docs).collect()} == {"my <secret> end"}


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "write to a@b.cd now"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert got == {1: "write to <email> now", 2: None}


URLS = ["http://A.Example.NET/en/x?y=1", "https://example.net/en", "http://example.com/de/1", "http://x.org/fr/", "http://net/", "http://net.org/fr/?q", "nothing", None, "", "http://example.com?x/de/", "ftp://b.net#://q/en/", "http://notexample.net/en/1", "http://xexample.com/de/"]


def brute_rule(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = re.search(r"[/?#]", rest)
        host = rest[: cut.start()] if cut else rest
        path = re.split(r"[?#]", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for verdict, rule in urlfilter.RULES:
        at, start = rule.split("/", 1)
        if (host == at or host.endswith("." + at)) and path.startswith("/" + start) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    return host, path, best


def test_url_rules_equal_brute_force(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    rows = {r["page_id"]: r for r in urlfilter.filter_urls(pages).collect()}
    assert len(rows) == len(URLS)
    for i, url in enumerate(URLS):
        host, path, best = brute_rule(url)
        r = rows[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, best and best[1]), url
        assert r["verdict"] == (best[0] if best else r["verdict"]) and r["verdict"] in ("allow", "block")
    assert urlfilter.filter_urls(pages.where("false")).count() == 0


def test_trees_learn_labelled_urls(spark):
    good = [f"https://site{i}.example.org/articles/story-{i}" for i in range(200)]
    bad = [f"http://x{i}-{i * 7919}.biz/{i * 104729}?a={i}&b={i * 3}&c=9" for i in range(200)]
    rows = [(u, 0) for u in good] + [(u, 1) for u in bad]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id long, url string")
    train = spark.createDataFrame(rows[::2], "url string, label int")
    got = {r["page_id"]: r["verdict"] for r in urlfilter.filter_urls(pages, train, rules=()).collect()}
    right = [got[i] == ("block" if label else "allow") for i, (_, label) in enumerate(rows) if i % 2]
    assert sum(right) / len(right) > 0.97


def test_trees_block_hosts_like_those_of_the_seed_words(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    words = tuple(w for w in urlfilter.SEED_WORDS if w not in ("pills", "adult"))
    host = urlfilter.host_and_path(F.col("url"))[0]
    train = urlfilter.seed_labels(pages.where((F.crc32(host) % 5 != 0) & ~host.rlike("cheap-pills|adult-x")), words)
    rows = urlfilter.filter_urls(pages, train).where("rule is null").collect()
    unseen = [r for r in rows if "cheap-pills" in r["host"] or "adult-x" in r["host"]]
    seeded = [r for r in rows if set(re.split("[.-]", r["host"])) & set(words)]
    clean = [r for r in rows if r not in unseen and r not in seeded]
    blocked = lambda x: sum(r["verdict"] == "block" for r in x) / len(x)
    assert blocked(unseen) > 0.9 and blocked(seeded) > 0.9 and blocked(clean) < 0.02  # rules alone: 0, 0, 0


def test_expressions_equal_the_models_predictions(spark):
    url = lambda i: f"http://x{i % 9}-{i * 7919}.s{i % 5}/{i * 104729}?a={i}" if i % 3 else f"https://site.s{i % 4}/story/of/day-{i}"
    rows = spark.createDataFrame([(url(i), float(i % 3 > 0)) for i in range(200)], "url string, label double")
    host, path = urlfilter.host_and_path(F.col("url"))
    rows = rows.select("label", *urlfilter.lexical(F.col("url"), host, path), F.lit(0.25).alias("suffix_rate"), F.rand(3).alias("suffix_freq")).cache()
    model = urlfilter._fit(rows)
    from pyspark.ml.feature import VectorAssembler

    ready = VectorAssembler(inputCols=list(urlfilter.FEATURES), outputCol="features").transform(rows)
    for r in model.transform(ready).withColumn("own", urlfilter.probability(urlfilter._trees(model))).select("own", "probability").collect():
        assert r["own"] == pytest.approx(r["probability"][1], abs=1e-9)


def test_urls_of_odd_rows(spark):
    long = "http://long.example.com/" + "a1" * 100_000
    rows = [(1, "http://casino.example.com/x", "c", "d"), (1, "http://casino.example.com/x", "c", "d"), (None, "http://casino.example.com/x", "c", "d"), (2, long, "c", "d"), (3, None, None, None), (4, "", "c", "d")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, score string")
    got = urlfilter.filter_urls(pages).collect()
    assert len(got) == len(rows) and len({(r["host"], r["verdict"]) for r in got if r["page_id"] in (1, None)}) == 1
    assert {r["host"] for r in got if r["page_id"] in (3, 4)} == {""}


def test_every_suffix_counts(spark):
    # 400 suffixes that are alike but for their labels; the old table held the 200 commonest.
    url = lambda k, i: f"https://site.example.s{k:03d}/story-{i:03d}"
    train = spark.createDataFrame([(url(k, i), k % 2) for k in range(400) for i in range(10)], "url string, label int")
    pages = spark.createDataFrame([(k, url(k, 900)) for k in range(400)], "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in urlfilter.filter_urls(pages, train, rules=()).collect()}
    assert [got[k] for k in range(400)] == ["allow", "block"] * 200


def test_repeated_urls_leave_the_others_in_the_sample(spark, monkeypatch):
    monkeypatch.setattr(urlfilter, "SAMPLE_URLS", 200)
    rows = [(f"https://site{i}.example.org/articles/story-{i}", 0) for i in range(60)] + [(f"http://x{i}-{i * 7919}.biz/{i * 104729}?a={i}&b={i * 3}", 1) for i in range(60)]
    urls = spark.createDataFrame(rows, "url string, label int")
    first = urls.orderBy(F.xxhash64("url")).first()
    train = urls.unionByName(spark.range(500).select(F.lit(first["url"]).alias("url"), F.lit(first["label"]).alias("label")))
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in urlfilter.filter_urls(pages, train, rules=()).collect()}
    assert sum(got[i] == ("block" if label else "allow") for i, (_, label) in enumerate(rows)) > 115


def test_joined_suffixes_equal_broadcast_ones(spark, monkeypatch):
    rows = [(f"https://h{i}.s{i % 30}/p{i}", int(i % 30 > 20)) for i in range(300)]
    pages = spark.createDataFrame([(i, f"https://h.s{i % 40}/q{i}") for i in range(80)] + [(99, None)], "page_id long, url string")
    train = spark.createDataFrame(rows, "url string, label int")
    want = sorted(urlfilter.filter_urls(pages, train, rules=()).collect())
    monkeypatch.setattr(urlfilter, "BROADCAST_ROWS", 0)
    assert sorted(urlfilter.filter_urls(pages, train, rules=()).collect()) == want and len(want) == 81


def brute_targets(sizes, weights, total, cap):
    target = {s: 0.0 for s in sizes}
    free, left = set(sizes), total
    while free:
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = {s for s in free if share[s] > cap * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        free -= over
    return target


def test_mixing(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = mixing.mix_sizes(docs).collect()
    sizes, words = Counter(), {r["doc_id"]: len(r["text"].encode().split()) for r in docs.collect()}
    for r in rows:
        assert r["size"] == words[r["doc_id"]]
        sizes[r["source"]] += r["size"]
    weights = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(sorted(sizes))}
    want = brute_targets(sizes, weights, 1.5 * sum(sizes.values()), 2)
    taken, longest = Counter(), Counter()
    for r in rows:
        assert r["target"] == pytest.approx(want[r["source"]]) and 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= longest[s] / 2 + 1
    taken_of = lambda: sorted((r["doc_id"], r["taken"]) for r in mixing.mix_sizes(docs).collect())
    assert taken_of() == sorted((r["doc_id"], r["taken"]) for r in rows)
    turns = Counter(r["doc_id"] for r in mixing.sample_mix(docs).select("doc_id").collect())
    assert all(turns[r["doc_id"]] == r["times"] for r in rows)
    out = mixing.mix_sizes(odd_docs)
    assert out.count() == odd_docs.count() and out.where("source is null").first()["size"] == 0
    assert mixing.sample_mix(odd_docs).columns == odd_docs.columns
    assert mixing.mix(no_docs).count() == 0 and mixing.mix_sizes(no_docs).count() == 0
