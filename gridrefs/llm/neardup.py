"""Near-duplicate documents by MinHash.

A document's set holds its distinct five-word shingles (words end at ASCII white space, A-Z are
lower-cased). 128 universal hash functions give 128 minima; 32 bands of 4 minima make documents
candidates: at similarity 0.75 a pair shares no band with probability 5e-6. Candidates are first
compared by their signatures, with a margin of five standard deviations, then confirmed on the
words of both whole texts; a pair is linked if 100 * intersection >= 75 * union.

Documents with equal sets are folded to one representative before anything is compared. Within a
band's bucket all members are compared with the smallest member; members of one component need
no more comparing, since a further link can't change it. Only pairs of different components that
share a bucket are left. Their signatures are compared in tiles of bounded size, so a bucket never
meets in one task; a tile returns a spanning forest, and so do the tiles that then compare the
whole sets, as 64-bit shingle hashes, of each family of agreeing members: all pairs but those inside
the family's largest component. Tiles are bounded in members and in bytes. The forests' links are
confirmed on the words as well. (Two shingles of a pair of texts with n shingles share a hash with
probability n * n / 2^64; n_shingles counts hashes.) Pairs never become rows, and no candidate is
capped or dropped.

Cases: null, empty and white-space texts have an empty set, no links and their own id as
component; fewer than five words are one shingle; each repeated row is returned, with the
component of its own text, and rows that share an id but not the text share their links; null ids
get a null component and are kept; ids are integers; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .shared import TEXT_BATCH, by_bytes, drop, join_unique, stored, without

WORDS = 5
#: Linked if 100 * intersection >= PERCENT * union.
PERCENT = 75
HASHES, BANDS = 128, 32
#: Equal minima that a pair of signatures needs: five standard deviations below 0.75 * 128.
AGREE = 72
SEED = 20_240_229
#: Members, and bytes of their sets, that a side of a tile holds.
TILE = 512
TILE_BYTES = 32 << 20
#: Pairs of signatures that a task compares, or so.
TASK_PAIRS = 20_000_000
#: Words of a text that are hashed at a time, so that very long texts take bounded memory.
CHUNK_WORDS = 100_000

_random = np.random.default_rng(SEED)
_A = _random.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _random.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_STEP = 0x9E3779B97F4A7C15
_INVERSE = pow(_STEP, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Hasher:
    """64-bit hashes of word runs by sums of byte values times powers of an odd number."""

    def __init__(self) -> None:
        self.grow(1 << 17)

    def grow(self, n: int) -> None:
        self.up, self.down = _powers(_STEP, n), _powers(_INVERSE, n)

    def hashes(self, words: list[bytes]) -> np.ndarray:
        """Hash of each run of WORDS words; of the whole run if there are fewer."""
        data = np.frombuffer(b" ".join(words), np.uint8)
        if len(data) >= len(self.up):
            self.grow(2 * len(data))
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * self.up[: len(data)], out=total[1:])
        blanks = np.flatnonzero(data == 32)
        starts = np.concatenate(([0], blanks + 1))
        ends = np.concatenate((blanks, [len(data)]))
        k = min(WORDS, len(words))
        starts, ends = starts[: len(words) - k + 1], ends[k - 1 :]
        h = (total[ends] - total[starts]) * self.down[starts]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        return h


_hasher: _Hasher | None = None


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased; bytes.split and bytes.lower know only ASCII."""
    return (text or "").encode().lower().split()


def shingle_hashes(words: list[bytes]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a document's set."""
    global _hasher
    _hasher = _hasher or _Hasher()
    if not words:
        return np.zeros(0, np.uint64)
    step = CHUNK_WORDS
    parts = [_hasher.hashes(words[i : i + step + WORDS - 1]) for i in range(0, max(1, len(words) - WORDS + 1), step)]
    return np.unique(parts[0] if len(parts) == 1 else np.concatenate(parts))


def minima(hashes: np.ndarray) -> np.ndarray:
    """The HASHES minima, 32 bits each, of a set that is not empty."""
    out = None
    for i in range(0, len(hashes), 512):
        part = (hashes[i : i + 512, None] * _A + _B).min(axis=0)
        out = part if out is None else np.minimum(out, part)
    return (out >> np.uint64(32)).astype(np.uint32)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key a band."""
    rows = sig.reshape(BANDS, -1).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for c in range(rows.shape[1]):
        key = (key ^ rows[:, c]) * np.uint64(0x9FB21C651E98DF25)
        key ^= key >> np.uint64(31)
    return key.view(np.int64)


def shingles(text: str | None) -> set[tuple[bytes, ...]]:
    """The set of a document itself, for confirming links."""
    w = words_of(text)
    return set(zip(*(w[i:] for i in range(WORDS)), strict=False)) if len(w) >= WORDS else {tuple(w)} if w else set()


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    for batch in by_bytes(batches, 1):
        n, lo, hi, bands, sigs = [], [], [], [], []
        for text in batch.column(1).to_pylist():
            h = shingle_hashes(words_of(text))
            n.append(len(h))
            both = xxhash.xxh3_128_intdigest(h.tobytes())
            lo.append((both & (1 << 64) - 1) - (1 << 63))
            hi.append((both >> 64) - (1 << 63))
            if len(h):
                sig = minima(h)
                bands.append(band_keys(sig))
                sigs.append((sig & np.uint32(0xFFFF)).astype("<u2").tobytes())
            else:
                bands.append(None)
                sigs.append(None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(lo, pa.int64()), pa.array(hi, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(sigs, pa.binary())],
            names=["doc_id", "n_shingles", "set_lo", "set_hi", "bands", "sig"],
        )


def _agreeing(a: Column, b: Column) -> Column:
    """Whether two signatures agree in at least AGREE minima."""

    @F.pandas_udf("boolean")
    def agree(x: pd.Series, y: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=bool)
        p, q = (np.frombuffer(b"".join(s), "<u2").reshape(-1, HASHES) for s in (x, y))
        return pd.Series((p == q).sum(axis=1) >= AGREE)

    return agree(a, b)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last: tuple = (None, None, None)
    for batch in by_bytes(batches, 2):
        a_ids, b_ids, a_texts, b_texts = (c.to_pylist() for c in batch.columns)
        keep = []
        for b_id, x, y in zip(b_ids, a_texts, b_texts, strict=True):
            if last[:2] != (b_id, y):
                last = (b_id, y, shingles(y))
            s, t = shingles(x), last[2]
            both = len(s & t)
            keep.append(100 * both >= PERCENT * (len(s) + len(t) - both))
        yield pa.RecordBatch.from_arrays([pa.array(a_ids, pa.int64()), pa.array(b_ids, pa.int64())], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def confirm_links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) whose whole texts are similar enough. ``texts`` has one row (doc_id, text) for each id in the pairs.

    The text of a hub b moves once for each pair; adaptive execution splits its rows among tasks.
    """
    left = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    full = left.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    return full.select("a", "b", "text_a", "text_b").mapInArrow(_confirm, "a long, b long")


class _Forest:
    """Union-find over the numbers 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        """Whether x and y were apart until now."""
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _edges(rep: np.ndarray, pairs: list[tuple[int, int]]) -> pd.DataFrame:
    a, b = (np.array([rep[p[k]] for p in pairs], np.int64) for k in (0, 1))
    return pd.DataFrame({"a": np.maximum(a, b), "b": np.minimum(a, b)})


def _alike(buckets: DataFrame, pairs: int) -> DataFrame:
    """Edges that connect whatever members of a bucket, of different components, agree by signature.

    A bucket of n members is cut into ceil(n / TILE) parts; every two parts meet in one task as a
    tile. A tile returns a spanning forest of its agreeing pairs, at most an edge a member. All
    buckets hold so many ``pairs``; tiles are dealt to tasks by that, as their bytes say little.
    """

    def compare(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = int(key[2]), int(key[3])
        sig = np.frombuffer(b"".join(pdf["sig"]), "<u2").reshape(-1, HASHES)
        comp, part = pdf["comp"].to_numpy(), pdf["part"].to_numpy()
        x, y = np.flatnonzero(part == i), np.flatnonzero(part == j)
        forest, out = _Forest(len(pdf)), []
        for k in x:
            others = y[y > k] if i == j else y
            others = others[comp[others] != comp[k]]
            if len(others):
                hit = others[(sig[others] == sig[k]).sum(axis=1) >= AGREE]
                out += [(k, m) for m in hit.tolist() if forest.join(k, m)]
        return _edges(pdf["rep"].to_numpy(), out)

    members = buckets.withColumn("parts", F.expr(f"(n + {TILE - 1}) div {TILE}")).withColumn("part", F.expr("pmod(xxhash64(rep), parts)"))
    tiles = members.withColumn("other", F.explode(F.expr("sequence(0L, parts - 1)"))).withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other"))
    tasks = int(min(100_000, max(buckets.sparkSession.sparkContext.defaultParallelism, pairs // TASK_PAIRS)))
    dealt = tiles.select("band", "key", "i", "j", "rep", "comp", "sig", "part").repartition(tasks, "band", "key", "i", "j")
    return dealt.groupBy("band", "key", "i", "j").applyInPandas(compare, "a long, b long")


def _intersections(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets x with sets y, by products of 0/1 matrices of bounded size."""
    found, ids, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    place = np.cumsum(n > 1) - 1  # shingles of one member only meet nothing
    starts = np.cumsum([0, *(len(h) for h in sets)])
    own = [np.sort(place[k[n[k] > 1]]) for k in (ids[starts[i] : starts[i + 1]] for i in range(len(sets)))]
    out = np.zeros((len(x), len(y)), np.float32)
    width = 4096
    for low in range(0, int((n > 1).sum()), width):
        a, b = (np.zeros((len(side), width), np.float32) for side in (x, y))
        for m, side in ((a, x), (b, y)):
            for row, k in enumerate(side):
                m[row, own[k][np.searchsorted(own[k], low) : np.searchsorted(own[k], low + width)] - low] = 1
        out += a @ b.T
    return out


def _hash_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_bytes(batches, 4):
        sets = [shingle_hashes(words_of(t)).tobytes() for t in batch.column(4).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(sets, pa.binary())], names=[*batch.schema.names[:4], "hashes"])


def _links_in_families(members: DataFrame) -> DataFrame:
    """Links (a, b) between components of a family, enough to connect all that are linked.

    ``members``: family, rep, comp, is_big, hashes. Members outside a family's largest component
    meet each other and that component's members in tiles; the whole sets of all pairs of a tile
    are compared. The largest component is never compared with itself.
    """

    def compare(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        _, kind, i, j = key
        comp = pdf["comp"].to_numpy()
        sets = [np.frombuffer(h, np.uint64) for h in pdf["hashes"]]
        size = np.array([len(h) for h in sets])
        if kind == "U":
            x, y = np.flatnonzero(pdf["part"] == int(i)), np.flatnonzero(pdf["part"] == int(j))
        else:
            x, y = np.flatnonzero(~pdf["is_big"]), np.flatnonzero(pdf["is_big"])
        if not len(x) or not len(y):
            return _edges(comp, [])
        both = _intersections(sets, x, y)
        linked = (100 * both >= PERCENT * (size[x][:, None] + size[y][None, :] - both)) & (comp[x][:, None] != comp[y][None, :])
        _, number = np.unique(comp, return_inverse=True)
        forest, out = _Forest(number.max() + 1), []
        for p, q in np.argwhere(linked).tolist():
            if forest.join(int(number[x[p]]), int(number[y[q]])):
                out.append((x[p], y[q]))
        return _edges(pdf["rep"].to_numpy(), out)

    parts = lambda side: F.expr(f"greatest(1L, (n_{side} + {TILE - 1}) div {TILE}, (bytes_{side} + {TILE_BYTES - 1}) div {TILE_BYTES})")
    total = lambda name, value, cond: F.coalesce(F.sum(F.when(cond, value)), F.lit(0)).cast("long").alias(name)
    big, length = F.col("is_big"), F.octet_length("hashes")
    sizes = members.groupBy("family").agg(*[total(f"{n}_{side}", v, c) for side, c in (("u", ~big), ("v", big)) for n, v in (("n", F.lit(1)), ("bytes", length))])
    sizes = sizes.select("family", parts("u").alias("nu"), parts("v").alias("nv"))
    rows = members.join(sizes, "family").withColumn("part", F.expr("pmod(xxhash64(rep), if(is_big, nv, nu))"))
    among = F.transform(F.expr("sequence(0L, nu - 1)"), lambda q: F.struct(F.lit("U").alias("kind"), F.least(q, F.col("part")).alias("i"), F.greatest(q, F.col("part")).alias("j")))
    to_big = F.transform(F.expr("sequence(0L, nv - 1)"), lambda q: F.struct(F.lit("V").alias("kind"), F.col("part").alias("i"), q.alias("j")))
    to_rest = F.transform(F.expr("sequence(0L, nu - 1)"), lambda q: F.struct(F.lit("V").alias("kind"), q.alias("i"), F.col("part").alias("j")))
    tiles = rows.withColumn("tile", F.explode(F.when(big, to_rest).otherwise(F.concat(among, to_big)))).select("family", "tile.*", "rep", "comp", "part", "is_big", "hashes")
    return tiles.groupBy("family", "kind", "i", "j").applyInPandas(compare, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id, kept."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = stored(source.mapInArrow(_sign, "doc_id long, n_shingles long, set_lo long, set_hi long, bands array<long>, sig binary"), "minhash-signed", TEXT_BATCH)

    # One representative, the smallest id, for each set.
    sets = signed.where("n_shingles > 0 and doc_id is not null").groupBy("set_lo", "set_hi").agg(F.min("doc_id").alias("rep"), F.count("*").alias("members"))
    sets = stored(sets, "minhash-sets")
    reps = stored(
        signed.where("n_shingles > 0").select("doc_id", "set_lo", "set_hi", "bands", "sig").join(sets.select(F.col("rep").alias("doc_id"), "set_lo", "set_hi"), ["doc_id", "set_lo", "set_hi"]).dropDuplicates(["doc_id", "set_lo", "set_hi"]).select(F.col("doc_id").alias("rep"), "bands", "sig"),
        "minhash-reps",
    )

    # Buckets of more than one representative.
    members = reps.select("rep", F.posexplode("bands").alias("band", "key"))
    shared = members.groupBy("band", "key").agg(F.min("rep").alias("center"), F.count("*").alias("n")).where("n > 1")
    buckets = stored(members.join(shared, ["band", "key"]), "minhash-buckets")

    # First pass: members against the smallest of their bucket.
    sig = reps.select("rep", "sig")
    stars = buckets.where("rep <> center").select(F.col("rep").alias("a"), F.col("center").alias("b")).distinct()
    stars = stars.join(sig.select(F.col("rep").alias("a"), F.col("sig").alias("sig_a")), "a").join(sig.select(F.col("rep").alias("b"), F.col("sig").alias("sig_b")), "b")
    stars = stored(stars.where(_agreeing(F.col("sig_a"), F.col("sig_b"))).select("a", "b"), "minhash-stars")
    first = stars.groupBy("a").agg(F.min("b").alias("b"))
    links = stored(confirm_links(first, _texts_of(source, first)), "minhash-links", TEXT_BATCH)
    comps = stored(connected_components(links), "minhash-components")

    # Second pass: what shares a bucket, or is a star, across components.
    comp_of = lambda c: comps.select(F.col("node").alias(c), F.col("component").alias(f"comp_{c}"))
    left = stars.join(first, ["a", "b"], "left_anti").join(comp_of("a"), "a", "left").join(comp_of("b"), "b", "left").where(F.coalesce("comp_a", "a") != F.coalesce("comp_b", "b")).select("a", "b")
    with_comp = buckets.join(comps.select(F.col("node").alias("rep"), "component"), "rep", "left").select("band", "key", "rep", F.coalesce("component", "rep").alias("comp"))
    mixed = with_comp.groupBy("band", "key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.count("*").alias("n")).where("c0 <> c1").select("band", "key", "n")
    mixed = stored(mixed, "minhash-mixed")
    pairs = mixed.agg(F.sum(F.col("n") * F.col("n") / 2).alias("p")).first()["p"] or 0
    across = _alike(with_comp.join(mixed, ["band", "key"]).join(sig, "rep"), int(pairs))
    # Families hold all pairs that are left; their whole texts decide.
    families = stored(connected_components(left.unionByName(across)), "minhash-families")
    members = families.select(F.col("node").alias("rep"), F.col("component").alias("family")).join(comps.select(F.col("node").alias("rep"), "component"), "rep", "left").select("family", "rep", F.coalesce("component", "rep").alias("comp"))
    biggest = members.groupBy("family", "comp").agg(F.count("*").alias("n")).groupBy("family").agg(F.max(F.struct("n", "comp")).getField("comp").alias("big"))
    members = members.join(biggest, "family").select("family", "rep", "comp", (F.col("comp") == F.col("big")).alias("is_big"))
    members = members.join(source.select(F.col("doc_id").alias("rep"), "text"), "rep").select("family", "rep", "comp", "is_big", "text")
    members = stored(members.mapInArrow(_hash_sets, "family long, rep long, comp long, is_big boolean, hashes binary"), "minhash-members", TEXT_BATCH)
    forests = stored(_links_in_families(members).distinct(), "minhash-forests")
    more = stored(confirm_links(forests, _texts_of(source, forests)), "minhash-more", TEXT_BATCH)
    final = stored(connected_components(links.unionByName(more)), "minhash-final")

    # Sets to components, documents to sets.
    by_set = stored(sets.join(final.select(F.col("node").alias("rep"), "component"), "rep", "left").select("set_lo", "set_hi", "members", F.coalesce("component", "rep").alias("component_id")), "minhash-by-set")
    rows = stored(signed.select("doc_id", "n_shingles", "set_lo", "set_hi"), "minhash-rows")
    drop(signed, sets, reps, buckets, stars, links, comps, mixed, families, members, forests, more, final)
    linked = rows.where("n_shingles > 0 and doc_id is not null")
    alone = rows.where("not (n_shingles > 0 and doc_id is not null)").withColumn("component_id", F.col("doc_id"))
    out = join_unique(linked, by_set, ["set_lo", "set_hi"], "members", rows.count()).select("doc_id", "n_shingles", "component_id")
    return out.unionByName(alone.select("doc_id", "n_shingles", "component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _texts_of(source: DataFrame, pairs: DataFrame) -> DataFrame:
    """(doc_id, text) of the documents in pairs."""
    wanted = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    return source.join(wanted, "doc_id", "left_semi")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without those that have a near-duplicate of smaller id."""
    return without(docs, [F.col(id_col)], near_duplicates(docs, id_col, text_col).where("not kept").select("doc_id"))
