"""URL filters: allow and block rules first, then gradient-boosted trees on lexical features.

Features of a URL: length, path depth, share of digits, character entropy, parameters, labels of
the host, longest host label, hyphens, and statistics of the host's suffix (smoothed share of
blocked URLs and frequency among the labelled). The trees are trained from labelled URLs on a
bounded sample. Without a labelled table, a short list of seed words labels the URLs: one whose host
has such a word is bad, the others count as good; the trees see no words, so they also block hosts
that are built like those. The trained trees are turned into SQL expressions, so that scoring all
URLs is one scan without a shuffle. Suffixes are counted over all distinct labelled URLs and joined
by their counts; only the trees' sample is bounded.

Cases: a null URL or one without ``://`` has empty host and path, fits no rule and is scored like
any other; without labels of both kinds every other URL is allowed; of rules that fit, the longest
text wins, at equal length the one with the longer host, then the smaller text; repeated rows give
repeated results; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import BROADCAST_ROWS, drop, hash_sample, join_unique, let, lower_ascii, stored

#: (verdict, rule): a rule is a host, a slash and the path's start without its leading slash.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

#: Distinct labelled URLs that the trees are trained on, chosen by a hash of the URL.
SAMPLE_URLS = 10_000
TREES, DEPTH, SEED = 12, 3, 7
#: Score from which a URL without a rule is blocked.
THRESHOLD = 0.5
FEATURES = ("length", "depth", "digit_ratio", "entropy", "params", "labels", "longest", "hyphens", "suffix_rate", "suffix_freq")
#: Words of hosts that label a URL as bad where there is no labelled table.
SEED_WORDS = ("adult", "ads", "bet", "bets", "casino", "pills", "poker", "porn", "spam", "viagra", "xxx")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; empty where there is no ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    has = F.coalesce(F.contains(url, F.lit("://")), F.lit(False))
    part = lambda n: F.when(has, F.regexp_extract(url, pattern, n)).otherwise("")
    return lower_ascii(part(1)), part(2)


def apply_rules(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """Struct (rule, verdict) of the rule that wins, or null. The rules are a short list of parameters."""
    by_host: dict[str, list[tuple[str, str, str]]] = {}
    for verdict, rule in rules:
        at, _, start = rule.partition("/")
        by_host.setdefault(at.lower(), []).append(("/" + start, rule, verdict))
    if not by_host:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    # The winner sorts first: longest rule, then longest host, then the smaller text.
    entry = lambda p, r, v: F.struct(F.lit(-len(r)).alias("a"), F.lit(-r.index("/")).alias("b"), F.lit(r).alias("rule"), F.lit(p).alias("path"), F.lit(v).alias("verdict"))
    known = F.create_map(*[x for at, own in by_host.items() for x in (F.lit(at), F.array(*[entry(*o) for o in own]))])
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fitting = F.filter(F.flatten(F.filter(F.transform(suffixes, lambda s: F.element_at(known, s)), lambda x: x.isNotNull())), lambda r: F.startswith(path, r["path"]))
    return let(F.array_min(fitting), lambda best: F.when(best.isNotNull(), F.struct(best["rule"].alias("rule"), best["verdict"].alias("verdict"))))


def _entropy(text: Column) -> Column:
    """Bits a character."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    n = F.size(chars)
    each = F.transform(F.array_distinct(chars), lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / F.length(text))
    return F.when(n > 0, F.aggregate(each, F.lit(0.0), lambda a, p: a - p * F.log2(p))).otherwise(0.0)


def lexical(url: Column, host: Column, path: Column) -> list[Column]:
    """The lexical features, without the statistics of the suffix."""
    text = F.coalesce(url, F.lit(""))
    n = F.length(text)
    query = F.regexp_extract(text, r"(?s)\?([^#]*)", 1)
    labels = F.split(host, r"\.")
    return [
        n.cast("double").alias("length"),
        F.size(F.filter(F.split(path, "/"), lambda p: p != "")).cast("double").alias("depth"),
        F.when(n > 0, F.regexp_count(text, F.lit("[0-9]")) / n).otherwise(0.0).alias("digit_ratio"),
        _entropy(text).alias("entropy"),
        F.when(query != "", F.regexp_count(query, F.lit("&")) + 1).otherwise(0).cast("double").alias("params"),
        F.size(labels).cast("double").alias("labels"),
        F.array_max(F.transform(labels, F.length)).cast("double").alias("longest"),
        F.regexp_count(host, F.lit("-")).cast("double").alias("hyphens"),
    ]


def suffix(host: Column) -> Column:
    """A host's last label."""
    return F.substring_index(host, ".", -1)


def suffix_stats(labelled: DataFrame) -> DataFrame:
    """(suffix, n, bad): labelled URLs and blocked ones of each suffix, from distinct (suffix, label, ..)."""
    return labelled.groupBy("suffix").agg(F.count("*").alias("n"), F.sum(F.col("label").cast("long")).alias("bad"))


def _rate_and_freq(n: int, bad: int) -> list[Column]:
    """Smoothed block rate and frequency of a suffix with (n, bad), of which there are so many over all."""
    rate = (F.col("bad") + 5 * bad / n) / (F.col("n") + 5)
    return [F.coalesce(rate, F.lit(bad / n)).alias("suffix_rate"), F.coalesce(F.col("n") / n, F.lit(0.0)).alias("suffix_freq")]


def _sample(urls: DataFrame) -> DataFrame:
    """At most SAMPLE_URLS distinct labelled URLs by a hash of the URL; half of each label if that would leave only one."""
    sample = hash_sample(urls, "url", SAMPLE_URLS)
    if sample.select("label").distinct().count() < 2:
        sample = hash_sample(urls.where("label = '0'"), "url", SAMPLE_URLS // 2).unionByName(hash_sample(urls.where("label = '1'"), "url", SAMPLE_URLS // 2))
    return sample


def seed_labels(urls: DataFrame, words: tuple[str, ...] = SEED_WORDS) -> DataFrame:
    """(url, label) of URLs with a host: 1 if a part of the host, between full stops and hyphens, is a seed word."""
    host, _ = host_and_path(F.col("url"))
    rows = urls.select("url", host.alias("host")).where("host <> ''")
    return rows.select("url", F.arrays_overlap(F.split("host", "[.-]"), F.lit(list(words))).cast("int").alias("label"))


def _fit(ready: DataFrame):
    """The boosted trees' model of (FEATURES, label)."""
    ready = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(ready).select("features", "label")
    return GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=SEED, maxBins=32).fit(ready)


def _trees(model) -> list[tuple[float, object]]:
    """(weight, tree) of a model."""
    return [(w, _tree(t._call_java("rootNode"))) for t, w in zip(model.trees, model.treeWeights, strict=True)]


def probability(trees: list[tuple[float, object]]) -> Column:
    """Probability of label 1 by the trees, from columns named as FEATURES."""
    margin = sum((F.lit(w) * _expression(t) for w, t in trees), F.lit(0.0))
    return 1 / (1 + F.exp(-2 * margin))


def train(labelled: DataFrame) -> tuple[list[tuple[float, object]], DataFrame, int, int] | None:
    """Trees with weights, (suffix, n, bad), and n and bad over all, from (url, label 0 or 1: block); None without both labels.

    Repeated rows count once. The suffixes are counted over all labelled URLs; the sample is for the
    trees alone.
    """
    host, path = host_and_path(F.col("url"))
    urls = stored(labelled.where("url is not null and label is not null").select("url", F.col("label").cast("int").cast("string").alias("label")).distinct(), "urls")
    stats = stored(suffix_stats(urls.select(suffix(host).alias("suffix"), "label")), "suffixes")
    total = stats.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    n, bad = total["n"] or 0, total["bad"] or 0
    if not 0 < bad < n:
        drop(urls, stats)
        return None
    sample = _sample(urls).select("url", F.col("label").cast("double").alias("label"), host.alias("host"), path.alias("path"))
    sample = sample.select("label", suffix(F.col("host")).alias("suffix"), *lexical(F.col("url"), F.col("host"), F.col("path")))
    sample = sample.coalesce(1).cache()  # bounded; one partition makes the trees the same at each run
    known = stats.join(F.broadcast(sample.select("suffix").distinct()), "suffix")  # at most as many as sampled URLs
    ready = sample.join(F.broadcast(known), "suffix", "left").select("*", *_rate_and_freq(n, bad))
    trees = _trees(_fit(ready))
    sample.unpersist()
    drop(urls)
    return trees, stats, n, bad


def _tree(node) -> object:
    """A JVM tree node as nested (feature, threshold, left, right) or a leaf's value."""
    if node.getClass().getSimpleName() == "LeafNode":
        return float(node.prediction())
    split = node.split()
    return (int(split.featureIndex()), float(split.threshold()), _tree(node.leftChild()), _tree(node.rightChild()))


def _with_stats(rows: DataFrame, stats: DataFrame, n: int, bad: int) -> DataFrame:
    """``rows`` with ``suffix_rate`` and ``suffix_freq`` of their ``suffix``; the table is broadcast if it is counted to be small."""
    sizes = rows.groupBy("suffix").agg(F.count("*").alias("suffix_size"))
    groups = stored(sizes.join(stats, "suffix", "left").select("suffix", "suffix_size", *_rate_and_freq(n, bad)), "suffixes")
    total = groups.agg(F.sum("suffix_size").alias("size"), F.count("*").alias("groups"), F.sum(F.length("suffix")).alias("chars")).first()
    if total["groups"] <= BROADCAST_ROWS and (total["chars"] or 0) <= 50 * BROADCAST_ROWS:
        return rows.join(F.broadcast(groups), "suffix")
    return join_unique(rows, groups, ["suffix"], "suffix_size", total["size"])


def _expression(tree: object) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    i, threshold, left, right = tree
    return F.when(F.col(FEATURES[i]) <= threshold, _expression(left)).otherwise(_expression(right))


def filter_urls(pages: DataFrame, labelled: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """One row a page: page_id, host, path, rule, verdict, score.

    ``labelled`` has url and label (1: block); without it, seed words label the pages' own URLs.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).select("page_id", "url", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("hit", apply_rules(F.col("host"), F.col("path"), rules))
    model = train(seed_labels(rows) if labelled is None else labelled)
    if model is None:
        scored = rows.withColumn("score", F.lit(0.0))
    else:
        trees, stats, n, bad = model
        rows = _with_stats(rows.withColumn("suffix", suffix(F.col("host"))), stats, n, bad)
        drop(stats)
        rows = rows.select("*", *lexical(F.col("url"), F.col("host"), F.col("path")))
        scored = rows.withColumn("score", probability(trees))
    return scored.select(
        "page_id",
        "host",
        "path",
        F.col("hit.rule").alias("rule"),
        F.coalesce(F.col("hit.verdict"), F.when(F.col("score") >= THRESHOLD, "block").otherwise("allow")).alias("verdict"),
        F.round("score", 6).alias("score"),
    )
