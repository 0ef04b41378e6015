"""Quality classifier by compression with two zstandard dictionaries.

One dictionary is trained on good, one on bad labelled texts. A text costs fewer bytes with the
dictionary of its own kind, so the difference of both sizes, over the text's length, tells the
kinds apart. Whole texts are compressed, in parts of ``PART`` bytes, each on its own: a dictionary
says little about the rest of a long text, which refers to itself. A logistic curve, fitted on
labelled texts that the dictionaries have not seen, turns the difference into a score; as a short
text's difference says less, the curve's slope and offset change with length up to ``FULL`` bytes.
Nothing else than the two sizes and the length enters.

The fit takes a bounded sample: at most ``SAMPLE_DOCS`` labelled texts of each class and
``SAMPLE_CHARS`` characters of them together, chosen by a hash among whole texts (the shortest one
if no text is that short). Every second one trains its dictionary, the others the curve. Scoring
covers all rows and whole texts, without a shuffle.

Cases: null and empty texts get the curve's value at zero difference and length; rows with other labels
than 0 and 1 are not learnt from; without labels of both classes the score is 0.5; repeated rows
get equal scores; an empty table gives an empty result; other columns pass through by struct.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import drop, hash_sample, stored

SAMPLE_DOCS = 800
SAMPLE_CHARS = 8_000_000
DICTIONARY_BYTES = 112 << 10
LEVEL = 3
THRESHOLD = 0.3
#: Bytes that are compressed at a time, and bytes from which the curve no longer changes with length.
PART, FULL = 1000, 500


@dataclass(frozen=True)
class Model:
    """Dictionaries of good and bad text, and the curve over :func:`features`."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]


def _train(texts: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself serves
        return b"\n".join(texts)[-DICTIONARY_BYTES:]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=data, write_content_size=False, write_dict_id=False)


def sizes(text: bytes, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> tuple[int, int, int]:
    """Bytes of a text's parts with either dictionary, and of the text."""
    parts = [text[i : i + PART] for i in range(0, len(text), PART)]
    return sum(len(good.compress(p)) for p in parts), sum(len(bad.compress(p)) for p in parts), len(text)


def features(texts: Iterable[bytes], good: bytes, bad: bytes) -> np.ndarray:
    """For each text: size difference over length, the same damped for short texts, length up to FULL, and 1."""
    a, b = _compressor(good), _compressor(bad)
    size = np.array([sizes(t, a, b) for t in texts], float).reshape(-1, 3)
    diff = 20 * (size[:, 1] - size[:, 0]) / np.maximum(size[:, 2], 1)
    length = np.minimum(1.0, size[:, 2] / FULL)
    return np.stack([diff, diff * length, length, np.ones(len(diff))], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Newton's method with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w = w + np.linalg.solve(h, x.T @ (y - p) - 1e-2 * w)
    return tuple(w.tolist())


def fit(labelled: DataFrame, text_col: str = "text", label_col: str = "label") -> Model | None:
    """Fit on (text, label 0 or 1); None where a class has no text."""
    texts: dict[int, list[bytes]] = {}
    rows = stored(labelled.select(F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label"), F.xxhash64(text_col).alias("hash")).where("text is not null"), "quality-sample")
    for label in (0, 1):
        own = rows.where(F.col("label") == label)
        lengths = [(r["hash"], r["n"]) for r in own.groupBy("hash").agg(F.max(F.length("text")).alias("n")).orderBy("hash").limit(SAMPLE_DOCS).collect()]
        chosen, held = [], 0
        for h, n in lengths:
            if held + n <= SAMPLE_CHARS:
                chosen.append(h)
                held += n
        chosen = chosen or [h for h, _ in sorted(lengths, key=lambda x: x[1])[:1]]
        texts[label] = [r["text"].encode() for r in own.where(F.col("hash").isin(chosen)).groupBy("hash").agg(F.min("text").alias("text")).orderBy("hash").collect()]
    drop(rows)
    if not (texts[0] and texts[1]):
        return None
    good, bad = _train(texts[1][::2]), _train(texts[0][::2])
    rest = [(t, label) for label in (0, 1) for t in texts[label][1::2] or texts[label]]
    x, y = features([t for t, _ in rest], good, bad), np.array([label for _, label in rest], float)
    return Model(good, bad, _logistic(x, y))


def predict(model: Model | None, texts: Iterable[str | None], n: int) -> np.ndarray:
    """Scores of n texts between 0 and 1; higher: label 1 likelier."""
    if model is None:
        return np.full(n, 0.5)
    x = features(((t or "").encode() for t in texts), model.good, model.bad)
    return 1 / (1 + np.exp(-np.clip(x @ np.array(model.weights), -30, 30)))


def score(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` as struct ``doc`` with its score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of bounded size

    @F.arrow_udf("double")
    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in texts:  # one text at a time leaves Arrow's memory
            yield pa.array(predict(shared.value, (x.as_py() for x in part), len(part)), pa.float64())
        pa.default_memory_pool().release_unused()

    return docs.select(F.struct("*").alias("doc"), scored(F.col(text_col)).alias("score"))


def held_out(id_col: Column, folds: int = 5) -> Column:
    """Whether a document is in the fold that is never learnt from."""
    return F.coalesce(F.crc32(id_col.cast("string")) % folds == 0, F.lit(False))


def labelled_texts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(text, label) of a bounded sample of labelled documents outside the held-out fold.

    The sample is drawn from the labels, SAMPLE_DOCS of each class, so that it is broadcast and the
    documents don't move.
    """
    known = labels.where(~held_out(F.col(id_col))).select(F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("label"))
    chosen = hash_sample(known.where("label = 1"), "label_id", SAMPLE_DOCS).unionByName(hash_sample(known.where("label = 0"), "label_id", SAMPLE_DOCS))
    texts = docs.select(F.col(id_col).alias("text_id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(chosen), F.col("text_id") == F.col("label_id")).select("text", "label")


def keep_good(docs: DataFrame, labels: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Documents whose score is at least the threshold."""
    return score(docs, fit(labelled_texts(docs, labels)), text_col).where(F.col("score") >= threshold).select("doc.*")
