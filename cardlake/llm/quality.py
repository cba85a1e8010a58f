"""Quality classifier: supervised subword embeddings.

A text is its white-space separated words, case kept; a word equal to the one
before it counts as one fixed unit, so that repetition is a feature. A word's
vector is the mean of the learned vectors of its hashed features: the word
itself and its character 3- to 5-grams between ``<`` and ``>``. A document is the mean of its
words' vectors; a softmax layer gives the class. Vectors and layer are fitted
together by stochastic gradient descent in numpy, one document a step.

Defined cases: NULL and empty texts have a zero vector and get the score 0.5; repeated rows get equal scores; extra columns of the input
are kept by ``filtered`` and ignored by ``scores``; without labelled rows (or
with one class only) every score is that class's share (0.5 without any).
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.llm.common import CACHE_WORDS, claim_cache, id_remainder, in_groups, labelled_sample

BUCKET_BITS, DIM, GRAMS = 17, 8, (3, 4, 5)
BUCKETS = 1 << BUCKET_BITS
EPOCHS, RATE = 5, 0.5
SAMPLE_ROWS, SAMPLE_CHARS = 2500, 12_000
#: The unit that stands for a word equal to the one before it.
AGAIN = "\x00again"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed feature ids of all words, in no order, and the word that each belongs to."""
    joined = "".join([f"<{w}>" for w in words])
    c = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    start = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(words), dtype=np.int32), size)
    rolled, ids, owners = c, [], []
    for n in range(2, max(GRAMS) + 1):
        rolled = rolled[:-1] * np.uint64(1_000_003) + c[n - 1:]
        if n in GRAMS:
            inside = owner[:len(rolled)] == owner[n - 1:]
            ids.append(rolled[inside] + np.uint64(n))
            owners.append(owner[:len(rolled)][inside])
    place = np.arange(len(c)) - np.repeat(start, size)
    ids.append(np.add.reduceat(c * _powers(int(size.max()))[place], start))
    owners.append(np.arange(len(words), dtype=np.int32))
    mixed = np.concatenate(ids) * _MIX
    return ((mixed ^ (mixed >> np.uint64(29))) * _MIX >> np.uint64(64 - BUCKET_BITS)).astype(np.int32), np.concatenate(owners)


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.full(n, 0x100000001B3, np.uint64))


def units(text: str) -> list[str]:
    """A text's words, with ``AGAIN`` for each word that repeats the one before it."""
    words = text.split()
    return [w if w != last else AGAIN for w, last in zip(words, [None, *words], strict=False)]


@dataclass
class Model:
    """``logit``: what each hashed feature adds to the log-odds of label 1; ``bias``: for one class only."""

    logit: np.ndarray
    bias: float = 0.0

    def word_logits(self, words: list[str]) -> np.ndarray:
        out = [np.zeros(0)]
        for part in (words[k:k + 8000] for k in range(0, len(words), 8000)):  # arrays that stay in the CPU's cache
            ids, owners = word_features(part)
            out.append(np.bincount(owners, self.logit[ids], len(part)) / np.bincount(owners, minlength=len(part)))
        return np.concatenate(out)


def fit(sample: list[tuple[str, int]], seed: int = 7) -> Model:
    """Fit vectors and softmax layer on (text, label) pairs."""
    y = np.array([label for _, label in sample], np.int64)
    if len(set(y.tolist())) < 2:
        share = float(y.mean()) if len(y) else 0.5
        return Model(np.zeros(BUCKETS, np.float32), float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    docs = [document_features(text) for text, _ in sample]
    rng = np.random.default_rng(seed)
    vec = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    layer = np.zeros((DIM, 2), np.float32)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for k in rng.permutation(len(docs)):
            feature, weight = docs[k]
            own = vec[feature]
            hidden = weight @ own
            out = hidden @ layer
            p = np.exp(out - out.max())
            p /= p.sum()
            p[y[k]] -= 1
            back = layer @ p
            layer -= rate * np.outer(hidden, p)
            # a feature's step follows its share of the document, relative to the document's concentration
            vec[feature] = own - np.outer(weight * (rate / float(weight @ weight) * 0.1), back)
    return Model(vec @ (layer[:, 1] - layer[:, 0]))


def document_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of a document and the weight of each in the document's mean vector."""
    count = Counter(units(text) or [""])
    times = np.fromiter(count.values(), np.float64, len(count))
    ids, owners = word_features(list(count))
    share = times / times.sum() / np.bincount(owners, minlength=len(times))
    weight = np.bincount(ids, share[owners], BUCKETS)
    feature = np.flatnonzero(weight)
    return feature, weight[feature].astype(np.float32)


_CACHE: dict[str, float] = {}
_CACHE_OF: list = [None]


def text_scores(model: Model, texts: list[str], key: object) -> np.ndarray:
    """Probability of label 1 for each whole text; words are looked up in the worker's cache for model ``key``."""
    claim_cache(_CACHE.clear)
    if _CACHE_OF[0] != key or len(_CACHE) > CACHE_WORDS:
        _CACHE.clear()
        _CACHE_OF[0] = key
    split = [units(t) for t in texts]
    new = list({w for words in split for w in words}.difference(_CACHE))
    _CACHE.update(zip(new, model.word_logits(new).tolist(), strict=True))
    get = _CACHE.__getitem__
    mean = [sum(map(get, words)) / len(words) if words else 0.0 for words in split]
    return 1 / (1 + np.exp(-np.clip(np.array(mean) + model.bias, -60, 60)))


def trained(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, max_chars: int = SAMPLE_CHARS) -> Model:
    """Fit on the training part of ``labels.quality`` (crc32 of the id, modulo 3, is not 1)."""
    return fit(labelled_sample(docs.sparkSession, docs, labels, "quality", id_remainder("doc_id", 3) != 1, rows, max_chars))


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted for every document."""
    key = hash((model.bias, model.logit[::97].tobytes()))

    def rows(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        s = text_scores(model, texts, key)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                          ["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(in_groups(rows, "text"), "doc_id long, score double, predicted int")


def filtered(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that the classifier accepts, all columns."""
    key = hash((model.bias, model.logit[::97].tobytes()))

    def rows(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        return batch.filter(pa.array(text_scores(model, texts, key) >= 0.5))

    return docs.mapInArrow(in_groups(rows, "text"), docs.schema)
