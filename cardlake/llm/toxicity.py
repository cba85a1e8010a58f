"""Toxicity: a subsequence string-kernel support vector machine on Nyström features.

A text is cut into sentences (one of over ``PIECE`` tokens into pieces of that
length) and a sentence into its set of lower-case tokens without ASCII
punctuation; a run of single-character tokens counts as one token, so
spaced-out insults are seen too. Two tokens are compared by the gap-weighted subsequence kernel: every
subsequence of three characters (a token begins with two marks) that spans at
most ``SPAN`` characters counts,
with weight ``DECAY`` to the power of its span, normalised to 1 for equal
tokens and raised to ``POWER``. Gapped, padded and suffixed forms of a word
stay close to it. A sentence's kernel is the sum over
its distinct tokens.

The kernel is approximated from ``LANDMARKS`` landmark tokens (Nyström: the
landmark similarities, whitened by the landmarks' own kernel matrix), and a
linear support vector machine is trained on the sentences of labelled
documents: at most ``SAMPLE_ROWS`` of them, of at most ``SAMPLE_CHARS``
characters, and of a clean one at most 40 distinct sentences, drawn by a
seeded generator (the fit alone; every sentence of every document is scored).
A clean document's sentences are all clean. Of a toxic document
only the document is known to be toxic, so its sentences get their labels in
rounds: at first those with a token unknown to clean documents, then those
that the machine itself finds toxic, the best one at least. A document's
score is a logistic function of its three most toxic sentences and its length,
since a long clean text meets an insult's likeness by chance.

Defined cases: NULL, empty and punctuation-only texts have no token and get
the least margin; repeated rows get equal scores; extra
columns are kept by ``filtered`` and ignored by ``scores``; without labelled
rows of both classes every score is 0.
"""

from __future__ import annotations

import re
import string
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.llm.common import CACHE_WORDS, claim_cache, id_remainder, in_groups, labelled_sample

SPAN, DECAY, POWER = 7, 0.7, 3
LANDMARKS, ROUNDS, EPOCHS, PIECE = 96, 3, 6, 32
SAMPLE_ROWS, SAMPLE_CHARS = 3500, 12_000
#: Marks a token's beginning, so that common beginnings weigh more than common middles.
START = "<<"
#: The least margin that counts: that of a sentence without tokens, or of one that is not there.
FLOOR = -2.0
_SENTENCE = re.compile(r"[.!?]*\s*\n\s*|[.!?]+\s+")
_DROP = re.compile(f"[{re.escape(string.punctuation)}]+")
_BASE = np.uint64(1_000_003)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def tokens(sentence: str) -> list[str]:
    """Tokens of a sentence without punctuation; runs of single characters are joined."""
    words = sentence.split()
    if min(map(len, words), default=2) > 1:
        return words
    out, run = [], ""
    for w in words:
        if len(w) == 1:
            run += w
            continue
        if run:
            out.append(run)
            run = ""
        out.append(w)
    return [*out, run] if run else out


def sentences_of(text: str) -> list[set[str]]:
    """The token sets of a text's sentences, long ones in pieces; one empty set for a text without tokens."""
    out = []
    for s in _DROP.sub("", _SENTENCE.sub("\n", text).lower()).split("\n"):
        own = tokens(s)
        if len(own) <= PIECE:
            out.append(set(own))
        else:
            out += [set(own[k:k + PIECE]) for k in range(0, len(own), PIECE)]
    return [s for s in out if s] or [set()]


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code, weight and owner of every three-character subsequence within ``SPAN``; a code may repeat."""
    c = np.frombuffer("".join([START + w for w in words]).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(words), dtype=np.int32), [len(w) + len(START) for w in words])
    codes, weights, owners = [], [], []
    for far in range(2, SPAN):
        if far >= len(c):
            break
        inside = np.flatnonzero(owner[:-far] == owner[far:])
        ends = c[inside] * _BASE + c[inside + far]
        for mid in range(1, far):
            codes.append((ends * _BASE + c[inside + mid]) * _MIX)
            weights.append(np.full(len(inside), DECAY ** (far + 1)))
            owners.append(owner[inside])
    if not codes:
        return np.zeros(0, np.uint64), np.zeros(0), np.zeros(0, np.int32)
    return np.concatenate(codes), np.concatenate(weights), np.concatenate(owners)


def merged(codes: np.ndarray, weights: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal codes of one owner added up."""
    order = np.argsort((owners.astype(np.uint64) << np.uint64(44)) | (codes >> np.uint64(20)))  # 44 bits tell a token's codes apart
    codes, weights, owners = codes[order], weights[order], owners[order]
    first = np.flatnonzero(np.r_[True, (codes[1:] != codes[:-1]) | (owners[1:] != owners[:-1])][:len(codes)])
    return codes[first], np.add.reduceat(weights, first) if len(first) else weights, owners[first]


class Kernel:
    """Normalised kernel of tokens to fixed landmark tokens."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        codes, weights, owners = merged(*subsequences(landmarks))
        norm = np.sqrt(np.bincount(owners, weights * weights, len(landmarks)))
        order = np.argsort(codes, kind="stable")
        self.codes, self.first, self.number = np.unique(codes[order], return_index=True, return_counts=True)
        self.seen = np.zeros(1 << 16, bool)  # of the codes' first 16 bits, to pass over most others at once
        self.seen[self.codes >> np.uint64(48)] = True
        # the landmarks that hold a code, and its weight in each
        self.holder, self.weight = owners[order].astype(np.int64), (weights / norm[owners])[order]

    def part(self, words: list[str]) -> np.ndarray:
        n, width = len(words), len(self.landmarks)
        codes, weights, owners = subsequences(words)
        hit = np.flatnonzero(self.seen[codes >> np.uint64(48)])
        at = np.searchsorted(self.codes, codes[hit]).clip(0, len(self.codes) - 1)
        known = self.codes[at] == codes[hit]
        hit, at = hit[known], at[known]
        number = self.number[at]
        each = np.repeat(np.arange(len(hit)), number)  # a row for each hit and landmark that holds its code
        entry = self.first[at][each] + np.arange(len(each)) - np.repeat(np.cumsum(number) - number, number)
        out = np.bincount(owners[hit][each] * width + self.holder[entry], weights[hit][each] * self.weight[entry], n * width).reshape(n, width)
        near = np.zeros(n, bool)
        near[owners[hit]] = True
        mine = near[owners]  # only these tokens' norms are needed
        _, w, o = merged(codes[mine], weights[mine], owners[mine])
        out[near] /= np.sqrt(np.bincount(o, w * w, n))[near, None]
        return out * out * out if POWER == 3 else out ** POWER

    def __call__(self, words: list[str], combine: np.ndarray | None = None) -> np.ndarray:
        """One row per token; with ``combine``, its product with that vector or matrix."""
        width = [len(self.landmarks)] if combine is None else list(combine.shape[1:])
        if not len(self.codes):
            return np.zeros([len(words), *width])
        parts = (self.part(words[k:k + 2000]) for k in range(0, len(words), 2000))  # one at a time in memory
        return np.concatenate([(p if combine is None else p @ combine).astype(np.float32) for p in parts] or [np.zeros([0, *width])])


@dataclass
class Model:
    """A token adds ``kernel(token) @ beta``; a sentence's margin is the sum plus ``bias``; ``weights`` give a document's score."""

    landmarks: list[str]
    beta: np.ndarray
    bias: float
    weights: np.ndarray

    def margins(self, documents: list[list[set[str]]], of: dict[str, float]) -> list[np.ndarray]:
        """Each document's sentence margins, from its tokens' margins ``of``."""
        get = of.__getitem__
        return [np.array([sum(map(get, s), self.bias) if s else FLOOR for s in own]) for own in documents]

    def token_margins(self, words: list[str]) -> np.ndarray:
        if not hasattr(self, "_kernel"):
            self._kernel = Kernel(self.landmarks)
        return self._kernel(words, self.beta)


def svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rng: np.random.Generator, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Linear support vector machine by averaged subgradient steps over mini-batches; y is -1 or 1."""
    w, b = np.zeros(x.shape[1]), 0.0
    mean_w, mean_b, n = np.zeros_like(w), 0.0, 0
    for epoch in range(EPOCHS):
        for part in np.array_split(rng.permutation(len(y)), max(1, len(y) // 64)):
            rate = 0.5 / (1 + 0.02 * n) ** 0.5
            miss = part[y[part] * (x[part] @ w + b) < 1]
            step = (cost * y)[miss] if len(miss) else np.zeros(0)
            w = w * (1 - rate * decay) + rate / 16 * (step @ x[miss] if len(miss) else 0)
            b += rate / 16 * step.sum()
            n += 1
            if epoch >= EPOCHS // 2:
                mean_w, mean_b = mean_w + w, mean_b + b
    kept = max(1, n - n * (EPOCHS // 2) // EPOCHS)
    return mean_w / kept, mean_b / kept


def fit(sample: list[tuple[str, int]], seed: int = 11) -> Model | None:
    """Fit on (text, label) pairs of documents; None without both classes."""
    if len({label for _, label in sample}) < 2:
        return None
    rng = np.random.default_rng(seed)
    distinct = list(dict.fromkeys(sample))
    shared: dict[str, str] = {}  # one copy of each token
    split = [[{shared.setdefault(t, t) for t in s} for s in sentences_of(text)] for text, _ in distinct]
    label = np.array([y for _, y in distinct])
    in_toxic, in_clean = Counter(), Counter()
    for own, y in zip(split, label, strict=True):
        (in_toxic if y else in_clean).update(set().union(*own))
    odd = Counter({t: n for t, n in in_toxic.items() if n >= 3 and len(t) >= 3 and n > 20 * in_clean[t]})
    landmarks = landmark_tokens(odd, in_clean, rng)
    kernel = Kernel(landmarks)
    near = kernel(landmarks)
    value, vector = np.linalg.eigh((near + near.T) / 2 + 1e-4 * np.eye(len(landmarks)))
    whiten = vector / np.sqrt(np.maximum(value, 1e-3))
    words = sorted(in_toxic.keys() | in_clean.keys())
    place = {t: k for k, t in enumerate(words)}
    per_token = kernel(words, whiten)
    sentences: list[np.ndarray] = []
    bag: list[int] = []
    for k, own in enumerate(split):
        kept = [np.array(sorted(place[t] for t in s), np.int32) for s in dict.fromkeys(map(frozenset, own)) if s]
        if not label[k] and len(kept) > 40:  # clean sentences are plenty
            kept = [kept[j] for j in rng.choice(len(kept), 40, replace=False)]
        sentences += kept
        bag += [k] * len(kept)
    owner, truth = np.array(bag), label[bag]
    x = np.concatenate([np.add.reduceat(per_token[np.concatenate(some)], np.cumsum([0, *map(len, some[:-1])]))
                        for some in (sentences[k:k + 1000] for k in range(0, len(sentences), 1000))])
    toxic = np.array([any(words[t] in odd for t in s) for s in sentences]) & (truth == 1)
    for _ in range(ROUNDS):
        y = np.where(toxic, 1.0, -1.0)
        doubtful = (truth == 1) & ~toxic  # a toxic document's other sentences teach nothing
        cost = np.where(toxic, (~toxic & ~doubtful).sum() / max(1, toxic.sum()) * 0.3, 1.0) * ~doubtful
        w, b = svm(x, y, np.minimum(cost, 10), rng)
        margin = x @ w + b
        best = np.full(len(split), -np.inf)
        np.maximum.at(best, owner, margin)
        toxic = (truth == 1) & ((margin > 0) | (margin == best[owner]))
    model = Model(landmarks, whiten @ w, b, np.zeros(5))
    margins = model.margins(split, dict(zip(words, (per_token @ w).tolist(), strict=True)))
    model.weights = logistic(document_features(margins), label)
    return model


def landmark_tokens(odd: Counter, clean: Counter, rng: np.random.Generator) -> list[str]:
    """Half the landmarks from tokens tied to toxic documents, spread by their kernel; the rest from clean ones, most of them
    those that resemble the toxic landmarks."""
    pool = [t for t, _ in sorted(odd.items(), key=lambda x: (-x[1], x[0]))[:800]]
    chosen: list[str] = []
    if pool:
        # the next landmark is the most frequent token that no earlier one resembles
        like = Kernel(pool)(pool)
        best = np.zeros(len(pool))
        weight = np.array([odd[t] for t in pool], float)
        while len(chosen) < min(LANDMARKS // 2, len(pool)):
            k = int(np.argmax(weight * (1 - best.clip(0, 1)) ** 2))
            if best[k] >= 0.999:
                break
            chosen.append(pool[k])
            best = np.maximum(best, like[:, k])
    rest = sorted(t for t in clean if len(t) >= 3 and t not in odd)
    if rest and chosen:
        near = Kernel(chosen)(rest).max(axis=1) * np.log1p([clean[t] for t in rest])
        chosen += [rest[k] for k in np.argsort(-near, kind="stable")[:LANDMARKS // 3]]
    rest = [t for t in rest if t not in set(chosen)]
    if rest:
        p = np.array([clean[t] for t in rest], float)
        chosen += [rest[k] for k in rng.choice(len(rest), min(LANDMARKS - len(chosen), len(rest)), replace=False, p=p / p.sum())]
    return chosen or ["aaa"]


def document_features(margins: list[np.ndarray]) -> np.ndarray:
    """The three largest sentence margins, clipped, the logarithm of the number of sentences, and 1."""
    out = np.ones((len(margins), 5))
    for k, m in enumerate(margins):
        top = np.sort(m)[::-1][:3]
        out[k, :3] = np.clip(np.r_[top, np.full(3 - len(top), FLOOR)], FLOOR, -FLOOR)
        out[k, 3] = np.log(len(m))
    return out


def logistic(x: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression by Newton steps with a small ridge; a toxic document counts twice."""
    w, own = np.zeros(x.shape[1]), 1.0 + label
    ridge = np.diag([*[1.0] * (x.shape[1] - 1), 1e-3])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= np.linalg.solve((x * (own * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (own * (p - label)) + ridge @ w)
    return w


_CACHE: dict[str, float] = {}
_CACHE_OF: list = [None]


def text_scores(model: Model | None, texts: list[str], key: object) -> np.ndarray:
    """Score of each whole text; token margins are looked up in the worker's cache for model ``key``."""
    if model is None:
        return np.zeros(len(texts))
    claim_cache(_CACHE.clear)
    if _CACHE_OF[0] != key or len(_CACHE) > CACHE_WORDS:
        _CACHE.clear()
        _CACHE_OF[0] = key
    split = [sentences_of(t) for t in texts]
    new = list(set().union(*(s for own in split for s in own)).difference(_CACHE))
    _CACHE.update(zip(new, model.token_margins(new).tolist(), strict=True))
    return 1 / (1 + np.exp(-np.clip(document_features(model.margins(split, _CACHE)) @ model.weights, -60, 60)))


def trained(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, max_chars: int = SAMPLE_CHARS) -> Model | None:
    """Fit on the training part of ``labels.toxic`` (crc32 of the id, modulo 5, is not 0)."""
    return fit(labelled_sample(docs.sparkSession, docs, labels, "toxic", id_remainder("doc_id", 5) != 0, rows, max_chars))


def _key(model: Model | None) -> int:
    return 0 if model is None else hash((tuple(model.landmarks), model.bias, model.beta.tobytes(), model.weights.tobytes()))


def scores(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score, predicted for every document."""
    key = _key(model)

    def rows(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        s = text_scores(model, texts, key)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                          ["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(in_groups(rows, "text"), "doc_id long, score double, predicted int")


def filtered(docs: DataFrame, model: Model | None) -> DataFrame:
    """The documents that the classifier does not find toxic, all columns."""
    key = _key(model)

    def rows(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        return batch.filter(pa.array(text_scores(model, texts, key) < 0.5))

    return docs.mapInArrow(in_groups(rows, "text"), docs.schema)
