"""Periodic runs, best-fit packing and whitening against brute force."""

from __future__ import annotations

import functools
import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import documents, no_documents, texts

from cardlake.llm import packing, periodic, queries, whitening

SF = "/root/testdata/sf0.001"


# -- periodic runs ---------------------------------------------------------------------------------------------------

def brute_lyndon(s):
    """By definition: the longest beginning that is less than all its rotations' tails."""
    out = []
    for i in range(len(s)):
        out.append(max(m for m in range(1, len(s) - i + 1) if all(s[i:i + m] < s[i + k:i + m] for k in range(1, m))))
    return out


def brute_runs(w):
    n, found = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q) and not any(w[i:i + q] == w[i:i + d] * (q // d) for d in range(1, q) if q % d == 0):
                found.append((i, j - i + q, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def texts_with_runs(count, seed):
    rng = random.Random(seed)
    for _ in range(count):
        w = []
        while len(w) < rng.randint(0, 60):
            root = rng.choices("abc", k=rng.randint(1, 6))
            w += root * rng.randint(1, 7) + root[:rng.randint(0, len(root))]
        yield w


def test_lyndon_arrays():
    rng = random.Random(2)
    for k in range(600):
        s = [rng.randrange(1 + k % 4) for _ in range(rng.randint(0, 24))]
        s = np.unique(s, return_inverse=True)[1].tolist() if s else []
        assert periodic.lyndon_array(s) == brute_lyndon(s), s


def test_runs_equal_brute_force():
    total = 0
    for w in texts_with_runs(1500, 3):
        want = brute_runs(w)
        total += len(want)
        assert periodic.runs_of_words(w) == want, w
        drop = {k for s, m, q in want for k in range(s + q, s + m)}
        assert periodic.collapsed(w, want) == " ".join(x for k, x in enumerate(w) if k not in drop)
    assert total > 1000


def test_a_long_periodic_text_is_one_run():
    root = [str(k) for k in range(700)]
    assert periodic.runs_of_words(["x", *root * 30, "y"]) == [(1, 21_000, 700)]
    assert periodic.runs_of_words(["a"] * 50_000) == [(0, 50_000, 1)]
    fib = ["a"], ["a", "b"]
    for _ in range(14):
        fib = fib[1], fib[1] + fib[0]
    assert periodic.runs_of_words(fib[1]) == []  # exponents stay under 4


def digest(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_runs_query_equals_brute_force(spark):
    rows = queries.op11_periodic_runs(spark, SF).collect()
    given = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(given)
    for r in rows:
        w = periodic.words_of(given[r.doc_id] or "")
        h = zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        want = brute_runs(w) if len(w) < 3000 else periodic.runs_of_words(w)
        best = min(((-m, s, q) for s, m, q in want), default=None)
        assert r.n_runs == len(want)
        assert (r.start, r.length, r.period, r.exponent_milli) == ((best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4)
        assert r.runs_sha256 == digest("".join(f"{s},{m},{q}\n" for s, m, q in want))
        drop = {k for s, m, q in want for k in range(s + q, s + m)}
        assert r.collapsed_sha256 == digest(" ".join(x for k, x in enumerate(w) if k not in drop))
    assert sum(r.n_runs for r in rows) > 5


def test_runs_defined_cases(spark):
    rows = periodic.periodic_runs(documents(spark)).collect()
    assert len(rows) == len(texts()) + 3
    assert all(r.runs == [] and r.collapsed == "" for r in rows if r.doc_id in (0, 1, 2))
    assert periodic.periodic_runs(no_documents(spark)).count() == 0


# -- packing ---------------------------------------------------------------------------------------------------------

@functools.cache
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.default_tokenizer())


def library(text):
    return tokenizer().encode(text, add_special_tokens=False).ids


def test_words_encode_as_whole_texts():
    rng = random.Random(7)
    symbols = ["a", "B", "the", " ", "  ", "\n", "\r\n", "\t", "é", "é", "́", "İ", "Σ", "ς", "<|endoftext|>", "<|startoftext|>", "<|", "'s", "'S", "'",
               "漢", "😀", "\x00", "12", "½", "\x1c", "\x85", "\xa0", " ", "!!", "ﬁ", "가", "ᄀ", "ᅡ", "x" * 70]
    own = packing.WordEncoder(packing.default_tokenizer())
    some = ["".join(rng.choices(symbols, k=rng.randint(0, 25))) for _ in range(4000)] + [t or "" for t in texts()]
    some += ["".join(rng.choices(symbols[:8] + ["é", "É", "ß", "'s", "'S", "'", "12", "!!", "-", "x" * 70], k=rng.randint(0, 25))) for _ in range(4000)]
    for _ in range(2):
        for t, ids in zip(some, own.encode(some), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == library(t), repr(t[:80])
    assert max(map(len, [*own.words, *own.cuts])) <= packing.CACHED_CHARS


def check_places(rows, size):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= size
    return len(bins)


def test_bins_are_bounded_best_fit():
    rng = random.Random(8)
    for most in (1, 3, 20):
        bins, model, made = packing.Bins(100, most), [], 0
        for _ in range(3000):
            n = rng.choice([rng.randint(1, 100), rng.randint(1, 12)])
            got, at = bins.put(n)
            room = [x for x in model if x[0] >= n]  # (free, own), the last changed at the end
            if room:
                least = min(x[0] for x in room)
                free, own = [x for x in model if x[0] == least][-1]
                model.remove((free, own))
            else:
                if len(model) == most:
                    least = min(x[0] for x in model)
                    model.remove([x for x in model if x[0] == least][-1])
                free, own = 100, made
                made += 1
            assert (got, at) == (own, 100 - free)
            if free > n:
                model.append((free - n, own))
            assert bins.open == len(model) <= most


def test_packing_query(spark):
    rows = queries.op12_best_fit(spark, "/root/testdata/sf0.01").collect()
    given = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    assert by_doc.keys() == given.keys()
    for doc, own in by_doc.items():
        ids = [*library(given[doc] or ""), 1]
        own.sort(key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // 4096)))
        for r in own:
            part = ids[r.start:r.start + r.length]
            assert r.start == 4096 * r.piece and len(part) == r.length and r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        assert sum(r.length for r in own) == len(ids)
    bins = check_places(rows, 4096)
    assert bins <= 1 + math.ceil(sum(r.length for r in rows) / 4096)


def test_packed_sequences_hold_the_ids(spark):
    docs = documents(spark)
    rows = packing.packed(packing.pieces(docs, size=256, keep=("ids",)), size=256, task_pieces=9)
    made = packing.sequences(rows).collect()
    want = defaultdict(list)
    for t in [*texts(), texts()[4], texts()[4], "no id"]:
        want[tuple([*library(t or ""), 1])].append(t)
    parts = defaultdict(list)
    for s in made:
        flat = np.frombuffer(bytes(s.ids), "<u4").tolist()
        assert len(flat) == s.length <= 256
        for p in s.pieces:
            parts[p.doc_id].append((p.piece, flat[p.offset:p.offset + p.length]))
    for k, t in enumerate(texts()):
        if k != 4:  # stands three times
            assert [i for _, x in sorted(parts[k]) for i in x] == [*library(t or ""), 1]
    assert len(parts[4]) == 3 and sum(len(p) for p in parts.values()) == rows.count()
    assert check_places(rows.collect(), 256) == len(made)
    assert packing.packed(packing.pieces(no_documents(spark))).count() == 0


def test_one_id_or_none_is_dealt_out(spark):
    docs = spark.range(4000).selectExpr("if(id % 3 = 0, null, 7) as doc_id", "'same text' as text")
    rows = packing.packed(packing.pieces(docs), task_pieces=100)
    tasks = rows.selectExpr("shiftright(sequence_id, 40) as task").groupBy("task").count().collect()
    assert len(tasks) == 40 and max(r["count"] for r in tasks) < 160 and sum(r["count"] for r in tasks) == 4000


# -- whitening -------------------------------------------------------------------------------------------------------

def reference(vectors, most=32):
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    total = [sum(r[k] for r in x) for k in range(d)]
    y = [[n * r[k] - total[k] for k in range(d)] for r in x]
    v = np.array([[sum(r[a] * r[b] for r in y) / n ** 3 for b in range(d)] for a in range(d)])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:most], u[:, ::-1][:, :most]
    return n, [sum(c * c for c in r) for r in y], np.array(y, float) / n @ u / np.sqrt(e), e / np.trace(v)


def test_whitening_query(spark):
    rows = queries.op13_whitening(spark, SF).collect()
    given = sorted((r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect())
    n, deviation, want, explained = reference([v for _, v in given])
    assert len(rows) == n * 32 and {r.n for r in rows} == {n}
    place = {k: i for i, (k, _) in enumerate(given)}
    got = np.zeros((n, 32))
    for r in rows:
        i = place[r.vec_id]
        assert r.deviation == deviation[i] and abs(r.explained / explained[r.component - 1] - 1) < 1e-9
        got[i, r.component - 1] = r.whitened
    signs = np.sign((got * want).sum(axis=0))
    assert np.abs(got - want * signs).max() < 1e-6
    assert {r.identity_error for r in rows} and max(r.identity_error for r in rows) < 1e-9


def test_polarised_covariance_is_exact(spark):
    rng = random.Random(11)
    vectors = [[rng.choice([rng.gauss(0, 3), 1e13, -7e12, 0.0]) for _ in range(5)] for _ in range(60)]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(7)
    own = whitening.usable(df, "embedding", "vec_id")
    n, total = whitening.totals(own)
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    assert (n, total) == (60, [sum(r[k] for r in x) for k in range(5)])
    y = [[n * r[k] - total[k] for k in range(5)] for r in x]
    assert whitening.squares(own, n, total) == {(a, b): sum((r[a] + (r[b] if a != b else 0)) ** 2 for r in y) for a in range(5) for b in range(a, 5)}


def test_whitening_defined_cases(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, 3.0], 1), (1, [1.0, 2.0, 3.0], 1), (None, [0.5, -2.0, 3.0], 2), (2, None, 1), (3, [1.0, None, 2.0], 1), (4, [nan, 1.0, 1.0], 1),
            (5, [inf, 1.0, 1.0], 1), (6, [], 1), (7, [1.0], 1), (8, [1e300, 0.0, 0.0], 1), (9, [4.0, 1.0, 3.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, whitened int")
    out, fitted, error = whitening.whiten(df)
    got = out.collect()
    assert sorted((r.vec_id or 0) for r in got) == [0, 1, 1, 9] and fitted.n == 4 and error < 1e-9
    assert all(len(r.whitened) == 3 and r.whitened[2] is None and None not in r.whitened[:2] for r in got)  # the third entry is the same in all
    n, deviation, _, explained = reference([v for i, v, _ in rows if i in (1, None, 9)])
    assert sorted(int(r.deviation) for r in got) == sorted(deviation) and fitted.explained()[:2] == pytest.approx(list(explained[:2]))
    same, fitted, error = whitening.whiten(df.where("vec_id = 1"))
    assert [r.whitened for r in same.collect()] == [[None] * 3] * 2 and error is None and fitted.explained() == [None] * 3
    assert whitening.whiten(df.where("false"))[0].count() == 0
    spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    assert queries.op13_whitening(spark, str(tmp_path)).count() == 0  # a table without usable rows
