"""SimHash near duplicates, benchmark windows and fingerprints against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from helpers import BENCH, DOCS, ITEM, SHORT_ITEM, documents, no_documents, texts

from cardlake.llm import decontaminate, golay, queries, simhash, syncmers


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


# --- SimHash ------------------------------------------------------------

def brute_fingerprint(t):
    words = re.findall("[^\x20\x09-\x0D]+", lower(t))
    grams = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    bits = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for b in range(64):
            bits[b] += h >> b & 1
    return sum((2 * bits[b] > len(grams)) << b for b in range(64)) if grams else 0


def brute_components(fps, ids, distance=3):
    root = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance and root[i] != root[j]:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    least = {}
    for r, k in zip(root, ids, strict=True):
        if k is not None:
            least[r] = min(least.get(r, k), k)
    return [least.get(r) for r in root]


def test_golay_code():
    w = np.random.default_rng(1).integers(0, 1 << 23, 5000)
    keys = golay.neighbours(w)
    assert set((keys >= 0).sum(axis=1)) == {1, 6}
    for b in range(23):
        assert (golay.neighbours(w ^ (1 << b)) == golay.nearest(w)[:, None]).any(axis=1).all()


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_linked_fingerprints_share_a_key(distance):
    rng = np.random.default_rng(distance)
    a = rng.integers(-(1 << 63), 1 << 63, 2000)
    b = a.view(np.uint64).copy()
    for _ in range(distance):
        b ^= np.uint64(1) << rng.integers(0, 64, len(b)).astype(np.uint64)
    own = [set() for _ in a]
    for k, r in zip(*simhash.fuzzy_keys(a), strict=True):
        own[r].add(k)
    shared = np.zeros(len(a), bool)
    for k, r in zip(*simhash.fuzzy_keys(b.view(np.int64)), strict=True):
        shared[r] |= k in own[r]
    assert shared.all()


def test_near_duplicates(spark):
    docs = documents(spark)
    given = [(r.doc_id, r.text) for r in docs.collect()]
    fps = [brute_fingerprint(t) for _, t in given]
    want = sorted(zip([k for k, _ in given], fps, brute_components(fps, [k for k, _ in given]), strict=True), key=str)
    got = sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == want
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(k for k in ids if k is not None) == sorted({c for (k, _, c) in want if k is not None} - {None})
    assert ids.count(None) == 1
    assert simhash.near_duplicates(no_documents(spark)).count() == 0
    assert simhash.one_of_each(no_documents(spark)).count() == 0


def test_dense_group_chains_and_split_keys(spark, monkeypatch):
    """A ball of fingerprints, chains of three-bit steps, and keys over several blocks."""
    rng = random.Random(3)
    center = rng.getrandbits(64)
    fps = {center ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(150)}
    x = rng.getrandbits(64)
    for _ in range(40):
        x ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64)) | (1 << rng.randrange(64))
        fps.add(x)
    fps |= {rng.getrandbits(64) for _ in range(100)}
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    want = brute_components([f % (1 << 64) for f in fps], fps)
    monkeypatch.setattr(simhash, "BLOCK", 20)
    roots = {r.node: r.root for r in simhash.components(simhash.links(df)).collect()}
    assert [roots.get(f, f) for f in fps] == want


def test_one_of_each_keeps_one_row_of_each_group(spark):
    """Different texts under one id all stay; of copies without an id one stays, and none beside a copy with an id."""
    rng = random.Random(4)
    a, b, c, d = (" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(50)) for _ in range(4))
    rows = [(5, a), (5, b), (5, a), (None, c), (None, c), (None, c), (None, d), (9, d), (None, a), (7, b)]
    df = spark.createDataFrame([(k, t, *[None] * 8) for k, t in rows], DOCS)
    out = simhash.one_of_each(df)
    assert out.columns == df.columns
    assert sorted((str(r.doc_id), r.text) for r in out.collect()) == sorted([("5", a), ("5", b), ("None", c), ("9", d)])


# --- decontamination ----------------------------------------------------

def brute_windows(docs, items):
    cut = lambda t: re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    known = {}
    for k, t in items:
        w = cut(t)
        n = min(10, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            known.setdefault(tuple(w[a:a + n]), set()).add(k)
    out = []
    for k, t in docs:
        w = cut(t)
        hit, found = set(), set()
        for n in {len(x) for x in known}:
            for a in range(len(w) - n + 1):
                if (own := known.get(tuple(w[a:a + n]))) is not None:
                    hit |= set(range(a, a + n))
                    found |= own
        found = sorted(str(x) for x in found - {None})
        out.append((k, len(w), len(hit), len(found), found))
    return out


def test_contamination(spark):
    rng = random.Random(12)
    items = [(7, ITEM), (10, ITEM + " xi"), (10, ITEM), (9, SHORT_ITEM), (8, "Ünï"), (None, "a"), (1, None), (2, ""), (3, "..."),
             (4, " ".join(rng.choices("ab", k=14)))]
    extra = [(100 + k, " ".join(rng.choices("abc", k=80))) for k in range(30)]
    extra += [(200, "ünï x " + ITEM + " " + ITEM + " one two three"), (201, " ".join(ITEM.split()[2:12])), (202, " ".join(ITEM.split()[:9]))]
    docs = documents(spark).unionByName(spark.createDataFrame([(k, t, *[None] * 8) for k, t in extra], DOCS))
    bench = spark.createDataFrame([(k, t, "w", 1) for k, t in items], BENCH)
    given = [(r.doc_id, r.text) for r in docs.collect()]
    want = sorted(brute_windows(given, items), key=str)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r["items"]) for r in decontaminate.contamination(docs, bench).collect()), key=str)
    assert got == want
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(x[0]) for x in want if not x[2])
    for d, b in ((docs, bench.limit(0)), (no_documents(spark), bench)):
        assert [r.n_hit for r in decontaminate.contamination(d, b).collect()] == [0] * d.count()


def test_clean_judges_rows_not_ids(spark):
    """Of rows without an id, or with one id, only those with a benchmark window go."""
    rows = [(k, t, *[None] * 8) for k in (None, 5) for t in ("clean words", "x " + ITEM, "other clean words", "clean words")]
    kept = decontaminate.clean(spark.createDataFrame(rows, DOCS), spark.createDataFrame([(1, ITEM, "w", 1)], BENCH))
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted((str(r[0]), r[1]) for r in rows if ITEM not in r[1])


def test_winnowing_guarantee():
    """Equal windows have equal fingerprints wherever they stand."""
    span = " ".join(f"w{k}" for k in range(10))
    rng = random.Random(1)
    seen = set()
    for n in range(12):
        w = decontaminate.Words([" ".join(rng.choices("xyz", k=n)) + " " + span + " " + " ".join(rng.choices("xyz", k=9 - n % 5))])
        seen.add(int(w.fingerprints(10)[n]))
    assert len(seen) == 1


# --- syncmers -----------------------------------------------------------

def edited_of(rows):
    out = []
    for k, (_, t) in enumerate(rows):
        nxt, half = rows[(k + 1) % len(rows)][1], len(t) // 2
        out.append(t[:len(t) - half] + nxt[:half])
    return out


def brute_anchors(spark, text):
    """(place, hash) by the definition; the marks stand before and after the symbols."""
    k, s = syncmers.K, syncmers.S
    hashed = lambda rows: [r[0] for r in spark.createDataFrame(rows).selectExpr("xxhash64(*)").collect()] if rows else []
    symbols = re.findall(r"[^ \n\r\t]{1,%d}" % syncmers.PIECE, text)
    h = hashed([(x,) for x in [""] * (k - 1) + symbols + [" "] * (k - 1)]) if symbols else []
    m = hashed([tuple(h[i:i + s]) for i in range(len(h) - s + 1)])
    places = [i for i in range(len(h) - k + 1) if min(m[i:i + k - s + 1]) in (m[i], m[i + k - s])]
    return list(zip(places, hashed([(m[i], m[i + k - s]) for i in places]), strict=True)) or [(0, hashed([(text,)])[0])]


@pytest.mark.parametrize("text", ["", " \n ", "one", "two words", "  spaced \n\r\t out  ", "x" * 300, "a b " * 90, "naïve café 漢字 😀 " * 9 + "é" * 40])
def test_anchors(spark, text):
    got = spark.createDataFrame([(text,)], "text string").select(syncmers.anchors("text").alias("a")).first().a
    assert [(x.place, x.hash) for x in got] == brute_anchors(spark, text)


@pytest.mark.parametrize("rows_each", [3, 256])
def test_edited_fingerprints(spark, monkeypatch, rows_each):
    monkeypatch.setattr(syncmers, "RANGE_ROWS", rows_each)
    docs = documents(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    given = sorted((r.doc_id, r.text or "") for r in docs.collect())
    got = {r.doc_id: r for r in syncmers.edited_fingerprints(docs).collect()}
    assert len(got) == len(given)
    prints = {}
    for (k, t), e in zip(given, edited_of(given), strict=True):
        r = got[k]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint and prints.setdefault(e, r.edited_fingerprint) == r.edited_fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert got[7].near_next == 1.0  # the next text is the same
    assert got[6].near_edited > 0.3 > got[6].near_next
    assert syncmers.edited_fingerprints(no_documents(spark)).count() == 0
    assert syncmers.edited_fingerprints(documents(spark)).count() == len(texts()) + 3


def test_near_copies_of_any_length(spark):
    """Texts of different lengths, and with words of about a piece and two: one more word leaves them near."""
    rng = random.Random(8)
    word = lambda n: "".join(rng.choices("abcdefgh", k=n))
    rows = []
    for limit, size in ((400, 4), (1600, 4), (5000, 15), (5000, 31)):
        t = " ".join(word(size) for _ in range(limit // (size + 1)))
        rows += [t, t + " " + word(60), t[:len(t) // 2] + word(99) + t[len(t) // 2:]]
    rows += [rows[0], rows[3] + rows[0]]  # a short text and one beyond the band that ends with it
    df = spark.createDataFrame([(k, t) for k, t in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r for r in syncmers.edited_fingerprints(df).collect()}
    assert all(got[k].near_next > 0.4 for k in range(12) if k % 3 < 2)
    assert 0.1 < got[12].near_next < 0.6


def test_a_long_text_with_a_short_edited_one(spark):
    """The next text is short, so the edited one is about half as long."""
    rng = random.Random(9)
    t = " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(100))
    df = spark.createDataFrame([(0, t), (1, "end")], "doc_id long, text string")
    r = syncmers.edited_fingerprints(df).where("doc_id = 0").first()
    assert r.near_edited > 0.5


def brute_share(a, b):
    a, b = Counter(a), Counter(b)
    return 2 * (a & b).total() / (a.total() + b.total())


def test_likeness_and_match_of_all_anchors(spark):
    """A small shared passage, one changed word, repeats and order, against sets of all anchors."""
    rng = random.Random(10)
    long = lambda n: ["".join(rng.choices("abcdefgh", k=rng.randint(3, 9))) for _ in range(n)]
    a, b, passage = long(4000), long(4000), long(40)
    rows = [a[:2000] + passage + a[2000:], b[:500] + passage + b[500:], [*b[:500], *passage, "other", *b[501:]], b[2000:] + b[:2000], b + b]
    rows = [" ".join(x) for x in rows] + ["a b " * 150, "a b " * 1500, "x", "x"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(rows)], "doc_id long, text string")
    found = {r.doc_id: r.anchors for r in syncmers.all_anchors(df).collect()}
    got = {r.doc_id: r for r in syncmers.edited_fingerprints(df).collect()}
    for k in range(len(rows)):
        x, y = ([(p.hash >> 32, p.place) for p in found[j]] for j in (k, (k + 1) % len(rows)))
        assert got[k].fingerprint == " ".join(str(v) for v, _ in x)  # every anchor, in order
        links = [[(p[0], q and q[0], q and q[1] - p[1]) for p, q in zip(z, [*z[1:], None], strict=True)] for z in (x, y)]
        assert got[k].near_next == pytest.approx(brute_share([v for v, _ in x], [v for v, _ in y]))
        assert got[k].match_next == pytest.approx(brute_share(*links))
    assert 0 < got[0].near_next < 0.05 and 0.99 < got[1].near_next < 1 and got[7].near_next == got[7].match_next == 1
    assert got[3].near_next < 0.7 and got[5].near_next < 0.5
    assert brute_anchors(spark, rows[0]) == [(p.place, p.hash) for p in found[0]]


def test_likeness_comes_from_the_fingerprints(spark):
    """Long texts that differ in a single word have different fingerprints, and the likeness can be computed from them."""
    rng = random.Random(12)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(4000)]
    rows = [" ".join([*words[:at], "changed", *words[at + 1:]]) for at in (5, 900, 1700, 2500, 3300, 3999)]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(rows)], "doc_id long, text string")
    got = [r for r in syncmers.edited_fingerprints(df).orderBy("doc_id").collect()]
    assert len({r.fingerprint for r in got}) == 6
    for r, s in zip(got, [*got[1:], got[0]], strict=True):
        assert r.near_next == pytest.approx(brute_share(r.fingerprint.split(), s.fingerprint.split())) and 0.99 < r.near_next < 1
        assert r.near_edited == pytest.approx(brute_share(r.fingerprint.split(), r.edited_fingerprint.split()))


@pytest.mark.parametrize("hot", [None, 700])
def test_a_third_of_all_rows_with_one_id(spark, monkeypatch, hot):
    """Ranges of one id are cut too, each range has one guest, and each document one next."""
    monkeypatch.setattr(syncmers, "RANGE_ROWS", 50)
    df = spark.range(0, 3000, 1, 6).selectExpr("if(id % 3 = 0, CAST(NULL AS LONG), id) AS doc_id" if hot is None else f"if(id % 3 = 0, {hot}L, id) AS doc_id",
                                               "if(id % 6 = 0, 'one text for many', 'text ' || id || ' ' || id * id) AS text")
    seen = {}
    real = syncmers.compared

    def watched(rows, *a):
        seen.setdefault("ranges", rows.groupBy("bucket", "sub").agg(F.count("*").alias("n"), F.count_if("guest").alias("guests")) if "guest" in rows.columns else None)
        return real(rows, *a)

    monkeypatch.setattr(syncmers, "compared", watched)
    out = syncmers.with_next(df)
    rows = out.select("doc_id", "text", "next_text").collect()
    ranges = seen["ranges"].collect()
    assert max(r.n for r in ranges) < 160 and {r.guests for r in ranges} == {1}
    given = Counter((r.doc_id, r.text) for r in df.collect())
    assert Counter((r.doc_id, r.text) for r in rows) == given
    assert Counter(r.next_text for r in rows) == Counter(t for _, t in given.elements())  # a ring: each text is next once
    single = {k: t for k, t in given if k is not None and k != hot}
    order = sorted(single)
    after = {r.doc_id: r.next_text for r in rows if r.doc_id in single}
    for a, b in zip(order, order[1:], strict=False):
        if hot is None or not a < hot < b:
            assert after[a] == single[b]


def test_registered_queries_run_on_small_tables(spark):
    for name in ("op1_syncmers", "op6_simhash", "op8_winnowing"):
        assert queries.QUERIES[name](spark, "/root/testdata/sf0.001").count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
