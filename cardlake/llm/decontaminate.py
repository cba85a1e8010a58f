"""Benchmark decontamination by winnowing.

Words are maximal runs of digits, lower-cased letters and non-ASCII characters.
A window is ``WINDOW`` consecutive words of a benchmark item (an item of fewer
words is one window). Winnowing gives each window the least hash of its
``GRAM``-word grams, so that equal windows of a document and an item always
have the same fingerprint: every shared span of ``WINDOW`` words is found.

1. Benchmark windows are made distinct, with fingerprint and items. Their
   fingerprints set bits in a bitmap of at most ``MAX_BITS`` bits, the one
   thing that is sent to all tasks (2 MB at most, whatever the tables' sizes).
2. One pass over the documents counts words, computes the fingerprint of every
   window (numpy, a few passes over bytes and words), and keeps windows whose
   bit is set, with their words.
3. These are joined with the benchmark's windows on fingerprint and words: the
   words extend a fingerprint's hit to the whole window and reject chance hits.
   Benchmark windows are distinct, so a document window meets one at most.
4. A document's hit words are the union of its windows (a running maximum).
   Items are listed once for each distinct set of windows, not per document,
   since documents that share a passage share the set.

Defined cases: NULL, empty and punctuation-only texts have no words and no
hits; items without words have no window; repeated documents get equal rows,
repeated items count once, an item without id marks words but is not listed;
extra columns are ignored; an empty table on either side gives no hits.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardlake.llm.common import in_groups, stored

WINDOW, GRAM = 10, 6
MIN_BITS, MAX_BITS = 16, 24  # as powers of two
_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_MIX = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.full(4096, 0x100000001B3, np.uint64))


class Words:
    """Word bounds and hashes of several texts, by numpy."""

    def __init__(self, texts: list[str]):
        # a line end after each text: no word goes on into the next one
        raw = [t.encode().lower() for t in texts]  # bytes.lower() changes A-Z alone
        self.bytes = b"\n".join([*raw, b""])
        b = np.frombuffer(self.bytes, np.uint8)
        edge = np.flatnonzero(np.diff(_WORD_BYTE[b].view(np.int8), prepend=0, append=0))
        self.start, self.end = edge[::2], edge[1::2]
        size = self.end - self.start
        text_end = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)
        self.text = np.searchsorted(text_end, self.start, "right")
        self.count = np.bincount(self.text, minlength=len(texts))
        self.first = np.cumsum(self.count) - self.count
        # positions within a word beyond the table's length start over; equal words still hash equally
        at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        letters = b[_WORD_BYTE[b]].astype(np.uint64) + np.uint64(1)
        h = np.add.reduceat(letters * _POWERS[at % len(_POWERS)], np.cumsum(size) - size) if len(size) else np.zeros(0, np.uint64)
        h = (h ^ (h >> np.uint64(31))) * _MIX
        self.hash = h ^ (h >> np.uint64(29))

    def grams(self, n: int) -> np.ndarray:
        """Hash of the ``n`` words from each word on (also across texts: callers leave those out)."""
        g = np.zeros(max(0, len(self.hash) - n + 1), np.uint64)
        for k in range(n if len(g) else 0):
            g = g * _MIX + self.hash[k:k + len(g)]
        return (g ^ (g >> np.uint64(32))) * _MIX

    def fingerprints(self, n: int) -> np.ndarray:
        """Winnowed fingerprint of each ``n``-word window: the least hash of its grams."""
        if n < WINDOW:
            return self.grams(n)  # a short item's window is one gram
        g = self.grams(GRAM)
        size = max(0, len(self.hash) - n + 1)
        low = g[:size]
        for k in range(1, n - GRAM + 1):
            low = np.minimum(low, g[k:k + size])
        return low

    def whole(self, n: int) -> np.ndarray:
        """Whether the ``n`` words from each word on belong to one text."""
        size = max(0, len(self.hash) - n + 1)
        return self.text[:size] == self.text[len(self.hash) - size:]

    def words(self, at: int, n: int) -> str:
        return b" ".join([self.bytes[self.start[k]:self.end[k]] for k in range(at, at + n)]).decode()


def windows_of(benchmark: DataFrame) -> DataFrame:
    """(item_id, n, fp, words) for every window of every item."""

    def rows(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        w = Words(texts)
        out: list[tuple] = []
        ids = batch.column("item_id").to_pylist()
        short = np.flatnonzero((w.count > 0) & (w.count < WINDOW))
        for n in {WINDOW, *w.count[short].tolist()}:
            fp, whole = w.fingerprints(n), w.whole(n)
            at = np.flatnonzero(whole) if n == WINDOW else w.first[short[w.count[short] == n]]
            out += [(ids[w.text[k]], n, int(fp[k].view(np.int64)), w.words(k, n)) for k in at]
        return pa.RecordBatch.from_pylist([dict(zip(("item_id", "n", "fp", "words"), x, strict=True)) for x in out], _ITEM)

    return benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text") \
        .mapInArrow(in_groups(rows, "text"), "item_id string, n int, fp long, words string")


_ITEM = pa.schema([("item_id", pa.string()), ("n", pa.int32()), ("fp", pa.int64()), ("words", pa.string())])


def bitmap(windows: DataFrame) -> tuple[np.ndarray, int, list[int]]:
    """Bits of the windows' fingerprints, the bitmap's size as a power of two, and the lengths of short windows."""
    about = windows.agg(F.count("*").alias("n"), F.collect_set(F.when(F.col("n") < WINDOW, F.col("n"))).alias("short")).first()
    bits = min(MAX_BITS, max(MIN_BITS, (32 * about.n).bit_length()))
    place = F.shiftrightunsigned("fp", 64 - bits)
    words = windows.select(place.alias("p")).groupBy(F.shiftright("p", 3).cast("int").alias("byte")) \
        .agg(F.bit_or(F.expr("shiftleft(1, cast(p & 7 as int))")).alias("set")).toArrow()  # at most 2 ** (bits - 3) rows
    out = np.zeros(1 << (bits - 3), np.uint8)
    out[words.column("byte").to_numpy()] = words.column("set").to_numpy()
    return out, bits, sorted(about.short)


def candidates(docs: DataFrame, bits: tuple[np.ndarray, int, list[int]]) -> DataFrame:
    """doc_id, given_row, n_words, and the windows (first word, length, fingerprint, words) whose bit is set, of every document."""
    table, power, short = bits
    lengths = [WINDOW, *short]

    def rows(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        w = Words(texts)
        found: list[list[dict]] = [[] for _ in texts]
        for n in lengths:
            fp = w.fingerprints(n)
            p = fp >> np.uint64(64 - power)
            for k in np.flatnonzero((table[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8) & 1).astype(bool) & w.whole(n)):
                d = w.text[k]
                found[d].append({"at": int(k - w.first[d]), "n": n, "fp": int(fp[k].view(np.int64)), "words": w.words(k, n)})
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("given_row"), pa.array(w.count, pa.int64()), pa.array(found, _FOUND)],
            ["doc_id", "given_row", "n_words", "found"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "given_row", "text").mapInArrow(
        in_groups(rows, "text"), "doc_id long, given_row long, n_words long, found array<struct<at:int, n:int, fp:long, words:string>>")


_FOUND = pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32()), ("fp", pa.int64()), ("words", pa.string())]))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (sorted ids) of every document."""
    base, member, per_row = _hits(docs.select("doc_id", "text", F.lit(None).cast("long").alias("given_row")), benchmark)
    items = per_row.groupBy("set").agg(F.first("wids").alias("wids")).select("set", F.explode("wids").alias("wid")) \
        .join(member, "wid").groupBy("set").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    return base.select("row", "doc_id", "n_words").join(per_row.select("row", "n_hit", "set").join(items, "set", "left"), "row", "left") \
        .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def _hits(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents with a row number, the items of the benchmark's windows, and the hits of each row that has any."""
    windows = stored(windows_of(benchmark), "winnow-items")
    known = stored(windows.groupBy("n", "fp", "words").agg(F.first(F.lit(1)).alias("one"))
                   .select("n", "fp", "words", F.monotonically_increasing_id().alias("wid")), "winnow-windows")
    member = windows.where(F.col("item_id").isNotNull()).join(known, ["n", "fp", "words"]).select("wid", "item_id").distinct()
    base = stored(candidates(docs, bitmap(known)).withColumn("row", F.monotonically_increasing_id()), "winnow-documents")
    hit = base.select("row", F.explode("found").alias("f")).select("row", "f.*") \
        .join(known, ["n", "fp", "words"]).select("row", "at", (F.col("at") + F.col("n")).alias("end"), "wid")
    before = F.max("end").over(Window.partitionBy("row").orderBy("at", "end").rowsBetween(Window.unboundedPreceding, -1))
    gain = F.greatest(F.lit(0), F.col("end") - F.greatest("at", F.coalesce(before, "at")))
    per_row = stored(hit.withColumn("gain", gain).groupBy("row").agg(
        F.sum("gain").alias("n_hit"), F.sort_array(F.collect_set("wid")).alias("wids"))
        .withColumn("set", F.sha2(F.array_join("wids", ","), 256)), "winnow-hits")
    return base, member, per_row


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a benchmark window, all columns; each row is judged by its own text, whatever its id."""
    numbered = stored(docs.select(F.struct(*docs.columns).alias("given"), F.monotonically_increasing_id().alias("given_row")), "winnow-given")
    base, _, per_row = _hits(numbered.select("given.doc_id", "given.text", "given_row"), benchmark)
    hit = base.join(per_row, "row", "left_semi").select("given_row")
    return numbered.join(hit, "given_row", "left_anti").select("given.*")
