"""SimHash near-duplicates by Golay-code fuzzy hashing.

**Fingerprints.** Texts are lower-cased (A-Z), cut into words at ASCII white
space and into shingles of consecutive words; a fingerprint bit is set if it
is set in over half the shingles' XXH64 values.

**Keys.** A 64-bit fingerprint is three segments of 22, 21 and 21 bits, each a
word of the (23, 12) Golay code. Of at most three differing bits, some two of
the three segments hold at most one each (pigeonhole). Words at most one bit
apart are found through codeword indices: the nearest codeword of one is among
the one to six codewords that are nearest to the other or its one-bit
neighbours. So for each pair of segments a fingerprint gives keys with the
first segment fuzzy and the second nearest, and the reverse; two linked
fingerprints share one.

**Join and verify.** Equal fingerprints are one from here on. The keys are
shuffled; a task goes over its keys in order and compares the fingerprints
under one key bit by bit, in blocks. It returns a spanning forest of the links
found (each link joins what no earlier one did), not all pairs. A key with
more than ``BLOCK`` fingerprints is split into pairs of blocks that go to
different tasks, so that no key is one task's work.

**Components.** Labels are lowered along the links and by jumping to the
label's label until nothing changes, as DataFrame joins and aggregates.

Defined cases: NULL, empty and white-space-only texts have the fingerprint
zero, which links like any other; fewer words than a shingle make one shingle;
repeated rows stay and share a component; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.llm import golay
from cardlake.llm.common import in_groups, stored

SHINGLE, DISTANCE, SEED, BLOCK = 3, 3, 42, 4096
#: Up to so many fingerprints under one key are compared side by side, without a forest.
FEW = 16
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
_SEGMENTS = ((42, 22), (21, 21), (0, 21))  # shift and bits
_PAIRS = ((0, 1), (1, 2), (0, 2))


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a whole text, as a signed integer."""
    import xxhash

    words = _WORDS.findall(text.encode().lower())  # bytes.lower() changes A-Z alone
    if not words:
        return 0
    joined = b" ".join(words)
    end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    start = (end - np.diff(end, prepend=0)).tolist()
    last = (end - 1).tolist()[min(shingle, len(words)) - 1:]
    hashed = xxhash.xxh64_intdigest
    h = np.array([hashed(joined[a:b], SEED) for a, b in zip(start, last, strict=False)], ">u8")
    count = np.zeros(64, np.int64)
    for k in range(0, len(h), 8192):
        count += np.unpackbits(h[k:k + 8192].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(count * 2 > len(h)).view(">i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (signed 64-bit) of every document."""

    def rows(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([fingerprint(t, shingle) for t in texts], pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(in_groups(rows, "text"), "doc_id long, fp long")


def fuzzy_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All keys of the fingerprints, and the row of each."""
    u = fp.view(np.uint64)
    segment = [((u >> np.uint64(shift)) & np.uint64((1 << bits) - 1)).astype(np.int64) for shift, bits in _SEGMENTS]
    close = [golay.nearest(s).astype(np.int64) for s in segment]
    fuzzy = [golay.neighbours(s).astype(np.int64) for s in segment]
    keys, rows = [], []
    for p, (a, b) in enumerate(_PAIRS):
        for x, y in ((fuzzy[a], close[b][:, None]), (close[a][:, None], fuzzy[b])):
            key = np.where((x < 0) | (y < 0), -1, (p << 24) | (x << 12) | y)
            row, _ = np.nonzero(key >= 0)
            keys.append(key[key >= 0])
            rows.append(row)
    keys, rows = np.concatenate(keys), np.concatenate(rows)
    both = np.unique(np.stack([rows, keys]), axis=1) if len(keys) else np.zeros((2, 0), np.int64)
    return both[1], both[0]


def _keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 4096):
            fp = batch.column("fp").slice(k, 4096).to_numpy(zero_copy_only=False)
            keys, rows = fuzzy_keys(fp)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fp[rows])], ["key", "fp"])


def forest(fp: np.ndarray, part: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct fingerprints: (fingerprint, its component's first)."""
    n = len(fp)
    if n < 2:
        return []
    root = np.arange(n)
    mixed = part.min() != part.max()
    for k in range(n - 1):  # one row of comparisons at a time: memory stays in proportion to n
        near = np.flatnonzero(np.bitwise_count(fp[k + 1:] ^ fp[k]) <= distance) + k + 1
        if mixed:  # two blocks: pairs within one block are another task's
            near = near[part[near] != part[k]]
        for r in np.unique(root[near]):
            if r != root[k]:
                low, high = min(r, root[k]), max(r, root[k])
                root[root == high] = low
    return [(int(fp[k]), int(fp[root[k]])) for k in np.flatnonzero(root != np.arange(n))]


def _links_of(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = [np.zeros((0, 4), np.int64)]  # the rows of the last key, which may go on

        def linked(x: np.ndarray) -> pa.RecordBatch:
            fp = np.ascontiguousarray(x[:, 3]).view(np.uint64)
            new = np.flatnonzero(np.r_[True, (x[1:, 0] != x[:-1, 0]) | (x[1:, 1] != x[:-1, 1])][:len(x)])
            size = np.diff(np.r_[new, len(x)])
            found: list[np.ndarray] = [np.zeros((0, 2), np.uint64)]
            for a, n in zip(new[size > FEW], size[size > FEW], strict=True):
                found.append(np.array(forest(fp[a:a + n], x[a:a + n, 2], distance), np.uint64).reshape(-1, 2))
            left = np.repeat(np.where(size > FEW, 0, size), size) - (np.arange(len(x)) - np.repeat(new, size))
            for step in range(1, FEW):  # each row with the one `step` rows on, if that has the same key
                a = np.flatnonzero(left > step)
                a = a[np.bitwise_count(fp[a] ^ fp[a + step]) <= distance]
                found.append(np.stack([fp[a], fp[a + step]], axis=1))
            out = np.concatenate(found).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(out[:, 0].copy()), pa.array(out[:, 1].copy())], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "pair", "part", "fp")], axis=1)
            last = np.flatnonzero((x[:, 0] != x[-1, 0]) | (x[:, 1] != x[-1, 1]))
            cut = last[-1] + 1 if len(last) else 0
            first = held[0]
            if cut == 0 and (not len(first) or (first[0, :2] == x[0, :2]).all()):
                held.append(x)
                continue
            yield linked(np.concatenate([*held, x[:cut]]))
            held = [x[cut:]]
        yield linked(np.concatenate(held))

    return run


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b) links that connect all distinct fingerprints ``fp`` within ``distance`` (at most 3) bits."""
    if not 0 <= distance <= 3:
        raise ValueError("the keys cover up to three differing bits")
    keys = stored(fps.mapInArrow(_keys_of, "key long, fp long"), "simhash-keys")
    full = keys.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK) \
        .select("key", F.ceil(F.col("n") / BLOCK).cast("long").alias("blocks"))
    blocks = F.coalesce("blocks", F.lit(1))
    part = F.pmod(F.xxhash64("fp"), blocks)
    # the pairs of blocks that a fingerprint's block belongs to
    pairs = F.expr("""explode(transform(sequence(0L, coalesce(blocks, 1L) - 1),
                      o -> least(o, part) * coalesce(blocks, 1L) + greatest(o, part)))""")
    dealt = keys.join(full, "key", "left").withColumn("part", part).select("key", pairs.alias("pair"), "part", "fp")
    return dealt.repartition("key", "pair").sortWithinPartitions("key", "pair", "fp") \
        .mapInArrow(_links_of(distance), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of undirected ``edges`` (a, b): root is the least node that it reaches."""
    both = stored(edges.union(edges.select("b", "a")).distinct().toDF("node", "other"), "simhash-edges")
    labels = stored(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("root")), "simhash-labels")
    while True:
        # the least label among the neighbours' and their own, then the label's label
        heard = both.join(labels.select(F.col("node").alias("other"), F.col("root").alias("heard")), "other") \
            .groupBy("node").agg(F.min("heard").alias("heard"))
        lower = labels.join(heard, "node").select("node", "root", F.least("root", "heard").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("root").alias("far"))
        step = stored(lower.join(jump, "low").select("node", F.least("low", "far").alias("root"),
                                                     (F.least("low", "far") != F.col("root")).alias("moved")), "simhash-labels")
        labels = step.select("node", "root")
        if step.where("moved").isEmpty():
            return labels


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fp, component_id (the least doc_id reachable) of every document."""
    own = stored(fingerprints(docs, shingle), "simhash-fingerprints")
    fps = stored(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = components(links(fps.select("fp"), distance))
    member = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = member.groupBy("root").agg(F.min("least").alias("component_id"))
    return own.join(member.join(least, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of each component, all columns: that with the least doc_id (NULL last), and of those the first as stored.

    Components are those of rows: rows without an id, or that repeat one, are judged by their texts.
    """
    numbered = stored(docs.select(F.struct(*docs.columns).alias("given"), F.monotonically_increasing_id().alias("row")), "simhash-given")
    named = near_duplicates(numbered.select(F.col("row").alias("doc_id"), "given.text"), shingle, distance)
    ids = numbered.select("row", F.col("given.doc_id").cast("long").alias("id"))
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("row"))
    kept = named.select(F.col("doc_id").alias("row"), "component_id").join(ids, "row") \
        .groupBy("component_id").agg(F.min(order).getField("row").alias("row"))
    return numbered.join(kept, "row", "left_semi").select("given.*")
