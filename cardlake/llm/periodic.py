"""Periodic runs of words: Lyndon arrays from Baier's grouping, Lyndon roots extended through LCE into runs.

A run is a stretch of words with smallest period q, of at least
``max(LEAST, TIMES q)`` words, that neither neighbour extends.

*Grouping.* Suffixes are grouped by their first word. Groups are taken from
the greatest down; when a group is taken, its context (the words that its
suffixes are known to share) is the longest Lyndon word that each begins with.
The nearest position to the left that no taken group holds is then known to be
followed by that context: it leaves its group for one right above, with the
context appended as often as members of the taken group point to it. That is
phase one of the suffix sorter, and the contexts' lengths are the Lyndon
array. The same with the words' order turned round gives the other array.

*Roots.* For each run, in one of the two orders, the Lyndon rotation of its
period is the longest Lyndon word wherever it stands in the run. With
``TIMES`` of at least 4 periods it stands there three times in a row, so only
such places are extended, once for each period and stretch, by comparing both
sides in blocks of doubling size.

Before that, texts are cut at words that stand too seldom to be in a run
(under ``TIMES`` times in the stretch; no run reaches over such a word, and
none would be extended by it), which leaves most texts nothing to group.

Defined cases: NULL counts as a text without words; a very long text is
worked on whole, with lists of some hundred bytes a word; equal words have
equal code points; NULL and repeated ids are documents of their own; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.llm.common import grouped_texts

LEAST, TIMES, CUTS = 6, 4, 3
words_of = re.compile(r"[^\x20\x09-\x0D]+").findall


def lyndon_array(symbols: list[int]) -> list[int]:
    """Length of the longest Lyndon word that begins at each place (symbols from 0, without gaps; the end is less than any)."""
    n = len(symbols)
    members: list[list[int]] = [[] for _ in range(max(symbols, default=-1) + 1)]
    for i, s in enumerate(symbols):
        members[s].append(i)
    group = list(symbols)
    size = [len(m) for m in members]
    context = [1] * len(members)
    below, above = list(range(-1, len(members) - 1)), list(range(1, len(members) + 1))
    # places that no taken group holds, as a linked list; n (or -1) is its end
    left, right = [*range(-1, n - 1), n - 1], [*range(1, n + 1), 0]
    longest = [0] * n
    g = len(members) - 1
    while g >= 0:
        length = context[g]
        own = members[g] if size[g] == len(members[g]) else [i for i in members[g] if group[i] == g]
        targets: list[int] = []
        counts: list[int] = []
        last = -1
        for i in own:
            longest[i] = length
            a, b = left[i], right[i]
            right[a] = b
            left[b] = a
            if a == last:
                if a >= 0:
                    counts[-1] += 1
            elif a >= 0:
                targets.append(a)
                counts.append(1)
                last = a
        if len(targets) == 1:
            h, k = group[targets[0]], counts[0]
            if size[h] == 1:
                context[h] += k * length
                g = below[g]
                continue
        moves: dict[tuple[int, int], list[int]] = {}
        for t, k in zip(targets, counts, strict=True):
            moves.setdefault((k, group[t]), []).append(t)
        for k, h in sorted(moves, reverse=True):  # those followed by more contexts are greater; each goes right above what is left
            moved = moves[k, h]
            if len(moved) == size[h]:
                context[h] += k * length
                continue
            new = len(members)
            members.append(moved)
            size.append(len(moved))
            size[h] -= len(moved)
            context.append(context[h] + k * length)
            below.append(h)
            above.append(above[h])
            below[above[h]] = new  # g itself at most: what is above h has not been taken, or is being taken
            above[h] = new
            for t in moved:
                group[t] = new
        g = below[g]
    return longest


def stretches(symbols: np.ndarray, first: int = 0, cuts: int = CUTS) -> Iterator[tuple[int, np.ndarray]]:
    """(start, symbols) of the stretches of at least ``LEAST`` symbols between those that stand under ``TIMES`` times."""
    if len(symbols) < LEAST:
        return
    counts = np.bincount(symbols)
    often = counts[symbols] >= TIMES
    if often.all():
        yield first, symbols
        return
    edges = np.flatnonzero(np.diff(np.concatenate([[0], often.view(np.int8), [0]])))
    for a, b in edges.reshape(-1, 2).tolist():
        if b - a >= LEAST:
            own = np.unique(symbols[a:b], return_inverse=True)[1]
            if cuts > 1:
                yield from stretches(own, first + a, cuts - 1)
            else:
                yield first + a, own


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common beginning."""
    n, at, step = min(len(a), len(b)), 0, 32
    while at < n:
        differ = a[at:at + step][:n - at] != b[at:at + step][:n - at]
        if differ.any():
            return at + int(differ.argmax())
        at += step
        step *= 2
    return n


def runs_in(symbols: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of an array of symbols, by start and period."""
    n, out = len(symbols), []
    roots = set()
    for ordered in (symbols, symbols.max(initial=0) - symbols):
        length = np.array(lyndon_array(ordered.tolist()), np.int64)
        i = np.flatnonzero(TIMES * length <= n)
        i = i[i + 2 * length[i] < n]
        p = length[i]
        thrice = (length[i + p] == p) & (length[i + 2 * p] == p) & (symbols[i] == symbols[i + p]) & (symbols[i] == symbols[i + 2 * p])
        roots.update(zip(i[thrice].tolist(), p[thrice].tolist(), strict=True))
    back = symbols[::-1]
    seen: dict[int, int] = {}
    for i, p in sorted(roots):
        if i + p <= seen.get(p, 0):  # the root is part of a stretch of this period that was extended before
            continue
        start = i - common(back[n - i:], back[n - i - p:])
        end = i + p + common(symbols[i:], symbols[i + p:])
        seen[p] = end
        if end - start >= max(LEAST, TIMES * p):
            out.append((start, end - start, p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def runs_of_words(words: list[str]) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and period."""
    numbers: dict[str, int] = {}
    symbols = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    return [(first + s, m, p) for first, own in stretches(symbols) for s, m, p in runs_in(own)]


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words that no run holds after its first period, joined by a space."""
    if runs:
        change = np.zeros(len(words) + 1, np.int64)
        for s, m, p in runs:
            change[s + p] += 1
            change[s + m] -= 1
        words = [words[k] for k in np.flatnonzero(np.cumsum(change)[:-1] == 0).tolist()]
    return " ".join(words)


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, runs (array of start, length, period, by start and period) and the collapsed text of every document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in grouped_texts(batch, "text"):
                found, left = [], []
                for t in texts:
                    words = words_of(t)
                    runs = runs_of_words(words)
                    found.append([{"start": s, "length": m, "period": p} for s, m, p in runs])
                    left.append(collapsed(words, runs))
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id").slice(first, len(texts)), "runs": pa.array(found, _RUNS),
                                                  "collapsed": pa.array(left, pa.string())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(rows, "doc_id long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
