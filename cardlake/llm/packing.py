"""Best-fit packing of documents into sequences of at most ``SEQUENCE`` tokens: bounded-space online best-fit.

``pieces`` encodes every document, appends the end id, and cuts documents
longer than a sequence into whole sequences and a rest. ``packed`` deals the
pieces out to tasks of about ``TASK_PIECES``, each of which gets the longest
first and keeps ``OPEN`` open bins at most. A piece goes into the bin with the least free space that has room for
it (a bitset with one bit for each free space that some open bin has gives it
in one shift); without such a bin a new one is opened, for which the fullest
closes if ``OPEN`` are open. ``sequences`` puts the ids of packed pieces
together.

Pieces are written before they are packed, with a number for each row, and
dealt by that number: so a task that is run again packs the same pieces in the
same order, and a hot or missing id, or repeated rows, are spread like any
others. Only rows of some fifty bytes are dealt out, unless ids are kept.

Encoding is that of the tokenizers library. Texts of ASCII and Latin-1 letters
are cut into lower-case pre-tokens as the library does it, and pre-tokens' ids
are kept in a bounded cache of the worker. The tokenizer drops white space and
cuts at it before anything else, so other texts are encoded by the words
between spaces or line ends, with a cache as well.

Defined cases: NULL counts as empty, which is the end id alone; NULL and
repeated ids are documents of their own; a very long text is encoded whole,
with other texts in groups of ``common.GROUP_CHARS`` characters; ties of free
space go to the bin that changed last; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.llm.common import CACHE_WORDS, claim_cache, grouped_texts, stored

SEQUENCE, OPEN, END, TASK_PIECES = 4096, 4096, 1, 25_000
#: Longest word or pre-token that is cached, in characters; pre-tokens in a worker's cache (a full one is emptied).
CACHED_CHARS, CACHE_CUTS = 64, 2 * CACHE_WORDS
_PLAIN_TEXT = re.compile(r"[\n\r\t -~À-ÖØ-öø-ÿ]*")
#: Pre-tokens of a lower-case plain text.
_CUT = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Whole texts to ids (little-endian unsigned 32-bit) of a tokenizer that drops white space."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; the library's idle threads would take CPU time
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        apart = b"".join(self.library(["a", "b"]))
        if self.library(["a b", "a\nb"]) != [apart, apart]:
            raise ValueError(f"{path}: white space is not dropped, so words can't be encoded on their own")
        if self.library(["Don'T!!x12"]) != [b"".join(self.library(_CUT.findall("don't!!x12")))]:
            raise ValueError(f"{path}: words are cut otherwise than here")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words: dict[str, bytes] = {}
        self.cuts: dict[str, bytes] = {}

    def library(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def joined(self, split: list[list[str]], cache: dict[str, bytes], most: int) -> list[bytes]:
        """The ids of each list of parts that the library can encode on their own."""
        if len(cache) > most:
            cache.clear()
        new = list(set().union(*split).difference(cache))
        cache.update(zip(new, self.library(new), strict=True))
        get = cache.__getitem__
        out = [b"".join(map(get, s)) for s in split]
        for w in new:
            if len(w) > CACHED_CHARS:
                del cache[w]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = [_PLAIN_TEXT.fullmatch(t) is not None and not any([s in t for s in self.special]) for t in texts]
        cut = iter(self.joined([_CUT.findall(t.lower()) for t, p in zip(texts, plain, strict=True) if p], self.cuts, CACHE_CUTS))
        other = iter(self.joined([t.replace("\n", " ").split(" ") for t, p in zip(texts, plain, strict=True) if not p], self.words, CACHE_WORDS))
        return [next(cut if p else other) for p in plain]


_LOADED: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    claim_cache(_LOADED.clear)
    if path not in _LOADED:
        _LOADED[path] = WordEncoder(path)
    return _LOADED[path]


def pieces(docs: DataFrame, tokenizer: str | None = None, size: int = SEQUENCE, end: int = END, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, with ``keep=("ids",)``, the ids (binary) of every piece of every document."""
    tokenizer, tail, width = tokenizer or default_tokenizer(), np.array([end], "<u4").tobytes(), 4 * size

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in grouped_texts(batch, "text"):
                row, place, ids = [], [], []
                for k, own in enumerate(_encoder(tokenizer).encode(texts)):
                    own += tail
                    for p in range(-(-len(own) // width)):
                        row.append(first + k)
                        place.append(p)
                        ids.append(own[p * width:(p + 1) * width])
                out = {"doc_id": batch.column("doc_id").take(pa.array(row, pa.int64())), "piece": pa.array(place, pa.int32()),
                       "start": pa.array(np.array(place, np.int64) * size), "length": pa.array([len(x) // 4 for x in ids], pa.int64()),
                       "ids_crc32": pa.array(list(map(zlib.crc32, ids)), pa.int64())}
                if "ids" in keep:
                    out["ids"] = pa.array(ids, pa.binary())
                yield pa.RecordBatch.from_pydict(out)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if "ids" in keep else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, schema)


class Bins:
    """At most ``most`` open bins of ``size`` places; bit f of ``bits`` is set if an open bin has f free places."""

    def __init__(self, size: int = SEQUENCE, most: int = OPEN):
        self.size, self.most = size, most
        self.bits, self.open, self.made = 0, 0, 0
        self.with_free: list[list[int]] = [[] for _ in range(size + 1)]

    def _take(self, free: int) -> int:
        bins = self.with_free[free]
        taken = bins.pop()
        if not bins:
            self.bits ^= 1 << free
        self.open -= 1
        return taken

    def put(self, length: int) -> tuple[int, int]:
        """Bin and place in it of the next piece."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            own = self._take(free)
        else:
            if self.open == self.most:  # the fullest closes
                self._take((self.bits & -self.bits).bit_length() - 1)
            free, own = self.size, self.made
            self.made += 1
        left = free - length
        if left:  # a full bin is closed
            if not self.with_free[left]:
                self.bits |= 1 << left
            self.with_free[left].append(own)
            self.open += 1
        return own, self.size - free


def packed(cut: DataFrame, size: int = SEQUENCE, most: int = OPEN, task_pieces: int = TASK_PIECES) -> DataFrame:
    """``cut`` (pieces with a ``length`` of 1 to ``size``) with ``sequence_id`` and ``offset``."""
    rows = stored(cut.withColumn("row", F.monotonically_increasing_id()), "pieces")
    tasks = max(1, math.ceil(rows.count() / task_pieces))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, base = Bins(size, most), TaskContext.get().partitionId() << 40
        for batch in batches:
            found = [bins.put(n) for n in batch.column("length").to_pylist()]
            out = dict(zip(batch.schema.names, batch.columns, strict=True))
            out["sequence_id"] = pa.array([base + b for b, _ in found], pa.int64())
            out["offset"] = pa.array([at for _, at in found], pa.int64())
            yield pa.RecordBatch.from_pydict(out)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", sequence_id long, offset long"
    return rows.repartition(tasks, "row").sortWithinPartitions(F.desc("length"), "row").mapInArrow(fit, schema).drop("row")


def sequences(packed_pieces: DataFrame) -> DataFrame:
    """sequence_id, length, its documents' pieces (offset, doc_id, piece, length) in order, and the ids of each sequence (packed pieces with ids)."""
    own = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))  # a sequence's ids at most
    return packed_pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), own.alias("x")).select(
        "sequence_id", "length", F.transform("x", lambda p: p.dropFields("ids")).alias("pieces"),
        F.expr("aggregate(x.ids, cast('' as binary), (a, b) -> a || b)").alias("ids"))
