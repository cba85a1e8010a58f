"""Token-id files: fixed-size blocks of ids, cut into byte or bit planes, each plane compressed with zstandard.

**Format.** A file set is a folder. ``chunks`` holds rows (Parquet, so that
Spark's commit protocol makes a retried task's output appear once); a row is a
chunk of consecutive whole documents:

- ``part``, ``chunk``: ascending order of the chunks; ``first``: ids of the part before it; ``n_ids``;
- ``doc_ids``, ``counts``: its documents in order, with the ids of each (end id included);
- ``index``: compressed size of each plane, block by block;
- ``payload``: the planes. A block has ``BLOCK`` ids (the last of a chunk fewer) as unsigned 32-bit
  integers. Byte planes: the 4 low-to-high bytes of all ids. Bit planes: the 32 bits, low to high, packed.

``manifest`` has a row for each part: ``part``, ``base`` (ids of all parts
before it), ``n_ids``; one row for each writing task, however many documents.

``format`` has one row, written last: format ``version``, ``planes`` (byte or
bit), ``block`` (ids), ``end`` (the end id) and ``tokenizer`` (SHA-256 of its
file). A set says itself how it is read; a set without that row is not
finished, and reading it is an error, as are another version, settings that
the caller expects otherwise, and chunks that do not fit their index.

**Encoding** is that of the tokenizers library. Texts of ASCII and Latin-1
letters are cut into pre-tokens as the library does it, and pre-tokens' ids
are kept in a bounded cache of the worker. Other texts are cut only where a
pre-token never reaches over, at a single space between two non-space
characters, and their words are cached; a text in which such a cut is not
safe goes to the library whole.

Defined cases: NULL counts as empty, which is the end id alone; rows are in
ascending doc_id order, NULL ids first, repeated ids in the order of their
texts' hash, and rows alike in both as they are read (so however many there
are, they are cut into ranges like others); a very long text is encoded whole
and is at least a chunk of its own; extra columns are ignored; an empty table
gives an empty set.
"""

from __future__ import annotations

import hashlib
import os
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardlake.llm.common import CACHE_WORDS, claim_cache, grouped_texts

BLOCK, CHUNK, LEVEL, END, VERSION = 1 << 16, 1 << 18, 3, 0, 2
#: Pre-tokens in a worker's cache (their entries are small); a full cache is emptied.
CACHE_CUTS = 3 * CACHE_WORDS
_PLAIN_TEXT = re.compile(r"[\n\r\t -~À-ÖØ-öø-ÿ]*")
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
#: Pre-tokens of plain text, as byte-level pre-tokenizing cuts them.
_CUT = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\sA-Za-z0-9À-ÖØ-öø-ÿ]+|\s+(?!\S)|\s+")


def pack_ids(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Whole texts to ids through the tokenizers library, with a cache of words."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; the library's idle threads would take CPU time
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words: dict[str, bytes | None] = {}
        self.cuts: dict[str, bytes] = {}

    def library(self, texts: list[str]) -> list[bytes]:
        return [pack_ids(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, words: set[str]) -> None:
        """Put the ids of each word after a single space into the cache; None if a cut before or after it is not safe."""
        direct, lines = [], {}
        for w in words:
            if not w or w[0].isspace() or w[-1].isspace():
                self.words[w] = None
            elif any(s in w for s in self.special):
                direct.append(w)
            elif _PLAIN.fullmatch(w):
                lines[w] = _CUT.findall(" " + w)
            elif all(map(_PLAIN.fullmatch, parts := w.split("\n"))):  # a single line end is a pre-token of its own
                cuts = _CUT.findall(" " + parts[0])
                for p in parts[1:]:
                    cuts += ["\n", *_CUT.findall(p)]
                lines[w] = cuts
            else:
                direct.append(w)
        new = list({c for cuts in lines.values() for c in cuts}.difference(self.cuts))
        self.cuts.update(zip(new, self.library(new), strict=True))
        get = self.cuts.__getitem__
        self.words.update((w, b"".join(map(get, cuts))) for w, cuts in lines.items())
        self.words.update(zip(direct, self.library([" " + w for w in direct]), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each whole text as little-endian unsigned 32-bit integers."""
        if len(self.cuts) > CACHE_CUTS:
            self.cuts.clear()
        cuts = [_CUT.findall(t) if _PLAIN_TEXT.fullmatch(t) and not any([s in t for s in self.special]) else None for t in texts]
        new = list(set().union(*filter(None, cuts)).difference(self.cuts))
        self.cuts.update(zip(new, self.library(new), strict=True))
        get = self.cuts.__getitem__
        out = [b"".join(map(get, c)) if c is not None else b"" for c in cuts]
        other = [k for k, c in enumerate(cuts) if c is None]
        for k, ids in zip(other, self.encode_words([texts[k] for k in other]), strict=True):
            out[k] = ids
        return out

    def encode_words(self, texts: list[str]) -> list[bytes]:
        """The same for texts of any characters, through the cache of words."""
        if not texts:
            return []
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        split = [t.split(" ") for t in texts]
        self.learn(set().union(*split).difference(self.words))
        # the first word has no space before it; in front of one that a space can follow, the text's start is a safe cut
        first = self.library([s[0] for s in split])
        get, out = self.words.__getitem__, []
        for text, s, head in zip(texts, split, first, strict=True):
            rest = [get(w) for w in s[1:]]
            if None in rest or (rest and (not s[0] or s[0][-1].isspace())):
                out += self.library([text])
            else:
                out.append(head + b"".join(rest))
        return out


_LOADED: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's one copy of a tokenizer."""
    claim_cache(_LOADED.clear)
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def pack(ids: np.ndarray, bits: bool) -> tuple[bytes, list[int]]:
    """Planes of all blocks, and the compressed size of each."""
    import zstandard

    press, out = zstandard.ZstdCompressor(level=LEVEL), []
    for k in range(0, len(ids), BLOCK):
        octets = ids[k:k + BLOCK].astype("<u4").view(np.uint8).reshape(-1, 4)
        planes = np.packbits(np.unpackbits(octets, axis=1, bitorder="little").T, axis=1) if bits else octets.T
        out += [press.compress(np.ascontiguousarray(p).tobytes()) for p in planes]
    return b"".join(out), [len(x) for x in out]


def unpack(payload: bytes, index: list[int], n: int, bits: bool, block: int = BLOCK) -> np.ndarray:
    """The ids of a chunk."""
    import zstandard

    press, out, at = zstandard.ZstdDecompressor(), [], 0
    planes_of = 32 if bits else 4
    if len(payload) != sum(index) or len(index) != planes_of * -(-n // block):
        raise ValueError("a chunk does not fit its index")
    for k in range(0, len(index), planes_of):
        size = min(block, n - k // planes_of * block)
        planes = []
        for length in index[k:k + planes_of]:
            planes.append(np.frombuffer(press.decompress(payload[at:at + length]), np.uint8))
            at += length
        both = np.stack(planes)
        if bits:
            both = np.packbits(np.unpackbits(both, axis=1, count=size).T, axis=1, bitorder="little").T
        out.append(np.ascontiguousarray(both.T).view("<u4").reshape(-1))
    return np.concatenate(out) if out else np.zeros(0, "<u4")


_CHUNK = pa.schema([("part", pa.int32()), ("chunk", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()),
                    ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("index", pa.list_(pa.int32())), ("payload", pa.binary())])
_CHUNK_SQL = "part int, chunk int, first long, n_ids long, doc_ids array<long>, counts array<long>, index array<int>, payload binary"


def write(docs: DataFrame, path: str, tokenizer: str | None = None, bits: bool = False, end: int = END) -> None:
    """Encode every document and write the file set ``path``."""
    tokenizer = tokenizer or default_tokenizer()
    tail = np.array([end], "<u4").tobytes()

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunk, first, size = TaskContext.get().partitionId(), 0, 0, 0
        ids: list[bytes] = []
        names: list[int | None] = []

        def row() -> pa.RecordBatch:
            payload, index = pack(np.frombuffer(b"".join(ids), "<u4"), bits)
            return pa.RecordBatch.from_pylist([dict(zip(_CHUNK.names, (part, chunk, first, size, names, [len(b) // 4 for b in ids], index, payload),
                                                       strict=True))], _CHUNK)

        for batch in batches:
            for start, texts in grouped_texts(batch, "text"):
                for k, own in enumerate(encoder(tokenizer).encode(texts)):
                    ids.append(own + tail)
                    names.append(batch.column("doc_id")[start + k].as_py())
                    size += len(ids[-1]) // 4
                    if size >= CHUNK:
                        yield row()
                        chunk, first, size, ids, names = chunk + 1, first + size, 0, [], []
        if ids:
            yield row()

    # the hash of the text parts rows that repeat an id, and orders them; the number parts rows that are alike
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("nr")) \
        .repartitionByRange("doc_id", "h", "nr").sortWithinPartitions("doc_id", "h", "nr").select("doc_id", "text")
    ordered.mapInArrow(chunks, _CHUNK_SQL).write.parquet(f"{path}/chunks")
    spark = docs.sparkSession
    parts = spark.read.schema(_CHUNK_SQL).parquet(f"{path}/chunks").groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    # one row for each writing task: their number is the plan's, not the data's
    base = F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts.select("part", F.coalesce(base, F.lit(0)).alias("base"), "n_ids").write.parquet(f"{path}/manifest")
    spark.range(1).select(F.lit(VERSION).alias("version"), F.lit(_planes(bits)).alias("planes"), F.lit(BLOCK).alias("block"),
                          F.lit(end).cast("long").alias("end"), F.lit(digest_of(tokenizer)).alias("tokenizer")).write.parquet(f"{path}/format")


def _planes(bits: bool) -> str:
    return "bit" if bits else "byte"


def digest_of(tokenizer: str) -> str:
    """SHA-256 of a tokenizer file."""
    with open(tokenizer, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def format_of(spark: SparkSession, path: str) -> dict:
    """How a file set was written: version, planes, block, end, tokenizer."""
    try:
        found = spark.read.schema("version int, planes string, block int, end long, tokenizer string").parquet(f"{path}/format").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        found = []
    if len(found) != 1:
        raise ValueError(f"{path}: not a finished set of id files")
    if found[0].version != VERSION:
        raise ValueError(f"{path}: format version {found[0].version}, not {VERSION}")
    return found[0].asDict()


def read(spark: SparkSession, path: str, ids: bool = True, **expected) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and, if asked for, the ids of every document of a file set.

    The set's own format row says how. ``expected`` are items of it that the
    caller relies on, e.g. ``end=0`` or ``tokenizer=digest_of(file)``; another
    value is an error.
    """
    own = format_of(spark, path)
    for item, value in expected.items():
        if own[item] != value:
            raise ValueError(f"{path}: {item} is {own[item]!r}, not {value!r}")
    bits, block = own["planes"] == _planes(True), own["block"]
    chunks = spark.read.schema(_CHUNK_SQL).parquet(f"{path}/chunks")
    parts = spark.read.schema("part int, base long").parquet(f"{path}/manifest")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
                flat = unpack(c["payload"], c["index"], c["n_ids"], bits, block)
                end = np.cumsum(c["counts"])
                own = [flat[b - n:b] for b, n in zip(end, c["counts"], strict=True)]
                out = {"doc_id": pa.array(c["doc_ids"], pa.int64()), "start": pa.array(c["first"] + end - c["counts"], pa.int64()),
                       "n_tokens": pa.array(c["counts"], pa.int64()), "part": pa.array([c["part"]] * len(own), pa.int32()),
                       "ids_crc32": pa.array([zlib.crc32(x.tobytes()) for x in own], pa.int64())}
                if ids:
                    out["ids"] = pa.array([x.astype(np.int64) for x in own], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(out)

    schema = "doc_id long, start long, n_tokens long, part int, ids_crc32 long" + (", ids array<long>" if ids else "")
    return chunks.mapInArrow(documents, schema).join(F.broadcast(parts), "part") \
        .withColumn("start", F.col("base") + F.col("start")).drop("part", "base")
