"""Pieces that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.session import scratch_dir

#: Characters that one round of Python work in a task holds at a time (a single longer text still comes whole).
GROUP_CHARS = 2_000_000
#: Entries of a per-worker cache of words; a full cache is emptied, which costs time only.
CACHE_WORDS = 400_000


_HOLDER: list = [None]


def claim_cache(clear: Callable[[], None]) -> None:
    """A worker that serves several operators keeps the cache of one at a time: the last holder's is cleared."""
    if _HOLDER[0] != clear:
        if _HOLDER[0] is not None:
            _HOLDER[0]()
        _HOLDER[0] = clear


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared scratch folder and read it back.

    Cuts lineage in a way that survives lost executors, and lets two later
    branches read one computed result.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_remainder(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (NULL ids count as the empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def grouped_texts(batch: pa.RecordBatch, column: str, chars: int = GROUP_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Consecutive whole texts of a batch, about ``chars`` characters at a time, with the first one's row; NULL is ''."""
    start, size, texts = 0, 0, []
    for x in batch.column(column):
        t = x.as_py() or ""
        texts.append(t)
        size += len(t)
        if size >= chars:
            yield start, texts
            start, size, texts = start + len(texts), 0, []
    if texts:
        yield start, texts


def in_groups(rows: Callable[[pa.RecordBatch], pa.RecordBatch], column: str) -> Callable:
    """``mapInArrow`` function that calls ``rows`` with slices of about ``GROUP_CHARS`` characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in grouped_texts(batch, column):
                yield rows(batch.slice(start, len(texts)), texts)

    return run


def labelled_sample(spark: SparkSession, docs: DataFrame, labels: DataFrame, label: str, usable: Column, rows: int,
                    max_chars: int) -> list[tuple[str, int]]:
    """At most ``rows`` labelled (text, label) pairs, to fit a classifier on.

    The bound: the ``rows`` usable labelled rows with the smallest hash of
    their id, of which those whose text has at most ``max_chars`` characters
    are used. An id that several documents have gives one text, that with the
    least hash. Everything else the classifiers do covers all documents.
    """
    ids = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & usable)
           .select("doc_id", F.col(label).cast("int").alias("label"))
           .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(F.length("text") <= max_chars)
    # both sides of the broadcast are bounded: `rows` ids; and so is what is collected: one text for each id
    one = texts.join(F.broadcast(ids.select("doc_id").distinct()), "doc_id", "left_semi") \
        .groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("of"), F.col("text"))).getField("text").alias("text"))
    found = one.join(F.broadcast(ids), "doc_id").select("text", "label", F.xxhash64("doc_id").alias("h"), "doc_id")
    return [(r.text, r.label) for r in sorted(found.collect(), key=lambda r: (r.h, r.doc_id, r.label, r.text))]
