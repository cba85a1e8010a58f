"""Embedding whitening through polarisation covariance.

An entry c becomes the integer x = floor(64 c) + 1,000,000. The covariance of
two dimensions is half the variance of their sum less both variances, so only
squares are added up, and all of them exactly:

1. ``totals``: rows n and, for each dimension, the sum S of x;
2. ``squares``: for each dimension and each pair's sum, the sum of squares of
   the centred values. A centred value n x - S is n z - r with z = x - S div n
   and r = S mod n; tasks add up the small integers z^2 and (z_a + z_b)^2, and
   since the sum of z is r, the exact sum of (n x - S)^2 is n^2 Z - n r^2;
3. ``Whitening.fit``: all covariances from these (one rounding each), ``eigh``
   on the driver;
4. ``whitened``: (x - S / n) projected on each component, over the root of its
   eigenvalue; ``identity_error`` measures the covariance of the rows written.

A task sends one row for each of the d (d + 1) / 2 squares, whatever its rows,
so what the driver collects grows with the dimension alone (2,080 numbers for
64 dimensions). Tables are cut by Spark's input splits, never by a key, so
repeated rows and hot ids are ordinary rows.

Defined cases: a row goes if its vector is NULL or has entries that are NULL,
not finite, or of 2^47 and more in size (64 c is no exact integer there), or
if its length is not the length that most rows have (ties: the longest);
NULL and repeated ids and repeated vectors are rows of their own; a component
without variance (eigenvalue of at most d eps times the greatest) has NULL in
``whitened`` and counts in no identity error; without any variance
``explained`` and the identity error are NULL; extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.llm.common import stored

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32
_LIMIT, _SAFE = 2.0 ** 53 / SCALE, 1 << 62
_EXACT = decimal.Context(prec=100)


def usable(rows: DataFrame, vec: str, vec_id: str) -> DataFrame:
    """vec_id and vec (array of double) of the rows whose vector is whole."""
    whole = f"vec is not null and size(vec) > 0 and forall(vec, e -> e is not null and abs(e) < {_LIMIT!r}D)"
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vec).cast("array<double>").alias("vec")).where(whole)


def _integers(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """x of a batch whose vectors all have ``d`` entries."""
    c = batch.column("vec").flatten().to_numpy(zero_copy_only=False)
    return np.floor(c * SCALE).astype(np.int64).reshape(-1, d) + SHIFT


def _decimals(values) -> pa.Array:
    return pa.array([_EXACT.create_decimal(int(v)) for v in values], pa.decimal128(38, 0))


def _sum(values: np.ndarray) -> list[int]:
    """Exact column sums of an integer matrix."""
    if values.size and int(np.abs(values).max()) * len(values) >= _SAFE:
        values = values.astype(object)
    return [int(v) for v in values.sum(axis=0)]


def _square_sums(z: np.ndarray) -> list[int]:
    """For a <= b: exact sum of z_a^2 (a = b) or of (z_a + z_b)^2."""
    if z.size and (2 * int(np.abs(z).max())) ** 2 * len(z) >= _SAFE:
        z = z.astype(object)
    out: list[int] = []
    for a in range(z.shape[1]):
        both = z[:, a:a + 1] + z[:, a:]
        both[:, 0] = z[:, a]
        out += [int(v) for v in (both * both).sum(axis=0)]
    return out


def totals(vectors: DataFrame) -> tuple[int, list[int]]:
    """Number of rows that have the table's dimension, and the sum of x for each dimension."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = batch.column("vec").value_lengths().to_numpy(zero_copy_only=False)
            for d in np.unique(of).tolist():
                own = batch.filter(pa.array(of == d))
                yield pa.RecordBatch.from_pydict({"d": pa.array([d] * d, pa.int32()), "n": pa.array([own.num_rows] * d, pa.int64()),
                                                  "dim": pa.array(range(d), pa.int32()), "total": _decimals(_sum(_integers(own, d)))})

    found = vectors.mapInArrow(sums, "d int, n long, dim int, total decimal(38,0)") \
        .groupBy("d", "dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    found = stored(found, "whitening-totals")
    most = found.where("dim = 0").orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    if not most:
        return 0, []
    rows = found.where(F.col("d") == most[0].d).orderBy("dim").collect()
    return most[0].n, [int(r.total) for r in rows]


def squares(vectors: DataFrame, n: int, total: list[int]) -> dict[tuple[int, int], int]:
    """For a = b the exact sum of (n x_a - S_a)^2, for a < b that of the pair's sum of centred values, squared."""
    d = len(total)
    middle = np.array([s // n for s in total], np.int64)
    rest = [s % n for s in total]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        added = None
        for batch in batches:
            own = _square_sums(_integers(batch, d) - middle)
            added = own if added is None else [x + y for x, y in zip(added, own, strict=True)]
        if added is not None:
            a, b = np.triu_indices(d)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int32()), "b": pa.array(b, pa.int32()), "total": _decimals(added)})

    found = vectors.where(F.size("vec") == d).mapInArrow(sums, "a int, b int, total decimal(38,0)").groupBy("a", "b").agg(F.sum("total").alias("total"))
    out = {}
    for r in found.collect():  # d (d + 1) / 2 rows
        left = rest[r.a] if r.a == r.b else rest[r.a] + rest[r.b]
        out[r.a, r.b] = n * n * int(r.total) - n * left * left
    return out


@dataclass
class Whitening:
    """A fitted whitening: exact totals, and the components by falling eigenvalue as columns of ``vectors``."""

    n: int
    total: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @classmethod
    def fit(cls, n: int, total: list[int], of: dict[tuple[int, int], int], components: int = COMPONENTS) -> Whitening:
        d = len(total)
        v = np.zeros((d, d))
        for (a, b), s in of.items():
            exact = s if a == b else (s - of[a, a] - of[b, b]) // 2  # always even: twice the sum of products
            v[a, b] = v[b, a] = exact / n ** 3
        values, vectors = np.linalg.eigh(v)
        keep = np.argsort(-values, kind="stable")[:components]
        values, vectors = values[keep], vectors[:, keep]
        # either sign is right: the entry of greatest size is made positive, so that every run gives the same
        big = np.abs(vectors).argmax(axis=0)
        vectors = vectors * np.where(vectors[big, range(len(keep))] < 0, -1.0, 1.0)
        floor = d * np.finfo(float).eps * max(values.max(initial=0.0), 0.0)
        return cls(n, total, np.where(values > floor, values, 0.0), vectors, sum(of[a, a] for a in range(d)) / n ** 3)

    def explained(self) -> list[float | None]:
        return [float(e / self.trace) if self.trace > 0 else None for e in self.values]


def whitened(vectors: DataFrame, fitted: Whitening) -> DataFrame:
    """vec_id, deviation (exact sum of (n x - S)^2) and whitened (array of double, NULL for a component without variance) of each row."""
    n, d, k = fitted.n, len(fitted.total), len(fitted.values)
    middle = np.array([s // n for s in fitted.total], np.int64)
    rest = np.array([s % n for s in fitted.total], np.int64)
    live = fitted.values > 0
    scaled = fitted.vectors / np.sqrt(np.where(live, fitted.values, 1.0))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = _integers(batch, d) - middle
            far = int(np.abs(z).max(initial=0)) * n + n
            y = n * z - rest if far * far * d < _SAFE else n * z.astype(object) - rest
            deviation = (y * y).sum(axis=1)
            w = np.ascontiguousarray(((z - rest / n) @ scaled).reshape(-1))
            flat = pa.array(w, mask=np.tile(~live, len(z)))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1, dtype=np.int32) * k), flat)
            yield pa.RecordBatch.from_pydict({"vec_id": batch.column("vec_id"), "deviation": _decimals(deviation), "whitened": lists})

    return vectors.where(F.size("vec") == d).mapInArrow(rows, "vec_id long, deviation decimal(38,0), whitened array<double>")


def identity_error(rows: DataFrame, fitted: Whitening) -> float | None:
    """Greatest absolute entry of the whitened rows' covariance less the identity, over the components that have variance."""
    live = np.flatnonzero(fitted.values > 0)
    k = len(live)
    if not k:
        return None

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        added = np.zeros(k * (k + 1))
        for batch in batches:
            column = batch.column("whitened")
            w = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)[:, live]
            added += np.concatenate([w.sum(axis=0), (w.T @ w).reshape(-1)])
        yield pa.RecordBatch.from_pydict({"at": pa.array(range(len(added)), pa.int32()), "total": pa.array(added)})

    found = rows.select("whitened").mapInArrow(sums, "at int, total double").groupBy("at").agg(F.sum("total").alias("total")).collect()
    added = np.zeros(k * (k + 1))
    for r in found:
        added[r["at"]] = r.total
    mean = added[:k] / fitted.n
    return float(np.abs(added[k:].reshape(k, k) / fitted.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(rows: DataFrame, vec: str = "embedding", vec_id: str = "vec_id", components: int = COMPONENTS) -> tuple[DataFrame, Whitening | None, float | None]:
    """Fit on all usable rows and whiten them: (``whitened`` rows, the fit, the identity error); the fit is None for a table without usable rows."""
    vectors = usable(rows, vec, vec_id)
    n, total = totals(vectors)
    if not n:
        return rows.sparkSession.createDataFrame([], "vec_id long, deviation decimal(38,0), whitened array<double>"), None, None
    fitted = Whitening.fit(n, total, squares(vectors, n, total), components)
    out = stored(whitened(vectors, fitted), "whitened")
    return out, fitted, identity_error(out, fitted)
