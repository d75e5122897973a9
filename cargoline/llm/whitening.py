"""Embedding whitening by polarisation covariance.

Entries become integers, so every sum below is exact.  For each dimension and for
each sum of two dimensions the tasks add up squares of values centred near the mean;
Spark sums them, and the variance of a sum less the two variances is twice the
covariance: the whole matrix comes from variances, without a product of two dimensions.

* the fit list is each distinct vector once (``distinct`` combines copies in every
  task before the shuffle, so a vector that a third of the rows hold costs one row a task);
* sums for the means, squares and the check of the result are three aggregations whose
  size is that of the matrix, not of the table; only they reach the driver;
* the matrix is put together with whole numbers and rounded once, then goes to ``eigh``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoline.llm.common import land, table

SCALE, SHIFT, MOST = 64.0, 1_000_000, 16
LIMIT = 2.0**47  # entries beyond it count as not finite
ROWS = 2048  # rows that are squared at a time
RESULT = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whole_numbers(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(rows, x)`` for the vectors of each length: their places in the batch, and their whole numbers."""
    column = batch["embedding"]
    entries = column.flatten().cast(pa.float64())
    values = entries.to_numpy(zero_copy_only=False)  # null: nan
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    x = np.floor(SCALE * values)
    bad = np.concatenate(([0], np.cumsum(~(np.abs(x) < LIMIT))))
    good = column.is_valid().to_numpy(zero_copy_only=False) & (lengths > 0) & (bad[ends] == bad[ends - lengths])
    for d in np.unique(lengths[good]):
        rows = np.flatnonzero(good & (lengths == d))
        yield rows, x[(ends[rows] - d)[:, None] + np.arange(d)].astype(np.int64) + SHIFT


def add_squares(held: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``held`` (whole numbers of any size, row by row of the upper triangle) plus the squares of ``y``'s
    dimensions, each followed by those of its sums with the later dimensions."""
    d = y.shape[1]
    if y.size and 4.0 * float(np.abs(y).max()) ** 2 * len(y) >= 2.0**62:
        y = y.astype(object)
    at = 0
    for i in range(d):
        t = y[:, i:] + y[:, i : i + 1]
        t[:, 0] = y[:, i]
        held[at : at + d - i] += (t * t).sum(axis=0).astype(object)
        at += d - i
    return held


def vectors(data: pa.Array, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(data.to_pylist()), "<i8").reshape(-1, d)


def by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.Array]]:
    dims = batch["d"].to_numpy()
    for d in np.unique(dims):
        yield int(d), batch["x"].filter(pa.array(dims == d))


def summed(rows: DataFrame, add) -> dict[int, np.ndarray]:
    """``add(held, d, x)`` over all rows, task by task; the tasks' whole numbers are summed by Spark.

    Returns an array of Python integers for each vector length.
    """
    kind = pa.decimal128(38, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for d, x in by_length(b):
                for lo in range(0, len(x), ROWS):
                    held[d] = add(held.get(d), d, vectors(x.slice(lo, ROWS), d))
        for d, v in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([d] * len(v), pa.int32()), pa.array(np.arange(len(v)), pa.int32()), pa.array([int(s) for s in v]).cast(kind) if all(abs(int(s)) < 2**63 for s in v) else pa.array([str(int(s)) for s in v]).cast(kind)],
                ["d", "i", "v"],
            )

    out: dict[int, dict[int, int]] = {}
    # d * (d + 1) / 2 numbers a vector length, however many rows there are
    for r in rows.mapInArrow(run, "d int, i int, v decimal(38,0)").groupBy("d", "i").agg(F.sum("v").alias("v")).toLocalIterator():
        out.setdefault(r.d, {})[r.i] = int(r.v)
    return {d: np.array([v[i] for i in range(len(v))], dtype=object) for d, v in out.items()}


def covariance(n: int, rest: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """The covariance matrix from the sums ``rest`` of the values centred near the mean and ``squares``
    of them and of their pairwise sums: exact up to the last rounding."""
    d = len(rest)
    variance = [0] * d  # times n * n
    at = 0
    starts = []
    for i in range(d):
        starts.append(at)
        variance[i] = n * int(squares[at]) - int(rest[i]) ** 2
        at += d - i
    v = np.empty((d, d))
    for i in range(d):
        v[i, i] = variance[i] / (n * n)
        for j in range(i + 1, d):
            of_sum = n * int(squares[starts[i] + j - i]) - (int(rest[i]) + int(rest[j])) ** 2
            v[i, j] = v[j, i] = (of_sum - variance[i] - variance[j]) / (2 * n * n)
    return v


class Whitening:
    """A fit for vectors of one length: plain numbers and arrays."""

    def __init__(self, n: int, sums: np.ndarray, v: np.ndarray, most: int):
        self.n, self.d = n, len(sums)
        self.centre = np.array([int(round(s / n)) if abs(s) < 2**52 else (2 * int(s) + n) // (2 * n) for s in sums], np.int64)
        self.rest = np.array([int(s) - n * int(c) for s, c in zip(sums, self.centre)], np.int64)
        values, axes = np.linalg.eigh(v)
        values, axes = values[::-1], axes[:, ::-1]
        total = float(np.trace(v))
        # Directions without variance have no unit scale.
        some = int((values > max(total, 0.0) * self.d * np.finfo(float).eps).sum()) if total > 0 else 0
        self.k = min(most, some)
        self.axes, self.roots = axes[:, : self.k], np.sqrt(values[: self.k])
        self.explained = values[: self.k] / total if total > 0 else values[: self.k]

    def plain(self) -> tuple:
        return self.n, self.centre, self.rest, self.axes, self.roots, self.explained


def project(x: np.ndarray, fit: tuple) -> np.ndarray:
    """The whitened components of whole-number vectors."""
    n, centre, rest, axes, roots, _ = fit
    return ((x - centre) - rest / n) @ axes / roots


def deviations(x: np.ndarray, fit: tuple) -> list[int]:
    """The sum over dimensions of ``(n * x - S)**2``, exactly."""
    n, centre, rest, *_ = fit
    y = x - centre
    if (float(np.abs(y).max(initial=0)) * n + n) ** 2 * x.shape[1] >= 2.0**62:
        y, rest = y.astype(object), rest.astype(object)
    t = n * y - rest
    return [int(s) for s in (t * t).sum(axis=1)]


def whiten(vecs: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = MOST) -> DataFrame:
    """``RESULT``: a row for each kept vector and each of its first ``most`` components.

    An entry c counts as ``floor(64 * c) + 1000000``.  Vectors that are null or empty, or hold a null or
    non-finite entry (or one beyond 2^47 / 64), give no rows.  Vectors of each length are a
    space with a fit of its own.  Components without variance (fewer distinct vectors than dimensions) are
    left out, so one distinct vector gives no rows; equal eigenvalues keep the order ``eigh`` gives them.
    Repeated rows are returned each and weigh once in the fit; a null id stays null; other columns are
    ignored; an empty table gives no rows.
    """
    spark = vecs.sparkSession
    rows = vecs.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding")).where(F.col("embedding").isNotNull())

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, x in whole_numbers(b):
                data = x.astype("<i8").tobytes()
                step = 8 * x.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.shape[1]] * len(at), pa.int32()), pa.array([data[i : i + step] for i in range(0, len(data), step)], pa.binary())], ["d", "x"]
                )

    listed = land(rows.select("embedding").mapInArrow(whole, "d int, x binary").distinct(), "whitening-fit")
    counts = {r.d: r.n for r in listed.groupBy("d").agg(F.count("*").alias("n")).collect()}  # a row for each vector length

    def add_up(held, d, x):
        total = x.astype(object).sum(axis=0) if float(np.abs(x).max()) * len(x) >= 2.0**62 else x.sum(axis=0).astype(object)
        return total if held is None else held + total

    sums = summed(listed, add_up)
    middle = {d: Whitening(counts[d], s, np.zeros((len(s), len(s))), 0) for d, s in sums.items()}
    centres = {d: f.centre for d, f in middle.items()}

    def add_pairs(held, d, x):
        held = np.zeros(d * (d + 1) // 2, dtype=object) if held is None else held
        return add_squares(held, x - centres[d])

    fits = {}
    for d, squares in summed(listed, add_pairs).items():
        fit = Whitening(counts[d], sums[d], covariance(counts[d], middle[d].rest, squares), most)
        if fit.k:
            fits[d] = fit.plain()
    errors = identity_errors(listed, fits)

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b["vec_id"]
            for at, x in whole_numbers(b):
                fit = fits.get(x.shape[1])
                if fit is None:
                    continue
                for lo in range(0, len(at), ROWS):
                    part = x[lo : lo + ROWS]
                    w = project(part, fit)
                    m, k = w.shape
                    each = np.repeat(np.arange(m), k)
                    yield pa.RecordBatch.from_arrays([
                        ids.take(pa.array(at[lo : lo + ROWS][each])), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array([fit[0]] * (m * k), pa.int64()),
                        pa.array([str(v) for v in deviations(part, fit)]).cast(pa.decimal128(38, 0)).take(pa.array(each)), pa.array(w.ravel()),
                        pa.array(np.tile(fit[5], m)), pa.array([errors[x.shape[1]]] * (m * k), pa.float64()),
                    ], names=[f.split()[0] for f in RESULT.split(", ")])

    if not fits:
        return spark.createDataFrame([], RESULT)
    return rows.mapInArrow(out, RESULT)


def identity_errors(listed: DataFrame, fits: dict[int, tuple]) -> dict[int, float]:
    """For each vector length the largest absolute entry of the whitened fit list's covariance less the identity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for d, data in by_length(b):
                for lo in range(0, len(data) if d in fits else 0, ROWS):
                    w = project(vectors(data.slice(lo, ROWS), d), fits[d])
                    held[d] = held.get(d, 0) + np.vstack([w.T @ w, w.sum(axis=0)])
        for d, v in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([d] * v.size, pa.int32()), pa.array(np.arange(v.size), pa.int32()), pa.array(v.ravel())], ["d", "i", "v"])

    parts: dict[int, dict[int, float]] = {}
    for r in listed.mapInArrow(run, "d int, i int, v double").groupBy("d", "i").agg(F.sum("v").alias("v")).collect():  # at most 16 * 17 rows a length
        parts.setdefault(r.d, {})[r.i] = r.v
    out = {}
    for d, v in parts.items():
        n, k = fits[d][0], len(fits[d][4])
        m = np.array([v[i] for i in range(len(v))]).reshape(k + 1, k)
        mean = m[k] / n
        out[d] = float(np.abs(m[:k] / n - np.outer(mean, mean) - np.eye(k)).max())
    return out


def op11(spark, sf_dir: str) -> DataFrame:
    """Contract of ``op11_embedding_whitening``; a deviation beyond a long is null."""
    found = whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))
