"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Document statistics are standardised and mapped to cosines of random
projections, whose inner products approximate a Gaussian kernel.  Every
partition adds up its part of the normal equations; Spark sums the parts, and
the driver solves one system of fixed size.  The raw scores' label rates, summed over a fixed grid of
score bins, are made monotone by pooling adjacent violators.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoline.llm.common import land, table

N_STATS, N_COSINES, WIDTH, RIDGE, SEED = 24, 200, 4.0, 1.0, 11
BINS, LOW, HIGH = 2048, -0.5, 1.5
CHUNK = 1 << 16


def statistics(text: bytes) -> list[float]:
    """``N_STATS`` numbers of the whole text; all zero for an empty one."""
    words = text.split()
    if not words:
        return [0.0] * N_STATS
    n, size = len(words), len(text)
    counts = Counter(words)
    top = [c for _, c in counts.most_common(2)] + [0]
    of = np.bincount(np.frombuffer(text, np.uint8), minlength=256) / size
    lengths = np.fromiter(map(len, words), np.float64, n)
    lines = [x for x in text.split(b"\n") if x.strip()]
    ends = np.frombuffer(b"".join(w[-1:] for w in words), np.uint8)
    tails = np.bincount(ends, minlength=256) / n
    heads = np.bincount(np.frombuffer(b"".join(w[:1] for w in words), np.uint8), minlength=256) / n
    shares = np.fromiter(counts.values(), np.float64, len(counts)) / n
    pairs = len(set(zip(words, words[1:])))
    squeezer, packed = zlib.compressobj(1), 0
    for at in range(0, size, CHUNK):
        packed += len(squeezer.compress(text[at : at + CHUNK]))
    packed += len(squeezer.flush())
    symbols = [ord(c) for c in "#*$%&|<>"]
    upper = of[65:91].sum()
    return [
        math.log1p(n), math.log1p(size / n), float(lengths.std()) / 8, math.log1p(float(lengths.max())), upper, of[97:123].sum(), of[48:58].sum(),
        of[symbols].sum(), of[33], of[[44, 46, 59, 58]].sum(), of[10] * 20, of[128:].sum(), len(counts) / n, len(counts) / n**0.8, top[0] / n,
        top[1] / n, -float((shares * np.log(shares)).sum()) / max(1.0, math.log(n)), pairs / n, len(set(lines)) / len(lines), math.log1p(n / len(lines)),
        packed / size, tails[symbols + [33]].sum(), heads[65:91].sum(), float((lengths <= 1).mean()),
    ]


def cosines() -> tuple[np.ndarray, np.ndarray]:
    """The fixed random projection and phases."""
    rng = np.random.Generator(np.random.PCG64(SEED))
    return rng.normal(0, 1 / WIDTH, (N_STATS, N_COSINES)), rng.uniform(0, 2 * np.pi, N_COSINES)


def design(x: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Constant, standardised statistics and cosines."""
    z = np.clip((x - mean) / spread, -6, 6)
    projection, phase = cosines()
    return np.hstack([np.ones((len(z), 1)), z, math.sqrt(2 / N_COSINES) * np.cos(z @ projection + phase)])


def remainder(id_col: str, m: int):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % m


def features(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, x)`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = pa.array([statistics((t.as_py() or "").encode("utf-8", "replace")) for t in b["text"]], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b["id"], x], ["doc_id", "x"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, x array<double>")


def matrix(column) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, N_STATS)


def summed(rows: DataFrame, part, size: int) -> np.ndarray:
    """Sum over all partitions of the vector ``part(batch)`` of ``size`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            total += part(b)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["i", "v"])

    out = np.zeros(size)
    for r in rows.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():  # `size` rows
        out[r.i] = r.v
    return out


def pooled(n: np.ndarray, positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic label rate over the bins: block centres and rates."""
    blocks: list[list[float]] = []  # weight, positives, weighted place
    for i in np.flatnonzero(n):
        blocks.append([n[i], positive[i], n[i] * (i + 0.5)])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    if not blocks:
        return np.zeros(1), np.full(1, 0.5)
    w, p, place = np.array(blocks).T
    return LOW + (HIGH - LOW) * place / w / BINS, p / w


def fit(train: DataFrame) -> dict:
    """The model from ``(x, y)`` rows; without rows every score is 0.5."""
    d, m = N_STATS, 1 + N_STATS + N_COSINES

    def moments(b):
        x = matrix(b["x"])
        return np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])

    s = summed(train, moments, 1 + 2 * d)
    n = max(1.0, s[0])
    mean = s[1 : 1 + d] / n
    spread = np.sqrt(np.maximum(s[1 + d :] / n - mean**2, 1e-6))

    def normal(b):
        z, y = design(matrix(b["x"]), mean, spread), b["y"].to_numpy()
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    s = summed(train, normal, m * m + m)
    weights = np.linalg.solve(s[: m * m].reshape(m, m) + RIDGE * np.eye(m), s[m * m :])

    def rates(b):
        raw, y = design(matrix(b["x"]), mean, spread) @ weights, b["y"].to_numpy()
        at = np.clip((raw - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1).astype(int)
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, y, minlength=BINS)])

    s = summed(train, rates, 2 * BINS)
    centres, rate = pooled(s[:BINS], s[BINS:])
    return {"mean": mean, "spread": spread, "weights": weights, "centres": centres, "rate": rate}


def score(model: dict, x: np.ndarray) -> np.ndarray:
    """Calibrated scores; a thousandth of the raw score orders texts of one isotonic level."""
    raw = design(x, model["mean"], model["spread"]) @ model["weights"]
    return 0.999 * np.interp(raw, model["centres"], model["rate"]) + 0.001 * np.clip((raw - LOW) / (HIGH - LOW), 0, 1)


def classify(docs: DataFrame, labels: DataFrame, label_col: str = "quality", folds: int = 4, held: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, score)`` of every row of ``docs``.

    Learns from all labelled rows outside the held-out fold of the id's CRC-32;
    nothing but the text enters a score.  Null and empty texts have all statistics
    zero.  Rows without an id hash as ''.  Repeated documents are scored each and
    alike, and a document with several labels is learned once with each of them.
    Without labels every score is about 0.5; an empty table gives no rows.
    """
    rows = land(features(docs, id_col, text_col).withColumn("held_out", remainder("doc_id", folds) == held), "statistics")
    known = labels.where(F.col(label_col).isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("y")).distinct()
    train = land(rows.where(~F.col("held_out")).join(known, "doc_id").select("x", "y"), "labelled")
    model = docs.sparkSession.sparkContext.broadcast(fit(train))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["held_out"], pa.array(score(model.value, matrix(b["x"])))], ["doc_id", "held_out", "score"])

    return rows.select("doc_id", "held_out", "x").mapInArrow(run, "doc_id long, held_out boolean, score double")


def op7(spark, sf_dir: str) -> DataFrame:
    """Contract of ``op7_quality_classifier``."""
    found = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))
