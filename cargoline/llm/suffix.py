"""Suffix-array dedup: maximal repeats from the LCP-interval tree.

Every byte under a ``width``-byte string that also starts anywhere else is
removed.

1. Runs of windows are keyed by anchors (``runs.py``); runs whose anchor does not
   recur hold no repeat.  Equal runs are folded to a class; a class with two
   places is repeated as a whole.
2. Where an anchor has several classes, one text of each goes to the anchor's
   shard, where an enhanced suffix array (suffix order and LCP by prefix
   doubling) is scanned with a stack for LCP intervals of at least ``width``;
   an interval whose suffixes differ in the byte to their left is a
   maximal repeat, given out with all of its occurrences.
3. An anchor with more than ``HOT_CLASSES`` classes is not gathered: its
   windows are grouped by their 128-bit content hash instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoline.llm.common import land, table
from cargoline.llm.runs import (
    WINDOW_SCHEMA, candidates, classes, contents, contested, grouped, run_rows, total, window_batch, window_hashes, with_spans,
)

WIDTH, GRAM = 200, 64
SHARD_BYTES = 1 << 19
HOT_CLASSES = 2048
STEP = 7  # bytes in the first sort key, whose last byte holds how many there are

# One odd 64-bit number per byte value, from a fixed generator.
BYTE_NUMBERS = np.random.Generator(np.random.PCG64(5)).integers(0, 2**64, 256, np.uint64) | np.uint64(1)


def byte_symbols(text: bytes) -> np.ndarray:
    return BYTE_NUMBERS[np.frombuffer(text, np.uint8)]


def enhanced_suffix_array(blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order over all ``blocks`` and the LCP of neighbours; no match crosses a block's end."""
    lengths = np.array([len(b) for b in blocks])
    buffer = np.frombuffer(b"".join(blocks), np.uint8)
    n = len(buffer)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(n)  # bytes to the block's end
    key = np.zeros(n, np.uint64)
    for i in range(STEP):
        byte = np.zeros(n, np.uint64)
        byte[: n - i] = buffer[i:]
        key = key << np.uint64(8) | np.where(left > i, byte, np.uint64(0))
    key = key << np.uint64(8) | np.minimum(left, STEP).astype(np.uint64)
    ranks, depth, deepest = [], STEP, int(lengths.max(initial=0))
    while True:
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate(([1], ordered[1:] != ordered[:-1])))
        ranks.append((depth, rank))
        if depth >= deepest:
            break
        second = np.zeros(n, np.int64)
        second[: n - depth] = rank[depth:]
        key = (rank << 32 | np.where(left > depth, second, 0)).astype(np.uint64)
        depth *= 2
    a, b = order[:-1], order[1:]
    lcp, shorter = np.zeros(max(0, n - 1), np.int64), np.minimum(left[a], left[b])
    for depth, rank in [*reversed(ranks), *[(1, buffer)] * (STEP - 1)]:
        at = np.minimum(lcp, shorter - 1)
        same = (lcp < shorter) & (rank[a + at] == rank[b + at])
        if depth == 1:
            same &= open_
            open_ = same
        lcp += np.where(same, np.minimum(shorter - lcp, depth), 0)
        if depth == STEP:
            open_ = np.ones(len(lcp), bool)
    return order, lcp


def maximal_repeats(blocks: list[bytes], least: int) -> list[tuple[int, np.ndarray]]:
    """``(length, positions)`` of every maximal repeat of ``least`` bytes or more.

    Positions are offsets into the joined blocks.  The stack holds open LCP
    intervals; a closed one is a maximal repeat if the bytes before its suffixes
    differ (a block's start differs from everything).
    """
    if not blocks:
        return []
    order, lcp = enhanced_suffix_array(blocks)
    lengths = np.array([len(b) for b in blocks])
    buffer = np.frombuffer(b"".join(blocks), np.uint8).astype(np.int64)
    before = np.concatenate(([-1], buffer[:-1]))
    heads = (np.cumsum(lengths) - lengths)[lengths > 0]
    before[heads] = -1 - np.arange(len(heads))
    before = before[order]
    changes = np.concatenate(([0], np.cumsum(before[1:] != before[:-1])))  # diversity of [i, j]: changes[j] > changes[i]
    out: list[tuple[int, np.ndarray]] = []
    high = np.flatnonzero(lcp >= least)
    if not len(high):
        return out
    for part in np.split(high, np.flatnonzero(np.diff(high) > 1) + 1):
        stack: list[tuple[int, int]] = []  # (lcp, left border)
        for i, value in zip([*part.tolist(), int(part[-1]) + 1], [*lcp[part].tolist(), 0]):
            border = i
            while stack and stack[-1][0] > value:
                length, border = stack.pop()
                if changes[i] > changes[border]:
                    out.append((length, order[border : i + 1]))
            if value and (not stack or stack[-1][0] < value):
                stack.append((value, border))
    return out


def _shared(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for docs, places, bodies in grouped(batches, SHARD_BYTES):
        repeats = maximal_repeats(bodies, width)
        if not repeats:
            continue
        longest: dict[int, int] = {}
        for length, positions in repeats:
            for p in positions.tolist():
                if longest.get(p, 0) < length:
                    longest[p] = length
        at = np.fromiter(longest, np.int64, len(longest))
        n = np.fromiter(longest.values(), np.int64, len(longest)) - width + 1
        heads = np.concatenate(([0], np.cumsum([len(b) for b in bodies])))
        block = np.searchsorted(heads, at, "right") - 1
        yield window_batch(np.array(docs)[block], np.array(places)[block] + at - heads[block], n)


def repeated_windows(docs: DataFrame, id_col: str, text_col: str, width: int, k: int) -> DataFrame:
    """``(doc, place, n)``: ``n`` windows from ``place`` on that occur elsewhere too."""
    cand = candidates(run_rows(docs, byte_symbols, width, k, id_col, text_col), "byte-runs")
    folded = land(classes(cand), "byte-classes")
    whole = cand.join(folded.where("rep <> last").select("anchor", "span"), ["anchor", "span"]).select("doc", "place", "n")

    def cut(text: bytes):
        return lambda start, n: text[start : start + n + width - 1]

    def run(batches):
        return _shared(batches, width)

    bodies = land(contents(contested(folded), docs, cut, id_col, text_col), "byte-bodies")
    shards = bodies.where(F.col("members") <= HOT_CLASSES).repartition("anchor").sortWithinPartitions("anchor", "doc", "place")
    hashes = window_hashes(bodies.where(F.col("members") > HOT_CLASSES), byte_symbols, width)
    tag = F.xxhash64("doc", "place")
    twice = land(hashes.groupBy("h", "g").agg(F.min(tag).alias("a"), F.max(tag).alias("b")).where("a <> b").select("h", "g"), "byte-windows")
    hot = hashes.join(twice, ["h", "g"], "left_semi").select("doc", "place", F.lit(1).alias("n"))
    # One member stands for its class in a shard; the others are in `whole`.
    return whole.union(shards.mapInArrow(run, WINDOW_SCHEMA)).union(hot)


def _without(text: bytes, spans: list[tuple[int, int]]) -> tuple[int, bytes]:
    out, at = [], 0
    for lo, hi in spans:
        out.append(text[at:lo])
        at = hi
    return len(text), b"".join([*out, text[at:]])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, k: int = GRAM) -> DataFrame:
    """``(doc_id, tkey, n_bytes, spans, kept)`` for every row of ``docs``.

    ``spans`` are the removed byte ranges ``[start, stop)``, maximal and
    disjoint; ``kept`` the other bytes.  Null and empty texts are
    empty.  Rows equal in id and text are one document (they don't repeat each
    other) and get the same result.  A null id counts as one id.  Other
    columns are ignored; an empty table gives no rows.
    """
    removed = repeated_windows(docs, id_col, text_col, width, k)
    return with_spans(docs, removed, width, _without, id_col, text_col, "n_bytes", "binary")


def op5(spark, sf_dir: str) -> DataFrame:
    """Contract of ``op5_suffix_array_dedup``."""
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", total("spans").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
