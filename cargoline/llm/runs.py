"""Anchored runs: how repeated windows of a fixed length are found by one key each.

A window is ``width`` consecutive symbols (bytes or words).  Its anchor is the
``k``-gram in it with the least hash (the leftmost of equal ones), so equal
windows have equal anchors at equal offsets.  Neighbouring windows share their
anchor in runs of about ``(width - k) / 2``; a run, not a window, is the unit
that is shuffled.  ``candidates`` keeps the runs whose anchor occurs at two
places or more, which every repeated window's run does.

Places are ``(doc, place)``: ``doc`` is the document id and ``place`` holds 31
bits of the text's CRC-32 above the first window's start (32 bits).  Rows equal
in id and text therefore count as one document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoline.llm.common import id_key, land, landed, text_key, texts

RUN_SCHEMA = "anchor long, span long, doc long, place long, n int"
CHUNK = 1 << 20  # k-grams per chunk; a k-gram's place in it takes 20 bits
START_MASK = (1 << 32) - 1

# Odd multipliers of the two polynomial hashes (mod 2^64).
GRAM_BASE, SPAN_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


class Powers:
    """Powers of an odd base and of its inverse mod 2^64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def need(self, n: int) -> None:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, base in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def prefix(self, symbols: np.ndarray) -> np.ndarray:
        """``P`` with ``(P[j] - P[i]) * down[i]`` the hash of ``symbols[i:j]``."""
        self.need(len(symbols) + 1)
        out = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(symbols * self.up[: len(symbols)], out=out[1:])
        return out


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    out, size = values, 1
    while 2 * size <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def runs_of(symbols: np.ndarray, width: int, k: int, grams: Powers, spans: Powers):
    """``(anchor, span, first, n)`` arrays of one document's runs of windows."""
    windows = len(symbols) - width + 1
    if windows <= 0:
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty
    w = width - k + 1
    p, q = grams.prefix(symbols), spans.prefix(symbols)
    gram = mixed((p[k:] - p[:-k]) * grams.down[: len(p) - k])
    picked = []
    for start in range(0, windows, CHUNK - w):
        part = gram[start : start + CHUNK]
        keyed = (part & np.uint64(~(CHUNK - 1) & (2**64 - 1))) | np.arange(len(part), dtype=np.uint64)
        least = sliding_min(keyed, w)[: CHUNK - w]
        picked.append((least & np.uint64(CHUNK - 1)).astype(np.int64) + start)
    at = np.concatenate(picked)[:windows]
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    n = np.diff(np.append(first, windows))
    span = mixed((q[first + n + width - 1] - q[first]) * spans.down[first])
    return gram[at[first]].view(np.int64), span.view(np.int64), first, n


def run_rows(docs: DataFrame, symbols: Callable[[bytes], np.ndarray], width: int, k: int, id_col: str, text_col: str) -> DataFrame:
    """One row per run of every document (``RUN_SCHEMA``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, spans = Powers(GRAM_BASE), Powers(SPAN_BASE)
        for b in batches:
            ids, tkeys = b["id"].to_numpy(), b["tkey"].to_numpy()
            out, size = [], 0
            for i, text in enumerate(texts(b["text"])):
                anchor, span, first, n = runs_of(symbols(text), width, k, grams, spans)
                if len(first):
                    out.append((anchor, span, np.full(len(n), ids[i]), (int(tkeys[i]) << 32) + first, n.astype(np.int32)))
                    size += len(n)
                if out and (size > 1 << 17 or i + 1 == b.num_rows):
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["anchor", "span", "doc", "place", "n"])
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["anchor", "span", "doc", "place", "n"])

    rows = docs.select(id_key(id_col).alias("id"), text_key(text_col).alias("tkey"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, RUN_SCHEMA)


def candidates(runs: DataFrame, name: str) -> DataFrame:
    """Runs whose anchor occurs at two places or more, landed.

    The runs are written first: both passes over them read the files, so each text is cut once. The first shuffle carries one minimum and one maximum per anchor, combined
    before it, and is written, so that the second, a semi-join, stands on two plain
    exchanges and AQE can split its hot anchors.  Both files go once the candidates are written.
    """
    tag = F.xxhash64("doc", "place")
    with landed(runs, f"{name}-all") as runs:
        tagged = runs.select("anchor", tag.alias("tag")).groupBy("anchor").agg(F.min("tag").alias("a"), F.max("tag").alias("b"))
        with landed(tagged.where("a <> b").select("anchor"), f"{name}-anchors") as shared:
            return land(runs.join(shared, "anchor", "left_semi"), name)


def classes(cand: DataFrame) -> DataFrame:
    """``(anchor, span, n, rep, last)``: equal runs folded to their least place."""
    at = F.struct("doc", "place")
    return cand.groupBy("anchor", "span").agg(F.first("n").alias("n"), F.min(at).alias("rep"), F.max(at).alias("last"))


def contested(folded: DataFrame) -> DataFrame:
    """Classes whose anchor has another class, with their number ``members``."""
    many = land(folded.groupBy("anchor").agg(F.count("*").alias("members")).where("members > 1"), "contested")
    return folded.join(many, "anchor")


def squeezed(text: bytes) -> bytes:
    """``text`` compressed, its length in front."""
    return len(text).to_bytes(8, "little") + pa.compress(text, "zstd", asbytes=True)


def unsqueezed(body: bytes) -> bytes:
    size = int.from_bytes(body[:8], "little")
    return pa.decompress(body[8:], size, "zstd", asbytes=True) if size else b""


def packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc, tkey, body)``: the texts, compressed for a shuffle by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            body = pa.array([squeezed(t) for t in texts(b["text"])], pa.binary())
            yield pa.RecordBatch.from_arrays([b["id"], b["tkey"], body], ["doc", "tkey", "body"])

    rows = docs.select(id_key(id_col).alias("id"), text_key(text_col).alias("tkey"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc long, tkey long, body binary")


def by_document(places: DataFrame) -> DataFrame:
    """``(doc, tkey, starts, counts, ...)``: rows of one document in one list."""
    cols = [c for c in places.columns if c not in ("doc", "place")]
    item = F.struct(F.col("place").bitwiseAND(F.lit(START_MASK)).alias("start"), *cols)
    return places.groupBy("doc", F.shiftright("place", 32).alias("tkey")).agg(F.collect_list(item).alias("items"))


def contents(wanted: DataFrame, docs: DataFrame, cut: Callable, id_col: str, text_col: str) -> DataFrame:
    """``(anchor, members, doc, place, body)``: the symbols under each wanted run.

    ``cut(text)`` returns a function from ``(start, n)`` to the bytes of the run.
    """
    listed = by_document(wanted.select("anchor", "members", "rep.doc", "rep.place", "n"))
    names = ["anchor", "members", "doc", "place", "body"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, tkey, body, items in zip(*(b[c] for c in ("doc", "tkey", "body", "items"))):
                slice_of, high, rows = cut(unsqueezed(body.as_py())), tkey.as_py() << 32, items.as_py()
                for lo in range(0, len(rows), 4096):
                    part = rows[lo : lo + 4096]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([r["anchor"] for r in part], pa.int64()),
                        pa.array([r["members"] for r in part], pa.int64()),
                        pa.array([doc.as_py()] * len(part), pa.int64()),
                        pa.array([high + r["start"] for r in part], pa.int64()),
                        pa.array([slice_of(r["start"], r["n"]) for r in part], pa.binary()),
                    ], names)

    # Repeated rows of a document would give its runs twice.
    texts_once = packed(docs, id_col, text_col).groupBy("doc", "tkey").agg(F.first("body").alias("body"))
    return texts_once.join(listed, ["doc", "tkey"]).mapInArrow(
        run, "anchor long, members long, doc long, place long, body binary"
    )


def grouped(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[list, list, list]]:
    """Whole anchor groups of an anchor-sorted stream, ``limit`` body bytes or a little more at a time."""
    docs, places, bodies, size, last = [], [], [], 0, None
    for b in batches:
        for anchor, doc, place, body in zip(*(b[c].to_pylist() for c in ("anchor", "doc", "place", "body"))):
            if anchor != last and size > limit:
                yield docs, places, bodies
                docs, places, bodies, size = [], [], [], 0
            last = anchor
            docs.append(doc), places.append(place), bodies.append(body)
            size += len(body)
    if docs:
        yield docs, places, bodies


WINDOW_SCHEMA = "doc long, place long, n int"


def window_batch(docs: list[int], places: list[int], n: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(docs, pa.int64()), pa.array(places, pa.int64()), pa.array(n, pa.int32())], ["doc", "place", "n"]
    )


def window_hashes(found: DataFrame, symbols: Callable[[bytes], np.ndarray], width: int) -> DataFrame:
    """``(h, g, doc, place)`` for every window under ``found``: 128 bits of content.

    The exact way for anchors with very many different runs: windows are
    counted by content, combined before the shuffle, and never gathered.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b2 = Powers(GRAM_BASE), Powers(SPAN_BASE)
        for b in batches:
            for doc, place, body in zip(*(b[c].to_pylist() for c in ("doc", "place", "body"))):
                s = symbols(body)
                n = len(s) - width + 1
                cols = [mixed((p[width:] - p[:-width]) * x.down[:n]).view(np.int64) for x in (a, b2) for p in (x.prefix(s),)]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, cols), pa.array(np.full(n, doc)), pa.array(place + np.arange(n))], ["h", "g", "doc", "place"]
                )

    return found.select("doc", "place", "body").mapInArrow(run, "h long, g long, doc long, place long")


def merged(items, extra: int) -> list[tuple[int, int]]:
    """Union of ``[start, start + n + extra)`` as sorted disjoint spans."""
    out: list[list[int]] = []
    for start, stop in sorted((r["start"], r["start"] + r["n"] + extra) for r in items):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [tuple(x) for x in out]


def with_spans(docs: DataFrame, removed: DataFrame, width: int, cut: Callable, id_col: str, text_col: str, unit: str, kind: str) -> DataFrame:
    """``(doc_id, tkey, n, spans, kept)`` of every row of ``docs``.

    ``removed`` has windows ``(doc, place, n)``; ``cut(text, spans)`` returns
    the number of units of the text and what is left of it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                p = b.slice(lo, 512)
                n, spans, kept = [], [], []
                for body, items in zip(p["body"], p["items"]):
                    found = merged(items.as_py() or [], width - 1)
                    units, left = cut(unsqueezed(body.as_py()), found)
                    n.append(units)
                    spans.append([{"start": x, "stop": y} for x, y in found])
                    kept.append(left)
                yield pa.RecordBatch.from_arrays([
                    p["doc"], p["tkey"], pa.array(n, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                    pa.array(kept, pa.binary() if kind == "binary" else pa.string()),
                ], ["doc", "tkey", unit, "spans", "kept"])

    rows = packed(docs, id_col, text_col).join(by_document(removed), ["doc", "tkey"], "left")
    out = rows.select("doc", "tkey", "body", "items").mapInArrow(
        run, f"doc long, tkey long, {unit} long, spans array<struct<start:long,stop:long>>, kept {kind}"
    )
    return out.withColumn("doc_id", F.when(F.col("doc") != F.lit(-(2**63)), F.col("doc")))


def total(spans: str):
    """Number of units in an array of spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda a, x: a + x["stop"] - x["start"])
