"""Substring dedup by repeated-phrase automata.

A passage of ``width`` words that also starts earlier (at a smaller id, or
before it in the same document) is removed.

1. Runs of windows are keyed by anchors (``runs.py``); only runs whose anchor
   recurs stay, and equal runs are folded to a class with its first place:
   every other member is a confirmed repeat as a whole.
2. Where an anchor has several classes, their first members go to the anchor's
   shard.  There the windows that occur in two classes are confirmed as
   phrases, compiled into an Aho-Corasick automaton over word numbers, and all
   runs of the shard are streamed through it; each phrase's least place stays.
   A shard's automaton covers about ``SHARD_BYTES`` of text.
3. An anchor with more than ``HOT_CLASSES`` classes (the edge of a passage that
   very many documents share) is not gathered: its windows are grouped by
   their 128-bit content hash, with the least place combined before the shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoline.llm.common import id_key, land, table, text_key
from cargoline.llm.runs import (
    WINDOW_SCHEMA, candidates, classes, contents, contested, grouped, run_rows, total, window_batch, window_hashes, with_spans,
)

WIDTH, GRAM = 20, 4
SHARD_BYTES = 1 << 19
HOT_CLASSES = 2048
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


class WordNumbers(dict):
    """64-bit XXH64 of a word, remembered for at most 2^18 words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 18:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def word_symbols():
    numbers = WordNumbers()

    def symbols(text: bytes) -> np.ndarray:
        words = text.split()
        return np.fromiter(map(numbers.__getitem__, words), np.uint64, len(words))

    return symbols


def _cut_run(width: int):
    def cut(text: bytes):
        words = text.split()
        return lambda start, n: b" ".join(words[start : start + n + width - 1])

    return cut


def phrase_matches(bodies: list[bytes], width: int) -> list[tuple[int, int, int]]:
    """``(phrase, body, start)`` of every phrase of ``width`` words found twice or more."""
    import ahocorasick

    numbers: dict[bytes, int] = {}
    runs = [tuple(numbers.setdefault(w, len(numbers)) for w in body.split()) for body in bodies]
    seen: dict[tuple, int] = {}
    for run in runs:
        for i in range(len(run) - width + 1):
            phrase = run[i : i + width]
            seen[phrase] = seen.get(phrase, 0) + 1
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    phrases = 0
    for phrase, times in seen.items():
        if times > 1:
            automaton.add_word(phrase, phrases)
            phrases += 1
    if not phrases:
        return []
    automaton.make_automaton()
    return [(phrase, k, end - width + 1) for k, run in enumerate(runs) for end, phrase in automaton.iter(run)]


def _later(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for docs, places, bodies in grouped(batches, SHARD_BYTES):
        found = phrase_matches(bodies, width)
        least: dict[int, tuple[int, int]] = {}
        for phrase, k, start in found:
            at = (docs[k], places[k] + start)
            least[phrase] = min(least.get(phrase, at), at)
        rows = [at for phrase, k, start in found if (at := (docs[k], places[k] + start)) != least[phrase]]
        if rows:
            yield window_batch([r[0] for r in rows], [r[1] for r in rows], [1] * len(rows))


def repeated_windows(docs: DataFrame, id_col: str, text_col: str, width: int, k: int) -> DataFrame:
    """``(doc, place, n)``: ``n`` windows from ``place`` on that start earlier elsewhere."""
    cand = candidates(run_rows(docs, word_symbols(), width, k, id_col, text_col), "phrase-runs")
    folded = land(classes(cand), "phrase-classes")
    whole = cand.join(folded.where("rep <> last").select("anchor", "span", "rep"), ["anchor", "span"]).where(
        F.struct("doc", "place") != F.col("rep")
    ).select("doc", "place", "n")
    bodies = land(contents(contested(folded), docs, _cut_run(width), id_col, text_col), "phrase-bodies")

    def run(batches):
        return _later(batches, width)

    shards = bodies.where(F.col("members") <= HOT_CLASSES).repartition("anchor").sortWithinPartitions("anchor", "doc", "place")
    hashes = window_hashes(bodies.where(F.col("members") > HOT_CLASSES), word_symbols(), width)
    first = hashes.groupBy("h", "g").agg(F.min(F.struct("doc", "place")).alias("rep"), F.max(F.struct("doc", "place")).alias("last"))
    hot = hashes.join(land(first.where("rep <> last").select("h", "g", "rep"), "phrase-windows"), ["h", "g"]).where(F.struct("doc", "place") != F.col("rep"))
    return whole.union(shards.mapInArrow(run, WINDOW_SCHEMA)).union(hot.select("doc", "place", F.lit(1).alias("n")))


def _without(text: bytes, spans: list[tuple[int, int]]) -> tuple[int, str]:
    """Number of words, and the text without the words of ``spans``."""
    if not spans:
        return len(text.split()), text.decode("utf-8", "surrogatepass")
    starts = [m.start() for m in WORD.finditer(text)]
    out, at = [], 0
    for lo, hi in spans:
        out.append(text[at : starts[lo]])
        at = starts[hi] if hi < len(starts) else len(text)
    out.append(text[at:])
    return len(starts), b"".join(out).decode("utf-8", "surrogatepass")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, k: int = GRAM) -> DataFrame:
    """``(doc_id, tkey, n_words, spans, kept)`` for every row of ``docs``.

    ``spans`` are the removed word ranges ``[start, stop)``, ``kept`` the text
    without them (white space before kept words stays as it was).  Null and
    empty texts have no words and keep ''.  Rows equal in id and text are one
    document and get the same result; rows that share an id but not a text
    are ordered by a hash of the text.  A null id sorts before all others.
    Other columns are ignored; an empty table gives no rows.
    """
    removed = repeated_windows(docs, id_col, text_col, width, k)
    return with_spans(docs, removed, width, _without, id_col, text_col, "n_words", "string")


def apply_removal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeats taken out of the texts and ``n_chars``, if there, set anew; other columns and rows stay."""
    found = remove_repeats(docs, id_col, text_col)
    changed = found.where(F.size("spans") > 0).select(
        F.coalesce("doc_id", F.lit(-(2**63))).alias("_id"), F.col("tkey").alias("_tkey"), F.col("kept").alias("_kept")
    ).dropDuplicates(["_id", "_tkey"])
    doc = F.struct(*[docs[c] for c in docs.columns])
    rows = docs.select(doc.alias("_doc"), id_key(id_col).alias("_id"), text_key(text_col).alias("_tkey")).join(changed, ["_id", "_tkey"], "left")
    cut = F.col("_kept").isNotNull()
    new = {c: F.col(f"_doc.`{c}`") for c in docs.columns}
    new[text_col] = F.when(cut, F.col("_kept")).otherwise(new[text_col])
    if "n_chars" in new:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(cut, F.char_length("_kept").cast(kind)).otherwise(new["n_chars"])
    return rows.select(*[v.alias(c) for c, v in new.items()])


def op10(spark, sf_dir: str) -> DataFrame:
    """Contract of ``op10_substring_dedup``."""
    found = remove_repeats(table(spark, sf_dir, "documents"))
    words = F.array_join(F.regexp_extract_all("kept", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)), " ")
    return found.select("doc_id", "n_words", total("spans").alias("n_removed"), F.sha2(words, 256).alias("kept_sha256"))
