"""Language-model scoring by online logistic context mixing.

A text is lower-cased and split into words and one end token; like a compressor
with a dictionary transform, it is coded as binary decisions:

* frequent tokens (at least a 2^-``HEAVY_BITS`` share of all training tokens, so at most
  2^19 of them) and one escape are the leaves of a Huffman tree; a token is
  the decisions on its path.  Three predictors give each decision a probability: the
  node's own counts, and two tables of counts hashed by node and the last one
  or two tokens, each smoothed with the predictor before it.  Their logits are mixed
  by weights, of which a gate (how often each hashed context was seen) picks the set; after every decision
  the set is refined by its error, afresh in every ``SEGMENT`` decisions, from
  weights learned over all training texts.
* a token behind the escape has its training count's share, discounted; the
  discount's mass goes to its spelling, the bits of its bytes predicted by
  hashed byte contexts.  Both are distributions, so the score is one.

What is gathered grows with the corpus: token counts (a table that is joined,
never broadcast) and, of bounded size per task, blocks of the hashed tables, both
summed by Spark.  The context tables have ``SLOTS_A_TOKEN`` slots for each training
token, up to 2^``MOST_SLOT_BITS``; beyond that contexts share slots more and more.
Broadcast are the frequent tokens and the summed tables, whose sizes are bounded above.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain, compress, repeat
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoline.llm.classifier import remainder
from cargoline.llm.common import blocks_of, land, table
from cargoline.llm.perplexity import BATCH, BATCH_ROWS
from cargoline.session import settings

HEAVY_BITS, BLOCK = 19, 4096
LEAST_SLOT_BITS, MOST_SLOT_BITS, SLOTS_A_TOKEN = 16, 23, 8  # of the context tables
SPELL_BITS, REACHES, SPELL_PRIOR = 20, (1, 2, 3), 2.0  # slots and context bytes of the spelling tables
SEGMENT, RATE, PRIOR = 1024, 0.03, 0.5
GATES, INPUTS = 9, 3
PART = 1 << 15  # decisions whose inputs are reckoned at a time
TEXT_BYTES = 1 << 19  # text that is coded at a time
FIRST_WEIGHTS = np.tile([0.8, 0.1, 0.1], (GATES, 1))
END = b""  # the end token; no word is empty
ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


# --- the code of frequent tokens --------------------------------------------------


def huffman(tokens: list[bytes], counts: list[int], escape: int) -> SimpleNamespace:
    """Huffman paths over ``tokens``; the last leaf is the escape."""
    weights = [max(1, c) for c in counts] + [max(1, escape)]
    n = len(weights)
    heap = [(w, i) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    parent, bit, total = [0] * (2 * n - 1), [0] * (2 * n - 1), weights + [0] * (n - 1)
    for node in range(n, 2 * n - 1):
        for side in (0, 1):
            w, child = heapq.heappop(heap)
            parent[child], bit[child] = node, side
            total[node] += w
        heapq.heappush(heap, (total[node], node))
    paths: list[list[tuple[int, int]]] = []
    for leaf in range(n):
        path, at = [], leaf
        while at != 2 * n - 2:
            path.append((parent[at] - n, bit[at]))
            at = parent[at]
        paths.append(path[::-1])
    flat = [d for p in paths for d in p]
    ones = np.zeros(max(1, n - 1))
    for child in range(2 * n - 2):
        if bit[child]:
            ones[parent[child] - n] = total[child]
    share = np.clip(ones / np.array(total[n:] or [1.0]), 1e-9, 1 - 1e-9)
    return SimpleNamespace(
        tokens=tokens, escape=n - 1, counts=np.array(counts + [0], np.float64),
        start=np.concatenate(([0], np.cumsum([len(p) for p in paths]))).astype(np.int64),
        node=np.array([d[0] for d in flat], np.int32), bit=np.array([d[1] for d in flat], np.int8),
        prior=share.astype(np.float32), logit=logits(share.astype(np.float32)),
        slot_bits=slot_bits(sum(counts)),
    )


def logits(p: np.ndarray) -> np.ndarray:
    return np.log(p / (1 - p))


def slot_bits(tokens: int) -> int:
    """Size of the context tables: ``SLOTS_A_TOKEN`` a training token, up to a bound that fits a worker."""
    return min(MOST_SLOT_BITS, max(LEAST_SLOT_BITS, math.ceil(math.log2(max(1, SLOTS_A_TOKEN * tokens)))))


def numbers_of(code: SimpleNamespace) -> dict[bytes, int]:
    return {t: i for i, t in enumerate(code.tokens)}


def decisions(tokens: np.ndarray, docs: np.ndarray, code: SimpleNamespace) -> tuple[np.ndarray, ...]:
    """``(node, bit, slot1, slot2, doc)`` of a stream of token numbers; ``docs`` tells the document."""
    n = len(tokens)
    before = np.full((2, n), -1, np.int64)
    for back in (1, 2):
        same = docs[back:] == docs[:-back] if n > back else np.zeros(0, bool)
        before[back - 1, back:] = np.where(same, tokens[:-back], -1) if n > back else 0
    first = code.start[tokens]
    lengths = code.start[tokens + 1] - first
    first -= np.cumsum(lengths) - lengths
    at = np.repeat(first, lengths)
    at += np.arange(len(at))
    node, bit = code.node[at], code.bit[at]
    del at
    one = (before[0] + 2).astype(np.uint64) * np.uint64(ODD[0])
    two = (one + (before[1] + 2).astype(np.uint64)) * np.uint64(ODD[1])
    salt = node.astype(np.uint64)
    salt *= np.uint64(ODD[2])
    out = []
    for h in (one, two):
        h = np.repeat(h, lengths)
        h += salt
        h ^= h >> np.uint64(31)
        h *= np.uint64(ODD[1])
        h >>= np.uint64(64 - code.slot_bits)
        out.append(h.astype(np.int32))
    return node, bit, out[0], out[1], np.repeat(docs.astype(np.int32), lengths)


def inputs(node, bit, slot1, slot2, code: SimpleNamespace, tables, leave_out: bool) -> tuple[np.ndarray, np.ndarray]:
    """Logits ``(3, decisions)`` and gate of each decision."""
    x, gate = np.empty((INPUTS, len(node)), np.float32), np.zeros(len(node), np.int8)
    for lo in range(0, len(node), PART):  # parts whose arrays stay in a core's cache
        part = slice(lo, lo + PART)
        at, seen_by = node[part], gate[part]
        x[0, part] = code.logit[at]
        p = code.prior[at]  # each context's counts are smoothed with the shorter context's probability
        own = bit[part].astype(np.float32)
        for k, slot in enumerate((slot1[part], slot2[part])):
            both = pairs_at(tables[k], slot)
            zeros, ones = both[:, 0].astype(np.float32), both[:, 1].astype(np.float32)
            if leave_out:  # a training text must not vouch for itself
                ones = np.maximum(ones - own, 0)
                zeros = np.maximum(zeros - (1 - own), 0)
            seen = ones + zeros
            seen_by += np.int8(3**k) * ((seen > 0).view(np.int8) + (seen > 16))
            p1, q1 = ones + np.float32(PRIOR) * p, zeros + np.float32(PRIOR) * (1 - p)
            np.log(p1 / q1, out=x[k + 1, part])
            p = p1 / (p1 + q1)
    return np.clip(x, -12, 12, out=x), gate


def pairs_at(table: np.ndarray, slot: np.ndarray) -> np.ndarray:
    """Rows ``(zeros, ones)`` of a table of counts, each fetched at once."""
    return table.view(np.uint64).ravel()[slot].view(np.uint32).reshape(-1, 2)


def mix(x: np.ndarray, gate: np.ndarray, bit: np.ndarray, docs: np.ndarray, first: np.ndarray):
    """Natural log probability of each document's decisions by segment, and the refined weights of every segment.

    Segments run side by side: step ``t`` predicts, then learns from, the
    ``t``-th decision of each; the longest segments come first, so those that
    have a ``t``-th decision are a prefix, and the decisions of one step are
    laid side by side.  Returns ``(doc, log, weights, visits)`` of the segments.
    """
    n = len(bit)
    heads = np.flatnonzero(np.concatenate(([True], docs[1:] != docs[:-1])))
    sizes = np.diff(np.append(heads, n))
    cuts = -(-sizes // SEGMENT)
    starts = np.repeat(heads, cuts) + (np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)) * SEGMENT
    lengths = np.diff(np.append(starts, n))
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    active = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), "right")
    edges = np.concatenate(([0], np.cumsum(active)))
    lane = np.arange(n) - np.repeat(edges[:-1], active)
    source = starts[lane]
    source += np.repeat(np.arange(len(active)), active)
    x = [-row[source] for row in x]  # of the other sign, as the logistic function takes them
    bit = bit[source].astype(np.float32)
    rows = gate[source].astype(np.int64)
    del source
    lane *= GATES
    rows += lane
    lane //= GATES
    visits = np.bincount(rows, minlength=len(starts) * GATES).reshape(-1, GATES)
    w = [np.tile(first[:, k].astype(np.float32), len(starts)) for k in range(INPUTS)]
    out = np.empty(n, np.float32)
    # Constants and buffers as wide as a step: a plain number is converted anew in every call.
    most = len(starts)
    one, rate, low, high = (np.full(most, v, np.float32) for v in (1, RATE, 1e-6, 1 - 1e-6))
    held, spare = [np.empty(most, np.float32) for _ in w], np.empty(most, np.float32)
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
        m = hi - lo
        if m < most:
            most, one, rate, low, high, spare, held = m, one[:m], rate[:m], low[:m], high[:m], spare[:m], [v[:m] for v in held]
        r, p = rows[lo:hi], out[lo:hi]
        xs = [row[lo:hi] for row in x]
        for all_, v in zip(w, held):
            all_.take(r, out=v, mode="clip")
        np.multiply(held[0], xs[0], out=p)
        for v, xk in zip(held[1:], xs[1:]):
            np.multiply(v, xk, out=spare)
            np.add(p, spare, out=p)
        np.exp(p, out=p)
        np.add(p, one, out=p)
        np.divide(one, p, out=p)
        np.maximum(p, low, out=p)
        np.minimum(p, high, out=p)
        step = bit[lo:hi] - p
        np.multiply(step, rate, out=step)
        for all_, v, xk in zip(w, held, xs):
            np.multiply(step, xk, out=spare)
            np.subtract(v, spare, out=v)
            all_[r] = v
    out = np.log(np.where(bit > 0, out, 1 - out))
    return docs[starts], np.bincount(lane, out, len(starts)), np.stack(w, 1).reshape(-1, GATES, INPUTS), visits


# --- spelling of the other tokens ---------------------------------------------------


def spell_slots(words: list[bytes]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """``(slots of each table, bit, word)`` of every bit of every word and its closing 0 byte."""
    data = np.frombuffer(b"\0".join(w.replace(b"\0", b"\1") for w in words) + b"\0", np.uint8).astype(np.uint64)
    ends = data == 0
    number = np.concatenate(([0], np.cumsum(ends)[:-1]))
    heads = np.concatenate(([0], np.flatnonzero(ends)[:-1] + 1))
    place = np.arange(len(data)) - heads[number]
    bits = np.unpackbits(data.astype(np.uint8)[:, None], axis=1)
    nodes = np.ones((len(data), 8), np.uint64)  # the byte's bits so far, behind a leading 1
    for i in range(1, 8):
        nodes[:, i] = nodes[:, i - 1] * np.uint64(2) + bits[:, i - 1]
    slots, context = [], np.zeros(len(data), np.uint64)
    for back in range(1, REACHES[-1] + 1):
        earlier = np.zeros(len(data), np.uint64)
        earlier[back:] = data[:-back]
        context = (context + np.where(place >= back, earlier, np.uint64(0)) + np.uint64(1)) * np.uint64(ODD[0])
        if back in REACHES:
            h = (context[:, None] + nodes) * np.uint64(ODD[2])
            h ^= h >> np.uint64(31)
            slots.append((h * np.uint64(ODD[0]) >> np.uint64(64 - SPELL_BITS)).astype(np.int32).ravel())
    return slots, bits.ravel(), np.repeat(number, 8)


def spelled(words: list[bytes], tables) -> np.ndarray:
    """Natural log probability of each word's spelling.

    From the shortest context to the longest, each predictor's counts are
    smoothed with the probability so far.
    """
    slots, bit, word = spell_slots(words)
    p = np.full(len(bit), 0.5, np.float32)
    for table, slot in zip(tables, slots):
        both = pairs_at(table, slot)
        one, all_ = both[:, 1].astype(np.float32), both[:, 0].astype(np.float32)
        p = (one + SPELL_PRIOR * p) / (one + all_ + SPELL_PRIOR)
    return np.bincount(word, np.log(np.clip(np.where(bit, p, 1 - p), 1e-9, 1)), len(words))


# --- gathering ----------------------------------------------------------------------


def split_tokens(text: str | None) -> list[bytes]:
    tokens = (text or "").encode("utf-8", "replace").lower().split()
    tokens.append(END)
    return tokens


def token_counts(train: DataFrame) -> DataFrame:
    """``(token, h, c)``: how often each token occurs in all training texts."""

    def emit(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["token", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in batches:
            for text in b["text"]:
                counts.update(split_tokens(text.as_py()))
                if len(counts) > 1 << 18:
                    yield emit(counts)
                    counts = Counter()
        if counts:
            yield emit(counts)

    return train.select("text").mapInArrow(run, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c")).select(
        "token", F.xxhash64("token").alias("h"), "c"
    )


def token_hash(token: bytes) -> int:
    """Spark's ``xxhash64`` of a binary value."""
    h = xxhash.xxh64_intdigest(token, 42)
    return h - (1 << 64) if h >> 63 else h


def packed_counts(counts: np.ndarray) -> bytes:
    """Most counts of a block are 0 or small: one byte each if they fit, compressed."""
    wide = bool((counts > 255).any())
    data = counts.astype("<u4" if wide else np.uint8).tobytes()
    return bytes([wide]) + len(data).to_bytes(4, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unpacked_counts(value: bytes) -> np.ndarray:
    data = pa.decompress(value[5:], int.from_bytes(value[1:5], "little"), codec="zstd", asbytes=True)
    return np.frombuffer(data, "<u4" if value[0] else np.uint8)


def packed_tables(tables: list[np.ndarray]) -> list[list[bytes]]:
    """Small enough to be sent to every executor; a task unpacks them for itself."""
    return [[packed_counts(table[lo : lo + BLOCK]) for lo in range(0, len(table), BLOCK)] for table in tables]


def unpacked_tables(tables: list[list[bytes]], sizes: list[int]) -> list[np.ndarray]:
    """Tables ``(zeros, ones)``; no second copy of one is made on the way."""
    out = [np.empty((size, 2), np.uint32) for size in sizes]
    for table, parts in zip(out, tables):
        lo = 0
        for value in parts:
            part = unpacked_counts(value).reshape(-1, 2)
            table[lo : lo + len(part)] = part
            lo += len(part)
    return out


def gathered(rows: DataFrame, sizes: list[int], visit) -> list:
    """Tables of rows ``(zeros, ones)`` summed over all tasks.

    ``visit(batch, add)`` calls ``add(table, slots, bits)``.  A task sends each block
    of ``BLOCK`` slots it touched once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(2 * size, np.uint32) for size in sizes]

        def add(k: int, slot: np.ndarray, bit: np.ndarray) -> None:
            at = slot.astype(np.int64)
            at *= 2
            at += bit
            np.add.at(held[k], at, np.uint32(1))

        for b in batches:
            visit(b, add)
        for k, counts in enumerate(held):
            parts = counts.reshape(-1, min(2 * BLOCK, len(counts)))
            for i in np.flatnonzero(parts.any(axis=1)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([i], pa.int32()), pa.array([packed_counts(parts[i])], pa.binary())], ["k", "i", "data"]
                )

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sums = None, None
        for b in batches:
            for k, i, data in zip(*(b[c].to_pylist() for c in ("k", "i", "data"))):
                if (k, i) != last:
                    if last:
                        yield block(last, sums)
                    last, sums = (k, i), 0
                sums = np.minimum(sums + unpacked_counts(data).astype(np.int64), 2**32 - 1)
        if last:
            yield block(last, sums)

    def block(key, sums) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([packed_counts(sums)], pa.binary())], ["k", "i", "data"]
        )

    schema = "k int, i int, data binary"
    summed = rows.mapInArrow(run, schema).repartition("k", "i").sortWithinPartitions("k", "i").mapInArrow(total, schema)
    out = [np.zeros((size, 2), np.uint32) for size in sizes]
    for r in land(summed, "tables").toLocalIterator():  # fixed size: the tables' blocks
        part = unpacked_counts(r.data).reshape(-1, 2)
        out[r.k][r.i * len(part) : (r.i + 1) * len(part)] = part
    return out


def numbered(batch: pa.RecordBatch, numbers: dict[bytes, int], escape: int) -> Iterator[tuple[list[list[bytes]], np.ndarray, np.ndarray]]:
    """Tokens, token numbers and document numbers of some rows at a time."""
    for lo, n in blocks_of(batch["text"], TEXT_BYTES):
        lists = [split_tokens(t.as_py()) for t in batch.slice(lo, n)["text"]]
        sizes = [len(x) for x in lists]
        flat = np.fromiter(map(numbers.get, chain.from_iterable(lists), repeat(escape)), np.int64, sum(sizes))
        yield lists, flat, np.repeat(np.arange(len(lists)), sizes)


def train(docs: DataFrame) -> tuple[dict, DataFrame]:
    """The model from the rows ``(text, held_out)``, and the table of token counts."""
    sc = docs.sparkSession.sparkContext
    learned = docs.where(~F.col("held_out")).select("text")
    counts = land(token_counts(learned), "token-counts")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    # At most 2^HEAVY_BITS tokens can have such a share.
    heavy = sorted(((bytes(r.token), r.c) for r in counts.where(F.col("c") * (1 << HEAVY_BITS) >= n).select("token", "c").toLocalIterator()), key=lambda x: (-x[1], x[0]))
    light = counts.where(F.col("c") * (1 << HEAVY_BITS) < n)
    stats = light.agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") == 1, 1)), F.count(F.when(F.col("c") == 2, 1))).first()
    types, tokens, once, twice = map(int, stats)
    code = huffman([t for t, _ in heavy], [c for _, c in heavy], tokens + 1)
    code.slot_bits = slot_bits(n)
    held = sc.broadcast(code)

    def spell(b, add):
        for lo in range(0, b.num_rows, 4096):
            slots, bit, _ = spell_slots(b.slice(lo, 4096)["token"].to_pylist())
            for k, slot in enumerate(slots):
                add(k, slot, bit)

    # Spelling is learned from every type once; all of them, or short corpora would have none.
    spelling = gathered(counts.where(F.length("token") > 0).select("token"), [1 << SPELL_BITS] * len(REACHES), spell)

    def contexts(b, add):
        c = held.value
        for _, flat, of in numbered(b, numbers_of(c), c.escape):
            _, bit, slot1, slot2, _ = decisions(flat, of, c)
            add(0, slot1, bit), add(1, slot2, bit)

    tables = gathered(learned, [1 << code.slot_bits] * 2, contexts)
    shared = sc.broadcast(packed_tables(tables))
    del tables

    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, sums, visits = held.value, np.zeros((GATES, INPUTS)), np.zeros(GATES)
        numbers, counted = numbers_of(c), unpacked_tables(shared.value, [1 << c.slot_bits] * 2)
        for b in batches:
            for _, flat, of in numbered(b, numbers, c.escape):
                node, bit, slot1, slot2, at = decisions(flat, of, c)
                if len(bit):
                    x, gate = inputs(node, bit, slot1, slot2, c, counted, True)
                    _, _, w, seen = mix(x, gate, bit, at, FIRST_WEIGHTS)
                    sums += (w * seen[:, :, None]).sum(0)
                    visits += seen.sum(0)
        data = np.concatenate([sums.ravel(), visits])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(data), dtype=np.int32)), pa.array(data)], ["i", "v"])

    data = np.zeros(GATES * (INPUTS + 1))
    for r in learned.mapInArrow(refine, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():  # 36 rows
        data[r.i] = r.v
    sums, visits = data[: GATES * INPUTS].reshape(GATES, INPUTS), data[GATES * INPUTS :]
    weights = (sums + 1000 * FIRST_WEIGHTS) / (visits + 1000)[:, None]
    discount = once / (once + 2 * twice) if once and twice else 0.5
    model = {
        "code": held, "tables": shared, "spelling": sc.broadcast(spelling), "weights": weights, "n": int(n), "v": int(v),
        "light_tokens": tokens, "discount": discount, "spell_share": discount * types / tokens if tokens else 1.0,
    }
    return model, counts


# --- scoring ------------------------------------------------------------------------


SCORE_ROWS = "row long, h long, tf double, spelled double, doc_id long, held_out boolean, n_bytes long, n_tokens long, known long, base double, mixed double"


def scored_parts(docs: DataFrame, model: dict) -> DataFrame:
    """For every text a row of sums, and a row for each of its light tokens."""
    code, tables, spelling, weights, n, v = (model[k] for k in ("code", "tables", "spelling", "weights", "n", "v"))
    schema = pa.schema([(f.split()[0], {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}[f.split()[1]]) for f in SCORE_ROWS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, row = code.value, TaskContext.get().partitionId() << 40
        numbers, counted, known = numbers_of(c), unpacked_tables(tables.value, [1 << c.slot_bits] * 2), {}
        for b in batches:
            ids, held = b["doc_id"], b["held_out"]
            done = 0
            for lists, flat, of in numbered(b, numbers, c.escape):
                mixed = np.zeros(len(lists))
                node, bit, slot1, slot2, at = decisions(flat, of, c)
                if len(bit):
                    x, gate = inputs(node, bit, slot1, slot2, c, counted, False)
                    text, value, _, _ = mix(x, gate, bit, at, weights)
                    mixed = np.bincount(text, value, len(lists))
                heavy = flat != c.escape
                # the constant part -log10(N + V + 1) of a token is added later
                base = np.bincount(of, np.where(heavy, np.log10(c.counts[flat] + 1), 0.0), len(lists))
                seen = np.bincount(of, heavy, len(lists)).astype(np.int64)
                light = [Counter() for _ in lists]
                for k, t in zip(of[~heavy].tolist(), compress(chain.from_iterable(lists), (~heavy).tolist())):
                    light[k][t] += 1
                if len(known) > 1 << 16:
                    known.clear()
                new = list({t for x in light for t in x if t not in known})
                for lo in range(0, len(new), 1 << 10):  # a part stays in a core's cache
                    part = new[lo : lo + (1 << 10)]
                    known.update(zip(part, zip(map(token_hash, part), spelled(part, spelling.value).tolist())))
                m = len(lists)
                rows = row + done + np.arange(m)
                yield pa.RecordBatch.from_arrays([
                    pa.array(rows), pa.nulls(m, pa.int64()), pa.nulls(m, pa.float64()), pa.nulls(m, pa.float64()), ids.slice(done, m), held.slice(done, m),
                    pa.array([len(t.as_py().encode("utf-8", "replace")) if t.is_valid else 0 for t in b["text"].slice(done, m)], pa.int64()),
                    pa.array([len(x) for x in lists], pa.int64()), pa.array(seen), pa.array(base), pa.array(mixed),
                ], schema=schema)
                sizes = [len(x) for x in light]
                if sum(sizes):
                    pairs = [(t, tf) for x in light for t, tf in x.items()]
                    k = len(pairs)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.repeat(rows, sizes)), pa.array([known[t][0] for t, _ in pairs], pa.int64()), pa.array([float(tf) for _, tf in pairs]),
                        pa.array([known[t][1] for t, _ in pairs]), *(pa.nulls(k, f.type) for f in list(schema)[4:]),
                    ], schema=schema)
                done += m
            row += b.num_rows

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, SCORE_ROWS)


def score(docs: DataFrame, folds: int = 7, held: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of every row of ``docs``, the held-out fold of the id's CRC-32 not learned from.

    ``base_score`` is the add-one unigram log10 probability, ``score`` the mixed
    model's, ``bits_per_byte`` the latter's bits over the text's bytes.  Null and
    empty texts are one end token.  Rows without an id hash as ''; repeated rows are
    scored each.  Other columns are ignored.  With no training row the counts
    are zero and every token is spelled; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (remainder(id_col, folds) == held).alias("held_out"), F.col(text_col).alias("text"))
    spark = docs.sparkSession
    with settings(spark, {BATCH: min(int(spark.conf.get(BATCH)), BATCH_ROWS)}):
        model, counts = train(rows)
        parts = land(scored_parts(rows, model), "score-parts")
    n, v, tokens = model["n"], model["v"], model["light_tokens"]
    for held in (model["code"], model["tables"], model["spelling"]):
        held.unpersist()  # the parts are written; executors need not keep the model
    # Sums of a text meet no count: each goes by its own row, not by one null.
    key = F.coalesce("h", F.col("row"))
    known = counts.where(F.col("c") * (1 << HEAVY_BITS) < n).select("h", "c")
    joined = parts.withColumn("key", key).join(known.withColumnRenamed("h", "key"), "key", "left")
    light = F.col("h").isNotNull()
    seen = light & F.col("c").isNotNull()
    share = F.coalesce((F.col("c") - model["discount"]) / float(tokens or 1), F.lit(0.0)) + model["spell_share"] * F.exp("spelled")
    sums = joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"), F.max("n_bytes").alias("n_bytes"),
        (F.sum(F.when(seen, F.col("tf")).otherwise(0.0)).cast("long") + F.max(F.coalesce("known", F.lit(0).cast("long")))).alias("n_known"),
        F.sum(F.when(seen, F.col("tf") * F.log10(F.col("c") + 1)).otherwise(F.coalesce("base", F.lit(0.0)))).alias("gain"),
        F.sum(F.when(light, F.col("tf") * F.log10(F.greatest(share, F.lit(1e-300)))).otherwise(F.col("mixed") / math.log(10))).alias("score"),
    )
    return sums.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
        (F.col("gain") - F.col("n_tokens") * math.log10(n + v + 1)).alias("base_score"), "score",
        (-F.col("score") / math.log10(2) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )


def op8(spark, sf_dir: str) -> DataFrame:
    """Contract of ``op8_lm_scoring``."""
    return score(table(spark, sf_dir, "documents"))
