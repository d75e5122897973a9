"""Byte-level BPE encoding and decoding with a pair occurrence index.

The texts of a partition are cut into pieces by the vocabulary's pattern.  All new distinct
pieces lie in one array of symbols, doubly linked so that merged symbols drop out.
An index maps each pair of neighbours that has a rank to all its positions.  The
active ranks are taken in ascending order; a rank's merge is applied at all its
positions at once, and only the pairs beside the merged symbols are entered anew.
Pieces are independent, so this order gives every piece what it would get alone.

There is no shuffle: a task holds ``TEXT_BYTES`` of text (or one longer text) at a time and
remembers the encoded pieces for its later texts, until they are over ``PIECES_HELD``.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoline.llm.common import table

TEXT_BYTES, PIECES_HELD = 1 << 23, 1 << 19
WIDE = 1 << 32
#: Fixed value: the pattern that cuts texts for byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ENCODED = "doc_id long, n_tokens long, ids binary, decoded string"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones are themselves,
    the others follow from U+0100 on."""
    out, extra = {}, 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out[chr(b)] = b
        else:
            out[chr(extra)] = b
            extra += 1
    return out


class Ragged:
    """Arrays of different lengths in one flat array."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray):
        self.flat, self.sizes = flat, sizes
        self.starts = np.cumsum(sizes) - sizes

    @classmethod
    def of(cls, parts: list[np.ndarray]) -> Ragged:
        return cls(np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts)))

    def plus(self, other: Ragged) -> Ragged:
        return Ragged(np.concatenate((self.flat, other.flat)), np.concatenate((self.sizes, other.sizes)))

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The arrays of ``numbers`` in a row, and how much has been given out after each."""
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        shift = np.repeat(self.starts[numbers] - (ends - sizes), sizes)
        return self.flat[shift + np.arange(len(shift))], ends


class Vocabulary:
    """Ids, ranks and bytes of a byte-level BPE file without a normaliser."""

    def __init__(self, path: str | None):
        import public_tokenizers

        with open(path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
            spec = json.load(f)
        cut = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or spec["model"]["type"] != "BPE" or cut.get("type") != "ByteLevel" or cut["add_prefix_space"] or not cut["use_regex"]:
            raise ValueError("not a plain byte-level BPE vocabulary")
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        spelled = {i: bytes(letters[c] for c in t) for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        spelled |= {i: text.encode() for text, i in self.special.items()}
        self.spelled = Ragged.of([np.frombuffer(spelled.get(i, b""), np.uint8) for i in range(max(spelled) + 1)])
        self.single = np.zeros(256, np.int64)
        for c, b in letters.items():
            self.single[b] = vocab[c]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.left, self.right = left, right
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left * WIDE + right
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 for none."""
        key = left * WIDE + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], -1)


def chosen(pos: np.ndarray, nxt: np.ndarray) -> np.ndarray:
    """Of the ascending positions of a pair of equal symbols those that merge: every other one of a chain."""
    chained = np.concatenate(([False], nxt[pos[:-1]] == pos[1:]))
    place = np.arange(len(pos))
    heads = np.maximum.accumulate(np.where(chained, 0, place))
    return pos[(place - heads) % 2 == 0]


def distinct(x: np.ndarray) -> np.ndarray:
    """Ascending, each value once."""
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


def encode_pieces(pieces: list[bytes], v: Vocabulary) -> Ragged:
    """The ids of each piece."""
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    n = int(sizes.sum())
    if not n:
        return Ragged(np.zeros(0, np.uint32), sizes)
    sym = v.single[np.frombuffer(b"".join(pieces), np.uint8)]
    ends = np.cumsum(sizes)
    nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
    nxt[ends[sizes > 0] - 1] = -1
    prv[(ends - sizes)[sizes > 0]] = -1
    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def enter(pos: np.ndarray) -> None:
        """Adds the pairs that begin at ``pos`` to the index."""
        rank = v.ranks(sym[pos], sym[nxt[pos]])
        pos, rank = pos[rank >= 0], rank[rank >= 0]
        if not len(rank):
            return
        order = np.argsort(rank, kind="stable")
        pos, rank = pos[order], rank[order]
        cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        for r, part in zip(rank[np.concatenate(([0], cuts))].tolist(), np.split(pos, cuts)):
            if r in index:
                index[r].append(part)
            else:
                index[r] = [part]
                heapq.heappush(active, r)

    enter(np.flatnonzero(nxt >= 0))
    while active:
        rank = heapq.heappop(active)
        parts = index.pop(rank)
        pos = distinct(np.concatenate(parts)) if len(parts) > 1 else parts[0]
        a, b = v.left[rank], v.right[rank]
        after = nxt[pos]
        pos = pos[(sym[pos] == a) & (after >= 0) & (sym[after] == b)]  # others have merged meanwhile
        if a == b and len(pos) > 1:
            pos = chosen(pos, nxt)
        if not len(pos):
            continue
        gone = nxt[pos]
        after = nxt[gone]
        sym[pos], sym[gone] = v.merged[rank], -1
        nxt[pos] = after
        inner = after >= 0
        prv[after[inner]] = pos[inner]
        before = prv[pos]
        enter(distinct(np.concatenate((pos[inner], before[before >= 0]))))
    alive = sym >= 0
    upto = np.concatenate(([0], np.cumsum(alive)))
    return Ragged(sym[alive].astype(np.uint32), upto[ends] - upto[ends - sizes])


class Numbers(dict):
    """Numbers its keys in the order in which they are asked for."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


class Encoder:
    """Encodes texts, with the pieces met before at hand."""

    def __init__(self, path: str | None = None):
        import regex

        self.vocabulary = Vocabulary(path)
        self.pattern = regex.compile(PATTERN)
        special = self.vocabulary.special
        # The longest special token that begins leftmost.
        names = sorted(special, key=len, reverse=True)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.forget()

    def forget(self) -> None:
        """Of the pieces met before only the special tokens stay."""
        special = self.vocabulary.special
        self.known = Numbers((name, i) for i, name in enumerate(special))
        self.ids = Ragged(np.array(list(special.values()), np.uint32), np.ones(len(special), np.int64))

    def plain(self, text: str) -> Iterable[str]:
        return self.pattern.findall(text) if len(text) < TEXT_BYTES else (m[0] for m in self.pattern.finditer(text))

    def pieces(self, text: str) -> Iterable[str]:
        """The text's pieces, those of a very long one by and by."""
        if self.specials is None or not any(name in text for name in self.vocabulary.special):
            return self.plain(text)
        return chain.from_iterable((part,) if i % 2 else self.plain(part) for i, part in enumerate(self.specials.split(text)))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; the special tokens' strings are their ids, as in the file."""
        if len(self.known) > PIECES_HELD:
            self.forget()
        before = len(self.known)
        numbers = [np.fromiter(map(self.known.__getitem__, self.pieces(t)), np.int64) for t in texts]
        new = [p.encode() for p in islice(self.known, before, None)]
        self.ids = self.ids.plus(encode_pieces(new, self.vocabulary))
        return [self.ids.take(x)[0] for x in numbers]

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids; bytes that are no UTF-8 become U+FFFD."""
        return self.vocabulary.spelled.take(ids)[0].tobytes().decode("utf-8", "replace")


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary_file: str | None = None) -> DataFrame:
    """``ENCODED`` of every row: ``ids`` are little-endian 32-bit, ``decoded`` is the text that they give back.

    Null and empty texts have no ids.  Repeated rows are encoded each; a null id stays
    null; other columns are ignored; an empty table gives no rows.  A text is held whole by its task, with
    some 20 bytes a byte for its ids and, while they merge, some 60 bytes a byte of pieces not met before.  ``vocabulary_file`` must be readable by every
    executor (default: the installed public vocabulary).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary_file)
        for b in batches:
            ids, column = b["doc_id"], b["text"].cast(pa.large_string())
            lengths = pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
            block = (np.cumsum(lengths) - lengths) // TEXT_BYTES
            for lo, hi in zip(starts := [0, *(np.flatnonzero(np.diff(block)) + 1).tolist()], [*starts[1:], len(lengths)]):
                found = encoder.encode([t.as_py() or "" for t in column.slice(lo, hi - lo)])
                yield pa.RecordBatch.from_arrays([
                    ids.slice(lo, hi - lo), pa.array(map(len, found), pa.int64()), pa.array([x.astype("<u4").tobytes() for x in found], pa.binary()), pa.array(map(encoder.decode, found), pa.string()),
                ], names=["doc_id", "n_tokens", "ids", "decoded"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, ENCODED)


def digest(encoded: DataFrame) -> DataFrame:
    """Hashes instead of ids and texts."""
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op13(spark, sf_dir: str) -> DataFrame:
    """Contract of ``op13_bpe_encoding``."""
    return digest(encode(table(spark, sf_dir, "documents")))
