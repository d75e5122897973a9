"""Order-preserving packing of token streams by dynamic programming.

The documents of an input partition form one stream of token ids in table
order.  The stream is cut into windows of at most ``window`` tokens at document
ends, sentence ends or, inside a long sentence, at every ``GRID``-th token.  A
window costs its padding (none at a power of two), a fixed ``WINDOW_COST`` and
the truncation penalty of its right cut.  With ``f(j)`` the least cost up to
cut ``j`` the transition is a minimum of ``f(i) + pos(i)`` over the cuts of the
last ``window`` tokens, kept in a monotone queue, so each cut is pushed and
popped once; windows of a power of two are looked up by position.

The stream is not held whole: as soon as all open cuts of the last window go
back to one common cut, everything before it is final and is given out.  If
that takes over ``MOST_WINDOWS`` windows, the best open cut decides.  There is
no shuffle, and a lost task only repeats its own partition.
"""

from __future__ import annotations

import itertools
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoline.llm.common import blocks_of, table, text_key

WINDOW, END_ID = 2048, 1
SENTENCE_PENALTY, GRID_PENALTY, GRID, WINDOW_COST = 8, 40, 64, 32
FLUSH_WINDOWS, MOST_WINDOWS = 256, 1024
WORDS_HELD, CORES_HELD = 1 << 20, 1 << 20
BLOCK_BYTES = 1 << 20  # texts that are tokenized together
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII punctuation without the apostrophe
LETTERS = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")
#: Fixed value: the pattern of words in vocabularies of this kind.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PIECES = "doc_id long, tkey long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class Numbers(dict):
    """Numbers of words in the order they are met; ``new`` are those met since it was emptied."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


class WordIds:
    """Token ids of words, which are numbered as they are met; about ``WORDS_HELD`` are remembered.

    White space separates tokens in such a vocabulary, so a text's ids are its
    words' ids in order.  Case is folded, and a run of letters is separated from marks and
    ends with an end-of-word token, so a word between marks shares the work of its letters
    with its other spellings, and many such runs are tokenized as one text.  Other words go
    to the tokenizer one by one.  Special tokens' strings are their ids, as in the
    file.  Other kinds of vocabularies are refused.
    """

    def __init__(self, path: str | None):
        import json

        import public_tokenizers
        from tokenizers import Tokenizer

        path = path or public_tokenizers.path("word_bpe_49k.json")
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", ())]
        cut = ((spec["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
        suffix = spec["model"].get("end_of_word_suffix")
        self.special = [x["content"] for x in spec["added_tokens"]]
        if (
            "Lowercase" not in steps or cut.get("pattern", {}).get("Regex") != WORD_PATTERN or cut["behavior"] != "Removed" or not cut["invert"]
            or not suffix or not all(any(c in MARKS for c in x) for x in self.special)
        ):
            raise ValueError("not a lower-case vocabulary of words without white space")
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self.cores: dict[str, bytes] = {}
        self.clear()

    def clear(self) -> None:
        self.numbers = Numbers()
        self.pool = np.zeros(1 << 20, np.uint32)  # ids of all words, one after the other
        self.start = np.zeros(1 << 18, np.int64)
        self.length = np.zeros(1 << 18, np.int64)
        self.stops = np.zeros(1 << 18, bool)  # a sentence may end behind the word
        self.marked = np.zeros(1 << 18, bool)  # its last character may be part of a run of marks
        self.used = 0

    def ids(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def learn_cores(self, cores: list[str]) -> None:
        """Runs of letters, tokenized as one text."""
        if not cores:
            return
        if len(self.cores) + len(cores) > CORES_HELD:
            self.cores.clear()
        got = np.array(self.tokenizer.encode_batch_fast([" ".join(cores)], add_special_tokens=False)[0].ids, "<u4")
        ends = (4 * np.flatnonzero(self.closes[got]) + 4).tolist()
        if len(ends) != len(cores):
            raise ValueError("a run of letters does not end with one end-of-word token")
        data, at = got.tobytes(), 0
        for core, end in zip(cores, ends):
            self.cores[core] = data[at:end]
            at = end

    def learn(self, words: list[str]) -> None:
        """Takes up the words that were numbered last."""
        text = " ".join(words)
        special = any(x in text for x in self.special)
        low = text.lower().split(" ")
        if len(low) != len(words):  # never with one space between words
            low = [w.lower() for w in words]
        cores = [x.strip(MARKS) for x in low]
        new = set(cores).difference(self.cores)
        self.learn_cores([x for x in new if LETTERS.fullmatch(x)])
        found = list(map(self.cores.get, cores))
        for k, (word, whole, core) in enumerate(zip(words, low, cores)):
            if special and any(x in word for x in self.special):
                found[k] = self.ids(word)
            elif found[k] is None:
                found[k] = self.ids(whole if whole.isascii() else word)
            elif len(core) != len(whole):
                at = whole.find(core)
                found[k] = self.marks(whole[:at]) + found[k] + self.marks(whole[at + len(core) :])
        self.put(words, found)

    def marks(self, run: str) -> bytes:
        if not run:
            return b""
        ids = self.cores.get(run)
        if ids is None:
            ids = self.cores[run] = self.ids(run)
        return ids

    def put(self, words: list[str], found: list[bytes]) -> None:
        n = len(words)
        first = len(self.numbers) - n
        flat = np.frombuffer(b"".join(found), "<u4")
        lengths = np.fromiter(map(len, found), np.int64, n) // 4
        self.pool = grown(self.pool, self.used + len(flat))
        self.start, self.length, self.stops, self.marked = (grown(x, first + n) for x in (self.start, self.length, self.stops, self.marked))
        self.pool[self.used : self.used + len(flat)] = flat
        self.start[first : first + n] = self.used + np.cumsum(lengths) - lengths
        self.length[first : first + n] = lengths
        self.stops[first : first + n] = [w.endswith((".", "!", "?", "\n")) for w in words]
        self.marked[first : first + n] = [not (w[-1:].isalnum() or w in ("", "\n")) for w in words]
        self.used += len(flat)

    def numbered(self, words: list[str]) -> np.ndarray:
        if len(self.numbers) > WORDS_HELD:
            self.clear()
        at = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        if self.numbers.new:
            self.learn(self.numbers.new)
            self.numbers.new = []
        return at

    def separate(self, at: np.ndarray) -> np.ndarray:
        """Whether the second of each two neighbouring words is a comma or full stop behind a mark."""
        closing = np.isin(at, [n for n in map(self.numbers.get, (",", ".")) if n is not None])
        return closing[1:] & self.marked[at[:-1]]


def grown(values: np.ndarray, size: int) -> np.ndarray:
    return values if size <= len(values) else np.concatenate([values, np.zeros(max(size, 2 * len(values)) - len(values), values.dtype)])


def word_ids(path: str | None) -> WordIds:
    """Kept by the Python worker for its later tasks, at a module that every worker has."""
    import public_tokenizers

    held = vars(public_tokenizers).setdefault("_word_ids", {})
    if path not in held:
        held[path] = WordIds(path)
    return held[path]


def split(text: str, marks: bool) -> list[str]:
    """Words between white space, line ends, and with ``marks`` also the comma or full stop that closes a word."""
    text = text.replace("\n", " \n ").replace("\t", " ").replace("\r", " ")
    if marks:
        text = text.replace(", ", " , ").replace(". ", " . ")
    return text.split(" ")


def block_tokens(texts: list[str], words: WordIds, end_id: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the texts, each with its end id; where each text ends; cuts and their penalties by position."""
    parts = [split(text, True) for text in texts]
    at, sizes = words.numbered(list(itertools.chain.from_iterable(parts))), np.array(list(map(len, parts)), np.int64)
    # A comma or full stop behind another mark belongs to its run: such texts are split again at white space alone.
    run = words.separate(at)
    if run.any():
        whole = np.unique(np.repeat(np.arange(len(texts)), sizes)[1:][run])
        for k in whole.tolist():
            parts[k] = split(texts[k], False)
        at, sizes = words.numbered(list(itertools.chain.from_iterable(parts))), np.array(list(map(len, parts)), np.int64)
    lengths = words.length[at]
    upto = np.cumsum(lengths)  # tokens up to each word's end, without end ids
    last = np.cumsum(sizes) - 1
    text_of = np.repeat(np.arange(len(texts)), sizes)
    ends = upto[last] + np.arange(1, len(texts) + 1)  # with the end ids
    place = np.arange(upto[-1]) + np.repeat(words.start[at] - (upto - lengths), lengths)
    ids = np.full(int(ends[-1]), end_id, np.uint32)
    body = np.ones(len(ids), bool)
    body[ends - 1] = False
    ids[body] = words.pool[place]

    stop = np.zeros(len(ids) + 1, bool)
    stop[(upto + text_of)[words.stops[at]]] = True
    grid = np.flatnonzero(stop | text_ends(ends, len(ids)))
    heads = np.concatenate(([0], grid[:-1]))
    inner = np.maximum(grid - heads - 1, 0) // GRID  # cuts inside a sentence
    steps = np.arange(1, int(inner.sum()) + 1) - np.repeat(np.cumsum(inner) - inner, inner)
    kind = np.zeros(len(ids) + 1, np.int8)
    kind[np.repeat(heads, inner) + GRID * steps] = 1
    kind[stop] = 2
    kind[ends - 1] = 0  # cutting just before the end id is no better than after it
    kind[0] = 0
    kind[ends] = 3
    cuts = np.flatnonzero(kind)
    return ids, ends, cuts, np.array([0, GRID_PENALTY, SENTENCE_PENALTY, 0])[kind[cuts]]


def text_ends(ends: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size + 1, bool)
    out[ends] = True
    return out


def best_cuts(cuts: list[tuple[int, int]], base: int, window: int) -> tuple[list[int], list[float], int]:
    """Parent of every cut (-1: the base), cost, and the first cut still open."""
    position, cost, parent = [base], [0.0], [-1]
    queue: deque[int] = deque([0])  # indices with rising cost + position
    at = {base: 0}
    powers = [p for p in (window >> 1, window >> 2, window >> 3) if p]
    for pos, penalty in cuts:
        while position[queue[0]] < pos - window:
            queue.popleft()
        i = queue[0]
        least, best = cost[i] + window - (pos - position[i]), i
        for p in powers:
            k = at.get(pos - p)
            if k is not None and cost[k] < least:
                least, best = cost[k], k
        j = len(position)
        position.append(pos)
        cost.append(least + penalty + WINDOW_COST)
        parent.append(best)
        at[pos] = j
        value = cost[j] + pos
        while queue and cost[queue[-1]] + position[queue[-1]] >= value:
            queue.pop()
        queue.append(j)
    first = len(position) - 1
    while first > 0 and position[first - 1] > position[-1] - window:
        first -= 1
    return parent, cost, first


class Packer:
    """Takes documents in order and gives out finished pieces."""

    def __init__(self, partition: int, window: int):
        self.window, self.sequence = window, partition << 40
        self.docs: deque[tuple] = deque()  # (id, tkey, first position, ids)
        self.cuts: list[tuple[int, int]] = []
        self.base = self.end = 0
        self.limit = FLUSH_WINDOWS * window

    def add(self, keys: list[tuple], ids: np.ndarray, ends: np.ndarray, cuts: np.ndarray, penalties: np.ndarray) -> Iterator[tuple]:
        """A block of documents, each with a key ``(id, tkey)``."""
        data, begin = ids.astype("<u4").tobytes(), 0
        for key, end in zip(keys, ends.tolist()):
            self.docs.append((*key, self.end + begin, data[4 * begin : 4 * end]))
            begin = end
        self.cuts += zip((cuts + self.end).tolist(), penalties.tolist())
        self.end += len(ids)
        if self.end - self.base >= self.limit:
            yield from self.flush(False)

    def flush(self, last: bool) -> Iterator[tuple]:
        if not self.cuts:
            return
        parent, cost, first = best_cuts(self.cuts, self.base, self.window)
        end = len(parent) - 1
        if not last:
            open_ = set(range(first, len(parent)))
            while len(open_) > 1:
                top = max(open_)
                open_.discard(top)
                open_.add(parent[top])
            end = open_.pop()
            if end <= 0:
                if self.end - self.base < MOST_WINDOWS * self.window:
                    self.limit *= 2
                    return
                end = min(range(first, len(parent)), key=cost.__getitem__)
        path = []
        while end > 0:
            path.append(end)
            end = parent[end]
        done = path[0]
        for j in reversed(path):
            yield from self.emit(self.cuts[j - 1][0])
        self.cuts = self.cuts[done:]

    def emit(self, stop: int) -> Iterator[tuple]:
        offset, at = 0, self.base
        while at < stop:
            doc_id, tkey, begin, ids = self.docs[0]
            n = len(ids) // 4
            upto = min(stop, begin + n)
            yield doc_id, tkey, at - begin, upto - at, ids[4 * (at - begin) : 4 * (upto - begin)], n, self.sequence, offset
            offset += upto - at
            at = upto
            if at == begin + n:
                self.docs.popleft()
        self.base = stop
        self.sequence += 1


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = END_ID, tokenizer_file: str | None = None) -> DataFrame:
    """``PIECES`` of every row: each id lies in exactly one piece.

    ``start`` counts the document's ids before the piece, ``offset`` the ids
    before it in its sequence; ``ids`` are little-endian 32-bit.  Null and empty
    texts give one piece with the end id.  Repeated rows are packed each; a
    null id stays null.  Other columns are ignored; an empty table gives no rows.
    ``tokenizer_file`` must be readable by every executor (default: the
    installed public vocabulary).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, pa.binary() if c == "ids" else pa.int64()) for c in (x.split()[0] for x in PIECES.split(", "))])
        words, packer = word_ids(tokenizer_file), Packer(TaskContext.get().partitionId(), window)
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows.clear()
            return out

        for b in batches:
            for lo, n in blocks_of(b["text"], BLOCK_BYTES):
                part = b.slice(lo, n)
                keys = list(zip(part["id"].to_pylist(), part["tkey"].to_pylist()))
                rows.extend(packer.add(keys, *block_tokens([t or "" for t in part["text"].to_pylist()], words, end_id)))
                if len(rows) >= 2048:
                    yield batch()
        rows.extend(packer.flush(True))
        if rows:
            yield batch()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_key(text_col).alias("tkey"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, PIECES)


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6(spark, sf_dir: str) -> DataFrame:
    """Contract of ``op6_packing``."""
    return digest(pack(table(spark, sf_dir, "documents")))
