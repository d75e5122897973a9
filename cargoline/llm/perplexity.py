"""Quality rules: word statistics, and n-gram perplexity inside bands per language.

The model is a modified Kneser-Ney model over the letters of words (order
``ORDER``, a word is bracketed by a start and an end symbol), one per
language:

* counting: tasks count words, break the distinct ones into letter n-grams and
  sum them; Spark adds up all tasks' counts (every document counts).
* a gram is a packed number, 11 bits a symbol and 8 bits of the language's code,
  so contexts and suffixes are bit operations: continuation counts, discounts
  and interpolated probabilities are joins and sums of DataFrames.  Characters
  from U+076C on are two symbols (three above plane 3), so no two share one, and
  languages have codes of their own (a model for every 256 of them).
* the finished tables are stored as sorted arrays of 64-bit hashes.  The hash is a
  bijection of the packed gram, so no two grams share an entry.  Tasks find them by binary
  search from the longest gram down; most are found at once.
* a broadcast model holds about ``HELD_GRAMS`` entries.  A larger model is cut by the
  symbol before the one that is scored: all that a position looks up lies in one such part, so
  each part scores its own positions in a pass over the texts, and the shares add up.

A document passes if the mean surprise of its words lies within its language's
band, whose two sides lie a number of deviations from the language's median;
a deviation shrinks with the root of the number of words, as sampling noise does.
The mean is taken by word, not by symbol: a word with odd signs behind it has more
symbols, which a mean over symbols would divide the surprise by.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargoline.llm.common import blocks_of, land, table
from cargoline.session import settings

ORDER, SYMBOL_BITS, LANG_SHIFT = 5, 11, 55
START, END, FIRST = 1, 2, 3  # symbols; 0: none
# Code points below SINGLES are one symbol; a symbol SINGLES marks three, those behind it lead two.
SINGLES, FAR, DIGITS, LANGS = 1900, 1 << 18, (1 << SYMBOL_BITS) - FIRST, 256
# Deviations below and above a language's middle that pass.  Texts of symbols and
# shouting lie below; passages in another language, which are no fault, above.
BELOW, ABOVE, LEAST_SCALE = 4.5, 12.0, 0.05
HELD_GRAMS = 1 << 22  # entries of the model a task holds: 12 bytes each
WORDS_HELD = 1 << 17  # distinct words a task holds before it adds up
SCORES_HELD = 1 << 17  # scored words of a language that a task remembers
TEXT_BYTES = 1 << 20  # text that is scored at a time
BATCH_ROWS, BATCH = 1024, "spark.sql.execution.arrow.maxRecordsPerBatch"  # rows sent to a scoring task at a time
WINDOWS_HELD = 1 << 17  # windows of a text held as tuples; longer texts are only numbered
SYMBOLS = "#*$%&|<>"
MIN_WORDS, REPEAT_WINDOW, REPEAT_PERCENT = 10, 5, 20


def lang_code(lang: str | None) -> int:
    """The code of a language that meets no other one."""
    return zlib.crc32((lang or "").encode("utf-8", "replace")) & 0xFF


def lang_blocks(langs: list[str | None]) -> list[dict[str, int]]:
    """Codes of all languages, 256 a block and each its own; null is ''."""
    names = sorted({x or "" for x in langs})
    blocks = []
    for lo in range(0, len(names), LANGS):
        codes: dict[str, int] = {}
        taken: set[int] = set()
        for name in names[lo : lo + LANGS]:
            code = lang_code(name)
            while code in taken:
                code = (code + 1) % LANGS
            taken.add(code)
            codes[name] = code
        blocks.append(codes)
    return blocks


def langs_of(docs: DataFrame, lang_col: str) -> list[str | None]:
    return [row[0] for row in docs.select(F.col(lang_col).cast("string")).distinct().collect()]


def symbols_of(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of code points, and how many each has: one up to ``SINGLES``, or a lead and one or two more."""
    one = points < SINGLES
    if one.all():
        return points + FIRST, np.ones(len(points), np.int64)
    sizes = np.where(one, 1, np.where(points < FAR, 2, 3))
    at = np.cumsum(sizes) - sizes
    out = np.empty(int(sizes.sum()), np.int64)
    out[at] = np.where(one, points, np.where(points < FAR, SINGLES + 1 + points // DIGITS, SINGLES))
    far, more = sizes == 3, sizes > 1
    out[at[far] + 1] = points[far] // DIGITS
    out[(at + sizes - 1)[more]] = points[more] % DIGITS
    return out + FIRST, sizes


def word_grams(words: list[bytes], lang: int) -> tuple[np.ndarray, np.ndarray]:
    """The packed n-gram that ends at each symbol of each word, and each word's first."""
    points = np.frombuffer(b"\n".join(words).decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.int64)
    brk = np.flatnonzero(points == 10)  # a word holds no line break
    symbols, sizes = symbols_of(points)
    brk = (np.cumsum(sizes) - sizes)[brk]
    heads = np.concatenate(([0], brk + 1))
    lengths = np.diff(np.append(heads, len(symbols) + 1))  # with the end symbol
    stream = np.append(symbols, END)
    stream[brk] = END
    n, at = len(stream), np.arange(len(stream)) - np.repeat(heads, lengths)  # place in the word
    gram = stream.copy()
    for back in range(1, ORDER):
        earlier = np.zeros(n, np.int64)
        earlier[back:] = stream[: max(0, n - back)]
        earlier = np.where(at >= back, earlier, np.where(at == back - 1, START, 0))
        gram |= earlier << (SYMBOL_BITS * back)
    return gram | (lang << LANG_SHIFT), heads


def suffix(gram, order: int):
    """The last ``order`` symbols, language kept (numpy arrays)."""
    return gram & ((1 << (SYMBOL_BITS * order)) - 1) | (gram >> LANG_SHIFT << LANG_SHIFT)


def context(gram, order: int):
    """The symbols before the last one of a gram of ``order``, language kept."""
    return (suffix(gram, order) & ((1 << LANG_SHIFT) - 1)) >> SYMBOL_BITS | (gram >> LANG_SHIFT << LANG_SHIFT)


def hashed(gram: np.ndarray) -> np.ndarray:
    """A 64-bit hash that no two grams share: odd factors and the shift can be undone."""
    h = gram.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return h * np.uint64(0xBF58476D1CE4E5B9)


# --- counting -------------------------------------------------------------------


def gram_counts(docs: DataFrame, codes: dict[str, int], text_col: str, lang_col: str) -> DataFrame:
    """``(gram, c)``: highest-order counts of all texts."""

    def emit(counts: dict[int, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, words in counts.items():
            gram, heads = word_grams(list(words), lang)
            times = np.repeat(np.fromiter(words.values(), np.int64, len(words)), np.diff(np.append(heads, len(gram))))
            found, where = np.unique(gram, return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(np.bincount(where, times).astype(np.int64))], ["gram", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, Counter] = {}
        for b in batches:
            for text, lang in zip(b["text"], b["lang"]):
                words = counts.setdefault(codes[lang.as_py() or ""], Counter())
                words.update((text.as_py() or "").encode("utf-8", "replace").split())
                if sum(map(len, counts.values())) > WORDS_HELD:
                    yield from emit(counts)
                    counts = {}
        yield from emit({k: v for k, v in counts.items() if v})

    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    return rows.mapInArrow(run, "gram long, c long").groupBy("gram").agg(F.sum("c").alias("c"))


def _suffix(order: int):
    low = F.col("gram").bitwiseAND(F.lit((1 << (SYMBOL_BITS * order)) - 1))
    return low.bitwiseOR(F.col("gram").bitwiseAND(F.lit(0xFF << LANG_SHIFT)))


def _context():
    body = F.shiftright(F.col("gram").bitwiseAND(F.lit((1 << LANG_SHIFT) - 1)), SYMBOL_BITS)
    return body.bitwiseOR(F.col("gram").bitwiseAND(F.lit(0xFF << LANG_SHIFT)))


def _discounts(level: DataFrame) -> list[float]:
    row = level.agg(*[F.count(F.when(F.col("c") == i, 1)).alias(f"n{i}") for i in range(1, 5)]).first()
    n = [0, *map(float, row)]
    if not (n[1] and n[2]):
        return [0.5, 1.0, 1.5]
    y = n[1] / (n[1] + 2 * n[2])
    raw = [i - (i + 1) * y * n[i + 1] / n[i] if n[i] else i / 2 for i in (1, 2, 3)]
    return [min(max(d, 0.1 * i), 0.95 * i) for i, d in zip((1, 2, 3), raw)]


def tables_of(docs: DataFrame, codes: dict[str, int], text_col: str = "text", lang_col: str = "lang") -> dict[int, DataFrame]:
    """``{order: (gram, p)}``, natural log probabilities, and ``{-order: (gram, p)}``, log back-off weights of contexts."""
    levels = {ORDER: land(gram_counts(docs, codes, text_col, lang_col), "grams")}
    for order in range(ORDER - 1, 0, -1):
        lead = F.shiftright("gram", SYMBOL_BITS * order).bitwiseAND(F.lit((1 << SYMBOL_BITS) - 1))
        below = levels[order + 1].groupBy(_suffix(order).alias("gram"))
        # A gram at a word's start has no left neighbour and keeps its own count.
        levels[order] = land(below.agg(F.sum(F.when(lead == 0, F.col("c")).otherwise(1)).alias("c")), "grams")
    tables, lower = {}, None
    for order in range(1, ORDER + 1):
        d1, d2, d3 = _discounts(levels[order])
        off = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        rows = levels[order].select("gram", "c", _context().alias("context"), off.alias("off"))
        sums = land(rows.groupBy("context").agg(F.sum("c").alias("all"), F.sum("off").alias("spare")), "gram-contexts")
        rows = rows.join(sums, "context")
        below = F.lit(2.0**-SYMBOL_BITS)
        if lower is not None:
            rows = rows.withColumn("s", _suffix(order - 1)).join(lower.select(F.col("gram").alias("s"), F.col("p").alias("q")), "s")
            below = F.col("q")
        p = (F.col("c") - F.col("off")) / F.col("all") + F.col("spare") / F.col("all") * below
        lower = land(rows.select("gram", p.alias("p")), "gram-probabilities")
        tables[order] = lower.select("gram", F.log("p").cast("float").alias("p"))
        tables[-order] = sums.select(F.col("context").alias("gram"), F.log(F.col("spare") / F.col("all")).cast("float").alias("p"))
    return tables


def _before(order: int):
    """The symbol before the scored one, in a gram (``order`` > 1) or a context (``order`` < -1)."""
    return F.shiftright("gram", SYMBOL_BITS if order > 0 else 0).bitwiseAND(F.lit((1 << SYMBOL_BITS) - 1))


def parts_of(tables: dict[int, DataFrame]) -> list[tuple[int, int]]:
    """Ranges ``[lo, hi)`` of the symbol before, each with about ``HELD_GRAMS`` entries or one symbol's."""
    keys = [k for k in tables if abs(k) > 1]
    marks = [tables[k].select(_before(k).alias("before")) for k in keys]
    found = marks[0]
    for more in marks[1:]:
        found = found.union(more)
    sizes = dict(map(tuple, found.groupBy("before").count().collect()))  # at most 2^11 symbols
    cuts, held = [0], 0
    for symbol in range(1 << SYMBOL_BITS):
        n = sizes.get(symbol, 0)
        if held and held + n > HELD_GRAMS:
            cuts.append(symbol)
            held = 0
        held += n
    return list(zip(cuts, [*cuts[1:], 1 << SYMBOL_BITS]))


def gathered(tables: dict[int, DataFrame], lo: int = 0, hi: int = 1 << SYMBOL_BITS) -> dict:
    """The part ``[lo, hi)`` of the model: ``{order or -order of a context: (sorted hashes, values)}``."""
    model: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for key, rows in tables.items():
        got = (rows.where(_before(key).between(lo, hi - 1)) if abs(key) > 1 else rows).toArrow()
        if got.num_rows:
            h, values = hashed(got["gram"].to_numpy()), got["p"].to_numpy()
            order = np.argsort(h)
            model[key] = (h[order], values[order])
    return model


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", codes: dict[str, int] | None = None) -> dict:
    """The whole model of all texts, for corpora whose model one process can hold (``quality`` takes any).

    ``codes`` are the languages' codes, at most ``LANGS`` (default: those of ``docs``).
    """
    if codes is None:
        codes, *more = lang_blocks(langs_of(docs, lang_col)) or [{}]
        if more:
            raise ValueError(f"a model holds {LANGS} languages; train one for each of lang_blocks")
    return gathered(tables_of(docs, codes, text_col, lang_col))


# --- scoring --------------------------------------------------------------------


def _probe(model: dict, key: int, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which grams the sorted hash array of ``key`` holds, and their values."""
    if key not in model:
        return np.zeros(len(gram), bool), np.zeros(len(gram), np.float32)
    hashes, values = model[key]
    h = hashed(gram)
    at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
    return hashes[at] == h, values[at]


def log_probabilities(words: list[bytes], lang: int, model: dict, part: tuple[int, int] = (0, 1 << SYMBOL_BITS)) -> tuple[np.ndarray, np.ndarray]:
    """Natural log probability and number of symbols of each word; of the probability only the ``part``'s share."""
    gram, heads = word_grams(words, lang)
    value = np.zeros(len(gram))
    before = (gram >> SYMBOL_BITS) & ((1 << SYMBOL_BITS) - 1)
    rest = np.flatnonzero((before >= part[0]) & (before < part[1]))
    g, back = gram[rest], np.zeros(len(rest))
    for order in range(ORDER, 0, -1):
        seen, p = _probe(model, order, suffix(g, order))
        value[rest[seen]] = back[seen] + p[seen]
        rest, g, back = rest[~seen], g[~seen], back[~seen]
        if not len(rest):
            break
        known, weight = _probe(model, -order, context(g, order))
        back = back + np.where(known, weight, 0.0)
    value[rest] = back - SYMBOL_BITS * np.log(2)
    return np.add.reduceat(value, heads), np.diff(np.append(heads, len(gram)))


def repeat_words(words: list[bytes], width: int) -> int:
    """Words inside a ``width``-word window that occurs twice or more."""
    n = len(words) - width + 1
    if n < 2 or n < WINDOWS_HELD and len(set(zip(*(words[k : n + k] for k in range(width))))) == n:
        return 0  # most texts repeat nothing
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    rank = ids[:n].copy()
    for k in range(1, width):  # exact: windows are numbered one word longer at a time
        _, rank = np.unique(rank * len(seen) + ids[k : k + n], return_inverse=True)
    twice = np.bincount(rank)[rank] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, np.flatnonzero(twice), 1)
    np.add.at(edge, np.flatnonzero(twice) + width, -1)
    return int((np.cumsum(edge) > 0).sum())


def base_stats(text: str, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    lines = [line for line in text.split("\n") if line.strip(" \t\n\r\x0b\x0c")]
    chars = len(b"".join(words).decode("utf-8", "replace"))
    symbols = sum(map(text.count, SYMBOLS))
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeat_words(words, REPEAT_WINDOW)


def per_word():
    """Mean surprise of a document's words."""
    return F.col("surprise") * F.col("n_letters") / F.greatest("n_words", F.lit(1))


STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_letters")


def scored(
    docs: DataFrame, held, codes: dict[str, int], carry: list[str], text_col: str = "text", lang_col: str = "lang",
    part: tuple[int, int] = (0, 1 << SYMBOL_BITS), digest: Column | None = None,
) -> DataFrame:
    """``(doc, lang, digest, <statistics>, surprise)``: ``doc`` holds the columns ``carry``, ``held`` is the broadcast model, ``codes`` its languages.

    ``surprise`` is the mean of ``-ln p`` over the symbols of the words, 0 without words; of it
    the share of the symbols in ``part``, which ``held`` must cover.
    """
    rows = docs.select(
        F.struct(*[docs[c] for c in carry]).alias("doc"), F.col(lang_col).cast("string").alias("lang"), (F.lit("") if digest is None else digest).alias("digest"),
        *([] if text_col in carry else [F.col(text_col).alias("text")]),  # a text is sent once
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, dict[bytes, tuple[float, int]]] = {}
        model = held.value
        for whole in batches:
            text_of = pc.struct_field(whole["doc"], [text_col]) if text_col in carry else whole["text"]
            for lo, n in blocks_of(text_of, TEXT_BYTES):
                b = whole.slice(lo, n)
                full = [t.as_py() or "" for t in text_of.slice(lo, n)]
                split = [t.encode("utf-8", "replace").split() for t in full]
                langs = [codes[x.as_py() or ""] for x in b["lang"]]
                for lang in set(langs):
                    cache = known.setdefault(lang, {})
                    if len(cache) > SCORES_HELD:
                        cache.clear()
                    new = list({w for words, c in zip(split, langs) if c == lang for w in words if w not in cache})
                    for at in range(0, len(new), 1 << 14):
                        some = new[at : at + (1 << 14)]
                        cache.update(zip(some, zip(*(x.tolist() for x in log_probabilities(some, lang, model, part)))))
                stats, surprise = [], []
                for text, words, lang in zip(full, split, langs):
                    found = list(map(known[lang].__getitem__, words))
                    letters = sum(x[1] for x in found)
                    stats.append((*base_stats(text, words), letters))
                    surprise.append(-sum(x[0] for x in found) / letters if letters else 0.0)
                yield pa.RecordBatch.from_arrays(
                    [b["doc"], b["lang"], b["digest"], *(pa.array(c, pa.int64()) for c in zip(*stats)), pa.array(surprise, pa.float64())],
                    ["doc", "lang", "digest", *STATS, "surprise"],
                )

    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc {kind}, lang string, digest string, {', '.join(f'{c} long' for c in STATS)}, surprise double")


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def bands(found: DataFrame) -> DataFrame:
    """``(band, middle, scale)`` of the documents of each language that pass the base rules.

    ``middle`` is the median of ``per_word``, ``scale`` the robust deviation (from the
    quartiles) of ``(per_word - middle) * sqrt(words)``.
    """
    rows = found.where(~base_failed()).select(F.coalesce("lang", F.lit("")).alias("band"), per_word().alias("mean"), F.sqrt("n_words").alias("root"))
    middle = land(rows.groupBy("band").agg(F.percentile_approx("mean", F.lit(0.5), 10000).alias("middle")), "middles")
    off = (F.col("mean") - F.col("middle")) * F.col("root")
    q = F.percentile_approx(off, F.array(F.lit(0.25), F.lit(0.75)), 10000)
    scale = rows.join(middle, "band").groupBy("band", "middle").agg(q.alias("q"))
    return scale.select("band", "middle", ((F.col("q")[1] - F.col("q")[0]) / 1.349).alias("scale"))


def judged(found: DataFrame, band: DataFrame) -> DataFrame:
    """``found`` with ``base_failed``, the band's ``lower`` and ``upper`` perplexity (by word), and ``kept``."""
    unit = F.greatest("scale", F.lit(LEAST_SCALE)) / F.sqrt(F.greatest("n_words", F.lit(1)))
    lower, upper = F.col("middle") - BELOW * unit, F.col("middle") + ABOVE * unit
    rows = found.join(band, F.coalesce("lang", F.lit("")) == F.col("band"), "left").drop("band")
    inside = per_word().between(lower, upper)
    return rows.select(
        "*", base_failed().alias("base_failed"), F.exp(lower).alias("lower"), F.exp(upper).alias("upper"),
        (~base_failed() & F.coalesce(inside, F.lit(False))).alias("kept"),
    )


def quality(docs: DataFrame, carry: list[str] | None = None, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Statistics, perplexity band and verdict of every row of ``docs``.

    The struct ``doc`` holds the columns ``carry`` (default: all), so no input
    column can clash with a result.  Null text has no words and fails the base
    rules; a null language is a language of its own.  Repeated rows are judged
    each and alike.  An empty table gives no rows.
    """
    found = None
    blocks = lang_blocks(langs_of(docs, lang_col)) or [{}]
    for codes in blocks:
        name = F.coalesce(docs[lang_col].cast("string"), F.lit(""))
        some = docs if len(blocks) == 1 else docs.where(name.isin(list(codes)))
        rows = surprises(some, codes, carry or docs.columns, text_col, lang_col)
        found = found.unionByName(rows) if found is not None else rows
    return judged(found, land(bands(found), "bands"))


def surprises(docs: DataFrame, codes: dict[str, int], carry: list[str], text_col: str, lang_col: str) -> DataFrame:
    """``scored`` by the model of ``docs`` itself, part by part if one task cannot hold it."""
    tables = tables_of(docs, codes, text_col, lang_col)
    parts = parts_of(tables)
    full = F.concat(F.coalesce(F.col(lang_col).cast("string"), F.lit("")), F.lit("\0"), F.coalesce(F.col(text_col), F.lit("")))
    digest = F.sha2(full, 256) if len(parts) > 1 else None  # tells whose shares add up
    done = []
    for part in parts:
        held = docs.sparkSession.sparkContext.broadcast(gathered(tables, *part))
        with settings(docs.sparkSession, {BATCH: min(int(docs.sparkSession.conf.get(BATCH)), BATCH_ROWS)}):
            done.append(land(scored(docs, held, codes, carry, text_col, lang_col, part, digest), "quality"))
        held.unpersist()  # the scores are written; executors need not keep the model
    first, *more = done
    if more:
        shares = more[0].select("digest", "surprise").distinct()
        for rows in more[1:]:
            shares = shares.union(rows.select("digest", "surprise").distinct())
        shares = shares.groupBy("digest").agg(F.sum("surprise").alias("_more"))
        first = land(first.join(shares, "digest").withColumn("surprise", F.col("surprise") + F.col("_more")).drop("_more"), "quality")
    return first.drop("digest")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass."""
    return quality(docs).where("kept").select("doc.*")


def op9(spark, sf_dir: str) -> DataFrame:
    """Contract of ``op9_quality_rules``."""
    found = quality(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select("doc.doc_id", *STATS[:5], "base_failed", "kept", F.exp(per_word()).alias("perplexity"), "lower", "upper")
