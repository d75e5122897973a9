"""Benchmark decontamination by a distributed positional inverted index.

DataFrame and SQL functions only.  Test items are cut into windows of
``width`` words; equal windows are one phrase.  Training counts of the test
words name the two rarest places of every phrase, and the index stores
postings ``(term, document, position)`` of those terms only, each with the
words around it.  A phrase's start is a posting of its rarest term less that
term's offset; it must agree with a posting of the second rarest term at its
own offset (the offset-adjusted intersection), and the words around confirm it.

The test side is written first, so Spark broadcasts it where its file size
is below ``spark.sql.autoBroadcastJoinThreshold`` and sorts and merges otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargoline.llm.common import id_key, land, table, text_key

WIDTH = 13
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAKS = "".join(c for c in map(chr, range(128)) if not c.isalnum())  # every other character belongs to a word


def words_of(text: str) -> Column:
    """The words, A-Z lowered; a translation and a split cost far less than matching a pattern."""
    plain = F.translate(F.coalesce(F.col(text), F.lit("")), BREAKS + UPPER, " " * len(BREAKS) + LOWER)
    return F.array_remove(F.split(plain, " "), "")


def phrases(items: DataFrame, item_col: str, text_col: str, width: int) -> DataFrame:
    """``(phrase, item)``, each once; a short item is one phrase, one without words none."""
    rows = items.select(F.col(item_col).cast("string").alias("item"), words_of(text_col).alias("w")).where(F.size("w") > 0)
    rows = rows.select("item", "w", F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - width + 1, F.lit(1)))).alias("at"))
    return rows.select(F.array_join(F.slice("w", F.col("at"), F.lit(width)), " ").alias("phrase"), "item").distinct()


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(id_key(id_col).alias("doc"), text_key(text_col).alias("tkey"), words_of(text_col).alias("w"))


def term_counts(docs: DataFrame, terms: DataFrame, text_col: str) -> DataFrame:
    """Occurrences of each of ``terms`` in all documents."""
    rows = docs.select(F.explode(words_of(text_col)).alias("term"))
    return rows.join(terms, "term").groupBy("term").agg(F.count("*").alias("n"))


def anchored(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """``(phrase, len, term, off, term2, off2)``: the two rarest places of each phrase.

    A phrase with a word that no document has is left out.
    """
    rows = windows.select("phrase", F.split("phrase", " ").alias("w"))
    rows = rows.select("phrase", F.size("w").alias("len"), F.posexplode("w").alias("off", "term"))
    rows = rows.join(counts, "term", "left")
    place = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "off", "term")
    best = rows.groupBy("phrase", "len").agg(F.slice(F.sort_array(F.collect_list(place)), 1, 2).alias("p"))
    first, second = F.col("p")[0], F.col("p")[F.least(F.size("p"), F.lit(2)) - 1]
    return best.where(first["n"] > 0).select(
        "phrase", "len", first["term"].alias("term"), first["off"].alias("off"), second["term"].alias("term2"), second["off"].alias("off2")
    )


def postings(docs: DataFrame, terms: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """The index: ``(term, doc, tkey, pos, first, around)``; ``around`` holds the words from ``first`` on."""
    rows = _keyed(docs, id_col, text_col).select("doc", "tkey", "w", F.posexplode("w").alias("pos", "term")).join(terms, "term")
    first = F.greatest(F.col("pos") - (width - 1), F.lit(0))
    around = F.array_join(F.slice("w", first + 1, F.lit(2 * width - 1)), " ")
    return rows.select("term", "doc", "tkey", "pos", first.alias("first"), around.alias("around"))


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", width: int = WIDTH, slop: int = 0) -> tuple[DataFrame, DataFrame]:
    """``(phrases with their items, found)``.

    ``found`` is ``(phrase, len, doc, tkey, start, exact)``.  Besides the exact
    occurrences, ``slop`` > 0 adds proximity matches: places where the two rarest
    words stand within ``slop`` words of their distance in the phrase.
    """
    listed = land(phrases(items, item_col, item_text, width), "phrases")
    windows = land(listed.select("phrase").distinct(), "windows")
    terms = land(windows.select(F.explode(F.split("phrase", " ")).alias("term")).distinct(), "terms")
    anchors = land(anchored(windows, land(term_counts(docs, terms, text_col), "term-counts")), "anchors")
    wanted = land(anchors.select("term").union(anchors.select("term2")).distinct(), "anchor-terms")
    index = land(postings(docs, wanted, id_col, text_col, width), "postings")
    starts = index.join(anchors, "term").withColumn("start", F.col("pos") - F.col("off"))
    other = index.select(F.col("term").alias("term2"), "doc", "tkey", F.col("pos").alias("pos2"))
    text = F.array_join(F.slice(F.split("around", " "), F.col("start") - F.col("first") + 1, F.col("len")), " ")
    aligned = starts.where("start >= 0").withColumn("pos2", F.col("start") + F.col("off2")).join(other, ["term2", "doc", "tkey", "pos2"], "left_semi")
    cols = ["phrase", "len", "doc", "tkey", "start"]
    # Rows equal in id and text give equal postings: told once.
    found = aligned.where(text == F.col("phrase")).select(*cols, F.lit(True).alias("exact")).distinct()
    if slop:
        shifted = starts.select("*", F.explode(F.sequence(F.lit(-slop), F.lit(slop))).alias("shift")).withColumn("pos2", F.col("start") + F.col("off2") + F.col("shift"))
        near = shifted.join(other, ["term2", "doc", "tkey", "pos2"], "left_semi").select(*cols).distinct()
        found = found.union(near.join(found, cols, "left_anti").select(*cols, F.lit(False)))
    return listed, found


def contamination(docs: DataFrame, items: DataFrame, carry: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", width: int = WIDTH) -> DataFrame:
    """``(doc, n_words, n_hit, n_items, item_ids, contaminated)`` of every row.

    The struct ``doc`` holds the columns ``carry`` (default: all), so no column
    clashes with a result.  A row is contaminated if a word is hit and at least a
    twentieth of its words are.  Null and empty texts have no words; null item
    texts have no phrases.  Rows equal in id and text have equal results.  An empty
    table gives no rows, an empty benchmark no hits.
    """
    listed, found = matches(docs, items, id_col, text_col, item_col, item_text, width)
    found = land(found, "matches")
    hit = found.select("doc", "tkey", F.explode(F.sequence("start", F.col("start") + F.col("len") - 1)).alias("pos")).distinct()
    hits = hit.groupBy("doc", "tkey").agg(F.count("*").alias("n_hit"))
    # At most as many ids a document as the benchmark has.
    named = found.select("phrase", "doc", "tkey").distinct().join(listed, "phrase").groupBy("doc", "tkey").agg(F.sort_array(F.collect_set("item")).alias("item_ids"))
    per_doc = land(hits.join(named, ["doc", "tkey"]).withColumnsRenamed({"doc": "_id", "tkey": "_tkey"}), "hits")
    rows = docs.select(
        F.struct(*[docs[c] for c in carry or docs.columns]).alias("doc"), id_key(id_col).alias("_id"), text_key(text_col).alias("_tkey"),
        F.size(words_of(text_col)).cast("long").alias("n_words"),
    ).join(per_doc, ["_id", "_tkey"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return rows.select(
        "doc", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated."""
    return contamination(docs, items).where(~F.col("contaminated")).select("doc.*")


def op4(spark, sf_dir: str) -> DataFrame:
    """Contract of ``op4_benchmark_decontamination``."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select(
        "doc.doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"), "contaminated"
    )
