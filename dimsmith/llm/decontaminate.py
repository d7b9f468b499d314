"""Benchmark decontamination with a distributed positional inverted index.

The benchmark's windows (``width`` consecutive words; a shorter item is one
window) are the test phrases.  A document holds a phrase where all its words
follow each other, and is near a window where some ``width`` consecutive words
hold at least ``near_share`` of the window's distinct ones.

One pass over the corpus counts every term of the windows.  A proximity match
may lack k of a window's distinct words, so a window is represented by its
k + 1 rarest ones, of which each match holds one (exact phrases: by the
rarest).  A second pass stores the postings of those terms (term, document,
position and the words around), and the windows of a term are intersected with
its postings at their offsets.  Words that the corpus lacks count as the
rarest; a window that lacks more than k of its words is settled by the count
alone, and one that lacks any has no exact phrase.

A posting whose surroundings hold fewer of the words that stand in any window
of its term than the least of those windows needs can match none, and is not
stored.  That test needs the term's neighbours beside it; a term with more than
``MAX_NEIGHBOURS`` of them has all its postings stored.

DataFrame functions only.  The terms searched for are broadcast in blocks of at
most ``block_terms`` (the bound is the block, not the data: a larger benchmark
is more blocks and more passes), so tokens are filtered where they are read
and nothing is shuffled but counts and postings of rare terms.  At most about
``WINDOWS_A_ROW`` windows of a term are one row, so a posting meets them in few
join rows however hot the term is, and a row is bounded however many windows
share a term.

Words are runs of characters other than ASCII non-alphanumerics, A-Z lowered.
Candidates are found by fully lower-cased terms (a superset; lowering neither
makes nor removes a word break) and confirmed on words with only A-Z lowered.

Defined results: a null or empty text has no words and no hits; items without
words have no window; a null item_id can mark words but is not listed; equal
windows of several items list all of them; rows that repeat doc_id and text are
judged alike; empty tables give no hits; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimsmith.llm.registry import ascii_lower, materialise, query, table

WIDTH, BLOCK_TERMS, NEAR_SHARE = 10, 100_000, 0.8
MAX_NEIGHBOURS, WINDOWS_A_ROW = 64, 500
_BREAK = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


def raw_words(text: Column) -> Column:
    """Words in their own case; the first and the last entry may be empty."""
    return F.split(F.coalesce(text, F.lit("")), _BREAK)


def word_count(words: Column) -> Column:
    n = F.size(words)
    first = F.when(F.element_at(words, 1) == "", 1).otherwise(0)
    last = F.when((n > 1) & (F.element_at(words, -1) == ""), 1).otherwise(0)
    return (n - first - last).cast("long")


def windows(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """items (item_id, text) -> window (its words, joined by spaces), n, items."""
    w = F.filter(raw_words(ascii_lower(F.col("text"))), lambda x: x != "")
    x = items.select(F.col("item_id").cast("string").alias("item_id"), w.alias("w")).where(F.size("w") > 0)
    at = F.sequence(F.lit(1), F.greatest(F.size("w") - width + 1, F.lit(1)))
    x = x.select("item_id", "w", F.explode(at).alias("at")).select(
        "item_id", F.slice("w", F.col("at"), F.lit(width)).alias("w"))
    return (x.groupBy(F.array_join("w", " ").alias("window"), F.size("w").alias("n"))
            .agg(F.sort_array(F.collect_set("item_id")).alias("items")))


def _blocks(terms: DataFrame, block_terms: int) -> list[DataFrame]:
    """The terms in broadcastable blocks."""
    n = -(-terms.count() // block_terms) or 1
    return [F.broadcast(terms.where(F.pmod(F.xxhash64("term"), F.lit(n)) == i)) for i in range(n)]


def _terms(docs: DataFrame) -> Column:
    return raw_words(F.lower(F.col("text")))


def term_counts(docs: DataFrame, terms: DataFrame, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """How often each term (lower-cased) occurs in the corpus; terms that don't are absent."""
    tokens = docs.select(F.explode(_terms(docs)).alias("term"))
    return reduce(DataFrame.unionByName, [
        tokens.join(b, "term").groupBy("term").agg(F.count("*").alias("tf")) for b in _blocks(terms, block_terms)])


def postings(docs: DataFrame, terms: DataFrame, around: int, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The index of some terms: term, doc_id, tk, pos, first and context (words first ..).

    terms (term, neighbours, least): only where ``least`` of the neighbours stand around; null: everywhere.
    """
    tokens = (docs.select("doc_id", F.xxhash64("text").alias("tk"), raw_words(F.col("text")).alias("words"),
                          _terms(docs).alias("terms"))
              .select("doc_id", "tk", "words", "terms", F.posexplode("terms").alias("pos", "term")))
    first = F.greatest(F.col("pos") - around, F.lit(0))

    def near(of: str) -> Column:
        return F.slice(of, first + 1, F.col("pos") - first + 1 + around)
    enough = F.col("neighbours").isNull() | (F.size(F.array_intersect(near("terms"), F.col("neighbours"))) >= F.col("least"))
    return reduce(DataFrame.unionByName, [
        tokens.join(b, "term").where(enough).select(
            "term", "doc_id", "tk", "pos", first.alias("first"), ascii_lower(F.array_join(near("words"), " ")).alias("context"))
        for b in _blocks(terms, block_terms)])


def _searched(entries: DataFrame) -> DataFrame:
    """entries (term, least, lowered) -> a term's number of entries, least and, where they are few, neighbours."""
    pairs = entries.select("term", F.explode("lowered").alias("word")).distinct()
    few = (pairs.join(pairs.groupBy("term").agg(F.count("*").alias("c")).where(F.col("c") <= MAX_NEIGHBOURS), "term")
           .groupBy("term").agg(F.collect_list("word").alias("neighbours")))
    return (entries.groupBy("term").agg(F.count("*").alias("n_entries"), F.min("least").alias("least"))
            .join(few, "term", "left"))


def find_matches(docs: DataFrame, items: DataFrame, width: int = WIDTH, near_share: float = NEAR_SHARE,
                 block_terms: int = BLOCK_TERMS) -> DataFrame:
    """doc_id, tk, phrases: array of (start, n, items), near: item_ids of proximity matches.

    start counts raw words from 0.  Documents without any match are absent.
    """
    win = materialise(windows(items, width), "windows")
    words = win.select("window", F.posexplode(F.split("window", " ")).alias("offset", "word"))
    words = words.groupBy("window", "word").agg(F.min("offset").alias("offset")).withColumn("term", F.lower("word"))
    counts = materialise(term_counts(docs, words.select("term").distinct(), block_terms), "term-counts")
    ranked = (words.join(counts, "term", "left").groupBy("window")     # an entry a distinct word of the window
              .agg(F.sort_array(F.collect_list(F.struct(F.coalesce("tf", F.lit(0)).alias("tf"), "offset", "term", "word"))).alias("r"))
              .withColumn("need", F.ceil(F.size("r") * near_share))
              .withColumn("lowered", F.array_distinct("r.term"))
              # words that differ only in the case of other letters than A-Z are one term
              .withColumn("least", F.col("need") - F.size("r") + F.size("lowered")))
    rarest = ranked.select("window", "need", "least", "lowered", F.col("r.word").alias("terms"),
                           F.posexplode(F.slice("r", 1, (F.size("r") - F.col("need") + 1).cast("int"))).alias("rank", "r"))
    entries = materialise(win.join(rarest.where("r.tf > 0"), "window").select(
        F.col("r.term").alias("term"), "least", "lowered",
        F.struct((F.col("rank") == 0).alias("rarest"), F.col("r.offset").alias("offset"), "n", "window",
                 "items", "terms", "need").alias("win")), "window-terms")
    searched = materialise(_searched(entries), "terms")
    chunk = F.pmod(F.xxhash64("win.window"), F.ceil(F.col("n_entries") / WINDOWS_A_ROW))
    anchors = materialise(entries.join(searched.select("term", "n_entries"), "term").groupBy("term", chunk.alias("chunk"))
                          .agg(F.collect_list("win").alias("wins")).drop("chunk"), "anchors")
    index = materialise(postings(docs, searched.select("term", "neighbours", "least"), width - 1, block_terms), "postings")

    x = index.join(anchors, "term").withColumn("ctx", F.split("context", " ", -1))

    def phrase(w: Column) -> Column:
        at = F.col("pos") - F.col("first") - w["offset"]
        return F.coalesce(F.when(at >= 0, F.array_join(F.slice("ctx", F.greatest(at + 1, F.lit(1)), w["n"]), " ") == w["window"]),
                          F.lit(False))

    def holds(stretch: Column, w: Column) -> Column:
        return F.size(F.array_intersect(stretch, w["terms"])) >= w["need"]

    def near(w: Column) -> Column:      # the words around, then each ``width`` of them
        starts = F.sequence(F.lit(1), F.greatest(F.size("ctx") - width + 1, F.lit(1)))
        return holds(F.col("ctx"), w) & F.exists(starts, lambda s: holds(F.slice("ctx", s, F.lit(width)), w))
    found = F.transform(F.filter("wins", lambda w: w["rarest"] & phrase(w)), lambda w: F.struct(
        (F.col("pos") - w["offset"]).alias("start"), w["n"].alias("n"), w["items"].alias("items")))
    close = F.array_distinct(F.flatten(F.transform(F.filter("wins", near), lambda w: w["items"])))
    x = x.select("doc_id", "tk", found.alias("phrases"), close.alias("near")).where(
        (F.size("phrases") > 0) | (F.size("near") > 0))
    return x.groupBy("doc_id", "tk").agg(F.flatten(F.collect_list("phrases")).alias("phrases"),
                                         F.array_distinct(F.flatten(F.collect_set("near"))).alias("near"))


def covered(phrases: Column) -> Column:
    """How many words lie in any of the (start, n) spans."""
    spans = F.array_sort(F.transform(phrases, lambda p: F.struct(
        p["start"].cast("long").alias("s"), (p["start"] + p["n"]).cast("long").alias("e"))))
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(spans, zero, lambda a, p: F.struct(
        F.greatest(a["end"], p["e"]).alias("end"),
        (a["n"] + F.greatest(F.lit(0).cast("long"), p["e"] - F.greatest(p["s"], a["end"]))).alias("n")))["n"]


def contamination(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, tk (hash of the text), n_words, n_hit, item_ids (sorted), near_items (sorted)."""
    hits = find_matches(docs, items, **options)
    hits = hits.select(F.col("doc_id").alias("_id"), F.col("tk").alias("_tk"), covered(F.col("phrases")).alias("n_hit"),
                       F.sort_array(F.array_distinct(F.flatten(F.col("phrases.items")))).alias("item_ids"),
                       F.sort_array("near").alias("near_items"))
    hits = materialise(hits, "hits")
    d = docs.select("doc_id", F.xxhash64("text").alias("tk"), word_count(raw_words(F.col("text"))).alias("n_words"))
    x = d.join(hits, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tk") == F.col("_tk")), "left")
    none = F.array().cast("array<string>")
    return x.select("doc_id", "tk", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("item_ids", none).alias("item_ids"), F.coalesce("near_items", none).alias("near_items"))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS k
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS k
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
             FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, k)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hit) GROUP BY 1),
tok AS (SELECT doc_id, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS p FROM d),
tf AS (SELECT t, count(*) AS tf FROM tok GROUP BY t),
win AS (SELECT k, list_distinct(string_split(k, ' ')) AS ts FROM (SELECT DISTINCT k FROM bw)),
few AS (SELECT k, ts, t, ceil(len(ts) * 8 / 10.0) AS need, row_number() OVER (PARTITION BY k ORDER BY coalesce(tf, 0), t) AS r
        FROM (SELECT k, ts, unnest(ts) AS t FROM win) LEFT JOIN tf USING (t)),
around AS (SELECT doc_id, p, k, ts, need, w FROM tok JOIN few USING (t) JOIN d USING (doc_id)
           WHERE r <= len(ts) - need + 1 AND len(list_intersect(w[greatest(p - 9, 1):p + 9], ts)) >= need),
near AS (SELECT DISTINCT doc_id, k FROM (SELECT *, unnest(range(greatest(p - 9, 1), p + 1)) AS s FROM around)
         WHERE len(list_intersect(w[s:s + 9], ts)) >= need),
nit AS (SELECT doc_id, count(*) AS n_near, string_agg(item_id, ',' ORDER BY item_id) AS ids
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM near JOIN bw USING (k)) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(its.ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
       coalesce(n_near, 0)::BIGINT AS n_near_items, sha256(coalesce(nit.ids, '')) AS near_items_sha256
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id) LEFT JOIN nit USING (doc_id)
"""


@query("op5_decontaminate", SQL)
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all items of the benchmark."""
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                      F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"), F.size("near_items").cast("long").alias("n_near_items"),
                      F.sha2(F.array_join("near_items", ","), 256).alias("near_items_sha256"))
