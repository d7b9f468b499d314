"""Quality rules with thresholds that adapt to each language and source.

`document_stats` counts words, symbols, repeated lines and repeated 3-word
windows of whole texts with numpy over the UTF-8 bytes of Arrow batches, a few
megabytes at a time.  Documents that pass the base rules feed mergeable
quantile sketches: per (lang, source, metric) a count for each logarithmic
bucket of the value (relative error 1 %).  Counts merge by addition, so the
sketches are one ordinary aggregation with map-side combine, whatever share of
the rows a source has, and a source with too few documents is judged by its
language's merged sketch, or by that of all documents.

A threshold is the upper Tukey fence Q3 + k (Q3 - Q1), for word length also
the lower one.  Where the quartiles are closer than the metric's least spread
(most groups hardly ever repeat a line), that stands for their distance, so a
group without outliers loses nothing.  The thresholds (one row per group) are
joined back to the statistics.

Defined results: a null or empty text has no words and fails the base rules;
null languages and sources are groups of their own; repeated rows are judged
alike; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimsmith.llm.registry import materialise, query, table
from dimsmith.llm.textbytes import RangeHash, buffers, in_turn, mix, per_doc, slices, words

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
_STATS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]

#: metric: (numerator, denominator, least spread, whether too small a value counts too).
#: The least spread stands for the distance of the quartiles where these are closer, as in a
#: group whose documents hardly ever repeat a line; it moves with the group's quartiles.
METRICS = {
    "symbols": ("n_symbols", "n_words", 0.03, False),
    "word_length": ("word_chars", "n_words", 0.5, True),
    "dup_lines": ("n_dup_lines", "n_lines", 0.15, False),
    "repeats": ("n_repeat_words", "n_words", 0.12, False),
}
GAMMA = 1.02
ZERO = -1_000_000


def slice_stats(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each document of one buffer."""
    n, out = len(offsets) - 1, {}
    start, end, doc = words(data, offsets)
    hashed = RangeHash(data)
    out["n_words"] = np.bincount(doc, minlength=n).astype(np.int64)
    solid = np.zeros(len(data) + 1, np.int8)      # bytes in words
    solid[start] += 1
    solid[end] -= 1
    inside = np.cumsum(solid[:-1], dtype=np.int8).astype(bool)
    out["word_chars"] = per_doc(inside & ((data & 0xC0) != 0x80), offsets)
    out["n_symbols"] = per_doc(SYMBOLS[data], offsets)

    # lines with a word, equal to an earlier line of the document
    feeds = np.flatnonzero(data == 10)
    ls = np.union1d(offsets[:-1], feeds + 1)
    ls = ls[ls < len(data)]
    le = np.append(ls[1:], len(data))
    le = le - (data[le - 1] == 10) if len(le) else le
    held = np.concatenate([[0], np.cumsum(inside)])
    ok = held[le] > held[ls]
    ls, le = ls[ok], le[ok]
    line_doc = np.searchsorted(offsets, ls, side="right") - 1
    out["n_lines"] = np.bincount(line_doc, minlength=n).astype(np.int64)
    _, again = _repeats(hashed(ls, le), line_doc)
    out["n_dup_lines"] = np.bincount(line_doc[again], minlength=n).astype(np.int64)

    covered = np.zeros(len(start), bool)
    if len(start) > 2:
        h = hashed(start, end)
        tri = mix(h[:-2] * np.uint64(3) + mix(h[1:-1] * np.uint64(5) + mix(h[2:])))
        at = np.flatnonzero(doc[:-2] == doc[2:])
        twice, _ = _repeats(tri[at], doc[at])
        at = at[twice]
        covered[at] = covered[at + 1] = covered[at + 2] = True
    out["n_repeat_words"] = np.bincount(doc[covered], minlength=n).astype(np.int64)
    return out


def _repeats(values: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places whose value occurs again in their document, all but one place of each such value)."""
    key = mix(values + doc.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice, again = np.zeros(len(key), bool), np.zeros(len(key), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    again[order[1:][same]] = True
    return twice, again


def _stats_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in in_turn(batches):
        data, off = buffers(b.column("text"))
        rest = [b.column(i) for i, c in enumerate(b.schema.names) if c != "text"]
        names = [c for c in b.schema.names if c != "text"]
        parts = [slice_stats(data[off[i]:off[j]], off[i:j + 1] - off[i]) for i, j in slices(off)]
        if parts:
            yield pa.RecordBatch.from_arrays(
                rest + [pa.array(np.concatenate([p[c] for p in parts]), pa.int64()) for c in _STATS],
                names=names + _STATS)


def document_stats(docs: DataFrame, keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """docs with ``keep`` and text -> ``keep`` and the counts of the whole text."""
    fields = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join([f"`{c}` {fields[c]}" for c in keep] + [f"{c} long" for c in _STATS])
    return docs.select(*keep, "text").mapInArrow(_stats_batches, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def _bucket(value: Column) -> Column:
    return F.when(value > 0, F.ceil(F.log(value) / math.log(GAMMA) - 1e-9)).otherwise(F.lit(ZERO)).cast("int")


def sketches(stats: DataFrame) -> DataFrame:
    """Mergeable sketches: lang, source, metric, bucket, n."""
    values = F.array(*[F.struct(F.lit(m).alias("metric"), _bucket(F.col(a) / F.greatest(F.col(b), F.lit(1))).alias("bucket"))
                       for m, (a, b, _, _) in METRICS.items()])
    return (stats.select("lang", "source", F.explode(values).alias("v"))
            .groupBy("lang", "source", F.col("v.metric").alias("metric"), F.col("v.bucket").alias("bucket"))
            .agg(F.count("*").alias("n")))


def _quartiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """Q1, Q3 and the number of documents of each group and metric."""
    w = Window.partitionBy(*by, "metric")
    up = w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    s = sketch.groupBy(*by, "metric", "bucket").agg(F.sum("n").alias("n"))
    s = s.withColumn("_upto", F.sum("n").over(up)).withColumn("_all", F.sum("n").over(w))
    value = F.when(F.col("bucket") == ZERO, 0.0).otherwise(
        2 * F.pow(F.lit(GAMMA), F.col("bucket").cast("double")) / (1 + GAMMA))

    def q(share):
        return F.min(F.when(F.col("_upto") >= F.ceil(F.col("_all") * share), F.struct("bucket", value.alias("v"))))["v"]
    return s.groupBy(*by, "metric").agg(q(0.25).alias("q1"), q(0.75).alias("q3"), F.max("_all").alias("n"))


def thresholds(sketch: DataFrame, k: float = 3.0, min_docs: int = 200) -> DataFrame:
    """lang, source and hi_<metric>, lo_<metric> of each group in the sketches.

    A group under ``min_docs`` documents takes its language's quartiles, a
    language under it those of all documents.
    """
    g = _quartiles(sketch, ["lang", "source"])
    by_lang = _quartiles(sketch, ["lang"]).select(
        F.col("lang").alias("_l"), F.col("metric").alias("_m"), F.col("q1").alias("l1"), F.col("q3").alias("l3"), F.col("n").alias("ln"))
    over_all = _quartiles(sketch, []).select(F.col("metric").alias("_am"), F.col("q1").alias("a1"), F.col("q3").alias("a3"))
    g = g.join(by_lang, F.col("lang").eqNullSafe(F.col("_l")) & (F.col("metric") == F.col("_m")))
    g = g.join(over_all, F.col("metric") == F.col("_am"))

    def pick(own, lang, everything):
        return F.when(F.col("n") >= min_docs, F.col(own)).when(F.col("ln") >= min_docs, F.col(lang)).otherwise(F.col(everything))
    g = g.withColumn("_q1", pick("q1", "l1", "a1")).withColumn("_q3", pick("q3", "l3", "a3"))
    out = []
    for m, (_, _, least, both) in METRICS.items():
        here = F.col("metric") == m
        spread = F.greatest(F.col("_q3") - F.col("_q1"), F.lit(least))
        out.append(F.max(F.when(here, F.col("_q3") + k * spread)).alias(f"hi_{m}"))
        if both:
            out.append(F.max(F.when(here, F.col("_q1") - k * spread)).alias(f"lo_{m}"))
    return g.groupBy("lang", "source").agg(*out)


def quality_filter(docs: DataFrame, k: float = 3.0, min_docs: int = 200) -> DataFrame:
    """docs (doc_id, text, lang, source) -> the counts, base_failed and kept."""
    stats = materialise(document_stats(docs), "quality-stats").withColumn("base_failed", base_failed())
    limits = materialise(thresholds(sketches(stats.where(~F.col("base_failed"))), k, min_docs), "quality-limits")
    limits = limits.withColumnRenamed("lang", "_lang").withColumnRenamed("source", "_source")
    x = stats.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    good = ~F.col("base_failed")
    for m, (a, b, _, both) in METRICS.items():
        value = F.col(a) / F.greatest(F.col(b), F.lit(1))
        good &= F.coalesce(value <= F.col(f"hi_{m}"), F.lit(True))
        if both:
            good &= F.coalesce(value >= F.col(f"lo_{m}"), F.lit(True))
    return x.withColumn("kept", good).drop("_lang", "_source")


def _sql() -> str:
    parts, his = [], []
    for m, (a, b, least, both) in METRICS.items():
        parts.append(f"SELECT lang, source, '{m}' AS metric, {a}::DOUBLE / greatest({b}, 1) AS v FROM good")
        value = f"{a}::DOUBLE / greatest({b}, 1)"
        his.append(f"coalesce({value} <= max(q3 + 3 * greatest(q3 - q1, {least})) FILTER (metric = '{m}'), true)")
        if both:
            his.append(f"coalesce({value} >= max(q1 - 3 * greatest(q3 - q1, {least})) FILTER (metric = '{m}'), true)")
    value = f"CASE WHEN bucket = {ZERO} THEN 0.0 ELSE 2 * pow({GAMMA}, bucket::DOUBLE) / {1 + GAMMA} END"

    def quartiles(name: str, by: str) -> str:
        keys = f"{by}, " if by else ""
        return f"""{name} AS (
  SELECT {keys}metric, arg_min(v, bucket) FILTER (upto >= ceil(total * 0.25)) AS q1,
         arg_min(v, bucket) FILTER (upto >= ceil(total * 0.75)) AS q3, max(total) AS n
  FROM (SELECT *, {value} AS v, sum(n) OVER (PARTITION BY {keys}metric ORDER BY bucket) AS upto,
               sum(n) OVER (PARTITION BY {keys}metric) AS total
        FROM (SELECT {keys}metric, bucket, count(*) AS n FROM sk GROUP BY ALL))
  GROUP BY {keys}metric)"""
    stats = "n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words"
    return rf"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w FROM documents),
tri AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c
        FROM (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k
              FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3))),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM tri WHERE c > 1) GROUP BY 1),
ln AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS l FROM d),
s AS (SELECT d.doc_id, lang, source, len(w)::BIGINT AS n_words,
             coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
      FROM d JOIN ln USING (doc_id) LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s),
good AS (SELECT * FROM b WHERE NOT base_failed),
sk AS (SELECT lang, source, metric,
              CASE WHEN v > 0 THEN ceil(ln(v) / {math.log(GAMMA)!r} - 1e-9)::INTEGER ELSE {ZERO} END AS bucket
       FROM ({" UNION ALL ".join(parts)})),
{quartiles("g", "lang, source")},
{quartiles("l", "lang")},
{quartiles("a", "")},
lim AS (SELECT g.lang, g.source, g.metric,
               CASE WHEN g.n >= 200 THEN g.q1 WHEN l.n >= 200 THEN l.q1 ELSE a.q1 END AS q1,
               CASE WHEN g.n >= 200 THEN g.q3 WHEN l.n >= 200 THEN l.q3 ELSE a.q3 END AS q3
        FROM g JOIN l ON g.lang IS NOT DISTINCT FROM l.lang AND g.metric = l.metric JOIN a ON g.metric = a.metric)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {" AND ".join(his)} AS kept
FROM b LEFT JOIN lim ON b.lang IS NOT DISTINCT FROM lim.lang AND b.source IS NOT DISTINCT FROM lim.source
GROUP BY b.doc_id, b.lang, b.source, {stats}, base_failed
"""


@query("op8_quality_rules", _sql())
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, whole texts."""
    out = quality_filter(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")
