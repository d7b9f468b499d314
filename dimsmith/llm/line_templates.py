"""Line deduplication by a log-template tree.

Lines are parsed as log messages are: a fixed-depth tree whose first level is
the number of tokens and whose next levels are the ``LEAD`` leading tokens; a
token with a digit is a variable field (``<*>``) on every level.  Below a leaf
the rest of the line is generalised to templates: the line itself and, for each
of ``BLOCKS`` equal parts of the remaining tokens, the line with that part as a
variable field.  Two lines under one leaf that differ within one part (so at
least three quarters of the rest agree) therefore share a template, whatever
the order in which lines come; no leaf is ever gathered in one place.

A template with ``LONG`` fixed tokens or more (neither a field nor in the left-out
part) recurs from ``LONG_DOCS`` documents on, a shorter or more generic one from
``SHORT_DOCS`` on, and every line that has a recurring template is dropped from
its document.  The lowest bit of a template's hash says which of the two it is.

Scale: texts are parsed once, into a written table of template hashes per
document; counting has map-side combine, however common a line is; recurring
templates are a small table that Spark broadcasts if its bytes allow and
otherwise joins by shuffle, splitting hot partitions.  Lines move as hashes;
texts move once, to meet the dropped line numbers.

Defined results: a null or empty text has no line; lines without a word are
never dropped; lines of fewer than ``MIN_TOKENS`` tokens have no left-out part
and only match as they are but for their fields; rows that repeat doc_id and text count
as separate documents and lose the same lines; an empty table gives an empty
result; extra columns are kept by `drop_lines`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimsmith.llm.registry import materialise, query, table
from dimsmith.llm.textbytes import RangeHash, buffers, in_turn, mix, slices, words

LEAD, BLOCKS, MIN_TOKENS = 3, 4, 8
LONG, LONG_DOCS, SHORT_DOCS = 8, 2, 10
_DIGIT = np.zeros(256, np.int64)
_DIGIT[48:58] = 1
_FIELD = np.uint64(0x5851F42D4C957F2D)
_odd = np.random.default_rng(3).integers(1, 1 << 63, 4096, dtype=np.uint64) | np.uint64(1)


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, document, number within the document) of every \\n-split line of non-empty texts."""
    ls = np.union1d(offsets[:-1], np.flatnonzero(data == 10) + 1)
    ls = ls[ls < len(data)]
    doc = np.searchsorted(offsets, ls, side="right") - 1
    first = np.searchsorted(ls, offsets[doc], side="left")
    return ls, doc, np.arange(len(ls)) - first


def _marked(template: np.ndarray, fixed: np.ndarray) -> np.ndarray:
    """Template hashes whose lowest bit is set if they have ``LONG`` fixed tokens."""
    return (template & ~np.uint64(1)) | (fixed >= LONG).astype(np.uint64)


def templates(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, line number, (lines, 1 + BLOCKS) template hashes) of lines with a word."""
    start, end, _ = words(data, offsets)
    ls, line_doc, number = line_spans(data, offsets)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 1 + BLOCKS), np.uint64)
    line = np.searchsorted(ls, start, side="right") - 1
    h = RangeHash(data)(start, end)
    digits = np.concatenate([[0], np.cumsum(_DIGIT[data])])
    n = np.bincount(line, minlength=len(ls))
    held = np.flatnonzero(n)
    first = np.concatenate([[0], np.cumsum(n)[:-1]])
    place, size = np.arange(len(start)) - first[line], n[line]
    field = digits[end] > digits[start]
    h = np.where(field, _FIELD, h)
    # each token's share of the line's sum depends on its place; a left-out part adds a mark instead
    term = mix(h + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) * _odd[place % len(_odd)]
    at = first[held]
    full = np.add.reduceat(term, at)
    leaf = np.add.reduceat(np.where(place < LEAD, term, np.uint64(0)), at) + mix(n[held].astype(np.uint64))
    rest = np.maximum(size - LEAD, 1)
    part = np.where(place < LEAD, -1, (place - LEAD) * BLOCKS // rest)
    fixed = np.add.reduceat((~field).astype(np.int64), at)
    out = np.zeros((len(held), 1 + BLOCKS), np.uint64)
    out[:, 0] = _marked(mix(leaf ^ mix(full)), fixed)
    for p in range(BLOCKS):
        left = full - np.add.reduceat(np.where(part == p, term, np.uint64(0)), at)
        own = _marked(mix(leaf ^ mix(left + _FIELD * np.uint64(p + 2))),
                      fixed - np.add.reduceat(((part == p) & ~field).astype(np.int64), at))
        out[:, 1 + p] = np.where(n[held] >= MIN_TOKENS, own, out[:, 0])
    return line_doc[held], number[held], out


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in in_turn(batches):
        data, off = buffers(b.column("text"))
        for i, j in slices(off):
            doc, number, t = templates(data[off[i]:off[j]], off[i:j + 1] - off[i])
            ends = np.searchsorted(doc, np.arange(j - i + 1))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").slice(i, j - i), b.column("tk").slice(i, j - i),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(number, pa.int32())),
                 pa.ListArray.from_arrays(pa.array(ends * t.shape[1], pa.int32()), pa.array(t.ravel().view(np.int64)))],
                names=["doc_id", "tk", "lines", "templates"])


def line_table(docs: DataFrame) -> DataFrame:
    """doc_id, tk (hash of the text), lines (numbers of lines with a word), templates (1 + BLOCKS a line)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("tk"), "text").mapInArrow(
        _lines, f"doc_id {kind}, tk long, lines array<int>, templates array<long>")


def recurring_templates(lines: DataFrame, min_docs: int | None = None) -> DataFrame:
    """template, n: the templates that recur (given ``min_docs``: in as many documents, whatever their length)."""
    long = F.col("template").bitwiseAND(F.lit(1)) == 1
    least = F.when(long, LONG_DOCS).otherwise(SHORT_DOCS) if min_docs is None else F.lit(min_docs)
    once = lines.select(F.explode(F.array_distinct("templates")).alias("template"))
    return once.groupBy("template").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def dropped_lines(docs: DataFrame, min_docs: int | None = None) -> DataFrame:
    """doc_id, tk (hash of the text), drop: the numbers of the lines to drop."""
    lines = materialise(line_table(docs), "lines")
    recurring = materialise(recurring_templates(lines, min_docs).select("template"), "templates")
    each = lines.select("doc_id", "tk", "lines", F.posexplode("templates").alias("i", "template")).select(
        "doc_id", "tk", F.get("lines", F.floor(F.col("i") / (1 + BLOCKS)).cast("int")).alias("line"), "template")
    hit = each.join(recurring, "template", "left_semi")
    return hit.groupBy("doc_id", "tk").agg(F.sort_array(F.collect_set("line")).alias("drop"))


def drop_lines(docs: DataFrame, min_docs: int | None = None) -> DataFrame:
    """docs with their text less the dropped lines, n_lines and n_dropped."""
    gone = dropped_lines(docs, min_docs).select(F.col("doc_id").alias("__line_id"), F.col("tk").alias("__line_tk"), F.col("drop").alias("__line_drop"))
    x = docs.withColumn("__line_h", F.xxhash64("text"))
    x = x.join(gone, F.col("doc_id").eqNullSafe(F.col("__line_id")) & (F.col("__line_h") == F.col("__line_tk")), "left")
    x = x.withColumn("__line_drop", F.coalesce("__line_drop", F.array().cast("array<int>")))
    lines = F.split("text", "\n", -1)
    # the numbers left, by a hash set: linear in the lines
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "__line_drop"), lambda i: F.get(lines, i))
    text = F.when(F.size("__line_drop") > 0, F.array_join(kept, "\n")).otherwise(F.col("text"))
    n = F.when(F.coalesce(F.col("text"), F.lit("")) == "", 0).otherwise(F.size(lines))
    return x.select(*[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns],
                    n.cast("long").alias("n_lines"), F.size("__line_drop").cast("long").alias("n_dropped"))


@query("op3_line_templates")
def op3_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, whole texts; tested against a plain count of all templates."""
    out = drop_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.length("text").cast("long").alias("kept_chars"),
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
