"""Importance resampling towards a target distribution, drawn by a distributed radix sort.

Texts are bags of hashed word n-grams.  A bucket's gain is the logarithm of how
much more frequent it is in the target than in the raw texts (add-one smoothed,
in integer thousandths); the gains form one array of ``buckets`` numbers, and a
document's weight is the mean of the array at its features.  A Gumbel draw from
a hash of the id makes the weight a score; the documents with the highest
scores are a sample without replacement by weight.

The draw is an exact sort: a least-significant-digit radix sort over the digits
of the composite key (score descending, id ascending).  Each pass is a stable
counting sort: rows lie in blocks of consecutive places; each block counts its
digits, global prefix sums over (digit, block) give every count its first
destination, and a row's destination is that plus its rank among the block's
equal digits.  After the last pass a row's place is its final rank.  Only the
bits in which keys differ get passes.

Scale: the two passes over the texts are map-only with one array of counts a
partition; the gain array has ``buckets`` entries whatever the data.  A sorting
pass shuffles four numbers a row, by (block, digit): no group holds more than
2^``BLOCK_BITS`` rows, however many keys are equal.  Places are written between
passes, so a lost executor repeats one pass.

Defined results: a null or wordless text has no features and weight 0; a null id
hashes as an empty string and comes last in ties; rows that repeat an id are
separate documents, those of equal score and id ranked in any order; without
target texts every gain is that of an empty target; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimsmith.llm.registry import materialise, query, table
from dimsmith.llm.textbytes import TO_LOWER, buffers, in_turn, slices

DIGIT_BITS = 12
BLOCK_BITS = 17          # 131,072 places a block

_IN_WORD = np.zeros(256, bool)
_IN_WORD[0x30:0x3A] = _IN_WORD[0x61:0x7B] = _IN_WORD[0x80:] = True


def _word_array(data: np.ndarray, off: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(lower-cased words of all texts, words per text)."""
    data = TO_LOWER[data]
    solid = _IN_WORD[data]
    edge = np.zeros(len(data) + 1, bool)        # a text starts here
    edge[off] = True
    starts = solid.copy()
    starts[1:] &= ~solid[:-1] | edge[1:len(data)]
    at = np.flatnonzero(starts)
    letters = np.concatenate([[0], np.cumsum(solid)])
    places = np.append(letters[at], letters[-1]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(at), [None, pa.py_buffer(places.tobytes()), pa.py_buffer(data[solid].tobytes())])
    return words, np.diff(np.searchsorted(at, off))


def features(data: np.ndarray, off: np.ndarray, least: int, most: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each feature, text of each feature, words per text): runs of ``least`` to ``most`` words."""
    words, n = _word_array(data, off)
    coded = words.dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False)
    known = coded.dictionary.to_pylist()
    text = np.repeat(np.arange(len(n)), n)
    end = np.cumsum(n)[text] if len(text) else text
    all_b, all_t = [], []
    for size in range(least, most + 1):
        first = np.flatnonzero(np.arange(len(index)) + size <= end)
        if size == 1:
            crc = np.fromiter((zlib.crc32(w) for w in known), np.int64, len(known))
            all_b.append(crc[index] % buckets)
        elif len(first):
            runs, which = np.unique(np.stack([index[first + i] for i in range(size)], 1), axis=0, return_inverse=True)
            crc = np.fromiter((zlib.crc32(b" ".join([known[i] for i in run])) for run in runs.tolist()), np.int64, len(runs))
            all_b.append(crc[which.ravel()] % buckets)
        else:
            continue
        all_t.append(text[first])
    none = np.zeros(0, np.int64)
    return np.concatenate(all_b or [none]), np.concatenate(all_t or [none]), n


def bucket_counts(texts: DataFrame, least: int = 1, most: int = 1, buckets: int = 10000) -> DataFrame:
    """texts (text) -> (bucket, n): features in each bucket, over all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in in_turn(batches):
            data, off = buffers(b.column("text"))
            for i, j in slices(off):
                bucket, _, _ = features(data[off[i]:off[j]], off[i:j + 1] - off[i], least, most, buckets)
                total += np.bincount(bucket, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])
    return texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gain_array(raw: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """Integer gains (thousandths) of all buckets; both tables have at most ``buckets`` rows."""
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for counts, into in ((raw, s), (target, t)):
        for r in counts.collect():
            into[r.bucket] = r.n
    odds = ((t + 1.0) * (float(s.sum()) + buckets)) / ((s + 1.0) * (float(t.sum()) + buckets))
    return np.floor(1000 * np.log(odds)).astype(np.int64)


def weighted(docs: DataFrame, gains: np.ndarray, least: int = 1, most: int = 1) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_words, n_features, weight."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_turn(batches):
            data, off = buffers(b.column("text"))
            for i, j in slices(off):
                bucket, text, n = features(data[off[i]:off[j]], off[i:j + 1] - off[i], least, most, len(gains))
                total = np.zeros(j - i, np.int64)
                np.add.at(total, text, gains[bucket])
                size = np.bincount(text, minlength=j - i)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, j - i), pa.array(n.astype(np.int64)), pa.array(size.astype(np.int64)),
                     pa.array(np.where(size > 0, total // np.maximum(size, 1), 0))],
                    names=["doc_id", "n_words", "n_features", "weight"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_words long, n_features long, weight long")


def gumbel_score(seed: str) -> Column:
    """weight plus a Gumbel draw (thousandths) from a hash of the id."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(h, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.col("weight") + F.floor(F.lit(-1000.0) * F.log(-F.log(u)))


def _digits(rows: DataFrame, keys: list[tuple[str, bool]]) -> list[Column]:
    """The digits of the composite key, least significant first; (column, descending) from the most significant on.

    A key becomes an unsigned 64-bit pattern that sorts alike; bits above the highest
    one in which its values differ are the same in all rows and get no pass.
    """
    least = F.lit(-(1 << 63))
    pattern = {c: (F.bitwise_not(F.col(c)) if down else F.col(c)).bitwiseXOR(least) for c, down in keys}
    ends = rows.agg(*[f(c).alias(f"{name}_{c}") for c, _ in keys for name, f in (("lo", F.min), ("hi", F.max))],
                    *[F.count_if(F.col(c).isNull()).alias(f"none_{c}") for c, _ in keys]).first()
    out = []
    for c, _ in reversed(keys):
        lo, hi = ends[f"lo_{c}"], ends[f"hi_{c}"]
        if lo is not None:
            for shift in range(0, (lo ^ hi).bit_length() if (lo < 0) == (hi < 0) else 64, DIGIT_BITS):
                digit = F.shiftrightunsigned(pattern[c], shift).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1).cast("long"))
                out.append(F.coalesce(digit, F.lit(0).cast("long")))
        if ends[f"none_{c}"]:
            out.append(F.col(c).isNull().cast("long"))      # nulls last
    return out


def counting_pass(rows: DataFrame, digit: Column, block_bits: int = BLOCK_BITS) -> DataFrame:
    """One stable counting sort of rows by ``digit``: ``place`` (any order-preserving numbers) becomes 0, 1, 2..."""
    x = rows.withColumn("block", F.shiftright("place", block_bits)).withColumn("digit", digit)
    counts = x.groupBy("block", "digit").agg(F.count("*").alias("n"))
    digits = counts.groupBy("digit").agg(F.sum("n").alias("n"))        # 2^DIGIT_BITS rows at most
    upto = Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
    digits = digits.select("digit", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("smaller"))
    earlier = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.withColumn("earlier", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(digits, "digit").select(
        "block", "digit", (F.col("smaller") + F.col("earlier")).alias("first"))
    rank = F.row_number().over(Window.partitionBy("block", "digit").orderBy("place")) - 1
    x = x.withColumn("rank_in", rank).join(first, ["block", "digit"])
    return x.withColumn("place", F.col("first") + F.col("rank_in")).select(*rows.columns)


def radix_ranks(rows: DataFrame, keys: list[tuple[str, bool]], block_bits: int = BLOCK_BITS) -> DataFrame:
    """rows with ``place``: 0, 1, 2... in the order of ``keys`` ((long column, descending), nulls last)."""
    x = materialise(rows.withColumn("place", F.monotonically_increasing_id()), "radix")
    for digit in _digits(x, keys) or [F.lit(0).cast("long")]:
        x = materialise(counting_pass(x, digit, block_bits), "radix")
    return x


def resample(docs: DataFrame, target: DataFrame, least: int = 1, most: int = 1, buckets: int = 10000, min_words: int = 20,
             percent: int = 10, seed: str = "2024") -> DataFrame:
    """docs (doc_id, text), target (text) -> doc_id, n_words, n_features, weight, score, rank of every document.

    ``percent`` of the documents with ``min_words`` words are drawn; the others' rank is null.
    """
    gains = gain_array(bucket_counts(docs, least, most, buckets), bucket_counts(target, least, most, buckets), buckets)
    x = materialise(weighted(docs, gains, least, most).withColumn("score", gumbel_score(seed)), "weights")
    ranked = radix_ranks(x.where(F.col("n_words") >= min_words), [("score", True), ("doc_id", False)])
    drawn = ranked.agg(F.expr(f"count(*) * {percent} div 100").alias("drawn"))
    rank = F.when(F.col("place") < drawn.scalar(), F.col("place") + 1)
    return ranked.withColumn("rank", rank).drop("place").unionByName(
        x.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long")))


def drawn_documents(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents themselves, with their rank in ``draw_rank`` (one row of those that repeat an id and score)."""
    r = resample(docs, target, **options).where("rank IS NOT NULL").groupBy(
        F.col("doc_id").alias("__draw_id")).agg(F.min("rank").alias("__draw_rank"))
    return docs.join(r, F.col("doc_id").eqNullSafe(F.col("__draw_id"))).select(
        *[F.col(f"`{c}`") for c in docs.columns], F.col("__draw_rank").alias("draw_rank"))


# crc32, byte by byte; 3988292384 is its polynomial
SQL = r"""
WITH crc AS MATERIALIZED (
  SELECT list(list_reduce(range(8), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, b) ORDER BY b) AS t
  FROM range(256) r(b)),
d AS (SELECT doc_id, row_number() OVER () AS k,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
f AS (SELECT k, unnest(w) AS w FROM d),
words AS (SELECT DISTINCT w FROM (SELECT w FROM f UNION ALL SELECT w FROM b)),
hashed AS MATERIALIZED (
  SELECT w, xor(list_reduce(list_transform(range(octet_length(encode(w))), lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::BIGINT),
                            lambda a, x: xor(a >> 8, t[xor(a & 255, x) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM words, crc),
s AS (SELECT bucket, count(*) AS n FROM f JOIN hashed USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM b JOIN hashed USING (w) GROUP BY bucket),
g AS (SELECT h.bucket,
             floor(1000 * ln(((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE)
                             / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain
      FROM (SELECT DISTINCT bucket FROM hashed) h LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
v AS (SELECT k, sum(gain)::BIGINT AS total FROM f JOIN hashed USING (w) JOIN g USING (bucket) GROUP BY k),
x AS (SELECT doc_id, len(w)::BIGINT AS n_features, CASE WHEN len(w) = 0 THEN 0 ELSE (total - (((total % len(w)) + len(w)) % len(w))) // len(w) END::BIGINT AS weight,
             ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
      FROM d LEFT JOIN v USING (k)),
y AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296.0::DOUBLE)))::BIGINT AS score FROM x),
z AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
             count(*) FILTER (n_features >= 20) OVER () AS n FROM y)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END::BIGINT AS rank FROM z
"""


@query("op13_importance_sampling", SQL)
def op13_importance_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents towards all benchmark texts: single words, 10,000 buckets, 10 % of those with 20 words."""
    out = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")
