"""Language identification by language-bitmask n-gram filters.

A bit-sliced Bloom filter holds the frequent byte n-grams of every language:
slot s of the table is a bit mask with one bit per language, and the AND of an
n-gram's slots gives all languages that contain it in one lookup.  A text's
hits per language (popcounts of its masks' bit slices) are corrected for each
filter's false-positive rate, and the language with the greatest corrected
share of the text's n-grams is the prediction; that share is the score.

Training uses a bounded sample of labelled rows (``sample_docs`` documents a
language in expectation, chosen by hash), counts their n-grams as a Spark
aggregation and keeps at most ``max_ngrams`` a language, so the table on the
driver and in the tasks is bounded by its parameters (2^slot_bits x 8 bytes
for each 64 languages).  Prediction runs over all whole texts in Arrow
batches, a few megabytes at a time; nothing is shuffled.

Text is lower-cased; bytes that are neither ASCII letters nor above 0x7F count
as one kind of space, and each text has one before and after it.

Defined results: a text that is null or has no letter is ``und`` with score 0;
without labelled rows every text is; a text with letters whose n-grams are all
unknown gets the language with most sample rows, score 0; equal shares are
decided in the same order; null languages are not learned; repeated rows are
predicted alike; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimsmith.llm.registry import materialise, query, table
from dimsmith.llm.textbytes import RangeHash, buffers, in_turn, mix, per_doc, slices

GRAMS = (3, 5)
HASHES = 3
UNKNOWN = "und"
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def _padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes with one space before each document and after the last."""
    out = np.insert(_FOLD[data], offsets, 32)
    return out, offsets + np.arange(len(offsets))


def ngrams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n: (hash at each position, whether it counts).

    Windows lie within one padded document and have no two spaces in a row.
    """
    text, off = _padded(data, offsets)
    hashed = RangeHash(text)
    gap = text == 32
    twice = np.concatenate([[0], np.cumsum(gap[1:] & gap[:-1])])
    for n in GRAMS:
        if len(text) < n:
            continue
        h = mix(hashed.windows(n) + np.uint64(n))
        ok = twice[n - 1:] == twice[:len(h)]
        inner = off[1:-1]               # the space between two documents may only end or start a window
        cross = np.zeros(len(text) + 1, np.int32)
        np.add.at(cross, np.maximum(inner - n + 2, 0), 1)
        np.add.at(cross, inner, -1)
        ok &= np.cumsum(cross[:len(h)]) == 0
        yield h, ok


@dataclass
class LanguageFilter:
    langs: list[str]
    slots: np.ndarray           # (2^bits, words) uint64: language masks
    false_hits: np.ndarray      # per language: the rate at which unknown n-grams hit

    @staticmethod
    def build(grams: dict[str, np.ndarray], langs: list[str], slot_bits: int) -> LanguageFilter:
        size = 1 << slot_bits
        slots = np.zeros((size, (len(langs) + 63) // 64), np.uint64)
        rate = np.zeros(len(langs))
        for i, lang in enumerate(langs):
            at = np.unique(np.concatenate(_places(grams[lang], size)))
            slots[at, i // 64] |= np.uint64(1) << np.uint64(i % 64)
            rate[i] = (len(at) / size) ** HASHES
        return LanguageFilter(langs, slots, rate)

    def masks(self, h: np.ndarray) -> np.ndarray:
        out = None
        for at in _places(h, len(self.slots)):
            out = self.slots[at] if out is None else out & self.slots[at]
        return out

    def shares(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(documents, languages): corrected share of the document's n-grams."""
        n = len(offsets) - 1
        total, hits = np.zeros(n), np.zeros((n, len(self.langs)))
        starts = offsets + np.arange(n + 1)
        for h, ok in ngrams(data, offsets):
            bound = np.minimum(starts, len(h))
            total += per_doc(ok, bound)
            masks = self.masks(h)
            masks[~ok] = 0
            for i in range(len(self.langs)):
                bit = (masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
                hits[:, i] += per_doc(bit.astype(bool), bound)
        total = np.maximum(total, 1)[:, None]
        return np.clip((hits / total - self.false_hits) / (1 - self.false_hits), 0, 1)


def _places(h: np.ndarray, size: int) -> list[np.ndarray]:
    step = (h >> np.uint64(32)) | np.uint64(1)
    return [((h + step * np.uint64(j)) & np.uint64(size - 1)).astype(np.int64) for j in range(HASHES)]


def _lowered(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return buffers(pc.utf8_lower(pc.fill_null(col, "")))


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in in_turn(batches):
        data, off = _lowered(b.column("text"))
        langs = np.array(b.column("lang").to_pylist(), dtype=object)
        for i, j in slices(off):
            for lang in sorted(set(langs[i:j])):
                found = []
                mine = np.flatnonzero(langs[i:j] == lang) + i
                part = np.concatenate([data[off[d]:off[d + 1]] for d in mine])
                bound = np.concatenate([[0], np.cumsum(off[mine + 1] - off[mine])])
                for h, ok in ngrams(part, bound):
                    found.append(h[ok])
                if found:
                    gram, n = np.unique(np.concatenate(found), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(gram), pa.string()), pa.array(gram.view(np.int64)), pa.array(n, pa.int64())],
                        names=["lang", "gram", "n"])


def train(labelled: DataFrame, sample_docs: int = 3000, max_ngrams: int = 20_000, slot_bits: int = 18,
          share_of_best: float = 0.1, max_langs: int = 1024) -> LanguageFilter:
    """labelled (doc_id, text, lang, non-null) -> filter.

    An n-gram is in a language's filter if its rate there is at least
    ``share_of_best`` of its greatest rate in any language and it occurs three
    times or more; of those the ``max_ngrams`` most frequent ones.  More than
    ``max_langs`` languages are refused: the filter holds a bit for each.
    """
    labelled = labelled.select("doc_id", "text", "lang")
    sizes = labelled.groupBy("lang").agg(F.count("*").alias("n_docs")).limit(max_langs + 1).collect()
    if len(sizes) > max_langs:
        raise ValueError(f"more than max_langs={max_langs} languages")
    if not sizes:
        return LanguageFilter([], np.zeros((1, 0), np.uint64), np.zeros(0))
    langs = [r.lang for r in sorted(sizes, key=lambda r: (-r.n_docs, r.lang))]
    sizes = F.broadcast(labelled.sparkSession.createDataFrame(sizes, "lang string, n_docs long"))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / (1 << 30)
    counted = (labelled.join(sizes, "lang").where(draw < sample_docs / F.col("n_docs")).select("lang", "text")
               .mapInArrow(_count_grams, "lang string, gram long, n long")
               .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    counted = materialise(counted, "ngrams")
    total = F.broadcast(counted.groupBy("lang").agg(F.sum("n").alias("total")))     # a row a language
    best = Window.partitionBy("gram")
    rank = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    rows = (counted.join(total, "lang").withColumn("_rate", F.col("n") / F.col("total"))
            .withColumn("_best", F.max("_rate").over(best))
            .where((F.col("_rate") >= share_of_best * F.col("_best")) & (F.col("n") >= 3))
            .withColumn("_r", F.row_number().over(rank)).where(F.col("_r") <= max_ngrams)
            .groupBy("lang").agg(F.collect_list("gram").alias("grams")).toArrow())     # max_ngrams a language
    grams = {k.as_py(): g.values.to_numpy().view(np.uint64) for k, g in zip(rows["lang"], rows["grams"], strict=True)}
    langs = [k for k in langs if k in grams] or langs
    return LanguageFilter.build({k: grams.get(k, np.zeros(0, np.uint64)) for k in langs}, langs, slot_bits)


def _predict(model: LanguageFilter, keep: tuple[str, ...], names: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_turn(batches):
            text = pc.fill_null(b.column("text"), "")
            letter = pc.match_substring_regex(text, r"\p{L}").to_numpy(zero_copy_only=False)
            data, off = _lowered(text)
            lang, score = np.full(len(text), UNKNOWN, object), np.zeros(len(text))
            if model.langs:
                for i, j in slices(off):
                    share = model.shares(data[off[i]:off[j]], off[i:j + 1] - off[i])
                    top = share.argmax(axis=1)
                    lang[i:j] = np.array(model.langs, object)[top]
                    score[i:j] = share[np.arange(j - i), top]
                lang[~letter], score[~letter] = UNKNOWN, 0.0
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in keep] + [pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=[*keep, *names])
    return run


def predict(docs: DataFrame, model: LanguageFilter, keep: tuple[str, ...] = ("doc_id",),
            names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """docs with ``keep`` and text -> ``keep``, the language and its score."""
    fields = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join(f"`{c}` {fields[c]}" for c in keep) + f", `{names[0]}` string, `{names[1]}` double"
    need = [*keep, *(["text"] if "text" not in keep else [])]
    return docs.select(*[F.col(f"`{c}`") for c in need]).mapInArrow(_predict(model, keep, names), schema)


def held_out() -> Column:
    """Whether a document is kept from training: crc32 of its id's text, mod 5, is 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def train_on(docs: DataFrame, **options) -> LanguageFilter:
    """Learn from the documents that are not held out and have a language and an id."""
    return train(docs.where(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull())
                 .select("doc_id", "text", "lang"), **options)


@query("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, whole texts; tested by held-out accuracy."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train_on(docs)
    marked = docs.select("doc_id", "text", held_out().alias("held_out"))
    return predict(marked, model, ("doc_id", "held_out"))
