"""Removal of repeated byte strings by bucketed suffix sorting over a cover.

Every ``LENGTH``-byte string (window) that also starts earlier is removed.  A
full suffix sort would shuffle every position, so suffixes are represented by a
cover: a sparse set of sample positions such that any two equal windows contain
a sample at the same offset.  The usual arithmetic difference cover needs 12 to
14 % of all positions for 100-byte strings and a partner's residue to choose
the common sample; here the cover is defined by content (each window's smallest
hashed 32-byte gram, the leftmost of equals), which picks about 3 % and gives
equal windows the same sample without knowing the partner.  README.md has the
figures.

1. Suffix buckets: samples are dealt by the hash of their gram and each bucket
   is sorted by (gram, context, position), the context being all bytes of the
   windows that chose the sample.  Its equal contexts are ranked at once: all
   but the first are repeats, with all their windows.
2. Long ties: only samples whose gram has several contexts are still open.  The
   first of each context goes back to its text, its windows are hashed one by
   one, dealt by that hash and sorted; all but the first of equals are repeats.
3. Each document takes the union of its repeated windows out.

Batches drop their own repeats before the shuffle (an earlier equal exists, so
the verdict is known), and a gram with many contexts in a batch sends one mark
and is open at once, so a passage that a third of all documents share sends few
entries a batch to a bucket, and its windows are dealt by their own hashes.  The number of buckets follows the corpus
size, so one bucket fits a task.  Equality is judged on 64-bit hashes beside 32
further bits of the gram.

Order: smaller doc_id first (null before all), then earlier start.  Matches
never cross documents.

Defined results: a null or empty text has no bytes and the digest of nothing;
rows that repeat doc_id and text are one document and get equal results; rows
with one doc_id, or none, and different texts are ordered by a hash of the text
(95 bits, which also tell them apart); texts
under ``LENGTH`` bytes are kept whole; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count as count_up

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimsmith.llm.registry import materialise, query, table
from dimsmith.llm.textbytes import RangeHash, buffers, give_back, in_turn, mix, slices

LENGTH, GRAM = 100, 32
BUCKET_BYTES = 32 << 20         # of text for each suffix bucket
SORT_AT_ONCE = 1 << 19          # entries of a bucket that are sorted together, and windows of a batch that are hashed together
MANY_CONTEXTS = 8               # of one gram in one batch: its samples are open without being sorted
_POS = np.uint64((1 << 31) - 1)
_COLUMNS = ["bucket", "tie", "value", "doc", "top", "dkey", "at", "count"]
_BLOB = "bucket int, tie binary, value binary, doc binary, top binary, dkey binary, at binary, count binary"
_FOUND = "id long, top long, dk long, removed array<long>, open array<long>"
_KEY = ["id", "top", "dk"]      # a document: its id, whether there is one beside 31 bits of the text's hash, 64 further bits
NULL_ID = -(1 << 63)
NO_ID = 1 << 31                 # added to the top key of documents with an id, so that null comes before all


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """min(x[i : i + width]) for each i."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def samples(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Runs of windows that chose the same sample: doc, at (first window), count, gram, context."""
    none = {k: np.zeros(0, np.uint64 if k in ("gram", "context") else np.int64) for k in ("doc", "at", "count", "gram", "context")}
    if len(data) < LENGTH:
        return none
    hashed = RangeHash(data)
    gram = mix(hashed.windows(GRAM))
    order = (gram & ~_POS) | np.arange(len(gram), dtype=np.uint64)
    chosen = (_sliding_min(order, LENGTH - GRAM + 1) & _POS).astype(np.int64)      # per window
    last = np.diff(offsets) - LENGTH        # a document's last window
    inside = np.zeros(len(chosen) + 1, np.int32)
    has = last >= 0
    np.add.at(inside, offsets[:-1][has], 1)
    np.add.at(inside, offsets[:-1][has] + last[has] + 1, -1)
    inside = np.cumsum(inside[:-1]).astype(bool)
    first = inside.copy()
    first[1:] &= ~(inside[:-1] & (chosen[1:] == chosen[:-1]))
    at = np.flatnonzero(first)
    if not len(at):
        return none
    ends = inside.copy()
    ends[:-1] &= ~(inside[1:] & (chosen[1:] == chosen[:-1]))
    count = np.flatnonzero(ends) - at + 1
    sample = chosen[at]
    doc = np.searchsorted(offsets, at, side="right") - 1
    context = hashed(at, at + count + LENGTH - 1)
    context = mix(context + (sample - at).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return {"doc": doc, "at": at - offsets[doc], "count": count, "gram": gram[sample], "context": context}


def _earlier(order: np.ndarray, keys: list[np.ndarray], doc, top, dk, at) -> tuple[np.ndarray, np.ndarray]:
    """(starts of the groups of equal keys, whether the entry has an earlier equal one), in ``order``."""
    new = np.ones(len(order), bool)
    if len(order) > 1:
        new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    head = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    later = np.any([x[order] != x[order][head] for x in (doc, top, dk, at)], axis=0)
    return new, later


def _joined(doc, top, dk, at, count) -> tuple[np.ndarray, ...]:
    """Sorted runs of windows, those that touch or overlap joined; a run is 255 windows at most."""
    end = at + count
    new = np.ones(len(doc), bool)
    new[1:] = np.any([x[1:] != x[:-1] for x in (doc, top, dk)], axis=0)
    # the furthest end so far of the document: documents are kept apart by an offset
    number = np.cumsum(new)
    wide = np.int64(1) << 32
    reach = np.maximum.accumulate(end.astype(np.int64) + number * wide) - number * wide
    new[1:] |= at[1:] > reach[:-1]
    heads = np.flatnonzero(new)
    length = reach[np.append(heads[1:] - 1, len(doc) - 1)] - at[heads]
    pieces = -(-length // 255)
    back = np.repeat(heads, pieces)
    nth = np.arange(len(back)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    size = np.minimum(np.repeat(length, pieces) - 255 * nth, 255)
    return doc[back], top[back], dk[back], at[back] + 255 * nth, size


def _blobs(tie, value, doc, top, dk, at, count, buckets: int, salt: int, by_gram: bool) -> Iterator[pa.RecordBatch]:
    """The batch's first entry of each (tie, value) by bucket, the others as known repeats.

    Samples are dealt by their gram, windows by their hash.  A gram with many
    contexts in the batch is open, whatever other batches hold: its bucket gets
    one mark, an entry without windows, and its samples go on to the windows.
    """
    bucket = ((tie if by_gram else value) % np.uint64(buckets)).astype(np.int64)
    small = (tie >> np.uint64(32)).astype(np.uint32)
    order = np.lexsort((at, dk, top, doc, value, small, bucket))
    new, later = _earlier(order, [bucket, small, value], doc, top, dk, at)
    entry, known, opened = order[new], order[~new & later], order[:0]
    if by_gram and len(entry):
        gram = np.concatenate([[True], (small[entry][1:] != small[entry][:-1]) | (bucket[entry][1:] != bucket[entry][:-1])])
        size = np.diff(np.append(np.flatnonzero(gram), len(entry)))
        many = np.repeat(size > MANY_CONTEXTS, size)
        opened, mark = entry[many], entry[many & gram]
        count = count.copy()
        if len(mark):       # the mark itself is also among the open samples
            tie, value, doc, top, dk, at = (np.concatenate([x, x[mark]]) for x in (tie, value, doc, top, dk, at))
            bucket, small = (np.concatenate([x, x[mark]]) for x in (bucket, small))
            count = np.concatenate([count, np.zeros(len(mark), count.dtype)])
            entry = np.concatenate([entry[~many], np.arange(len(count) - len(mark), len(count))])
    entry = entry[np.lexsort((at[entry], dk[entry], top[entry], doc[entry], bucket[entry]))]
    cut = np.flatnonzero(np.diff(bucket[entry], prepend=-1))
    for part in np.split(entry, cut[1:]) if len(entry) else []:
        yield _blob(int(bucket[part[0]]), small[part], value[part], doc[part], top[part], dk[part], at[part], count[part])
    for kind, part in ((1, known), (2, opened)):
        if len(part):       # settled here: passed through other groups, spread over the tasks
            part = part[np.lexsort((at[part], dk[part], top[part], doc[part]))]
            runs = doc[part], top[part], dk[part], at[part], count[part]
            yield _blob(kind * buckets + salt % buckets, small[:0], value[:0], *(_joined(*runs) if kind == 1 else runs))


_KINDS = {"tie": "<u4", "value": "<u8", "doc": "<i8", "top": "<u4", "dkey": "<i8", "at": "<u4", "count": "<u1"}
_SORTED = ("doc", "top", "dkey", "at")         # kept as differences, which compress well


def _blob(bucket, *arrays) -> pa.RecordBatch:
    cols = [pa.array([bucket], pa.int32())]
    for (c, kind), x in zip(_KINDS.items(), arrays, strict=True):
        x = x.astype(kind)
        if c in _SORTED:
            x = np.concatenate([x[:1], x[1:] - x[:-1]])
        cols.append(pa.array([x.tobytes()], pa.binary()))
    return pa.RecordBatch.from_arrays(cols, names=_COLUMNS)


def _read_blobs(t: pa.Table) -> list[np.ndarray]:
    out = []
    for c, kind in _KINDS.items():
        rows = [np.frombuffer(x.as_buffer(), kind) for x in t.column(c)]
        out.append(np.concatenate([np.cumsum(x, dtype=kind) if c in _SORTED else x for x in rows]))
    return out


def _ids(b: pa.RecordBatch) -> list[np.ndarray]:
    return [b.column(c).to_numpy(zero_copy_only=False) for c in _KEY]


def _batch_salts() -> Iterator[int]:
    """A number for each batch of a task, so that what batches pass through is spread over the groups."""
    from pyspark import TaskContext
    task = TaskContext.get()
    first = (task.partitionId() if task else 0) << 32
    for n in count_up():
        yield int(mix(np.array([first + n], np.uint64))[0] >> np.uint64(33))


def _sample_blobs(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, salt in zip(in_turn(batches), _batch_salts(), strict=False):
            doc, top, dk = _ids(b)
            data, off = buffers(b.column("text"))
            parts = []
            for i, j in slices(off):
                s = samples(data[off[i]:off[j]], off[i:j + 1] - off[i])
                s["doc"] = s["doc"] + i
                parts.append(s)
            if parts:
                s = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
                yield from _blobs(s["gram"], s["context"], doc[s["doc"]], top[s["doc"]], dk[s["doc"]], s["at"], s["count"], buckets, salt, True)
    return run


def _by_document(doc, top, dk, at, count, is_open) -> pa.Table:
    """One row per document: its repeated and its open runs as (start << 20 | count)."""
    code = (at.astype(np.int64) << 20) | count.astype(np.int64)
    order = np.lexsort((at, dk, top, doc))
    doc, top, dk, code, is_open = doc[order], top[order].astype(np.int64), dk[order], code[order], is_open[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (top[1:] != top[:-1]) | (dk[1:] != dk[:-1])
    heads = np.flatnonzero(new)
    lists = []
    for want in (False, True):
        pick = is_open == want
        lists.append(pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(pick)])[np.append(heads, len(doc))], pa.int32()),
            pa.array(code[pick], pa.int64())))
    return pa.table({"id": pa.array(doc[heads], pa.int64()), "top": pa.array(top[heads], pa.int64()),
                     "dk": pa.array(dk[heads], pa.int64()), "removed": lists[0], "open": lists[1]})


def _sort_bucket(buckets: int, resolve: bool):
    """One bucket: repeats of each value; with ``resolve`` the first of each value of a tie is open."""
    def run(t: pa.Table) -> pa.Table:
        kind = t.column("bucket")[0].as_py() // buckets
        tie, value, doc, top, dk, at, count = _read_blobs(t)
        if kind:
            return _by_document(doc, top, dk, at, count, np.full(len(doc), kind == 2))
        repeats, stills = [], []
        for part in _parts(tie, SORT_AT_ONCE):
            repeat, still = _judge(part, tie, value, doc, top, dk, at, count, resolve)
            repeats.append(repeat)
            stills.append(still)
        del tie, value
        n = sum(map(len, repeats))
        x = np.concatenate([*repeats, *stills])
        out = _by_document(doc[x], top[x], dk[x], at[x], count[x], np.arange(len(x)) >= n)
        del doc, top, dk, at, count, x, repeats, stills
        give_back()
        return out
    return run


def _parts(tie: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """The entries in parts of about ``most``, those of one tie together: what sorts a part is small beside the bucket."""
    n = max(1, -(-len(tie) // most))
    part = (tie % np.uint32(n)).astype(np.uint16 if n < 1 << 16 else np.uint32)
    for i in range(n):
        yield np.flatnonzero(part == i)


def _judge(part, tie, value, doc, top, dk, at, count, resolve: bool) -> tuple[np.ndarray, np.ndarray]:
    """(repeats, open entries) of a part of a bucket that holds all entries of its ties."""
    marked = np.unique(tie[part[count[part] == 0]])
    part = part[count[part] > 0]
    tie, value, doc, top, dk, at = (x[part] for x in (tie, value, doc, top, dk, at))
    order = np.lexsort((at, dk, top, doc, value, tie))
    new, later = _earlier(order, [tie, value], doc, top, dk, at)
    repeat, still = order[~new & later], order[:0]
    if resolve:
        heads = order[new]
        same = tie[heads][1:] == tie[heads][:-1]
        several = np.isin(tie[heads], marked)
        several[1:] |= same
        several[:-1] |= same
        still = heads[several]
    return part[repeat], part[still]


def _lists(b: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    col = b.column(name)
    size = col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return col.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(size)])


def _cut(raw: bytes, codes: np.ndarray) -> tuple[int, int, int, str]:
    """(bytes, removed, spans, digest of the rest) of one document."""
    if not len(codes):
        return len(raw), 0, 0, hashlib.sha256(raw).hexdigest()
    codes = np.sort(codes)
    start = codes >> 20
    end = np.maximum.accumulate(start + (codes & 0xFFFFF) + LENGTH - 1)
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    s = start[new]
    e = end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]
    rest, at = hashlib.sha256(), 0
    for x, y in zip(s.tolist(), e.tolist(), strict=True):
        rest.update(raw[at:x])
        at = y
    rest.update(raw[at:])
    return len(raw), int((e - s).sum()), len(s), rest.hexdigest()


_RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _columns(parts: list[tuple]) -> list[np.ndarray]:
    """The parts' columns as one array each; the list is emptied."""
    cols = [np.concatenate(c) for c in zip(*parts, strict=True)]
    parts.clear()
    return cols


def _window_blobs(buckets: int):
    """Hash the windows of open runs one by one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, salt in zip(in_turn(batches), _batch_salts(), strict=False):
            data, off = buffers(b.column("text"))
            opened, o_at = _lists(b, "open")
            doc, top, dk = _ids(b)
            out: list[tuple] = []
            held, nth = 0, 0
            for i in np.flatnonzero(np.diff(o_at)):
                hashed = RangeHash(data[off[i]:off[i + 1]])
                code = opened[o_at[i]:o_at[i + 1]]
                count = code & 0xFFFFF
                at = np.repeat((code >> 20) - (np.cumsum(count) - count), count) + np.arange(count.sum())
                value = hashed(at, at + LENGTH)
                tie = hashed(at + 30, at + 70)      # the bytes' middle, hashed apart from the whole
                out.append((tie, value, *(np.full(len(at), x[i]) for x in (doc, top, dk)), at, np.ones(len(at), np.uint8)))
                held += len(at)
                if held >= SORT_AT_ONCE:
                    yield from _blobs(*_columns(out), buckets, salt + nth, False)
                    held, nth = 0, nth + 1
            if out:
                yield from _blobs(*_columns(out), buckets, salt + nth, False)
    return run


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in in_turn(batches):
        data, off = buffers(b.column("text"))
        first, f_at = _lists(b, "removed")
        more, m_at = _lists(b, "more")
        got = [_cut(data[off[i]:off[i + 1]].tobytes(), np.concatenate([first[f_at[i]:f_at[i + 1]], more[m_at[i]:m_at[i + 1]]]))
               for i in range(b.num_rows)]
        yield pa.RecordBatch.from_arrays(
            [b.column("id"), b.column("top")] + [pa.array([g[k] for g in got], pa.string() if k == 3 else pa.int64()) for k in range(4)],
            names=["id", "top", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _gather(found: DataFrame) -> DataFrame:
    return found.groupBy(*_KEY).agg(F.flatten(F.collect_list("removed")).alias("removed"),
                                         F.flatten(F.collect_list("open")).alias("open"))


def remove_repeats(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """docs (doc_id long, text) -> doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Texts are shuffled once, by document: both joins read the same exchange.
    """
    d = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"),
                    F.xxhash64(F.lit(9), "text").bitwiseAND(F.lit(NO_ID - 1)).bitwiseOR(
                        F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(F.lit(NO_ID))).cast("long").alias("top"),
                    F.xxhash64("text").alias("dk"),
                    F.coalesce("text", F.lit("")).alias("text"))
    total = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, -(-total // bucket_bytes))

    blobs = d.mapInArrow(_sample_blobs(buckets), _BLOB)
    # tasks grow in number, not in size, with the corpus
    tasks = max(2 * buckets, int(d.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = materialise(_gather(blobs.repartition(tasks, "bucket").groupBy("bucket").applyInArrow(_sort_bucket(buckets, True), _FOUND)), "found")
    x = d.join(found, _KEY, "left")
    more = x.where(F.size("open") > 0).mapInArrow(_window_blobs(buckets), _BLOB)
    more = _gather(more.repartition(tasks, "bucket").groupBy("bucket").applyInArrow(_sort_bucket(buckets, False), _FOUND))
    out = x.join(more.select(*_KEY, F.col("removed").alias("more")), _KEY, "left")
    out = out.select("id", "top", "text", "removed", "more").mapInArrow(_finish, f"id long, top long, {_RESULT}")
    return out.select(F.when(F.col("top") >= NO_ID, F.col("id")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op9_repeat_spans")
def op9_repeat_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, whole texts as UTF-8 bytes; tested against a plain scan of all windows."""
    return remove_repeats(table(spark, sf_dir, "documents"))
