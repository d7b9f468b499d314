"""Packing documents into sequences by best-two-fit.

Documents longer than a sequence are cut into whole sequences and a rest; no
other piece is cut.  Sequences are filled one after the other: greedily with the
longest piece left that fits, then the sequence's smallest piece is exchanged
for the two unpacked pieces that fill the gap it leaves more tightly, if there
are such.

Only lengths matter to that procedure, so it runs on the counts of pieces by
length (one row per length, ``capacity`` rows at most, whatever the data).  The
same steps repeat while no length they use runs out, so a sequence's pattern is
found once and entered with the number of sequences that follow it: the plan has
a few rows per length, and equals the sequences that the procedure would fill
one by one.

Scale: a piece is a row of numbers.  Pieces are numbered within their length in
two levels (hash buckets, then rows of a bucket), so a length with a third of
all pieces is spread over many tasks; the plan (bounded by ``capacity``) says
for each number the sequence and the place.  No task ever sees the pieces of
more than one bucket, and no pieces go through the driver.

Defined results: a null text is an empty document (the end id alone); rows that
repeat a doc_id are separate documents; an empty table gives no sequences; extra
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimsmith.llm.registry import materialise, query, table
from dimsmith.llm.textbytes import buffers, in_turn, slices
from dimsmith.llm.token_store import Encoder, _with_end

CAPACITY = 4096
BUCKET_ROWS = 50_000


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 1,
                 with_ids: bool = False, batch_bytes: int = 16 << 20) -> DataFrame:
    """docs (doc_id, text) -> doc_id, piece, start, length, ids_crc32 (and ids: little-endian uint32s)."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(tokenizer)
        for b in in_turn(batches):
            text, doc = pc.fill_null(b.column("text"), ""), b.column("doc_id")
            _, off = buffers(text)
            for i, j in slices(off, batch_bytes):
                ids, n = _with_end(*enc(text.slice(i, j - i)), end_id)
                pieces = -(-n // capacity)
                who = np.repeat(np.arange(j - i), pieces)
                piece = np.arange(len(who)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                size = np.minimum(n[who] - start, capacity)
                raw = memoryview(ids.astype("<u4").tobytes())
                ends = 4 * np.cumsum(size)
                parts = [raw[e - 4 * s:e] for e, s in zip(ends.tolist(), size.tolist(), strict=True)]
                out = [doc.slice(i, j - i).take(pa.array(who)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(size, pa.int64()), pa.array([zlib.crc32(p) for p in parts], pa.int64())]
                if with_ids:
                    out.append(pa.array([bytes(p) for p in parts], pa.binary()))
                yield pa.RecordBatch.from_arrays(out, names=names)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def _pattern(count: np.ndarray, capacity: int) -> tuple[dict[int, int], dict[int, int]]:
    """(pieces by length of the next sequence, pieces that its steps have to find), from the counts left."""
    lengths = np.flatnonzero(count)
    left, gap, used = count.copy(), capacity, {}
    at = len(lengths) - 1
    while at >= 0:                      # greedily: the longest piece that fits
        at = int(np.searchsorted(lengths[:at + 1], gap, side="right")) - 1
        if at < 0:
            break
        length = int(lengths[at])
        n = min(int(left[length]), gap // length)
        used[length] = n
        left[length] -= n
        gap -= n * length
        at -= 1
    needed = dict(used)
    if gap and used:                    # two pieces for the smallest one
        small = min(used)
        rest = np.flatnonzero(left)
        rest = rest[rest <= gap + small]
        if len(rest):
            mate = np.searchsorted(rest, gap + small - rest, side="right") - 1
            mate = np.where((mate >= 0) & (rest[mate] == rest) & (left[rest] < 2), mate - 1, mate)      # a length of one piece
            total = np.where(mate >= 0, rest + rest[mate], 0)
            best = int(np.argmax(total))
            if total[best] > small:
                used[small] -= 1
                if not used[small]:
                    del used[small]
                for length in (int(rest[best]), int(rest[mate[best]])):
                    used[length] = used.get(length, 0) + 1
                    needed[length] = needed.get(length, 0) + 1
    return used, needed


def best_two_fit(count: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """count[length] pieces -> the plan: rows (length, first number, copies, sequences, first sequence, offset).

    Pieces of a length are numbered from 0; a row places ``copies`` of them side
    by side in each of its sequences.
    """
    count, taken = count.astype(np.int64).copy(), np.zeros_like(count, dtype=np.int64)
    plan, sequence = [], 0
    while count.any():
        used, needed = _pattern(count, capacity)
        # the steps are the same as long as every length still has the pieces that they look for
        times = min([(int(count[x]) - needed.get(x, 0)) // n for x, n in used.items()]) + 1
        offset = 0
        for length in sorted(used, reverse=True):
            plan.append((length, int(taken[length]), used[length], times, sequence, offset))
            offset += length * used[length]
            taken[length] += used[length] * times
            count[length] -= used[length] * times
        sequence += times
    return np.array(plan, np.int64).reshape(-1, 6)


def _placed(plan: np.ndarray):
    """(length, number) -> sequence and offset, by binary search in the plan."""
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    wide = plan[:, 1].max(initial=0) + (plan[:, 2] * plan[:, 3]).max(initial=0) + 1     # above every number
    keys = plan[:, 0] * wide + plan[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length = b.column("length").to_numpy(zero_copy_only=False)
            number = b.column("number").to_numpy(zero_copy_only=False)
            row = np.searchsorted(keys, length * wide + number, side="right") - 1
            _, first, copies, _, sequence, offset = plan[row].T
            k = number - first
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i) for i, c in enumerate(b.schema.names) if c != "number"],
                 pa.array(sequence + k // copies), pa.array(offset + k % copies * length)],
                names=[c for c in b.schema.names if c != "number"] + ["sequence_id", "offset"])
    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """pieces (length 1 to capacity, any other columns) with ``sequence_id`` and ``offset``."""
    x = materialise(pieces.withColumn("__row", F.monotonically_increasing_id()), "pack-pieces")
    buckets = max(1, -(-x.count() // bucket_rows))
    x = x.withColumn("__bucket", F.pmod(F.xxhash64("__row"), F.lit(buckets)))
    counts = materialise(x.groupBy("length", "__bucket").agg(F.count("*").alias("n")), "pack-counts")
    by_length = np.zeros(capacity + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():        # capacity rows at most
        by_length[r.length] = r.n
    earlier = Window.partitionBy("length").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "__bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__first"))
    within = Window.partitionBy("length", "__bucket").orderBy("__row")
    x = x.withColumn("__nth", F.row_number().over(within) - 1).join(first, ["length", "__bucket"])
    x = x.select(*pieces.columns, (F.col("__first") + F.col("__nth")).alias("number"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return x.mapInArrow(_placed(best_two_fit(by_length, capacity)), f"{schema}, sequence_id long, offset long")


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def packed_sequences(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = 1) -> DataFrame:
    """The sequences themselves: sequence_id, ids (array of int) and doc_starts (offset, doc_id, start) in order.

    A group is one sequence: ``capacity`` ids at most.
    """
    pieces = token_pieces(docs, tokenizer or default_tokenizer(), capacity, end_id, with_ids=True)
    placed = pack(pieces, capacity).groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "doc_id", "start", "ids"))).alias("parts"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column("raw")
            data, off = buffers(raw)
            ids = np.frombuffer(np.ascontiguousarray(data).tobytes(), "<u4").astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("sequence_id"), pa.ListArray.from_arrays(pa.array(off // 4, pa.int32()), pa.array(ids)), b.column("doc_starts")],
                names=["sequence_id", "ids", "doc_starts"])
    joined = F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    places = F.transform("parts", lambda p: F.struct(p["offset"].alias("offset"), p["doc_id"].alias("doc_id"), p["start"].alias("start")))
    return placed.select("sequence_id", joined.alias("raw"), places.alias("doc_starts")).mapInArrow(
        decode, "sequence_id long, ids array<int>, doc_starts array<struct<offset:bigint,doc_id:bigint,start:bigint>>")


@query("op11_best_fit_packing")
def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4,096 tokens; tested against the procedure run piece by piece."""
    pieces = token_pieces(table(spark, sf_dir, "documents"), default_tokenizer())
    return pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
