"""Token-ID output as directly addressable codes.

Documents are range-partitioned and sorted by doc_id, tokenised in Arrow
batches, and written as shards: rows of a Parquet table in the shared folder
(so any store that Spark writes to will do) with a self-contained binary
payload and the documents' places in it.  A payload splits each id into 8-bit
chunks, level by level; a bitmap per level says which ids go on in the next
level, and a rank directory (set bits before every 512th) finds an id's place
there.  Any id or range is read without decoding what precedes it
(`DacShard`).

Tokenising: a batch's texts are cut where no token crosses, every distinct piece
is encoded once by the tokenizers library and the ids are gathered by numpy.  Work
goes on in slices of some MB, which bound a worker's memory; the ids of pieces are
kept from slice to slice, up to a bound.

A shard is closed at ``shard_tokens``; a document is never split, so the
memory of a task is bounded by a shard and one document.  Nothing is collected
but one token count per range partition, from which the partitions' first
positions follow.

Defined results: a null text is empty (the end id alone); an empty table gives
no shard; a null doc_id sorts first; rows that repeat a doc_id are separate
documents, ordered by text; extra columns are ignored.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimsmith.llm.registry import query, shared_path, small_batches, table

MAGIC, BLOCK = b"DAC1", 512
KEPT_PIECES = 1 << 17           # pieces whose ids a worker keeps between slices and tasks: some 30 MB
_SHARD = "part int, seq int, start long, doc_ids array<long>, doc_tokens array<long>, dac binary"


def encode_dac(ids: np.ndarray) -> bytes:
    """uint32 ids -> header, then per level: chunks, continuation bitmap, rank directory."""
    rest, out = ids.astype(np.uint32), []
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little").tobytes()
        ones = np.add.reduceat(more, np.arange(0, len(more), BLOCK), dtype=np.int64) if len(more) else np.zeros(0, np.int64)
        ranks = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<u4") if len(more) else np.zeros(0, "<u4")
        out.append(struct.pack("<I", len(rest)) + (rest & 0xFF).astype(np.uint8).tobytes() + bits + ranks.tobytes())
        rest = rest[more] >> np.uint32(8)
        if not len(rest):
            return MAGIC + struct.pack("<IB", len(ids), len(out)) + b"".join(out)


class DacShard:
    """Random access to the ids of one payload."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a DAC payload")
        self.n, levels = struct.unpack_from("<IB", payload, 4)
        at, self.levels = 9, []
        for _ in range(levels):
            (n,) = struct.unpack_from("<I", payload, at)
            at += 4
            chunks = np.frombuffer(payload, np.uint8, n, at)
            bits = np.frombuffer(payload, np.uint8, (n + 7) // 8, at + n)
            ranks = np.frombuffer(payload, "<u4", (n + BLOCK - 1) // BLOCK, at + n + len(bits))
            at += n + len(bits) + 4 * len(ranks)
            self.levels.append((chunks, bits, ranks))

    def _rank(self, level: int, i: int) -> int:
        """Set bits before place i of a level's bitmap."""
        chunks, bits, ranks = self.levels[level]
        if i >= len(chunks):
            return len(self.levels[level + 1][0]) if level + 1 < len(self.levels) else 0
        block = i // BLOCK
        part = np.unpackbits(bits[block * BLOCK // 8:i // 8 + 1], bitorder="little")
        return int(ranks[block]) + int(part[:i - block * BLOCK].sum())

    def __getitem__(self, i: int) -> int:
        return int(self.slice(i, 1)[0])

    def slice(self, start: int, n: int) -> np.ndarray:
        """ids start .. start + n - 1, touching only their own chunks."""
        out = np.zeros(n, np.uint32)
        place = np.arange(n)
        for level, (chunks, bits, _) in enumerate(self.levels):
            out[place] |= chunks[start:start + n].astype(np.uint32) << np.uint32(8 * level)
            first = start // 8 * 8
            more = np.unpackbits(bits[first // 8:(start + n + 7) // 8], bitorder="little")[start - first:][:n].astype(bool)
            if not more.any():
                break
            place, start, n = place[more], self._rank(level, start), int(more.sum())
        return out


def _byte_symbols() -> list[str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others, in order, for 256 and up."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(256, 512))
    return [chr(b if b in plain else next(other)) for b in range(256)]


#: The normaliser and the pre-tokeniser for which texts may be cut into pieces.
_LOWER_WORDS = (
    {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    "</w>")

#: Letters that the normaliser only lower-cases and that stay in one token of the pre-tokeniser.
_WORD = re.compile("[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")


class Encoder:
    """Whole texts to ids; with the rules of ``_LOWER_WORDS`` each distinct piece of a batch is encoded once.

    There no token crosses white space or a step from an ASCII letter to ``.`` or
    ``,``, and case and the kind of white space do not matter, so texts are cut
    there.  Pieces of Latin letters are what the pre-tokeniser hands to the
    model and go to it directly; all others go through the whole tokeniser, and
    so does every text that holds the start of a special token.  A tokeniser
    with other rules gets whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        parts = [json.loads(x.__getstate__()) if x is not None else None for x in (self.tok.normalizer, self.tok.pre_tokenizer)]
        self.by_piece = (*parts, getattr(self.tok.model, "end_of_word_suffix", None)) == _LOWER_WORDS
        added = self.tok.get_added_tokens_decoder().values()
        self.heads = sorted({t.content[:2] for t in added})
        self.symbols = _byte_symbols()
        self.kept: dict[str, bytes] = {}

    def _piece(self, piece: str) -> list[int]:
        if _WORD.fullmatch(piece):
            if not piece.isascii():
                piece = "".join([self.symbols[b] for b in piece.lower().encode()])
            return [t.id for t in self.tok.model.tokenize(piece)]
        return self.tok.encode(piece, add_special_tokens=False).ids

    def _encoded(self, pieces: list[str]) -> list[bytes]:
        """The pieces' ids as bytes of unsigned 32-bit integers."""
        out = []
        for p in pieces:
            ids = self.kept.get(p)
            if ids is None:
                ids = array("I", self._piece(p)).tobytes()
                if len(p) <= 64 and len(self.kept) < KEPT_PIECES:      # frequent pieces come first
                    self.kept[p] = ids
            out.append(ids)
        return out

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per text)."""
        n = len(texts)
        if not self.by_piece:
            out = [np.array(self.tok.encode(t, add_special_tokens=False).ids, np.uint32) for t in texts.to_pylist()]
            return np.concatenate([np.zeros(0, np.uint32), *out]), np.array([len(x) for x in out], np.int64)
        whole = np.zeros(n, bool)
        for head in self.heads:
            whole |= pc.match_substring(texts, head).to_numpy(zero_copy_only=False)
        cut = pc.if_else(pa.array(whole), "", pc.replace_substring(pc.ascii_lower(texts), "\n", " "))
        cut = pc.replace_substring_regex(cut, pattern="([a-z])([.,])", replacement=r"\1 \2")
        parts = pc.split_pattern(cut, " ")
        per_text = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = parts.flatten().dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False)
        known = self._encoded(coded.dictionary.to_pylist())
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        flat = np.frombuffer(b"".join(known), np.uint32)
        first = np.cumsum(size) - size
        sizes = size[index]
        ends = np.cumsum(sizes)
        ids = flat[np.repeat(first[index] - (ends - sizes), sizes) + np.arange(sizes.sum())]
        counts = np.diff(np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per_text)])])
        if not whole.any():
            return ids, counts
        at, out = np.concatenate([[0], np.cumsum(counts)]), []
        for i in range(n):
            out.append(np.array(self.tok.encode(texts[i].as_py(), add_special_tokens=False).ids, np.uint32)
                       if whole[i] else ids[at[i]:at[i + 1]])
        return np.concatenate(out), np.array([len(x) for x in out], np.int64)


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """The worker's encoder, kept for its next tasks."""
    return Encoder(path)


def _with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    out = np.insert(ids, np.cumsum(counts), end_id) if len(counts) else ids
    return out.astype(np.uint32), counts + 1


def _write_shards(tokenizer: str, end_id: int, shard_tokens: int, batch_bytes: int = 4 << 20):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from dimsmith.llm.textbytes import buffers, in_turn, slices

        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        seq = start = held = 0
        docs: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        ids: list[np.ndarray] = []

        def shard():
            nonlocal seq, start, held
            who, n, all_ids = pa.concat_arrays(docs), np.concatenate(counts), np.concatenate(ids)
            row = pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([start], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(who)], pa.int32()), who),
                pa.ListArray.from_arrays(pa.array([0, len(n)], pa.int32()), pa.array(n, pa.int64())),
                pa.array([encode_dac(all_ids)], pa.binary())],
                names=["part", "seq", "start", "doc_ids", "doc_tokens", "dac"])
            seq, start, held = seq + 1, start + len(all_ids), 0
            docs.clear(), counts.clear(), ids.clear()
            return row

        for b in in_turn(batches):
            text, doc = pc.fill_null(b.column("text"), ""), b.column("doc_id").cast(pa.int64())
            _, off = buffers(text)
            for i, j in slices(off, batch_bytes):
                x, n = _with_end(*enc(text.slice(i, j - i)), end_id)
                place = np.concatenate([[0], np.cumsum(n)])
                at = 0
                while at < j - i:       # as many documents as the shard still takes, one at least
                    to = int(np.searchsorted(place, place[at] + max(shard_tokens - held, 1), side="right")) - 1
                    to = min(max(to, at + 1), j - i)
                    docs.append(doc.slice(i + at, to - at))
                    counts.append(n[at:to])
                    ids.append(x[place[at]:place[to]])
                    held += int(place[to] - place[at])
                    at = to
                    if held >= shard_tokens:
                        yield shard()
        if docs:
            yield shard()
    return run


def write_token_store(docs: DataFrame, tokenizer: str, path: str, end_id: int = 1,
                      shard_tokens: int = 1 << 20) -> str:
    """Write the shards of docs (doc_id, text) in ascending doc_id order to ``path``."""
    # rows that share an id, or have none, are spread by how their text begins, in the order of the texts
    shards = (docs.select("doc_id", "text", F.substring("text", 1, 64).alias("head"))
              .repartitionByRange("doc_id", "head").sortWithinPartitions("doc_id", "text").select("doc_id", "text")
              .mapInArrow(_write_shards(tokenizer, end_id, shard_tokens), _SHARD))
    with small_batches(docs.sparkSession, "8m"):
        shards.write.parquet(path)
    return path


def _read_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for row in range(b.num_rows):
            shard = DacShard(b.column("dac")[row].as_py())
            n = b.column("doc_tokens")[row].values.to_numpy(zero_copy_only=False)
            who = b.column("doc_ids")[row].values
            at = np.concatenate([[0], np.cumsum(n)])
            raw = memoryview(shard.slice(0, shard.n).astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * at[i]:4 * at[i + 1]]) for i in range(len(n))]
            yield pa.RecordBatch.from_arrays(
                [b.column("part").take(pa.array([row] * len(n), pa.int64())), who,
                 pa.array(at[:-1] + b.column("start")[row].as_py(), pa.int64()),
                 pa.array(n, pa.int64()), pa.array(crc, pa.int64())],
                names=["part", "doc_id", "at", "n_tokens", "ids_crc32"])


def read_token_index(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    shards = spark.read.schema(_SHARD).parquet(path)
    # one count per range partition, whatever the number of documents
    total = shards.groupBy("part").agg(F.sum(F.aggregate(
        "doc_tokens", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")).collect()
    first, at = [], 0
    for r in sorted(total, key=lambda r: r.part):
        first.append((r.part, at))
        at += r.n
    first = spark.createDataFrame(first, "part int, first long")
    docs = shards.select("part", "start", "doc_ids", "doc_tokens", "dac").mapInArrow(
        _read_docs, "part int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return docs.join(first, "part").select("doc_id", (F.col("first") + F.col("at")).alias("start"),
                                           "n_tokens", "ids_crc32")


def token_index(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1) -> DataFrame:
    """Write the store to a fresh shared folder and return its index, read back."""
    spark = docs.sparkSession
    if tokenizer is None:
        import public_tokenizers
        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return read_token_index(spark, write_token_store(docs, tokenizer, shared_path(spark, "tokens"), end_id))


@query("op7_token_store")
def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; tested by an exact round trip against the library."""
    return token_index(table(spark, sf_dir, "documents"))
