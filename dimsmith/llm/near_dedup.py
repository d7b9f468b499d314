"""Near-duplicate documents by MinHash with tensored banding, links verified.

A document's set is its distinct 5-word shingles (64-bit hashes reduced to 50
bits).  Two collections of ``rows`` half-keys each are built from ``width``
MinHashes a half-key; a table's key pairs half-key i of the first collection
with half-key j of the second, so rows x rows tables cost only
2 x rows x width MinHashes.  With 12 rows of 2, 144 tables of 4 MinHashes cost
48 instead of 576; a pair at similarity 0.75 shares a table with probability
0.9999, at 0.8 with more than 0.99999.

Equal sets are one node.  In each table bucket the members are compared with
one representative, never all pairs, in rounds:

* first in the 12 tables of the diagonal (half-key i of both collections),
  where most groups are found; the representative is the member with the
  fullest buckets, which in a group of edited copies is their original;
* then in all tables, but only with half-keys that two components share (a key
  that two components share needs both its halves shared, so nothing is lost,
  and a document without overlap ends at its 24 half-keys);
* again with other representatives, in the buckets that still hold several
  components, until a round adds fewer than one link in 100;
* then every pair of different components among the members of buckets that are
  still open, by an exact prefix filter: shingles are ordered by how often they
  occur there, those of a single component first, and a pair at 0.75 shares one
  of the first quarter of either set.  Pairs meet at such shingles, a common one
  dealt in blocks of ``BLOCK`` members, and are dropped there if the parities of
  their sets differ in more places than sets at 0.75 can differ in shingles.

Every link is confirmed on the full sets: 100 * |A and B| >= 75 * |A or B|.

Hot buckets: representatives come from a min aggregate with map-side combine,
and the joins back are inner joins that adaptive execution splits.

Defined results: a null, empty or wordless text has no set and is linked with
nothing; fewer than five words are one shingle; rows that repeat a doc_id and
text are one document and get equal results; a null doc_id is never the
component's id unless all are null, and is kept only then; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimsmith.llm.components import components
from dimsmith.llm.registry import materialise, query, table
from dimsmith.llm.textbytes import TO_LOWER, RangeHash, buffers, in_turn, mix, slices, words

SHINGLE, ROWS, WIDTH = 5, 12, 2
BLOCK = 500
PARITY_WORDS = 8         # 64 parities each
_BITS = np.uint64(50)
_rng = np.random.default_rng(4)
_A = _rng.integers(1, 1 << 63, 2 * ROWS * WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(1, 1 << 63, 2 * ROWS * WIDTH, dtype=np.uint64)
_PLACE = _rng.integers(1, 1 << 63, SHINGLE + 1, dtype=np.uint64) | np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(all documents' sorted distinct shingles, size of each document's set)."""
    n = len(offsets) - 1
    low = TO_LOWER[data]
    start, end, doc = words(low, offsets)
    h = RangeHash(low)(start, end)
    count = np.bincount(doc, minlength=n)
    parts, owner = [], []
    if len(h) >= SHINGLE:
        full = np.zeros(len(h) - SHINGLE + 1, np.uint64)
        for k in range(SHINGLE):
            full += h[k:len(h) - SHINGLE + 1 + k] * _PLACE[k]
        ok = doc[:len(full)] == doc[SHINGLE - 1:]
        parts.append(mix(full[ok]))
        owner.append(doc[:len(full)][ok])
    few = np.flatnonzero((count > 0) & (count < SHINGLE))
    if len(few):
        first = np.concatenate([[0], np.cumsum(count)[:-1]])[few]
        one = count[few].astype(np.uint64) * _PLACE[SHINGLE]
        for k in range(SHINGLE - 1):
            has = count[few] > k
            one[has] += h[first[has] + k] * _PLACE[k]
        parts.append(mix(one))
        owner.append(few)
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(n, np.int64)
    key = (np.concatenate(owner).astype(np.uint64) << _BITS) | (np.concatenate(parts) >> (np.uint64(64) - _BITS))
    key = np.unique(key)
    size = np.bincount((key >> _BITS).astype(np.int64), minlength=n).astype(np.int64)
    return key & ((np.uint64(1) << _BITS) - np.uint64(1)), size


def half_keys(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    """2 x ROWS half-keys of each non-empty set (rows in document order)."""
    at = np.concatenate([[0], np.cumsum(size)[:-1]])[size > 0]
    out = np.zeros((len(at), 2 * ROWS), np.uint64)
    if not len(at):
        return out
    for i in range(2 * ROWS):
        for j in range(WIDTH):
            x = values * _A[i * WIDTH + j] + _B[i * WIDTH + j]
            x ^= x >> np.uint64(32)
            x *= _A[0]
            low = np.minimum.reduceat(x, at)
            out[:, i] = mix(out[:, i] * np.uint64(0x100000001B3) + low + np.uint64(i))
    return out


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in in_turn(batches):
        data, off = buffers(b.column("text"))
        for i, j in slices(off):
            values, size = shingle_sets(data[off[i]:off[j]], off[i:j + 1] - off[i])
            keys = half_keys(values, size)
            some = size > 0
            node = np.zeros(len(size), np.int64)
            if some.any():
                at = np.concatenate([[0], np.cumsum(size)[:-1]])[some]
                total = np.add.reduceat(mix(values + np.uint64(11)), at)
                node[some] = mix(total ^ mix(size[some].astype(np.uint64))).view(np.int64)
            lists = np.where(some, 2 * ROWS, 0)
            halves = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lists)]), pa.int32()),
                                              pa.array(keys.view(np.int64).ravel(), pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").slice(i, j - i), b.column("tk").slice(i, j - i), pa.array(size, pa.int64()),
                 pa.array(node, pa.int64(), mask=~some), halves],
                names=["doc_id", "tk", "n_shingles", "node", "halves"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in in_turn(batches):
        data, off = buffers(b.column("text"))
        for i, j in slices(off):
            values, size = shingle_sets(data[off[i]:off[j]], off[i:j + 1] - off[i])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()),
                                             pa.array(values.view(np.int64), pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column("node").slice(i, j - i), lists], names=["node", "shingles"])


def signatures(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> doc_id, tk (hash of the text), n_shingles, node (hash of the set, null if empty), halves."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", F.xxhash64("text").alias("tk")).mapInArrow(
        _signatures, f"doc_id {kind}, tk long, n_shingles long, node long, halves array<long>")


def _set_nodes(sig: DataFrame) -> DataFrame:
    """node, n, halves: one row for each distinct non-empty set."""
    return sig.where("node IS NOT NULL").groupBy("node").agg(
        F.max("n_shingles").alias("n"), F.first("halves").alias("halves"))


def diagonal_keys(nodes: DataFrame) -> DataFrame:
    """node, n, comp, key of the tables that pair half-key i with half-key i."""
    keys = F.array(*[F.xxhash64(F.lit(i), F.get("halves", F.lit(i)), F.get("halves", F.lit(i + ROWS))) for i in range(ROWS)])
    keys = nodes.select("node", "n", F.col("node").alias("comp"), F.explode(keys).alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    return keys.join(shared, "key", "left_semi")


def table_keys(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """node, n, comp, key: the keys of all tables that two components share."""
    x = nodes.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    halves = x.select("node", "n", "comp", F.posexplode("halves").alias("i", "h"))
    live = (halves.groupBy("i", "h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
            .where("lo <> hi").select("i", "h"))
    mine = (halves.join(live, ["i", "h"], "left_semi").groupBy("node", "n", "comp")
            .agg(F.collect_list(F.struct("i", "h")).alias("l")))        # 24 entries at most
    left = F.filter("l", lambda x: x["i"] < ROWS)
    right = F.filter("l", lambda x: x["i"] >= ROWS)
    both = mine.select("node", "n", "comp", F.explode(left).alias("x"), right.alias("r")).select(
        "node", "n", "comp", "x", F.explode("r").alias("y"))
    return _several(both.select("node", "n", "comp", F.xxhash64("x.i", "x.h", "y.i", "y.h").alias("key")))


def _several(keys: DataFrame) -> DataFrame:
    """The rows of buckets that hold several components."""
    open_ = keys.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    return keys.join(open_.select("key"), "key", "left_semi")


def _candidates(keys: DataFrame, salt: int) -> DataFrame:
    """Pairs (a, b) of each bucket's representative and its members of other components."""
    if salt < 2:        # the member whose buckets are the fullest
        size = keys.groupBy("key").agg(F.count("*").alias("c"))
        rank = keys.join(size, "key").groupBy("node").agg(F.sum("c").alias("rank"))
        keys = keys.join(rank, "node")
    else:
        keys = keys.withColumn("rank", F.xxhash64(F.lit(salt), "node"))
    rep = keys.groupBy("key").agg(F.max(F.struct("rank", "node", "n", "comp")).alias("r")).select(
        "key", F.col("r.node").alias("rep"), F.col("r.n").alias("rep_n"), F.col("r.comp").alias("rep_comp"))
    x = keys.join(rep, "key").where("comp <> rep_comp")
    x = x.where(4 * F.least("n", "rep_n") >= 3 * F.greatest("n", "rep_n"))     # else J < 0.75
    return x.select(F.least("node", "rep").alias("a"), F.greatest("node", "rep").alias("b")).distinct()


def prefixes(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """nodes (node, n, comp) -> node, n, comp, s, at: the shingles of each prefix that other components have, and their places."""
    each = materialise(sets.join(nodes, "node").select("node", "n", "comp", F.explode("shingles").alias("s")), "shingles")
    shared = each.groupBy("s").agg(F.count("*").alias("df"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    shared = shared.where("lo <> hi").select("s", "df")
    # parities of the shared shingles by hash: two sets differ in at least as many shingles as in parities
    h = F.xxhash64(F.lit(17), "s")
    bit = F.expr("shiftleft(1L, cast(shiftright(xxhash64(17, s), 8) & 63 as int))")
    parity = [F.coalesce(F.bit_xor(F.when(F.pmod(h, F.lit(PARITY_WORDS)) == w, bit)), F.lit(0).cast("long")) for w in range(PARITY_WORDS)]
    mine = each.join(shared, "s").groupBy("node", "n", "comp").agg(
        F.sort_array(F.collect_list(F.struct("df", "s"))).alias("l"), F.array(*parity).alias("parity"))
    mine = mine.withColumn("own", F.col("n") - F.size("l"))         # only in this component: first in the order
    mine = mine.withColumn("left", F.floor(F.col("n") / 4) + 1 - F.col("own")).where("left > 0")
    return mine.select("node", "n", "comp", "own", "parity", F.posexplode(F.slice("l", 1, F.col("left").cast("int"))).alias("i", "e")).select(
        "node", "n", "comp", "parity", F.col("own").alias("alone"), F.col("e.s").alias("s"), (F.col("own") + F.col("i")).alias("at"))


def rest_pairs(nodes: DataFrame, sets: DataFrame, block: int = BLOCK) -> DataFrame:
    """Pairs (a, b) of all nodes (node, n, comp) of different components that may be at 0.75."""
    x = materialise(prefixes(nodes, sets), "prefixes")
    met = x.groupBy("s").agg(F.count("*").alias("c"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    x = x.join(met.select("s", F.ceil(F.col("c") / block).alias("blocks")), "s")
    x = x.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
    one = x.select("s", F.col("node").alias("a"), F.col("n").alias("na"), F.col("comp").alias("ca"), F.col("at").alias("ia"),
                   F.col("parity").alias("pa"), F.col("alone").alias("oa"), F.col("own").alias("p"), F.explode(F.sequence("own", F.col("blocks") - 1)).alias("q"))
    two = x.select("s", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("comp").alias("cb"), F.col("at").alias("ib"),
                   F.col("parity").alias("pb"), F.col("alone").alias("ob"), F.explode(F.sequence(F.lit(0).cast("long"), "own")).alias("p"), F.col("own").alias("q"))
    most = F.least(F.col("na") - F.col("ia"), F.col("nb") - F.col("ib"))     # in common from their first common shingle on
    one, two = one.alias("one"), two.alias("two")
    same = [F.col(f"one.{k}") == F.col(f"two.{k}") for k in ("s", "p", "q")]
    # sets at 0.75 differ in a seventh of their sizes at most; shingles of one component only are differences too
    apart = F.col("oa") + F.col("ob")
    for w in range(PARITY_WORDS):
        apart = apart + F.bit_count(F.get("pa", F.lit(w)).bitwiseXOR(F.get("pb", F.lit(w))))
    may = (F.col("ca") != F.col("cb")) & (7 * apart <= F.col("na") + F.col("nb")) & (7 * most >= 3 * (F.col("na") + F.col("nb"))) & ((F.col("one.p") != F.col("one.q")) | (F.col("a") < F.col("b")))
    return one.join(two, [*same, may]).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    x = pairs.join(a, "a").join(b, "b")
    common = F.size(F.array_intersect("sa", "sb")).cast("long")
    union = F.size("sa").cast("long") + F.size("sb").cast("long") - common
    return x.where(100 * common >= 75 * union).select("a", "b")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def _sets_of(docs: DataFrame, sig: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, shingles of the wanted nodes, from one document of each."""
    chosen = (sig.where("node IS NOT NULL").groupBy("node").agg(F.min(F.struct("doc_id", "tk")).alias("c"))
              .join(wanted, "node", "left_semi")).select("node", "c.*").alias("c")
    d = docs.select("doc_id", "text", F.xxhash64("text").alias("tk")).alias("d")
    texts = d.join(chosen, F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("d.tk") == F.col("c.tk")))
    return texts.select("node", "text").mapInArrow(_sets, "node long, shingles array<long>")


def near_components(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> doc_id, tk (xxhash64 of the text), n_shingles, comp (null: no set)."""
    sig = materialise(signatures(docs), "signatures")
    nodes = materialise(_set_nodes(sig), "nodes")
    diagonal = materialise(diagonal_keys(nodes), "diagonal")
    pairs = materialise(_candidates(diagonal, 0), "pairs")
    links = materialise(_verified(pairs, _sets_of(docs, sig, _ends(pairs))), "links")
    labels = components(links)
    keys = materialise(table_keys(nodes, labels), "keys")
    sets = materialise(_sets_of(docs, sig, keys.select("node").distinct()), "sets")
    tested, salt = pairs, 1
    while True:
        pairs = materialise(_candidates(keys, salt).join(tested, ["a", "b"], "left_anti"), "pairs")
        new = materialise(_verified(pairs, sets), "links")
        n_new = new.count()
        few = 100 * n_new < links.count() or not n_new
        if n_new:
            tested, links = tested.unionByName(pairs), links.unionByName(new)
            labels = components(links)
            keys = keys.drop("comp").join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
            keys = materialise(_several(keys), "keys")
        if few:         # the last pass decides all that is left
            break
        salt += 1
    rest = materialise(keys.select("node", "n", "comp").distinct(), "open")
    pairs = materialise(rest_pairs(rest, sets).join(tested, ["a", "b"], "left_anti"), "pairs")
    new = materialise(_verified(pairs, sets), "links")
    if not new.isEmpty():
        labels = components(links.unionByName(new))
    x = sig.select("doc_id", "tk", "n_shingles", "node").join(labels, "node", "left")
    return x.select("doc_id", "tk", "n_shingles", F.coalesce("comp", "node").alias("comp"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> doc_id, tk (xxhash64 of the text), n_shingles, component_id, kept."""
    x = near_components(docs)
    first = x.where("comp IS NOT NULL").groupBy("comp").agg(F.min("doc_id").alias("first"))
    x = x.join(first, "comp", "left")
    own = F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("first"))
    return x.select("doc_id", "tk", "n_shingles", own.alias("component_id"),
                    F.col("doc_id").eqNullSafe(own).alias("kept"))


SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                          ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s FROM w),
n AS (SELECT doc_id, len(s)::BIGINT AS n FROM s),
g AS (SELECT doc_id, hash(unnest(s)) AS h FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (WITH RECURSIVE t(id, m) AS (SELECT a, a FROM e UNION SELECT e.b, t.m FROM t JOIN e ON e.a = t.id WHERE t.m < e.b)
      SELECT id, min(m) AS m FROM t GROUP BY id)
SELECT n.doc_id, n.n AS n_shingles, least(n.doc_id, coalesce(m, n.doc_id)) AS component_id,
       n.doc_id = least(n.doc_id, coalesce(m, n.doc_id)) AS kept
FROM n LEFT JOIN r ON r.id = n.doc_id
"""


@query("op4_near_dedup", SQL)
def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, whole texts."""
    return near_duplicates(table(spark, sf_dir, "documents")).drop("tk")
