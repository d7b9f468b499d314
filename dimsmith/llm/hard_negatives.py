"""Hard-negative mining by slot-decomposed selection.

An anchor's positives are its nearest rows of the same label.  Each positive
opens a window of scores for its negatives, from ``low`` to ``high`` per cent of
its own score; the windows of one anchor overlap.  Their upper limits split the
scores into disjoint slots (slot 0: between the two highest limits, and so on).
Every block of rows keeps the best ``k`` of each slot, partial results are
combined slot by slot, and a positive's negatives are the first ``k`` of its own
slot and those below it (a suffix of the slots, read in descending order), cut
at its lower limit.  One pass over the rows thus answers all windows.

Scores are exact integer inner products: components become floor(scale * x).
Matrix products run in float64 while they are exact there, else in int64.

Scale: rows and anchors are dealt to blocks of bounded size by (length of the
vector, label, hash); each block of rows meets each block of anchors once, in a
join on the block's number, and never a whole label or the whole table in one
task.  Positives come from blocks that hold the anchor's label only.  What a
pair of blocks returns is bounded by anchors x slots x k; the best k are taken
by a window whose limit Spark applies before the shuffle too.

Defined results: rows with a null label, vector or component, or one that is
not finite, take no part, nor do rows whose integers' squares sum to 2^62 or
more (their scores need not fit a long); rows equal in id, label and vector
count once; a row's others are those of another id; rows that share an id with
different vectors are separate rows; a null id comes last in ties; vectors of
different lengths do not meet; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimsmith.llm.registry import materialise, query, table

BLOCK_BYTES = 1 << 20
BLOCK_ROWS = 4096
ANCHOR_ROWS = 2048
CHUNK = 1 << 21          # scores held at once
_EXACT = float(1 << 53)
_ROW = "array<struct<vec_id:bigint,label:bigint,q:array<int>>>"


def integer_rows(rows: DataFrame, anchor: Column, scale: int = 256) -> DataFrame:
    """rows (vec_id, label, vec) -> distinct vec_id, label, q (floor(scale * x)), dim, is_anchor."""
    whole = F.transform("vec", lambda x: F.floor(x.cast("double") * scale))
    sound = (F.col("label").isNotNull() & F.col("vec").isNotNull()
             & ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
             & (F.aggregate(whole, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")) < float(1 << 62)))
    x = rows.where(F.coalesce(sound, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.transform(whole, lambda x: x.cast("int")).alias("q"), F.coalesce(anchor, F.lit(False)).alias("is_anchor"))
    return x.dropDuplicates(["vec_id", "label", "q"]).withColumn("dim", F.size("q"))


def _blocks(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(blocks of rows, blocks of anchors): id, dim, cell, pure, and the members ``m``.

    A label with more than a block of rows is a cell of its own (``pure``), dealt
    to as many blocks as it needs; smaller labels share cells by a hash.
    """
    most = F.greatest(F.lit(64), F.least(F.lit(BLOCK_ROWS), F.floor(F.lit(BLOCK_BYTES) / (F.col("dim") * 4 + 32)))).cast("long")
    labels = rows.groupBy("dim", "label").agg(F.count("*").alias("rows"), F.count_if("is_anchor").alias("anchors"))
    labels = labels.withColumn("most", most).withColumn("pure", F.col("rows") >= F.col("most"))
    rest = labels.where("NOT pure").groupBy("dim").agg(F.sum("rows").alias("rest"))
    labels = labels.join(rest, "dim", "left")
    shared = F.pmod(F.xxhash64("label"), F.ceil(F.coalesce("rest", F.lit(1)) / F.col("most")))
    cells = materialise(labels.select(
        "dim", "label", "pure", F.when(F.col("pure"), F.col("label")).otherwise(shared).alias("cell"),
        F.when(F.col("pure"), F.ceil(F.col("rows") / F.col("most"))).otherwise(1).alias("parts"),
        F.when(F.col("pure"), F.ceil(F.greatest("anchors", F.lit(1)) / ANCHOR_ROWS)).otherwise(1).alias("anchor_parts")), "negatives-cells")
    x = rows.join(cells, ["dim", "label"])

    def deal(x, parts, name):
        part = F.pmod(F.xxhash64("vec_id", "q"), F.col(parts))
        m = x.groupBy("dim", "pure", "cell", part.alias("part")).agg(F.collect_list(F.struct("vec_id", "label", "q")).alias("m"))
        return materialise(m.select(F.monotonically_increasing_id().alias("id"), "dim", "pure", "cell",
                                    F.col("m").cast(_ROW).alias("m")), name)
    return deal(x, "parts", "negatives-rows"), deal(x.where("is_anchor"), "anchor_parts", "negatives-anchors")


def _members(col: pa.Array, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, null ids, labels, integer matrix) of a block, in the order it is stored."""
    m = col[row].values
    ids, q = m.field("vec_id"), m.field("q")
    none = ids.is_null().to_numpy(zero_copy_only=False)
    flat = q.flatten().to_numpy(zero_copy_only=False)
    return (ids.fill_null(0).to_numpy(zero_copy_only=False), none, m.field("label").to_numpy(zero_copy_only=False),
            flat.reshape(len(m), len(flat) // max(len(m), 1)))


def _scored(b: pa.RecordBatch, row: int):
    """Chunks (first anchor, scores, order-preserving keys or None) of a pair of blocks, and its rows sorted by id."""
    a_ids, a_none, a_label, a_q = _members(b.column("anchors"), row)
    r_ids, r_none, r_label, r_q = _members(b.column("rows"), row)
    order = np.lexsort((r_ids, r_none))
    r_ids, r_none, r_label, r_q = r_ids[order], r_none[order], r_label[order], r_q[order]
    norm = [np.sqrt((x.astype(np.float64) ** 2).sum(1)).max(initial=1.0) for x in (a_q, r_q)]
    exact = norm[0] * norm[1] * (len(r_ids) + 1) * 1.01 < _EXACT
    kind = np.float64 if exact else np.int64
    r_t = np.ascontiguousarray(r_q.T).astype(kind)
    step = max(1, CHUNK // max(len(r_ids), 1))

    def chunks():
        for i in range(0, len(a_ids), step):
            j = min(i + step, len(a_ids))
            other = (a_ids[i:j, None] != r_ids) | (a_none[i:j, None] != r_none)
            yield i, a_q[i:j].astype(kind) @ r_t, other, a_label[i:j, None] == r_label
    return (a_ids, a_none), (r_ids, r_none), chunks()


def _best(score: np.ndarray, where: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, row) of the k highest scores of each line among ``where``; the earlier row of equals."""
    n = score.shape[1]
    if score.dtype == np.int64:       # no room for the place in the key
        line, at = np.nonzero(where)
        order = np.lexsort((at, -score[line, at], line))
        line, at = line[order], at[order]
        first = np.searchsorted(line, line, side="left")
        keep = np.arange(len(line)) - first < k
        return line[keep], at[keep]
    key = np.where(where, score * n + np.arange(n - 1, -1, -1), -np.inf)
    at = np.argpartition(key, n - k, axis=1)[:, n - k:] if n > k else np.broadcast_to(np.arange(n), score.shape)
    line, place = np.nonzero(np.take_along_axis(where, at, 1))
    return line, at[line, place]


def _ids(ids: np.ndarray, none: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.array(ids[at], pa.int64(), mask=none[at])


def _positives(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                mine, theirs, chunks = _scored(b, row)
                for i, score, other, same in chunks:
                    line, at = _best(score, other & same, k)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(line), b.column("aid")[row].as_py())), pa.array(line + i, pa.int64()),
                         _ids(*mine, line + i), _ids(*theirs, at), pa.array(score[line, at].astype(np.int64))],
                        names=["aid", "place", "anchor_id", "positive_id", "positive_score"])
    return run


def _slots(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                _, theirs, chunks = _scored(b, row)
                limits = {}
                for anchor in b.column("windows")[row].as_py():
                    slots = {w["slot"]: (w["most"], w["least"]) for w in anchor["limits"]}
                    limits[anchor["place"]] = np.array([slots[i] for i in sorted(slots, reverse=True)], np.int64).T   # ascending
                out = []
                for i, score, other, same in chunks:
                    for line in range(len(score)):
                        if line + i not in limits:
                            continue
                        top, bottom = limits[line + i]
                        s = score[line]
                        at = np.flatnonzero(other[line] & ~same[line] & (s <= top[-1]) & (s >= bottom[0]))
                        at = at[np.argsort(-s[at], kind="stable")]          # rows stand in the order of ids
                        mine = np.searchsorted(top, s[at], side="left")      # the lowest limit not below the score
                        enough = s[at] >= bottom[mine]
                        at, slot = at[enough], len(top) - 1 - mine[enough]
                        best = np.arange(len(at)) - np.searchsorted(slot, slot, side="left") < k
                        out.append((np.full(int(best.sum()), line + i), slot[best], at[best], s[at[best]].astype(np.int64)))
                if out:
                    place, slot, at, s = (np.concatenate(x) for x in zip(*out, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(place), b.column("aid")[row].as_py())), pa.array(place, pa.int64()),
                         pa.array(slot, pa.int64()), _ids(*theirs, at), pa.array(s)],
                        names=["aid", "place", "slot", "negative_id", "negative_score"])
    return run


def _met(anchors: DataFrame, rows: DataFrame, on: Column, tasks: int) -> DataFrame:
    """Each pair of blocks that ``on`` allows, once: (aid, anchors, rows, ...)."""
    a, r = anchors.withColumnsRenamed({"m": "anchors", "id": "aid"}), rows.withColumnsRenamed({"m": "rows", "id": "rid"})
    pairs = a.select("aid", "dim", "pure", "cell").alias("a").join(
        r.select("rid", "dim", "pure", "cell").alias("r"), on).select("aid", "rid")
    pairs = pairs.repartition(tasks, "rid", "aid")
    return pairs.join(a.drop("dim", "pure", "cell"), "aid").join(r.select("rid", "rows"), "rid").drop("rid")


def mine_negatives(rows: DataFrame, anchor: Column, n_positives: int = 5, k: int = 3, low: int = 50, high: int = 95,
                   scale: int = 256) -> DataFrame:
    """rows (vec_id, label, vec) -> anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` says which rows are anchors; ``low`` and ``high`` are per cent of
    the positive's score.
    """
    spark = rows.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows, anchors = _blocks(materialise(integer_rows(rows, anchor, scale), "negatives"))
    same_dim = F.col("a.dim") == F.col("r.dim")
    same_cell = same_dim & (F.col("a.pure") == F.col("r.pure")) & (F.col("a.cell") == F.col("r.cell"))

    found = _met(anchors, rows, same_cell, tasks).mapInArrow(
        _positives(n_positives), "aid long, place long, anchor_id long, positive_id long, positive_score long")
    mine = Window.partitionBy("aid", "place")
    nth = F.row_number().over(mine.orderBy(F.desc("positive_score"), F.col("positive_id").asc_nulls_last()))
    positives = found.withColumn("nth", nth).where(F.col("nth") <= n_positives)
    # limits without products that could overflow; a negative score has no window
    limit = "positive_score div 100 * {0} + (positive_score % 100 * {0} + {1}) div 100"
    positives = positives.where("positive_score >= 0").select(
        "aid", "place", "anchor_id", "positive_id", "positive_score",
        F.expr(limit.format(low, 99)).alias("least"), F.expr(limit.format(high, 0)).alias("most")).where("least <= most")
    positives = materialise(positives.withColumn(
        "slot", F.dense_rank().over(mine.orderBy(F.desc("most"))) - 1), "negatives-positives")

    # the anchors' windows travel with their block: n_positives at most an anchor
    windows = positives.groupBy("aid", "place", "slot", "most").agg(F.min("least").alias("least"))
    windows = windows.groupBy("aid", "place").agg(F.collect_list(F.struct("slot", "least", "most")).alias("limits"))
    windows = windows.groupBy("aid").agg(F.collect_list(F.struct("place", "limits")).alias("windows"))
    asked = materialise(anchors.join(windows.withColumnRenamed("aid", "id"), "id"), "negatives-windows")
    other_label = same_dim & ~(F.col("a.pure") & F.col("r.pure") & (F.col("a.cell") == F.col("r.cell")))
    found = _met(asked, rows, other_label, tasks).mapInArrow(
        _slots(k), "aid long, place long, slot long, negative_id long, negative_score long")
    best = Window.partitionBy("aid", "place", "slot").orderBy(F.desc("negative_score"), F.col("negative_id").asc_nulls_last())
    slots = found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k)
    slots = slots.groupBy("aid", "place").agg(
        F.array_sort(F.collect_list(F.struct(F.col("slot").alias("in"), "nth", "negative_id", "negative_score"))).alias("slots"))

    # a positive's suffix: its own slot and those below, in order; the first k of them, cut at its lower limit
    suffix = F.slice(F.filter("slots", lambda s: s["in"] >= F.col("slot")), 1, k)
    x = positives.join(slots, ["aid", "place"]).withColumn(
        "taken", F.filter(suffix, lambda s: s["negative_score"] >= F.col("least")))
    return x.select("anchor_id", "positive_id", "positive_score", F.posexplode("taken").alias("rank", "n")).select(
        "anchor_id", "positive_id", (F.col("rank") + 1).alias("rank"), "n.negative_id", "positive_score", "n.negative_score")


SQL = """
WITH r AS (SELECT DISTINCT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
      FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id IS DISTINCT FROM b.vec_id AND len(a.q) = len(b.q)),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 3
"""


@query("op12_hard_negatives", SQL)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings; every 50th id is an anchor, and every 7th id has its label moved on by one."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").alias("vec"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)
