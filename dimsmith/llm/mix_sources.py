"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are shuffled (by a hash of doc_id and seed) and queued;
a document's virtual finish time is the words its source has sent when it ends,
divided by the source's target weight.  Sorting all documents of all sources by
virtual finish time and cutting at the total budget mixes the sources in the
wanted proportions all along the output.  A source whose target is above its
size is queued again, pass by pass.

Targets are water-filled: the budget is shared by weight, a source's target
stops at ``max_passes`` times its size, and the excess is shared by weight
among the others until none is above.  The weights used in the queue are the
targets, so every source reaches its target at virtual time 1: the cut takes
whole documents and, of each source's document that crosses time 1, its first
words.  Each source's words are then within one of its target.

Scale: only (doc_id, source, size, hash) is shuffled.  A source's running sum is
taken in two levels, per hash bucket and then within it, so a source with a
third of all rows is spread over many tasks; the number of buckets follows the
number of rows.  The table of sources (one row each) meets in one task for the
water-filling, never the documents.

Defined results: a null text has no words; a null source is a source of its
own, last in code-point order; documents of size 0 and sources without words
take 0; rows that repeat a doc_id are separate documents (equal ones share
their shuffle place in any order, with equal results in sum); an empty table
gives an empty mix; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimsmith.llm.registry import materialise, query, table

SPACES = " \t\n\u000b\f\r"
BUCKET_ROWS = 50_000
SEED = "mix-1"


def word_list(text: Column) -> Column:
    """The runs of characters other than space and tab to carriage return."""
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, "[ \\t-\\r]+"))


def weigh_in_order(sizes: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0)) -> DataFrame:
    """Weights repeated over the sources in code-point order, null last."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (place % len(weights) + 1).cast("int"))
    return sizes.withColumn("weight", w)


def water_fill(sources: DataFrame, share: float = 1.5, max_passes: float = 2.0) -> DataFrame:
    """sources (source, source_size, weight) -> the same and target.

    Sources are capped in the order of size per weight; level is the words per
    weight that the uncapped ones get.  One row per source, in one task.
    """
    cap = F.col("source_size") * max_passes
    ratio = F.when(F.col("weight") > 0, cap / F.col("weight")).otherwise(F.lit(float("inf")))
    whole = Window.partitionBy(F.lit(0))
    before = Window.partitionBy(F.lit(0)).orderBy("_ratio", F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1)
    x = sources.withColumn("_cap", cap).withColumn("_ratio", ratio)
    x = (x.withColumn("_budget", F.least(F.sum("source_size").over(whole) * share, F.sum("_cap").over(whole)))
         .withColumn("_level", (F.col("_budget") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
                     / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))))
    # the first source whose cap is above the level sets the level of all that follow
    level = F.min(F.when(F.col("_ratio") > F.col("_level"), F.struct("_ratio", "_level"))).over(whole)["_level"]
    x = x.withColumn("_set", level)
    target = F.when(F.col("_set").isNull() | (F.col("_ratio") <= F.col("_set")), F.col("_cap"))
    return x.withColumn("target", target.otherwise(F.col("_set") * F.col("weight"))).select(
        "source", "source_size", "weight", "target")


def queue_times(docs: DataFrame, targets: DataFrame, seed: str = SEED,
                bucket_rows: int = BUCKET_ROWS, key: str | None = None) -> DataFrame:
    """docs (doc_id, source, size, ...) with source_size, target, and ``sent``:
    the words its source has sent in a pass when the document ends."""
    n = docs.count()
    buckets = max(1, min(1 << 24, -(-n // bucket_rows)))
    # id, size and ``key`` (of the text): rows without an id, or that share one, are spread too
    h = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("size").cast("string"),
                       F.lit(":"), F.col(key).cast("string") if key else F.lit("")))
    x = docs.withColumn("_h", h).withColumn(
        "_b", F.floor(F.conv(F.substr("_h", F.lit(1), F.lit(8)), 16, 10).cast("long") * buckets / (1 << 32)))
    sums = x.groupBy("source", "_b").agg(F.sum("size").alias("_n"))
    upto = Window.partitionBy("source").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_n").over(upto), F.lit(0)))
    s, t = sums.alias("s"), targets.alias("t")
    s = materialise(s.join(t, F.col("s.source").eqNullSafe(F.col("t.source"))).select(
        "s.source", "s._b", "s._before", "t.source_size", "t.target"), "mix-buckets").alias("s")
    x = x.alias("x").join(s, F.col("x.source").eqNullSafe(F.col("s.source")) & (F.col("x._b") == F.col("s._b")))
    x = x.select("x.*", "s._before", "s.source_size", "s.target")
    within = Window.partitionBy("source", "_b").orderBy("_h", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, 0)
    return x.withColumn("sent", F.col("_before") + F.sum("size").over(within)).drop("_h", "_b", "_before")


def mix(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5,
        max_passes: int = 2, seed: str = SEED, key: str | None = None) -> DataFrame:
    """docs (doc_id, source, size) -> doc_id, source, size, source_size, target, taken,
    and ``copies``: array of (pass, words, finish) in queue order, finish up to 1."""
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialise(water_fill(weigh_in_order(sizes, weights), share, max_passes), "mix-targets")
    x = queue_times(docs, targets, seed, key=key)
    budget = F.floor(F.col("target") + 1e-6)
    copies = []
    for p in range(max_passes):
        end = F.col("sent") + F.col("source_size") * p
        words = F.greatest(F.lit(0), F.least(F.col("size"), budget - (end - F.col("size"))))
        finish = F.when(F.col("target") > 0, F.least(end / F.col("target"), F.lit(1.0))).otherwise(F.lit(0.0))
        copies.append(F.struct(F.lit(p).alias("pass"), words.cast("long").alias("words"), finish.alias("finish")))
    x = x.withColumn("copies", F.filter(F.array(*copies), lambda c: c["words"] > 0))
    return x.withColumn("taken", F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + c["words"]))


def cut_queue(queue: DataFrame, order: list[str]) -> DataFrame:
    """queue (words, budget, ...) in the order of ``order``, with ``sent``: the words that fit the total budget.

    The budget is the same in all rows.  Rows are range-sorted and written, each
    partition's sum and the sums before it (one row a partition) say which
    partitions are sent whole; only the one in which the budget runs out is
    summed row by row.
    """
    q = materialise(queue.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "_place", F.monotonically_increasing_id()), "mix-queue")
    q = q.withColumn("_part", F.shiftright("_place", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = q.groupBy("_part").agg(F.sum("words").alias("_n")).select(
        "_part", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    x = q.join(F.broadcast(parts), "_part")
    left = F.col("budget") - F.col("_before")
    whole = x.where(left >= F.col("_n")).withColumn("sent", F.col("words"))
    none = x.where(left <= 0).where(left < F.col("_n")).withColumn("sent", F.lit(0).cast("long"))
    upto = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    some = x.where((left > 0) & (left < F.col("_n"))).withColumn("_upto", F.sum("words").over(upto)).withColumn(
        "sent", F.greatest(F.lit(0), F.least(F.col("words"), left - (F.col("_upto") - F.col("words"))))).drop("_upto")
    return whole.unionByName(none).unionByName(some).drop("_part", "_place", "_n", "_before")


def mixed_texts(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: documents' rows, each as often as it is taken, in order of virtual
    finish time (globally range-sorted); a cut copy has its first words, joined by single spaces.

    docs must have doc_id, text, source; its other columns are kept (rows equal in
    these three share one row's other columns).
    """
    own = docs.withColumn("__mix_size", F.size(word_list(F.col("text"))).cast("long")).withColumn(
        "__mix_k1", F.xxhash64("doc_id", "source", "text")).withColumn(
        "__mix_k2", F.xxhash64(F.lit(7), "text", "source", "doc_id"))
    plan = mix(materialise(own.select("doc_id", "source", F.col("__mix_size").alias("size"), "__mix_k1", "__mix_k2"), "mix-sizes"),
               key="__mix_k1", **options)
    keys = ["__mix_k1", "__mix_k2"]
    rows = plan.groupBy(*keys).agg(F.count("*").alias("__mix_n"), F.flatten(F.collect_list("copies")).alias("__mix_copies"))
    rows = materialise(rows.where(F.size("__mix_copies") > 0), "mix-plan")
    # rows equal in these columns are one key; only their texts need a shuffle to meet
    once = own.join(rows.where("__mix_n = 1"), keys)
    many = own.join(rows.where("__mix_n > 1"), keys).dropDuplicates(keys)
    x = once.unionByName(many).withColumn("__mix_c", F.explode("__mix_copies")).alias("d")
    words = F.col("__mix_c.words").cast("int")
    text = F.when(words >= F.col("__mix_size"), F.col("d.text")).otherwise(
        F.array_join(F.slice(word_list(F.col("d.text")), 1, words), " "))
    names = docs.columns
    x = x.select(*[text.alias(c) if c == "text" else F.col(f"d.`{c}`") for c in names],
                 F.col("__mix_c.finish").alias("__mix_finish"), F.col("__mix_c.pass").alias("__mix_pass"))
    return x.orderBy("__mix_finish", "doc_id", "__mix_pass").select(*names)


SQL = r"""
WITH d AS (SELECT doc_id, source,
                  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                  md5(coalesce(text, '')) AS text_key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight
      FROM d GROUP BY source),
r AS (SELECT *, 2.0 * source_size AS cap, 2.0 * source_size / weight AS ratio,
             sum(source_size) OVER () * 1.5::DOUBLE AS budget FROM s),
l AS (SELECT *, (budget - coalesce(sum(cap) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
      FROM r WINDOW b AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
z AS (SELECT arg_min(level, ratio) AS lv FROM l WHERE ratio > level),
t AS (SELECT source, source_size, CASE WHEN lv IS NULL OR ratio <= lv THEN cap ELSE lv * weight END AS target FROM l, z),
q AS (SELECT d.doc_id, d.size, source_size, target, floor(target + 1e-6)::BIGINT AS budget,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('mix-1' || coalesce(d.doc_id::VARCHAR, '') || ':' || d.size || ':' || text_key), d.doc_id, d.size
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS sent
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(size, budget - (sent - size)))
        + greatest(0, least(size, budget - (sent + source_size - size))))::BIGINT AS taken
FROM q
"""


@query("op2_mix_sources", SQL)
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; weights 5, 2, 1 over the sources, 150 % of all words, two passes at most."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", F.size(word_list(F.col("text"))).cast("long").alias("size"),
        F.md5(F.coalesce("text", F.lit(""))).alias("text_key"), F.monotonically_increasing_id().alias("row"))
    plan = mix(materialise(docs, "mix-sizes"), key="text_key")
    budget = plan.groupBy("source").agg(F.floor(F.max("target") + 1e-6).alias("n")).agg(F.sum("n")).first()[0]
    own = ["row", "doc_id", "size", "source_size", "target"]
    queue = plan.select(*own, "source", F.explode_outer("copies").alias("copy")).select(
        *own, "source", F.coalesce("copy.words", F.lit(0).cast("long")).alias("words"),
        F.coalesce("copy.finish", F.lit(2.0)).alias("finish"), F.lit(budget).cast("long").alias("budget"))
    out = cut_queue(queue, ["finish", "source", "row"]).groupBy(*own).agg(F.sum("sent").alias("taken"))
    return out.select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), "taken")
