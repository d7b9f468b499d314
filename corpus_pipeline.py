"""A corpus pipeline of five stages, each one operator of ``dimsmith.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's documents; all but the last
return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimsmith.llm.decontaminate import contamination
from dimsmith.llm.language_id import UNKNOWN, predict, train_on
from dimsmith.llm.mix_sources import mixed_texts
from dimsmith.llm.near_dedup import near_components
from dimsmith.llm.registry import materialise, table
from dimsmith.llm.token_store import token_index

#: share of a text's n-grams that its language has to know
LEAST_SCORE = 0.1


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: null, no letter, or fewer than LEAST_SCORE of the n-grams known in
    the best language.  A null lang becomes the predicted one.  The model learns from docs' own labels."""
    model = train_on(docs.select("doc_id", "text", "lang"))
    marked = predict(docs, model, tuple(docs.columns), ("__lang", "__score"))
    some = marked.where((F.col("__lang") != UNKNOWN) & (F.col("__score") >= LEAST_SCORE))
    return some.select(*[F.coalesce("lang", "__lang").alias("lang") if c == "lang" else F.col(f"`{c}`") for c in docs.columns])


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (of rows equal in id and text, one)."""
    x = near_components(docs).groupBy("comp", "doc_id", "tk").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "tk", "n")).alias("c")     # an id before null, then the smallest text hash
    one = x.where("comp IS NOT NULL").groupBy("comp").agg(first).select("c.doc_id", "c.tk", "c.n")
    kept = one.unionByName(x.where("comp IS NULL").select("doc_id", "tk", "n"))            # no words: a group of its own
    v = materialise(kept.withColumnsRenamed({"doc_id": "__stage_id", "tk": "__stage_tk", "n": "__stage_n"}), "verdict")
    same = F.col("doc_id").eqNullSafe(F.col("__stage_id")) & (F.xxhash64("text") == F.col("__stage_tk"))
    once = docs.join(v.where("__stage_n = 1"), same, "left_semi")
    again = docs.join(v.where("__stage_n > 1"), same).dropDuplicates(["__stage_id", "__stage_tk"])
    return once.unionByName(again.select(*[F.col(f"`{c}`") for c in docs.columns]))


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    # exact windows decide here, so that only the rarest term of each is indexed
    hit = contamination(docs, table(spark, sf_dir, "benchmark"), near_share=1.0).where("n_hit > 0")
    v = materialise(hit.select(F.col("doc_id").alias("__stage_id"), F.col("tk").alias("__stage_tk")).distinct(), "verdict")
    same = F.col("doc_id").eqNullSafe(F.col("__stage_id")) & (F.xxhash64("text") == F.col("__stage_tk"))
    return docs.join(v, same, "left_anti")


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights, in order of virtual finish time."""
    return mixed_texts(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left and their index, read back."""
    return token_index(docs)


STAGES = [
    ("language_id", language_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("mix_sources", mix_stage),
    ("token_store", token_stage),
]

#: language models, tokenisers and verified MinHash links have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
