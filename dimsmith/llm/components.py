"""Connected components of a graph of links, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimsmith.llm.registry import materialise


def components(links: DataFrame) -> DataFrame:
    """links (a long, b long) -> node, comp (the smallest node that it reaches).

    Each round every node takes the smallest label among its neighbours and
    then its label's label (pointer jumping), so stars end in two rounds and
    long chains in a logarithmic number.  A node with very many links is a
    grouping key with map-side combine and a join side that adaptive execution
    splits.  Every round is written to the shared folder.
    """
    both = links.select("a", "b").where("a <> b")
    both = materialise(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_m"))
    labels = materialise(labels.select("node", F.least("node", "_m").alias("comp")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), F.col("comp").alias("_c")), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("_c").alias("_m")))
        step = labels.join(near, "node").select("node", "comp", F.least("comp", "_m").alias("_n"))
        jump = labels.select(F.col("node").alias("_n"), F.col("comp").alias("_nn"))
        step = step.join(jump, "_n", "left").select(
            "node", F.least("_n", F.coalesce("_nn", "_n")).alias("comp"),
            (F.least("_n", F.coalesce("_nn", "_n")) < F.col("comp")).alias("_moved"))
        step = materialise(step, "labels")
        labels = step.select("node", "comp")
        if step.where("_moved").isEmpty():
            return labels
