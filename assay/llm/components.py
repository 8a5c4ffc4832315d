"""Connected components of large edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.session import settle


def connected(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for every node of edges (a, b): root is the least node that links reach.

    Large and small stars by turns: every node hands its larger neighbours, then its smaller ones, to the
    least node it knows, until nothing changes. Each turn is an aggregate and a join on the node,
    written to the shared folder; hot nodes are split by adaptive execution, and edges never grow.
    """
    pairs = lambda df: settle(df.where("a <> b").distinct(), label)
    edges = pairs(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = pairs(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = pairs(small.unionByName(least.select("a", F.col("m").alias("b"))))
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
