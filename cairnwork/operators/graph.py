"""Connected components over an edge table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnwork.plans.storage import cut


def components(edges: DataFrame, left: str, right: str, max_rounds: int = 60) -> DataFrame:
    """(node, root): root is the smallest node that can be reached; every end of an edge has a row.

    Each round hooks every node to the least label around it and then halves the label chains, so
    the rounds grow with the logarithm of the longest chain. Null ends are ignored, loops keep their
    node, an empty edge table gives an empty result.
    """
    pairs = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    both = cut(pairs.union(pairs.select("v", "u")).distinct(), "edges")
    labels = both.groupBy(F.col("u").alias("node")).agg(F.min(F.least("u", "v")).alias("root"))
    labels = cut(labels, "labels")
    for _ in range(max_rounds):
        near = both.join(labels.withColumnRenamed("node", "v"), "v").groupBy(F.col("u").alias("node")).agg(F.min("root").alias("near"))
        hooked = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        above = labels.select(F.col("node").alias("root"), F.col("root").alias("above"))
        now = cut(hooked.join(above, "root").select("node", "old", F.least("root", "above").alias("root")), "labels")
        if now.where("root <> old").isEmpty():
            return now.select("node", "root")
        labels = now.select("node", "root")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
