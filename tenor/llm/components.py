"""Connected components of a link table (distributed, stored every round)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenor.llm.blocks import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, comp): the smallest id reachable, for every id in ``links``. Each round takes the
    smallest label among a node's neighbours, then follows labels once (pointer
    jumping); it ends when no label changes. Hubs meet partial minima only."""
    both = links.select(F.col(a).alias("id"), F.col(b).alias("other")).unionByName(
        links.select(F.col(b).alias("id"), F.col(a).alias("other")))
    edges = stored(both.distinct(), "edges")
    labels = stored(edges.groupBy("id").agg(F.least("id", F.min("other")).alias("comp")), "labels")
    while True:
        near = (edges.join(labels.select(F.col("id").alias("other"), "comp"), "other")
                .groupBy("id").agg(F.min("comp").alias("near")))
        moved = labels.join(near, "id").select("id", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        jump = moved.alias("m").join(labels.select(F.col("id").alias("comp"), F.col("comp").alias("up")), "comp")
        new = stored(jump.select("id", "old", F.least("comp", "up").alias("comp")), "labels")
        changed = new.where(F.col("old") != F.col("comp")).limit(1).count()
        labels = new.select("id", "comp")
        if not changed:
            return labels
