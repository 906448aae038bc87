"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordcheck.sources.storage import scratch_table


def components(edges: DataFrame) -> DataFrame:
    """(a, b) -> (node, comp): comp is the smallest node reachable.  Labels go to
    neighbours and then to their label's label (so long chains halve), round
    after round until nothing changes; every round is a stored table.  Partial
    aggregation carries a hub with very many edges."""
    spark = edges.sparkSession
    both = scratch_table(spark, edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct(), "cc-edges")
    labels = scratch_table(spark, both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.min("a")).alias("comp")), "cc-labels")
    while True:
        near = (both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("n_node"))
                .agg(F.min("comp").alias("near")))
        step = (labels.join(near, F.col("node") == F.col("n_node"))
                .select("node", F.col("comp").alias("was"), F.least("comp", "near").alias("comp")))
        up = labels.select(F.col("node").alias("u_node"), F.col("comp").alias("up"))
        stepped = scratch_table(spark, step.join(up, F.col("comp") == F.col("u_node"), "left").select(
            "node", "was", F.least("comp", F.coalesce("up", "comp")).alias("comp")), "cc-labels")
        changed = stepped.filter("comp <> was").limit(1).count()
        labels = stepped.select("node", "comp")
        if not changed:
            return labels
