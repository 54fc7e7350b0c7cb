"""Connected components of a table of links, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import crowded_keys, spread_join, stored


def connected_components(links: DataFrame) -> DataFrame:
    """``(v, c)`` for each end of the links ``(a, b)``: c is the smallest vertex of its component.

    Each round every vertex takes the smallest label among its neighbours, then the label of that label. Minima are
    combined before the shuffle. Links to a vertex with very many links, and vertices under a label that very many share, are not shuffled by it: such labels
    are few and broadcast. No links give no rows.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct(), "links")
    hubs = crowded_keys(both, "b")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("v"), F.least("a", "m").alias("c")), "labels")
    while True:
        seen = spread_join(both, labels.withColumnRenamed("v", "b"), "b", hubs).groupBy("a").agg(F.min("c").alias("m"))
        near = stored(labels.join(seen, labels.v == seen.a).select("v", F.col("c").alias("old"), F.least("c", "m").alias("c")), "near")
        if near.filter("c <> old").isEmpty():
            return labels
        root = labels.select(F.col("v").alias("c"), F.col("c").alias("up"))
        labels = stored(spread_join(near, root, "c").select("v", F.least("c", "up").alias("c")), "labels")
