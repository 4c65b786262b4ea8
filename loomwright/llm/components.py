"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import BROADCAST_BYTES, free, saved


def components(links: DataFrame, most_broadcast: int = BROADCAST_BYTES // 48) -> DataFrame:
    """(node, root) of every node in links (a, b): root is the smallest node reachable.

    Each round every node takes the smallest label among its neighbours' and its own, then the label of that label,
    so labels travel twice as far in each round. Rounds end when no label changes. Every round's labels are
    written to the shared folder, and broadcast if they are at most most_broadcast (48 bytes each). Links may repeat, run either way, or join a node to itself; an empty table
    gives no rows. Links with a null end are ignored.
    """
    both = links.select("a", "b").union(links.select("b", "a")).filter("a IS NOT NULL AND b IS NOT NULL").distinct()
    both = saved(both)
    labels = saved(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")))
    # Broadcast, no node's links need to come together before they are combined.
    few = labels.count() <= most_broadcast
    near_by = F.broadcast if few else lambda df: df
    while True:
        offered = both.join(near_by(labels.select(F.col("node").alias("b"), "root")), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("offer"))
        nearer = labels.select("node", "root").join(offered, "node").select("node", F.col("root").alias("was"), F.least("root", "offer").alias("near"))
        jump = labels.select(F.col("node").alias("near"), F.col("root").alias("far"))
        step = saved(nearer.join(near_by(jump), "near", "left").select("node", "was", F.least("near", "far").alias("root")))
        changed = step.filter("root <> was").limit(1).count()
        free(labels)
        labels = step
        if not changed:
            free(both)
            return labels.select("node", "root")
