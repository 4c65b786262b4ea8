"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwright.sources.scratch import saved


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in links (a, b): root is the smallest node that can be reached.

    In each round a node takes the smallest label of its neighbours and itself, and then that label's own label, so a chain is
    halved by each round. Labels are written to the shared folder between rounds. Links may repeat and run either way;
    those with a null end are left out.
    """
    both = links.select("a", "b").union(links.select("b", "a")).dropna()
    both = saved(both.distinct())
    labels = saved(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("root")))
    while True:
        seen = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("seen"))
        near = labels.join(seen, "node").select("node", F.col("root").alias("was"), F.least("root", "seen").alias("near"))
        far = labels.select(F.col("node").alias("near"), F.col("root").alias("far"))
        labels = saved(near.join(far, "near").select("node", "was", F.least("near", "far").alias("root")))
        if labels.filter("root <> was").isEmpty():
            return labels.select("node", "root")
