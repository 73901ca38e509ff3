"""Connected components of links, in Spark steps only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import cut_lineage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that each linked node reaches.

    Rounds of label propagation with path halving.  Every node points at the
    smallest label seen; a round offers each end of a link the other's label
    and each label its own label's label, and takes minima.  Grouped minima are
    combined before the shuffle, the link table never grows, and every round is
    a stored table, so lineage stays flat and a lost executor loses nothing."""
    both = links.select(F.col(a).alias("node"), F.col(b).alias("other")).unionByName(links.select(F.col(b).alias("node"), F.col(a).alias("other")))
    both = cut_lineage(both.where("node <> other").distinct(), "component-links")
    label = cut_lineage(both.groupBy("node").agg(F.least("node", F.min("other")).alias("component")), "component-labels")
    while True:
        over_links = both.join(label.select(F.col("node").alias("other"), "component"), "other").select("node", "component")
        above = label.select(F.col("node").alias("component"), F.col("component").alias("top"))
        halved = label.join(above, "component").select("node", "top")
        # what a node learns, its old label learns too: whole trees hook on at once
        taught = (both.join(label.select(F.col("node").alias("other"), F.col("component").alias("there")), "other")
                      .join(label, "node").select(F.col("component").alias("node"), F.col("there").alias("component")))
        new = over_links.unionByName(halved.withColumnRenamed("top", "component")).unionByName(taught)
        new = cut_lineage(new.groupBy("node").agg(F.least("node", F.min("component")).alias("component")), "component-labels")
        moved = new.join(label.withColumnRenamed("component", "old"), "node").where("component <> old").limit(1).count()
        label = new
        if not moved:
            return label
