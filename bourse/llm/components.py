"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourse.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node in ``edges`` (a, b: long); component
    is the smallest node reachable.

    Each round takes the smallest label among a node's neighbours and then
    that label's own label, so labels cross long chains in a logarithmic
    number of rounds. Labels are written to the shared folder after each
    round; nothing but the count of changes reaches the driver. Hub nodes
    are reduced map-side (min) and their joins are plain shuffle joins that
    Spark can split. Repeated edges and loops do no harm; an empty table
    gives an empty result.
    """
    both = stored(edges.select(F.col("a").alias("src"), F.col("b").alias("dst"))
                  .unionByName(edges.select(F.col("b").alias("src"), F.col("a").alias("dst"))), "edges")
    labels = stored(both.groupBy("src").agg(F.min("dst").alias("low"))
                    .select(F.col("src").alias("node"), F.least("src", "low").alias("label")), "labels")
    while True:
        near = both.join(labels, both.dst == labels.node).groupBy("src").agg(F.min("label").alias("low"))
        stepped = labels.join(near, labels.node == near.src) \
            .select("node", F.col("label").alias("old"), F.least("label", "low").alias("at"))
        target = labels.select(F.col("node").alias("at"), F.col("label").alias("next"))
        new = stored(stepped.join(target, "at").select("node", "old", F.least("at", "next").alias("label")),
                     "labels")
        labels = new.select("node", "label")
        if new.filter("old <> label").isEmpty():
            return labels.select("node", F.col("label").alias("component"))
