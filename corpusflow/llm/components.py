"""Connected components of an edge table."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import stored


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long); component is its smallest reachable node.

    Each round takes the smallest label among a node's neighbours and then the
    label of its label, so labels travel twice as far every round.  Minima are
    taken in every task before they are shuffled, and every table is written, so
    joins on a hub's key can be split.  An empty table gives an empty result.
    """
    both = edges.where("a <> b").select("a", "b")
    both = stored(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("component")), "labels")
    for _ in range(max_rounds):
        seen = labels.select(F.col("node").alias("__n"), F.col("component").alias("__c"))
        near = both.join(seen, F.col("b") == F.col("__n")).groupBy("a").agg(F.min("__c").alias("__near"))
        hooked = stored(labels.join(near, F.col("node") == F.col("a"), "left")
                        .select("node", F.least("component", F.coalesce("__near", "component")).alias("component"),
                                F.col("component").alias("__old")), "hooked")
        above = hooked.select(F.col("node").alias("__n"), F.col("component").alias("__c"))
        labels = stored(hooked.join(above, F.col("component") == F.col("__n"), "left")
                        .select("node", F.coalesce("__c", "component").alias("component"), "__old"), "labels")
        if labels.where("component <> __old").isEmpty():
            break
    else:
        raise RuntimeError(f"components: not settled after {max_rounds} rounds")
    return labels.select("node", "component")
