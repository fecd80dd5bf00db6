"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ledgerloom.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b: long); component is the smallest node reachable.

    Every round takes the smallest label among the neighbours and then the label of that label, so long chains
    halve. Minima combine before each shuffle, so a node with very many links costs one row a task. Rounds end
    when nothing changes. NULL ends and self links are ignored; an empty table gives an empty one.
    """
    ends = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    ends = ends.filter("a is not null and b is not null and a <> b")
    edges = written(ends.union(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                     .select("node", F.least("node", "low").alias("component")))
    while True:
        near = (edges.join(labels, edges.b == labels.node)
                .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("low")))
        hooked = written(labels.join(near, "node").select("node", "component", F.least("component", "low").alias("next")))
        above = hooked.select(F.col("node").alias("next"), F.col("next").alias("top"))
        seen = Observation()
        jumped = hooked.join(above, "next").select(
            "node", F.col("component").alias("was"), F.least("next", "top").alias("component")
        )
        changed = F.sum((F.col("was") != F.col("component")).cast("long"))
        labels = written(jumped.observe(seen, changed.alias("changed")).select("node", "component"))
        if not seen.get["changed"]:
            return labels
