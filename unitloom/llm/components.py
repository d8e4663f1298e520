"""Connected components of an edge table by label spreading with pointer jumping; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) of an edge table (a, b): component is the smallest node reachable. The result is the scratch table `name`.

    Each round a node takes the smallest label among itself and its neighbours (pre-aggregated before the shuffle), then the
    label of its label, so chains halve. Rounds end when no label changes. Written tables cut the lineage; a round's tables go
    once the next round has its own.
    """
    one = edges.where("a <> b")
    both = scratch.write(one.select("a", "b").unionByName(one.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}_both")
    labels = scratch.write(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("component")), f"{name}_labels0")
    k = 0
    while True:
        heard = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("component").alias("heard"))
        nearer = scratch.write(labels.join(heard, labels.node == heard.a).select("node", F.col("component").alias("was"), F.least("component", "heard").alias("component")), f"{name}_near{k}")
        up = nearer.select(F.col("node").alias("up"), F.col("component").alias("top"))
        jumped = scratch.write(nearer.join(up, nearer.component == up.up).select("node", "was", F.least("component", "top").alias("component")), f"{name}_labels{k + 1}")
        scratch.drop(f"{name}_near{k}", f"{name}_labels{k}")
        if jumped.where("component <> was").isEmpty():
            out = scratch.write(jumped.select("node", "component"), name)
            scratch.drop(f"{name}_both", f"{name}_labels{k + 1}")
            return out
        labels = jumped.select("node", "component")
        k += 1
