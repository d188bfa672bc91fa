"""Connected components of nodes that share groups: least labels by hooking and pointer jumping over staged tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import staged


def min_labels(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Smallest label reachable from each node.

    ``members`` (node, grp): a row says that the node belongs to a group, all nodes of a
    group are linked.  ``labels`` (node, label): the nodes' own labels (null: none, larger than any).
    Returns (node, label) for the nodes of ``members``.

    Each node points at the least node that it knows of its component, itself at first, nodes
    being ordered by label, then by node, so that nodes with one label stay apart.  A round
    takes the pointers' own pointers, their minimum over each group and over each node's
    groups, and gives it to the node and to the node that it pointed at.  Pointers so
    double their reach: the rounds grow with the logarithm of the longest path of groups.

    All steps are joins of staged tables or aggregates with a map-side part, so a group, or a
    node that many point at, sends one row a task and a hot key is split by adaptive
    execution.  Every round is written to the shared folder; rounds end when nothing changes.
    """
    return _components(members, labels)[0]


def _components(members: DataFrame, labels: DataFrame) -> tuple[DataFrame, int]:
    """The rows of ``min_labels`` and the number of rounds."""
    members = staged(members.select("node", "grp").distinct(), "members")
    own = F.struct(F.col("label").isNull().alias("none"), F.col("label").alias("label"), F.col("node").alias("node"))
    nodes = members.select("node").distinct().join(labels.select("node", "label").distinct(), "node", "left")
    current = staged(nodes.groupBy("node").agg(F.min(own).alias("at")), "labels")
    rounds = 0
    while True:
        rounds += 1
        target = current.select(F.col("node").alias("to"), F.col("at").alias("far"))
        ahead = staged(current.join(target, F.col("at.node") == F.col("to")).select("node", "at", "far"), "ahead")
        low = staged(members.join(ahead.select("node", "far"), "node").groupBy("grp").agg(F.min("far").alias("low")), "low")
        near = staged(members.join(low, "grp").groupBy("node").agg(F.min("low").alias("near")), "near")
        # what a node learns is for itself and for the node it points at; ``was`` marks the node's own row
        told = ahead.join(near, "node").select(F.explode(F.array(
            F.struct("node", F.least("at", "far", "near").alias("at"), F.col("at").alias("was")),
            F.struct(F.col("at.node").alias("node"), F.col("near").alias("at"), F.lit(None).alias("was")))).alias("t"))
        step = staged(told.groupBy("t.node").agg(F.min("t.at").alias("at"), F.max("t.was").alias("was"))
                      .select("node", "at", (F.col("at") < F.col("was")).alias("moved")), "labels")
        moved = not step.filter("moved").isEmpty()
        current = step.select("node", "at")
        if not moved:
            return current.select("node", F.col("at.label").alias("label")), rounds
