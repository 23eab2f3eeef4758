"""Connected components of an edge table, by smallest labels with pointer jumping.

Every step is a join or an aggregation that combines before it shuffles; neighbour
lists are never gathered, so a node with very many edges is no special case.  State
between steps lies in the shared scratch folder, one table for each step; whether a step
changed a label is counted while its table is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cellscope.llm.common import materialize


def components(edges: DataFrame) -> DataFrame | None:
    """``edges`` (a, b) of comparable ids -> (node, label): the smallest node that
    can be reached.  Nodes without an edge aren't listed; None if there are none at all."""
    both = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(
        F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.a", "e.b")
    both = materialize(both.where("a <> b").distinct(), "cc-edges")
    if not both.take(1):
        return None
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.first("a")).alias("label")), "cc-labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(
            F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        # Jump: a label's own label is smaller or equal and in the same component.
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        after = step.join(jump, "label", "left").select(
            "node", "old", F.least(F.coalesce("next", "label"), F.col("label")).alias("label"))
        seen = Observation()
        changed = F.coalesce(F.sum((F.col("label") != F.col("old")).cast("long")), F.lit(0)).alias("changed")
        labels = materialize(after.observe(seen, changed), "cc-labels").select("node", "label")
        if not seen.get["changed"]:
            return labels
