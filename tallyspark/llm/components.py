"""Connected components of a link table, entirely in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import write_table


def connected_components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable over ``links(a, b)`` for every id in them.

    Each round every id takes the smallest label among its neighbours (a partial
    aggregate, so a hub with many links is no hot spot) and then its label's label, which
    at least halves long chains.  Rounds end when nothing changes.  Labels are written
    each round, so lineage stays short and lost executors cost no recomputation.
    """
    edges = write_table(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = write_table(edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("b"))
                         .select("id", F.least("id", "b").alias("component")), "labels")
    while True:
        near = (edges.join(labels, edges.b == labels.id).groupBy("a").agg(F.min("component").alias("near")))
        step = (labels.join(near, labels.id == near.a, "left")
                .select("id", "component", F.least("component", F.coalesce("near", "component")).alias("new")))
        jump = step.select(F.col("id").alias("j_id"), F.col("new").alias("j_new"))
        moved = write_table(step.join(jump, step.new == jump.j_id, "left")
                            .select("id", "component", F.least("new", F.coalesce("j_new", "new")).alias("new")), "labels")
        labels = moved.select("id", F.col("new").alias("component"))
        if moved.where(F.col("component") != F.col("new")).isEmpty():
            return labels
