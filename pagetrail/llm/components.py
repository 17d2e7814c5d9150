"""Connected components of a table of edges, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetrail.sources.scratch import scratch_table


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node in ``src`` or ``dst``.

    Each round every node takes the smallest label around it and then that node's label.
    Labels are written at the end of each round, so a lost executor costs one round. Nodes
    are of any type that sorts. Give edges that are written, as they are counted first.
    """
    both = edges.select("src", "dst").union(edges.select("dst", "src"))
    most = 2 * edges.count()
    both = scratch_table(both.distinct(), "edges", most)
    labels = scratch_table(
        both.groupBy(F.col("src").alias("node")).agg(
            F.least(F.first("src"), F.min("dst")).alias("component")
        ),
        "labels",
        most,
    )
    total = None
    while True:
        # 64 bits of each node and its label: an equal sum means that nothing has changed.
        marks = F.xxhash64("node", "component").cast("decimal(38,0)")
        now = labels.agg(F.sum(marks)).first()[0]
        if now is None or now == total:
            return labels
        total = now
        around = (
            both.join(labels, both["dst"] == labels["node"])
            .select(F.col("src").alias("node"), "component")
            .union(labels)
        )
        nearest = around.groupBy("node").agg(F.min("component").alias("component"))
        nearest = scratch_table(nearest, "labels", most)
        above = nearest.select(F.col("node").alias("_node"), F.col("component").alias("_above"))
        labels = scratch_table(
            nearest.join(above, F.col("component") == F.col("_node")).select(
                "node", F.col("_above").alias("component")
            ),
            "labels",
            most,
        )
