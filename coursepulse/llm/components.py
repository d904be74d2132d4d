"""Connected components by min-label propagation with root hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from coursepulse.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (src, dst); component is the least node.

    Each round a node takes the least label among its neighbours, its own and its label's
    label, and a root takes the least label next to its members, so that the number of rounds
    is about logarithmic. Labels and edges are read from stored tables on both sides of each
    join: a hub's rows are split by adaptive execution, sums are pre-aggregated. Self loops
    and repeated edges change nothing; rows with a null end are ignored; no edges, no rows.
    """
    edges = edges.select("src", "dst").filter("src IS NOT NULL AND dst IS NOT NULL")
    both = materialize(
        edges.union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct(),
        "edges",
    )
    labels = materialize(
        both.groupBy(F.col("src").alias("node")).agg(
            F.min(F.least("src", "dst")).alias("component")
        ),
        "labels",
    )
    total = F.sum(F.col("component").cast("decimal(38,0)"))
    before = labels.agg(total).first()[0]
    while before is not None:
        at = lambda name: labels.select(
            F.col("node").alias(name), F.col("component").alias(f"label_{name}")
        )
        met = both.join(at("dst"), "dst").join(at("src"), "src")
        jump = labels.join(at("component"), "component").select(
            "node", F.col("label_component").alias("component")
        )
        told = met.select(
            F.explode(
                F.array(
                    F.struct(F.col("src").alias("node"), F.col("label_dst").alias("component")),
                    F.struct(F.col("label_src").alias("node"), F.col("label_dst").alias("component")),
                )
            ).alias("x")
        ).select("x.*")
        labels = materialize(
            labels.union(told).union(jump).groupBy("node").agg(F.min("component").alias("component")),
            "labels",
        )
        now = labels.agg(total).first()[0]
        if now == before:
            break
        before = now
    return labels
