"""Connected components by rounds of joins and aggregates (alternating large and small stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.session import stage_table


def _stars(pairs: DataFrame, large: bool) -> DataFrame:
    """Ties each node's neighbours to the least node around it."""
    if large:
        around = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = around.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        out = around.join(least, "a").filter("b > a").select(F.col("b").alias("a"),
                                                             F.col("m").alias("b"))
    else:
        # Here every pair has a > b.
        least = pairs.groupBy("a").agg(F.min("b").alias("m"))
        out = pairs.join(least, "a").select(
            F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m")))
            .alias("p")).select("p.a", F.col("p.m").alias("b"))
    return out.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component: the least node that can be reached, for every node of ``links`` (a, b).

    Links go both ways; repeated links and links to oneself do no harm, links with a null are left
    out. Only counts reach the driver. Each round is written, so that no lineage grows.
    """
    nodes = links.filter("a IS NOT NULL AND b IS NOT NULL")
    pairs = stage_table(nodes.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .filter("a <> b").distinct(), "links")
    mark = None
    while True:
        found = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast(
            "decimal(38,0)")).alias("s")).first()
        if (found.n, found.s) == mark:
            break
        mark = (found.n, found.s)
        pairs = stage_table(_stars(_stars(pairs, large=True).select("a", "b"), large=False),
                            "links")
    roots = pairs.select(F.col("b").alias("node")).distinct()
    alone = nodes.filter("a = b").select(F.col("a").alias("node")).distinct()
    linked = pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.withColumn("component", F.col("node")))
    return linked.unionByName(alone.join(linked, "node", "left_anti").select(
        "node", F.col("node").alias("component")))
