"""Connected components of a graph too large for one machine."""

from pyspark.sql import functions as F

from urbanstats.llm.common import stored


def _mins(arcs):
    """Per node, the smallest of itself and its neighbours."""
    return arcs.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))


def connected_components(links, name="components"):
    """Rows (node, label) for all nodes of ``links``; the label is the smallest node.

    ``links`` has two columns ``u`` and ``v`` of longs, in any order, repeats allowed.
    Large-star and small-star steps (Kiveris and others, 2014) alternate until nothing
    changes, which takes about log(n) rounds. Each is a grouping and a join, so no task
    holds a component. Every round goes to the shared scratch folder.
    """
    edges = stored(links.filter("u <> v").select("u", "v").distinct(), name)
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_mins(both), "u")
            .filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v")
            .distinct()
        )
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        small_mins = _mins(down)
        small = (
            down.join(small_mins, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small_mins.select("u", F.col("m").alias("v")))
            .filter("u <> v")
            .distinct()
        )
        edges = stored(small, name)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        roots.select("node", F.col("node").alias("label"))
    )
