"""Connected components by repeated contraction."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): nodes share a root if
    links connect them.  The root is one of the nodes, not the smallest.

    Each round sends every node to the node of lowest priority within two
    steps (priorities are hashes, drawn anew each round, so chains shrink by
    a constant factor and stars vanish at once), and the edges to those
    between the nodes left.  Aggregations combine before they shuffle, and
    the joins are on one row per node, so that a node with many edges is only
    a skewed join key, which AQE splits.  Every round is written to the shared
    folder.
    """
    edges = stored(edges.select("a", "b").where("a != b").distinct(), "edges")
    maps, turn = [], 0
    while not edges.isEmpty():
        def ranked(c):
            return F.struct(F.xxhash64(F.col(c), F.lit(turn)).alias("h"), F.col(c).alias("n"))
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # written, so that the join reads both sides as they were shuffled and AQE can split a node with many edges
        near = stored(both.groupBy("a").agg(F.min(ranked("b")).alias("m"))
                      .select("a", F.least("m", ranked("a")).alias("m")), "nearest")
        far = (both.join(near.select(F.col("a").alias("b"), "m"), "b").groupBy("a").agg(F.min("m").alias("f"))
               .join(near, "a").select(F.col("a").alias("node"), F.least("f", "m")["n"].alias("root")))
        far = stored(far, "contraction")
        maps.append(far)
        edges = stored(
            edges.join(far.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a")
            .join(far.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
            .where("ra != rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
        turn += 1
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = maps[0]
    for m in maps[1:]:
        step = m.select(F.col("node").alias("root"), F.col("root").alias("_next"))
        found = found.join(step, "root", "left").select("node", F.coalesce("_next", "root").alias("root"))
    return found
