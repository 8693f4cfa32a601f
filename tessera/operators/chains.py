"""Following references over many hops: chains, their roots, and closures.

* ``follow`` - every node of a chain of references with the node it ends at
  and how many hops away that is (J3/J4 roots of preceding visits, R7 chains
  of one relationship), by pointer doubling: a round replaces every pointer
  by the pointer of the node it points at, so a chain of n hops takes about
  log2(n) rounds.
* ``closure`` - all pairs of ancestor and descendant with the least and most
  levels between them (R6), level by level.

A round reads the written result of the round before; only counts reach the
driver.
"""
from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import cut_lineage


class CycleFound(ValueError):
    """A hierarchy that must have none contains a cycle."""


def _written(df: DataFrame, *counts: Column):
    """``df`` written to the shared folder, and counts observed by that write."""
    seen = Observation(f"round_{uuid.uuid4().hex[:8]}")
    out = cut_lineage(df.observe(seen, *[c.alias(str(i)) for i, c in enumerate(counts)]), "round")
    return out, *[seen.get[str(i)] for i in range(len(counts))]


def follow(edges: DataFrame, node: str, target: str) -> DataFrame:
    """(node, root, depth, cycle, on_cycle) for every node that occurs in
    ``edges`` (node -> target, a NULL target ends a chain).

    A node without a target is its own root at depth 0.  Where a node has
    several targets the smallest is followed.  Nodes whose chain never ends
    have NULL root and depth, the smallest node of the cycle they run into as
    ``cycle``, and tell in ``on_cycle`` whether they lie on it.

    In each round some node of every unfinished chain that does end gets
    there; a round in which none does leaves only cycles.  Many nodes that
    point at one are a skewed key of a join between two written tables, which
    AQE splits.
    """
    pairs = cut_lineage(edges.select(F.col(node).alias("node"), F.col(target).alias("at")).where("node IS NOT NULL"), "references")
    ends = pairs.where("at IS NOT NULL").select(F.col("at").alias("node"), F.lit(None).cast(dict(pairs.dtypes)["at"]).alias("at"))
    state = cut_lineage(pairs.unionByName(ends).groupBy("node").agg(F.min("at").alias("at"))
                        .select("node", F.coalesce("at", "node").alias("at"), F.col("at").isNull().alias("done"),
                                F.when(F.col("at").isNull(), 0).otherwise(1).cast("long").alias("hops")), "chains")
    finished = [state.where("done").select("node", F.col("at").alias("root"), F.col("hops").alias("depth"))]
    while True:
        # what a pointer meets: a finished node ends the chain, another one is skipped over
        met = state.select(F.col("node").alias("at"), F.col("at").alias("_at"), F.col("hops").alias("_hops"), F.col("done").alias("_done"))
        open_ = state.where("NOT done")
        step, left, ended = _written(open_.join(met, "at").select(
            "node", F.col("_at").alias("at"), F.col("_done").alias("done"), (F.col("hops") + F.col("_hops")).alias("hops")),
            F.count_if(~F.col("done")), F.count_if("done"))
        finished.append(step.where("done").select("node", F.col("at").alias("root"), F.col("hops").alias("depth")))
        # finished nodes stay to be met
        state = step.unionByName(reduce(DataFrame.unionByName, finished[:-1]).select(
            "node", F.col("root").alias("at"), F.lit(True).alias("done"), F.col("depth").alias("hops")))
        if not left or not ended:
            break
    kind = dict(pairs.dtypes)["node"]
    out = reduce(DataFrame.unionByName, finished).select(
        "node", "root", "depth", F.lit(None).cast(kind).alias("cycle"), F.lit(False).alias("on_cycle"))
    if left:
        out = out.unionByName(_cycles(step.where("NOT done").select("node"), pairs, left))
    return out


def _cycles(nodes: DataFrame, pairs: DataFrame, n: int) -> DataFrame:
    """Rows of ``follow`` for nodes that all lead into cycles: after as many
    doublings as make ``n`` steps every pointer is on its cycle, and the
    smallest node passed from there is the cycle's name."""
    jump = cut_lineage(nodes.join(pairs.groupBy("node").agg(F.min("at").alias("at")), "node")
                       .withColumn("least", F.least("node", "at")), "cycles")
    for _ in range(n.bit_length()):
        met = jump.select(F.col("node").alias("at"), F.col("at").alias("_at"), F.col("least").alias("_least"))
        jump = cut_lineage(jump.join(met, "at").select("node", F.col("_at").alias("at"), F.least("least", "_least").alias("least")), "cycles")
    on = jump.select(F.col("at").alias("node")).distinct().withColumn("_on", F.lit(True))
    name = jump.select(F.col("node").alias("at"), F.col("least").alias("cycle"))
    kind = dict(jump.dtypes)["node"]
    return jump.select("node", "at").join(name, "at").join(on, "node", "left").select(
        "node", F.lit(None).cast(kind).alias("root"), F.lit(None).cast("long").alias("depth"), "cycle",
        F.col("_on").isNotNull().alias("on_cycle"))


def closure(edges: DataFrame, child: str, parent: str, itself: bool = True, most_levels: int | None = None) -> DataFrame:
    """The ancestor table of a hierarchy: (ancestor_concept_id,
    descendant_concept_id, min_levels_of_separation, max_levels_of_separation).

    Round k joins the pairs that are joined by some path of k - 1 steps with
    the edges and keeps each pair once, so a pair takes part in a round only
    if a path of that length exists.  ``itself`` adds every node as its own
    ancestor at level 0.  A hierarchy with a cycle has no most levels and is
    an error (``CycleFound``); ``most_levels`` stops after so many rounds.
    """
    counts = F.count_if(F.col("a") == F.col("d")), F.count(F.lit(1))
    step, loops, n = _written(edges.select(F.col(child).alias("d"), F.col(parent).alias("a"))
                              .where("d IS NOT NULL AND a IS NOT NULL").distinct(), *counts)
    up = step.select(F.col("d").alias("a"), F.col("a").alias("_next"))
    levels, found, k = [], step, 1
    while True:
        if loops:
            raise CycleFound(f"{loops} nodes are their own ancestors, {k} levels up")
        if not n:
            break
        levels.append(found.withColumn("k", F.lit(k)))
        if k == most_levels:
            break
        found, loops, n = _written(found.join(up, "a").select("d", F.col("_next").alias("a")).distinct(), *counts)
        k += 1
    if itself:
        levels.append(step.select("d").union(step.select("a")).distinct().select("d", F.col("d").alias("a"), F.lit(0).alias("k")))
    every = reduce(DataFrame.unionByName, levels) if levels else step.withColumn("k", F.lit(0))
    return every.groupBy(F.col("a").alias("ancestor_concept_id"), F.col("d").alias("descendant_concept_id")).agg(
        F.min("k").alias("min_levels_of_separation"), F.max("k").alias("max_levels_of_separation"))
