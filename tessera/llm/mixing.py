"""Mixing sources to target weights by Pfair scheduling.

Time is a row of slots, one block of rows each.  A source of weight w (weights
sum to 1) owes its i-th block (i = 1, 2, ...) between its release
floor((i-1)/w) and its deadline ceil(i/w); taking the released block with the
earliest deadline in every slot meets all deadlines, since unit jobs with
whole release times and deadlines are feasible here and earliest deadline
first is optimal for them.  So after any t slots a source has been given more
than w*t - 1 and fewer than w*t + 1 blocks.

Weights are rounded to whole slots out of ``resolution``, which makes the
schedule periodic: one period of ``resolution`` slots is worked out and every
row finds its slot from its number in its source by arithmetic.  By default a
period has 50 slots for each source, 1,000 at least, so that the slot each
source gets in any case moves no target by more than a fiftieth and any number
of sources fits.  The period is worked out in one row: its cost grows with the
square of the number of sources, not with the rows.  Only DataFrame functions
are used.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, number_in_groups, without

ADDED = ["epoch", "block", "slot", "place"]
#: slots of a period by default
LEAST_PERIOD, SLOTS_PER_SOURCE = 1000, 50
#: slots worked out before the picks so far are copied
CHUNK = 500


def source_ticks(docs: DataFrame, source: str, resolution: int | None = None,
                 weights: dict[str, int] | None = None, smoothing: int = 4) -> DataFrame:
    """(source, n, ticks): whole slots per period for each source; they add up
    to the period.

    Target weights are ``weights`` (positive whole numbers by source; sources
    not named weigh 1), or by default the source's share of rows moved one
    ``smoothing``-th of the way to equal shares.  Every source gets one slot;
    the others go by weight, what is left over to the largest remainders.
    """
    big = "decimal(38,0)"
    n = docs.groupBy(F.col(source).alias("_source")).agg(F.count(F.lit(1)).alias("_n"))
    rows = n.agg(F.array_sort(F.collect_list(F.struct("_source", "_n"))).alias("_s"))
    rows = rows.select(
        "_s", F.size("_s").alias("_k"),
        F.aggregate("_s", F.lit(0).cast("long"), lambda a, x: a + x["_n"]).alias("_all"))
    rows = rows.select("_k", "_all", F.explode("_s").alias("__t_r")).select("_k", "_all", "__t_r._source", "__t_r._n")
    if weights is None:
        w = (F.lit(smoothing - 1).cast(big) * F.col("_k") * F.col("_n") + F.col("_all")).cast(big)
    else:
        w = F.lit(1)
        for name, value in weights.items():
            w = F.when(F.col("_source") == name, F.lit(int(value))).otherwise(w)
        w = w.cast(big)
    rows = rows.select("_source", "_n", "_k", w.alias("_w"))
    # one row again, an item per source
    one = rows.agg(F.array_sort(F.collect_list(F.struct("_source", "_n", "_w"))).alias("_s"),
                   F.sum("_w").cast(big).alias("_total"))
    k = F.size("_s")
    slots = F.greatest(F.lit(LEAST_PERIOD).cast("long"), k.cast("long") * SLOTS_PER_SOURCE) if resolution is None else F.lit(resolution).cast("long")
    spare = (slots - k).cast(big)
    one = one.select(
        F.when(k > slots, F.raise_error(F.lit("more sources than slots in a period: raise resolution")))
        .otherwise(F.transform("_s", lambda x: F.struct(
            x["_source"].alias("source"), x["_n"].alias("n"),
            (1 + F.floor((x["_w"] * spare).cast(big) / F.col("_total"))).cast("long").alias("base"),
            ((x["_w"] * spare).cast(big) % F.col("_total")).alias("rest")))).alias("_s"))
    order = F.array_sort(F.transform("_s", lambda x, i: F.struct((-x["rest"]).alias("r"), i.alias("i"))))
    left = slots - F.aggregate("_s", F.lit(0).cast("long"), lambda a, x: a + x["base"])
    one = one.select("_s", F.transform(F.slice(order, 1, F.greatest(left, F.lit(0)).cast("int")),
                                       lambda o: o["i"]).alias("_plus"))
    return one.select(F.explode(F.transform("_s", lambda x, i: F.struct(
        x["source"].alias("source"), x["n"].alias("n"),
        (x["base"] + F.array_contains("_plus", i).cast("long")).alias("ticks")))).alias("__t_r")).select("__t_r.*")


def period(ticks: DataFrame, resolution: int | None = None) -> DataFrame:
    """One period: (source, n, ticks, period, slots), where ``period`` is its
    length, the sum of all ticks, and ``slots`` holds the slots that earliest
    deadline first gives the source's blocks, in order."""
    one = ticks.agg(F.array_sort(F.collect_list(F.struct("source", "n", "ticks"))).alias("_s"),
                    F.sum("ticks").cast("long").alias("_m"))
    one = one.filter(F.size("_s") > 0).withColumn("_m", F.col("_m") if resolution is None else F.lit(resolution).cast("long"))
    m, k = F.col("_m"), F.col("_k")
    sources = one.select(F.posexplode("_s").alias("_i", "_x"), "_m", F.size("_s").cast("long").alias("_k"))
    # a row per block: its release and, as one number that also sorts by it, its deadline and source
    blocks = sources.select("_i", "_m", "_k", F.col("_x.ticks").alias("_a"),
                            F.explode(F.sequence(F.lit(0).cast("long"), F.col("_x.ticks") - 1)).alias("_g"))
    blocks = blocks.select(F.floor(F.col("_g") * m / F.col("_a")).alias("_t"),
                           (-F.floor(-((F.col("_g") + 1) * m) / F.col("_a")) * k + F.col("_i")).alias("_b"))
    every = one.select(F.explode(F.sequence(F.lit(0).cast("long"), m - 1)).alias("_t"), F.lit(None).cast("long").alias("_b"))
    released = blocks.unionByName(every).groupBy("_t").agg(F.collect_list("_b").alias("_b"))
    # one row: the blocks released at each slot, CHUNK slots in an array
    released = released.groupBy(F.floor(F.col("_t") / CHUNK).alias("_c")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_t", "_b"))), lambda x: x["_b"]).alias("_r"))
    released = released.agg(F.transform(F.array_sort(F.collect_list(F.struct("_c", "_r"))), lambda x: x["_r"]).alias("_r"))

    def slot(acc: Column, more: Column) -> Column:
        return let(F.concat(acc["ready"], more), lambda r: F.struct(
            F.array_remove(r, F.array_min(r)).alias("ready"), F.array_append(acc["picks"], F.array_min(r)).alias("picks")))

    def chunk(acc: Column, slots: Column) -> Column:
        none = F.array().cast("array<bigint>")
        return let(F.aggregate(slots, F.struct(acc["ready"].alias("ready"), none.alias("picks")), slot), lambda x: F.struct(
            x["ready"].alias("ready"), F.array_append(acc["chunks"], x["picks"]).alias("chunks")))

    start = F.struct(F.array().cast("array<bigint>").alias("ready"), F.array().cast("array<array<bigint>>").alias("chunks"))
    picks = released.select(F.posexplode(F.flatten(F.aggregate("_r", start, chunk, lambda x: x["chunks"]))).alias("_t", "_b"))
    # the number of sources again, for the source of a block
    picks = picks.crossJoin(F.broadcast(one.select(F.size("_s").cast("long").alias("_k")))).groupBy(
        (F.col("_b") % k).cast("int").alias("_i")).agg(F.array_sort(F.collect_list("_t")).alias("slots"))
    return sources.join(picks, "_i").select("_x.*", m.alias("period"), "slots")


def mix(docs: DataFrame, source: str = "source", key: str = "doc_id",
        weights: dict[str, int] | None = None, block_rows: int = 8,
        resolution: int | None = None, smoothing: int = 4, apart: Column | None = None) -> DataFrame:
    """Every row of ``docs`` with its places in the mixture: ``epoch`` (0 for
    the first time the row is used), ``block`` (of its source's stream),
    ``slot`` (of the whole mixture) and ``place`` in the block.

    A source is read in the order of md5(key), over and over, in blocks of
    ``block_rows``; the mixture ends with the slot in which the last source
    ends its first pass.  So every row occurs, rows of sources below their
    target more than once, and after every slot each source is within one
    block of its (rounded) target.  A null source is a source; rows with
    equal keys each have their place; an empty table gives no rows.  Input
    columns named like the added ones are replaced.  ``apart`` tells rows
    without a key apart that are equal in all columns (``number_in_groups``).
    """
    docs = without(docs, ADDED)
    plan = period(source_ticks(docs, source, resolution, weights, smoothing), resolution)
    m = F.col("period")
    last = F.floor((F.col("n") - 1) / block_rows)  # the block that ends the first pass
    plan = plan.withColumn("_end", F.floor(last / F.col("ticks")) * m
                           + F.get("slots", (last % F.col("ticks")).cast("int")))
    plan = plan.withColumn("_stop", plan.select(F.max("_end")).scalar()).select(
        F.col("source").alias("__t_psource"), F.col("n").alias("__t_pn"), F.col("ticks").alias("__t_pticks"),
        F.col("slots").alias("__t_pslots"), m.alias("__t_pperiod"),
        ((F.floor(F.col("_stop") / m) * F.col("ticks")
          + F.size(F.filter("slots", lambda s: s <= F.col("_stop") % m))) * block_rows).alias("__t_prows"))
    numbered = number_in_groups(docs, [source], key, "__t_r", apart)
    # a row per source and the slots of one period
    rows = numbered.join(F.broadcast(plan), F.col(source).eqNullSafe(F.col("__t_psource")))
    rows = rows.withColumn("epoch", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("__t_prows") - 1 - F.col("__t_r")) / F.col("__t_pn")))))
    p = F.col("epoch") * F.col("__t_pn") + F.col("__t_r")
    rows = rows.withColumn("block", F.floor(p / block_rows)).withColumn("place", (p % block_rows).cast("int"))
    rows = rows.withColumn("slot", F.floor(F.col("block") / F.col("__t_pticks")) * F.col("__t_pperiod")
                           + F.get("__t_pslots", (F.col("block") % F.col("__t_pticks")).cast("int")))
    return rows.select(*docs.columns, *ADDED)


def mixed_order(docs: DataFrame, partitions: int | None = None, **how) -> DataFrame:
    """The mixture itself: the rows of ``docs``, repeated as ``mix`` says and
    sorted by slot across and within partitions."""
    mixed = mix(docs, **how)
    parts = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (mixed.repartitionByRange(parts, "slot", "place").sortWithinPartitions("slot", "place")
            .select(*without(docs, ADDED).columns))
