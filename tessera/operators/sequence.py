"""Order-dependent operators that stay distributed.

A window with no PARTITION BY pulls every row into one task, and a window
partitioned by a hot key pulls that key's rows into one task.  The operators
here cut the full ordering into ranges of similar size, work inside each
range with ordinary windows, and link the ranges by a table of at most one
row per range (and group).  The bounds of the ranges are taken once, from a
bounded sample of rows; they decide how even the ranges are, never the result.

* ``assign_ids`` - dense 1..N identity in a given order (K2 RESTART IDENTITY).
* ``previous_in_order`` - columns of the preceding row within a group (the
  derivation of self references such as a preceding visit, J3).
* ``running`` - a running sum or maximum within a group.
* ``eras`` - merge dated events per group when gaps are small (R14).
* ``interval_eras`` - the same for exposures with a start and an end.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

#: ranges at most on the first level, and in each of these on the second; sampled rows per range
MOST_RANGES, SAMPLE_PER_RANGE = 1024, 20


def _steps(bounds: Column, n: int, mine: Column) -> Column:
    """How many of up to ``n`` ascending bounds are at or below ``mine``."""
    def further(at: Column, step: Column) -> Column:
        return F.when(F.get(bounds, at + step - 1) <= mine, at + step).otherwise(at)
    steps = [1 << i for i in reversed(range(n.bit_length()))]
    return F.aggregate(F.array(*[F.lit(x) for x in steps]), F.lit(0), further)


def _every(step: int) -> Column:
    """Of the collected column ``k``, sorted, every ``step``-th."""
    return F.filter(F.array_sort(F.collect_list("k")), lambda x, i: (i > 0) & (i % step == 0))


def _ranged(df: DataFrame, keys: list[str], ranges: int | None) -> DataFrame:
    """``df`` with ``_range``: the number of the range that a row's ``keys`` lie
    in, ascending with them.

    The bounds of the first level, MOST_RANGES at most, come from a sample and
    are a literal of the plan (as JSON, whose rounding of times does no harm),
    so every use of the column sees the same ones.  Where more ranges are
    wanted each is cut again, by bounds sampled inside it and written once: a
    table of a row per range of the first level, which is broadcast.
    """
    wanted = int(ranges or 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    n, inner = min(MOST_RANGES, wanted), min(MOST_RANGES, -(-wanted // MOST_RANGES))
    mine = F.struct(*[F.col(k) for k in keys])
    picked = df.select(F.struct(*keys).alias("k")).orderBy(F.rand(17)).limit(n * SAMPLE_PER_RANGE)
    bounds = picked.agg(_every(SAMPLE_PER_RANGE).alias("b"))
    kind = bounds.schema["b"].dataType.simpleString()
    outer = _steps(F.from_json(F.lit(bounds.select(F.to_json("b")).first()[0]), kind), n, mine)
    if inner == 1:
        return df.withColumn("_range", outer)
    share = min(1.0, n * inner * SAMPLE_PER_RANGE / max(1, df.count()))
    cuts = (df.select(outer.alias("_outer"), mine.alias("k")).where(F.rand(23) < share).groupBy("_outer")
            .agg(F.array_sort(F.collect_list("k")).alias("s"))
            .select("_outer", F.transform(F.sequence(F.lit(1), F.lit(inner - 1)), lambda i: F.get("s", F.floor(i * F.size("s") / inner).cast("int"))).alias("_cuts")))
    x = df.withColumn("_outer", outer).join(F.broadcast(cut_lineage(cuts, "ranges")), "_outer", "left")
    own = F.coalesce(_steps(F.col("_cuts"), inner - 1, mine), F.lit(0))
    return x.withColumn("_range", F.col("_outer") * inner + own).drop("_outer", "_cuts")


def assign_ids(df: DataFrame, order, id_col: str = "id", start: int = 1,
               partitions: int | None = None, id_type: str = "int") -> DataFrame:
    """Dense identity ``start..start+N-1`` following ``order``.

    One shuffle of the rows, by range; the offset of a range is the number of
    rows in the ranges before it, at most one row per range and broadcast.
    Rows that tie on ``order`` are ordered by a hash of the whole row (any
    order is valid for ROW_NUMBER; this one is reproducible), which the ranges
    take in, so a heavily repeated order value is cut up too.
    """
    names = [f"_o{i}" for i in range(len(order))]
    x = df.select("*", *[(F.col(o) if isinstance(o, str) else o).alias(n) for o, n in zip(order, names)],
                  F.xxhash64(*[F.col(f"`{c}`") for c, t in df.dtypes if not t.startswith(("map", "variant"))]).alias("_tie"))
    keys = [*names, "_tie"]
    x = _ranged(x, keys, partitions)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (x.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
               .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")))
    at = F.row_number().over(Window.partitionBy("_range").orderBy(*keys))
    out = x.withColumn("_at", at).join(F.broadcast(offsets), "_range")
    ident = (F.col("_off") + F.col("_at") - 1 + F.lit(start)).cast(id_type)
    return out.withColumn(id_col, ident).drop("_range", "_off", "_at", *keys)


def previous_in_order(df: DataFrame, group, order, carry: dict[str, str],
                      partitions: int | None = None) -> DataFrame:
    """Adds, for every row, the ``carry`` columns of the preceding row of the
    same ``group`` under ``order`` (NULL for a group's first row) - LAG(1).

    ``order`` should be a total order within the group (add a unique id as
    the last column).  Rows are dealt by (group, range of group and order), so
    a group holding a third of all rows is spread over many tasks; LAG runs
    inside each, and the first row of a range takes its predecessor from the
    last row of the group's nearest earlier range.  That table has one row per
    group and range and is joined on the partitioning the window needs anyway.
    """
    group, order = list(group), list(order)
    x = _ranged(df, [*group, *order], partitions)
    x = x.withColumn("_group", F.struct(*[F.col(g) for g in group]))  # equal where NULLs meet, unlike the columns
    own = Window.partitionBy("_group", "_range").orderBy(*order)
    carried = F.struct(*[F.col(src).alias(out) for out, src in carry.items()])
    ends = x.groupBy("_group", "_range").agg(F.max_by(carried, F.struct(*[F.col(o) for o in order])).alias("_last"))
    edges = ends.select("_group", "_range", F.lag("_last").over(Window.partitionBy("_group").orderBy("_range")).alias("_edge"))
    y = (x.withColumn("_first", F.row_number().over(own) == 1).withColumn("_lag", F.lag(carried).over(own))
         .join(edges, ["_group", "_range"], "left"))
    for out in carry:
        y = y.withColumn(out, F.when(F.col("_first"), F.col("_edge")[out]).otherwise(F.col("_lag")[out]))
    return y.select(*df.columns, *carry)


def eras(df: DataFrame, group, day: Column | str, gap_days: int,
         start_col: str = "era_start", end_col: str = "era_end", count_col: str = "n") -> DataFrame:
    """Merge dated events of a group into eras: a new era starts when a day
    is more than ``gap_days`` after the previous event's day.

    Events are first reduced to (group, day, count) with a map-side combined
    aggregation, so the window only ever sees distinct days - a group's
    window size is bounded by the calendar span, not by its event count.
    """
    group = list(group)
    day = F.col(day) if isinstance(day, str) else day
    days = df.groupBy(*group, day.alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*group).orderBy("_d")
    brk = F.when(F.datediff(F.col("_d"), F.lag("_d").over(w)) <= gap_days, 0).otherwise(1)
    numbered = days.withColumn("_brk", brk).withColumn(
        "_era", F.sum("_brk").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return (numbered.groupBy(*group, "_era")
                    .agg(F.min("_d").alias(start_col), F.max("_d").alias(end_col),
                         F.sum("_n").alias(count_col))
                    .drop("_era"))


def running(df: DataFrame, group, order, out: str, value: Column, how: str = "sum", before: bool = False,
            partitions: int | None = None) -> DataFrame:
    """Adds ``out``: the sum (or ``max``) of ``value`` over the rows of the same
    ``group`` up to this one under ``order``, a total order within the group;
    with ``before`` this row itself is left out (NULL for a group's first row).

    As in ``previous_in_order`` a large group is cut into ranges: a window
    works inside each, and what the earlier ranges of the group amount to
    comes from a table of one row per group and range.
    """
    group, order = list(group), list(order)
    total = {"sum": F.sum, "max": F.max}[how]
    x = _ranged(df, [*group, *order], partitions).withColumn("_value", value)
    x = x.withColumn("_group", F.struct(*[F.col(g) for g in group]))  # equal where NULLs meet
    earlier = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    edges = (x.groupBy("_group", "_range").agg(total("_value").alias("_all"))
             .select("_group", "_range", total("_all").over(earlier).alias("_earlier")))
    own = Window.partitionBy("_group", "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    y = x.withColumn("_own", total("_value").over(own)).join(edges, ["_group", "_range"], "left")
    if how == "max":
        both = F.greatest("_own", "_earlier")  # NULLs are passed over
    else:
        both = F.when(F.col("_own").isNull() & F.col("_earlier").isNull(), F.lit(None)).otherwise(
            F.coalesce("_own", F.lit(0)) + F.coalesce("_earlier", F.lit(0)))
    return y.withColumn(out, both).select(*df.columns, out)


def interval_eras(df: DataFrame, group, start: str, end: str, gap_days: int, start_col: str = "era_start",
                  end_col: str = "era_end", count_col: str = "n", gap_col: str | None = None,
                  partitions: int | None = None) -> DataFrame:
    """Merge exposures (``start`` to ``end``) of a group into eras: a new era
    begins where a start is more than ``gap_days`` after the greatest end so
    far, so exposures that overlap or lie inside another are one era.  A NULL
    end counts as the start; exposures without a start are left out.
    ``gap_col`` adds the days of an era that no exposure covers.

    Exposures are first reduced to one row per group, start and end (with
    their number); a group of any size is then cut into ranges (``running``).
    """
    group = list(group)
    spans = (df.where(F.col(start).isNotNull())
             .groupBy(*group, F.col(start).alias("_s"), F.greatest(F.coalesce(end, start), F.col(start)).alias("_e"))
             .agg(F.count(F.lit(1)).alias("_n")))
    spans = cut_lineage(spans, "exposures")
    order = ["_s", "_e"]
    seen = running(spans, group, order, "_reach", F.col("_e"), "max", before=True, partitions=partitions)
    apart = F.datediff(F.col("_s"), F.col("_reach"))
    seen = cut_lineage(seen.withColumn("_new", F.when(apart <= gap_days, 0).otherwise(1))
                       .withColumn("_gap", F.when(apart.between(2, gap_days), apart - 1).otherwise(0)), "exposures")
    numbered = running(seen, group, order, "_era", F.col("_new"), "sum", partitions=partitions)
    sums = [F.min("_s").alias(start_col), F.max("_e").alias(end_col), F.sum("_n").alias(count_col)]
    if gap_col:
        sums.append(F.sum("_gap").alias(gap_col))
    return numbered.groupBy(*group, "_era").agg(*sums).drop("_era")
