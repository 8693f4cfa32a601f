"""Joins of dated rows with validity windows (R4), and windows that overlap.

A code is a poor join key when few of them hold most rows.  The windows are
cut at the edges of date buckets, and a row looks only in the bucket of its
date, so a code's rows meet its windows in as many tasks as there are buckets.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import sequence


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def window_join(rows: DataFrame, windows: DataFrame, keys, day: Column, start: str, end: str, take,
                bucket_days: int = 30, hint_broadcast: bool = False) -> DataFrame:
    """``rows`` with the ``take`` columns of every window of the same keys that
    holds the row's ``day`` (both ends belong to it); rows without one stay,
    with NULLs.  ``keys`` maps columns of the rows to those of the windows.

    Windows are copied once per bucket that they share with the span of the
    rows' days, so an open end costs no copies beyond the last day.  Rows with
    a NULL key or day are spread over all tasks, as they meet nothing.
    """
    pairs = dict(keys)
    epoch = F.lit("1970-01-01").cast("date")
    span = rows.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()

    def bucket(d):
        return F.floor(F.datediff(d, epoch) / bucket_days).cast("int")
    w = windows.select(*[_q(c).alias(f"__w_{i}") for i, c in enumerate(pairs.values())], F.col(start).alias("__w_start"),
                       F.col(end).alias("__w_end"), *[_q(t).alias(f"__t_{t}") for t in take])
    w = w.where(reduce(lambda a, b: a & b, [F.col(f"__w_{i}").isNotNull() for i in range(len(pairs))])
                & (F.col("__w_start") <= F.col("__w_end")) & (F.col("__w_start") <= hi) & (F.col("__w_end") >= lo))
    w = w.withColumn("__w_bucket", F.explode(F.sequence(bucket(F.greatest("__w_start", lo)), bucket(F.least("__w_end", hi)))))
    if hint_broadcast:
        w = F.broadcast(w)
    absent = reduce(lambda a, b: a | b, [_q(c).isNull() for c in pairs], day.isNull())
    spread = [c for c, t in rows.dtypes if not t.startswith(("map", "variant"))]
    # a bucket below all others for rows that cannot match
    own = F.when(absent, -1_000_000 - F.pmod(F.xxhash64(*[_q(c) for c in spread]), F.lit(4096))).otherwise(bucket(day)).cast("int")
    x = rows.withColumn("__day", day).withColumn("__bucket", own)
    met = reduce(lambda a, b: a & b, [x[f"`{c}`"] == F.col(f"__w_{i}") for i, c in enumerate(pairs)])
    met = met & (F.col("__bucket") == F.col("__w_bucket")) & F.col("__day").between(F.col("__w_start"), F.col("__w_end"))
    return x.join(w, met, "left").select(*[_q(c) for c in rows.columns], *[F.col(f"__t_{t}").alias(t) for t in take])


def overlapping(windows: DataFrame, keys, start: str, end: str, partitions: int | None = None) -> DataFrame:
    """Windows that begin before an earlier one of the same keys has ended:
    all columns and ``covered_until``, the greatest end among the earlier ones
    (by start, then end, then the other columns).  A key with any number of
    windows is cut into ranges (``sequence.running``)."""
    keys = list(keys)
    rest = [c for c, t in windows.dtypes if c not in (*keys, start, end) and not t.startswith(("map", "variant"))]
    swept = sequence.running(windows.withColumn("__tie", F.monotonically_increasing_id()), keys, [start, end, *rest, "__tie"],
                             "covered_until", F.col(end), "max", before=True, partitions=partitions)
    return swept.where(F.col(start) <= F.col("covered_until")).drop("__tie")
