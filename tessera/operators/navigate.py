"""Navigation joins generated from declared foreign keys.

All navigations are equi-joins.  No side is forced to broadcast: a parent is
broadcast only when AQE has measured it at runtime below
``spark.sql.autoBroadcastJoinThreshold``; otherwise the join is a sort-merge
join whose skewed partitions AQE splits.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import navigations


def _q(c: str):
    return F.col(f"`{c}`")


def many_to_one(child: DataFrame, parent: DataFrame, fk, pk, take=None, prefix: str = "",
                how: str = "left") -> DataFrame:
    """Each child row with its parent's columns (0 or 1 parent per row).

    ``take`` selects the parent columns to bring (default: all but the key);
    they are renamed with ``prefix``.  Only the key and the taken columns are
    read from the parent, so the scan is pruned.

    In a left join, rows whose key may be NULL find no parent but would all be
    sent to one task; a second join key, which numbers such rows by a hash and
    is 0 for all others, spreads them.
    """
    fk, pk = ([fk] if isinstance(fk, str) else list(fk)), ([pk] if isinstance(pk, str) else list(pk))
    take = [c for c in (take if take is not None else parent.columns) if c not in pk]
    right = parent.select(*[_q(p).alias(f"__k{i}") for i, p in enumerate(pk)],
                          *[_q(c).alias(prefix + c) for c in take])
    keys = [f"__k{i}" for i in range(len(pk))]
    cond = reduce(lambda a, b: a & b, [child[f"`{f}`"] == right[k] for f, k in zip(fk, keys)])
    optional = [f for f in fk if child.schema[f].nullable]
    if how == "left" and optional:
        plain = [c for c, t in child.dtypes if c not in fk and not t.startswith(("map", "variant"))][:3]  # enough, and read anyway
        absent = reduce(lambda a, b: a | b, [_q(f).isNull() for f in optional])
        child = child.withColumn("__spread", F.when(absent, 1 + F.pmod(F.xxhash64(*[_q(c) for c in plain or fk]), F.lit(4096))).otherwise(0))
        # 0 for every key; not a constant, which Spark would take out of the join
        right = right.withColumn("__zero", F.when(_q("__k0").isNull(), F.lit(-1).cast("long")).otherwise(F.lit(0).cast("long")))
        cond = reduce(lambda a, b: a & b, [child[f"`{f}`"] == right[k] for f, k in zip(fk, keys)]) & (child["__spread"] == right["__zero"])
    return child.join(right, cond, how).drop(*keys, "__spread", "__zero")


def _ordered(*cols):
    out = []
    for c in cols:
        if c not in out:
            out.append(c)
    return out


def path(child: DataFrame, hops) -> DataFrame:
    """J1 along a chain of N:1 hops, e.g. lineitem -> orders -> customer.

    ``hops`` is a list of (parent_df, fk, pk, take) with single-column keys;
    the first ``fk`` is a column of ``child``, each later one a column of the
    previous parent.  The chain is assembled from the far end (customer into
    orders, then the result into lineitem).  For left joins on parent keys
    that is the same result, and the largest table is shuffled once instead
    of once per hop.
    """
    acc, acc_fk, acc_pk, acc_take = None, None, None, []
    for parent, fk, pk, take in reversed(list(hops)):
        take = [c for c in take if c != pk]
        if acc is None:
            base, all_take = parent.select(*_ordered(pk, *take)), take
        else:
            base = many_to_one(parent.select(*_ordered(pk, *take, acc_fk)), acc, acc_fk, acc_pk, acc_take)
            base = base.select(*_ordered(pk, *take, *acc_take))
            all_take = _ordered(*take, *acc_take)
        acc, acc_fk, acc_pk, acc_take = base, fk, pk, all_take
    return many_to_one(child, acc, acc_fk, acc_pk, acc_take)


def one_to_many(parent: DataFrame, child: DataFrame, pk, fk, take=None, prefix: str = "") -> DataFrame:
    """Each parent row repeated per child (parent kept once with NULLs
    when it has none).  Children are flattened rows, never collected into a
    list per parent, so a parent with millions of children is not one cell."""
    return many_to_one(parent, child, pk, fk, take, prefix, how="left")


def child_counts(parent: DataFrame, child: DataFrame, pk, fk, count_col: str = "n_children") -> DataFrame:
    """J2 summary: children per parent, 0 when none.  Children are counted
    per key map-side first, so only one row per key and task is shuffled and
    the join is 1:1."""
    pk = [pk] if isinstance(pk, str) else list(pk)
    fk = [fk] if isinstance(fk, str) else list(fk)
    counts = (child.where(reduce(lambda a, b: a & b, [_q(c).isNotNull() for c in fk]))
                   .groupBy(*[_q(c) for c in fk]).agg(F.count(F.lit(1)).alias(count_col)))
    joined = many_to_one(parent, counts, pk, fk, [count_col])
    return joined.withColumn(count_col, F.coalesce(F.col(count_col), F.lit(0)).cast("long"))


def self_many_to_one(df: DataFrame, fk: str, pk: str, take, prefix: str,
                     parent: DataFrame | None = None) -> DataFrame:
    """Self reference (e.g. preceding visit): the referenced row's columns
    under ``prefix``.  ``parent`` is the stored table when ``df`` is derived
    from it (e.g. a computed reference), so the referenced side is a pruned
    scan instead of a second evaluation of the derivation."""
    return many_to_one(df, df if parent is None else parent, fk, pk, take, prefix)


def self_one_to_many(df: DataFrame, fk: str, pk: str, take, prefix: str,
                     parent: DataFrame | None = None) -> DataFrame:
    """Reverse self reference: rows that point at this row (``parent``
    as in ``self_many_to_one``)."""
    return many_to_one(df, df if parent is None else parent, pk, fk, take, prefix)


def cascade_survivors(child: DataFrame, deleted_parent_keys: DataFrame, fk, pk) -> DataFrame:
    """After parents are deleted, child rows whose parent went are
    deleted too (ON DELETE CASCADE); returns the surviving child rows."""
    fk, pk = ([fk] if isinstance(fk, str) else list(fk)), ([pk] if isinstance(pk, str) else list(pk))
    keys = deleted_parent_keys.select(*[_q(p).alias(f) for p, f in zip(pk, fk)]).distinct()
    return child.join(keys, fk, "left_anti")


def following_rows(child: DataFrame, parent: DataFrame, fk, pk) -> DataFrame:
    """J7 semi form: child rows whose parent is in ``parent``."""
    fk, pk = ([fk] if isinstance(fk, str) else list(fk)), ([pk] if isinstance(pk, str) else list(pk))
    keys = parent.select(*[_q(p).alias(f) for p, f in zip(pk, fk)])
    return child.join(keys, fk, "left_semi")


def navigate(frames: dict[str, DataFrame], table: str, name: str, take=None,
             schema_type: str = "cohort", layer: str = "bronze") -> DataFrame:
    """Follow a declared navigation by its model name, in either direction:
    ``navigate(frames, 'visit_occurrence', 'person')`` (N:1) or
    ``navigate(frames, 'person', 'visit_occurrence')`` (1:N)."""
    for child, fk, parent, forward, reverse in navigations(schema_type, layer):
        col, ref = fk.columns[0], fk.ref_columns[0]
        if child == table and forward == name:
            return many_to_one(frames[child], frames[parent], col, ref, take, prefix=f"{name}__")
        if parent == table and reverse == name:
            return one_to_many(frames[parent], frames[child], ref, col, take, prefix=f"{name}__")
    raise KeyError(f"{table} has no navigation {name!r}")
