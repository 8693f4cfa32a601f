"""Constraint checks over loaded rows.

Parquet tables enforce no key, foreign key or NOT NULL constraint, so every
check is a query.  Two forms exist:

* row-level helpers (``duplicate_keys``, ``fk_violation_rows``, ...) return
  the offending rows or keys in the input's own columns;
* ``*_report`` functions return one common shape, ``VIOLATION_COLUMNS``, so a
  whole layer's violations union into one DataFrame.

Scale notes: every check aggregates map-side before it shuffles (a hot key
collapses to one row per task), FK checks deduplicate child keys before they
meet the parent keys and stack all FK columns of a child that point to one
parent into a single scan, ``validate_tables`` reads a table twice however
many keys it has, and of wide (string) keys only candidate duplicates move
with their full text.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import TableContract
from ..session import cut_lineage

VIOLATION_COLUMNS = ["table_name", "constraint_name", "columns", "key", "n"]


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _report(df: DataFrame, table: str, constraint: str, cols, key: Column, n: Column) -> DataFrame:
    return df.select(F.lit(table).alias("table_name"), F.lit(constraint).alias("constraint_name"),
                     F.lit(",".join(cols)).alias("columns"), key.cast("string").alias("key"),
                     n.cast("long").alias("n"))


def empty_report(spark) -> DataFrame:
    schema = T.StructType([T.StructField("table_name", T.StringType()),
                           T.StructField("constraint_name", T.StringType()),
                           T.StructField("columns", T.StringType()),
                           T.StructField("key", T.StringType()),
                           T.StructField("n", T.LongType())])
    return spark.createDataFrame([], schema)


def _key_json(cols) -> Column:
    return F.to_json(F.struct(*[_q(c) for c in cols]))


def _is_wide(df: DataFrame, cols) -> bool:
    types = dict(df.dtypes)
    return any(types[c] in ("string", "binary") or types[c].startswith("varchar") for c in cols)


# --- C1 / C3 ---------------------------------------------------------------

def duplicate_keys(df: DataFrame, cols, count_col: str = "n", skip_nulls: bool = False) -> DataFrame:
    """Key values that occur more than once, with their count.

    ``skip_nulls`` exempts rows with a NULL key part (unique-constraint
    semantics).  Text keys are first counted by a 64-bit hash.  The hashes that
    repeat are written and counted, and become a bitmap of BITS_PER_VALUE bits
    for each; only rows whose bit is set are shuffled and grouped by their full
    value, which is exact.  Of rows that do not repeat, one in BITS_PER_VALUE
    passes, however many values do.  Without repeated hashes nothing else runs;
    beyond MOST_REPEATED of them a semi join takes the place of the bitmap.
    """
    cols = list(cols)
    src = df.select(*[_q(c) for c in cols])
    if skip_nulls:
        src = src.where(reduce(lambda a, b: a & b, [_q(c).isNotNull() for c in cols]))
    if _is_wide(df, cols):
        h = F.xxhash64(*[_q(c) for c in cols])
        repeated = cut_lineage(src.groupBy(h.alias("_h")).count().where("count > 1").select("_h"), "repeated")
        n = repeated.count()
        if n > MOST_REPEATED:
            src = src.withColumn("_h", h).join(repeated, "_h", "left_semi").drop("_h")
        else:
            src = src.where(may_be_among(h, repeated, "_h", n))
    return (src.groupBy(*[_q(c) for c in cols]).agg(F.count(F.lit(1)).alias(count_col))
               .where(F.col(count_col) > 1))


#: bits of the bitmap per repeated hash, and hashes for which there is one (16 MB)
BITS_PER_VALUE, MOST_REPEATED = 16, 1 << 23


def _bit_place(h: Column, bits: int) -> tuple[Column, Column]:
    at = F.pmod(h, F.lit(bits))
    return F.floor(at / 64).cast("int"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int"))


def _bitmap(hashes: DataFrame, col: str, bits: int) -> Column:
    """Bitmap of the hashes as one array of 64-bit words (a scalar subquery)."""
    word, bit = _bit_place(F.col(col), bits)
    words = hashes.groupBy(word.alias("_w")).agg(F.bit_or(bit).alias("_b"))
    every = hashes.sparkSession.range(bits // 64).join(words, F.col("id") == F.col("_w"), "left")
    return every.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", F.coalesce("_b", F.lit(0).cast("long")).alias("b")))),
                                 lambda x: x["b"])).scalar()


def may_be_among(h: Column, hashes: DataFrame, col: str, n: int) -> Column:
    """Whether a 64-bit hash is among ``n`` written ones, or one of the few
    others (one in BITS_PER_VALUE) that the bitmap lets pass; everything passes
    where there are more than MOST_REPEATED."""
    if n == 0 or n > MOST_REPEATED:
        return F.lit(n > 0)
    bits = max(1 << 16, BITS_PER_VALUE * n) // 64 * 64
    word, bit = _bit_place(h, bits)
    return F.get(_bitmap(hashes, col, bits), word).bitwiseAND(bit) != 0


def null_key_rows(df: DataFrame, cols) -> DataFrame:
    return df.where(reduce(lambda a, b: a | b, [_q(c).isNull() for c in cols]))


def pk_report(df: DataFrame, target: TableContract, pk=None, include_nulls: bool = True) -> DataFrame:
    """Primary key must be unique and not NULL.

    Duplicates are counted over rows whose key has no NULL part
    (``IsNotNull`` reaches the Parquet reader); the NULL-key branch pushes
    ``IsNull`` down, so row groups whose statistics show no NULLs are
    skipped.  ``include_nulls=False`` leaves NULL keys to the NOT NULL column
    check when that runs anyway.
    """
    pk = list(pk or target.primary_key)
    notnull = reduce(lambda a, b: a & b, [_q(c).isNotNull() for c in pk])
    dup = duplicate_keys(df.where(notnull), pk)
    out = _report(dup, target.name, "primary_key", pk, _key_json(pk), F.col("n"))
    if include_nulls:
        nulls = null_key_rows(df, pk).agg(F.count(F.lit(1)).alias("n")).where("n > 0")
        out = out.unionByName(_report(nulls, target.name, "primary_key_null", pk, F.lit(None), F.col("n")))
    return out


def unique_report(df: DataFrame, target: TableContract, cols) -> DataFrame:
    """Rows with a NULL key part are exempt, as in SQL."""
    dup = duplicate_keys(df, cols, skip_nulls=True)
    return _report(dup, target.name, "unique", cols, _key_json(cols), F.col("n"))


# --- C2 --------------------------------------------------------------------

def fk_violation_rows(child: DataFrame, parent: DataFrame, fk, pk) -> DataFrame:
    """Child rows whose non-NULL key has no parent row.

    The NOT NULL filter matters: ``left_anti`` keeps NULL keys while SQL
    foreign keys ignore them.  A hot child key is split by AQE's skew-join
    handling, which covers anti-joins.
    """
    fk, pk = list(fk), list(pk)
    # no distinct() on the parent: repeated parent keys do not change an
    # anti-join's result (and are reported by the parent's key check)
    keys = parent.select(*[_q(p).alias(f) for p, f in zip(pk, fk)])
    notnull = reduce(lambda a, b: a & b, [_q(c).isNotNull() for c in fk])
    return child.where(notnull).join(keys, fk, "left_anti")


def stacked_keys(child: DataFrame, columns, key_type: str | None = None) -> DataFrame:
    """All single-column FK values of one child as (column, key, n), one scan
    and one map-side-combined aggregation instead of one scan per column."""
    columns = list(columns)
    key_type = key_type or dict(child.dtypes)[columns[0]]
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), _q(c).cast(key_type).alias("key"))
                                for c in columns]))
    return (child.select(pairs.alias("p")).select("p.column", "p.key")
                 .where(F.col("key").isNotNull())
                 .groupBy("column", "key").agg(F.count(F.lit(1)).alias("n")))


#: keys that one task of a join of keys is to hold
KEYS_PER_TASK = 1_000_000


def _key_tasks(frames: list[DataFrame]) -> int:
    """Tasks for a join of the frames' keys: by their rows (Parquet counts them
    from its footers), as key columns compress so well that AQE, which goes by
    bytes, gives a task more keys the larger the table is."""
    rows = _all_of([df.select(F.lit(1).alias("_one")) for df in frames]).count()
    return max(1, -(-rows // KEYS_PER_TASK))


def fk_report(children: dict[str, DataFrame], parent: DataFrame, parent_key: str,
              edges: dict[str, list[str]], parent_name: str,
              parent_keys: DataFrame | None = None) -> DataFrame:
    """C2 for many children and columns referencing one parent key.

    ``edges`` maps child table -> FK columns.  All keys are stacked and
    deduplicated per (table, column, key) before a single join against the
    parent keys, so a skewed concept id costs one row per task.
    ``parent_keys`` (one column named ``parent_key``) replaces a fresh scan
    of the parent, e.g. the grouping its key check already defines.
    """
    parts = []
    for table, cols in edges.items():
        if not cols:
            continue
        ktype = dict(parent.dtypes)[parent_key]
        parts.append(stacked_keys(children[table], cols, ktype).withColumn("table_name", F.lit(table)))
    if not parts:
        return empty_report(parent.sparkSession)
    tasks = _key_tasks([parent, *[children[t] for t, cols in edges.items() for _ in cols]])
    stacked = reduce(lambda a, b: a.unionByName(b), parts).repartition(tasks, "key")
    if parent_keys is not None:  # already one row per key
        keys = parent_keys.select(_q(parent_key).alias("key")).repartition(tasks, "key")
    else:
        keys = parent.select(_q(parent_key).alias("key")).where(F.col("key").isNotNull()).repartition(tasks, "key").distinct()
    # A left join on unique parent keys plus a NULL filter, not a left_anti
    # join: the optimizer pushes anti-joins below the aggregation of the
    # stacked keys, which would join every child row instead of one row per
    # distinct key.
    # Merged, never broadcast: the keys are as many as the parent's rows, and
    # checks of several schemas run at the same time in one driver.
    missing = (stacked.join(keys.withColumn("_parent", F.lit(True)).hint("merge"), "key", "left")
                      .where(F.col("_parent").isNull()))
    return missing.select(
        "table_name", F.concat(F.lit(f"foreign_key:{parent_name}.{parent_key}")).alias("constraint_name"),
        F.col("column").alias("columns"), F.col("key").cast("string").alias("key"),
        F.col("n").cast("long").alias("n"))


# --- C4 / C5 ---------------------------------------------------------------

def not_null_violation_rows(df: DataFrame, cols) -> DataFrame:
    """C4 row form: rows with a NULL in any of ``cols``."""
    return null_key_rows(df, cols)


def length_violation_rows(df: DataFrame, col: str, max_len: int, keep=()) -> DataFrame:
    """C5 row form: rows whose text is longer than ``max_len`` characters."""
    return (df.where(F.length(_q(col)) > max_len)
              .select(*[_q(k) for k in keep], F.length(_q(col)).alias("len")))


def column_report(df: DataFrame, target: TableContract) -> DataFrame:
    """C4 + C5 for every column in one pass: a single global aggregation
    (partial per task, one tiny final merge) counting NULLs in NOT NULL
    columns and over-long VARCHAR values, unpivoted to report rows."""
    have = set(df.columns)
    probes = []
    for c in target.columns:
        if c.name not in have:
            continue
        if not c.nullable:
            probes.append(("not_null", c.name, F.count_if(_q(c.name).isNull())))
        if c.kind == "vc" and c.length:
            probes.append((f"max_length_{c.length}", c.name, F.count_if(F.length(_q(c.name)) > c.length)))
    if not probes:
        return empty_report(df.sparkSession)
    agg = df.agg(*[p[2].alias(f"p{i}") for i, p in enumerate(probes)])
    rows = F.explode(F.array(*[F.struct(F.lit(kind).alias("k"), F.lit(col).alias("c"),
                                        F.col(f"p{i}").alias("n"))
                               for i, (kind, col, _) in enumerate(probes)]))
    return (agg.select(rows.alias("r"))
               .select(F.lit(target.name).alias("table_name"), F.col("r.k").alias("constraint_name"),
                       F.col("r.c").alias("columns"), F.lit(None).cast("string").alias("key"),
                       F.col("r.n").cast("long").alias("n"))
               .where("n > 0"))


# --- C6 --------------------------------------------------------------------

def _all_of(frames: list[DataFrame]) -> DataFrame:
    """Union of frames with the same columns, in pairs: each union is analysed
    with all below it, so a chain of them takes long to build."""
    while len(frames) > 1:
        frames = [frames[i].union(frames[i + 1]) if i + 1 < len(frames) else frames[i] for i in range(0, len(frames), 2)]
    return frames[0]


def row_checks(df: DataFrame, target: TableContract) -> DataFrame | None:
    """What the rows of one table show by themselves, in one scan and one
    aggregation: (table_name, constraint_name, parent, columns, key, n) with a
    row per missing value and over-long text column (C4, C5; parent and key
    NULL) and one per distinct foreign key value (C2; not yet looked up)."""
    have = set(df.columns)
    names, found = [], []

    def probe(when: Column, constraint: str, column: str, parent: str | None = None, key: Column | None = None):
        found.append(F.when(when, F.struct(F.lit(len(names)).alias("probe"),
                                           (F.lit(None) if key is None else key).cast("string").alias("key"))))
        names.append((constraint, parent, column))
    for c in target.columns:
        if c.name in have and not c.nullable:
            probe(_q(c.name).isNull(), "not_null", c.name)
        if c.name in have and c.kind == "vc" and c.length:
            probe(F.length(_q(c.name)) > c.length, f"max_length_{c.length}", c.name)
    for fk in target.foreign_keys:
        for col in fk.columns:
            probe(_q(col).isNotNull(), f"foreign_key:{fk.ref_table}.{fk.ref_columns[0]}", col,
                  f"{fk.ref_table}.{fk.ref_columns[0]}", _q(col))
    if not found:
        return None
    rows = df.select(F.explode(F.array(*found)).alias("r")).where(F.col("r").isNotNull()).select("r.probe", "r.key")
    counted = rows.groupBy("probe", "key").agg(F.count(F.lit(1)).alias("n"))

    def named(i):
        return F.get(F.array(*[F.lit(x[i]).cast("string") for x in names]), F.col("probe"))
    return counted.select(F.lit(target.name).alias("table_name"), named(0).alias("constraint_name"), named(1).alias("parent"),
                          named(2).alias("columns"), "key", "n")


def validate_tables(frames: dict[str, DataFrame], contracts: dict[str, TableContract],
                    parents: dict[str, DataFrame] | None = None,
                    new_rows: dict[str, DataFrame] | None = None) -> DataFrame:
    """All checks for a set of staged tables: keys, uniques, column checks and
    foreign keys (looked up among all tables staged, so circular references
    such as concept <-> domain resolve).

    Each table is read once for its key and once for everything its rows show
    (``row_checks``); the distinct foreign key values of all tables then meet
    the distinct keys of all their parents in a single join.

    ``parents`` supplies referenced tables that are not part of ``frames``
    (e.g. shared tables for a cohort load); a referenced table that is in
    neither is an error.  ``new_rows`` (appends) limits the row-local checks to
    the appended rows - published rows passed them and parents only grow - and
    the key and unique checks to keys that occur among them.
    """
    spark = next(iter(frames.values())).sparkSession
    lookup = dict(parents or {})
    lookup.update(frames)
    new_rows = new_rows or {}
    reports, rows, wanted = [], [], {}
    for name, df in frames.items():
        t = contracts[name]
        local = new_rows.get(name, df)

        def among_new(cols):
            if name not in new_rows:
                return df
            keys = local.select(*[_q(c) for c in cols]).distinct()
            return df.select(*[_q(c) for c in cols]).join(keys.hint("merge"), list(cols), "left_semi")
        if t.primary_key:
            pk = list(t.primary_key)
            # PK columns are NOT NULL columns: the row checks count NULLs
            nulls_checked = all(not t.column(c).nullable for c in pk)
            reports.append(pk_report(among_new(pk), t, include_nulls=not nulls_checked))
        for u in t.uniques:
            reports.append(unique_report(among_new(u), t, u))
        for fk in t.foreign_keys:
            if fk.ref_table not in lookup:
                raise KeyError(f"{name}.{','.join(fk.columns)} refers to {fk.ref_table}, which is neither checked nor given as a parent")
            wanted[(fk.ref_table, fk.ref_columns[0])] = lookup[fk.ref_table]
        found = row_checks(local, t)
        if found is not None:
            rows.append(found)
    if rows:
        stacked = _all_of(rows)
        if wanted:
            keys = _all_of([
                df.select(F.lit(f"{parent}.{key}").alias("parent"), _q(key).cast("string").alias("key"))
                  .where(F.col("key").isNotNull()).distinct().withColumn("_there", F.lit(True))
                for (parent, key), df in wanted.items()])
            # a left join on unique keys, not left_anti, and merged: see fk_report
            stacked = stacked.join(keys.hint("merge"), ["parent", "key"], "left").where(F.col("parent").isNull() | F.col("_there").isNull())
        reports.append(stacked.select(*VIOLATION_COLUMNS))
    return _all_of(reports) if reports else empty_report(spark)
