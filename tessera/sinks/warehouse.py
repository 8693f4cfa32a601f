"""Parquet tables per layer and schema.

A table is the folder ``<root>/<layer>/<schema>/<table>``, written and read by
Spark's own Parquet source; there is nothing else to it.  A load of one or
more tables first writes all of them to the shared folder, at the same time,
checks what was written together with what is there, and only then appends to
or overwrites the tables from it.  A load that breaks a constraint leaves the
tables untouched and its violation report under ``<schema>/_violations``.

One job at a time writes a schema, as for any folder that Spark overwrites; a
driver that dies between the writes of a load leaves some tables written, and
the load is run again as a replace.
"""
from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..contracts import COHORT_PREFIX, TableContract, tables
from ..operators.checks import fk_report, stacked_keys, validate_tables
from ..operators.columns import conform, default_value
from ..operators.navigate import cascade_survivors, following_rows
from ..session import scratch_path
from ..sources import fs


class ViolationsFound(Exception):
    """A load broke constraints.  ``totals`` has a row per table, constraint
    and columns with the number of broken keys and of rows; the full report
    (``checks.VIOLATION_COLUMNS``) stays at ``path``."""

    def __init__(self, totals, path: str):
        self.totals, self.path = totals, path
        super().__init__("constraint violations: " + "; ".join(
            f"{r['table_name']}.{r['columns']} {r['constraint_name']}: {r['n_keys']} keys, {r['n_rows']} rows"
            for r in totals) + f" (full report: {path})")


def schema_type_of(schema: str) -> str:
    if schema in ("shared", "orphan"):
        return schema
    if schema.startswith(COHORT_PREFIX):
        return "cohort"
    raise ValueError(f"{schema!r} is neither shared, orphan nor a cohort ({COHORT_PREFIX}...)")


def cluster_key(target: TableContract) -> list[str]:
    if "person_id" in target.column_names:
        return ["person_id"]
    return list(target.primary_key)


def together(spark: SparkSession, jobs: dict) -> dict:
    """Run independent Spark jobs at the same time; their results by name."""
    if len(jobs) < 2:
        return {name: job() for name, job in jobs.items()}
    with ThreadPoolExecutor(min(16, len(jobs))) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(job)) for name, job in jobs.items()}
        return {name: f.result() for name, f in running.items()}


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, layer: str = "bronze"):
        self.spark, self.root, self.layer = spark, root.rstrip("/"), layer

    # -- layout ---------------------------------------------------------
    def schema_path(self, schema: str) -> str:
        return f"{self.root}/{self.layer}/{schema}"

    def table_path(self, schema: str, table: str) -> str:
        return f"{self.schema_path(schema)}/{table}"

    def contracts(self, schema: str) -> dict[str, TableContract]:
        """The layer's table set for this schema (raises for unsupported)."""
        return tables(schema_type_of(schema), self.layer)

    def _require(self, schema: str) -> None:
        if not fs.exists(self.spark, self.schema_path(schema)):
            raise KeyError(f"{self.layer}.{schema} does not exist; create the schema first")

    # -- K7 / K8 / S8 ---------------------------------------------------
    def create_schema(self, schema: str) -> None:
        """K7: a folder for every table of the layer's contract, if absent."""
        for table in self.contracts(schema):
            fs.make_dir(self.spark, self.table_path(schema, table))

    def drop_schema(self, schema: str) -> None:
        """K8: drop a schema with all its tables, and its catalog entries."""
        self.spark.sql(f"DROP DATABASE IF EXISTS `{self.database(schema)}` CASCADE")
        fs.delete(self.spark, self.schema_path(schema))

    def schemas(self, prefix: str = "") -> list[str]:
        """Schemas of this layer, by prefix."""
        return [s for s in fs.list_names(self.spark, f"{self.root}/{self.layer}") if s.startswith(prefix)]

    def cohorts(self) -> list[str]:
        return self.schemas(COHORT_PREFIX)

    def tables(self, schema: str) -> list[str]:
        """The tables of the contract that the schema has."""
        there = set(fs.list_names(self.spark, self.schema_path(schema)))
        return [t for t in self.contracts(schema) if t in there]

    def has_rows(self, schema: str, table: str) -> bool:
        """Whether a table has data files (a listing, no job)."""
        return any(not n.startswith(("_", ".")) for n in fs.list_names(self.spark, self.table_path(schema, table)))

    # -- reads ----------------------------------------------------------
    def read(self, schema: str, table: str) -> DataFrame:
        target, path = self.contracts(schema)[table], self.table_path(schema, table)
        if not fs.exists(self.spark, path):
            raise KeyError(f"{self.layer}.{schema}.{table} does not exist; create the schema first")
        return self.spark.read.schema(target.spark_schema).parquet(path)

    def frames(self, schema: str) -> dict[str, DataFrame]:
        return {t: self.read(schema, t) for t in self.tables(schema)}

    # -- SQL access -----------------------------------------------------
    def database(self, schema: str) -> str:
        return f"{self.layer}_{schema}"

    def register(self, schema: str) -> str:
        """Make every table known to SQL as ``<layer>_<schema>.<table>`` (e.g.
        ``bronze_cohort_101.person``): external tables on the folders.
        Register again after a load, as Spark remembers a table's files."""
        db = self.database(schema)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
        for table in self.tables(schema):
            self.spark.sql(f"DROP TABLE IF EXISTS `{db}`.`{table}`")
            self.spark.sql(f"CREATE TABLE `{db}`.`{table}` ({self.contracts(schema)[table].ddl()}) USING PARQUET "
                           f"LOCATION '{self.table_path(schema, table)}'")
        return db

    def registered_cohorts(self) -> list[str]:
        """S8 through the catalog: registered cohort databases of this layer."""
        prefix = f"{self.layer}_{COHORT_PREFIX}"
        return sorted(d.name[len(self.layer) + 1:] for d in self.spark.catalog.listDatabases(f"{prefix}*"))

    # -- loads ----------------------------------------------------------
    def _write(self, schema: str, table: str, df: DataFrame, path: str, mode: str = "errorifexists") -> int:
        """Write rows with Spark; their number is an observed metric of the
        write itself (A1), not a second pass.  Rows are sorted inside each
        task by the table's cluster key (``person_id`` for clinical tables,
        else the primary key), so Parquet's statistics prune lookups and joins
        by that key; there is no extra shuffle."""
        key = cluster_key(self.contracts(schema)[table])
        if key:
            df = df.sortWithinPartitions(*key)
        seen = Observation(f"rows_{table}_{uuid.uuid4().hex[:8]}")
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(path)
        return int(seen.get["rows"])

    def require_clean(self, schema: str, report: DataFrame) -> None:
        """Write a violation report beside the schema's tables; raise with its
        totals if it has rows, else remove it."""
        path = f"{self.schema_path(schema)}/_violations/{uuid.uuid4().hex}"
        seen = Observation(f"violations_{uuid.uuid4().hex[:8]}")
        report.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
        if not seen.get["rows"]:
            fs.delete(self.spark, path)
            return
        # one row per declared constraint at most
        totals = (self.spark.read.parquet(path).groupBy("table_name", "constraint_name", "columns")
                  .agg(F.count(F.lit(1)).alias("n_keys"), F.sum("n").alias("n_rows"))
                  .orderBy("table_name", "constraint_name", "columns").collect())
        raise ViolationsFound(totals, path)

    def commit(self, schema: str, writes: dict[str, DataFrame], mode: str = "append", check: bool = True,
               parents: dict[str, DataFrame] | None = None) -> dict[str, int]:
        """Write every frame to the shared folder, check the tables as they
        would become, then append to (K1) or overwrite (K2 and every rewrite)
        them.  Returns rows written per table.  An overwritten table is also
        checked against the tables that refer to it."""
        contracts = self.contracts(schema)
        self._require(schema)
        for table in writes:
            if table not in contracts:
                raise KeyError(f"{self.layer}.{schema} has no table {table!r}")
        rows = {t: conform(df, contracts[t]) for t, df in writes.items()}
        if mode == "append" and not check:  # nothing to wait for
            return together(self.spark, {t: lambda t=t: self._write(schema, t, rows[t], self.table_path(schema, t), "append") for t in rows})
        staged = {t: scratch_path(self.spark, t) for t in rows}
        try:
            counts = together(self.spark, {t: lambda t=t: self._write(schema, t, rows[t], staged[t]) for t in rows})
            new = {t: self.spark.read.schema(contracts[t].spark_schema).parquet(path) for t, path in staged.items()}
            if check:
                append = mode == "append"
                whole = {t: self.read(schema, t).unionByName(df) if append and self.has_rows(schema, t) else df for t, df in new.items()}
                known = {**self._parents(schema), **whole, **(parents or {})}
                report = validate_tables(whole, {t: contracts[t] for t in whole}, parents=known, new_rows=new if append else None)
                for orphans in [] if append else self._left_behind(schema, whole):
                    report = report.unionByName(orphans)
                self.require_clean(schema, report)
            together(self.spark, {t: lambda t=t: new[t].write.mode(mode).parquet(self.table_path(schema, t)) for t in new})
            return counts
        finally:
            for path in staged.values():
                fs.delete(self.spark, path)

    def _parents(self, schema: str) -> dict[str, DataFrame]:
        """Tables that this schema's keys may refer to: its own, and those of
        the shared schema."""
        out = self.frames(schema)
        if schema != "shared":
            wanted = {fk.ref_table for c in self.contracts(schema).values() for fk in c.foreign_keys} - set(out)
            out.update({t: self.read("shared", t) for t in self.tables("shared") if t in wanted})
        return out

    def _referring(self, schema: str, table: str):
        """(schema, child table, foreign keys) of the tables with rows that
        refer to a table of ``schema``; shared tables are referred to from
        every schema of the layer."""
        for s in (self.schemas() if schema == "shared" else [schema]):
            for child, c in self.contracts(s).items():
                keys = [fk for fk in c.foreign_keys if fk.ref_table == table]
                if keys and (s == schema or table not in self.contracts(s)) and self.has_rows(s, child):
                    yield s, child, keys

    def _left_behind(self, schema: str, changed: dict[str, DataFrame]):
        """Reports on keys of unchanged tables that would no longer have a parent."""
        for table, parent in changed.items():
            for s, child, keys in self._referring(schema, table):
                if s != schema or child not in changed:
                    columns = [c for fk in keys for c in fk.columns]
                    yield fk_report({child: self.read(s, child)}, parent, keys[0].ref_columns[0], {child: columns}, table)

    def _still_referred_to(self, schema: str, kept: dict, gone: dict):
        """Reports on kept rows that refer to rows about to go."""
        for table, lost in gone.items():
            for s, child, keys in self._referring(schema, table):
                rows = kept[child] if s == schema and child in kept else self.read(s, child)
                ref = keys[0].ref_columns[0]
                lost_keys = lost.select(F.col(ref).alias("key")).distinct()
                stacked = stacked_keys(rows, [c for fk in keys for c in fk.columns], dict(lost.dtypes)[ref])
                yield stacked.join(lost_keys.hint("merge"), "key").select(
                    F.lit(child).alias("table_name"), F.lit(f"foreign_key:{table}.{ref}").alias("constraint_name"),
                    F.col("column").alias("columns"), F.col("key").cast("string").alias("key"), "n")

    # -- K1 / K2 / K3 / K5 / K6 ----------------------------------------
    def append(self, schema: str, writes: dict[str, DataFrame], check: bool = True) -> dict[str, int]:
        return self.commit(schema, writes, "append", check)

    def replace(self, schema: str, writes: dict[str, DataFrame], check: bool = True) -> dict[str, int]:
        return self.commit(schema, writes, "overwrite", check)

    def upsert(self, schema: str, table: str, source: DataFrame, key: str, update_cols,
               preserve=("created_at",), touch: str | None = "updated_at") -> dict[str, int]:
        """K3 through the sink: merge ``source`` into the table."""
        merged = upsert_frames(self.read(schema, table), source, key, update_cols, preserve, touch, self.contracts(schema)[table])
        return self.replace(schema, {table: merged})

    def delete_where(self, schema: str, table: str, predicate) -> int:
        """K6: remove rows matching ``predicate``; rows where it is NULL stay."""
        return self.delete_rows(schema, {table: predicate})[table]

    def delete_rows(self, schema: str, predicates: dict) -> dict[str, int]:
        """Remove the rows matching each table's predicate.  Rows that
        refer to a removed one go too where their key is declared ON DELETE
        CASCADE (and so on from there); any other reference that would be left
        without its parent fails the delete (RESTRICT).  Returns rows removed
        per table, those of cascades included."""
        contracts, kept, gone = self.contracts(schema), {}, {}
        for table, predicate in predicates.items():
            current = self.read(schema, table)
            hit = F.coalesce(predicate, F.lit(False))
            kept[table], gone[table] = current.where(~hit), current.where(hit)
        todo = list(predicates)
        while todo:  # at most once per declared cascade
            table = todo.pop()
            for s, child, keys in self._referring(schema, table):
                for fk in keys:
                    if not fk.cascade or s != schema or child == table:
                        continue
                    rows = kept.get(child, self.read(schema, child))
                    lost = following_rows(rows, gone[table], list(fk.columns), list(fk.ref_columns))
                    kept[child] = cascade_survivors(rows, gone[table], list(fk.columns), list(fk.ref_columns))
                    gone[child] = gone[child].unionByName(lost) if child in gone else lost
                    todo.append(child)
        reports = list(self._still_referred_to(schema, kept, gone))
        if reports:
            self.require_clean(schema, reduce(lambda a, b: a.unionByName(b), reports))
        before = together(self.spark, {t: self.read(schema, t).count for t in kept if t in contracts})
        after = self.replace(schema, kept, check=False)
        return {t: before[t] - after[t] for t in kept}


def upsert_frames(target: DataFrame, source: DataFrame, key: str, update_cols,
                  preserve=("created_at",), touch: str | None = "updated_at",
                  contract: TableContract | None = None) -> DataFrame:
    """INSERT ... ON CONFLICT (key) DO UPDATE as a full outer join.

    Matched rows take the source's ``update_cols`` (except ``preserve``) and
    get ``touch`` refreshed; unmatched source rows are inserted with declared
    defaults for the columns the source lacks; other target rows are kept.
    Keys are unique on both sides (checked by the caller), so the join is
    1:1 and cannot skew.
    """
    update_cols = [c for c in update_cols if c != key]
    s = source.select(F.col(key).alias("_s_key"), *[F.col(c).alias(f"_s_{c}") for c in update_cols],
                      F.lit(True).alias("_s_present"))
    t = target.withColumn("_t_present", F.lit(True))
    j = t.join(s, t[key] == s["_s_key"], "full_outer")
    present, in_target = F.col("_s_present").isNotNull(), F.col("_t_present").isNotNull()
    out = []
    for c in target.columns:
        spec = contract.column(c) if contract is not None and c in contract.column_names else None
        dtype = dict(target.dtypes)[c]
        if c == key:
            v = F.coalesce(t[key], F.col("_s_key"))
        elif c in update_cols and c not in preserve:
            v = F.when(present, F.col(f"_s_{c}")).otherwise(t[c])
        elif c in update_cols:  # preserved: kept on update, taken on insert
            v = F.when(in_target, t[c]).otherwise(F.col(f"_s_{c}"))
        elif c == touch:
            v = F.when(present, F.localtimestamp()).otherwise(t[c])
        else:
            default = default_value(spec) if spec is not None else F.lit(None)
            v = F.when(in_target, t[c]).otherwise(default)
        out.append(v.cast(dtype).alias(c))
    return j.select(*out)
