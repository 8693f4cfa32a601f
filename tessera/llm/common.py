"""Helpers shared by the corpus operators."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back: cuts the lineage
    and survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame, rows: int = 1000, size: str = "8m") -> None:
    """From here on, Python tasks of the session get batches of this many rows
    and bytes at most: rows with long texts take much room."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def without(df: DataFrame, names) -> DataFrame:
    """``df`` without input columns whose names an operator is about to add
    (names compare case-insensitively, as in Spark)."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once: an expression used
    several times inside lambdas is otherwise evaluated at every use."""
    return F.element_at(F.transform(F.array(value), body), 1)


def md5_key(key) -> Column:
    """Order and bucket key: the same text on every engine, null as ''."""
    return F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))


#: what rows without a key are ordered by, and the buckets that they are dealt to
_NO_KEY = "d41d8cd98f00b204e9800998ecf8427e"  # md5 of an empty text
SPREAD = 4096


def number_in_groups(df: DataFrame, groups: list[str], key: str, out: str, apart: Column | None = None) -> DataFrame:
    """Add ``out``: 0, 1, 2 ... within each group, in the order of md5(key).

    A group may hold any share of all rows, so no window sees a whole group:
    rows are numbered inside 4,096 md5 buckets of a group and each bucket's
    offset comes from a prefix sum over the bucket counts.  Rows with equal
    keys are ordered by their other columns.  Rows without a key, of which
    there may be very many, come where an empty text would and are dealt to
    SPREAD buckets of their own, by ``apart``: an expression with the same
    value for a row whenever ``df`` is read, by default a hash of the other
    columns, which leaves rows that are equal throughout in one bucket.
    """
    other = [c for c, t in df.dtypes if c != key and c not in groups and not t.startswith(("map", "variant"))]
    at = F.struct(*[F.col(c) for c in groups])
    none = F.coalesce(F.col(key).cast("string"), F.lit("")) == ""
    apart = apart if apart is not None else F.xxhash64(*[F.col(f"`{c}`") for c in other] or [F.lit(0)])
    prefix = F.substring("__t_md5", 1, 3)
    # in the order of md5: before the rows without a key, these, and behind them
    bucket = (F.when(none, F.concat(F.lit(_NO_KEY), F.lpad(F.pmod(apart, F.lit(SPREAD)).cast("string"), 4, "0")))
              .when((prefix == _NO_KEY[:3]) & (F.col("__t_md5") > _NO_KEY), F.concat(prefix, F.lit("f"))).otherwise(prefix))
    # one struct to deal by: the window and the join need the same dealing, and NULLs are equal in it
    df = df.withColumn("__t_md5", md5_key(key)).withColumn("__t_at", F.struct(at.alias("group"), bucket.alias("bucket")))
    order = ["__t_md5", *[F.col(f"`{c}`") for c in other]]
    local = df.withColumn("__t_local", F.row_number().over(Window.partitionBy("__t_at").orderBy(*order)) - 1)
    before = Window.partitionBy("__t_at.group").orderBy("__t_at.bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (df.groupBy("__t_at").agg(F.count(F.lit(1)).alias("__t_n"))
               .select("__t_at", F.coalesce(F.sum("__t_n").over(before), F.lit(0)).alias("__t_before")))
    return (local.join(offsets, "__t_at").withColumn(out, (F.col("__t_local") + F.col("__t_before")).cast("long"))
            .drop("__t_md5", "__t_at", "__t_local", "__t_before"))
