"""Driver-side path checks through the cluster's Hadoop filesystem.

Only metadata calls (exists, list, make, rename, delete) go through here; data
are always read and written by Spark tasks.
"""
from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def is_dir(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p) and fs.getFileStatus(p).isDirectory())


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p))


def make_dir(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, p = _fs(spark, old)
    if not fs.rename(p, _fs(spark, new)[1]):
        raise OSError(f"cannot rename {old} to {new}")


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))
