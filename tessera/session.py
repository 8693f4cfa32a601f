"""Session construction and shared-storage helpers.

Everything that needs durable scratch space (lineage cuts, staged writes in
the driver queries) goes under the folder the cluster names in
``spark.checkpoint.dir``.  A local fallback is only set when that setting is
absent, which is the situation in unit tests and on a laptop.
"""
from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job in the library relies on.  AQE coalesces small shuffle
# partitions, converts joins to broadcast only after measuring the built side
# at runtime and splits skewed join partitions; ANSI mode makes bad casts
# raise instead of producing NULL, which is what strict loads need.
_CORE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[*]", app: str = "tessera",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(_CORE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.driver.memory"] = os.environ.get("TESSERA_DRIVER_MEMORY", "16g")
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session."""
    for k, v in _CORE_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static or locked settings keep their value
            pass


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when the cluster names none (tests, laptops)
    a folder beside the session's warehouse is used and registered as the
    checkpoint directory.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder "
                               "(HDFS/object store) that every executor can reach")
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        configured = f"{warehouse}-scratch-{uuid.uuid4().hex}"
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path under the shared folder, deleted when the
    driver ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def cut_lineage(df: DataFrame, label: str = "cut") -> DataFrame:
    """``df`` written under the shared folder and read back (never a local
    checkpoint): a lost executor does not force recomputation from the
    sources, and Spark knows the size of the result."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
