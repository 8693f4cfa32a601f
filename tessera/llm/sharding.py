"""Sharding by jump consistent hashing (Lamping and Veach, 2014).

The shard of a key depends on the key and the number of shards alone; no ring
table is stored, and going from n to n + 1 shards moves only the rows that
the new shard takes.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import number_in_groups, stored, without


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key; all keys advance together."""
    key = keys.astype(np.uint64, copy=True)
    at = np.zeros(len(key), dtype=np.int64)
    nxt = np.zeros(len(key), dtype=np.int64)
    live = np.arange(len(key))
    while len(live):
        at[live] = nxt[live]
        k = key[live] * np.uint64(2862933555777941757) + np.uint64(1)
        key[live] = k
        nxt[live] = ((at[live] + 1) * (float(1 << 31) / ((k >> np.uint64(33)).astype(np.float64) + 1.0))).astype(np.int64)
        live = live[nxt[live] < shards]
    return at.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """Shard column for a key of any type; a null key is one more key."""
    if shards < 1:
        raise ValueError("at least one shard is needed")

    @F.pandas_udf("int")
    def of(hashes: pd.Series) -> pd.Series:
        return pd.Series(jump(hashes.to_numpy(np.int64).view(np.uint64), shards))

    return of(F.xxhash64(F.coalesce(key.cast("string"), F.lit(""))))


def shard(df: DataFrame, shards: int, key: str = "doc_id", out: str = "shard") -> DataFrame:
    """Add the shard of every row.  An input column named ``out`` is replaced."""
    return without(df, [out]).withColumn(out, shard_of(F.col(key), shards))


def shard_documents(docs: DataFrame, shards: int) -> DataFrame:
    """One row per document with its shard among ``shards``, its gapless slot
    in the shard and its shard if one more were added.

    Rows with equal ids share a shard and take different slots; a null text
    has size 1 and checksum 0, as an empty one.  Extra columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.lit("key").alias("law"))
    # written without the texts: rows without an id are told apart by their place in it
    rows = stored(shard(shard(rows, shards), shards + 1, out="grown_shard"), "sharded")
    return (number_in_groups(rows, ["shard"], "doc_id", "slot", F.monotonically_increasing_id())
            .select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"))
