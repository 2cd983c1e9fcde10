"""Two-level prefix scans: ranks within groups of any size, no group in one task.

A window over a whole group puts a hot group into one task. Here rows are ranked inside bounded slots of the order
column; slot sizes, one row per slot, are scanned per group, and the offset is joined back on (group, slot).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked(df: DataFrame, keys: list[str], order: list[str], slot: Column, rank: str = "rango") -> DataFrame:
    """df with the 1-based rank of each row in its group by `order`.

    slot must grow with `order` and cut groups into pieces that fit a task. Keys must not be null; ties in `order` get
    ranks in any order, so equal rows are interchangeable.
    """
    cut = df.withColumn("_slot", slot)
    local = cut.withColumn("_n", F.row_number().over(Window.partitionBy(*keys, "_slot").orderBy(*order)))
    offsets = (
        cut.groupBy(*keys, "_slot")
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_before", F.coalesce(F.sum("_size").over(Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .drop("_size")
    )
    return local.join(offsets, [*keys, "_slot"]).withColumn(rank, F.col("_before") + F.col("_n")).drop("_slot", "_n", "_before")


def dense_codes(keys: DataFrame, key: str, code: str = "codice", slots: int = 256) -> DataFrame:
    """Dictionary encoding: distinct non-null values of `key` with dense codes from 1.

    Slots are hash ranges, so the dictionary is numbered in parallel; only `slots` sizes pass through one task.
    """
    distinct = keys.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_g", F.pmod(F.xxhash64(key), F.lit(slots)))
    sizes = distinct.groupBy("_g").agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select("_g", F.coalesce(F.sum("_size").over(Window.orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return (
        distinct.withColumn("_n", F.row_number().over(Window.partitionBy("_g").orderBy(key)))
        .join(F.broadcast(offsets), "_g")  # `slots` rows
        .select(key, (F.col("_before") + F.col("_n")).alias(code))
    )
