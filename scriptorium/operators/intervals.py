"""Interval algebra per entity: maximal stretches and the holes between them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.operators.scans import ranked
from scriptorium.session import written

#: Positions per slot of the two-level ranks.
SLOT = 2048


def stretches_and_gaps(ranges: DataFrame, keys: list[str], lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Columns keys, tipo (`periodo`, `lacuna`), lo, hi of half-open ranges.

    Starts and ends are ranked independently per entity. The (r+1)-th start beyond the r-th end is a hole; boundaries
    without a partner begin the first and end the last stretch; the k-th beginning belongs to the k-th ending. Touching
    ranges join. Null keys or bounds and empty or inverted ranges are ignored; an empty input gives no rows.
    """
    valid = F.col(lo) < F.col(hi)
    for k in keys:
        valid = valid & F.col(k).isNotNull()
    clean = ranges.where(valid).select(*keys, F.col(lo).alias("_lo"), F.col(hi).alias("_hi")).distinct()
    starts = ranked(clean.select(*keys, F.col("_lo").alias("_x")), keys, ["_x"], F.floor(F.col("_x") / SLOT)).select(*keys, "rango", F.col("_x").alias("_s"))
    ends = ranked(clean.select(*keys, F.col("_hi").alias("_x")), keys, ["_x"], F.floor(F.col("_x") / SLOT)).select(*keys, (F.col("rango") + 1).alias("rango"), F.col("_x").alias("_e"))
    # stored once: four ranks are taken from it
    edges = written(starts.join(ends, [*keys, "rango"], "full_outer").where(F.col("_s").isNull() | F.col("_e").isNull() | (F.col("_s") > F.col("_e"))), "bordi")
    gaps = edges.where(F.col("_s").isNotNull() & F.col("_e").isNotNull()).select(*keys, F.lit("lacuna").alias("tipo"), F.col("_e").alias("lo"), F.col("_s").alias("hi"))
    opens = ranked(edges.where(F.col("_s").isNotNull()).select(*keys, "_s"), keys, ["_s"], F.floor(F.col("_s") / SLOT))
    closes = ranked(edges.where(F.col("_e").isNotNull()).select(*keys, "_e"), keys, ["_e"], F.floor(F.col("_e") / SLOT))
    periods = opens.join(closes, [*keys, "rango"]).select(*keys, F.lit("periodo").alias("tipo"), F.col("_s").alias("lo"), F.col("_e").alias("hi"))
    return periods.unionByName(gaps)
