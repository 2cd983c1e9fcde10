"""References to parents that are missing, taken away or late, found by bitmaps per key range and period."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.operators.scans import dense_codes
from scriptorium.session import written

_RANGE = 32768  # bits of one bitmap, as Spark's bitmap functions have it
_SPARSE = 1024  # up to so many bits a range is held as sorted positions, else as bits
#: Distinct suspect keys per table and period that are sent to all tasks at once (below 20 MB).
SUSPECTS_AT_ONCE = 200_000
_ALWAYS, _NEVER = "0000-00", "9999-99"


class Bits:
    """A compressed bitmap of one key range: sorted positions while sparse, packed bits when dense."""

    def __init__(self, raw: bytes | np.ndarray):
        packed = np.frombuffer(raw, np.uint8) if isinstance(raw, bytes) else raw
        count = int(np.bitwise_count(packed).sum())
        self.positions = np.flatnonzero(np.unpackbits(packed, bitorder="little")).astype(np.uint16) if count <= _SPARSE else None
        self.packed = packed if count > _SPARSE else None

    def bits(self) -> np.ndarray:
        if self.packed is not None:
            return self.packed
        full = np.zeros(_RANGE, np.uint8)
        full[self.positions] = 1
        return np.packbits(full, bitorder="little")

    def minus(self, parents: np.ndarray) -> np.ndarray:
        """Positions set here and not in the parents' packed bits."""
        if self.positions is not None:
            return self.positions[(parents[self.positions >> 3] >> (self.positions & 7)) & 1 == 0].astype(np.int64)
        return np.flatnonzero(np.unpackbits(self.packed & ~parents, bitorder="little"))


def _and_not(group: pd.DataFrame) -> pd.DataFrame:
    """One key range: references of each table and period AND-NOT the parents born before that period."""
    born = group[group.tabella.isna()].sort_values("periodo")
    births = [(p, Bits(b).bits()) for p, b in zip(born.periodo, born.bit)]
    out, at, known = [], 0, np.zeros(_RANGE // 8, np.uint8)
    for tab, period, raw in group[group.tabella.notna()].sort_values("periodo")[["tabella", "periodo", "bit"]].itertuples(index=False):
        while at < len(births) and births[at][0] < period:
            known = known | births[at][1]
            at += 1
        left = Bits(raw).minus(known)
        out.append(pd.DataFrame({"tabella": tab, "periodo": period, "codice": (group.intervallo.iloc[0] - 1) * _RANGE + left + 1}))
    return pd.concat(out) if out else pd.DataFrame({"tabella": pd.Series(dtype=str), "periodo": pd.Series(dtype=str), "codice": pd.Series(dtype=np.int64)})


def orphans(refs: DataFrame, parents: DataFrame, removed: DataFrame) -> DataFrame:
    """(tabella, id, chiave, periodo, motivo) of references without a parent.

    refs: tabella, id, chiave, quando; parents: chiave, nato; removed: chiave. motivo is `tolto` if the key is among the
    removed and no parent, `mancante` if in neither, `tardivo` if its earliest birth is later than the reference. Null
    keys are no references; a null `quando` is never late; a parent born at null time was always there. Rows may repeat.
    """
    refs = refs.where(F.col("chiave").isNotNull()).withColumn("periodo", F.coalesce(F.date_format("quando", "yyyy-MM"), F.lit(_NEVER)))
    used = written(refs.groupBy("tabella", "periodo", "chiave").agg(F.count(F.lit(1)).alias("_n")).drop("_n"), "usate")
    first = written(parents.where(F.col("chiave").isNotNull()).groupBy("chiave").agg(F.when(F.count("nato") == F.count(F.lit(1)), F.min("nato")).alias("nato")), "libri")
    codes = written(dense_codes(used.select("chiave").unionByName(first.select("chiave")), "chiave"), "codici")
    page, bit = F.bitmap_bucket_number("codice"), F.bitmap_bit_position("codice")
    ref_bits = used.join(codes, "chiave").groupBy("tabella", "periodo", page.alias("intervallo")).agg(F.bitmap_construct_agg(bit).alias("bit"))
    birth = F.coalesce(F.date_format("nato", "yyyy-MM"), F.lit(_ALWAYS))
    parent_bits = first.join(codes, "chiave").groupBy(birth.alias("periodo"), page.alias("intervallo")).agg(F.bitmap_construct_agg(bit).alias("bit")).withColumn("tabella", F.lit(None).cast("string"))
    suspects = (
        ref_bits.unionByName(parent_bits)
        .groupBy("intervallo")
        .applyInPandas(_and_not, "tabella string, periodo string, codice bigint")
        .join(codes, "codice")
        .join(first, "chiave", "left")
        .join(removed.select("chiave", F.lit(True).alias("_tolto")).where(F.col("chiave").isNotNull()).distinct(), "chiave", "left")
        .join(first.select("chiave", F.lit(True).alias("_c")), "chiave", "left")
        .select("tabella", "periodo", "chiave", "nato", F.when(F.col("_c").isNotNull(), "tardivo").when(F.col("_tolto").isNotNull(), "tolto").otherwise("mancante").alias("motivo"))
    )
    # keys and periods, not references: few go to all tasks, many are joined with AQE splitting hot keys
    suspects = written(suspects, "sospette")
    found = refs.join(F.broadcast(suspects) if suspects.count() <= SUSPECTS_AT_ONCE else suspects, ["tabella", "periodo", "chiave"])
    late = (F.col("motivo") != "tardivo") | (F.col("nato") > F.col("quando"))
    return found.where(late).select("tabella", "id", "chiave", F.when(F.col("periodo") != _NEVER, F.col("periodo")).alias("periodo"), "motivo")
