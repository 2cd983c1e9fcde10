"""Thresholded multi-label scores, their intervals, reports and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def thresholded(units: DataFrame, scores: str = "punti", threshold: float = 0.8) -> DataFrame:
    """units with `tipi`, the sorted labels at or above the threshold."""
    return units.withColumn("tipi", F.sort_array(F.map_keys(F.map_filter(scores, lambda _, v: v >= threshold))))


def label_intervals(units: DataFrame, gap: int = 2, scores: str = "punti") -> DataFrame:
    """(tipo, file, inizio, fine, unita, tok, punteggio_medio): runs of units with the same label.

    Units are numbered by id within their file; a unit without the label breaks the run, and so does a distance above
    gap + 1 lines from the furthest end so far. Windows are per (label, file), so no label is held in one task.
    """
    numbered = units.withColumn("_i", F.row_number().over(Window.partitionBy("file").orderBy("id")))
    rows = numbered.select("id", "file", "inizio", "fine", "tok", "_i", F.explode("tipi").alias("tipo"), scores).withColumn("_s", F.col(scores)[F.col("tipo")])
    run = Window.partitionBy("tipo", "file").orderBy("_i")
    far = F.max("fine").over(run.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when((F.lag("_i").over(run) == F.col("_i") - 1) & (F.col("inizio") - far <= gap + 1), 0).otherwise(1)
    islands = rows.withColumn("_f", fresh).withColumn("_g", F.sum("_f").over(run))
    return (
        islands.groupBy("tipo", "file", "_g")
        .agg(F.min("inizio").alias("inizio"), F.max("fine").alias("fine"), F.count(F.lit(1)).alias("unita"), F.sum("tok").cast("bigint").alias("tok"), F.round(F.avg("_s"), 3).alias("punteggio_medio"))
        .drop("_g")
    )


def label_report(units: DataFrame) -> DataFrame:
    """(tipo, unita, tok, quota): per label and for units without one (`nessuna`); labels overlap, so shares may exceed 100."""
    total = units.agg(F.sum("tok").alias("_t"))
    labelled = units.select("tok", F.explode(F.when(F.size("tipi") > 0, F.col("tipi")).otherwise(F.array(F.lit("nessuna")))).alias("tipo"))
    sums = labelled.groupBy("tipo").agg(F.count(F.lit(1)).alias("unita"), F.sum("tok").cast("bigint").alias("tok"))
    return sums.crossJoin(F.broadcast(total)).select("tipo", "unita", "tok", F.round(100 * F.col("tok") / F.greatest(F.col("_t"), F.lit(1)), 2).alias("quota"))


def threshold_sweep(pairs: DataFrame, thresholds: list[float], scores: str = "punti", truth: str = "veri") -> DataFrame:
    """(soglia, tp, fp, fn, precisione, richiamo, f1, esatti): micro measures for each threshold, in one pass over the rows."""
    def found(t: float):
        return F.map_keys(F.map_filter(scores, lambda _, v: v >= t))

    wide = pairs.select(truth, F.explode(F.array(*[F.struct(F.lit(t).alias("soglia"), found(t).alias("trovati")) for t in thresholds])).alias("_x")).select(truth, "_x.*")
    hit = F.size(F.array_intersect("trovati", truth))
    sums = wide.groupBy("soglia").agg(
        F.sum(hit).cast("bigint").alias("tp"),
        F.sum(F.size(F.array_except("trovati", truth))).cast("bigint").alias("fp"),
        F.sum(F.size(F.array_except(truth, "trovati"))).cast("bigint").alias("fn"),
        F.round(F.avg(F.when((F.size("trovati") == hit) & (F.size(F.array_distinct(truth)) == hit), 1.0).otherwise(0.0)), 4).alias("esatti"),
    )
    p, r = F.col("tp") / F.greatest(F.col("tp") + F.col("fp"), F.lit(1)), F.col("tp") / F.greatest(F.col("tp") + F.col("fn"), F.lit(1))
    return sums.select("soglia", "tp", "fp", "fn", F.round(p, 4).alias("precisione"), F.round(r, 4).alias("richiamo"), F.round(F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0), 4).alias("f1"), "esatti")


def neighbours(units: DataFrame, label: str, margin: int = 1, tiny: int = 40) -> DataFrame:
    """Units with a label, those up to `margin` beside them in their file, and a tiny title unit in front of any of these."""
    numbered = units.withColumn("_i", F.row_number().over(Window.partitionBy("file").orderBy("id"))).withColumn("_has", F.array_contains("tipi", label))
    around = Window.partitionBy("file").orderBy("_i").rowsBetween(-margin, margin)
    near = numbered.withColumn("_in", F.max("_has").over(around))
    # the title may stand at the end of the file before, so this looks along ids
    runs = near.withColumn("_next", F.lead("_in").over(Window.partitionBy("libro").orderBy("id")))
    return runs.where(F.col("_in") | ((F.col("tok") < tiny) & F.coalesce("_next", F.lit(False)))).drop("_i", "_has", "_in", "_next")


def first_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by a total order."""
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*[c for c in rows.columns if c not in keys]), F.struct(*order)).alias("_r")).select(*keys, "_r.*")


def mode(rows: DataFrame, keys: list[str], value: str, weight: str | None = None, seen: str | None = None) -> DataFrame:
    """(keys, value, peso): the commonest value by count or weight; among equals the first seen, then the smallest."""
    amount = F.sum(weight) if weight else F.count(F.lit(1))
    sums = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(amount.alias("peso"), (F.min(seen) if seen else F.min(value)).alias("_s"))
    return sums.groupBy(*keys).agg(F.min_by(F.struct(value, "peso"), F.struct((-F.col("peso")).alias("a"), F.col("_s").alias("b"), F.col(value).alias("c"))).alias("_r")).select(*keys, f"_r.{value}", "_r.peso")


def loops(names: DataFrame, key: str, name: str, most: int = 3) -> DataFrame:
    """(key, ripetuto): whether any name comes more than `most` times in an answer."""
    counts = names.groupBy(key, name).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(key).agg(F.bool_or(F.col("_n") > most).alias("ripetuto"))
