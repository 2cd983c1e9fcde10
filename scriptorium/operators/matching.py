"""Joins by prefix, range, neighbourhood, likeness and place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.functions import geometry as G
from scriptorium.operators import grams


def longest_prefix(headings: DataFrame, names: DataFrame, heading: str, name: str, least: int = 3) -> DataFrame:
    """Headings with the longest names they begin with, ties kept; without any, no row.

    An equality join on all prefixes of a heading (at most its length) replaces the nested loop; names are matched by
    hash, so neither side needs to fit in memory.
    """
    keys = headings.withColumn("_p", F.explode(F.transform(F.sequence(F.lit(least), F.greatest(F.length(heading), F.lit(least))), lambda n: F.substring(F.col(heading), F.lit(1), n)))).where(F.length("_p") >= least)
    hit = keys.distinct().join(names.where(F.length(name) >= least), F.col("_p") == F.col(name))
    longest = F.max(F.length(name)).over(Window.partitionBy(heading))
    return hit.withColumn("_m", longest).where(F.length(name) == F.col("_m")).drop("_p", "_m")


def range_semi(ranges: DataFrame, points: DataFrame, key: str, lo: str, hi: str, point: str, bin_size: int = 64) -> DataFrame:
    """Ranges [lo, hi) that hold a point of the same key: points are looked up by bins of the range."""
    bins = F.sequence(F.floor(F.col(lo) / bin_size), F.floor((F.col(hi) - 1) / bin_size))
    held = ranges.where(F.col(lo) < F.col(hi)).withColumn("_id", F.struct(key, lo, hi)).withColumn("_b", F.explode(bins))
    spots = points.select(F.col(key).alias("_k"), F.col(point).alias("_x"), F.floor(F.col(point) / bin_size).alias("_b")).distinct()
    on = (held["_b"] == spots["_b"]) & (held[key] == spots["_k"]) & (spots["_x"] >= held[lo]) & (spots["_x"] < held[hi])
    return held.join(spots, on, "left_semi").drop("_id", "_b").distinct()


def as_of(rows: DataFrame, events: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """rows with the value of the nearest event at or before: one sorted union instead of a range join."""
    both = rows.select(key, at, F.lit(1).alias("_o"), F.lit(None).cast(dict(events.dtypes)[value]).alias("_v")).unionByName(events.select(key, at, F.lit(0).alias("_o"), F.col(value).alias("_v")))
    run = Window.partitionBy(key).orderBy(at, "_o").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(value, F.last("_v", ignorenulls=True).over(run)).where("_o = 1").select(key, at, value)


def in_boxes(points: DataFrame, boxes: DataFrame, keys: list[str], point: G.Box, box: G.Box) -> DataFrame:
    """Blocks whose centre lies in a box of the same page."""
    x, y = G.centre(point)
    return points.join(boxes, keys).where((x >= box[0]) & (x <= box[2]) & (y >= box[1]) & (y <= box[3]))


def best_overlap(blocks: DataFrame, zones: DataFrame, keys: list[str], block: str, a: G.Box, b: G.Box, zone: str) -> DataFrame:
    """Each block with the zone of its page that covers it most; null if none does."""
    hit = blocks.join(zones, keys, "left").withColumn("_a", G.overlap(a, b))
    return hit.groupBy(*keys, block).agg(F.max_by(F.when(F.col("_a") > 0, F.col(zone)), F.struct(F.coalesce("_a", F.lit(0.0)).alias("a"), F.col(zone).alias("z"))).alias(zone))


def likeness_pairs(left: DataFrame, right: DataFrame, block: list[str], score: Column, least: float) -> DataFrame:
    """Pairs within a block whose score reaches `least`."""
    return left.join(right, block).withColumn("punti", score).where(F.col("punti") >= least)


def nearest(rows: DataFrame, keys: list[str], distance: Column, order: list[str]) -> DataFrame:
    """One row per key: least distance, then order."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.withColumn("_d", distance).groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct("_d", *order)).alias("_r")).select(*keys, "_r.*")


def trigram_pairs(left: DataFrame, right: DataFrame, a: str, b: str, grams_a: Column, grams_b: Column, least: float) -> DataFrame:
    """(a, b, jaccard) of distinct names that share at least so much of their trigrams: an exact test on the pairs of `grams.candidates`."""
    return _as_alike(grams.candidates(left, right, a, b, grams_a, grams_b, least), a, b, grams_a, grams_b, least)


def trigram_twins(names: DataFrame, a: str, b: str, grams_a: Column, grams_b: Column, least: float) -> DataFrame:
    """trigram_pairs of the names of one table, in column a, with a < b; read and posted once."""
    return _as_alike(grams.candidates_within(names, a, b, grams_a, least), a, b, grams_a, grams_b, least)


def _as_alike(near: DataFrame, a: str, b: str, grams_a: Column, grams_b: Column, least: float) -> DataFrame:
    near = near.withColumn("_ga", grams_a).withColumn("_gb", grams_b)
    score = F.size(F.array_intersect("_ga", "_gb")) / F.size(F.array_union("_ga", "_gb"))
    return near.select(a, b, F.explode(F.array(F.round(score, 4))).alias("jaccard")).where(F.col("jaccard") >= least)  # exploded: else the filter scores once more
