"""Ordered folds as queries; SQL can't state them shortly, so they are tested against brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.operators import folds
from scriptorium.session import table


def l03_unit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.units(table(spark, sf_dir, "documents"))


def l04_extraction_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.extraction_windows(table(spark, sf_dir, "documents")).select("doc_id", "n", "inizio", "fine", "tok")


def l05_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.chunks(table(spark, sf_dir, "documents"))


def l07_size_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.sized_chapters(table(spark, sf_dir, "documents"), limit=1000)


def w07_accepted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.accepted(table(spark, sf_dir, "events"), "user_id", "ts", 86_400)


def w10_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "pag_n_res").dropDuplicates(["blocco_id"]).where(F.col("block_bbox").isNotNull())
    return folds.bands(b.select("libro_id", "pag", "blocco_id", F.col("block_bbox")[1].alias("y")), ["libro_id", "pag"], "y", 40.0)


def w08_demoted_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "pag_n_res").where("block_label in ('doc_title', 'paragraph_title') and block_content is not null").dropDuplicates(["blocco_id"])
    return folds.demoted_repeats(t.select("libro_id", "pag", "idx", "block_content", F.when(F.col("block_label") == "doc_title", 1).otherwise(2).alias("livello")), "libro_id", "pag", ["idx"], "block_content", "livello")


QUERIES = {f.__name__: f for f in (l03_unit_packing, l04_extraction_windows, l05_chunks, l07_size_split, w07_accepted_events, w08_demoted_repeats, w10_bands)}
