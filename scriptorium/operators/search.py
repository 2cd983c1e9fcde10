"""Ranked search over chapters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.functions import text as T


def scored(docs: DataFrame, query: str, text: str = "text") -> DataFrame:
    """docs that hold every term, with `titolo`, `punti` and `estratto`.

    Points: occurrences, 40 for each term in the title, with several words 15 for each of up to ten phrases and 300 for
    one in the title; half for texts below 250 characters. A query without terms finds nothing.
    """
    terms, phrase, several = T.search_terms(query)
    if not terms:
        return docs.where(F.lit(False)).select("*", F.lit("").alias("titolo"), F.lit(0).cast("bigint").alias("punti"), F.lit("").alias("estratto"))
    low = F.lower(F.col(text))
    hit = F.lit(True)
    for t in terms:
        hit = hit & F.contains(low, F.lit(t))
    rows = docs.where(F.col(text).isNotNull() & hit).withColumn("titolo", F.trim(F.regexp_replace(F.substring_index(text, "\n", 1), r"^[#*\s]+", "")))
    title = F.lower("titolo")
    points = sum((T.occurrences(low, t) + F.when(F.contains(title, F.lit(t)), 40).otherwise(0) for t in terms), F.lit(0))
    if several:
        points = points + 15 * F.least(F.lit(10), T.occurrences(low, phrase)) + F.when(F.contains(title, F.lit(phrase)), 300).otherwise(0)
    points = F.when(F.length(text) < 250, F.floor(points / 2)).otherwise(points)
    return rows.withColumn("punti", points.cast("bigint")).withColumn("estratto", T.snippet(T.plain_text(F.col(text)), terms))


def ranked(docs: DataFrame, query: str, most: int = 80, text: str = "text", order: tuple[str, ...] = ("source", "doc_id")) -> DataFrame:
    """The best hits of a query: a distributed top-k."""
    return scored(docs, query, text).orderBy(F.desc("punti"), *order).limit(most)


def postings(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, termine, key, n, posizioni): an inverted index over all terms, one row per term and document.

    Terms are runs of letters and digits of any length, positions count the terms of the text from 1. No row or group
    is larger than one document, so frequent terms need no salt.
    """
    terms = docs.where(F.col(text).isNotNull()).select(key, F.lower(lang).alias("lang"), F.posexplode(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{M}\p{N}]+"), F.lit(0))).alias("_p", "termine"))
    places = terms.groupBy("lang", "termine", key).agg(F.sort_array(F.collect_list((F.col("_p") + 1).cast("bigint"))).alias("posizioni"))
    return places.select("lang", "termine", key, F.size("posizioni").cast("bigint").alias("n"), "posizioni")
