"""Texts as lines, blocks, chapters and joined books."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exploded_lines(docs: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """(key, n, riga): 1-based lines; null texts have none, an empty text has one empty line."""
    return docs.where(F.col(text).isNotNull()).select(*key, F.posexplode(F.split(text, "\n")).alias("_p", "riga")).select(*key, (F.col("_p") + 1).cast("bigint").alias("n"), "riga")


def text_blocks(docs: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """(key, inizio, fine, testo): runs of non-blank lines with their first and last line number.

    Built inside the row from arrays, so no exchange is needed: a break flag per line, summed along the array.
    """
    lines = F.split(text, "\n")
    step = F.aggregate(
        F.sequence(F.lit(1), F.size(lines)),
        F.array().cast("array<struct<a:bigint,z:bigint>>"),
        lambda acc, i: F.when(~F.element_at(lines, i).rlike(r"[^ \t\r]"), acc)
        .when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["z"] == i - 1), F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(F.try_element_at(acc, F.lit(-1))["a"].alias("a"), i.cast("bigint").alias("z")))))
        .otherwise(F.concat(acc, F.array(F.struct(i.cast("bigint").alias("a"), i.cast("bigint").alias("z"))))),
    )
    runs = docs.where(F.col(text).isNotNull()).select(*key, lines.alias("_l"), F.explode(step).alias("_r"))
    return runs.select(*key, F.col("_r.a").alias("inizio"), F.col("_r.z").alias("fine"), F.array_join(F.slice("_l", F.col("_r.a").cast("int"), (F.col("_r.z") - F.col("_r.a") + 1).cast("int")), "\n").alias("testo"))


def chapters(docs: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """(key, ord, titolo, testo): pieces that begin at a line `## `; what comes before the first is piece 0 with a null title."""
    parts = docs.where(F.col(text).isNotNull()).select(*key, F.posexplode(F.split(text, r"(?m)(?=^## )")).alias("_p", "testo"))
    head = F.regexp_extract("testo", r"\A## +([^\n]*)", 1)
    return parts.where(F.trim("testo") != "").select(*key, F.col("_p").cast("bigint").alias("ord"), F.when(F.startswith("testo", F.lit("## ")), F.trim(head)).alias("titolo"), "testo")


def book_parts(blocks: DataFrame, book: str, page: str, order: list[str], text: str, pages: int = 50, inside: str = "\n\n", between: str = "\n\n---\n\n", heading: str | None = None) -> DataFrame:
    """(book, parte, da, a, testo): all pages of each book in order, as ordered parts of so many page numbers.

    Blocks are joined to pages, pages to parts; a book's parts in order, with `between` between them, are its whole
    text. No row or group holds more than the pages of one part, however long the book is. Null texts are left out,
    repeated rows count once: they meet in their page, so no exchange of their own is needed.
    """
    rows = F.array_sort(F.collect_set(F.struct(*order, F.col(text).alias("_t"))))
    whole = blocks.where(F.col(text).isNotNull()).groupBy(book, page).agg(F.array_join(F.transform(rows, lambda r: r["_t"]), inside).alias("_t"))
    if heading:  # a pattern of what stands at the head of a page and goes
        whole = whole.withColumn("_t", F.regexp_replace("_t", heading, ""))
    parts = F.array_sort(F.collect_list(F.struct(page, "_t")))
    return whole.groupBy(book, F.floor(F.col(page) / pages).alias("parte")).agg(F.min(page).alias("da"), F.max(page).alias("a"), F.array_join(F.transform(parts, lambda r: r["_t"]), between).alias("testo"))


def missing_pages(pages: DataFrame, book: str, page: str) -> DataFrame:
    """(book, page): numbers between 1 and a book's last page that have no row."""
    last = pages.where(F.col(page).isNotNull()).groupBy(book).agg(F.max(page).alias("_m"))
    wanted = last.select(book, F.explode(F.sequence(F.lit(1), F.greatest(F.col("_m"), F.lit(1)))).alias(page))
    return wanted.join(pages.select(book, page).distinct(), [book, page], "left_anti")


def repeated_lines(blocks: DataFrame, book: str, page: str, place: Column, key: Column, least: int = 2) -> DataFrame:
    """(book, posto, chiave, pagine): normalised lines that occur at a place of at least so many pages of a book."""
    return blocks.select(book, page, place.alias("posto"), key.alias("chiave")).where(F.col("chiave") != "").groupBy(book, "posto", "chiave").agg(F.countDistinct(page).cast("bigint").alias("pagine")).where(F.col("pagine") >= least)


def carried(df: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """df with the last non-null value so far (as-of, backward)."""
    run = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.last(value, ignorenulls=True).over(run))


def ordered_rules(c: Column, rules: list[dict]) -> Column:
    """Manual fixes in list order: {find, replace, regex}. The list is small, the expression is built once."""
    for r in rules:
        c = F.regexp_replace(c, r["find"], r["replace"]) if r.get("regex") else F.replace(c, F.lit(r["find"]), F.lit(r["replace"]))
    return c
