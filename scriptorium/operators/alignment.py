"""Alignment of names, outlines and page furniture: containment joins, monotone and greedy matches, running-header runs."""

from __future__ import annotations

import difflib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.operators.folds import monotone_alignment


def contained(short: DataFrame, long: DataFrame, keys: list[str], a: str, b: str, n: int = 4) -> DataFrame:
    """Distinct (keys, a, b) where text b of the same keys contains text a of at least n characters.

    A containing text has every n-gram of the contained one, so a's rarest n-gram is looked up; no pair without it is formed.
    """
    def grams(c: str) -> Column:
        return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - (n - 1)), lambda i: F.substring(F.col(c), i, F.lit(n))))

    one = short.select(*keys, a).where(F.length(a) >= n).distinct()
    two = long.select(*keys, b).where(F.length(b) >= n).distinct().select(*keys, b, F.explode(grams(b)).alias("_g"))
    often = two.groupBy(*keys, "_g").agg(F.count(F.lit(1)).alias("_f"))
    asked = one.select(*keys, a, F.explode(grams(a)).alias("_g")).join(often, [*keys, "_g"], "left")
    rarest = asked.groupBy(*keys, a).agg(F.min_by("_g", F.struct(F.coalesce("_f", F.lit(0)).alias("f"), "_g")).alias("_g"))
    return rarest.join(two, [*keys, "_g"]).where(F.contains(b, F.col(a))).select(*keys, a, b)


def cascading_match(asked: DataFrame, known: DataFrame, keys: list[str], name: str, other: str) -> DataFrame:
    """asked (keys, name) with `trovato`: an equal name of the same keys, else the shortest, then first, that contains it or is contained in it, else null."""
    asked, known = asked.select(*keys, name).where(F.col(name).isNotNull()).distinct(), known.select(*keys, other).where(F.col(other).isNotNull()).distinct()
    equal = asked.join(known.withColumn(name, F.col(other)), [*keys, name]).select(*keys, name, other, F.lit(0).alias("_p"))
    near = contained(asked, known, keys, name, other).unionByName(contained(known, asked, keys, other, name)).select(*keys, name, other, F.lit(1).alias("_p"))
    best = equal.unionByName(near).groupBy(*keys, name).agg(F.min_by(other, F.struct("_p", F.length(other), other)).alias("trovato"))
    return asked.join(best, [*keys, name], "left")


def ratio(a: Column, b: Column) -> Column:
    """Ratcliff-Obershelp likeness of two texts, lower case and with single blanks; 1 if both are empty or null."""
    def score(x: pd.Series, y: pd.Series) -> pd.Series:
        tidy = [(" ".join((p or "").lower().split()), " ".join((q or "").lower().split())) for p, q in zip(x, y)]
        return pd.Series([1.0 if not p and not q else difflib.SequenceMatcher(None, p, q).ratio() for p, q in tidy])

    return F.pandas_udf(score, "double")(a, b)


def outline_alignment(outline: DataFrame, lines: DataFrame, book: str, score: Callable[[str, str], float], least: float = 0.85, reach: int = 3) -> DataFrame:
    """(book, voce, pag, riga): each outline entry (book, pag, voce) with the id of the line (book, pag, n, riga_id, testo) it names; the cursor never goes back.

    One group per book holds its titles only; texts of other lines don't enter.
    """
    kind = dict(outline.dtypes)
    both = outline.select(book, "pag", F.col("voce").alias("testo"), F.col("ord").cast("long").alias("n"), F.lit(None).cast("long").alias("riga_id")).unionByName(lines.select(book, "pag", "testo", F.col("n").cast("long").alias("n"), F.col("riga_id").cast("long").alias("riga_id")))

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf.riga_id.isna()
        toc, rows = pdf[own].sort_values("n"), pdf[~own].sort_values(["pag", "n"])
        hits = monotone_alignment(list(zip(toc.testo, toc.pag)), list(zip(rows.testo, rows.pag)), score, least, reach)
        ids = rows.riga_id.to_numpy()
        return pd.DataFrame({book: toc[book], "voce": toc.testo, "pag": toc.pag, "riga": [None if h is None else int(ids[h]) for h in hits]})

    return both.where(F.col("testo").isNotNull()).groupBy(book).applyInPandas(fold, f"{book} {kind[book]}, voce string, pag {kind['pag']}, riga long")


def used_once(pairs: DataFrame, group: list[str], entry: str, order: str, title: str, score: str) -> DataFrame:
    """Of scored pairs, each entry in order with its best title of the group that no earlier entry took; groups are pages."""
    kinds = dict(pairs.dtypes)

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        taken, out = set(), []
        for _, rows in pdf.sort_values([order, entry]).groupby([order, entry], sort=False):
            rows = rows[~rows[title].isin(taken)].sort_values([score, title], ascending=[False, True])
            if len(rows):
                taken.add(rows[title].iloc[0])
                out.append(rows.iloc[0])
        return pd.DataFrame(out, columns=pdf.columns)

    return pairs.groupBy(*group).applyInPandas(fold, ", ".join(f"{c} {kinds[c]}" for c in pairs.columns))


def header_runs(headers: DataFrame, book: str, page: str, text: str, key: str, alike: Callable[[str, str], bool], back: int = 4) -> DataFrame:
    """(book, inizio, testo, pagine): runs of pages with the same running header, those of two pages and more.

    headers has one row per page (the longest header line). A header alike to the last run lengthens it; one alike to
    another of the last `back` runs alternates and is skipped; others begin a run. A group is one book's pages.
    """
    kinds = dict(headers.dtypes)

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        runs: list[list] = []
        for p, t, k in pdf.sort_values(page)[[page, text, key]].itertuples(index=False):
            if runs and alike(k, runs[-1][2]):
                runs[-1][3] += 1
            elif not any(alike(k, r[2]) for r in runs[-back:]):
                runs.append([p, t, k, 1])
        kept = [r for r in runs if r[3] >= 2]
        return pd.DataFrame({book: [pdf[book].iloc[0]] * len(kept), "inizio": [r[0] for r in kept], "testo": pd.Series([r[1] for r in kept], dtype=object), "pagine": [r[3] for r in kept]})

    return headers.groupBy(book).applyInPandas(fold, f"{book} {kinds[book]}, inizio {kinds[page]}, testo string, pagine long")


def near_pages(names: DataFrame, outline: DataFrame, book: str, key: str, least: int = 8) -> DataFrame:
    """(book, id, voce, distanza): outline entries at most one page away whose key equals a name's key or, from `least` letters on, begins with it or is its beginning; nearest first, then exact.

    names: book, id, pag, key; outline: book, voce, pag, key. Joined by book, page and the first letters, so no page's pairs are all formed.
    """
    head = lambda c: F.substring(c, 1, least)
    asked = names.select(book, "id", F.col("pag").alias("_p"), F.col(key).alias("_a"), head(key).alias("_h"), F.explode(F.array(F.col("pag") - 1, F.col("pag"), F.col("pag") + 1)).alias("pag"))
    toc = outline.select(book, "voce", "pag", F.col(key).alias("_b"), head(key).alias("_h"))
    prefix = (F.length("_a") >= least) & (F.length("_b") >= least) & (F.startswith("_a", F.col("_b")) | F.startswith("_b", F.col("_a")))
    hit = asked.join(toc, [book, "pag", "_h"]).where((F.col("_a") == F.col("_b")) | prefix)
    far = F.abs(F.col("pag") - F.col("_p"))
    return hit.groupBy(book, "id").agg(F.min_by(F.struct("voce", far.alias("distanza")), F.struct(far.alias("d"), (F.col("_a") != F.col("_b")).alias("e"), "voce")).alias("_r")).select(book, "id", "_r.voce", "_r.distanza")


def sliding_total(events: DataFrame, at: str, seconds: int, out: str) -> DataFrame:
    """events with how many events of all keys fell in the last `seconds`, itself included.

    Counts per second are laid into bins of `seconds`, each also into the next bin, so a frame needs one bin and no window spans all rows.
    """
    timed = events.withColumn("_t", F.unix_timestamp(F.col(at).cast("timestamp")))
    per = timed.groupBy("_t").agg(F.count(F.lit(1)).alias("_n")).withColumn("_o", F.floor(F.col("_t") / seconds))
    laid = per.select("_t", "_n", "_o", F.explode(F.array("_o", F.col("_o") + 1)).alias("_b"))
    run = Window.partitionBy("_b").orderBy("_t").rangeBetween(-seconds + 1, 0)
    sums = laid.withColumn(out, F.sum("_n").over(run)).where(F.col("_o") == F.col("_b")).select("_t", out)
    return timed.join(sums, "_t").drop("_t")
