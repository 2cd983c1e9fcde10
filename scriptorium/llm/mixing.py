"""Mixing sources to target weights: iterative proportional fitting and calibrated sampling.

Token weights of the cells (source, language, topic) are raked until their marginals match: sources to the target
shares, languages and topics to the corpus' own shares. A cell's weight over its tokens is the expected number of uses
of each of its documents; it never exceeds the source's cap. Documents are then drawn by systematic sampling in order
of their tokens, so each is used floor or ceil of its expectation and small and large ones are drawn alike. Of
several starts the one counts at which a source's tokens come nearest to its weight.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.llm import encoding, topics
from scriptorium.session import written

#: Passes of the fitting, and documents of a cell per hash part of its slots.
PASSES, SLOT_DOCS = 200, 1_000_000
#: Starts of the systematic sampling that are tried for each source.
STARTS = 64

#: Words in the transducer while only counts of tokens are asked.
COUNT_WORDS = 16_384


def measured(docs: DataFrame, everything: DataFrame, model: topics.TopicModel, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, source, lang, area, n_token) of docs: tokens and commonest subject area, both from one reading of the text.

    everything: the documents whose words make the lexicon. Null and empty texts have 0 tokens and no area.
    """
    lexicon = encoding.build_lexicon(docs.sparkSession, everything, column, size=COUNT_WORDS)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoding._ready(lexicon, encoding.VOCABULARY)
        for b in batches:
            texts = b.column(3).to_pylist()
            areas = [a[0][0] if a else None for a in shared.value.areas_of(texts)]
            sizes = [len(encoding.packed(t, words)) >> 2 for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(areas, pa.string()), pa.array(sizes, pa.int64())], [key, "source", "lang", "area", "n_token"])

    return docs.select(key, "source", "lang", column).mapInArrow(measure, f"{key} {dict(docs.dtypes)[key]}, source string, lang string, area string, n_token long")


def rake(cells: pd.DataFrame, targets: pd.DataFrame, total: float | None = None) -> pd.DataFrame:
    """cells (source, lang, area, n_token) with `usi`, the expected uses of each document of a cell.

    Sources that have tokens share the weights of those that haven't, in proportion. total: tokens of the mix; by
    default the largest at which each source can reach its share under its cap. With a larger total, capped sources
    fall short and the others keep their target tokens.
    """
    t = targets.groupby("source").agg(peso=("peso", "max"), cap=("max_ripetizioni", "max"))
    c = cells[cells.n_token > 0].merge(t[t.peso > 0], left_on="source", right_index=True).reset_index(drop=True)
    if c.empty:
        return c.assign(usi=pd.Series(dtype=float))
    size = c.groupby("source").n_token.sum()
    share = t.peso.reindex(size.index) / t.peso.reindex(size.index).sum()
    cap = t.cap.reindex(size.index).fillna(1).clip(lower=0)
    reach = (cap * size / share).min() if total is None else float(total)
    want = np.minimum(share * reach, cap * size)
    n = c.n_token.to_numpy(float)
    top = n * cap.reindex(c.source).to_numpy(float)
    w = n * (want / size).reindex(c.source).to_numpy(float)
    margins = [(c.groupby(k, sort=True).ngroup().to_numpy(), n) for k in ("lang", "area")]
    source, aim = c.groupby("source", sort=True).ngroup().to_numpy(), want.sort_index().to_numpy(float)
    for _ in range(PASSES):
        for code, own in margins:
            goal = np.bincount(code, own) * w.sum() / n.sum()
            w = np.minimum(w * (goal / np.maximum(np.bincount(code, w), 1e-12))[code], top)
        for _ in range(50):  # the sources' shares hold exactly: what a cap cuts goes to the source's other cells
            lack = aim - np.bincount(source, w)
            free = np.where(w < top, w + 1e-9, 0)
            room = np.bincount(source, free)
            if np.all((np.abs(lack) < 1e-6 * np.maximum(aim, 1)) | (room == 0)):
                break
            w = np.clip(w + (np.where(room > 0, lack / np.maximum(room, 1e-12), 0))[source] * free, 0, top)
    return c.assign(usi=np.minimum(w / n, top / n))[["source", "lang", "area", "usi"]]


def mixed(docs: DataFrame, targets: DataFrame, total: float | None = None, key: str = "doc_id") -> DataFrame:
    """(key, source, lang, area, n_token, ripetizioni): the documents of the mix and how often each is used (at least once).

    docs: key, source, lang, area, n_token. Documents of sources without a target, without tokens or with a null
    source are left out. Null language or topic is a class of its own, and so is what names no language. Of rows with
    the same key the least counts.
    """
    spark = docs.sparkSession
    tongue = F.regexp_extract(F.lower("lang"), r"^([a-z]{2,3})(?:[-_].*)?$", 1)
    named = (
        docs.where(F.col("source").isNotNull() & (F.col("n_token") > 0))
        .select(key, "source", F.when(tongue != "", tongue).otherwise("?").alias("lang"), F.coalesce("area", F.lit("?")).alias("area"), "n_token")
        .join(targets.select("source").distinct(), "source", "left_semi")
        .groupBy(key)
        .agg(F.min(F.struct("source", "lang", "area", "n_token")).alias("_r"))
        .select(key, "_r.*")
    )
    named = written(named, "nominati")
    # one row per source, language and topic: named sources x languages x areas
    cells = named.groupBy("source", "lang", "area").agg(F.sum("n_token").alias("n_token"), F.count(F.lit(1)).alias("_docs")).toPandas()
    weights = rake(cells.drop(columns="_docs"), targets.select("source", "peso", "max_ripetizioni").dropna(subset=["source", "peso"]).distinct().toPandas(), total)
    weights = weights.merge(cells[["source", "lang", "area", "_docs"]], on=["source", "lang", "area"]) if len(weights) else pd.DataFrame(columns=["source", "lang", "area", "usi", "_docs"])
    uses = spark.createDataFrame(weights.assign(_docs=weights._docs // SLOT_DOCS + 1), "source string, lang string, area string, usi double, _parti long")
    cell, hashed = ["source", "lang", "area"], F.xxhash64(F.col(key), F.lit(42))
    # slots grow with the size of documents and then with hash parts, as many as the cell's documents need
    drawn = named.join(F.broadcast(uses), cell).withColumn("_h", hashed).withColumn("_slot", F.floor(F.log2("n_token") * 4) * (1 << 32) + F.pmod(F.col("_h"), F.col("_parti"))).withColumn("_f", F.col("usi") - F.floor("usi"))
    run = Window.partitionBy(*cell, "_slot").orderBy("n_token", "_h", key)
    inner = drawn.withColumn("_to", F.sum("_f").over(run.rowsBetween(Window.unboundedPreceding, 0)))
    # sums of slots run on through the cells of a source, so it is off by at most one document
    slots = drawn.groupBy(*cell, "_slot").agg(F.sum("_f").alias("_s")).withColumn("_before", F.coalesce(F.sum("_s").over(Window.partitionBy("source").orderBy("lang", "area", "_slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    at = written(inner.join(slots.drop("_s"), [*cell, "_slot"]).select(key, *cell, "n_token", "usi", "_f", (F.col("_before") + F.col("_to")).alias("_to")), "cumulati")

    def uses_from(start: Column) -> Column:
        return F.floor("usi") + F.floor(F.col("_to") + start + 1e-9) - F.floor(F.col("_to") - F.col("_f") + start + 1e-9)

    # the start of each source is the one of STARTS at which its tokens come nearest to what is wanted
    starts = [(k + 0.5) / STARTS for k in range(STARTS)]
    sums = at.groupBy("source").agg(F.sum(F.col("usi") * F.col("n_token")).alias("_w"), *[F.sum(F.col("n_token") * uses_from(F.lit(x))).alias(f"_{k}") for k, x in enumerate(starts)])
    nearest = F.array_min(F.array(*[F.struct(F.abs(F.col(f"_{k}") - F.col("_w")).alias("d"), F.lit(x).alias("_start")) for k, x in enumerate(starts)]))
    chosen = sums.select("source", nearest["_start"].alias("_start"))  # one row per named source
    return at.join(F.broadcast(chosen), "source").withColumn("ripetizioni", uses_from(F.col("_start")).cast("int")).where("ripetizioni > 0").select(key, *cell, "n_token", "ripetizioni")


def shares(mix: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, peso, obiettivo, documenti, token, quota): the weight given, the target among sources with documents, and what the mix reaches; sources without documents with 0."""
    got = mix.groupBy("source").agg(F.count(F.lit(1)).alias("documenti"), F.sum(F.col("n_token") * F.col("ripetizioni")).alias("token"))
    named = targets.where(F.col("source").isNotNull()).groupBy("source").agg(F.max("peso").alias("peso")).join(got, "source", "left")
    total = named.agg(F.sum("token").alias("_t"), F.sum(F.when(F.col("token").isNotNull(), F.col("peso"))).alias("_p"))
    return named.crossJoin(F.broadcast(total)).select("source", "peso", F.round(F.when(F.col("token").isNotNull(), F.col("peso") / F.col("_p")).otherwise(0.0), 6).alias("obiettivo"), F.coalesce("documenti", F.lit(0)).alias("documenti"), F.coalesce("token", F.lit(0)).alias("token"), F.round(F.coalesce(F.col("token") / F.col("_t"), F.lit(0.0)), 6).alias("quota"))


def marginals(mix: DataFrame, docs: DataFrame) -> DataFrame:
    """(margine, classe, quota_corpus, quota_mix): of each language (`lang`) and subject area (`area`) its share of the tokens of docs, to which the mix is raked, and of the mix."""
    tongue = F.regexp_extract(F.lower("lang"), r"^([a-z]{2,3})(?:[-_].*)?$", 1)
    own = docs.where(F.col("n_token") > 0).select(F.when(tongue != "", tongue).otherwise("?").alias("lang"), F.coalesce("area", F.lit("?")).alias("area"), F.col("n_token").alias("_c"), F.lit(0).cast("long").alias("_m"))
    both = own.unionByName(mix.select("lang", "area", F.lit(0).cast("long").alias("_c"), (F.col("n_token") * F.col("ripetizioni")).alias("_m")))
    sums = both.groupBy("lang", "area").agg(F.sum("_c").alias("_c"), F.sum("_m").alias("_m"))
    flat = sums.select(F.explode(F.array(*[F.struct(F.lit(k).alias("margine"), F.col(k).alias("classe")) for k in ("lang", "area")])).alias("_k"), "_c", "_m").groupBy("_k.margine", "_k.classe").agg(F.sum("_c").alias("_c"), F.sum("_m").alias("_m"))
    total = sums.agg(F.sum("_c").alias("_tc"), F.sum("_m").alias("_tm"))
    return flat.crossJoin(F.broadcast(total)).select("margine", "classe", F.round(F.col("_c") / F.col("_tc"), 6).alias("quota_corpus"), F.round(F.col("_m") / F.col("_tm"), 6).alias("quota_mix"))
