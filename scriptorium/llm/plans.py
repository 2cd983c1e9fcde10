"""Queries p1, p3, p8, p9 and p10 over the tables of the project."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm import encoding, markup, mixing, scans, topics
from scriptorium.session import table, written


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks and the languages of which they hold markup."""
    return markup.found(table(spark, sf_dir, "pag_n_res"))


def p1_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each block once, with its clean text."""
    return markup.cleaned(markup.once(table(spark, sf_dir, "pag_n_res").select("blocco_id", "block_content")))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks and the kinds of noise in them."""
    return scans.noise(table(spark, sf_dir, "pag_n_res"))


def p3_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The paragraphs of all pages without the noise of scans, named by the block where they begin."""
    return scans.clean(table(spark, sf_dir, "pag_n_res"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of each document by byte_bpe_50k, without special tokens."""
    return encoding.encoded(table(spark, sf_dir, "documents"))


def _mix(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    docs, targets = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pesi_fonti")
    named = docs.join(targets.select("source").distinct(), "source", "left_semi")
    model = topics.fit(docs, table(spark, sf_dir, "etichette_doc"), table(spark, sf_dir, "aree"))
    sizes = written(mixing.measured(named, docs, model), "pesi")
    return mixing.mixed(sizes, targets), targets, sizes


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the mix and how often each is used."""
    return _mix(spark, sf_dir)[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target share and reached share of each source."""
    return mixing.shares(*_mix(spark, sf_dir)[:2])


def p9_marginals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of each language and subject area in the corpus of the named sources, the share raked to, and what the mix reaches."""
    mix, _, sizes = _mix(spark, sf_dir)
    return mixing.marginals(mix, sizes)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The subject areas of each document."""
    docs = table(spark, sf_dir, "documents")
    model = topics.fit(docs, table(spark, sf_dir, "etichette_doc"), table(spark, sf_dir, "aree"))
    return topics.assigned(docs, model).select("doc_id", "area")


def p10_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per subject area; a document counts for each of its areas."""
    return p10_found(spark, sf_dir).groupBy("area").agg(F.count(F.lit(1)).alias("documenti"))


QUERIES = {f.__name__: f for f in (p1_found, p1_clean, p3_found, p3_clean, p8_ids, p9_mix, p9_shares, p9_marginals, p10_found, p10_composition)}

# no equivalent in SQL: the operators are tested against the tokenizer, brute force and held-out labels
SQL: dict[str, str] = {}
