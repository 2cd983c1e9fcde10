"""Queries p2, p4, p5, p6 and p7 over the tables of the project."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.functions import attributes as A
from scriptorium.operators import changefeed, eav, intervals, multivalue, orphans
from scriptorium.session import table

# fixed values: attributes that hold several values
MULTI = ("classi", "componenti", "linguaggi", "competenze", "proprieta", "tag", "tratti_razziali_tag", "equipaggiamento_iniziale", "resistenza_vulnerabilita_immunita")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles with a decision in force after the whole log, applied as a base and a later batch."""
    return changefeed.replay(table(spark, sf_dir, "decisioni"), "arrivo").select(F.col("libro_id").cast("int").alias("libro_id"), F.col("id").cast("int").alias("id"), "classe")


def p4_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per entity with a typed column per attribute."""
    return eav.wide(table(spark, sf_dir, "entita"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed attributes of the wide table as texts."""
    return eav.narrow(eav.wide(table(spark, sf_dir, "entita")), "id", list(A.TYPED))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Continuous stretches and holes of the line ranges per book and file."""
    ranges = table(spark, sf_dir, "entita").select("libro_id", "file", F.col("righe.lo").alias("lo"), F.col("righe.hi").alias("hi"))
    return intervals.stretches_and_gaps(ranges, ["libro_id", "file"])


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each value of the multi-valued attributes with its place."""
    return multivalue.exploded(multivalue.field_entries(table(spark, sf_dir, "entita"), MULTI))


def _orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [table(spark, sf_dir, t).select(F.lit(t).alias("tabella"), F.col(i).cast("long").alias("id"), F.col("libro_id").alias("chiave"), F.col(w).alias("quando")) for t, i, w in (("entita", "id", "creato_il"), ("documents", "doc_id", "acquisito_il"))]
    books = table(spark, sf_dir, "libri").select(F.col("id").alias("chiave"), F.col("creato_il").alias("nato"))
    return orphans.orphans(rows[0].unionByName(rows[1]), books, table(spark, sf_dir, "libri_tolti").select(F.col("id").alias("chiave"))).distinct()


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that name a book that is missing, taken out or late."""
    return _orphans(spark, sf_dir).select("tabella", "id", "motivo").distinct()


def p7_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphans per table, month and kind."""
    return _orphans(spark, sf_dir).groupBy("tabella", "periodo", "motivo").agg(F.countDistinct("id").alias("righe"), F.countDistinct("chiave").alias("chiavi"))


QUERIES = {f.__name__: f for f in (p2_found, p4_found, p4_wide, p5_found, p6_found, p7_found, p7_report)}

_P7 = """WITH b AS (SELECT id, CASE WHEN count(creato_il) = count(*) THEN min(creato_il) END AS nato FROM libri GROUP BY id), t AS (SELECT DISTINCT id FROM libri_tolti),
r AS (SELECT 'entita' AS tabella, id, libro_id, creato_il AS quando FROM entita UNION ALL SELECT 'documents', doc_id, libro_id, acquisito_il FROM documents),
o AS (SELECT DISTINCT r.tabella, r.id, r.libro_id, strftime(r.quando, '%Y-%m') AS periodo, CASE WHEN b.id IS NULL AND t.id IS NULL THEN 'mancante' WHEN b.id IS NULL THEN 'tolto' WHEN b.nato > r.quando THEN 'tardivo' END AS motivo FROM r LEFT JOIN b ON b.id = r.libro_id LEFT JOIN t ON t.id = r.libro_id WHERE r.libro_id IS NOT NULL)"""
SQL = {
    "p2_found": """WITH r AS (SELECT DISTINCT ON (libro_id, sessione, prog) libro_id, sessione, prog, id, classe, coalesce(annulla, false) AS annulla,
CASE WHEN regexp_matches(ts, '^[0-9]+$') THEN ts::bigint ELSE epoch(CASE WHEN regexp_matches(ts, '(Z|[+-][0-9]{2}:[0-9]{2})$') THEN ts ELSE ts || 'Z' END::timestamptz)::bigint END AS t FROM decisioni WHERE id IS NOT NULL OR annulla),
d AS (SELECT *, sum(CASE WHEN annulla THEN -1 ELSE 1 END) OVER (PARTITION BY libro_id ORDER BY t, prog, sessione ROWS UNBOUNDED PRECEDING) AS d FROM r),
f AS (SELECT *, min(d) OVER (PARTITION BY libro_id ORDER BY t, prog, sessione ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS f FROM d)
SELECT libro_id, id, max_by(classe, (t, prog, sessione)) AS classe FROM f WHERE NOT annulla AND f >= d GROUP BY libro_id, id""",
    "p5_found": """WITH e AS (SELECT DISTINCT libro_id, file, righe.lo AS lo, righe.hi AS hi FROM entita WHERE libro_id IS NOT NULL AND file IS NOT NULL AND righe.lo < righe.hi),
m AS (SELECT *, max(hi) OVER (PARTITION BY libro_id, file ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM e),
g AS (SELECT *, sum(CASE WHEN p IS NULL OR lo > p THEN 1 ELSE 0 END) OVER (PARTITION BY libro_id, file ORDER BY lo, hi) AS g FROM m), s AS (SELECT libro_id, file, min(lo) AS lo, max(hi) AS hi FROM g GROUP BY libro_id, file, g)
SELECT libro_id, file, 'periodo' AS tipo, lo, hi FROM s UNION ALL SELECT libro_id, file, 'lacuna', hi, n FROM (SELECT libro_id, file, hi, lead(lo) OVER (PARTITION BY libro_id, file ORDER BY lo) AS n FROM s) WHERE n IS NOT NULL""",
    "p7_found": _P7 + " SELECT DISTINCT tabella, id, motivo FROM o WHERE motivo IS NOT NULL",
    "p7_report": _P7 + " SELECT tabella, periodo, motivo, count(DISTINCT id) AS righe, count(DISTINCT libro_id) AS chiavi FROM o WHERE motivo IS NOT NULL GROUP BY ALL",
}
