"""Joins, aggregations, windows, orders and set operations as queries over the project's tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriptorium.functions import geometry as G
from scriptorium.functions import text as T
from scriptorium.operators import labels, lines, matching, search, store
from scriptorium.operators.intervals import stretches_and_gaps
from scriptorium.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# fixed values: the labels of the classifier
LABELS = ("bestiario", "incantesimo", "classe", "specie", "background", "oggetto", "regola", "luogo")


def query(sql: str | None = None) -> Callable:
    """Register a query under its function's name, with its SQL."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def blocks(spark: SparkSession, d: str) -> DataFrame:
    """Page blocks, each once. Re-delivered rows are equal, so any of them will do."""
    return table(spark, d, "pag_n_res").dropDuplicates(["blocco_id"])


def entities(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "entita").dropDuplicates(["id"])


def units(spark: SparkSession, d: str) -> DataFrame:
    """Blocks as labelled units: lines and scores by arithmetic on the id, tokens by blanks."""
    b = blocks(spark, d).where(F.col("block_content").isNotNull())
    scores = F.map_from_arrays(F.array(*[F.lit(x) for x in LABELS]), F.array(*[((F.col("blocco_id") * (k + 3) + F.floor(F.col("blocco_id") / (k + 5)) * 17) % 100) / 100.0 for k in range(len(LABELS))]))
    return b.select(F.col("blocco_id").alias("id"), F.col("libro_id").alias("file"), F.col("libro_id").alias("libro"), (F.col("blocco_id") * 3).alias("inizio"), (F.col("blocco_id") * 3 + F.length("block_content") % 4).cast("bigint").alias("fine"), F.size(F.split("block_content", " ")).cast("bigint").alias("tok"), scores.alias("punti"))


B = "(SELECT DISTINCT ON (blocco_id) * FROM pag_n_res)"
E = "(SELECT DISTINCT ON (id) * FROM entita)"
_UNITS = f"u0 AS (SELECT blocco_id AS id, libro_id AS file, blocco_id*3 AS inizio, blocco_id*3 + length(block_content) % 4 AS fine, len(string_split(block_content, ' ')) AS tok, [{', '.join(f'((blocco_id * {k + 3} + (blocco_id // {k + 5}) * 17) % 100) / 100.0' for k in range(8))}] AS s FROM {B} WHERE block_content IS NOT NULL), lab AS (SELECT unnest([{', '.join(repr(x) for x in LABELS)}]) AS tipo, unnest(range(1, 9)) AS k), u AS (SELECT u0.*, tipo, s[k] AS score FROM u0, lab)"


# ---- joins ----
@query(f"SELECT e.id, e.libro_id, l.titolo, l.licenza FROM {E} e JOIN (SELECT DISTINCT id, titolo, licenza FROM libri WHERE pubblico) l ON e.libro_id = l.id WHERE e.revisione <> 'scartata'")
def j01_public_view(spark, d):
    return store.public_view(entities(spark, d), table(spark, d, "libri").select("id", "titolo", "licenza", "pubblico").distinct()).select("id", "libro_id", "titolo", "licenza")


@query(f"SELECT l.id, count(e.id) AS voci FROM (SELECT DISTINCT id FROM libri) l LEFT JOIN (SELECT * FROM {E} WHERE tipologia = 'classe' AND revisione = 'verificata') e ON e.libro_id = l.id GROUP BY l.id")
def j02_books_with_counts(spark, d):
    chosen = entities(spark, d).where("tipologia = 'classe' and revisione = 'verificata'").groupBy("libro_id").agg(F.count("id").alias("voci"))
    return table(spark, d, "libri").select("id").distinct().join(chosen, F.col("id") == F.col("libro_id"), "left").select("id", F.coalesce("voci", F.lit(0)).alias("voci"))


@query("SELECT d.source, count(*) AS documenti, count(l.id) AS con_libro FROM documents d LEFT JOIN (SELECT DISTINCT id FROM libri) l ON d.libro_id = l.id GROUP BY d.source")
def j03_left_lookup(spark, d):
    books = table(spark, d, "libri").select("id").distinct()
    counts = table(spark, d, "documents").groupBy("source", "libro_id").agg(F.count(F.lit(1)).alias("n"))  # before the join: hot books become one row a source
    return counts.join(books, F.col("libro_id") == F.col("id"), "left").groupBy("source").agg(F.sum("n").alias("documenti"), F.coalesce(F.sum(F.when(F.col("id").isNotNull(), F.col("n"))), F.lit(0)).alias("con_libro"))


@query(f"WITH n AS (SELECT DISTINCT nome_norm AS voce FROM entita WHERE nome_norm IS NOT NULL), p AS (SELECT DISTINCT string_split(nome_norm, ' ')[1] AS nome FROM entita WHERE length(string_split(nome_norm, ' ')[1]) >= 3 UNION SELECT DISTINCT string_split(nome_norm, ' ')[1] || ' ' || string_split(nome_norm, ' ')[2] FROM entita WHERE len(string_split(nome_norm, ' ')) > 1), x AS (SELECT voce, nome, length(nome) AS k, max(length(nome)) OVER (PARTITION BY voce) AS m FROM n JOIN p ON starts_with(voce, nome)) SELECT voce, nome FROM x WHERE k = m")
def j05_longest_prefix(spark, d):
    names = table(spark, d, "entita").select("nome_norm").where(F.col("nome_norm").isNotNull()).distinct()
    parts = F.split("nome_norm", " ")
    firsts = names.select(F.explode(F.array_compact(F.array(parts[0], F.when(F.size(parts) > 1, F.concat_ws(" ", parts[0], F.try_element_at(parts, F.lit(2))))))).alias("nome")).distinct()
    return matching.longest_prefix(names.withColumnRenamed("nome_norm", "voce"), firsts, "voce", "nome").select("voce", "nome")


@query(f"WITH e AS (SELECT DISTINCT file, righe.lo AS lo, righe.hi AS hi FROM {E} WHERE righe.lo < righe.hi AND file IS NOT NULL), p AS (SELECT DISTINCT file, righe.lo AS x FROM {E} WHERE tipologia = 'incantesimo' AND righe.lo IS NOT NULL) SELECT * FROM e WHERE EXISTS (SELECT 1 FROM p WHERE p.file = e.file AND p.x >= e.lo AND p.x < e.hi)")
def j06_range_semi(spark, d):
    e = entities(spark, d).select("file", F.col("righe.lo").alias("lo"), F.col("righe.hi").alias("hi"), "tipologia").where(F.col("file").isNotNull())
    points = e.where("tipologia = 'incantesimo' and lo is not null").select("file", F.col("lo").alias("x"))
    return matching.range_semi(e.drop("tipologia").distinct(), points, "file", "lo", "hi", "x")


_LINES = "l AS (SELECT doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS n, unnest(string_split(text, chr(10))) AS riga FROM documents WHERE text IS NOT NULL)"


@query(rf"WITH {_LINES} SELECT doc_id, n, md5(last_value(CASE WHEN regexp_matches(riga, '^(#|Capitolo |\*)') THEN riga END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY n ROWS UNBOUNDED PRECEDING)) AS titolo FROM l")
def j07_as_of_heading(spark, d):
    rows = lines.exploded_lines(table(spark, d, "documents"), ["doc_id"]).withColumn("_h", F.when(F.col("riga").rlike(r"^(#|Capitolo |\*)"), F.col("riga")))
    return lines.carried(rows, ["doc_id"], ["n"], "_h", "titolo").select("doc_id", "n", F.md5("titolo").alias("titolo"))


@query("WITH e AS (SELECT o_orderkey, o_orderdate FROM orders), v AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'purchase') SELECT x.event_id, max_by(v.event_id, (v.ts, v.event_id)) AS precedente FROM events x LEFT JOIN v ON v.user_id = x.user_id AND v.ts <= x.ts WHERE x.event_type = 'view' GROUP BY x.event_id")
def j07_as_of_join(spark, d):
    e = table(spark, d, "events")
    bought = e.where("event_type = 'purchase'").groupBy("user_id", "ts").agg(F.max("event_id").alias("precedente"))
    seen = e.where("event_type = 'view'")
    near = matching.as_of(seen.select("user_id", "ts").distinct(), bought, "user_id", "ts", "precedente")
    return seen.join(near, ["user_id", "ts"]).select("event_id", "precedente")


def _store(spark, d):
    base = entities(spark, d).where("libro_id is not null").groupBy("libro_id", "tipologia", "nome_norm").agg(F.min("id").alias("id"), F.min_by("revisione", "id").alias("revisione"), F.min_by("file", "id").alias("file")).where("nome_norm is not null")
    batch = base.where("id % 3 <> 0 and tipologia <> 'luogo'").select("libro_id", "tipologia", F.when(F.col("id") % 7 == 1, F.concat("nome_norm", F.lit(" x"))).otherwise(F.col("nome_norm")).alias("nome_norm"), (F.col("id") + 1000000).alias("id"), F.lit("automatica").alias("revisione"), "file")
    return base, batch


_STORE = f"""base AS (SELECT libro_id, tipologia, nome_norm, min(id) AS id, min_by(revisione, id) AS revisione, min_by(file, id) FILTER (WHERE true) AS file FROM {E} WHERE libro_id IS NOT NULL AND nome_norm IS NOT NULL GROUP BY ALL),
base2 AS (SELECT b.libro_id, b.tipologia, b.nome_norm, b.id, b.revisione, e.file FROM base b JOIN {E} e USING (id)),
batch AS (SELECT libro_id, tipologia, CASE WHEN id % 7 = 1 THEN nome_norm || ' x' ELSE nome_norm END AS nome_norm, id + 1000000 AS id, 'automatica' AS revisione, file FROM base2 WHERE id % 3 <> 0 AND tipologia <> 'luogo')"""


@query(f"""WITH {_STORE}, n AS (SELECT libro_id, tipologia, nome_norm, max(id) AS id, max_by(revisione, id) AS revisione, max_by(file, id) AS f0 FROM batch GROUP BY ALL), n2 AS (SELECT n.libro_id, n.tipologia, n.nome_norm, n.id, n.revisione, b.file FROM n JOIN batch b ON b.id = n.id),
s AS (SELECT DISTINCT libro_id, tipologia FROM batch)
SELECT COALESCE(o.libro_id, n.libro_id) AS libro_id, COALESCE(o.tipologia, n.tipologia) AS tipologia, COALESCE(o.nome_norm, n.nome_norm) AS nome_norm, CASE WHEN o.id IS NOT NULL AND (o.revisione <> 'automatica' OR n.id IS NULL) THEN o.id ELSE n.id END AS id, CASE WHEN o.id IS NOT NULL AND (o.revisione <> 'automatica' OR n.id IS NULL) THEN o.revisione ELSE n.revisione END AS revisione, CASE WHEN o.id IS NOT NULL AND (o.revisione <> 'automatica' OR n.id IS NULL) THEN o.file ELSE n.file END AS file
FROM base2 o FULL JOIN n2 n ON o.libro_id = n.libro_id AND o.tipologia = n.tipologia AND o.nome_norm = n.nome_norm LEFT JOIN s ON s.libro_id = COALESCE(o.libro_id, n.libro_id) AND s.tipologia = COALESCE(o.tipologia, n.tipologia) WHERE NOT (n.id IS NULL AND o.revisione = 'automatica' AND s.libro_id IS NOT NULL)""")
def j08_guarded_upsert(spark, d):
    base, batch = _store(spark, d)
    return store.guarded_upsert(base, batch, ["libro_id", "tipologia", "nome_norm"], scope=["libro_id", "tipologia"])


@query(f"WITH {_STORE} SELECT libro_id, tipologia, nome_norm, id FROM base2 b WHERE revisione = 'automatica' AND NOT EXISTS (SELECT 1 FROM batch n WHERE n.libro_id = b.libro_id AND n.tipologia = b.tipologia AND n.nome_norm = b.nome_norm)")
def j09_vanished(spark, d):
    base, batch = _store(spark, d)
    return store.vanished(base, batch, ["libro_id", "tipologia", "nome_norm"]).select("libro_id", "tipologia", "nome_norm", "id")


def _zones(spark, d):
    pages = blocks(spark, d).groupBy("libro_id", "pag").agg(F.max("width").alias("w"), F.max("height").alias("h"))
    return pages.select("libro_id", "pag", F.explode(F.array(*[F.struct(F.lit(k).alias("zona"), (F.lit(0.0)).alias("zx0"), (F.col("h") * (k / 3)).alias("zy0"), F.col("w").alias("zx1"), (F.col("h") * ((k + 1) / 3)).alias("zy1")) for k in range(3)])).alias("_z")).select("libro_id", "pag", "_z.*")


def _zone_box():
    return F.col("zx0"), F.col("zy0"), F.col("zx1"), F.col("zy1")


_ZSQL = f"z AS (SELECT libro_id, pag, k AS zona, 0.0 AS zx0, max(height) * (k / 3) AS zy0, max(width) AS zx1, max(height) * ((k + 1) / 3) AS zy1 FROM {B}, range(3) t(k) GROUP BY libro_id, pag, k)"


@query(f"WITH {_ZSQL} SELECT b.blocco_id, z.zona::int AS zona FROM {B} b JOIN z USING (libro_id, pag) WHERE (block_bbox[1] + block_bbox[3]) / 2 BETWEEN zx0 AND zx1 AND (block_bbox[2] + block_bbox[4]) / 2 BETWEEN zy0 AND zy1")
def j13_point_in_box(spark, d):
    return matching.in_boxes(blocks(spark, d).select("blocco_id", "libro_id", "pag", "block_bbox"), _zones(spark, d), ["libro_id", "pag"], G.box(F.col("block_bbox")), _zone_box()).select("blocco_id", "zona")


@query(f"""WITH b AS (SELECT blocco_id, libro_id, pag, block_bbox[1] x0, block_bbox[2] y0, block_bbox[3] x1, block_bbox[4] y1 FROM {B} WHERE block_bbox IS NOT NULL),
p AS (SELECT a.blocco_id AS uno, c.blocco_id AS due, greatest(least(a.x1, c.x1) - greatest(a.x0, c.x0), 0.0) * greatest(least(a.y1 + 40, c.y1) - greatest(a.y0, c.y0), 0.0) AS o, greatest(a.x1 - a.x0, 0.0) * greatest(a.y1 + 40 - a.y0, 0.0) + greatest(c.x1 - c.x0, 0.0) * greatest(c.y1 - c.y0, 0.0) AS s FROM b a JOIN b c ON a.libro_id = c.libro_id AND a.pag = c.pag AND a.blocco_id < c.blocco_id)
SELECT uno, due, round(CASE WHEN s - o > 0 THEN o / (s - o) ELSE 0.0 END, 4) AS iou FROM p WHERE CASE WHEN s - o > 0 THEN o / (s - o) ELSE 0.0 END > 0.05""")
def j14_overlapping_boxes(spark, d):
    b = blocks(spark, d).where(F.col("block_bbox").isNotNull()).select("libro_id", "pag", F.col("blocco_id").alias("uno"), F.col("block_bbox").alias("p"))
    c = b.select("libro_id", "pag", F.col("uno").alias("due"), F.col("p").alias("q"))
    a, o = G.box(F.col("p")), G.box(F.col("q"))
    score = G.iou((a[0], a[1], a[2], a[3] + 40), o)
    # a page holds few blocks, and equality on the page comes first
    return b.join(c, ["libro_id", "pag"]).where("uno < due").withColumn("iou", score).where("iou > 0.05").select("uno", "due", F.round("iou", 4).alias("iou"))


@query(f"WITH {_ZSQL}, o AS (SELECT b.blocco_id, z.zona, greatest(least(block_bbox[3], zx1) - greatest(block_bbox[1], zx0), 0.0) * greatest(least(block_bbox[4], zy1) - greatest(block_bbox[2], zy0), 0.0) AS a FROM {B} b JOIN z USING (libro_id, pag)) SELECT blocco_id, max_by(CASE WHEN a > 0 THEN zona END, (coalesce(a, 0.0), zona))::int AS zona FROM o GROUP BY blocco_id")
def j15_best_zone(spark, d):
    b = blocks(spark, d).select("blocco_id", "libro_id", "pag", "block_bbox")
    return matching.best_overlap(b, _zones(spark, d), ["libro_id", "pag"], "blocco_id", G.box(F.col("block_bbox")), _zone_box(), "zona").select("blocco_id", "zona")


@query("SELECT libro_id, id, max_by(classe, (arrivo, sessione, prog)) AS classe FROM decisioni WHERE id IS NOT NULL GROUP BY libro_id, id")
def j16_latest_state(spark, d):
    return store.latest(table(spark, d, "decisioni").where("id is not null").select("libro_id", "id", "classe", "arrivo", "sessione", "prog"), ["libro_id", "id"], ["arrivo", "sessione", "prog"]).select("libro_id", "id", "classe")


@query(f"WITH {_UNITS}, h AS (SELECT u0.*, max(CASE WHEN score >= 0.8 THEN 1 ELSE 0 END) OVER (PARTITION BY file ORDER BY id ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS vicino FROM u0 JOIN (SELECT id, score FROM u WHERE tipo = 'regola') USING (id)), g AS (SELECT *, lead(vicino) OVER (PARTITION BY file ORDER BY id) AS dopo FROM h) SELECT id FROM g WHERE vicino = 1 OR (tok < 5 AND dopo = 1)")
def j19_neighbours(spark, d):
    return labels.neighbours(labels.thresholded(units(spark, d)), "regola", 1, 5).select("id")


@query(f"SELECT id, (letters = norm) OR (length(letters) >= 4 AND length(norm) >= 4 AND (contains(letters, norm) OR contains(norm, letters))) AS simile FROM (SELECT id, regexp_replace({T.ACCENTED and 'translate(lower(nome), ' + repr(T.ACCENTED) + ', ' + repr(T.FOLDED) + ')'}, '[^a-z0-9]', '', 'g') AS letters, regexp_replace(translate(lower(nome_norm), '{T.ACCENTED}', '{T.FOLDED}'), '[^a-z0-9]', '', 'g') AS norm FROM {E})")
def j20_alike_names(spark, d):
    e = entities(spark, d).select("id", T.letters_key(F.col("nome")).alias("a"), T.letters_key(F.col("nome_norm")).alias("b"))
    return e.select("id", ((F.col("a") == F.col("b")) | ((F.length("a") >= 4) & (F.length("b") >= 4) & (F.contains("a", F.col("b")) | F.contains("b", F.col("a"))))).alias("simile"))


@query("SELECT d.doc_id, CASE WHEN l.id IS NOT NULL THEN 'libro' WHEN t.id IS NOT NULL THEN 'tolto' ELSE 'nessuno' END AS dove FROM documents d LEFT JOIN (SELECT DISTINCT id FROM libri) l ON l.id = d.libro_id LEFT JOIN (SELECT DISTINCT id FROM libri_tolti) t ON t.id = d.libro_id")
def j21_cascading_lookup(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "libro_id")
    one, two = (table(spark, d, t).select(F.col("id").alias("libro_id"), F.lit(True).alias(t)).distinct() for t in ("libri", "libri_tolti"))
    return docs.join(one, "libro_id", "left").join(two, "libro_id", "left").select("doc_id", F.when(F.col("libri"), "libro").when(F.col("libri_tolti"), "tolto").otherwise("nessuno").alias("dove"))


@query(f"WITH w AS (SELECT DISTINCT libro_id, unnest(regexp_extract_all(block_content, '\\b[0-9lO]*[0-9][0-9lO]*\\b')) AS w FROM {B}), c AS (SELECT libro_id, w FROM w WHERE NOT regexp_matches(w, '[lO]')) SELECT b.libro_id, b.w AS letto, translate(b.w, 'lO', '10') AS giusto FROM w b WHERE regexp_matches(b.w, '[lO]') AND EXISTS (SELECT 1 FROM c WHERE c.libro_id = b.libro_id AND c.w = translate(b.w, 'lO', '10'))")
def j23_corpus_checked_codes(spark, d):
    # distinct codes per book first: the join sees types, not tokens
    w = table(spark, d, "pag_n_res").select("libro_id", F.explode(F.regexp_extract_all("block_content", F.lit(r"\b[0-9lO]*[0-9][0-9lO]*\b"), F.lit(0))).alias("w")).distinct()
    odd = w.where(F.col("w").rlike("[lO]")).select("libro_id", F.col("w").alias("letto"), F.translate("w", "lO", "10").alias("giusto"))
    return odd.join(w.where(~F.col("w").rlike("[lO]")).withColumnRenamed("w", "giusto"), ["libro_id", "giusto"], "left_semi").select("libro_id", "letto", "giusto")


@query(f"WITH p AS (SELECT libro_id, max(pag) AS m FROM pag_n_res GROUP BY libro_id), x AS (SELECT libro_id, unnest(range(1, m + 1))::int AS pag FROM p) SELECT * FROM x EXCEPT SELECT libro_id, pag FROM (SELECT DISTINCT libro_id, pag FROM pag_n_res WHERE block_label = 'number')")
def j25_missing_pages(spark, d):
    pages = table(spark, d, "pag_n_res").select("libro_id", "pag", "block_label")
    last = pages.groupBy("libro_id").agg(F.max("pag").alias("_m"))
    wanted = last.select("libro_id", F.explode(F.sequence(F.lit(1), "_m")).alias("pag"))
    return wanted.join(pages.where("block_label = 'number'").select("libro_id", "pag").distinct(), ["libro_id", "pag"], "left_anti")


@query(f"WITH r AS (SELECT blocco_id, unnest(regexp_extract_all(block_content, 'images/(fig_[0-9]+)\\.jpg', 1)) AS nome FROM {B}), f AS (SELECT DISTINCT 'fig_' || (blocco_id % 400) AS nome FROM {B} WHERE block_label IN ('image', 'figure')) SELECT r.blocco_id, r.nome, f.nome IS NOT NULL AS esiste FROM r LEFT JOIN f USING (nome)")
def j27_asset_references(spark, d):
    b = blocks(spark, d)
    refs = b.select("blocco_id", F.explode(F.regexp_extract_all("block_content", F.lit(r"images/(fig_[0-9]+)\.jpg"), F.lit(1))).alias("nome"))
    there = b.where(F.col("block_label").isin("image", "figure")).select(F.concat(F.lit("fig_"), F.col("blocco_id") % 400).alias("nome")).distinct().withColumn("_e", F.lit(True))
    return refs.join(there, "nome", "left").select("blocco_id", "nome", F.coalesce("_e", F.lit(False)).alias("esiste"))


@query(f"WITH i AS (SELECT * FROM {B} WHERE block_label IN ('image', 'figure') AND block_bbox IS NOT NULL), t AS (SELECT * FROM {B} WHERE block_label = 'text' AND block_bbox IS NOT NULL) SELECT i.blocco_id, min_by(t.blocco_id, (t.block_bbox[2] - i.block_bbox[4], t.blocco_id)) AS didascalia FROM i JOIN t USING (libro_id, pag) WHERE t.block_bbox[2] - i.block_bbox[4] BETWEEN -3 AND 40 AND least(i.block_bbox[3], t.block_bbox[3]) > greatest(i.block_bbox[1], t.block_bbox[1]) GROUP BY i.blocco_id")
def j29_caption_below(spark, d):
    b = blocks(spark, d).where(F.col("block_bbox").isNotNull())
    i = b.where(F.col("block_label").isin("image", "figure")).select("libro_id", "pag", "blocco_id", F.col("block_bbox").alias("p"))
    t = b.where("block_label = 'text'").select("libro_id", "pag", F.col("blocco_id").alias("didascalia"), F.col("block_bbox").alias("q"))
    gap = F.col("q")[1] - F.col("p")[3]
    near = i.join(t, ["libro_id", "pag"]).where(gap.between(-3, 40) & (G.x_overlap(G.box(F.col("p")), G.box(F.col("q"))) > 0))
    return matching.nearest(near.select("blocco_id", "didascalia", gap.alias("g")), ["blocco_id"], F.col("g"), ["didascalia"]).select("blocco_id", "didascalia")


@query(f"SELECT blocco_id, md5(replace(regexp_replace(replace(block_content, 'CA ', 'Classe Armatura '), '\\s+pf\\b', ' punti ferita', 'g'), '...', '…')) AS testo FROM {B}")
def j30_ordered_fixes(spark, d):
    rules = [{"find": "CA ", "replace": "Classe Armatura "}, {"find": r"\s+pf\b", "replace": " punti ferita", "regex": True}, {"find": "...", "replace": "…"}]
    return blocks(spark, d).select("blocco_id", F.md5(lines.ordered_rules(F.col("block_content"), rules)).alias("testo"))


@query()
def j20_trigram_names(spark, d):
    """Pairs of alike names over all names; no SQL: a nested loop there."""
    # exploded: else each filter folds the names once more
    names = table(spark, d, "entita").select(F.explode(F.array(T.ascii_words(F.col("nome")))).alias("uno")).where(F.length("uno") > 2).distinct()
    return matching.trigram_twins(names, "uno", "due", T.shingles(F.col("uno")), T.shingles(F.col("due")), 0.6)


# ---- aggregations ----
@query(f"SELECT tipologia, revisione, count(*) AS n FROM {E} WHERE libro_id IS NOT NULL GROUP BY tipologia, revisione")
def a01_counts_by_type(spark, d):
    return entities(spark, d).where("libro_id is not null").groupBy("tipologia", "revisione").count().withColumnRenamed("count", "n")


@query(f"WITH {_UNITS}, t AS (SELECT sum(tok) AS t FROM u0), x AS (SELECT tipo, tok FROM u WHERE score >= 0.8 UNION ALL SELECT 'nessuna', tok FROM u0 WHERE id NOT IN (SELECT id FROM u WHERE score >= 0.8)) SELECT tipo, count(*) AS unita, sum(tok)::bigint AS tok, round(100 * sum(tok) / greatest(max(t), 1), 2) AS quota FROM x, t GROUP BY tipo")
def a03_label_report(spark, d):
    return labels.label_report(labels.thresholded(units(spark, d)))


@query("SELECT source, count(*) AS file, sum(strlen(coalesce(text, '')))::bigint AS byte, round(sum(strlen(coalesce(text, ''))) / 6.3) AS parole FROM documents GROUP BY ROLLUP (source)")
def a04_listing_with_total(spark, d):
    size = F.sum(F.octet_length(F.coalesce("text", F.lit(""))))
    return table(spark, d, "documents").rollup("source").agg(F.count(F.lit(1)).alias("file"), size.cast("bigint").alias("byte"), F.round(size / 6.3).alias("parole"))


@query(f"WITH c AS (SELECT libro_id, block_label, count(*) AS peso, min(blocco_id) AS s FROM {B} GROUP BY ALL) SELECT libro_id, first(block_label ORDER BY peso DESC, s, block_label) AS block_label, max(peso) AS peso FROM c GROUP BY libro_id")
def a05_mode(spark, d):
    return labels.mode(blocks(spark, d), ["libro_id"], "block_label", seen="blocco_id")


@query(f"SELECT libro_id, round(median(block_bbox[4] - block_bbox[2]), 4) AS mediana FROM {B} WHERE length(block_content) > 2 GROUP BY libro_id")
def a06_median_height(spark, d):
    b = blocks(spark, d).where(F.length("block_content") > 2)
    return b.groupBy("libro_id").agg(F.round(F.median(F.col("block_bbox")[3] - F.col("block_bbox")[1]), 4).alias("mediana"))


@query(f"SELECT * FROM (SELECT libro_id, CASE WHEN (block_bbox[1]+block_bbox[3])/2 < width/3 THEN 'left' WHEN (block_bbox[1]+block_bbox[3])/2 > width*2/3 THEN 'right' ELSE 'centre' END AS posto, regexp_replace(regexp_replace(lower(trim(block_content)), '\\d+', '#', 'g'), '\\s+', ' ', 'g') AS chiave, count(DISTINCT pag) AS pagine FROM {B} WHERE block_content <> '' GROUP BY ALL HAVING count(DISTINCT pag) >= 2) WHERE chiave <> ''")
def a07_repeated_in_margins(spark, d):
    b = blocks(spark, d).where("block_content <> ''")
    return lines.repeated_lines(b, "libro_id", "pag", G.third(G.box(F.col("block_bbox")), F.col("width")), T.margin_key(F.col("block_content")))


@query(f"SELECT libro_id, lower(block_content) AS testo, count(*) AS volte FROM {B} WHERE block_label IN ('paragraph_title', 'doc_title', 'header') GROUP BY ALL HAVING count(*) >= 20")
def a08_frequent_titles(spark, d):
    return blocks(spark, d).where("block_label in ('paragraph_title', 'doc_title', 'header')").groupBy("libro_id", F.lower("block_content").alias("testo")).agg(F.count(F.lit(1)).alias("volte")).where("volte >= 20")


@query(f"SELECT tipologia, nome_norm, min(id) AS id, min_by(nome, id) AS nome FROM {E} WHERE nome_norm IS NOT NULL GROUP BY tipologia, nome_norm")
def a09_first_wins(spark, d):
    return labels.first_wins(entities(spark, d).where("nome_norm is not null").select("tipologia", "nome_norm", "id", "nome"), ["tipologia", "nome_norm"], ["id"])


def _pairs(spark, d):
    truth = F.filter(F.array(*[F.when((F.col("id") * (k + 2)) % 5 == 0, F.lit(x)) for k, x in enumerate(LABELS)]), lambda x: x.isNotNull())
    return units(spark, d).withColumn("veri", truth)


@query(f"WITH {_UNITS}, v AS (SELECT u.id, u.tipo, u.score, (u.id * (k + 1)) % 5 = 0 AS vero FROM u JOIN lab USING (tipo)), s AS (SELECT unnest([0.5, 0.6, 0.7, 0.8, 0.9]) AS soglia), r AS (SELECT soglia, id, count(*) FILTER (WHERE score >= soglia AND vero) AS tp, count(*) FILTER (WHERE score >= soglia AND NOT vero) AS fp, count(*) FILTER (WHERE score < soglia AND vero) AS fn FROM v, s GROUP BY soglia, id), t AS (SELECT soglia::double AS soglia, sum(tp)::bigint AS tp, sum(fp)::bigint AS fp, sum(fn)::bigint AS fn, round(avg(CASE WHEN fp = 0 AND fn = 0 THEN 1.0 ELSE 0.0 END), 4) AS esatti FROM r GROUP BY soglia) SELECT soglia, tp, fp, fn, round(tp / greatest(tp + fp, 1), 4) AS precisione, round(tp / greatest(tp + fn, 1), 4) AS richiamo, round(CASE WHEN tp > 0 THEN 2 * (tp / greatest(tp + fp, 1)) * (tp / greatest(tp + fn, 1)) / (tp / greatest(tp + fp, 1) + tp / greatest(tp + fn, 1)) ELSE 0.0 END, 4) AS f1, esatti FROM t")
def a10_threshold_sweep(spark, d):
    return labels.threshold_sweep(_pairs(spark, d), [0.5, 0.6, 0.7, 0.8, 0.9])


@query(f"SELECT tipologia, count(*) AS attese, count_if(json_valid(dati)) AS valide, count_if(dati IS NOT NULL AND NOT json_valid(dati)) AS rotte, round(100 * avg(CASE WHEN json_valid(dati) THEN 1.0 ELSE 0.0 END), 1) AS percento FROM {E} GROUP BY tipologia")
def a11_answer_summary(spark, d):
    # a broken text has no root value
    good = F.col("dati").isNotNull() & F.get_json_object("dati", "$").isNotNull()
    return entities(spark, d).groupBy("tipologia").agg(F.count(F.lit(1)).alias("attese"), F.count_if(good).alias("valide"), F.count_if(F.col("dati").isNotNull() & ~good).alias("rotte"), F.round(100 * F.avg(F.when(good, 1.0).otherwise(0.0)), 1).alias("percento"))


@query(f"SELECT libro_id, pag, min(block_bbox[1]) AS x0, min(block_bbox[2]) AS y0, max(block_bbox[3]) AS x1, max(block_bbox[4]) AS y1 FROM {B} GROUP BY libro_id, pag")
def a15_page_hull(spark, d):
    c = F.col("block_bbox")
    return blocks(spark, d).groupBy("libro_id", "pag").agg(F.min(c[0]).alias("x0"), F.min(c[1]).alias("y0"), F.max(c[2]).alias("x1"), F.max(c[3]).alias("y1"))


@query(f"SELECT libro_id, string_agg(DISTINCT tipologia, '|' ORDER BY tipologia) AS tipi, sum(length(nome))::bigint AS caratteri FROM {E} GROUP BY libro_id")
def a16_collected(spark, d):
    return entities(spark, d).groupBy("libro_id").agg(F.array_join(F.sort_array(F.collect_set("tipologia")), "|").alias("tipi"), F.sum(F.length("nome")).cast("bigint").alias("caratteri"))


@query("SELECT DISTINCT lower(lang) AS lang, source FROM documents ORDER BY 1, 2")
def a18_facets(spark, d):
    return table(spark, d, "documents").select(F.lower("lang").alias("lang"), "source").distinct().orderBy("lang", "source")


@query(f"WITH t AS (SELECT libro_id, pag, lag(pag) OVER (PARTITION BY libro_id ORDER BY pag, blocco_id) AS p FROM {B} WHERE block_label = 'paragraph_title') SELECT libro_id, round(avg(pag - p), 4) AS distanza FROM t GROUP BY libro_id")
def a19_mean_distance(spark, d):
    t = blocks(spark, d).where("block_label = 'paragraph_title'")
    run = Window.partitionBy("libro_id").orderBy("pag", "blocco_id")
    return t.select("libro_id", (F.col("pag") - F.lag("pag").over(run)).alias("d")).groupBy("libro_id").agg(F.round(F.avg("d"), 4).alias("distanza"))


@query("WITH x AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) SELECT user_id, max(n) > 15 AS ripetuto FROM x GROUP BY user_id")
def a21_loops(spark, d):
    return labels.loops(table(spark, d, "events"), "user_id", "event_type", 15)


@query(f"SELECT libro_id, pag, round(sum(greatest(block_bbox[3]-block_bbox[1],0.0)*greatest(block_bbox[4]-block_bbox[2],0.0)) / max(width*height), 4) AS coperta, count(*) FILTER (WHERE block_label = 'paragraph_title') AS titoli FROM {B} GROUP BY libro_id, pag")
def a22_page_coverage(spark, d):
    return blocks(spark, d).groupBy("libro_id", "pag").agg(F.round(F.sum(G.area(G.box(F.col("block_bbox")))) / F.max(F.col("width") * F.col("height")), 4).alias("coperta"), F.count_if(F.col("block_label") == "paragraph_title").alias("titoli"))


@query("SELECT user_id, max(ts) AS ultimo, max_by(event_type, (ts, event_id)) AS tipo FROM events GROUP BY user_id")
def a24_last_access(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.max("ts").alias("ultimo"), F.max_by("event_type", F.struct("ts", "event_id")).alias("tipo"))


@query("SELECT (SELECT count(*) FROM libri) AS libri, (SELECT count(*) FROM entita) AS entita, (SELECT count(DISTINCT blocco_id) FROM pag_n_res) AS blocchi")
def a25_scalar_counts(spark, d):
    one = table(spark, d, "libri").agg(F.count(F.lit(1)).alias("libri"))
    two = table(spark, d, "entita").agg(F.count(F.lit(1)).alias("entita"))
    three = table(spark, d, "pag_n_res").agg(F.countDistinct("blocco_id").alias("blocchi"))
    return one.crossJoin(two).crossJoin(three)  # of single rows


@query(f"SELECT libro_id, count(DISTINCT (pag)) AS pagine, count_if(block_content IS NULL OR block_content = '') AS vuoti, round(100.0 * count_if(block_label = 'text') / greatest(count(*), 1), 1) AS testo FROM {B} GROUP BY libro_id")
def a30_progress(spark, d):
    return blocks(spark, d).groupBy("libro_id").agg(F.countDistinct("pag").alias("pagine"), F.count_if(F.col("block_content").isNull() | (F.col("block_content") == "")).alias("vuoti"), F.round(100.0 * F.count_if(F.col("block_label") == "text") / F.count(F.lit(1)), 1).alias("testo"))


# ---- windows ----
@query(f"SELECT blocco_id, row_number() OVER (PARTITION BY libro_id ORDER BY pag, idx) - 1 AS n, lpad((row_number() OVER (PARTITION BY libro_id ORDER BY pag, idx))::varchar, 6, '0') AS codice FROM {B}")
def w01_sequence(spark, d):
    from scriptorium.operators.scans import ranked

    r = ranked(blocks(spark, d).select("blocco_id", "libro_id", "pag", "idx"), ["libro_id"], ["pag", "idx"], F.floor(F.col("pag") / 256))
    return r.select("blocco_id", (F.col("rango") - 1).alias("n"), F.lpad(F.col("rango").cast("string"), 6, "0").alias("codice"))


@query(f"SELECT blocco_id, substring(lag(block_content) OVER w, 1, 90) AS prima, substring(lead(block_content) OVER w, 1, 90) AS dopo, lead(block_label, 2) OVER w AS terzo FROM {B} WINDOW w AS (PARTITION BY libro_id, pag ORDER BY idx)")
def w02_neighbours(spark, d):
    w = Window.partitionBy("libro_id", "pag").orderBy("idx")
    return blocks(spark, d).select("blocco_id", F.substring(F.lag("block_content").over(w), 1, 90).alias("prima"), F.substring(F.lead("block_content").over(w), 1, 90).alias("dopo"), F.lead("block_label", 2).over(w).alias("terzo"))


@query(f"""WITH {_UNITS}, n AS (SELECT *, row_number() OVER (PARTITION BY tipo, file ORDER BY id) AS i FROM u), x AS (SELECT * FROM n WHERE score >= 0.8),
y AS (SELECT *, lag(i) OVER (PARTITION BY tipo, file ORDER BY id) AS pi, max(fine) OVER (PARTITION BY tipo, file ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pf FROM x),
g AS (SELECT *, sum(CASE WHEN pi = i - 1 AND inizio - pf <= 3 THEN 0 ELSE 1 END) OVER (PARTITION BY tipo, file ORDER BY id) AS g FROM y)
SELECT tipo, file, min(inizio) AS inizio, max(fine) AS fine, count(*) AS unita, sum(tok)::bigint AS tok, round(avg(score), 3) AS punteggio_medio FROM g GROUP BY tipo, file, g""")
def w03_interval_merge(spark, d):
    return labels.label_intervals(labels.thresholded(units(spark, d)))


@query(f"SELECT blocco_id, last_value(CASE WHEN block_label LIKE '%title' THEN block_content END IGNORE NULLS) OVER (PARTITION BY libro_id ORDER BY pag, idx ROWS UNBOUNDED PRECEDING) AS titolo FROM {B}")
def w04_running_title(spark, d):
    rows = blocks(spark, d).withColumn("_t", F.when(F.col("block_label").like("%title"), F.col("block_content")))
    return lines.carried(rows, ["libro_id"], ["pag", "idx"], "_t", "titolo").select("blocco_id", "titolo")


@query(f"SELECT blocco_id, coalesce(last_value(CASE WHEN block_label = 'table' THEN true WHEN block_label LIKE '%title' THEN false END IGNORE NULLS) OVER (PARTITION BY libro_id ORDER BY pag, idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS dentro FROM {B}")
def w05_open_state(spark, d):
    run = Window.partitionBy("libro_id").orderBy("pag", "idx").rowsBetween(Window.unboundedPreceding, -1)
    event = F.when(F.col("block_label") == "table", True).when(F.col("block_label").like("%title"), False)
    return blocks(spark, d).select("blocco_id", F.coalesce(F.last(event, ignorenulls=True).over(run), F.lit(False)).alias("dentro"))


@query(f"SELECT blocco_id, bool_or(block_label = 'table') OVER (PARTITION BY libro_id, pag ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING) AS tabella_presto FROM {B}")
def w09_look_ahead(spark, d):
    w = Window.partitionBy("libro_id", "pag").orderBy("idx").rowsBetween(1, 3)
    return blocks(spark, d).select("blocco_id", F.bool_or(F.col("block_label") == "table").over(w).alias("tabella_presto"))


@query(f"SELECT blocco_id, pag AS inizio, coalesce(lead(pag) OVER (PARTITION BY libro_id ORDER BY pag, idx) - 1, 99999) AS fine FROM {B} WHERE block_label = 'doc_title'")
def w11_span_end(spark, d):
    run = Window.partitionBy("libro_id").orderBy("pag", "idx")
    return blocks(spark, d).where("block_label = 'doc_title'").select("blocco_id", F.col("pag").alias("inizio"), F.coalesce(F.lead("pag").over(run) - 1, F.lit(99999)).alias("fine"))


@query(f"SELECT DISTINCT libro_id, pag, min(block_bbox[2]) OVER (PARTITION BY libro_id, pag) AS alto, first_value(block_label) OVER (PARTITION BY libro_id, pag ORDER BY idx) AS primo FROM {B}")
def w14_first_on_page(spark, d):
    return blocks(spark, d).groupBy("libro_id", "pag").agg(F.min(F.col("block_bbox")[1]).alias("alto"), F.min_by("block_label", "idx").alias("primo"))


# ---- order, limit, top-k ----
@query("""WITH q AS (SELECT doc_id, source, lower(text) AS low, text, trim(regexp_replace(string_split(text, chr(10))[1], '^[#*\\s]+', '')) AS titolo FROM documents WHERE text IS NOT NULL),
s AS (SELECT *, (length(low) - length(replace(low, 'regola', ''))) // 6 AS c1, (length(low) - length(replace(low, 'copertura', ''))) // 9 AS c2, (length(low) - length(replace(low, 'regola copertura', ''))) // 16 AS cp FROM q),
t AS (SELECT doc_id, source, length(text) AS n, (c1 + c2 + CASE WHEN contains(lower(titolo), 'regola') THEN 40 ELSE 0 END + CASE WHEN contains(lower(titolo), 'copertura') THEN 40 ELSE 0 END + 15 * least(10, cp) + CASE WHEN contains(lower(titolo), 'regola copertura') THEN 300 ELSE 0 END)::bigint AS p FROM s WHERE c1 > 0 AND c2 > 0)
SELECT doc_id, source, CASE WHEN n < 250 THEN p // 2 ELSE p END AS punti FROM t ORDER BY punti DESC, source, doc_id LIMIT 80""")
def t01_ranked_search(spark, d):
    return search.ranked(table(spark, d, "documents"), "regola copertura").select("doc_id", "source", "punti")


@query(f"SELECT file, row_number() OVER (ORDER BY coalesce(try_cast(regexp_extract(file, '^[0-9]+') AS bigint), 1000000000), file) AS posto FROM (SELECT DISTINCT file FROM entita WHERE file IS NOT NULL)")
def t02_natural_order(spark, d):
    from scriptorium.operators.scans import ranked

    f = table(spark, d, "entita").select("file").where(F.col("file").isNotNull()).distinct()
    f = f.select("file", F.coalesce(F.regexp_extract("file", "^[0-9]+", 0).try_cast("bigint"), F.lit(1000000000)).alias("_n"), F.lit(1).alias("_k"))
    return ranked(f, ["_k"], ["_n", "file"], F.floor(F.col("_n") / 16)).select("file", F.col("rango").alias("posto"))


@query("SELECT source, max_by(doc_id, (acquisito_il, doc_id)) AS doc_id FROM documents WHERE acquisito_il IS NOT NULL GROUP BY source")
def t03_newest(spark, d):
    return table(spark, d, "documents").where("acquisito_il is not null").groupBy("source").agg(F.max_by("doc_id", F.struct("acquisito_il", "doc_id")).alias("doc_id"))


@query(f"SELECT libro_id, pag, string_agg(idx::varchar, ',' ORDER BY block_order NULLS LAST, idx) AS ordine FROM {B} GROUP BY libro_id, pag")
def t07_reading_order(spark, d):
    key = F.struct(F.col("block_order").isNull().alias("a"), F.col("block_order").alias("b"), "idx")
    return blocks(spark, d).groupBy("libro_id", "pag").agg(F.array_join(F.transform(F.array_sort(F.collect_list(key)), lambda x: x["idx"].cast("string")), ",").alias("ordine"))


@query("SELECT doc_id FROM documents ORDER BY md5('7-' || doc_id), doc_id LIMIT 100")
def t10_seeded_sample(spark, d):
    return table(spark, d, "documents").orderBy(F.md5(F.concat(F.lit("7-"), F.col("doc_id"))), "doc_id").limit(100).select("doc_id")


@query(f"SELECT libro_id, arg_max(blocco_id, (length(block_content), -blocco_id)) AS blocco_id, max(length(block_content)) AS lunghezza FROM {B} WHERE block_content IS NOT NULL GROUP BY libro_id")
def t12_longest(spark, d):
    b = blocks(spark, d).where(F.col("block_content").isNotNull())
    return b.groupBy("libro_id").agg(F.max_by("blocco_id", F.struct(F.length("block_content"), -F.col("blocco_id"))).alias("blocco_id"), F.max(F.length("block_content")).cast("bigint").alias("lunghezza"))


# ---- sets ----
@query("SELECT libro_id FROM documents WHERE libro_id IS NOT NULL EXCEPT SELECT id FROM libri")
def u01_difference(spark, d):
    return table(spark, d, "documents").select("libro_id").where("libro_id is not null").distinct().join(table(spark, d, "libri").select(F.col("id").alias("libro_id")), "libro_id", "left_anti")


@query(f"WITH w AS (SELECT id, list_filter(string_split(lower(trim(nome)), ' '), lambda w: length(w) > 1) AS p FROM {E} WHERE nome IS NOT NULL), k AS (SELECT id, p, list_filter(p, lambda w: NOT list_contains([{', '.join(repr(w) for w in T.STOP_WORDS)}], w)) AS q FROM w) SELECT id, CASE WHEN len(q) > 0 THEN q ELSE p END AS parole FROM k")
def u03_without_stop_words(spark, d):
    stop = F.array(*[F.lit(w) for w in T.STOP_WORDS])
    words = F.filter(F.split(F.lower(F.trim("nome")), " "), lambda x: F.length(x) > 1)
    kept = F.filter(words, lambda x: ~F.array_contains(stop, x))
    return entities(spark, d).where("nome is not null").select("id", F.when(F.size(kept) > 0, kept).otherwise(words).alias("parole"))


@query("SELECT chiave, min_by(tabella, p) AS tabella FROM (SELECT libro_id AS chiave, 'documents' AS tabella, 2 AS p FROM documents UNION ALL SELECT libro_id, 'entita', 1 FROM entita UNION ALL SELECT id, 'libri', 0 FROM libri) WHERE chiave IS NOT NULL GROUP BY chiave")
def u04_union_by_priority(spark, d):
    sources = (("libri", "id"), ("entita", "libro_id"), ("documents", "libro_id"))
    parts = [table(spark, d, t).select(F.col(c).alias("chiave"), F.lit(t).alias("tabella"), F.lit(p).alias("p")).where("chiave is not null").distinct() for p, (t, c) in enumerate(sources)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("chiave").agg(F.min_by("tabella", "p").alias("tabella"))


@query(f"WITH {_UNITS} SELECT file, string_agg(DISTINCT tipo, '|' ORDER BY tipo) AS tipi FROM u WHERE score >= 0.8 GROUP BY file")
def u07_label_union(spark, d):
    return labels.thresholded(units(spark, d)).select("file", F.explode("tipi").alias("tipo")).groupBy("file").agg(F.array_join(F.sort_array(F.collect_set("tipo")), "|").alias("tipi"))


# ---- filters and cases ----
@query(f"WITH {_UNITS} SELECT u0.id, coalesce(string_agg(u.tipo, '|' ORDER BY u.tipo), '') AS tipi FROM u0 LEFT JOIN u ON u.id = u0.id AND u.score >= 0.8 GROUP BY u0.id")
def pr01_threshold(spark, d):
    return labels.thresholded(units(spark, d)).select("id", F.array_join("tipi", "|").alias("tipi"))


@query(f"SELECT id, array_to_string(list_filter([CASE WHEN length(trim(coalesce(nome, ''))) < 3 OR length(trim(coalesce(nome, ''))) > 80 THEN 'lunghezza' END, CASE WHEN NOT regexp_matches(trim(coalesce(nome, '')), '\\p{{L}}') THEN 'senza lettere' END, CASE WHEN trim(coalesce(file, '')) = '' THEN 'manca file' END, CASE WHEN trim(coalesce(adapter, '')) = '' THEN 'manca adapter' END], lambda x: x IS NOT NULL), '; ') AS avvisi FROM {E}")
def pr03_warnings(spark, d):
    return entities(spark, d).select("id", F.array_join(store.warnings_of(F.col("nome"), {"file": F.col("file"), "adapter": F.col("adapter")}), "; ").alias("avvisi"))


@query(f"SELECT id, righe.lo AS lo, CASE WHEN righe.lo <= righe.hi THEN righe.hi + 1 END AS hi FROM {E} WHERE righe.lo <= righe.hi")
def pr05_line_ranges(spark, d):
    r = store.line_range(F.col("righe.lo"), F.col("righe.hi"), F.lit(True))
    return entities(spark, d).select("id", r.alias("r")).where("r is not null").select("id", "r.lo", "r.hi")


@query(f"SELECT doc_id FROM documents WHERE contains(lower(text), 'regola') AND lang IN ('it', 'en') AND source = 'avventure' AND libro_id IS NOT NULL AND n_chars > 300")
def pr07_facets(spark, d):
    return table(spark, d, "documents").where(F.col("lang").isin("it", "en") & (F.col("source") == "avventure") & F.col("libro_id").isNotNull() & (F.col("n_chars") > 300) & F.contains(F.lower("text"), F.lit("regola"))).select("doc_id")


@query(f"""WITH b AS (SELECT *, lead(block_label) OVER (PARTITION BY libro_id, pag ORDER BY idx) AS dopo, count(*) OVER (PARTITION BY libro_id, lower(block_content)) AS volte FROM {B} WHERE block_label IN ('paragraph_title', 'doc_title', 'text', 'table'))
SELECT blocco_id, CASE WHEN volte >= 20 THEN 'ripetuto' WHEN regexp_matches(block_content, '^[\\d\\s.,;:/+\\-–—()]+$') THEN 'numeri' WHEN regexp_matches(lower(block_content), '^\\s*\\d*d(?:4|6|8|10|12|20|100)\\b') THEN 'dadi' WHEN dopo = 'table' THEN 'tabella' ELSE 'titolo' END AS proposta FROM b WHERE block_label IN ('paragraph_title', 'doc_title')""")
def pr10_title_classifier(spark, d):
    page = Window.partitionBy("libro_id", "pag").orderBy("idx")
    b = blocks(spark, d).where(F.col("block_label").isin("paragraph_title", "doc_title", "text", "table")).withColumn("dopo", F.lead("block_label").over(page)).withColumn("_k", F.lower("block_content"))
    titles = b.where(F.col("block_label").isin("paragraph_title", "doc_title"))
    often = b.groupBy("libro_id", "_k").agg(F.count(F.lit(1)).alias("volte"))
    c = F.col("block_content")
    case = F.when(F.col("volte") >= 20, "ripetuto").when(T.only_numbers(c), "numeri").when(T.dice_header(c), "dadi").when(F.col("dopo") == "table", "tabella").otherwise("titolo")
    return titles.join(often, ["libro_id", "_k"]).select("blocco_id", case.alias("proposta"))


@query(f"SELECT blocco_id, max(CASE WHEN regexp_matches(lower(block_content), 'licenza') THEN 1 ELSE 0 END) OVER (PARTITION BY libro_id, pag ORDER BY idx ROWS UNBOUNDED PRECEDING) = 1 AS dopo_licenza FROM {B} WHERE pag <= 8")
def pr11_after_credits(spark, d):
    run = Window.partitionBy("libro_id", "pag").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    hit = F.when(F.lower("block_content").rlike("licenza"), 1).otherwise(0)
    return blocks(spark, d).where("pag <= 8").select("blocco_id", (F.max(hit).over(run) == 1).alias("dopo_licenza"))


@query("SELECT libro_id, sessione, prog, CASE WHEN annulla THEN 'annulla' WHEN id IS NULL THEN 'rifiutata' WHEN livello NOT BETWEEN 1 AND 6 THEN 'livello' ELSE 'valida' END AS esito FROM (SELECT DISTINCT libro_id, sessione, prog, id, annulla, livello FROM decisioni)")
def pr27_decision_checks(spark, d):
    case = F.when(F.col("annulla"), "annulla").when(F.col("id").isNull(), "rifiutata").when(~F.col("livello").between(1, 6), "livello").otherwise("valida")
    return table(spark, d, "decisioni").select("libro_id", "sessione", "prog", "id", "annulla", "livello").distinct().select("libro_id", "sessione", "prog", case.alias("esito"))


@query("SELECT event_id FROM events WHERE event_type = 'error' AND user_id BETWEEN 10 AND 60 AND value > 10")
def pr26_log_filter(spark, d):
    return table(spark, d, "events").where((F.col("event_type") == "error") & F.col("user_id").between(10, 60) & (F.col("value") > 10)).select("event_id")


@query(f"SELECT blocco_id, CASE WHEN block_label = 'doc_title' THEN '# ' || block_content WHEN block_label = 'paragraph_title' THEN '## ' || block_content WHEN block_label IN ('header', 'footer', 'number', 'image', 'figure') THEN '' ELSE coalesce(block_content, '') END AS resa FROM {B}")
def pr30_rendered(spark, d):
    c, lab = F.col("block_content"), F.col("block_label")
    out = F.when(lab == "doc_title", F.concat(F.lit("# "), c)).when(lab == "paragraph_title", F.concat(F.lit("## "), c)).when(lab.isin("header", "footer", "number", "image", "figure"), "").otherwise(F.coalesce(c, F.lit("")))
    return blocks(spark, d).select("blocco_id", out.alias("resa"))


@query(f"SELECT blocco_id, CASE WHEN block_label IN ('image', 'figure') THEN '<!-- figura ' || row_number() OVER (PARTITION BY libro_id, pag, block_label IN ('image', 'figure') ORDER BY idx) || ' -->' ELSE block_label END AS segno FROM {B}")
def pr31_picture_counter(spark, d):
    pic = F.col("block_label").isin("image", "figure")
    run = Window.partitionBy("libro_id", "pag", "_p").orderBy("idx")
    return blocks(spark, d).withColumn("_p", pic).select("blocco_id", F.when(F.col("_p"), F.concat(F.lit("<!-- figura "), F.row_number().over(run).cast("string"), F.lit(" -->"))).otherwise(F.col("block_label")).alias("segno"))


# ---- sources, sinks and text structure ----
@query(f"WITH {_LINES} SELECT doc_id, n, riga FROM l")
def s05_chapter_lines(spark, d):
    return lines.exploded_lines(table(spark, d, "documents"), ["doc_id"])


@query(f"SELECT id, CASE WHEN dati IS NULL THEN 'nullo' WHEN NOT json_valid(dati) THEN 'rotto' WHEN json_type(dati) = 'OBJECT' THEN 'oggetto' ELSE 'elenco' END AS forma FROM {E}")
def s06_tolerant_json(spark, d):
    root = F.get_json_object("dati", "$")
    return entities(spark, d).select("id", F.when(F.col("dati").isNull(), "nullo").when(root.isNull(), "rotto").when(F.startswith(F.ltrim("dati"), F.lit("{")), "oggetto").otherwise("elenco").alias("forma"))


@query("SELECT event_id, ts FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY")
def s12_recent_log(spark, d):
    e = table(spark, d, "events")
    last = e.agg(F.max("ts").alias("_m"))
    return e.crossJoin(F.broadcast(last)).where(F.col("ts") >= F.col("_m") - F.expr("interval 7 days")).select("event_id", "ts")


@query(f"WITH p AS (SELECT libro_id, pag, regexp_replace(string_agg(block_content, chr(10) || chr(10) ORDER BY idx, blocco_id), '^# [^\\n]* - Pagina [0-9]+\\s*', '') AS t FROM {B} WHERE block_content IS NOT NULL GROUP BY libro_id, pag) SELECT libro_id, pag // 50 AS parte, md5(string_agg(t, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY pag)) AS testo FROM p GROUP BY libro_id, pag // 50")
def k03_whole_book(spark, d):
    """The whole of each book without page headings, all pages in order, in ordered parts."""
    return lines.book_parts(table(spark, d, "pag_n_res"), "libro_id", "pag", ["idx", "blocco_id"], "block_content", heading=r"^# [^\n]* - Pagina [0-9]+\s*").select("libro_id", "parte", F.md5("testo").alias("testo"))


@query(f"WITH p AS (SELECT libro_id, pag, string_agg(block_content, chr(10) || chr(10) ORDER BY idx, blocco_id) AS t FROM {B} WHERE block_content IS NOT NULL GROUP BY libro_id, pag) SELECT libro_id, pag // 50 AS parte, min(pag) AS da, max(pag) AS a, string_agg(t, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY pag) AS testo FROM p GROUP BY libro_id, pag // 50")
def k03_all_pages(spark, d):
    """The whole of each book: all its pages in order; k03_whole_book has blocks of the first three pages only."""
    return lines.book_parts(table(spark, d, "pag_n_res"), "libro_id", "pag", ["idx", "blocco_id"], "block_content")


@query("SELECT d.doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM etichette_doc e WHERE e.doc_id = d.doc_id)")
def k05_resume(spark, d):
    return store.resumed(table(spark, d, "documents"), table(spark, d, "etichette_doc"), "doc_id").select("doc_id")


@query(f"SELECT tipologia, nome, id FROM {E} ORDER BY tipologia, nome, id LIMIT 300")
def k10_report(spark, d):
    return entities(spark, d).select("tipologia", "nome", "id").orderBy("tipologia", "nome", "id").limit(300)


@query(f"WITH {_LINES}, f AS (SELECT *, CASE WHEN regexp_matches(riga, '[^ \\t\\r]') THEN 1 ELSE 0 END AS pieno FROM l), g AS (SELECT *, n - sum(pieno) OVER (PARTITION BY doc_id ORDER BY n) AS g FROM f) SELECT doc_id, min(n) AS inizio, max(n) AS fine, md5(string_agg(riga, chr(10) ORDER BY n)) AS testo FROM g WHERE pieno = 1 GROUP BY doc_id, g")
def l01_paragraph_blocks(spark, d):
    return lines.text_blocks(table(spark, d, "documents"), ["doc_id"]).select("doc_id", "inizio", "fine", F.md5("testo").alias("testo"))


@query(f"WITH {_LINES}, c AS (SELECT *, sum(CASE WHEN starts_with(riga, '## ') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n) AS c FROM l) SELECT doc_id, count(DISTINCT c) FILTER (WHERE starts_with(riga, '## ')) AS capitoli, sum(length(riga))::bigint AS caratteri FROM c GROUP BY doc_id")
def l06_chapter_split(spark, d):
    parts = lines.chapters(table(spark, d, "documents"), ["doc_id"])
    body = F.sum(F.length(F.replace("testo", F.lit("\n"), F.lit(""))))
    full = table(spark, d, "documents").where("text is not null").select("doc_id", F.length(F.replace("text", F.lit("\n"), F.lit(""))).cast("bigint").alias("caratteri"))
    return full.join(parts.groupBy("doc_id").agg(F.count("titolo").alias("capitoli"), body.alias("_b")), "doc_id", "left").select("doc_id", F.coalesce("capitoli", F.lit(0)).alias("capitoli"), "caratteri")


@query(f"WITH g AS (SELECT libro_id, pag, blocco_id, block_bbox[2] AS y0, max(block_bbox[4]) OVER (PARTITION BY libro_id, pag ORDER BY block_bbox[2], idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prima FROM {B} WHERE block_bbox IS NOT NULL) SELECT libro_id, pag, count(*) FILTER (WHERE prima IS NULL OR y0 - prima > 24) AS gruppi FROM g GROUP BY libro_id, pag")
def l24_vertical_groups(spark, d):
    b = blocks(spark, d).where(F.col("block_bbox").isNotNull()).select("libro_id", "pag", "idx", F.col("block_bbox")[1].alias("y0"), F.col("block_bbox")[3].alias("y1"))
    far = F.max("y1").over(Window.partitionBy("libro_id", "pag").orderBy("y0", "idx").rowsBetween(Window.unboundedPreceding, -1))
    return b.withColumn("_f", far).groupBy("libro_id", "pag").agg(F.count_if(F.col("_f").isNull() | (F.col("y0") - F.col("_f") > 24)).alias("gruppi"))


@query("WITH t AS (SELECT doc_id, lower(lang) AS lang, unnest(list_distinct(regexp_split_to_array(lower(text), '[^a-zàèéìòù]+'))) AS termine FROM documents WHERE text IS NOT NULL) SELECT lang, termine, count(*) AS documenti FROM t WHERE length(termine) > 3 GROUP BY lang, termine HAVING count(*) >= 20")
def x79_inverted_index(spark, d):
    docs = table(spark, d, "documents").where("text is not null")
    terms = docs.select(F.lower("lang").alias("lang"), F.explode(F.array_distinct(F.split(F.lower("text"), "[^a-zàèéìòù]+"))).alias("termine")).where(F.length("termine") > 3)
    return terms.groupBy("lang", "termine").agg(F.count(F.lit(1)).alias("documenti")).where("documenti >= 20")


@query(r"WITH a AS (SELECT doc_id, lower(lang) AS lang, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}]+') AS l FROM documents WHERE text IS NOT NULL), t AS (SELECT doc_id, lang, unnest(l) AS termine, generate_subscripts(l, 1) AS p FROM a) SELECT lang, termine, doc_id, count(*) AS n, list(p ORDER BY p) AS posizioni FROM t GROUP BY lang, termine, doc_id")
def x79_postings(spark, d):
    """The inverted index itself, over all terms; x79_inverted_index counts documents of frequent terms only."""
    return search.postings(table(spark, d, "documents"))


@query("WITH a AS (SELECT doc_id, string_split(text, chr(10)) AS r FROM documents WHERE text IS NOT NULL) SELECT doc_id, CASE WHEN r[1] = '' OR len(r) < 2 OR r[2] = '' THEN 0.0 WHEN r[2] = r[1] THEN 1.0 WHEN starts_with(r[2], r[1]) THEN 0.95 WHEN instr(r[2], r[1]) BETWEEN 1 AND 61 THEN 0.85 WHEN replace(r[1], ' ', '') <> '' AND starts_with(replace(r[2], ' ', ''), replace(r[1], ' ', '')) THEN 0.9 WHEN length(r[1]) >= 12 AND abs(length(r[1]) - length(r[2])) <= 3 AND levenshtein(r[1], r[2]) <= greatest(1, floor(length(r[1]) * 0.08)) THEN 0.88 ELSE 0.0 END::double AS punti FROM a")
def x10_similarity(spark, d):
    r = F.split("text", "\n")
    return table(spark, d, "documents").where("text is not null").select("doc_id", T.similarity(F.try_element_at(r, F.lit(1)), F.coalesce(F.try_element_at(r, F.lit(2)), F.lit(""))).alias("punti"))


@query("SELECT date_trunc('day', ts) AS giorno, event_type, count(*) AS n, round(sum(value), 4) AS somma FROM events GROUP BY ALL")
def z01_daily_counts(spark, d):
    return table(spark, d, "events").groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("giorno"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("somma"))


@query("WITH e AS (SELECT *, CASE WHEN epoch(ts) - lag(epoch(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) < 43200 THEN 0 ELSE 1 END AS f FROM events), s AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM e) SELECT user_id, min(ts) AS inizio, count(*) AS eventi FROM s GROUP BY user_id, s")
def z04_sessions(spark, d):
    run = Window.partitionBy("user_id").orderBy("ts", "event_id")
    gap = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lag("ts").over(run).cast("timestamp"))
    e = table(spark, d, "events").withColumn("_f", F.when(gap < 43_200_000_000, 0).otherwise(1)).withColumn("_s", F.sum("_f").over(run))
    return e.groupBy("user_id", "_s").agg(F.min("ts").alias("inizio"), F.count(F.lit(1)).alias("eventi")).drop("_s")


@query("SELECT event_id, ts FROM events WHERE ts >= timestamp '2024-01-15'")
def z11_retention(spark, d):
    return table(spark, d, "events").where(F.col("ts") >= F.to_timestamp_ntz(F.lit("2024-01-15"))).select("event_id", "ts")


@query(f"""WITH e AS (SELECT DISTINCT l_suppkey AS k, l_orderkey % 5000 AS lo, l_orderkey % 5000 + l_linenumber AS hi FROM lineitem),
m AS (SELECT *, max(hi) OVER (PARTITION BY k ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM e), g AS (SELECT *, sum(CASE WHEN p IS NULL OR lo > p THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY lo, hi) AS g FROM m), s AS (SELECT k, g, min(lo) AS lo, max(hi) AS hi FROM g GROUP BY k, g)
SELECT k, 'periodo' AS tipo, lo, hi FROM s UNION ALL SELECT k, 'lacuna', hi, n FROM (SELECT k, hi, lead(lo) OVER (PARTITION BY k ORDER BY lo) AS n FROM s) WHERE n IS NOT NULL""")
def w15_stretches_of_orders(spark, d):
    r = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("k"), (F.col("l_orderkey") % 5000).alias("lo"), (F.col("l_orderkey") % 5000 + F.col("l_linenumber")).alias("hi"))
    return stretches_and_gaps(r, ["k"])
