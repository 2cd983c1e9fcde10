"""Further joins, folds, page rules and JSON functions as queries over the project's tables, with SQL where it can state them."""

from __future__ import annotations

import difflib

from pyspark.sql import Window
from pyspark.sql import functions as F

from scriptorium.functions import text as T
from scriptorium.operators import alignment, labels, store
from scriptorium.plans.relational import _UNITS, LABELS, B, E, blocks, entities, units
from scriptorium.session import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_KEY = r"regexp_replace(lower({}), '[^\p{{L}}\p{{N}}]+', '', 'g')"


@query(f"SELECT e.id, d.doc_id AS finestra, d.source FROM {E} e LEFT JOIN documents d ON d.doc_id = e.id % 1500")
def j04_entity_windows(spark, d):
    return entities(spark, d).select("id", (F.col("id") % 1500).alias("_f")).join(table(spark, d, "documents").select("doc_id", "source"), F.col("_f") == F.col("doc_id"), "left").select("id", F.col("doc_id").alias("finestra"), "source")


@query(f"""WITH a AS (SELECT DISTINCT libro_id, {T.ACCENTED and "regexp_replace(translate(lower(nome_norm), '" + T.ACCENTED + "', '" + T.FOLDED + "'), '[^a-z0-9]', '', 'g')"} AS k, tipologia FROM entita WHERE libro_id IS NOT NULL AND nome_norm IS NOT NULL), q AS (SELECT DISTINCT libro_id, k AS chiave FROM a WHERE tipologia = 'incantesimo'), o AS (SELECT DISTINCT libro_id, k AS altra FROM a WHERE tipologia = 'oggetto'),
m AS (SELECT q.libro_id, chiave, altra, CASE WHEN chiave = altra THEN 0 ELSE 1 END AS p FROM q JOIN o USING (libro_id) WHERE chiave = altra OR (length(chiave) >= 4 AND length(altra) >= 4 AND (contains(chiave, altra) OR contains(altra, chiave))))
SELECT q.libro_id, q.chiave, (SELECT first(m.altra ORDER BY m.p, length(m.altra), m.altra) FROM m WHERE m.libro_id = q.libro_id AND m.chiave = q.chiave) AS trovato FROM q""")
def j22_cascading_match(spark, d):
    e = table(spark, d, "entita").where("libro_id is not null and nome_norm is not null").select("libro_id", "tipologia", T.letters_key(F.col("nome_norm")).alias("k"))
    return alignment.cascading_match(e.where("tipologia = 'incantesimo'").withColumnRenamed("k", "chiave"), e.where("tipologia = 'oggetto'").withColumnRenamed("k", "altra"), ["libro_id"], "chiave", "altra")


@query(f"""WITH k AS (SELECT libro_id, CASE WHEN (block_bbox[1]+block_bbox[3])/2 < width/3 THEN 'left' WHEN (block_bbox[1]+block_bbox[3])/2 > width*2/3 THEN 'right' ELSE 'centre' END AS posto, regexp_replace(regexp_replace(lower(trim(block_content)), '\\d+', '#', 'g'), '\\s+', ' ', 'g') AS chiave, pag, blocco_id FROM {B} WHERE block_content <> ''),
r AS (SELECT libro_id, posto, chiave FROM k WHERE chiave <> '' GROUP BY ALL HAVING count(DISTINCT pag) >= 2) SELECT k.blocco_id, r.chiave IS NOT NULL AS ripetuta FROM k LEFT JOIN r ON r.libro_id = k.libro_id AND r.posto = k.posto AND r.chiave = k.chiave""")
def j24_repetition_lookup(spark, d):
    from scriptorium.functions import geometry as G
    from scriptorium.operators import lines

    b = blocks(spark, d).where("block_content <> ''").select("blocco_id", "libro_id", "pag", G.third(G.box(F.col("block_bbox")), F.col("width")).alias("posto"), T.margin_key(F.col("block_content")).alias("chiave"))
    again = lines.repeated_lines(b, "libro_id", "pag", F.col("posto"), F.col("chiave")).select("libro_id", "posto", "chiave", F.lit(True).alias("_r"))
    return b.join(again, ["libro_id", "posto", "chiave"], "left").select("blocco_id", F.coalesce("_r", F.lit(False)).alias("ripetuta"))


@query(f"WITH n AS (SELECT libro_id, pag, try_cast(regexp_extract(block_content, '[0-9]+') AS int) AS stampato, blocco_id FROM {B} WHERE block_label = 'number'), p AS (SELECT libro_id, pag, min_by(stampato, blocco_id) AS stampato FROM n WHERE stampato IS NOT NULL GROUP BY ALL) SELECT a.libro_id, a.pag, p.stampato FROM (SELECT DISTINCT libro_id, pag FROM pag_n_res) a LEFT JOIN p USING (libro_id, pag)")
def j28_printed_numbers(spark, d):
    n = table(spark, d, "pag_n_res").where("block_label = 'number'").select("libro_id", "pag", "blocco_id", F.regexp_extract("block_content", "[0-9]+", 0).try_cast("int").alias("s")).where("s is not null")
    printed = n.groupBy("libro_id", "pag").agg(F.min_by("s", "blocco_id").alias("stampato"))
    return table(spark, d, "pag_n_res").select("libro_id", "pag").distinct().join(printed, ["libro_id", "pag"], "left")


def _titles(spark, d):
    t = blocks(spark, d).where("block_label in ('doc_title', 'paragraph_title') and block_content is not null")
    return t.select("blocco_id", "libro_id", "pag", "idx", "block_label", "block_content", T.heading_key(F.col("block_content")).alias("chiave")).where("chiave <> ''")


_TITLES = f"t AS (SELECT blocco_id, libro_id, pag, idx, block_label, block_content, {_KEY.format('block_content')} AS chiave FROM {B} WHERE block_label IN ('doc_title', 'paragraph_title') AND {_KEY.format('block_content')} <> '')"


@query(f"""WITH {_TITLES}, n AS (SELECT blocco_id AS id, libro_id, pag, chiave FROM t WHERE block_label = 'paragraph_title'), o AS (SELECT libro_id, pag, chiave, blocco_id AS voce FROM t WHERE block_label = 'doc_title'),
m AS (SELECT n.libro_id, n.id, o.voce, abs(o.pag - n.pag) AS d, n.chiave <> o.chiave AS e FROM n JOIN o ON o.libro_id = n.libro_id AND abs(o.pag - n.pag) <= 1 AND (n.chiave = o.chiave OR (length(n.chiave) >= 8 AND length(o.chiave) >= 8 AND (starts_with(n.chiave, o.chiave) OR starts_with(o.chiave, n.chiave)))))
SELECT libro_id, id, first(voce ORDER BY d, e, voce) AS voce, min(d) AS distanza FROM m GROUP BY libro_id, id""")
def j32_names_near_outline(spark, d):
    t = _titles(spark, d)
    return alignment.near_pages(t.where("block_label = 'paragraph_title'").withColumnRenamed("blocco_id", "id"), t.where("block_label = 'doc_title'").withColumnRenamed("blocco_id", "voce"), "libro_id", "chiave")


@query(f"""WITH {_TITLES}, s AS (SELECT libro_id, chiave, min(pag) AS da, max(pag) AS a FROM t WHERE block_label = 'doc_title' GROUP BY ALL) SELECT t.blocco_id, s.da, s.a FROM t JOIN s ON s.libro_id = t.libro_id AND s.chiave = t.chiave AND t.pag BETWEEN s.da - 1 AND s.a WHERE t.block_label = 'paragraph_title'""")
def j12_titles_in_sections(spark, d):
    t = _titles(spark, d)
    spans = t.where("block_label = 'doc_title'").groupBy("libro_id", "chiave").agg(F.min("pag").alias("da"), F.max("pag").alias("a"))
    return t.where("block_label = 'paragraph_title'").join(spans, ["libro_id", "chiave"]).where("pag between da - 1 and a").select("blocco_id", "da", "a")


def _grade(a: str, b: str) -> float:
    return 1.0 if a == b else 0.95 if a and b.startswith(a) else difflib.SequenceMatcher(None, a, b).ratio() * 0.9


@query()
def j10_outline_alignment(spark, d):
    """Outline entries of each book with the title lines they name; the cursor never goes back."""
    t = _titles(spark, d)
    outline = t.where("block_label = 'doc_title'").select("libro_id", "pag", F.col("chiave").alias("voce"), (F.col("pag") * 1000 + F.col("idx")).alias("ord"))
    rows = t.where("block_label = 'paragraph_title'").select("libro_id", "pag", F.col("idx").alias("n"), F.col("blocco_id").alias("riga_id"), F.col("chiave").alias("testo"))
    return alignment.outline_alignment(outline, rows, "libro_id", _grade)


@query()
def j11_titles_used_once(spark, d):
    """Entries of a page with their best title of the page, each title used once."""
    t = _titles(spark, d)
    one = t.where("block_label = 'doc_title'").select("libro_id", "pag", F.col("blocco_id").alias("voce"), F.col("idx").alias("ord"), F.col("chiave").alias("_a"))
    two = t.where("block_label = 'paragraph_title'").select("libro_id", "pag", F.col("blocco_id").alias("titolo"), F.col("chiave").alias("_b"))
    pairs = one.join(two, ["libro_id", "pag"]).withColumn("punti", T.similarity(F.col("_a"), F.col("_b"))).where("punti >= 0.85").drop("_a", "_b")
    return alignment.used_once(pairs, ["libro_id", "pag"], "voce", "ord", "titolo", "punti").select("libro_id", "pag", "voce", "titolo", "punti")


@query()
def w13_header_runs(spark, d):
    """Runs of pages with the same running header."""
    h = blocks(spark, d).where("block_label = 'header'").select("libro_id", "pag", F.split(F.trim("block_content"), "\n")[0].alias("testo")).where(F.col("testo").rlike(r"[A-Za-zÀ-ù]{4,}"))
    one = h.groupBy("libro_id", "pag").agg(F.max_by("testo", F.struct(F.length("testo"), "testo")).alias("testo")).withColumn("chiave", T.heading_key(F.col("testo")))
    return alignment.header_runs(one, "libro_id", "pag", "testo", "chiave", lambda a, b: a == b or difflib.SequenceMatcher(None, a, b).ratio() >= 0.9)


@query()
def x12_likeness(spark, d):
    """Likeness of each name and its normal form by matching blocks."""
    return entities(spark, d).select("id", F.round(alignment.ratio(F.col("nome"), F.col("nome_norm")), 6).alias("quota"))


@query(r"""SELECT id, creato_il, trim(string_split(titolo, ' - ')[1]) AS titolo_breve, try_cast(list_extract(list_filter(list_transform(string_split(titolo || ' - ' || coalesce(anno::varchar, ''), ' - ')[2:], lambda p: trim(p)), lambda p: regexp_matches(p, '^(19|20)\d\d$')), -1) AS int) AS anno_nome,
CASE WHEN anno < 2000 THEN 'classico' WHEN contains(titolo, '5.5') THEN '2024' ELSE '5e' END AS era FROM libri""")
def x18_name_parts(spark, d):
    parts = F.transform(F.split(F.concat_ws(" - ", "titolo", F.coalesce(F.col("anno").cast("string"), F.lit(""))), " - "), lambda p: F.trim(p))
    years = F.filter(F.slice(parts, F.lit(2), F.size(parts)), lambda p: p.rlike(r"^(19|20)\d\d$"))
    era = F.when(F.col("anno") < 2000, "classico").when(F.contains("titolo", F.lit("5.5")), "2024").otherwise("5e")
    return table(spark, d, "libri").select("id", "creato_il", F.trim(F.split("titolo", " - ")[0]).alias("titolo_breve"), F.try_element_at(years, F.lit(-1)).try_cast("int").alias("anno_nome"), era.alias("era"))


_PB = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace({}, '(\p{{L}})-\n+---\n+(\p{{Ll}})', '\1\2', 'g'), '([^.!?:\n])\n+---\n+(\p{{Ll}})', '\1 \2', 'g'), '\n+---\n+', '\n\n', 'g'), '\n{{3,}}', '\n\n', 'g')"


@query("WITH j AS (SELECT doc_id, replace(text, '. ', chr(10) || chr(10) || '---' || chr(10) || chr(10)) AS t FROM documents) SELECT doc_id, md5(" + _PB.format("t").replace("'\\n\\n'", "chr(10) || chr(10)") + ") AS testo FROM j")
def x35_page_breaks(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(T.page_breaks(F.replace("text", F.lit(". "), F.lit("\n\n---\n\n")))).alias("testo"))


_UA = ("Mozilla/5.0 (Windows NT 10.0) Chrome/120 Safari/537 Edg/120", "Mozilla/5.0 (X11; Linux x86_64) Firefox/121", "Mozilla/5.0 (iPhone) Version/17 Safari/604", "Mozilla/5.0 (Linux; Android 14) Chrome/120 Safari/537", "Opera/9.8 (Macintosh)", "", "curl/8")


@query("SELECT event_id, CASE WHEN contains(ua, 'Edg/') THEN 'Edge' WHEN regexp_matches(ua, 'OPR/|Opera') THEN 'Opera' WHEN contains(ua, 'Firefox/') THEN 'Firefox' WHEN contains(ua, 'Chrome/') THEN 'Chrome' WHEN contains(ua, 'Safari/') THEN 'Safari' WHEN ua = '' THEN '-' ELSE 'altro' END || '/' || CASE WHEN contains(ua, 'Windows') THEN 'Windows' WHEN contains(ua, 'Android') THEN 'Android' WHEN regexp_matches(ua, 'iPhone|iPad|iOS') THEN 'iOS' WHEN regexp_matches(ua, 'Mac OS X|Macintosh') THEN 'macOS' WHEN contains(ua, 'Linux') THEN 'Linux' ELSE '-' END AS programma FROM (SELECT event_id, [" + ", ".join(repr(u) for u in _UA) + "][event_id % 7 + 1] AS ua FROM events)")
def x37_browser(spark, d):
    ua = F.element_at(F.array(*[F.lit(u) for u in _UA]), (F.col("event_id") % 7 + 1).cast("int"))
    return table(spark, d, "events").select("event_id", T.browser(ua).alias("programma"))


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN 'k=errore;tipo=error' ELSE 'k=' || coalesce(props ->> '$.k', '-') || ';tipo=' || event_type END AS unione FROM events")
def x71_merged_objects(spark, d):
    left = F.create_map(F.lit("k"), F.coalesce(F.get_json_object("props", "$.k"), F.lit("-")))
    right = F.when(F.col("event_type") == "error", F.create_map(F.lit("tipo"), F.col("event_type"), F.lit("k"), F.lit("errore"))).otherwise(F.create_map(F.lit("tipo"), F.col("event_type")))
    flat = F.transform(F.array_sort(F.map_entries(T.merged(left, right))), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return table(spark, d, "events").select("event_id", F.array_join(flat, ";").alias("unione"))


@query(f"SELECT id, count(*) AS voci FROM (SELECT id, unnest(CASE WHEN json_valid(dati) AND json_type(dati) = 'ARRAY' THEN from_json(dati, '[\"json\"]') ELSE [] END) AS v FROM {E}) WHERE json_type(v) = 'OBJECT' AND (v ->> '$.attributo') IS NOT NULL GROUP BY id")
def x73_named_objects(spark, d):
    root = F.get_json_object("dati", "$")
    items = F.when(root.isNotNull() & F.startswith(F.ltrim("dati"), F.lit("[")), F.from_json("dati", "array<string>"))
    return entities(spark, d).select("id", F.explode(items).alias("v")).where(F.startswith("v", F.lit("{")) & F.get_json_object("v", "$.attributo").isNotNull()).groupBy("id").agg(F.count(F.lit(1)).alias("voci"))


@query(f"WITH {_UNITS} SELECT u.id, string_agg(tipo, '|' ORDER BY tipo) AS chiavi FROM u WHERE tipo NOT IN ('regola', 'luogo') AND score >= 0.5 GROUP BY u.id")
def x76_without_keys(spark, d):
    kept = F.map_filter("punti", lambda k, v: ~k.isin("regola", "luogo") & (v >= 0.5))
    return units(spark, d).select("id", F.array_join(F.sort_array(F.map_keys(kept)), "|").alias("chiavi")).where("chiavi <> ''")


@query(f"SELECT id, CASE WHEN trim(coalesce(nome, '')) = '' THEN 'vuoto' WHEN NOT regexp_matches(nome, '\\p{{L}}') THEN 'senza lettere' END AS motivo FROM {E} WHERE trim(coalesce(nome, '')) = '' OR NOT regexp_matches(nome, '\\p{{L}}')")
def pr04_rejected(spark, d):
    why = F.when(F.trim(F.coalesce("nome", F.lit(""))) == "", "vuoto").when(~F.col("nome").rlike(r"\p{L}"), "senza lettere")
    return entities(spark, d).select("id", why.alias("motivo")).where("motivo is not null")


_LET = r"length(regexp_replace({0}, '[^\p{{L}}]', '', 'g'))"


@query(f"SELECT blocco_id, CASE WHEN t = '' THEN false WHEN length(t) >= 8 THEN {_LET.format('t')} / length(t) < 0.3 ELSE block_label = 'doc_title' AND {_LET.format('t')} <= 1 END AS fregio FROM (SELECT blocco_id, block_label, trim(block_content) AS t FROM {B} WHERE block_label IN ('doc_title', 'paragraph_title') AND block_content IS NOT NULL)")
def pr14_decorative_titles(spark, d):
    t, let = F.trim("block_content"), F.length(F.regexp_replace(F.trim("block_content"), r"[^\p{L}]", ""))
    odd = F.when(t == "", False).when(F.length(t) >= 8, let / F.length(t) < 0.3).otherwise((F.col("block_label") == "doc_title") & (let <= 1))
    return blocks(spark, d).where("block_label in ('doc_title', 'paragraph_title') and block_content is not null").select("blocco_id", odd.alias("fregio"))


@query(f"""WITH b AS (SELECT *, trim(coalesce(block_content, '')) AS t FROM {B} WHERE block_label NOT IN ('image', 'figure', 'table') AND block_bbox IS NOT NULL), m AS (SELECT libro_id, pag, min(block_bbox[1]) AS sx, max(block_bbox[3]) AS dx FROM b WHERE length(t) >= 15 GROUP BY ALL)
SELECT b.blocco_id FROM b JOIN m USING (libro_id, pag) WHERE length(t) BETWEEN 1 AND 7 AND {_LET.format('t')} / length(t) < 0.3 AND (block_bbox[3] < sx OR block_bbox[1] > dx)""")
def pr15_margin_garbage(spark, d):
    b = blocks(spark, d).where("block_label not in ('image', 'figure', 'table') and block_bbox is not null").select("blocco_id", "libro_id", "pag", F.trim(F.coalesce("block_content", F.lit(""))).alias("t"), F.col("block_bbox")[0].alias("x0"), F.col("block_bbox")[2].alias("x1"))
    margins = b.where(F.length("t") >= 15).groupBy("libro_id", "pag").agg(F.min("x0").alias("sx"), F.max("x1").alias("dx"))
    return b.where(F.length("t").between(1, 7) & (T.letter_share(F.col("t")) < 0.3)).join(margins, ["libro_id", "pag"]).where("x1 < sx or x0 > dx").select("blocco_id")


@query(f"SELECT libro_id, round(avg(CASE WHEN regexp_matches(lower(block_content), '^(pag|p)\\.? ?[0-9]+') THEN 1.0 ELSE 0.0 END), 4) AS quota FROM {B} WHERE block_label = 'doc_title' AND block_content IS NOT NULL GROUP BY libro_id")
def pr19_placeholder_outline(spark, d):
    return blocks(spark, d).where("block_label = 'doc_title' and block_content is not null").groupBy("libro_id").agg(F.round(F.avg(F.when(F.lower("block_content").rlike(r"^(pag|p)\.? ?[0-9]+"), 1.0).otherwise(0.0)), 4).alias("quota"))


@query(f"SELECT tipologia, round(100.0 * count_if(json_valid(dati)) / count(*), 1) AS percento, round(coalesce(avg(CASE WHEN json_valid(dati) AND nome IS NOT NULL AND nome_norm IS NOT NULL THEN 1 - levenshtein(nome, nome_norm) / greatest(length(nome), length(nome_norm), 1) END), 0.0), 3) AS somiglianza FROM {E} GROUP BY tipologia")
def a12_success_and_likeness(spark, d):
    ok = F.get_json_object("dati", "$").isNotNull()
    like = 1 - F.levenshtein("nome", "nome_norm") / F.greatest(F.length("nome"), F.length("nome_norm"), F.lit(1))
    return entities(spark, d).groupBy("tipologia").agg(F.round(100.0 * F.count_if(ok) / F.count(F.lit(1)), 1).alias("percento"), F.round(F.coalesce(F.avg(F.when(ok & F.col("nome").isNotNull() & F.col("nome_norm").isNotNull(), like)), F.lit(0.0)), 3).alias("somiglianza"))


@query(f"""WITH w AS (SELECT libro_id, file, count(DISTINCT nome_norm) FILTER (WHERE tipologia <> 'luogo') AS attese, count(DISTINCT nome_norm) FILTER (WHERE adapter IS NOT NULL) AS trovate, count(DISTINCT nome_norm) FILTER (WHERE tipologia <> 'luogo' AND adapter IS NOT NULL) AS tp FROM {E} WHERE libro_id IS NOT NULL AND file IS NOT NULL GROUP BY ALL)
SELECT libro_id, count_if(attese > 0) AS finestre, round(coalesce(sum(tp) FILTER (WHERE attese > 0), 0) / greatest(coalesce(sum(attese), 0), 1), 3)::double AS richiamo, count_if(attese > 0 AND trovate <= 1) AS fermo_a_1, count_if(attese > 0 AND tp = attese) AS tutte, count_if(attese = 0) AS negativi, count_if(attese = 0 AND trovate = 0) AS negativi_ok FROM w GROUP BY libro_id""")
def a13_multi_metrics(spark, d):
    e = table(spark, d, "entita").where("libro_id is not null and file is not null").groupBy("libro_id", "file", "nome_norm").agg(F.bool_or(F.col("tipologia") != "luogo").alias("_a"), F.bool_or(F.col("adapter").isNotNull()).alias("_t"), F.bool_or((F.col("tipologia") != "luogo") & F.col("adapter").isNotNull()).alias("_b"))
    named = F.col("nome_norm").isNotNull()
    w = e.groupBy("libro_id", "file").agg(F.count_if(named & F.col("_a")).alias("attese"), F.count_if(named & F.col("_t")).alias("trovate"), F.count_if(named & F.col("_b")).alias("tp"))
    pos = F.col("attese") > 0
    return w.groupBy("libro_id").agg(F.count_if(pos).alias("finestre"), F.round(F.coalesce(F.sum(F.when(pos, F.col("tp"))), F.lit(0)) / F.greatest(F.coalesce(F.sum("attese"), F.lit(0)), F.lit(1)), 3).alias("richiamo"), F.count_if(pos & (F.col("trovate") <= 1)).alias("fermo_a_1"), F.count_if(pos & (F.col("tp") == F.col("attese"))).alias("tutte"), F.count_if(~pos).alias("negativi"), F.count_if(~pos & (F.col("trovate") == 0)).alias("negativi_ok"))


@query(f"SELECT libro_id, pag, sum(CASE WHEN block_label = 'text' THEN length(coalesce(block_content, '')) ELSE 0 END)::bigint AS caratteri, count_if(block_label LIKE '%title') AS titoli FROM {B} GROUP BY libro_id, pag HAVING caratteri < 150 AND titoli >= 3")
def a23_title_pages(spark, d):
    body = F.sum(F.when(F.col("block_label") == "text", F.length(F.coalesce("block_content", F.lit("")))).otherwise(0))
    return blocks(spark, d).groupBy("libro_id", "pag").agg(body.cast("bigint").alias("caratteri"), F.count_if(F.col("block_label").like("%title")).alias("titoli")).where("caratteri < 150 and titoli >= 3")


@query("SELECT doc_id, len(list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '^#{1,6} '))) AS titoli FROM documents WHERE text IS NOT NULL")
def a28_heading_count(spark, d):
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.size(F.filter(F.split("text", "\n"), lambda x: x.rlike(r"^#{1,6} "))).cast("bigint").alias("titoli"))


@query(f"WITH {_UNITS}, s AS (SELECT id, max(score) AS m FROM u GROUP BY id) SELECT u0.file, round(100.0 * coalesce(sum(tok) FILTER (WHERE m >= 0.8), 0) / greatest(sum(tok), 1), 1) AS coperto FROM u0 JOIN s USING (id) GROUP BY u0.file")
def a29_covered_tokens(spark, d):
    u = labels.thresholded(units(spark, d))
    return u.groupBy("file").agg(F.round(100.0 * F.coalesce(F.sum(F.when(F.size("tipi") > 0, F.col("tok"))), F.lit(0)) / F.greatest(F.sum("tok"), F.lit(1)), 1).alias("coperto"))


@query(f"SELECT blocco_id, idx AS inizio, coalesce(lead(idx) OVER (PARTITION BY libro_id, pag ORDER BY idx), ultimo + 1) AS fine FROM (SELECT *, max(idx) OVER (PARTITION BY libro_id, pag) AS ultimo FROM {B}) WHERE block_label LIKE '%title'")
def w12_box_ends(spark, d):
    page = Window.partitionBy("libro_id", "pag")
    b = blocks(spark, d).select("blocco_id", "libro_id", "pag", "idx", "block_label").withColumn("_u", F.max("idx").over(page))
    return b.where(F.col("block_label").like("%title")).select("blocco_id", F.col("idx").alias("inizio"), F.coalesce(F.lead("idx").over(page.orderBy("idx")), F.col("_u") + 1).alias("fine"))


@query("SELECT user_id, array_to_string(list_sort(list_filter(list(DISTINCT event_type), lambda x: x <> 'error')) || ['extra'], '|') AS elenco FROM events GROUP BY user_id")
def u09_list_edits(spark, d):
    kept = F.array_remove(F.array_sort(F.collect_set("event_type")), "error")
    return table(spark, d, "events").groupBy("user_id").agg(F.array_join(F.array_union(kept, F.array(F.lit("extra"))), "|").alias("elenco"))


@query(f"""WITH b AS (SELECT *, min(CASE WHEN block_label NOT IN ('image', 'figure', 'table') THEN block_bbox[2] END) OVER (PARTITION BY libro_id, pag) AS alto FROM {B} WHERE block_bbox IS NOT NULL), k AS (SELECT *, (block_bbox[1] + block_bbox[3]) / 2 AS cx FROM b)
SELECT blocco_id, row_number() OVER (PARTITION BY libro_id, pag ORDER BY CASE WHEN block_label = 'doc_title' AND abs(cx - width / 2) <= 15 AND block_bbox[2] <= coalesce(alto, 0) + 5 THEN -1 WHEN cx < width / 2 THEN 0 ELSE 1 END, block_bbox[2], idx) AS posto FROM k""")
def t08_column_order(spark, d):
    page, c = Window.partitionBy("libro_id", "pag"), F.col("block_bbox")
    b = blocks(spark, d).where("block_bbox is not null").withColumn("_a", F.min(F.when(~F.col("block_label").isin("image", "figure", "table"), c[1])).over(page))
    cx = (c[0] + c[2]) / 2
    col = F.when((F.col("block_label") == "doc_title") & (F.abs(cx - F.col("width") / 2) <= 15) & (c[1] <= F.coalesce("_a", F.lit(0.0)) + 5), -1).when(cx < F.col("width") / 2, 0).otherwise(1)
    return b.withColumn("_c", col).withColumn("_y", c[1]).select("blocco_id", F.row_number().over(page.orderBy("_c", "_y", "idx")).alias("posto"))


@query(f"SELECT libro_id, pag, max_by(blocco_id, (greatest(block_bbox[3]-block_bbox[1], 0.0) * greatest(block_bbox[4]-block_bbox[2], 0.0), -idx)) AS blocco_id FROM (SELECT *, row_number() OVER (PARTITION BY libro_id, pag ORDER BY idx) AS n FROM {B} WHERE block_label IN ('image', 'figure') AND block_bbox IS NOT NULL) WHERE n <= 3 GROUP BY libro_id, pag")
def t04_largest_of_three(spark, d):
    from scriptorium.functions import geometry as G

    b = blocks(spark, d).where("block_label in ('image', 'figure') and block_bbox is not null").withColumn("_n", F.row_number().over(Window.partitionBy("libro_id", "pag").orderBy("idx"))).where("_n <= 3")
    return b.groupBy("libro_id", "pag").agg(F.max_by("blocco_id", F.struct(G.area(G.box(F.col("block_bbox"))).alias("a"), (-F.col("idx")).alias("i"))).alias("blocco_id"))


@query(f"""WITH b AS (SELECT blocco_id, libro_id, pag, idx, trim(block_content) AS t, block_bbox[2] AS y0, block_bbox[4] AS y1 FROM {B} WHERE block_label = 'text' AND block_bbox IS NOT NULL AND block_content IS NOT NULL), w AS (SELECT *, lag(y1) OVER p AS py1, lag(t) OVER p AS pt, lead(y0) OVER p AS ny0, lead(t) OVER p AS nt, lag(blocco_id) OVER p AS pi, lead(blocco_id) OVER p AS ni FROM b WINDOW p AS (PARTITION BY libro_id, pag ORDER BY idx))
SELECT blocco_id, CASE WHEN pi IS NULL AND ni IS NULL THEN NULL WHEN ni IS NULL OR abs(y0 - py1) <= abs(ny0 - y1) THEN pi ELSE ni END AS paragrafo FROM w WHERE length(t) <= 2 AND regexp_matches(t, '^\\p{{L}}+$')""")
def l11_drop_caps(spark, d):
    p = Window.partitionBy("libro_id", "pag").orderBy("idx")
    b = blocks(spark, d).where("block_label = 'text' and block_bbox is not null and block_content is not null").select("blocco_id", "libro_id", "pag", "idx", F.trim("block_content").alias("t"), F.col("block_bbox")[1].alias("y0"), F.col("block_bbox")[3].alias("y1"))
    w = b.withColumn("py1", F.lag("y1").over(p)).withColumn("ny0", F.lead("y0").over(p)).withColumn("pi", F.lag("blocco_id").over(p)).withColumn("ni", F.lead("blocco_id").over(p))
    near = F.when(F.col("pi").isNull() & F.col("ni").isNull(), None).when(F.col("ni").isNull() | (F.abs(F.col("y0") - F.col("py1")) <= F.abs(F.col("ny0") - F.col("y1"))), F.col("pi")).otherwise(F.col("ni"))
    return w.where((F.length("t") <= 2) & F.col("t").rlike(r"^\p{L}+$")).select("blocco_id", near.alias("paragrafo"))


@query("""WITH e AS (SELECT *, floor(epoch(ts))::bigint AS t, count(*) FILTER (WHERE event_type = 'purchase') OVER (PARTITION BY user_id ORDER BY floor(epoch(ts))::bigint RANGE UNBOUNDED PRECEDING) AS s FROM events WHERE event_type IN ('error', 'purchase')), f AS (SELECT * FROM e WHERE event_type = 'error')
SELECT event_id, count(*) OVER (PARTITION BY user_id, s ORDER BY t RANGE BETWEEN 599 PRECEDING AND CURRENT ROW) AS recenti, count(*) OVER (ORDER BY t RANGE BETWEEN 599 PRECEDING AND CURRENT ROW) AS in_tutto FROM f""")
def w06_throttle(spark, d):
    """Failures of the last 600 s per key since its last success, and of all keys."""
    e = table(spark, d, "events").where("event_type in ('error', 'purchase')").withColumn("_t", F.unix_timestamp(F.col("ts").cast("timestamp")))
    e = e.withColumn("_s", F.count_if(F.col("event_type") == "purchase").over(Window.partitionBy("user_id").orderBy("_t").rangeBetween(Window.unboundedPreceding, 0)))
    f = store.sliding_counts(e.where("event_type = 'error'").drop("_t"), ["user_id", "_s"], "ts", 600)
    return alignment.sliding_total(f, "ts", 600, "in_tutto").select("event_id", "recenti", "in_tutto")


@query(f"WITH b AS (SELECT libro_id FROM {E} WHERE libro_id IS NOT NULL GROUP BY libro_id HAVING len(list_intersect(list(DISTINCT tipologia), [{', '.join(repr(x) for x in LABELS)}])) >= 6) SELECT e.id, CASE WHEN b.libro_id IS NOT NULL THEN 'base' ELSE 'altro' END AS gruppo FROM {E} e LEFT JOIN b ON b.libro_id = e.libro_id")
def a17_tagged_by_overlap(spark, d):
    """Each entity tagged by whether its book has at least 6 of the 8 classifier labels among its types."""
    e = entities(spark, d).select("id", "libro_id", "tipologia")
    base = F.array(*[F.lit(x) for x in LABELS])
    full = e.where("libro_id is not null").groupBy("libro_id").agg(F.size(F.array_intersect(F.collect_set("tipologia"), base)).alias("_n")).where("_n >= 6").select("libro_id", F.lit("base").alias("gruppo"))
    return e.join(full, "libro_id", "left").select("id", F.coalesce("gruppo", F.lit("altro")).alias("gruppo"))
