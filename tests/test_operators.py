"""Folds, joins, functions, sources, sinks and streams on small cases with known results."""

from __future__ import annotations

import json
import random
import zipfile
from io import BytesIO

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scriptorium.functions import text as T
from scriptorium.operators import folds, labels, lines, matching, search, store
from scriptorium.sources import readers, sinks
from scriptorium.streaming import access


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "f,value,want",
    [(T.name_key, "  Perché, no?_x ", "perché no _x"), (T.letters_key, "Città-Ä 2", "cittaa2"), (T.bare_name, "Mago (del nord)  vecchio", "mago vecchio"), (T.book_slug, "--L'Àbc " + "x" * 70, "l-bc-" + "x" * 55), (T.chapter_slug, "È 1.2 però", "e-1.2-pero"),
     (T.repair_dice, "tira 2dl0 o dl2 o idl2x", "tira 2d10 o d12 o idl2x"), (T.dotted_contents, "Capitolo ........ 12", True), (T.dotted_contents, "ecc... 12", False), (T.rejoin, "fine\nriga.\nNuova", "fine riga.\nNuova"), (T.unfenced, "```json\n[1]\n```", "[1]"),
     (T.salvaged_names, '[{"nome": "A"}, {"nome": "B", "x', ["A", "B"]), (T.page_breaks, "la pa-\n\n---\n\nrola e\n\n---\n\nqui", "la parola e qui"), (T.html_lines, "<p>a</p> <br> b", ["a", "b"]), (T.dialogue, "Re: vieni\nServo: sì\nfine", True), (T.title_variants, "Re - Regno", ["re regno", "re", "regno"]),
     (T.last_year, "SRD 1999 e 2024, n. 20245", 2024), (T.mime, "a/b.JPG", "image/jpeg"), (T.safe_name, "../x", False), (T.capital, "pAROLA", "Parola"), (T.list_of, "mago, ,ladro", ["Mago", "Ladro"]), (T.functional_end, "la via della", True), (T.ocr_maths, r"$ 3^{\circ} $ liv", "3° liv")],
)
def test_text_functions(spark, f, value, want):
    assert one(spark, value, f) == want
    assert one(spark, None, f) in (None, False, "application/octet-stream")


@pytest.mark.parametrize("a,b,want", [("mago", "mago", 1.0), ("mago", "mago nero", 0.95), ("mago", "il mago", 0.85), ("mago", "x" * 70 + "mago", 0.0), ("punteggi di", "punteggidi forza", 0.9), ("descrizione degli", "descrizioni degli", 0.88), ("", "x", 0.0), (None, "x", 0.0)])
def test_similarity(spark, a, b, want):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(T.similarity(F.col("a"), F.col("b"))).first()[0] == want


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab .,\n#", max_size=300), st.integers(10, 60))
def test_chunks_lose_nothing(text, limit):
    parts = folds.chunk(text, limit)
    assert "".join("".join(parts).split()) == "".join(text.split())
    assert all(0 < len(p) <= limit for p in parts)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab#\n ", max_size=200), st.integers(1, 30))
def test_units_cover_all_blocks_in_order(text, limit):
    blocks = folds.paragraphs(text)
    units = folds.pack(blocks, limit, 5)
    covered = [b for a, z, _ in units for b in blocks if a <= b[0] and b[1] <= z]
    assert covered == blocks
    assert all(n <= limit + 1 or len([b for b in blocks if a <= b[0] <= z]) == 1 or n <= limit + len(blocks) for a, z, n in units)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.integers(1, 60)), max_size=30))
def test_windows_keep_each_block_once(spec):
    blocks = [(i * 3, i * 3 + 1, ("# t " if h else "") + "x " * n) for i, (h, n) in enumerate(spec, 1)]
    out = folds.windows(blocks, 100, 20)
    assert "\n\n".join(w[3] for w in out) == "\n\n".join(b[2] for b in blocks)
    assert all(a <= z for a, z, _, _ in out)


def test_size_split_and_tables():
    text = "prima\n# A\nx\n## B\n" + "y" * 50 + "\n### C\n" + "z" * 50 + "\n### D\nw"
    assert folds.split_by_size(text, 0) == [("", "prima"), ("A", "# A\nx"), ("B", text[text.index("## B") :])]
    assert [t for t, _ in folds.split_by_size(text, 60)] == ["", "A", "B", "C", "D"]
    table = "<table>" + "".join(f"<tr><td>{i} a b c</td></tr>" for i in range(6)) + "</table>"
    parts = folds.split_table("su " + table + " giù", 12)
    assert parts[0] == "su" and parts[-1] == "giù" and all(p.count("0 a b c") == 1 for p in parts[1:-1])
    assert folds.hard_pieces("x" * 10, 1) == ["xxxx", "xxxxxx"]
    assert folds.balanced(["aa", "bb", "cc", "dd"], 4) == [["aa", "bb"], ["cc", "dd"]]


def test_reading_order_and_alignment():
    boxes = [(300, 100, 500, 200), (0, 100, 200, 200), (0, 0, 500, 50), (0, 210, 200, 300)]
    assert folds.reading_order(boxes) == [2, 1, 0, 3]
    score = lambda a, b: 1.0 if a == b else 0.0
    assert folds.monotone_alignment([("a", 1), ("b", 2), ("a", 9)], [("a", 1), ("x", 1), ("b", 4), ("a", 1)], score) == [0, 2, None]
    assert folds.reading_order([]) == []


def test_per_key_folds(spark):
    ev = spark.createDataFrame([(1, f"2024-01-01 00:{m:02d}:00") for m in (0, 4, 5, 9, 10, 16)] + [(2, "2024-01-01 00:00:00"), (None, None)], "k int, t string")
    got = folds.accepted(ev.withColumn("t", F.col("t").cast("timestamp")), "k", "t", 300).groupBy("k").count().collect()
    assert {r.k: r["count"] for r in got} == {1: 4, 2: 1}
    rows = spark.createDataFrame([(1, y) for y in (0.0, 3.0, 6.0, 9.0)], "p int, y double")
    assert [r.banda for r in folds.bands(rows, ["p"], "y").orderBy("y").collect()] == [0, 0, 1, 1]
    titles = spark.createDataFrame([(1, 1, 0, "Re orco", 2), (1, 3, 0, "re, orco", 2), (1, 5, 0, "Re orco", 2), (1, 8, 0, "RE ORCO", 2), (1, 20, 0, "Re orco", 2), (1, 21, 0, "re", 2)], "b int, p int, i int, t string, l int")
    assert [r.livello_nuovo for r in folds.demoted_repeats(titles, "b", "p", ["i"], "t", "l").orderBy("p").collect()] == [2, 2, 2, 3, 2, 2]


def test_labels(spark):
    u = spark.createDataFrame([(i, "f", 1, i * 3, i * 3 + 1, 10, {"x": s}) for i, s in enumerate((0.9, 0.95, 0.1, 0.9, 0.85))], "id int, file string, libro int, inizio long, fine long, tok long, punti map<string,double>")
    t = labels.thresholded(u)
    assert [(r.inizio, r.fine, r.unita, r.punteggio_medio) for r in labels.label_intervals(t).orderBy("inizio").collect()] == [(0, 4, 2, 0.925), (9, 13, 2, 0.875)]
    assert {(r.tipo, r.unita) for r in labels.label_report(t).collect()} == {("x", 4), ("nessuna", 1)}
    assert labels.label_report(t.limit(0)).count() == 0
    m = spark.createDataFrame([(1, "b", 1), (1, "a", 2), (1, None, 0)], "k int, v string, o int")
    assert labels.mode(m, ["k"], "v", seen="o").first().v == "b"


def test_matching(spark):
    h = spark.createDataFrame([("luce solare",), ("lu",), (None,)], "h string")
    n = spark.createDataFrame([("luce",), ("luce s",), ("solare",)], "n string")
    assert [(r.h, r.n) for r in matching.longest_prefix(h, n, "h", "n").collect()] == [("luce solare", "luce s")]
    r = spark.createDataFrame([("f", 0, 100), ("f", 200, 210), ("g", 0, 5)], "f string, lo int, hi int")
    p = spark.createDataFrame([("f", 99), ("f", 210), ("g", 5)], "f string, x int")
    assert [(x.f, x.lo) for x in matching.range_semi(r, p, "f", "lo", "hi", "x").collect()] == [("f", 0)]
    a = spark.createDataFrame([("drago rosso",), ("mago",)], "a string")
    b = spark.createDataFrame([("drago rossi",), ("maghi",)], "b string")
    got = matching.trigram_pairs(a, b, "a", "b", T.shingles(F.col("a")), T.shingles(F.col("b")), 0.6).collect()
    assert [(x.a, x.b) for x in got] == [("drago rosso", "drago rossi")]


def test_trigram_pairs_equal_brute_force(spark):
    rng = random.Random(2)
    names = list({"".join(rng.choice("abcd") for _ in range(rng.randrange(3, 8))) for _ in range(120)})

    def grams(s):
        s = "  " + s + " "
        return {s[i : i + 3] for i in range(len(s) - 2)}

    want = {(x, y) for x in names for y in names if x < y and round(len(grams(x) & grams(y)) / len(grams(x) | grams(y)), 4) >= 0.5}
    df = spark.createDataFrame([(x,) for x in names], "a string")
    got = matching.trigram_pairs(df, df.withColumnRenamed("a", "b"), "a", "b", T.shingles(F.col("a")), T.shingles(F.col("b")), 0.5).where("a < b").collect()
    assert {(r.a, r.b) for r in got} == want


def test_upsert_is_idempotent_and_guarded(spark):
    s = "k int, t string, v string, revisione string"
    base = spark.createDataFrame([(1, "a", "old", "automatica"), (2, "a", "mine", "verificata"), (3, "a", "gone", "automatica"), (4, "b", "stay", "automatica")], s)
    batch = spark.createDataFrame([(1, "a", "new", "automatica"), (2, "a", "no", "automatica"), (5, "a", "add", "automatica")], s)
    once = store.guarded_upsert(base, batch, ["k", "t"], scope=["t"])
    assert {(r.k, r.v) for r in once.collect()} == {(1, "new"), (2, "mine"), (4, "stay"), (5, "add")}
    assert sorted(store.guarded_upsert(once, batch, ["k", "t"], scope=["t"]).collect()) == sorted(once.collect())


def test_search_and_lines(spark):
    docs = spark.createDataFrame([(1, "s", "La regola\n" + "x " * 200 + "regola"), (2, "s", "regola"), (3, "s", None), (4, "s", "altro")], "doc_id long, source string, text string")
    assert [(r.doc_id, r.punti) for r in search.ranked(docs, "la regola").collect()] == [(1, 357), (2, 20)]
    assert search.ranked(docs, " ").count() == 0
    assert T.search_terms("della regola") == (["regola"], "della regola", True)
    pages = spark.createDataFrame([(1, 1), (1, 4), (2, 1)], "b int, p int")
    assert {(r.b, r.p) for r in lines.missing_pages(pages, "b", "p").collect()} == {(1, 2), (1, 3)}
    md = spark.createDataFrame([(1, "pre\n## A\nx\n## B\n")], "k int, text string")
    assert [(r.ord, r.titolo) for r in lines.chapters(md, ["k"]).orderBy("ord").collect()] == [(0, None), (1, "A"), (2, "B")]


def test_sources(spark, tmp_path):
    (tmp_path / "ocr").mkdir()
    block = {"block_label": "text", "block_content": "c", "block_bbox": [0, 0, 1, 1]}
    (tmp_path / "ocr/page_1.json").write_text(json.dumps({"width": 1, "height": 2, "parsing_res_list": [block, block]}))
    (tmp_path / "ocr/page_2.json").write_text(json.dumps({"res": {"width": 3, "height": 4, "parsing_res_list": [block]}}))
    assert [(r.pag, r.idx, r.width) for r in readers.page_results(spark, str(tmp_path / "ocr")).orderBy("pag", "idx").collect()] == [(1, 0, 1.0), (1, 1, 1.0), (2, 0, 3.0)]
    (tmp_path / "md").mkdir()
    (tmp_path / "md/page_1.md").write_text("a *(testo a margine: x)*\nb")
    (tmp_path / "md/page_3.md").write_text("c")
    texts = readers.page_texts(spark, str(tmp_path / "md"))
    assert texts.where("pag = 1").first().testo == "a b"
    with pytest.raises(Exception, match="pages are missing"):
        readers.complete_pages(texts).collect()
    (tmp_path / "x.jsonl").write_text('{"id": 1}\n{broken\n')
    assert readers.json_lines(spark, str(tmp_path / "x.jsonl"), "id INT").where("id is null").count() == 1
    two = spark.createDataFrame([('[{"nome": "a"}]',), ('{"entita": [{"nome": "b"}]}',), ("x",)], "t string")
    assert sorted(r.nome for r in readers.dict_or_list(two, "t", "STRUCT<nome: STRING>").collect()) == ["a", "b"]
    bad = readers.parsed(spark, str(tmp_path / "md"), lambda b: [{"n": len(b)}] if b != b"c" else 1 / 0, "n int")
    assert sorted((r.n is None, bool(r.errore)) for r in bad.collect()) == [(False, False), (True, True)]
    chat = spark.createDataFrame([(1, 2, "u", "ciao"), (1, 1, "s", None)], "c int, t int, r string, x string")
    assert readers.chat_texts(chat, "c", "t", "r", "x").first().testo == "<|s|>\n\n<|u|>\nciao"


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.replace_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "p int, v string"), path, ["p"])
    sinks.replace_partitions(spark.createDataFrame([(2, "c")], "p int, v string"), path, ["p"])
    assert {(r.p, r.v) for r in spark.read.parquet(path).collect()} == {(1, "a"), (2, "c")}
    old = spark.createDataFrame([("x", "t")], "k string, testo string").withColumn("impronta", F.lit("hand")).unionByName(spark.createDataFrame([("y", "t")], "k string, testo string").withColumn("impronta", F.sha2("testo", 256)))
    new = spark.createDataFrame([("x", "n"), ("y", "n"), ("z", "n")], "k string, testo string")
    assert {r.k: r.dove for r in sinks.guarded_drafts(new, old, "k").collect()} == {"x": "auto", "y": "bozza", "z": "bozza"}
    ch = spark.createDataFrame([("b", 1, 1, "x" * 50), ("b", 2, 2, "y" * 60), ("b", 3, 2, "z"), ("b", 4, 1, "w")], "b string, o int, l int, t string")
    assert [r.sezione for r in sinks.grouped_sections(ch, "b", "o", "l", "t", 100).orderBy("o").collect()] == [1, 2, 2, 3]
    book = sinks.packages(ch, "b", "o", "t", "t").first()
    with zipfile.ZipFile(BytesIO(book.epub)) as z:
        assert z.namelist()[0] == "mimetype" and z.infolist()[0].compress_type == 0 and book.file == 4

    def model(text, attempt):
        if text == "y" or attempt < 2:
            raise ValueError("no")
        return text.upper()

    got = {r.k: (r.risposta, bool(r.errore)) for r in sinks.modelled(spark.createDataFrame([("a", "x"), ("b", "y")], "k string, t string"), "k", "t", model).collect()}
    assert got == {"a": ("X", False), "b": (None, True)}


def test_streams(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = [(1, f"2024-01-01 00:0{m}:00", k) for m, k in enumerate(("bad", "bad", "ok", "bad", "bad"))] + [(2, "2024-01-03 00:00:00", "bad")]
    spark.createDataFrame(rows, "u int, ts string, e string").withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(path)

    def s():
        return access.stream_of(spark, path, "u int, ts timestamp_ntz, e string")

    spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert [(r.e, r.n) for r in access.drained(access.daily_counts(s(), kind="e"), "daily").orderBy("e").collect()] == [("bad", 4), ("ok", 1)]
    t = access.drained(access.throttled(s(), "u", "ts", "e", "bad", "ok", 600, 2), "throttle")
    assert sorted((r.u, r.recenti, r.bloccato) for r in t.collect()) == [(1, 1, False), (1, 1, False), (1, 2, True), (1, 2, True), (2, 1, False)]
    assert sorted((r.u, r.n) for r in access.drained(access.once_per(s(), "u", "ts", 180), "once").groupBy("u").agg(F.count("*").alias("n")).collect()) == [(1, 2), (2, 1)]
    assert access.drained(access.sessions(s(), "u"), "sessions").count() == 1
    log = str(tmp_path / "dec")
    spark.createDataFrame([(1, 1, 10, 5, "a", None), (1, 2, 11, 5, "b", None), (1, 3, 12, None, None, True), (1, 4, 13, 6, "c", None)], "libro_id int, prog int, istante long, id int, classe string, annulla boolean").write.parquet(log)
    stream = spark.readStream.schema("libro_id int, prog int, istante long, id int, classe string, annulla boolean").parquet(log)
    assert {(r.id, r.classe) for r in access.drained(access.decisions(stream), "decisions", "update").collect()} >= {(6, "c")}
    spark.conf.set("spark.sql.shuffle.partitions", "8")
