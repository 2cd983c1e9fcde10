"""p2, p4, p5, p6 and p7 against brute force on whole tables, and edge cases."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from scriptorium.functions import attributes as A
from scriptorium.operators import changefeed, eav, intervals, multivalue, orphans
from scriptorium.operators.scans import dense_codes, ranked
from scriptorium.plans import data_problems as P
from scriptorium.session import fresh_path, table


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _when(ts):
    if re.fullmatch(r"\d+", ts):
        return int(ts)
    t = dt.datetime.fromisoformat(ts.replace("Z", "+00:00"))
    return int((t if t.tzinfo else t.replace(tzinfo=dt.timezone.utc)).timestamp())


def _fold(records):
    seen, books = set(), {}
    for r in sorted(records, key=lambda r: (_when(r["ts"]), r["prog"])):
        key = (r["libro_id"], r["sessione"], r["prog"])
        if key in seen or (r["id"] is None and not r["annulla"]):
            continue
        seen.add(key)
        state, stack = books.setdefault(r["libro_id"], ({}, []))
        if r["annulla"]:
            if stack:
                i, old = stack.pop()
                state.pop(i) if old is None else state.__setitem__(i, old)
        else:
            stack.append((r["id"], state.get(r["id"])))
            state[r["id"]] = r["classe"]
    return sorted(((b, i, c) for b, (s, _) in books.items() for i, c in s.items()), key=repr)


def test_p2_equals_an_ordered_fold(spark, sf):
    log = [r.asDict() for r in table(spark, sf, "decisioni").collect()]
    assert rows(P.p2_found(spark, sf)) == _fold(log)


LOG = "libro_id int, sessione int, prog int, id int, classe string, annulla boolean, ts string"


def test_p2_any_split_and_order_of_deliveries(spark):
    rng, log = random.Random(3), []
    for book in (1, 2):
        at = 1_700_000_000
        for n in range(1, 160):
            at += rng.randrange(0, 40)
            back = rng.random() < 0.4
            log.append({"libro_id": book, "sessione": 9, "prog": n, "id": None if back else rng.randrange(12), "classe": None if back else rng.choice("abc"), "annulla": back, "ts": str(at)})
    log.append({"libro_id": 1, "sessione": 9, "prog": 500, "id": None, "classe": "x", "annulla": None, "ts": "1700000000"})
    expected, noisy = _fold(log), log + rng.sample(log, 60)
    rng.shuffle(noisy)
    path = fresh_path(spark, "test")
    t = changefeed.BucketedTable(spark, path, ["libro_id", "slot"], ["libro_id", "sessione", "prog"], ["istante", "prog"], 8)
    for part in (noisy[:90], noisy[90:95], noisy[95:]):
        out = changefeed.apply_log(spark.createDataFrame([tuple(r.values()) for r in part], LOG), t)
    assert rows(out) == expected
    assert t.manifest()["version"] == 3


def test_copy_on_write_keeps_untouched_buckets(spark):
    t = changefeed.BucketedTable(spark, fresh_path(spark, "test"), ["k"], ["k"], ["k"], 16)
    t.merge(spark.range(200).select(F.col("id").alias("k"), F.lit("a").alias("v")))
    before = t.manifest()["buckets"]
    t.merge(spark.createDataFrame([(3, "b"), (None, "c")], "k long, v string"))
    after = t.manifest()["buckets"]
    assert sum(before[b] != after[b] for b in after) == 1
    assert {r.k: r.v for r in t.read().select("k", "v").collect()} == {k: "b" if k == 3 else "a" for k in range(200)}


def test_p2_empty_and_null_cases(spark):
    assert rows(changefeed.apply_log(spark.createDataFrame([], LOG))) == []
    odd = [(None, 1, 1, 1, "a", None, "1700000000"), (1, 1, 1, 1, "a", None, None), (1, 1, 2, 1, "b", None, "no"), (1, 1, 3, None, None, True, "1700000000"), (1, 1, 4, 2, None, None, "1700000001")]
    assert rows(changefeed.apply_log(spark.createDataFrame(odd, LOG))) == [(1, 2, None)]


@pytest.mark.parametrize("text", ["2024-03-04T05:53:09", "2024-03-04T05:53:09Z", "2024-03-04T06:53:09+01:00", "2024-03-04 05:53:09", "2024-03-04T05:53:09.000Z", "2024-03-04T02:53:09-0300", "1709531589", "1709531589000", " 2024-03-04T05:53:09 "])
def test_notations_of_time(spark, text):
    assert spark.createDataFrame([(text,)], "t string").select(changefeed.instant(F.col("t"))).first()[0] == 1709531589


def _union(ranges):
    out = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return out


def test_p5_equals_a_sweep(spark, sf):
    groups = {}
    for r in table(spark, sf, "entita").collect():
        if r.libro_id is not None and r.file is not None and r.righe and r.righe.lo is not None and r.righe.hi is not None and r.righe.lo < r.righe.hi:
            groups.setdefault((r.libro_id, r.file), []).append((r.righe.lo, r.righe.hi))
    want = []
    for k, v in groups.items():
        u = _union(v)
        want += [(*k, "periodo", a, b) for a, b in u] + [(*k, "lacuna", a[1], b[0]) for a, b in zip(u, u[1:])]
    assert rows(P.p5_found(spark, sf)) == sorted(want, key=repr)


def test_intervals_across_slots_and_odd_rows(spark):
    rng = random.Random(5)
    data = [(1, a := rng.randrange(0, 90_000), a + rng.randrange(1, 60)) for _ in range(900)]
    odd = [(1, 5, 5), (1, 9, 3), (None, 1, 2), (1, None, 4), data[0], (2, 0, 100_000), (2, 10, 20)]
    df = spark.createDataFrame(data + odd, "k int, lo int, hi int").withColumn("_lo", F.lit("clash"))
    want = []
    for k in (1, 2):
        u = _union([(a, b) for kk, a, b in data + odd if kk == k and a is not None and a < b])
        want += [(k, "periodo", a, b) for a, b in u] + [(k, "lacuna", a[1], b[0]) for a, b in zip(u, u[1:])]
    assert rows(intervals.stretches_and_gaps(df, ["k"])) == sorted(want, key=repr)
    assert rows(intervals.stretches_and_gaps(df.limit(0), ["k"])) == []


def test_two_level_ranks_and_codes(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 1000).alias("x"))
    got = ranked(df, ["g"], ["x"], F.floor(F.col("x") / 64)).collect()
    for g in range(3):
        assert [r.x for r in sorted((r for r in got if r.g == g), key=lambda r: r.rango)] == sorted(r.x for r in got if r.g == g)
    assert sorted(r.codice for r in dense_codes(df, "x").collect()) == list(range(1, 1001))


@pytest.mark.parametrize(
    "name,value,want",
    [("livello", " 4 ", "4"), ("livello", "5° livello", "5"), ("livello", 7.0, "7"), ("livello", "Trucchetto", "0"), ("livello", "varia", None), ("livello", None, None), ("dado_vita", "un d12", "12"), ("dado_vita", "1d10", "10"), ("dado_vita", 8, "8"),
     ("velocita", "10,5 m, volo 18 m", "10.5"), ("velocita", "m 12", "12"), ("velocita", "9.0 m", "9"), ("punti_ferita", "237 (2d8+18)", "237"), ("punti_ferita", "pf 9", "9"), ("peso", "1500 grammi", "1.5"), ("peso", "2,5 Kg", "2.5"), ("peso", 0.25, "0.25"),
     ("peso", "kg 3", "3"), ("costo", "2.300 mo", "230000"), ("costo", "35 mo 3 ma", "3530"), ("costo", "ma 27", "270"), ("costo", "4 monete d'oro", "400"), ("costo", "7mr", "7"), ("costo", "n.d.", None), ("sintonizzazione", "sì (da un mago)", "true"),
     ("sintonizzazione", "non richiede", "false"), ("sintonizzazione", "SI", "true"), ("sintonizzazione", False, "false"), ("sintonizzazione", "?", None), ("rarita", " Molto  rara", "molto rara"), ("scuola", "—", None)],
)
def test_typed_readings(spark, name, value, want):
    import json

    df = spark.createDataFrame([(1, "t", json.dumps({name: value})), (1, "t", json.dumps({name: value}))], "id long, tipologia string, dati string")
    got = {r.attributo: r.valore for r in eav.narrow(eav.wide(df), "id", list(A.TYPED)).collect()}
    assert got == ({} if want is None else {name: want})


def test_wide_layouts_repeats_and_broken_texts(spark):
    data = [
        (1, "a", '{"Livello": 2, "livello": 3}', 0), (2, "a", '[["punti-ferita", "9"], ["PUNTI_FERITA", "?"]]', 0), (3, "a", '[{"valore": "d8", "attributo": "dadoVita (x)"}]', 0), (4, "a", '{"livello": 1', 0), (5, None, None, 0),
        (None, "a", '{"livello": 1}', 0), (6, "a", '7', 0), (7, "a", '[1, [2], {"livello": "4"}]', 0), (8, "a", "{}" + " " * 100_000, 0),
    ]
    df = spark.createDataFrame(data, "id long, tipologia string, dati string, livello int")
    wide = eav.wide(df)
    assert sorted(r.id for r in wide.collect()) == [1, 2, 3, 4, 5, 6, 7, 8]
    assert rows(eav.narrow(wide, "id", list(A.TYPED))) == [(1, "livello", "3"), (3, "dado_vita", "8"), (7, "livello", "4")]
    assert rows(eav.wide(df.limit(0))) == []


def _split(text):
    out, cur, i = [], "", 0
    close = {"«": "»", "“": "”"}
    while i < len(text):
        c = text[i]
        end = -1
        if c == '"':
            m = re.compile(r'"(?:[^"]|"")*"').match(text, i)
            end = m.end() if m else -1
        elif c in close:
            end = text.find(close[c], i) + 1 or -1
        elif c == "(":
            m = re.compile(r"\((?:[^()]|\([^()]*\))*\)").match(text, i)
            end = m.end() if m else -1
        if end > 0:
            cur += text[i:end]
            i = end
            continue
        if c in ",;/|•·\t\n\r" or (c == "e" and i and text[i - 1].isspace() and text[i + 1 : i + 2].isspace()):
            out.append(cur)
            cur = ""
        else:
            cur += c
        i += 1
    out.append(cur)
    values = []
    for v in out:
        v = v.strip()
        if len(v) > 1 and (v[0], v[-1]) in (('"', '"'), ("«", "»"), ("“", "”")) and not re.search('["«»“”]', v[1:-1].replace('""', "")):
            v = v[1:-1].replace('""', '"').strip()
        if v:
            values.append(v)
    return values


def test_p6_equals_a_scanner(spark, sf):
    want = []
    seen = set()
    for r in table(spark, sf, "entita").collect():
        if r.id in seen:
            continue
        seen.add(r.id)
        for k, v in {k: v for k, v in A.pairs(r.dati) or ()}.items():
            if k in P.MULTI and v is not None:
                values = [x for x in v] if isinstance(v, list) else [] if v.strip() in ("", "-", "—", "–") else _split(v)
                want += [(r.id, k, n, x) for n, x in enumerate(values, 1)]
    assert rows(P.p6_found(spark, sf)) == sorted(want, key=repr)


@pytest.mark.parametrize(
    "text,want",
    [('a, "b; c" e d', ["a", "b; c", "d"]), ("«x, y»|“z e w”", ["x, y", "z e w"]), ('"uno ""di"", v"/q', ['uno "di", v', "q"]), ("razioni (x9; y), z", ["razioni (x9; y)", "z"]), ("• a • • b", ["a", "b"]), (",,a,,", ["a"]), ("a, a", ["a", "a"]),
     ('5" lama, b', ['5" lama', "b"]), ("0, (k)", ["0", "(k)"]), ('kit "da, viaggio" grande; x', ['kit "da, viaggio" grande', "x"]), ("te e latte", ["te", "latte"]), ("", []), ('""', [])],
)
def test_split_values(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(multivalue.split_values(F.col("t"))).first()[0] == want


def test_long_field_keeps_all_values(spark):
    df = spark.createDataFrame([(1, '{"tag": "' + ", ".join(f'x{i} (a,b)' for i in range(3000)) + '"}')], "id long, dati string")
    got = multivalue.exploded(multivalue.field_entries(df, ("tag",)))
    assert got.count() == 3000 and got.where("posizione = 3000").first().valore == "x2999 (a,b)"


def test_p7_equals_lookups(spark, sf):
    books, gone = {}, {r.id for r in table(spark, sf, "libri_tolti").collect()}
    for r in table(spark, sf, "libri").collect():
        books[r.id] = min(x for x in (books.get(r.id), r.creato_il) if x)
    want = set()
    for tab, i, w in (("entita", "id", "creato_il"), ("documents", "doc_id", "acquisito_il")):
        for r in table(spark, sf, tab).collect():
            b, t = r.libro_id, r[w]
            if b is None:
                continue
            if b not in books:
                want.add((tab, r[i], "tolto" if b in gone else "mancante"))
            elif t is not None and books[b] > t:
                want.add((tab, r[i], "tardivo"))
    assert rows(P.p7_found(spark, sf)) == sorted(want, key=repr)


def test_orphans_over_many_ranges(spark):
    refs = spark.range(120_000).select(F.lit("t").alias("tabella"), "id", F.col("id").alias("chiave"), F.lit("2024-05-10").cast("timestamp").alias("quando"))
    odd = spark.createDataFrame([("t", -1, None, None), ("t", -2, 6, None), ("t", -3, 7, None)], "tabella string, id long, chiave long, quando timestamp")
    parents = spark.range(120_000).where("id % 1000 != 7").select(F.col("id").alias("chiave"), F.when(F.col("id") == 6, F.lit("2024-05-11")).otherwise(F.lit("2024-05-09")).cast("timestamp").alias("nato"))
    gone = spark.createDataFrame([(7,), (7,), (6,)], "chiave long")
    got = {(r.id, r.motivo) for r in orphans.orphans(refs.unionByName(odd), parents, gone).collect()}
    assert got == {(i, "mancante") for i in range(1007, 120_000, 1000)} | {(7, "tolto"), (6, "tardivo"), (-3, "tolto")}


def test_spans_of_any_length_and_depth(spark):
    long, deep = "x" * 100_000, "(" * 20 + "a, b" + ")" * 20
    data = [f'"{long}, y", z', f"({long}; y), z", f"{deep} q, z", '"' + '""' * 50_000 + '", z', "(" * 5000 + ", z", '"a, b', "(a, (b, c)", "a) , (b, c) 0, d", ", 5"]
    want = [[f"{long}, y", "z"], [f"({long}; y)", "z"], [f"{deep} q", "z"], ['"' * 50_000, "z"], ["(" * 5000, "z"], ['"a', "b"], ["(a", "(b, c)"], ["a)", "(b, c) 0", "d"], ["", "5"]]
    df = spark.createDataFrame(list(enumerate(data)), "i int, t string")
    assert [r[1] for r in sorted(df.select("i", multivalue.split_values(F.col("t"))).collect())] == want


def test_attributes_nobody_named(spark):
    df = spark.createDataFrame([(1, "a", '{"Forza": 12, "livello": 2, "id": "q", "peso_netto": 1}'), (2, "a", '{"forza": 9, "forza": 10, "vola": true, "peso netto": 1.5}'), (3, "a", '{"forza": null, "vola": false, "vario": [1], "Vario": "x"}'), (4, "a", "{")], "id long, tipologia string, dati string")
    got = {r.id: r.asDict() for r in eav.wide(df).collect()}
    assert [got[i]["forza"] for i in (1, 2, 3, 4)] == [12, 10, None, None]
    assert [got[i]["vola"] for i in (1, 2, 3, 4)] == [None, True, False, None]
    assert got[1]["id_"] == "q" and got[2]["peso_netto"] == 1.5 and got[3]["vario"] == "x" and got[1]["livello"] == 2


def test_rare_attributes_stay_in_a_map(spark, monkeypatch):
    monkeypatch.setattr(eav, "MOST_COLUMNS", len(A.TYPED) + 1)
    df = spark.createDataFrame([(1, "a", '{"forza": 12, "x": 3}'), (2, "a", '{"forza": 9}')], "id long, tipologia string, dati string")
    got = {r.id: (r.forza, r.altri) for r in eav.wide(df).collect()}
    assert got == {1: (12, {"x": "3"}), 2: (9, {})}


def test_a_second_batch_is_merged_into_its_buckets_only(spark):
    first = [{"libro_id": b, "sessione": 1, "prog": n, "id": n % 5, "classe": "a", "annulla": False, "ts": str(1_700_000_000 + 900 * n)} for b in range(6) for n in range(1, 9)]
    late = [{"libro_id": 2, "sessione": 2, "prog": 1, "id": None, "classe": None, "annulla": True, "ts": str(1_700_000_000 + 900 * 4 + 5)}, first[3]]
    t = changefeed.BucketedTable(spark, fresh_path(spark, "test"), ["libro_id", "slot"], ["libro_id", "sessione", "prog"], ["istante", "prog"], 64)
    changefeed.apply_log(spark.createDataFrame([tuple(r.values()) for r in first], LOG), t)
    before = t.manifest()["buckets"]
    out = rows(changefeed.apply_log(spark.createDataFrame([tuple(r.values()) for r in late], LOG), t))
    after = t.manifest()["buckets"]
    assert 1 <= sum(before.get(b) != after[b] for b in after) <= 2
    assert out == _fold(first + late)


def test_one_writer_takes_a_version(spark):
    t = changefeed.BucketedTable(spark, fresh_path(spark, "test"), ["k"], ["k"], ["k"], 4)
    t._commit({"version": 1, "buckets": {}})
    with pytest.raises(RuntimeError):
        t._commit({"version": 1, "buckets": {"0": "x"}})
    assert t.manifest() == {"version": 1, "buckets": {}}
