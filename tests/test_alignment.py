"""Alignment operators, ordered folds and hashes against brute force."""

from __future__ import annotations

import hashlib
import hmac
import itertools
import random
import uuid

import pytest
from pyspark.sql import functions as F

from scriptorium.functions import text as T
from scriptorium.operators import alignment, folds


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_containment_and_cascade(spark):
    rng = random.Random(2)
    names = ["".join(rng.choice("abc") for _ in range(rng.randrange(2, 9))) for _ in range(120)]
    a = spark.createDataFrame([(i % 3, n) for i, n in enumerate(names[:60])] + [(None, "abca"), (1, None)], "k int, a string")
    b = spark.createDataFrame([(i % 3, n) for i, n in enumerate(names[60:])], "k int, b string")
    left, right = {(i % 3, n) for i, n in enumerate(names[:60])}, {(i % 3, n) for i, n in enumerate(names[60:])}
    want = {(k, x, y) for (k, x), (q, y) in itertools.product(left, right) if k == q and len(x) >= 4 and x in y}
    assert set(rows(alignment.contained(a, b, ["k"], "a", "b"))) == want
    got = {(r.k, r.a): r.trovato for r in alignment.cascading_match(a, b, ["k"], "a", "b").collect() if r.k is not None}
    for (k, x), y in got.items():
        near = [o for q, o in right if q == k and (o == x or (min(len(o), len(x)) >= 4 and (x in o or o in x)))]
        assert y == (min(near, key=lambda o: (o != x, len(o), o)) if near else None)
    assert rows(alignment.cascading_match(a.limit(0), b, ["k"], "a", "b")) == []


def test_ratio_of_matching_blocks(spark):
    df = spark.createDataFrame([("Il  Drago", "il drago"), ("abcd", "bcde"), (None, ""), ("a", None)], "a string, b string")
    assert [r[0] for r in df.select(alignment.ratio(F.col("a"), F.col("b"))).collect()] == [1.0, 0.75, 1.0, 0.0]


def test_outline_cursor_goes_forward(spark):
    outline = spark.createDataFrame([(1, 1, "uno", 0), (1, 4, "due", 1), (1, 5, "uno", 2), (2, 1, "x", 0)], "b int, pag int, voce string, ord int")
    lines = spark.createDataFrame([(1, 2, 0, 10, "uno"), (1, 5, 0, 11, "due"), (1, 5, 1, 12, "uno"), (1, 1, 0, 13, None)], "b int, pag int, n int, riga_id long, testo string")
    got = rows(alignment.outline_alignment(outline, lines, "b", lambda a, b: float(a == b)))
    assert got == sorted([(1, "uno", 1, 10), (1, "due", 4, 11), (1, "uno", 5, 12), (2, "x", 1, None)], key=repr)


def test_each_title_is_used_once(spark):
    pairs = spark.createDataFrame([(1, 1, "e1", 0, "t1", 0.9), (1, 1, "e1", 0, "t2", 0.95), (1, 1, "e2", 1, "t2", 1.0), (1, 1, "e3", 2, "t1", 0.85)], "b int, p int, e string, o int, t string, s double")
    assert [(r.e, r.t) for r in alignment.used_once(pairs, ["b", "p"], "e", "o", "t", "s").orderBy("e").collect()] == [("e1", "t2"), ("e3", "t1")]


def test_header_runs_skip_alternating_lines(spark):
    data = [(1, p, t, t.lower()) for p, t in enumerate(["A", "B", "A", "B", "A", "C", "C", "D"], 1)]
    df = spark.createDataFrame(data, "b int, p int, t string, k string")
    assert rows(alignment.header_runs(df, "b", "p", "t", "k", lambda a, b: a == b)) == [(1, 2, "B", 2), (1, 6, "C", 2)]  # A and B alternate: only the last run grows
    assert rows(alignment.header_runs(df.limit(0), "b", "p", "t", "k", lambda a, b: a == b)) == []


def test_totals_over_bins_equal_a_scan(spark):
    rng = random.Random(4)
    at = [rng.randrange(0, 5000) for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(at)], "i int, s long").withColumn("ts", F.timestamp_seconds("s"))
    got = {r.i: r.n for r in alignment.sliding_total(df, "ts", 600, "n").collect()}
    assert got == {i: sum(t - 600 < u <= t for u in at) for i, t in enumerate(at)}


def test_repeated_titles_go_below_their_model(spark):
    rng = random.Random(9)
    data = [(1, rng.randrange(1, 20), i, rng.choice(["Re del mare", "re, del mare!", "Oste", "Re"]), rng.randrange(1, 4)) for i in range(80)]
    got = {r.i: r.livello_nuovo for r in folds.demoted_repeats(spark.createDataFrame(data, "b int, p int, i int, t string, l int"), "b", "p", ["i"], "t", "l").collect()}
    done: list[tuple[str, int, int]] = []
    for _, p, i, t, level in sorted(data, key=lambda r: (r[1], r[2])):
        key = "".join(c for c in t.lower() if c.isalnum())
        if level <= 2 and len(key) >= 4:
            model = next((q for k, page, q in done if k == key and page > 3 and p - page <= 6 and q <= 2), None)
            if model is not None and level <= model:
                level = min(5, model + 1)
        done.append((key, p, level))
        assert got[i] == level


@pytest.mark.parametrize("word,want", [("dl2", "d12"), ("2dlO", "2d10"), ("IOd6", "10d6"), ("d1OO", "d100"), ("2l d6", "2l d6"), ("dl3", "dl3"), ("25dl2", "25dl2"), ("il d20", "il d20"), ("lD8+l", "1D8+l"), ("dO6", "d06"), (None, None)])
def test_dice_of_valid_quantity_and_faces(spark, word, want):
    assert spark.createDataFrame([(word,)], "t string").select(T.repair_dice(F.col("t"))).first()[0] == want


def test_keyed_hashes_and_named_ids(spark):
    row = spark.createDataFrame([("perché no",)], "t string").select(T.hmac_sha256(b"chiave", F.col("t")), T.hmac_sha256(b"k" * 80, F.col("t")), T.uuid5(uuid.NAMESPACE_URL, F.col("t"))).first()
    text = "perché no".encode()
    assert tuple(row) == (hmac.new(b"chiave", text, hashlib.sha256).hexdigest(), hmac.new(b"k" * 80, text, hashlib.sha256).hexdigest(), str(uuid.uuid5(uuid.NAMESPACE_URL, "perché no")))
