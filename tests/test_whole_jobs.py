"""Queries that once did less than the whole job."""

from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from scriptorium.functions import text as T
from scriptorium.operators import grams, lines, matching, search
from scriptorium.plans import relational, scalars
from scriptorium.session import table


def test_a_book_has_all_its_pages_in_order(spark):
    rows = [(1, 1, p, i, f"{p}.{i}") for p in range(1, 121) for i in (1, 0)]
    got = lines.book_parts(spark.createDataFrame(rows + rows[:9], "b int, k int, pag int, idx int, t string"), "b", "pag", ["idx", "k"], "t").orderBy("parte").collect()
    assert [(r.parte, r.da, r.a) for r in got] == [(0, 1, 49), (1, 50, 99), (2, 100, 120)]
    assert "\n\n---\n\n".join(r.testo for r in got) == "\n\n---\n\n".join(f"{p}.0\n\n{p}.1" for p in range(1, 121))


def test_every_page_of_the_table_is_in_a_book(spark, sf):
    pages = table(spark, sf, "pag_n_res").where("block_content is not null").groupBy("libro_id").agg(F.max("pag").alias("m"))
    got = relational.QUERIES["k03_all_pages"](spark, sf).groupBy("libro_id").agg(F.max("a").alias("m"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, pages.collect()))


def test_rare_and_short_terms_have_postings(spark):
    docs = spark.createDataFrame([(1, "Il re e il drago", "IT"), (2, "être, 2d6", None), (3, None, "it"), (4, "", "it")], "doc_id long, text string, lang string")
    got = {(r.lang, r.termine, r.doc_id): (r.n, r.posizioni) for r in search.postings(docs).collect()}
    assert got == {("it", "il", 1): (2, [1, 4]), ("it", "re", 1): (1, [2]), ("it", "e", 1): (1, [3]), ("it", "drago", 1): (1, [5]), (None, "être", 2): (1, [1]), (None, "2d6", 2): (1, [2])}


def test_the_index_is_a_query():
    assert "x79_postings" in relational.QUERIES


def _grams(s):
    s = "  " + s + " "
    return {s[i : i + 3] for i in range(len(s) - 2)}


def _alike(x, y):
    return int(len(_grams(x) & _grams(y)) / len(_grams(x) | _grams(y)) * 1e4 + 0.5) / 1e4  # half up, as Spark rounds


def _names(seed, n):
    rng = random.Random(seed)
    heads, parts = ["torre d ambra di", "torre del sale di", "lupo di", ""], ["gro", "fen", "glin", "dru", "ba", "co"]
    return sorted({f"{rng.choice(heads)} {''.join(rng.choice(parts) for _ in range(rng.randrange(1, 5)))}".strip() for _ in range(n)} | {"x" * 200, "ab" * 90, "ab" * 90 + "c", "".join(map(chr, range(200, 500))), "".join(map(chr, range(201, 501)))})


@pytest.mark.parametrize("codes,block", [(1 << 16, 1 << 15), (1 << 16, 40), (32, 1 << 15), (32, 40)])
def test_names_of_common_trigrams_find_all_their_like(spark, monkeypatch, codes, block):
    monkeypatch.setattr(grams, "CODES", codes)
    monkeypatch.setattr(grams, "BLOCK", block)
    names = _names(3, 500)
    df = spark.createDataFrame([(x,) for x in [*names, names[0], None]], "a string")
    for least in (0.35, 0.6, 1.0):
        got = [tuple(r) for r in matching.trigram_twins(df, "a", "b", T.shingles(F.col("a")), T.shingles(F.col("b")), least).collect()]
        assert sorted(got) == [(x, y, _alike(x, y)) for x in names for y in names if x < y and _alike(x, y) >= least]
    left, right = names[::2] + names[1::4], names[1::2] + names[::4]
    one, two = (spark.createDataFrame([(x,) for x in side], f"{c} string") for side, c in ((left, "a"), (right, "b")))
    got = [tuple(r) for r in matching.trigram_pairs(one, two, "a", "b", T.shingles(F.col("a")), T.shingles(F.col("b")), 0.6).collect()]
    assert sorted(got) == sorted((x, y, _alike(x, y)) for x in left for y in right if _alike(x, y) >= 0.6)


def test_few_pairs_of_names_leave_the_comparison(spark, sf):
    alike = relational.QUERIES["j20_trigram_names"](spark, sf)
    assert "Join" not in alike._jdf.queryExecution().executedPlan().toString()  # the pairs that share a rare trigram were joined and shuffled
    names = spark.createDataFrame([(x,) for x in _names(4, 2000)], "a string")
    asked = grams.candidates_within(names, "a", "b", T.shingles(F.col("a")), 0.6).count()
    assert asked <= 1.05 * matching.trigram_twins(names, "a", "b", T.shingles(F.col("a")), T.shingles(F.col("b")), 0.6).count()


def test_colours_of_keys_beyond_32_bits(spark, tmp_path):
    keys = [0, 1, 523907, 523908, 1199999, 1 << 31, 1 << 40, None]
    spark.createDataFrame([(k,) for k in keys], "p_partkey long").write.parquet(f"{tmp_path}/part.parquet")
    got = scalars.QUERIES["x62_colour_distance"](spark, str(tmp_path)).collect()
    want = duckdb.sql(scalars.SQL["x62_colour_distance"].replace("FROM part", f"FROM '{tmp_path}/part.parquet/*.parquet'")).fetchall()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr) and len(got) == len(keys)
