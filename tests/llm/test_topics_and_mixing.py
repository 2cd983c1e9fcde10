"""p9 and p10: held-out accuracy, raking, caps and shares."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from scriptorium.llm import mixing, plans, topics
from scriptorium.session import table


def test_subject_areas_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"  # sf0.001 has nine documents to fit and nine to test
    docs, labels, areas = (table(spark, sf, t) for t in ("documents", "etichette_doc", "aree"))
    # documents that all annotators gave the same areas; half of them fit, half test
    sets = labels.distinct().groupBy("doc_id", "annotatore").agg(F.sort_array(F.collect_set("area")).alias("a")).groupBy("doc_id").agg(F.collect_set("a").alias("s")).where("size(s) = 1")
    test = sets.where("doc_id % 2 = 0")
    model = topics.fit(docs, labels.join(test, "doc_id", "left_anti"), areas)
    truth = {r.doc_id: set(r.s[0]) - {"nessuna"} for r in test.collect()}
    got: dict[int, set] = {}
    for r in topics.assigned(docs, model).collect():
        got.setdefault(r.doc_id, set()).add(r.area)
    tp = sum(len(truth[d] & got.get(d, set())) for d in truth)
    assert tp >= 0.75 * sum(map(len, truth.values())) and tp >= 0.75 * sum(len(got.get(d, set())) for d in truth)


def test_blank_texts_and_no_labels(spark, sf):
    labels, areas = table(spark, sf, "etichette_doc"), table(spark, sf, "aree")
    docs = table(spark, sf, "documents")
    model = topics.fit(docs, labels, areas)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, " \n "), (4, "Indice generale 71\nDedica 4"), (5, "xyz " * 50_000)], "doc_id long, text string")
    assert topics.assigned(odd, model).count() == 0
    assert topics.assigned(odd, topics.fit(docs, labels.limit(0), areas)).count() == 0
    assert topics.assigned(odd.limit(0), model).count() == 0


def test_svd_finds_the_main_directions():
    rng = np.random.default_rng(0)
    terms = rng.integers(0, 12, 4000).astype(np.int32)
    passage = np.sort(rng.integers(0, 300, 4000))
    weights = np.linspace(0.5, 1.5, 12).astype(np.float32)
    dense = np.zeros((300, 12))
    np.add.at(dense, (passage, terms), weights[terms])
    q = topics.truncated_svd(terms, passage, weights, 3, 60)
    v = np.linalg.svd(dense, full_matrices=False)[2][:3].T
    assert abs(np.linalg.det(q.T @ v)) > 0.99


def cells():
    rng = random.Random(1)
    return pd.DataFrame([(s, lang, a, rng.randrange(200, 900) * k) for s, k in (("x", 50), ("y", 8), ("z", 1)) for lang in ("it", "en") for a in ("p", "q", "r")], columns=["source", "lang", "area", "n_token"])


def test_raking_reaches_the_shares():
    c = cells()
    t = pd.DataFrame([("x", 0.5, 1), ("y", 0.3, 2), ("z", 0.1, 4), ("none", 0.1, 5)], columns=["source", "peso", "max_ripetizioni"])
    w = mixing.rake(c, t).merge(c)
    used = (w.usi * w.n_token).groupby(w.source).sum()
    assert np.allclose(used / used.sum(), np.array([0.5, 0.3, 0.1]) / 0.9, atol=1e-3)
    assert (w.usi <= w.source.map({"x": 1, "y": 2, "z": 4}) + 1e-9).all()
    lang = (w.usi * w.n_token).groupby(w.lang).sum() / (w.usi * w.n_token).sum()
    own = c.groupby("lang").n_token.sum() / c.n_token.sum()
    assert np.allclose(lang, own, atol=0.05)
    capped = mixing.rake(c, t, total=1e9)
    assert np.allclose(capped.usi, capped.source.map({"x": 1, "y": 2, "z": 4}))
    assert mixing.rake(c, t[t.source == "none"]).empty


def test_mixture(spark, sf):
    rows = [(i, "abc"[i % 3] if i % 50 else "big", ["it", "EN", None][i % 3], ["p", None][i % 2], 50 + i % 40) for i in range(6000)]
    docs = spark.createDataFrame(rows + rows[:20] + [(9001, None, "it", "p", 5), (9002, "a", "it", "p", 0), (9003, "other", "it", "p", 9)], "doc_id long, source string, lang string, area string, n_token long")
    t = spark.createDataFrame([("a", 0.6, 1), ("b", 0.3, 1), ("big", 0.1, 5), ("void", 0.2, 3)] * 2, "source string, peso double, max_ripetizioni int")
    mix = mixing.mixed(docs, t)
    got = mix.toPandas()
    assert got.doc_id.is_unique and set(got.source) == {"a", "b", "big"}
    assert (got.ripetizioni <= got.source.map({"a": 1, "b": 1, "big": 5})).all()
    share = (got.n_token * got.ripetizioni).groupby(got.source).sum() / (got.n_token * got.ripetizioni).sum()
    assert np.allclose(share, [0.6, 0.3, 0.1], atol=0.02)
    report = {r.source: (r.documenti, r.quota) for r in mixing.shares(mix, t).collect()}
    assert report["void"] == (0, 0.0) and abs(sum(q for _, q in report.values()) - 1) < 1e-4
    assert mixing.mixed(docs.limit(0), t).count() == 0
    caps = {r.source: r.max_ripetizioni for r in table(spark, sf, "pesi_fonti").collect()}
    assert all(r.ripetizioni <= caps[r.source] for r in plans.p9_mix(spark, sf).collect())


def test_shares_follow_tokens_of_any_size(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice("abc"), rng.choice(["it", "en-GB", "??"]), rng.choice(["p", "q", None]), int(rng.lognormvariate(5, 1.2)) + 1) for i in range(9000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, area string, n_token long")
    t = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.1, 1), ("void", 0.1, 1)], "source string, peso double, max_ripetizioni int")
    mix = mixing.mixed(docs, t)
    report = {r.source: (r.obiettivo, r.quota) for r in mixing.shares(mix, t).collect()}
    assert all(abs(goal - got) < 0.001 for goal, got in report.values()) and report["void"] == (0.0, 0.0)
    margins = mixing.marginals(mix, docs).collect()
    assert {r.classe for r in margins if r.margine == "lang"} == {"it", "en", "?"}
    assert all(abs(r.quota_corpus - r.quota_mix) < 0.02 for r in margins)
