"""p8 against the tokenizer itself, and the transducer against a dictionary."""

from __future__ import annotations

import random

import pytest
from tokenizers import Tokenizer

from scriptorium.llm import encoding, plans
from scriptorium.llm.lexicon import Lexicon, compile_lexicon
from scriptorium.session import table


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_every_document_as_the_tokenizer(spark, sf, reference):
    want = {r.doc_id: reference(r.text) for r in table(spark, sf, "documents").collect()}
    assert {r.doc_id: list(r.ids) for r in plans.p8_ids(spark, sf).collect()} == want


ODD = ["", None, " ", "a", " a", "a ", "a  b", "a\nb", "a\n\nb", "a\n\n\nb", "a \nb", "a\n b", "\n", "\n\n", "a\n\n", "\tx", "caffè x", "it's we'll don't", "<|endoftext|> x", "x​y \U0001f642\U0001f642", "12345 67.8,9", "a b", "a\x1cb !?\u0085", "é́", "x" * 3000, "ab" * 900 + " " * 50 + "!" * 700, "\r\na\r\n", "  lead", "日本語 テキスト"]


def test_odd_spacing_and_long_texts(spark, reference):
    df = spark.createDataFrame(list(enumerate(ODD)) * 2, "doc_id long, text string")
    got = encoding.encoded(df, size=20).collect()
    assert len(got) == 2 * len(ODD)
    for r in got:
        assert list(r.ids) == reference(ODD[r.doc_id]), repr(ODD[r.doc_id])
    assert encoding.encoded(df.limit(0)).count() == 0
    counts = {r.doc_id: r.n_token for r in encoding.encoded(df, ids=False).collect()}
    assert counts == {i: len(reference(t)) for i, t in enumerate(ODD)}


def test_transducer_shares_suffixes():
    rng = random.Random(1)
    words = {bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 9))) + rng.choice([b"zione", b"mente", b""]): tuple(rng.randrange(99) for _ in range(rng.randrange(0, 4))) for _ in range(4000)}
    lex = Lexicon.open(compile_lexicon(words))
    assert len(lex) == len(words)
    import numpy as np

    for w, ids in words.items():
        assert np.frombuffer(lex.packed(w), "<i4").tolist() == list(ids)
    assert all(lex.packed(x) is None for x in (b"zzz", b"abczion", b"q") if x not in words)
    assert len(lex.final) < sum(map(len, words)) / 3
    assert len(Lexicon.open(compile_lexicon({}))) == 0
