"""p1: minimum cuts, found languages, clean text."""

from __future__ import annotations

import itertools
import random
import re

import pytest

from scriptorium.llm import markup, plans
from scriptorium.llm.mincut import min_cut
from scriptorium.session import table


def cost(gain, edges, label):
    return sum(abs(g) for g, x in zip(gain, label) if (g > 0) != x) + sum(w for i, j, w in edges if label[i] != label[j])


def test_min_cut_equals_brute_force():
    rng = random.Random(4)
    for _ in range(150):
        n = rng.randrange(1, 8)
        gain = [rng.uniform(-2, 2) for _ in range(n)]
        edges = [(i, j, rng.uniform(0, 1.5)) for i, j in itertools.combinations(range(n), 2) if rng.random() < 0.5]
        best = min(cost(gain, edges, x) for x in itertools.product([False, True], repeat=n))
        assert abs(cost(gain, edges, min_cut(gain, edges)) - best) < 1e-9
    assert min_cut([], []) == []


@pytest.mark.parametrize("text", markup._ORDINARY)
def test_ordinary_signs_are_no_markup(text):
    assert markup.languages(text.replace("W", "il drago dorme")) == []


@pytest.mark.parametrize("lang,text", markup._MARKED)
def test_made_markup_is_found(lang, text):
    assert markup.languages(text.replace("§", "").replace("W", "il drago dorme")) == [markup.LANGUAGES[lang]]


@pytest.mark.parametrize(
    "text,want",
    [("Il tiro <b>per</b> colpire&nbsp;vale", ["html"]), ("Il **tiro** vale", ["markdown"]), ("La [[spada]] vale", ["wiki"]), ("Vale $x^{2}$ e Gi\\`a", ["latex"]), ("**a** e <i>b</i> con ''c''", ["html", "markdown", "wiki"]), ("tronco <span class=\"x", ["html"]), ("se a<b e b>c", []), ("C:\\dati\\sud", []), ("costa 3$ o 4$", []), ("", []), (None, [])],
)
def test_languages(text, want):
    assert markup.languages(text) == want


@pytest.mark.parametrize(
    "text,want",
    [("<h2>Re</h2><p>a &amp; b</p>", "## Re\n\na & b"), ("<ul><li>a<li>b</ul>", "- a\n- b"), ("<table><tr><td>1</td><td>x</td></tr></table>", "| 1 | x |"), ("a **b** ~~c~~ [d](e.md)", "a b c d"), ("Re\n===\ntesto", "# Re\ntesto"), ("== Re ==\n'''a''' [[b|c]] {{n|d}}", "## Re\na c d"),
     ("\\section{Re}\n\\textbf{a} 3\\% $x^2$", "## Re\na 3% $x^2$"), ("\\begin{itemize}\n\\item a\n\\end{itemize}", "-  a"), ("Gi\\`a perch\\'e", "Già perché"), ("usa `tira(1)`", "usa `tira(1)`"), ("piano testo", "piano testo"), ("", ""), (None, None)],
)
def test_clean(text, want):
    assert markup.clean(text) == want


@pytest.mark.parametrize(
    "text,want",
    [("```\n**a**\n<b>x</b>\n```\n**b**", "```\n**a**\n<b>x</b>\n```\nb"), ("<pre>**a** &lt;b&gt;</pre> **c**", "```\n**a** <b>\n```\n c"), ("vedi `x **y** z` e **w**", "vedi `x **y** z` e w"), ("<table><tr><td>1<td>2<tr><td>3<td>4</table>", "| 1 | 2 |\n| 3 | 4 |"),
     ("{{Mostro|nome=Orco|ca=13}}", "Mostro: nome: Orco; ca: 13"), ("| a | b |\n|---|---|\n| **1** | 2 |", "| a | b |\n|---|---|\n| 1 | 2 |"), ("$$ " + "x^2 + " * 200 + "\\frac{a}{b} $$ e \\textbf{c}", "$$ " + "x^2 + " * 200 + "\\frac{a}{b} $$ e c"),
     ("\\begin{verbatim}\n\\textbf{a} **b**\n\\end{verbatim}", "```\n\n\\textbf{a} **b**\n\n```")],
)
def test_code_tables_and_records_stay(text, want):
    assert markup.clean(text) == want


@pytest.mark.parametrize("text,want", [("chiude -->", ["html"]), ("== Re ==", ["wiki"]), ("$" + "x_{1} + " * 60 + "y$", ["latex"])])
def test_signs_in_front_of_the_reader(text, want):
    assert markup.languages(text) == want and re.search(markup.PREFILTER, text)


# written apart from the templates of the fit
HELD_OUT = (
    ("html", "Il <i class='x'>vecchio</i> mulino"), ("html", "<ol start=2><li>primo</li><li>secondo</li></ol>"), ("html", "tra 3 &lt; 5 &eacute; chiaro"), ("html", "<a href='pag2.html'>vai</a> oltre"), ("html", "Fine.<br>Nuova riga<br>"), ("html", "<h3>Capitolo nono</h3>"), ("html", "testo <u>sotto</u> e <sub>2</sub>"), ("html", "<blockquote>disse lei</blockquote>"),
    ("markdown", "### La cripta\n\nBuia e fredda."), ("markdown", "la **lama del gelo** taglia"), ("markdown", "vedi [la mappa](mappe/nord.png)"), ("markdown", "> **Oste:** chi va là?"), ("markdown", "```python\nprint(1)\n```"), ("markdown", "| arma | danno |\n|:--|--:|\n| ascia | 1d8 |"), ("markdown", "una ~~vecchia~~ regola"), ("markdown", "![stemma](img/s.jpg)"),
    ("wiki", "la [[Foresta Nera|foresta]] è vasta"), ("wiki", "'''Nota''' sul testo"), ("wiki", "=== Origini ===\nNacque al nord."), ("wiki", "{| border=1\n|-\n| a || b\n|}"), ("wiki", "{{Arma|nome=Ascia|peso=2}}"), ("wiki", "il ''Codice'' antico"),
    ("latex", "\\subsection{Il ponte} crolla"), ("latex", "vale $\\frac{3}{4}$ del totale"), ("latex", "\\emph{forse} domani"), ("latex", "\\begin{enumerate}\n\\item uno\n\\end{enumerate}"), ("latex", "citt\\`a e perch\\'e"), ("latex", "somma $a_1 + b^2$ pari"), ("latex", "dopo \\ref{fig:2} viene"),
)
HELD_OUT_PLAIN = ("se a < b allora c > d", "prezzo 5$ oppure 8$", "il tiro 2 * 3 = 6", "a_b e c_d sono codici", "vedi [4] e [7]", "cartella C:\\giochi\\carte", "il 100% & oltre", "Nome: ____ Età: ____", "# 3 della lista", "lungo 12'' circa", "{1, 2} e {3}", "- primo\n- secondo", "mago/ladro | 3", "> 18 anni", "R&D; poi altro")


def test_held_out_examples():
    wrong = [(lang, t, markup.languages(t)) for lang, t in HELD_OUT if markup.languages(t) != [lang]] + [("", t, markup.languages(t)) for t in HELD_OUT_PLAIN if markup.languages(t)]
    assert len(wrong) <= 0.1 * (len(HELD_OUT) + len(HELD_OUT_PLAIN)), wrong


def test_repeats_and_rows_without_a_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (None, "d")], "blocco_id long, block_content string")
    assert sorted((r[0] or 0, r[1]) for r in markup.cleaned(markup.once(df)).collect()) == [(0, "c"), (0, "d"), (1, "a"), (2, "b")]


def test_found_over_rows(spark):
    df = spark.createDataFrame([(1, "<b>x</b>", "z"), (1, "<b>x</b>", "z"), (2, None, "z"), (3, "", "z"), (None, "<b>x</b>", "z"), (4, "x " * 100_000 + "**fine** qui", "z")], "blocco_id long, block_content string, tipo string")
    assert sorted(tuple(r) for r in markup.found(df).collect()) == [(1, "html"), (4, "markdown")]
    assert markup.found(df.limit(0)).count() == 0
    assert markup.cleaned(df).count() == 6


def test_whole_table(spark, sf):
    rows = {(r.blocco_id, r.tipo) for r in plans.p1_found(spark, sf).collect()}
    want = {(r.blocco_id, x) for r in table(spark, sf, "pag_n_res").collect() for x in markup.languages(r.block_content)}
    assert rows == want
    clean = {r.blocco_id: r.testo for r in plans.p1_clean(spark, sf).collect()}
    left = [b for b, t in clean.items() if t and "<td>" in t.lower()]
    assert not left
