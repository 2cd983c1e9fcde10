"""Markup residue of HTML, Markdown, wiki and LaTeX in texts: found by minimum-cut labelling, turned into clean text.

Signs that may be markup are read from a text with cues of their surroundings. A classifier of the cues, fitted here
on made examples of markup and of the same signs in ordinary use, gives each sign its gain as markup (the terminal
capacities). Edges between neighbouring signs of a language, between the ends of a pair (tag and end tag, rows of a
table, begin and end) and between an HTML element and what stands in it make their labels agree. The minimum cut
separates markup from content.
"""

from __future__ import annotations

import html
import math
import random
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.mincut import min_cut
from scriptorium.session import written

LANGUAGES = ("html", "markdown", "wiki", "latex")
# fixed values: element names of HTML
TAGS = frozenset(
    "a abbr address article aside b big blockquote body br button caption center cite code col colgroup dd del details dfn div dl dt em embed fieldset figcaption figure font footer form "
    "frame h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend li link main map mark menu meta nav ol option p param pre q s samp script section select small "
    "span strike strong style sub summary sup svg table tbody td textarea tfoot th thead title tr tt u ul var video wbr".split()
)
# fixed values: commands of TeX and LaTeX
COMMANDS = frozenset(
    "begin end item section subsection subsubsection chapter part paragraph subparagraph title author date maketitle textbf textit texttt textsc textsf textrm textsl emph underline em bf it tt sc rm sf sl bfseries itshape "
    "footnote footnotemark footnotetext label ref pageref eqref cite citep citet index caption centering includegraphics input include usepackage documentclass newcommand hline cline multicolumn tabular hspace vspace "
    "medskip smallskip bigskip noindent newpage clearpage newline linebreak par quad qquad ldots dots cdots frac dfrac tfrac sqrt sum prod int lim left right lfloor rfloor lceil rceil times div cdot pm mp leq geq le ge neq "
    "ne approx equiv sim infty alpha beta gamma delta epsilon varepsilon zeta eta theta lambda mu nu xi pi rho sigma tau phi varphi chi psi omega Gamma Delta Theta Lambda Pi Sigma Phi Psi Omega mathrm mathbf mathit mathcal "
    "mathbb text mbox hbox vec hat bar overline to rightarrow leftarrow Rightarrow leftrightarrow in notin subset cup cap forall exists partial nabla log ln exp sin cos tan min max mod bmod pmod binom over textwidth "
    "linewidth ss ae oe aa textquoteright textquoteleft textquotedblleft textquotedblright textemdash textendash guillemotleft guillemotright large Large small footnotesize tiny huge href url S P".split()
)
CUES = ("known", "odd", "paired", "left", "right", "argument", "digit", "words", "formal", "inside", "start", "thin")
CLASSES = (
    "tag", "cuttag", "comment", "entity", "heading", "underline", "rule", "emphasis", "tick", "fence", "link", "reference", "definition", "note", "quote", "task", "row", "delimiter",
    "wikilink", "quotes", "template", "wikitable", "wikicell", "wikiheading", "magic", "environment", "command", "math", "delimmath", "break", "symbol", "accent", "texquotes",
)
_CLASS = {c: i for i, c in enumerate(CLASSES)}
_CUE = {c: i + 1 for i, c in enumerate(CUES)}
_WIDTH = len(CUES) + 1


class Mark(NamedTuple):
    """A sign that may be markup: its place, language, class, cues and the key under which it pairs with others."""

    start: int
    end: int
    language: int
    kind: str
    cues: tuple[str, ...]
    pair: str


#: Texts without any of these can't hold markup (a test of the JVM, in front of the Python workers).
PREFILTER = r"[<&*_`\[\]#|\\${}]|~~|''|==|-{3}|-->|(?m:^)\s*>"
_SIGNS = re.compile(
    r"(?P<comment><!--(?:[^-]|-(?!->))*(?:-->)?|-->)"
    r"|(?P<tag></?([A-Za-z][A-Za-z0-9]*)(\s[^<>]*)?/?>)"
    r"|(?P<cuttag></?([A-Za-z][A-Za-z0-9]*)(?:\s+[A-Za-z-]+\s*=[^<>\n]*)?(?=\n|\Z))"
    r"|(?P<entity>&(?:\#[0-9]+|\#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);|&(?:nbsp|quot|rsquo|lsquo|hellip|laquo|raquo|egrave|agrave)\b)"
    r"|(?P<accent>\\['\"`^~=.]\s?\{?\\?[A-Za-z]\}?|\\[cvHkrub]\{[A-Za-z]\})"
    r"|(?P<environment>\\(?:begin|end)\s*\{[A-Za-z]*\*?\}?)"
    r"|(?P<command>\\([A-Za-z]+)\*?)"
    r"|(?P<delimmath>\\[()\[\]])"
    r"|(?P<break>\\\\(?=\s|\Z|\[))"
    r"|(?P<symbol>\\[%&$#_,;:!{}])"
    r"|(?P<math>\$\$[^$]+\$\$|\$[^$\n]+\$)"
    r"|(?P<texquotes>``[^`\n]+?'')"
    r"|(?P<fence>(?m:^)[ ]{0,3}(?:```+|~~~+)[^\n`~]*(?=\n|\Z))"
    r"|(?P<tick>`+)"
    r"|(?P<wikilink>\[\[[^\[\]\n]*(?:\]\]|(?=\n|\Z))|\[https?://\S+\s[^\]\n]*\])"
    r"|(?P<note>\[\^[^\]\s]+\]:?)"
    r"|(?P<link>!?\[[^\[\]\n]*\]\([^()\s]*(?:\)|(?=\n|\Z))|!\[[^\[\]\n]*(?=\n|\Z))"
    r"|(?P<task>(?m:^)[ ]*[-*+] \[[ xX]\] )"
    r"|(?P<definition>(?m:^)[ ]*\[[^\[\]\n]+\]:\s*\S+)"
    r"|(?P<reference>\[[^\[\]\n]+\]\s?\[[^\[\]\n]*\])"
    r"|(?P<template>\{\{[^{}\n]*(?:\}\}|(?=\n|\Z)))"
    r"|(?P<wikitable>(?m:^)[ ]*(?:\{\||\|\}|\|-(?!-))[^\n]*)"
    r"|(?P<delimiter>(?m:^)[ ]*\|?[ ]*:?-{2,}:?[ ]*\|[ :|-]*(?=\n|\Z))"
    r"|(?P<wikicell>(?m:^)[ ]*(?:!(?=[^\n\[]*!!)|\|(?=[^\n|]*\|\|)))"
    r"|(?P<row>(?m:^)[ ]*\|(?=[^\n]*\|[ ]*(?:\n|\Z)))"
    r"|(?P<wikiheading>(?m:^)(={2,6})[^=\n]+={2,6}[ ]*(?=\n|\Z))"
    r"|(?P<underline>(?m:^)(?:={3,}|-{3,})[ ]*(?=\n|\Z))"
    r"|(?P<rule>(?m:^)[ ]{0,3}(?:(?:\*[ ]?){3,}|(?:_[ ]?){3,})(?=\n|\Z))"
    r"|(?P<heading>(?m:^)\#{1,6}[ \t]+(?=\S))"
    r"|(?P<magic>__[A-Z]{3,}__|\#(?:REDIRECT|RINVIA|REDIRECTION)\b|~{4,5}(?!~))"
    r"|(?P<quote>(?m:^)[ ]{0,3}(?:>[ ]?)+)"
    r"|(?P<quotes>'{2,5}(?!'))"
    r"|(?P<emphasis>\*{1,3}(?!\*)|_{1,3}(?!_)|~~(?!~))",
)
_ATTRIBUTES = re.compile(r"(?:\s+[A-Za-z][\w:-]*\s*=\s*(?:\"[^\"]*\"?|'[^']*'?|[^\s\"'<>=]+)|\s+(?:nowrap|noshade|checked|disabled|selected|compact))*\s*/?\s*")
_PLAIN = re.compile(r"(?<![\\A-Za-z])[^\W\d_]{3,}(?![A-Za-z]*\{)")
_LANG = {"tag": 0, "cuttag": 0, "comment": 0, "entity": 0, "wikilink": 2, "quotes": 2, "template": 2, "wikitable": 2, "wikicell": 2, "wikiheading": 2, "magic": 2} | {k: 3 for k in ("environment", "command", "math", "delimmath", "break", "symbol", "accent", "texquotes")}


def _blank(c: str) -> bool:
    return not c or c.isspace()


def marks(text: str) -> list[Mark]:
    """All signs of a text with their cues."""
    raw = []
    counts: dict[str, int] = {}
    opened: dict[str, int] = {}
    table = "{|" in text or "|}" in text or "|-\n" in text
    for m in _SIGNS.finditer(text):
        kind, s, e = m.lastgroup, m.start(), m.end()
        got = m.group()
        before, after = text[s - 1 : s], text[e : e + 1]
        cues: list[str] = []
        pair = ""
        if kind == "tag" or kind == "cuttag":
            t = re.match(r"</?([A-Za-z0-9]+)", got)[1].lower()
            rest = got[2 + len(t) if got[1] == "/" else 1 + len(t) :].rstrip(">")
            fine = _ATTRIBUTES.fullmatch(rest) is not None
            if t in TAGS or t in ("ref", "nowiki"):
                cues.append("known")
            if not fine:
                cues.append("odd")
            if "=" in rest:
                cues.append("argument")
            if got[1] == "/":
                cues.append("right")
            pair = "<" + t
        elif kind == "entity":
            if got[1] == "#" or got[1:] in html.entities.html5 or got[1:] + ";" in html.entities.html5:
                cues.append("known")
            if before.isalpha() and got[1:2].isupper():
                cues.append("odd")
        elif kind == "comment":
            cues.append("known")
        elif kind == "emphasis" or kind == "quotes" or kind == "tick":
            if got[0] == "_" and len(got) > 2 and (before == "_" or after == "_"):
                continue
            left, right = not _blank(after), not _blank(before)
            if left and (not right or not before.isalnum()):
                cues.append("left")
            if right and (_blank(after) or not after.isalnum()):
                cues.append("right")
            if before.isalnum() and after.isalnum():
                cues.append("inside")
            if before.isdigit() or (got[0] == "*" and before == ")"):
                cues.append("digit")
            if len(got) == 1:
                cues.append("thin")
            if not left and not right:
                cues.append("odd")
            if kind == "tick" and before == "\\":
                continue
            if after and after in ":;,.)" and not right:
                cues.append("odd")
            pair = got
        elif kind == "math":
            inner = got.strip("$")
            if re.search(r"\\[A-Za-z%]|[\^_]", inner):
                cues.append("formal")
            if "=" in inner:
                cues.append("argument")
            if _PLAIN.search(inner):
                cues.append("words")
            if got.startswith("$$"):
                cues.append("known")
            if not inner.strip():
                cues.append("odd")
            if "formal" not in cues and "known" not in cues and ("words" in cues or before.isdigit()):
                cues.append("digit")
        elif kind == "command":
            name = got[1:].rstrip("*")
            if name in COMMANDS:
                cues.append("known")
            if after in "{[" and after:
                cues.append("argument")
            if before.isalnum() or before in ":\\" and before:
                cues.append("inside")
            if text[e : e + 1] == "\\" and name not in COMMANDS:
                cues.append("odd")
            if len(name) == 1:
                cues.append("thin")
        elif kind == "quote":
            if after.isdigit() or after == "=" or (got[-1] != " " and len(got.strip()) == 1 and not after.isupper()):
                cues.append("digit")
            if after.isalpha() or after in "*_[`" and after:
                cues.append("left")
            pair = ">"
        elif kind == "link":
            target = got[got.find("](") + 2 :]
            if "](" not in got or re.search(r"[./#]|https?:", target):
                cues.append("known")
            if got[0] == "!":
                cues.append("start")
        elif kind == "reference" or kind == "wikilink":
            if re.fullmatch(r"[\[\]\d\s,;.\-]*", got):
                cues.append("digit")
            if got.startswith("[["):
                cues.append("known")
        elif kind == "definition":
            if got.lstrip().startswith("[^") or re.search(r"\]:\s*(?:https?:|\S+\.\w{2,5}$|[#/]\S)", got):
                cues.append("known")
        elif kind == "template":
            if re.match(r"\{\{\s*[^\W\d_]", got):
                cues.append("known")
        elif kind == "wikiheading":
            inner = got.strip("= ")
            if len(inner) < 2:
                cues.append("thin")
        elif kind == "underline":
            above = text[:s].rstrip("\n").rpartition("\n")[2] if text[:s].endswith("\n") else ""
            if above.strip() and not text[:s].endswith("\n\n"):
                cues.append("left")
        elif kind == "rule":
            if "_" in got:
                cues.append("odd")
        elif kind == "row":
            if table:
                kind = "wikicell"
            pair = "|"
        elif kind == "heading":
            if after.isdigit():
                cues.append("digit")
        elif kind == "magic":
            if got[0] == "~" and (s == 0 or before == "\n"):
                cues.append("odd")
        if kind in ("wikitable", "wikicell"):
            pair = "{|"
        elif kind == "delimiter":
            pair = "|"
        elif kind == "environment":
            pair = "\\" + got.partition("{")[2].rstrip("}")
        elif kind == "delimmath":
            pair = "\\("
        if pair and kind in ("emphasis", "quotes", "tick"):  # an opening and a closing end
            if "right" in cues and pair in opened:
                cues.append("paired")
                raw[opened.pop(pair)][4].append("paired")
            elif "left" in cues:
                opened[pair] = len(raw)
            else:
                pair = ""
        elif pair:
            counts[pair] = counts.get(pair, 0) + 1
        raw.append((s, e, _LANG.get(kind, 1), kind, cues, pair))
    out = []
    for s, e, lang, kind, cues, pair in raw:
        if pair and counts.get(pair, 0) > 1:
            cues.append("paired")
        out.append(Mark(s, e, lang, kind, tuple(cues), pair))
    return out


_DOMAIN = ("il drago di pietra dorme", "la torre ha due porte", "chi perde paga il pegno", "ogni eroe tira un dado", "the old bridge is closed", "le roi garde la clef", "un mercante vende tre spade", "nessuno apre la cripta", "la notte cala presto")
# markup in use (language, text with § around it) and the same signs in ordinary use; W is replaced by words
_MARKED = (
    (0, "§<b>§W§</b>§ W."), (0, "§<p align=\"left\">§W.§</p>§"), (0, "§<div style='x: y;'>§W§</div>§"), (0, "§<br/>§W"), (0, "§<TD>§W§</TD>§"), (0, "W §<SPAN\nclass=n>§W§</SPAN>§"), (0, "W §<font color=red>§W§</font>§"), (0, "W§<!-- W -->§ W"), (0, "W§<!-- W"),
    (0, "W §&nbsp;§W"), (0, "l§&#8217;§alba W"), (0, "W §&amp;§ W"), (0, "W§&hellip;§"), (0, "W §<span class=\"no"), (0, "W §</i>§ W"), (0, "§<table border=1><tr><td>§W§</td></tr></table>§"), (0, "W §<hr>§ W"), (0, "W §<img src=\"f.png\" alt=\"W\"/>§"), (0, "§<h2 id=s3>§W§</h2>§ W"), (0, "W§<sup>§W§</sup>§"),
    (1, "§## §W\n\nW."), (1, "W\n§=======§\nW."), (1, "W\n§-------§\nW."), (1, "W §**§W§**§ W."), (1, "W §*§W§*§ W."), (1, "W §***§W§***§ W."), (1, "W §__§W§__§ W."), (1, "W §_§W§_§ W."), (1, "W §**§W"), (1, "W §~~§W§~~§ W"), (1, "W §~~§W"), (1, "usa §`§tira(1d6)§`§ W"), (1, "W §`§tira"), (1, "§```§\nW\n§```§"),
    (1, "§![W](images/f_1.jpg)§\nW"), (1, "W §[W](pag_3.md)§ W"), (1, "W §[W][mappa]§ W"), (1, "§[mappa]: pag_3.md§"), (1, "W.§[^3]§"), (1, "§[^3]:§ W"), (1, "§> §W.\n§> §W"), (1, "§> **§Nota.§**§ W"), (1, "§- [ ] §W\n§- [x] §W"), (1, "§| d8 | W |§\n§|---|:---:|§\n§| 1 | W |§"), (1, "d8 | W\n§--|--§\n1 | W"), (1, "W\n\n§***§\n\nW"), (1, "W §**§W:§**§ W"), (1, "W (§*§W§*§)"),
    (2, "W §[[W]]§ W"), (2, "W §[[W|altro]]§"), (2, "W §'''§W§'''§ W."), (2, "W §''§W§''§ W."), (2, "W §'''''§W§'''''§."), (2, "W §{{c|W}}§ W"), (2, "§{{Mostro|nome=W|ca=3}}§"), (2, "§{| class=\"wikitable\"§\n§! d6 !! Effetto§\n§|-§\n§| 1 || W§\n§|}§"), (2, "§== W ==§\nW."), (2, "§=== W ===§\nW"), (2, "§#REDIRECT§ §[[W]]§"), (2, "W. §~~~~§"), (2, "§__NOTOC__§ W"), (2, ":§''§W§''§"), (2, "W §'''§W"), (2, "W §[[W"), (2, "W §{{c|W"), (2, "* §'''§W§'''§ W"),
    (3, "§\\begin{itemize}§\n§\\item§ W.\n§\\end{itemize}§"), (3, "§\\section§{W}\nW"), (3, "W §\\textbf§{W} W."), (3, "W §$x^{2}$§"), (3, "W §$ 25 \\% $§ su §$ 10^{4} $§."), (3, "W H§$_2$§O"), (3, "W §$\\frac{1}{2} \\times 4$§"), (3, "§$$ D = 3d6 + \\left\\lfloor \\frac{L}{2} \\right\\rfloor $$§"), (3, "W §\\(§CD = 12 + §\\mathrm§{mod}§\\)§"),
    (3, "W. pag.~§\\pageref§{tab:5}"), (3, "W {§\\em§ W} W"), (3, "Gi§\\`a§ W"), (3, "bench§\\'e§ W"), (3, "W 30§\\,§§\\%§ W"), (3, "W §``W''§ W"), (3, "2 & W. §\\\\§ \n3 & W §\\\\§"), (3, "W. §\\ldots§"), (3, "§\\medskip§"), (3, "W §\\S§~8"), (3, "W {§\\bf§ W}"), (3, "W§\\footnote§{W.} W"), (3, "W §$d_{6}$§"), (3, "W §$\\leq 3$§"), (3, "§\\begin{tabular}§{ll}"), (3, "W §\\textbf§{W"), (3, "W §$n = 4$§"), (3, "W §\\LaTeX§{} W"), (3, "W §\\foo§{W} W"),
)
_ORDINARY = (
    "se a<b e b>c W", "se CA <9 e CA >3 W", "Orso&Lupo; W", "La locanda Ape&Ragno; W", "W 3d6 & W", "se x < 9 W", "il tiro è <= 9 o >= 3 W", "> 9 W", ">9 W", ">= 3 W", "Nome: ______ Classe: ____", "danno +1* W (*: W)", "prezzo** e peso* (** W)", "fa 2 * 9 + 3. W", "2 *\n9 + 3", "usa nome_file_lungo W", "file_nome_x e altro_nome",
    "Nome:\n______\nW", "______", "#3 W", "il n. #7 W", "W [vedi oltre] W", "vedi [1] e [2] W", "vedi [1][2] W", "asta lunga 63'' e larga 2'' W", "asta di 3'' W", "vale se A == B == C. W", "== B ==\nW", "A\n== B == C", "gli insiemi { {1,2}, {3} } W", "la scelta {A|B} W", "Punteggio: 3|41|7. W", "sta in C:\\mappe\\nord. W", "sta in D:\\dati\\sud W", "mago e\\o ladro W",
    "costa $ 12 oppure $ 15 al W", "circa 9$ al pezzo di 3$ W", "paga 5$ e poi 6$ W", "~20 metri e ~30 W", "W 5% W", "• W\n• W", "- W\n- W", "* W\n* W", "W A_ W", "W (*) W", "W * W", "W *", "W &c; W", "x > y\n> z", "W `", "W [W]", "[W]: W W", "W | W", "1 - W", "W -- W", "scelte {1, 2} W", "un \\ solo", "premi\\fine W", "si\\no W", "il <mago W", "Rif. [3, 4] W", "W_ W", "W -> W", "* 9 + 9. W", "W #W",
)


@lru_cache(1)
def weights() -> np.ndarray:
    """Logistic regression of class and cues on made examples: a row of weights per class."""
    rng = random.Random(11)
    rows, aims = [], []

    def words() -> str:
        w = rng.choice(_DOMAIN).split()
        k = rng.randrange(1, len(w) + 1)
        a = rng.randrange(0, len(w) - k + 1)
        return " ".join(w[a : a + k])

    def fill(t: str) -> str:
        return re.sub(r"\bW\b", lambda _: words(), re.sub(r"(?<![\d\\])\b[39]\b", lambda _: str(rng.randrange(2, 90)), t))

    for _ in range(24):
        for lang, t in _MARKED:
            parts = fill(t).split("§")
            text, spans, at = "", [], 0
            for i, p in enumerate(parts):
                if i % 2:
                    spans.append((at, at + len(p)))
                text += p
                at += len(p)
            for m in marks(text):
                if m.language == lang:
                    inside = any(a <= m.start and m.end <= b + 1 or a < m.end and m.start < b for a, b in spans)
                    rows.append(m)
                    aims.append(float(inside))
        for t in _ORDINARY:
            for m in marks(fill(t)):
                rows.append(m)
                aims.append(0.0)
    x = np.zeros((len(rows), len(CLASSES) * _WIDTH))
    for i, m in enumerate(rows):
        at = _CLASS[m.kind] * _WIDTH
        x[i, [at, *(at + _CUE[c] for c in m.cues)]] = 1
    y, w = np.array(aims), np.zeros(x.shape[1])
    for _ in range(25):  # Newton steps of the penalised likelihood
        p = 1 / (1 + np.exp(-x @ w))
        h = x.T @ (x * (p * (1 - p))[:, None]) + 0.5 * np.eye(len(w))
        w += np.linalg.solve(h, x.T @ (y - p) - 0.5 * w)
    return w.reshape(len(CLASSES), _WIDTH)


#: Weights of edges: neighbours (falling with the distance), ends of a pair, an element and the one around it; cost of standing in plain text.
NEAR, REACH, PAIR, DOM, ALONE = 0.5, 60.0, 1.5, 0.4, 0.1
# fixed values: elements without an end tag
_VOID = frozenset("br hr img input meta link col wbr".split())


def _parents(text: str, own: list[Mark]) -> list[tuple[int, int]]:
    """Of each sign that stands in an HTML element the place of the element's tag: the edges of the tree that the tags make. Elements left open end with the one around them."""
    stack: list[tuple[str, int]] = []
    out = []
    for i, m in enumerate(own):
        if m.kind == "tag" and "right" in m.cues:
            names = [n for n, _ in stack]
            if m.pair in names:
                del stack[len(names) - 1 - names[::-1].index(m.pair) :]
        if stack:
            out.append((stack[-1][1], i))
        if m.kind == "tag" and "right" not in m.cues and m.pair[1:] not in _VOID and text[m.end - 2] != "/":
            stack.append((m.pair, i))
    return out


@lru_cache(8192)
def _gain(kind: str, cues: tuple[str, ...]) -> float:
    row = weights()[_CLASS[kind]]
    return float(row[0] + sum(row[_CUE[c]] for c in cues))


def labelled(text: str) -> list[tuple[Mark, bool]]:
    """The signs of a text and whether the minimum cut takes them for markup."""
    found = marks(text)
    out: list[tuple[Mark, bool]] = []
    for lang in {m.language for m in found}:
        own = [m for m in found if m.language == lang]
        gain = [_gain(m.kind, m.cues) - ALONE for m in own]
        if len({g > 0 for g in gain}) == 1:  # one sign: the cut is empty
            out += [(m, gain[0] > 0) for m in own]
            continue
        edges = [(i, i + 1, NEAR * math.exp(-max(0, b.start - a.end) / REACH)) for i, (a, b) in enumerate(zip(own, own[1:]))]
        last: dict[str, int] = {}
        for i, m in enumerate(own):
            if m.pair:
                if m.pair in last:
                    edges.append((last[m.pair], i, PAIR))
                last[m.pair] = i
        if lang == 0:
            edges += [(i, j, DOM) for i, j in _parents(text, own)]
        out += zip(own, min_cut(gain, edges))
    return sorted(out, key=lambda x: x[0].start)


def languages(text: str | None) -> list[str]:
    """Languages of which a text holds markup; none for null and empty texts."""
    if not text:
        return []
    return sorted({LANGUAGES[m.language] for m, yes in labelled(text) if yes})


# fixed values: the marks that TeX accents stand for
_ACCENTS = {"`": "\u0300", "'": "\u0301", "^": "\u0302", '"': "\u0308", "~": "\u0303", "=": "\u0304", ".": "\u0307", "c": "\u0327", "v": "\u030c", "H": "\u030b", "k": "\u0328", "r": "\u030a", "u": "\u0306", "b": "\u0331"}
# fixed values: what some commands become
_SAYS = {"ldots": "…", "dots": "…", "S": "§", "P": "¶", "item": "- ", "hline": "", "medskip": "\n", "smallskip": "\n", "bigskip": "\n", "par": "\n", "newline": "\n", "ss": "ß", "ae": "æ", "oe": "œ", "textemdash": "—", "textendash": "–"}
_HEADS = {"part": 1, "chapter": 1, "title": 1, "section": 2, "subsection": 3, "subsubsection": 4, "paragraph": 5, "subparagraph": 6}
_DROPPED = frozenset("label ref pageref eqref cite citep citet index includegraphics usepackage documentclass hspace vspace input include".split())
_CODE = frozenset("verbatim lstlisting minted alltt".split())
_BREAKS = frozenset("p div blockquote ul ol dl table thead tbody tfoot section article header footer nav main figure center caption figcaption hr br".split())


def _closing(text: str, at: int) -> int:
    """Place of the brace that closes the one at `at`; -1 if it is cut off."""
    depth = 0
    for i in range(at, len(text)):
        if text[i] == "{" and text[i - 1 : i] != "\\":
            depth += 1
        elif text[i] == "}" and text[i - 1 : i] != "\\":
            depth -= 1
            if not depth:
                return i
    return -1


def _stop(text: str, at: int, pattern: str, before: str | None = None) -> int:
    """End of the next match of a pattern; without one (or with `before` in front of it) the given place, so nothing is kept."""
    m = re.compile(pattern).search(text, at)
    if not m or before and before in text[at : m.start()]:
        return at
    return m.end()


def _tag(m: Mark, got: str, state: dict) -> str:
    name = re.match(r"</?([A-Za-z0-9]+)", got)[1].lower()
    end = got[1] == "/"
    if re.fullmatch(r"h[1-6]", name):
        return "\n" if end else "\n" + "#" * int(name[1]) + " "
    if name == "pre":
        state["pre"] = not end
        return "\n```\n"
    if name in ("code", "tt", "kbd", "samp"):
        return "" if state.get("pre") else "`"
    if name in ("li", "dd", "dt"):
        return "" if end else {"li": "\n- ", "dd": "\n  ", "dt": "\n"}[name]
    if name in ("tr", "td", "th", "table"):
        open_cell, state["cell"] = state.get("cell"), name in ("td", "th") and not end
        shut = " |" if open_cell else ""  # cells and rows may lack their end tags
        if name in ("td", "th"):
            return shut if end else shut + " "
        return shut + ("\n" if name == "table" else "" if end else "\n|")
    if name == "img":
        alt = re.search(r"alt\s*=\s*[\"']([^\"']*)", got)
        return f"[{alt[1]}]" if alt and alt[1] else ""
    return "\n" if name in _BREAKS else ""


def clean(text: str | None) -> str | None:
    """Clean text: headings as #, lists as -, tables as | rows |, code in ticks and formulas in TeX stay; other markup goes. Null stays null."""
    if not text:
        return text
    cuts: list[tuple[int, int, str]] = []
    state: dict = {}
    kept = 0  # formulas stay as they are up to here
    for m, yes in labelled(text):
        if not yes or m.start < kept:
            continue
        got, new = text[m.start : m.end], None
        kind = m.kind
        if state.get("pre") and m.language:  # code: only tags and entities of HTML are markup in it
            continue
        if kind == "fence":
            kept = _stop(text, m.end, r"(?m)^[ ]{0,3}" + re.escape(got.lstrip()[:3]) + r"[`~]*[ ]*$")
            continue
        if kind == "tick":
            kept = _stop(text, m.end, "(?<!`)" + got + "(?!`)", "\n\n")
            continue
        if kind in ("tag", "cuttag"):
            new = _tag(m, got, state)
        elif kind in ("comment", "definition", "note", "rule", "quotes", "magic", "emphasis", "quote", "wikitable"):
            new = ""
        elif kind == "entity":
            new = html.unescape(got)
        elif kind == "underline":
            new = ""
            line = text.rfind("\n", 0, max(0, m.start - 1)) + 1
            cuts.append((line, line, "# " if "=" in got else "## "))
        elif kind == "link" or kind == "reference":
            new = got[got.find("[") + 1 : got.find("]")] if "]" in got else ""
        elif kind == "task":
            new = "- "
        elif kind == "wikilink":
            inner = got.strip("[]")
            new = "" if re.match(r"(?i)(?:categoria|category|catégorie|file|immagine|image):", inner) else inner.rpartition("|")[2] if got.startswith("[[") else inner.partition(" ")[2]
        elif kind == "template":
            name, _, rest = got.strip("{}").partition("|")
            new = "; ".join(p.replace("=", ": ", 1) for p in rest.split("|")) if rest else ""
            if re.search(r"(?:^|\|)\s*\w+\s*=", rest):  # a record, not a format: its name says what it is
                new = f"{name.strip()}: {new}"
        elif kind == "wikicell":
            stop = text.find("\n", m.start)
            stop = len(text) if stop < 0 else stop
            body = text[m.end : stop]
            cuts.append((m.start, m.end, "|"))
            for x in re.finditer(r"\|\||!!", body):
                cuts.append((m.end + x.start(), m.end + x.end(), "|"))
            cuts.append((stop, stop, " |"))
            continue
        elif kind == "wikiheading":
            level = len(got) - len(got.lstrip("="))
            new = "#" * level + " " + got.strip("= \n")
        elif kind == "environment":
            name = got.partition("{")[2].rstrip("}")
            base = name.rstrip("*")
            if base in _CODE:
                new = "\n```\n"
                if got.startswith("\\begin"):
                    at = text.find("\\end{" + name, m.end)
                    kept = at if at > 0 else len(text)
            elif base in ("equation", "align", "displaymath", "math", "eqnarray", "gather"):
                new = "\n$$\n"
                if got.startswith("\\begin"):
                    at = text.find("\\end{" + name, m.end)
                    kept = at if at > 0 else len(text)
            else:
                new = ""
                if got.startswith("\\begin") and text[m.end : m.end + 1] in ("{", "["):
                    close = text.find("}" if text[m.end] == "{" else "]", m.end)
                    cuts.append((m.start, close + 1 if close > 0 else m.end, ""))
                    continue
        elif kind == "command":
            name = got[1:].rstrip("*")
            brace = _closing(text, m.end) if text[m.end : m.end + 1] == "{" else -1
            if name in _DROPPED:
                cuts.append((m.start, brace + 1 if brace > 0 else m.end, ""))
                kept = max(kept, brace + 1)
                continue
            new = "#" * _HEADS[name] + " " if name in _HEADS else _SAYS.get(name, "")
            if name == "footnote":
                new = " ("
                cuts.append((brace, brace + 1, ")")) if brace > 0 else None
            elif brace > 0:
                cuts.append((brace, brace + 1, ""))
            if text[m.end : m.end + 1] == "{":
                cuts.append((m.end, m.end + 1, ""))
            if text[m.start - 1 : m.start] == "{" and brace < 0:  # a group such as {\\em x}
                close = _closing(text, m.start - 1)
                cuts.append((m.start - 1, m.start, ""))
                if close > 0:
                    cuts.append((close, close + 1, ""))
                if text[m.end : m.end + 1] == " ":
                    cuts.append((m.end, m.end + 1, ""))
        elif kind == "delimmath" and got in ("\\(", "\\["):
            at = text.find("\\)" if got == "\\(" else "\\]", m.end)
            kept = at + 2 if at > 0 else len(text)
            continue
        elif kind == "break":
            new = "\n"
        elif kind == "symbol":
            new = " " if got[1] in ",;:!" else got[1]
        elif kind == "accent":
            letter = re.sub(r"[\\{}\s]", "", got[2:])
            new = unicodedata.normalize("NFC", letter + _ACCENTS.get(got[1], ""))
        elif kind == "texquotes":
            new = "“" + got[2:-2] + "”"
        if new is not None:
            end = m.end
            if new == "" and text[end : end + 1] == "\n" and (m.start == 0 or text[m.start - 1] == "\n"):
                end += 1  # a line of markup alone goes with its end
            cuts.append((m.start, end, new))
    if not cuts:
        return text
    out, at = [], 0
    for s, e, new in sorted(cuts, key=lambda c: (c[0], c[1])):
        if s < at:
            continue
        out += (text[at:s], new)
        at = max(at, e)
    out.append(text[at:])
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+(?=\n)", "", "".join(out))).strip()


def found(blocks: DataFrame, key: str = "blocco_id", column: str = "block_content") -> DataFrame:
    """(key, tipo): each language of which a block holds markup, once. Null and empty contents and null keys have none; repeated rows count once."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = [languages(t) for t in b.column(1).to_pylist()]
            rows = np.repeat(np.arange(len(names)), [len(n) for n in names])
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), pa.array([x for n in names for x in n], pa.string())], [key, "tipo"])

    chosen = blocks.select(key, column).where(F.col(key).isNotNull() & F.col(column).rlike(PREFILTER))
    return chosen.mapInArrow(read, f"{key} {dict(blocks.dtypes)[key]}, tipo string").distinct()


#: Ids that come again and are sent to all tasks at once (below 16 MB); beyond, whole rows meet in a shuffle.
REPEATS_AT_ONCE = 1_000_000


def once(blocks: DataFrame, key: str = "blocco_id") -> DataFrame:
    """blocks with each key once; rows without a key stay. Keys are counted first, so only rows that come again are shuffled."""
    again = written(blocks.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where((F.col("_n") > 1) & F.col(key).isNotNull()).select(key), "ripetuti")
    if again.count() > REPEATS_AT_ONCE:
        return blocks.where(F.col(key).isNotNull()).dropDuplicates([key]).unionByName(blocks.where(F.col(key).isNull()))
    shared = F.broadcast(again)
    return blocks.join(shared, key, "left_anti").select(*blocks.columns).unionByName(blocks.join(shared, key, "left_semi").select(*blocks.columns).dropDuplicates([key]))


def cleaned(blocks: DataFrame, key: str = "blocco_id", column: str = "block_content") -> DataFrame:
    """(key, testo): the clean text of each row, repeated rows kept; null stays null and texts without signs pass unchanged."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signs = re.compile(PREFILTER)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([clean(t) if t and signs.search(t) else t for t in b.column(1).to_pylist()], pa.string())], [key, "testo"])

    return blocks.select(key, column).mapInArrow(read, f"{key} {dict(blocks.dtypes)[key]}, testo string")
