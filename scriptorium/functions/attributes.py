"""Reading attribute-value pairs from JSON texts of several layouts, and typed readings of their values."""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

# fixed values: placeholders that stand for "no value"
PLACEHOLDERS = {"", "-", "–", "—", "?", "n.d.", "nd", "n/d", "varia", "vedi testo", "null", "none"}
# fixed values: units of cost in copper, of weight in kilograms
COIN = {"mo": 100, "ma": 10, "mr": 1}
WEIGHT = {"kg": 1.0, "chilogrammi": 1.0, "chilogrammo": 1.0, "chili": 1.0, "g": 0.001, "gr": 0.001, "grammi": 0.001, "grammo": 0.001}


@lru_cache(65536)
def canonical(name: str) -> str:
    """Attribute name in one spelling: no note in brackets, no accents, snake case."""
    name = re.sub(r"(?<=[a-zà-ü])(?=[A-Z])", "_", re.sub(r"\(.*", "", name.strip(), flags=re.S))
    name = "".join(c for c in unicodedata.normalize("NFD", name) if not unicodedata.combining(c)).lower()
    return re.sub(r"[^a-z0-9]+", "_", name).strip("_")


class _Object(list):
    """Pairs of a JSON object in their order, repeated names kept."""


def pairs(text: str | None) -> list[tuple[str, object]] | None:
    """Attribute-value pairs in order; None if the text is no JSON. Layouts: an object, a list of {attributo, valore}, a list of [name, value]."""
    if text is None:
        return None
    try:
        doc = json.loads(text, object_pairs_hook=_Object)
    except (ValueError, RecursionError):
        return None
    if isinstance(doc, _Object):
        return [(canonical(k), v) for k, v in doc]
    out: list[tuple[str, object]] = []
    for item in doc if isinstance(doc, list) else []:
        if isinstance(item, _Object):
            fields = dict(item)
            if isinstance(fields.get("attributo"), str):
                out.append((canonical(fields["attributo"]), fields.get("valore")))
            else:
                out.extend((canonical(k), v) for k, v in item)
        elif isinstance(item, list) and len(item) == 2 and isinstance(item[0], str):
            out.append((canonical(item[0]), item[1]))
    return out


_NUMBER = r"\d+(?:\.\d{3})+(?:,\d+)?|\d+(?:[.,]\d+)?"


def _text(v: object) -> str | None:
    if v is None or isinstance(v, (list, bool)):
        return None
    t = " ".join(str(v).split())
    return None if t.lower() in PLACEHOLDERS else t


def _float(t: str, thousands: bool = False) -> float:
    if thousands and re.fullmatch(r"\d{1,3}(?:\.\d{3})+(?:,\d+)?", t):
        t = t.replace(".", "")
    return float(t.replace(",", "."))


def whole(v: object) -> int | None:
    """Whole number in a text without dice; None if there is none or it has a fraction."""
    if isinstance(v, float):
        return int(v) if v == int(v) else None
    t = _text(v)
    if t is None:
        return None
    t = re.sub(r"\(.*?\)|\d*d\d+(?:\s*[+-]\s*\d+)?", " ", t)
    m = re.search(_NUMBER, t)
    if not m:
        return None
    x = _float(m[0], True)
    return int(x) if x == int(x) else None


def level(v: object) -> int | None:
    t = _text(v)
    return 0 if t and "trucchetto" in t.lower() else whole(v)


def die(v: object) -> int | None:
    """Faces of a hit die."""
    t = _text(v)
    if t is None:
        return None
    m = re.search(r"d\s*(\d+)", t.lower()) or re.fullmatch(r"(\d+)(?:\.0+)?", t)
    return int(m[1]) if m else None


def metres(v: object) -> float | None:
    t = _text(v)
    m = t and re.search(_NUMBER, t)
    return _float(m[0]) if m else None


def kilograms(v: object) -> float | None:
    t = _text(v)
    m = t and re.search(_NUMBER, t)
    if not m:
        return None
    unit = re.search(r"(?<![a-z])(kg|chilogramm[io]|chili|gramm[io]|gr?)(?![a-z])", t.lower())
    factor = WEIGHT[unit[1]] if unit else 1.0
    return _float(m[0], factor != 1.0) * factor


def copper(v: object) -> float | None:
    """Cost in copper coins; several coins add up. Without a coin it is unreadable."""
    t = _text(v)
    if t is None:
        return None
    t = re.sub(r"monet[ae]\s+d'\s*oro", "mo", re.sub(r"monet[ae]\s+d'\s*argento", "ma", re.sub(r"monet[ae]\s+di\s+rame", "mr", t.lower().replace("’", "'"))))
    parts = [(n, u) for n, u in re.findall(rf"({_NUMBER})\s*(m[oar])(?![a-z])", t)] or [(n, u) for u, n in re.findall(rf"(?<![a-z])(m[oar])\s*({_NUMBER})", t)]
    return sum(_float(n, True) * COIN[u] for n, u in parts) if parts else None


def attuned(v: object) -> bool | None:
    if isinstance(v, bool):
        return v
    t = _text(v)
    if t is None:
        return None
    t = t.lower()
    if re.match(r"(?:no|non|false|falso)\b", t):
        return False
    return True if re.match(r"(?:s[iìí]|true|vero|richie\w+)(?!\w)", t) else None


def lowered(v: object) -> str | None:
    t = _text(v)
    return t.lower() if t else None


def plain(v: object) -> str | None:
    return v.strip() if isinstance(v, str) else None if v is None else json.dumps(v, ensure_ascii=False)


#: attribute -> (Arrow type name, reading); the typed columns of the wide table
TYPED = {
    "livello": ("int64", level),
    "dado_vita": ("int64", die),
    "velocita": ("double", metres),
    "punti_ferita": ("int64", whole),
    "peso": ("double", kilograms),
    "costo": ("double", copper),
    "sintonizzazione": ("bool", attuned),
    "scuola": ("string", lowered),
    "taglia": ("string", lowered),
    "rarita": ("string", lowered),
}
