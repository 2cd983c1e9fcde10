"""Fields that hold several values: one row per value with its place."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.functions import attributes as A
from scriptorium.operators.eav import by_entity, once

# fixed values: signs and words that separate values, and the quotes whose content stays together
SEPARATORS = r"[,;/|•·\t\n\r]|(?<=\s)e(?=\s)"
QUOTES = {'"': '"', "«": "»", "“": "”"}
_OPEN, _CLOSE = "\uE000", "\uE001"
_BLANK = r"^[\s\u00A0]+|[\s\u00A0]+$"
_SIGNS = re.compile('["«“()\uE000\uE001]')


def spans_of(text: str) -> list[tuple[int, int]]:
    """Places of what stays together, in order: quoted texts (a doubled quote goes on), whole brackets of any depth, and signs used in placeholders.

    One pass over the signs; a quote or bracket that isn't closed is an ordinary sign.
    """
    signs = [m.start() for m in _SIGNS.finditer(text)]
    partner: dict[int, int] = {}
    opened: list[int] = []
    for i in signs:
        if text[i] == "(":
            opened.append(i)
        elif text[i] == ")" and opened:
            partner[opened.pop()] = i
    out: list[tuple[int, int]] = []
    at = 0
    for i in signs:
        if i < at:
            continue
        sign = text[i]
        if sign in QUOTES:
            end = text.find(QUOTES[sign], i + 1)
        elif sign == "(":
            end = partner.get(i, -1)
        else:
            end = -1 if sign == ")" else i
        if end >= 0:
            out.append((i, end + 1))
            at = end + 1
    return out


def masked(text: str) -> tuple[str, list[str]]:
    """The text with each span replaced by its number between two signs, and the spans."""
    out, spans, at = [], [], 0
    for k, (a, z) in enumerate(spans_of(text)):
        out += (text[at:a], f"{_OPEN}{k}{_CLOSE}")
        spans.append(text[a:z])
        at = z
    return "".join(out) + text[at:], spans


def _masks(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([(None, None) if t is None else masked(t) for t in texts], columns=["testo", "parti"])


def split_values(text: Column, spans: Column | None = None) -> Column:
    """Array of the values in a masked text; without spans the text is masked first.

    Placeholders number the spans, and the signs that make up a placeholder count as spans too, so no text can collide
    with one. The text is split at separators and the spans are looked up again.
    """

    if spans is None:
        both = F.pandas_udf(_masks, "testo string, parti array<string>")(text)
        return F.element_at(F.transform(F.array(both), lambda b: split_values(b["testo"], b["parti"])), 1)

    def restore(piece: Column) -> Column:
        parts = F.split(piece, _OPEN, -1)
        back = F.transform(parts, lambda p, j: F.when(j == 0, p).otherwise(F.concat(F.element_at(spans, F.substring_index(p, _CLOSE, 1).cast("int") + 1), F.substring_index(p, _CLOSE, -1))))
        whole = F.array_join(back, "")
        bare = F.substring(whole, F.lit(2), F.length(whole) - 2)
        alone = F.startswith(piece, F.lit(_OPEN)) & (F.regexp_replace(piece, f"{_OPEN}\\d+{_CLOSE}", "") == "") & (F.length(whole) >= 2)
        # spans that touch are one text with doubled quotes
        doubled = F.startswith(whole, F.lit('"')) & F.endswith(whole, F.lit('"')) & ~F.contains(F.replace(bare, F.lit('""'), F.lit("")), F.lit('"'))
        single = (F.size(parts) == 2) & ((F.startswith(whole, F.lit("«")) & F.endswith(whole, F.lit("»"))) | (F.startswith(whole, F.lit("“")) & F.endswith(whole, F.lit("”"))))
        return F.when(alone & (doubled | single), F.regexp_replace(F.replace(bare, F.lit('""'), F.lit('"')), _BLANK, "")).otherwise(whole)

    pieces = F.transform(F.split(text, SEPARATORS, -1), lambda p: F.regexp_replace(p, _BLANK, ""))
    return F.filter(F.transform(pieces, restore), lambda v: v != "")


def field_entries(df: DataFrame, names: tuple[str, ...], key: str = "id", data: str = "dati") -> DataFrame:
    """(key, campo, testo, parti, elenco): the last entry of each named attribute, as a masked text and its spans or as a JSON list."""
    wanted = frozenset(names)
    schema = pa.schema([(key, pa.int64()), ("campo", pa.string()), ("testo", pa.string()), ("parti", pa.list_(pa.string())), ("elenco", pa.list_(pa.string()))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in once(batches):
            ids, fields, texts, parts, lists = [], [], [], [], []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for name, value in {k: v for k, v in A.pairs(text) or () if k in wanted}.items():
                    if value is None:
                        continue
                    ids.append(i)
                    fields.append(name)
                    if isinstance(value, list):
                        lists.append([x if isinstance(x, str) else json.dumps(x, ensure_ascii=False) for x in value if x is not None])
                        texts.append(None)
                        parts.append(None)
                    else:
                        lists.append(None)
                        text, spans = masked(value if isinstance(value, str) else json.dumps(value, ensure_ascii=False))
                        texts.append(text)
                        parts.append(spans)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((ids, fields, texts, parts, lists), schema.types)], schema=schema)

    return by_entity(df, key, [data], [data]).mapInArrow(read, f"{key} bigint, campo string, testo string, parti array<string>, elenco array<string>")


def exploded(entries: DataFrame, key: str = "id") -> DataFrame:
    """One row per value: key, campo, posizione from 1, valore. Nothing for blank fields and for a lone dash; empty pieces aren't numbered, list elements stay as they are."""
    text = F.regexp_replace("testo", _BLANK, "")
    values = F.when(F.col("elenco").isNotNull(), F.filter("elenco", lambda v: F.trim(v) != "")).when(~text.isin("", "-", "–", "—"), split_values(text, F.col("parti")))
    return entries.select(key, "campo", F.posexplode(values).alias("_p", "valore")).select(key, "campo", (F.col("_p") + 1).alias("posizione"), "valore")
