"""Order-dependent folds per text or key: packing, windows, chunks, throttles. Each group is one file or key; a book's files spread over tasks."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def word_count(text: str) -> int:
    """The default token counter: white-space words. Any callable text -> int may replace it."""
    return len(text.split())


# ---- texts to pieces, one text at a time ----


def paragraphs(text: str) -> list[tuple[int, int, str]]:
    """(first line, last line, text) of runs of non-blank lines, 1-based."""
    out, start, lines = [], None, text.split("\n")
    for n, line in enumerate(lines + [""], 1):
        if line.strip():
            start = start or n
        elif start:
            out.append((start, n - 1, "\n".join(lines[start - 1 : n - 1])))
            start = None
    return out


def split_table(text: str, limit: int, count: Callable[[str], int] = word_count) -> list[str]:
    """A block with a long HTML table as several, each table with the head row; the text around stays around."""
    m = re.search(r"(<table[^>]*>)(.*?)</table>", text, re.S | re.I)
    rows = re.findall(r"<tr[^>]*>.*?</tr>", m[2], re.S | re.I) if m else []
    if not m or len(rows) < 3 or count(text) <= limit:
        return [text]
    pieces, open_, head = [], m[1], rows[0]
    part: list[str] = []
    for row in rows[1:]:
        if part and count(open_ + head + "".join(part) + row + "</table>") > limit:
            pieces.append(open_ + head + "".join(part) + "</table>")
            part = []
        part.append(row)
    pieces.append(open_ + head + "".join(part) + "</table>")
    before, after = text[: m.start()].strip(), text[m.end() :].strip()
    return [*([before] if before else []), *pieces, *(split_table(after, limit, count) if after else [])]


def pack(blocks: list[tuple[int, int, str]], limit: int = 400, heading_after: int = 150, count: Callable[[str], int] = word_count) -> list[tuple[int, int, int]]:
    """(first line, last line, tokens) of units: blocks in turn while they fit, each with one token more; the first
    always, none from a heading on once `heading_after` is reached."""
    units: list[tuple[int, int, int]] = []
    first = last = tokens = 0
    opened = False
    for a, z, text in blocks:
        n = count(text)
        if opened and (tokens + n > limit or (text.lstrip().startswith("#") and tokens >= heading_after)):
            units.append((first, last, tokens))
            opened = False
        if not opened:
            first, tokens, opened = a, 0, True
        last, tokens = z, tokens + n + 1
    if opened:
        units.append((first, last, tokens))
    return units


def chunk(text: str, limit: int = 1500) -> list[str]:
    """Pieces of at most `limit` characters, cut at a heading, paragraph, sentence, comma or hard; trimmed, none lost."""
    marks = (("\n#", 0.5, 0), ("\n\n", 0.3, 0), (". ", 0.3, 1), (", ", 0.3, 1))
    out, at, text = [], 0, text.strip()
    while at < len(text):
        end = len(text)
        if end - at > limit:
            end = at + limit
            for sign, part, extra in marks:
                k = text.rfind(sign, at, at + limit)
                if k - at > limit * part:
                    end = k + extra
                    break
        piece = text[at:end].strip()
        if piece:
            out.append(piece)
        at = end
        while at < len(text) and text[at].isspace():
            at += 1
    return out


def split_by_size(text: str, limit: int = 100 * 1024) -> list[tuple[str, str]]:
    """(title, text) of pieces that begin at # or ##; a piece beyond `limit` bytes is cut at the next level, down to
    level 6. What comes before a first sub-heading keeps its parent's title. limit 0 cuts nothing further."""

    def heads(lines: list[str], levels: tuple[int, ...]) -> list[tuple[int, int, str]]:
        found = ((i, re.match(r"(#{1,6})\s+(.+)$", x)) for i, x in enumerate(lines))
        return [(i, len(m[1]), m[2].strip()) for i, m in found if m and len(m[1]) in levels]

    out: list[tuple[str, str]] = []
    lines = text.split("\n")
    tops = heads(lines, (1, 2))
    todo = [(lines[i : (tops[k + 1][0] if k + 1 < len(tops) else len(lines))], lvl, title) for k, (i, lvl, title) in enumerate(tops)]
    if tops and tops[0][0] and "\n".join(lines[: tops[0][0]]).strip():
        out.append(("", "\n".join(lines[: tops[0][0]]).strip()))
    stack = todo[::-1]
    while stack:
        part, level, title = stack.pop()
        body = "\n".join(part).strip()
        if limit <= 0 or level >= 6 or len(body.encode()) <= limit:
            if body:
                out.append((title, body))
            continue
        subs = heads(part, (level + 1,))
        if not subs:
            stack.append((part, level + 1, title))
            continue
        pieces = [(part[: subs[0][0]], level + 1, title)] if subs[0][0] else []
        pieces += [(part[i : (subs[k + 1][0] if k + 1 < len(subs) else len(part))], level + 1, name) for k, (i, _, name) in enumerate(subs)]
        stack.extend(pieces[::-1])
    return out


def windows(blocks: list[tuple[int, int, str]], limit: int = 1800, tail: int = 120, count: Callable[[str], int] = word_count, card: Callable[[list[str]], bool] | None = None) -> list[tuple[int, int, int, str]]:
    """(first line, last line, tokens, text) of extraction windows.

    Blocks are taken in turn. On overflow the window is cut at its last inner heading, or a heading at its end goes
    along to the next. A tail below `tail` tokens joins the window before if that stays within 1.3 of the limit. With
    `card`, a window begins at each heading for which card(this and the next three texts) holds, and tails stay.
    """
    sized = [(b, count(b[2]) + 1) for b in blocks]
    done: list[list] = []
    now: list = []

    def heading(item) -> bool:
        return item[0][2].lstrip().startswith("#")

    for k, item in enumerate(sized):
        if now and card and heading(item) and card([b[2] for b, _ in sized[k : k + 4]]):
            done.append(now)
            now = []
        elif now and sum(n for _, n in now) + item[1] > limit:
            inner = [i for i in range(1, len(now)) if heading(now[i])]
            at = inner[-1] if inner else len(now)
            done.append(now[:at])
            now = now[at:]
        now = [*now, item]
    if now:
        done.append(now)
    merged: list[list] = []
    for w in done:
        n = sum(x for _, x in w)
        if merged and not card and n < tail and sum(x for _, x in merged[-1]) + n <= 1.3 * limit:
            merged[-1] = merged[-1] + w
        else:
            merged.append(w)
    return [(w[0][0][0], w[-1][0][1], sum(n for _, n in w), "\n\n".join(b[2] for b, _ in w)) for w in merged]


def hard_pieces(text: str, tokens: int, per_token: float = 4.0, slack: float = 1.5) -> list[str]:
    """Pieces of about `tokens` tokens by a ratio of characters; the last may be longer by `slack`."""
    size = max(1, int(tokens * per_token))
    out = []
    while len(text) > size * slack:
        out.append(text[:size])
        text = text[size:]
    return [*out, text] if text or not out else out


def balanced(parts: list[str], limit: int) -> list[list[str]]:
    """Parts on as few cards as a greedy count needs, then evenly by characters, in order."""
    cards, used = 1, 0
    for p in parts:
        if used and used + len(p) > limit:
            cards, used = cards + 1, 0
        used += len(p)
    goal = sum(map(len, parts)) / cards
    out: list[list[str]] = [[]]
    used = 0
    for k, p in enumerate(parts):
        left = len(parts) - k
        if out[-1] and len(out) < cards and (used + len(p) / 2 > goal or left < cards - len(out) + 1):
            out.append([])
            used = 0
        out[-1].append(p)
        used += len(p)
    return out


# ---- the same over tables ----


def per_text(docs: DataFrame, key: str, text: str, fold: Callable[[str], list[tuple]], names: list[tuple[str, pa.DataType, str]]) -> DataFrame:
    """A 1-to-n fold of each text by Arrow batches: (key, n, the fold's columns); null texts give no row."""
    kinds = dict(docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, ns, cols = [], [], [[] for _ in names]
            for i, t in enumerate(b.column(1).to_pylist()):
                for n, values in enumerate(fold(t) if t is not None else ()):
                    rows.append(i)
                    ns.append(n)
                    for c, v in zip(cols, values):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows, pa.int64())), pa.array(ns, pa.int64()), *[pa.array(c, t) for c, (_, t, _) in zip(cols, names)]], [key, "n", *[n for n, _, _ in names]])

    return docs.select(key, text).mapInArrow(run, f"{key} {kinds[key]}, n bigint, " + ", ".join(f"{n} {s}" for n, _, s in names))


def units(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = 400, table_limit: int = 500) -> DataFrame:
    """(key, n, inizio, fine, tok): packed units of each file; long tables are split first."""
    def fold(t: str) -> list[tuple]:
        return pack([(a, z, p) for a, z, b in paragraphs(t) for p in split_table(b, table_limit)], limit)

    return per_text(docs, key, text, fold, [("inizio", pa.int64(), "bigint"), ("fine", pa.int64(), "bigint"), ("tok", pa.int64(), "bigint")])


def chunks(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = 1500) -> DataFrame:
    return per_text(docs, key, text, lambda t: [(c,) for c in chunk(t, limit)], [("testo", pa.string(), "string")])


def sized_chapters(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = 100 * 1024) -> DataFrame:
    return per_text(docs, key, text, lambda t: split_by_size(t, limit), [("titolo", pa.string(), "string"), ("testo", pa.string(), "string")])


def extraction_windows(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = 1800) -> DataFrame:
    return per_text(docs, key, text, lambda t: windows(paragraphs(t), limit), [("inizio", pa.int64(), "bigint"), ("fine", pa.int64(), "bigint"), ("tok", pa.int64(), "bigint"), ("testo", pa.string(), "string")])


def accepted(events: DataFrame, key: str, at: str, seconds: int) -> DataFrame:
    """Events at least `seconds` after the last accepted one of their key: an ordered fold, not a look at the row before.

    Only times are folded, one array per (key, day) chained by the last accepted time of the day before would change
    nothing but memory; times of a key are 8 bytes each and come sorted.
    """
    kind = dict(events.dtypes)[key]

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        keep, last = [], None
        for t in pdf["_t"].to_numpy():
            ok = last is None or t - last >= seconds
            keep.append(ok)
            last = t if ok else last
        return pdf.loc[keep, [key, "_t"]]

    times = events.select(key, F.unix_timestamp(F.col(at).cast("timestamp")).alias("_t")).dropna().distinct().withColumn("_o", F.col("_t"))
    return times.groupBy(key).applyInPandas(lambda p: fold(p.sort_values("_o")), f"{key} {kind}, _t bigint").withColumnRenamed("_t", "istante")


def bands(rows: DataFrame, keys: list[str], y: str, tolerance: float = 4.0) -> DataFrame:
    """rows with `banda`: rows of a page in order of y belong together while they stay within `tolerance` of the band's first."""
    schema = T.StructType([*rows.schema.fields, T.StructField("banda", T.IntegerType())])

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(y)
        out, band, anchor = [], -1, None
        for v in pdf[y]:
            if anchor is None or v - anchor >= tolerance:
                band, anchor = band + 1, v
            out.append(band)
        return pdf.assign(banda=out)

    return rows.groupBy(*keys).applyInPandas(fold, schema)


def demoted_repeats(titles: DataFrame, book: str, page: str, order: list[str], title: str, level: str, reach: int = 6) -> DataFrame:
    """titles with `livello_nuovo`: a title of level 1 or 2 that repeats one of the last `reach` pages goes below it.

    Texts are compared by letters and digits; keys below 4 characters take no part, and pages 1 to 3 are no models. Of
    the earlier titles the first one that is still of level 1 or 2 is the model; a title already deeper stays. Groups
    are the titles of a book with one key, so a book's titles spread over tasks.
    """
    schema = T.StructType([*titles.schema.fields, T.StructField("livello_nuovo", T.IntegerType())])

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([page, *order])
        out: list[int] = []
        pages = pdf[page].tolist()
        short = len(pdf["_k"].iloc[0] or "") < 4
        for i, (p, lv) in enumerate(zip(pages, pdf[level])):
            new = int(lv)
            if new <= 2 and not short:
                model = next((out[j] for j in range(i) if pages[j] > 3 and p - pages[j] <= reach and out[j] <= 2), None)
                if model is not None and new <= model:
                    new = min(5, model + 1)
            out.append(new)
        return pdf.drop(columns="_k").assign(livello_nuovo=out)

    return titles.withColumn("_k", F.regexp_replace(F.lower(title), r"[^\p{L}\p{N}]+", "")).groupBy(book, "_k").applyInPandas(fold, schema)


def reading_order(blocks: list[tuple[float, float, float, float]], gap_y: float = 6.0, gap_x: float = 8.0) -> list[int]:
    """Indices of boxes in reading order by recursive cuts: rows at gaps above gap_y, then columns at gutters of gap_x."""
    def cut(items: list[int], axis: int, gap: float) -> list[list[int]]:
        items = sorted(items, key=lambda i: (blocks[i][axis], i))
        parts, far = [[items[0]]], blocks[items[0]][axis + 2]
        for i in items[1:]:
            if blocks[i][axis] - far >= gap:
                parts.append([])
            parts[-1].append(i)
            far = max(far, blocks[i][axis + 2])
        return parts

    out: list[int] = []
    stack = [list(range(len(blocks)))] if blocks else []
    while stack:
        items = stack.pop()
        if len(items) == 1:
            out += items
            continue
        for axis, gap in ((1, gap_y), (0, gap_x)):
            parts = cut(items, axis, gap)
            if len(parts) > 1:
                stack.extend(parts[::-1])
                break
        else:
            out += sorted(items, key=lambda i: (blocks[i][1], blocks[i][0]))
    return out


def monotone_alignment(outline: list[tuple[str, int]], lines: list[tuple[str, int]], score: Callable[[str, str], float], least: float = 0.85, reach: int = 3) -> list[int | None]:
    """Of each outline entry (title, page) the line it names: pages within 1, then up to `reach`; the cursor never goes back."""
    out: list[int | None] = []
    cursor = 0
    for title, page in outline:
        hit = None
        for margin in range(1, reach + 1):
            hit = next((i for i in range(cursor, len(lines)) if abs(lines[i][1] - page) <= margin and score(title, lines[i][0]) >= least), None)
            if hit is not None:
                cursor = hit
                break
        out.append(hit)
    return out
