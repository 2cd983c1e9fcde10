"""Sinks: replaced partitions, guarded drafts, JSON reports, purges, packages."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def replace_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Write partitions anew; those that df doesn't have stay. Commits when all files are there."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def guarded_drafts(new: DataFrame, old: DataFrame, key: str, text: str = "testo", mark: str = "impronta") -> DataFrame:
    """(key, testo, impronta, dove): drafts to write. A stored draft whose text no longer has its stored hash was edited by hand: the new one goes to `auto`, the edited one stays."""
    o = old.select(key, F.col(text).alias("_t"), F.col(mark).alias("_m"))
    both = new.select(key, text).join(o, key, "left").withColumn(mark, F.sha2(F.col(text), 256))
    edited = F.col("_t").isNotNull() & (F.sha2("_t", 256) != F.col("_m"))
    return both.select(key, text, mark, F.when(edited, "auto").otherwise("bozza").alias("dove"))


def json_report(df: DataFrame, path: str) -> None:
    """One JSON file per partition, visible only when complete."""
    df.write.mode("overwrite").json(path)


def purged(log: DataFrame, at: str, now: str, days: int) -> DataFrame:
    """Rows younger than `days`."""
    return log.where(F.col(at) >= F.lit(now).cast("timestamp") - F.make_dt_interval(F.lit(days)))


def report_rows(df: DataFrame, order: list[str], most: int = 300) -> DataFrame:
    """The first rows of a report by order."""
    return df.orderBy(*order).limit(most)


def grouped_sections(chapters: DataFrame, book: str, order: str, level: str, text: str, limit: int = 80 * 1024) -> DataFrame:
    """chapters with `sezione`: a new one at level 1 or when the next chapter would pass the size."""
    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        out, section, size = [], 0, 0
        for lv, t in zip(pdf[level], pdf[text]):
            n = len((t or "").encode())
            if section == 0 or lv == 1 or size + n > limit:
                section, size = section + 1, 0
            size += n
            out.append(section)
        return pdf.assign(sezione=out)

    kinds = ", ".join(f"`{c}` {t}" for c, t in chapters.dtypes)
    return chapters.groupBy(book).applyInPandas(fold, kinds + ", sezione int")


def packages(sections: DataFrame, book: str, order: str, title: str, body: str) -> DataFrame:
    """(book, epub BINARY, file INT): an EPUB package of each book's XHTML bodies; the mimetype comes first and uncompressed."""
    kind = dict(sections.dtypes)[book]

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        out = io.BytesIO()
        items = [(f"s{i:04d}.xhtml", t, b) for i, (t, b) in enumerate(zip(pdf[title], pdf[body]), 1)]
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr(zipfile.ZipInfo("mimetype"), "application/epub+zip")
            z.writestr("META-INF/container.xml", '<?xml version="1.0"?><container version="1.0" xmlns="urn:oasis:names:tc:opendocument:xmlns:container"><rootfiles><rootfile full-path="content.opf" media-type="application/oebps-package+xml"/></rootfiles></container>')
            manifest = "".join(f'<item id="i{i}" href="{n}" media-type="application/xhtml+xml"/>' for i, (n, _, _) in enumerate(items))
            spine = "".join(f'<itemref idref="i{i}"/>' for i in range(len(items)))
            z.writestr("content.opf", f'<?xml version="1.0"?><package xmlns="http://www.idpf.org/2007/opf" version="3.0"><manifest><item id="nav" href="nav.xhtml" media-type="application/xhtml+xml" properties="nav"/>{manifest}</manifest><spine>{spine}</spine></package>')
            links = "".join(f'<li><a href="{n}">{t}</a></li>' for n, t, _ in items)
            z.writestr("nav.xhtml", f'<html xmlns="http://www.w3.org/1999/xhtml"><body><nav><ol>{links}</ol></nav></body></html>')
            for n, t, b in items:
                z.writestr(n, f'<html xmlns="http://www.w3.org/1999/xhtml"><head><title>{t}</title></head><body>{b}</body></html>')
        return pd.DataFrame({book: [pdf[book].iloc[0]], "epub": [out.getvalue()], "file": [len(items)]})

    return sections.groupBy(book).applyInPandas(build, f"{book} {kind}, epub binary, file int")


def modelled(rows: DataFrame, key: str, text: str, model, retries: int = 3) -> DataFrame:
    """(key, risposta, errore): a model call per row in Arrow batches. model(text, attempt) may fail; failures are retried, then recorded, never raised."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for k, t in zip(b[key], b[text]):
                answer, error = None, None
                for attempt in range(retries + 1):
                    try:
                        answer, error = model(t, attempt), None
                        break
                    except Exception as x:  # noqa: BLE001
                        error = str(x)[:200]
                out.append((k, answer, error))
            yield pd.DataFrame(out, columns=[key, "risposta", "errore"])

    return rows.select(key, text).mapInPandas(run, f"{key} {dict(rows.dtypes)[key]}, risposta string, errore string")
