"""Sources as DataFrames: page results, chapters, JSON lines, whole JSON files, logs, file listings, PDF parsers as plug-ins."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = "STRUCT<block_label: STRING, block_content: STRING, block_bbox: ARRAY<DOUBLE>, block_order: INT>"
PAGE = f"width DOUBLE, height DOUBLE, parsing_res_list ARRAY<{BLOCK}>, res STRUCT<width: DOUBLE, height: DOUBLE, parsing_res_list: ARRAY<{BLOCK}>>"
ACCESS = "t STRING, e STRING, u STRING, ip STRING, ua STRING, d STRING"


def page_results(spark: SparkSession, path: str) -> DataFrame:
    """(pag, idx, width, height, block_*) of OCR results, one JSON file per page named page_N; also if nested under `res`. Order nulls last, then place."""
    raw = spark.read.schema(PAGE).option("multiLine", True).json(path).select("*", F.regexp_extract("_metadata.file_name", r"(\d+)\D*$", 1).cast("int").alias("pag"))
    flat = raw.select("pag", *[F.coalesce(F.col(c), F.col(f"res.{c}")).alias(c) for c in ("width", "height", "parsing_res_list")])
    return flat.select("pag", "width", "height", F.posexplode("parsing_res_list").alias("idx", "_b")).select("pag", "idx", "width", "height", "_b.*")


def page_texts(spark: SparkSession, path: str, strip_margin_notes: bool = True) -> DataFrame:
    """(pag, testo) of one Markdown file per page; margin notes removed."""
    raw = spark.read.text(path, wholetext=True).select(F.regexp_extract("_metadata.file_name", r"(\d+)\D*$", 1).cast("int").alias("pag"), F.col("value").alias("testo"))
    return raw.withColumn("testo", F.regexp_replace("testo", r"\*\(testo a margine:[^)]*\)\*\n?", "")) if strip_margin_notes else raw


def complete_pages(pages: DataFrame) -> DataFrame:
    """pages, or an error naming how many are missing between 1 and the last: checked inside the plan."""
    gap = pages.agg((F.max("pag") - F.countDistinct("pag")).alias("_g"))
    checked = gap.select(F.when(F.col("_g") > 0, F.raise_error(F.concat(F.col("_g").cast("string"), F.lit(" pages are missing")))).otherwise(F.lit(0)).cast("int").alias("_ok"))
    return pages.crossJoin(F.broadcast(checked)).where("_ok = 0 or _ok is null").drop("_ok")


def chapter_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, testo) of chapter files."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("testo"))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; broken lines come out with nulls and their text in `_corrupt_record`."""
    return spark.read.schema(schema + ", _corrupt_record STRING").option("mode", "PERMISSIVE").json(path)


def dict_or_list(text_df: DataFrame, column: str, element: str, field: str = "entita") -> DataFrame:
    """Elements of a JSON text that is a bare array or an object with the array in `field`."""
    array = f"ARRAY<{element}>"
    either = F.when(F.startswith(F.ltrim(column), F.lit("{")), F.from_json(column, f"{field} {array}")[field]).otherwise(F.from_json(column, array))
    return text_df.withColumn("_e", F.explode(either)).select("*", "_e.*").drop("_e")


def access_log(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """Access events with a parsed time `quando`, from an instant on."""
    log = spark.read.schema(ACCESS).json(path).withColumn("quando", F.try_to_timestamp("t"))
    return log.where(F.col("quando") >= F.lit(since).cast("timestamp")) if since else log


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(path, modificationTime, length) of files, without their contents."""
    return spark.read.format("binaryFile").load(path).select("path", "modificationTime", "length")


def parsed(spark: SparkSession, path: str, parse: Callable[[bytes], list[dict]], schema: str) -> DataFrame:
    """Rows a plug-in parser makes of each binary file (PDF outline, native text, images); a file it fails on gives one row with `errore`."""
    names = [c.strip().split(" ")[0] for c in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for p, content in zip(b["path"], b["content"]):
                try:
                    rows += [{"path": p, "errore": None, **r} for r in parse(content)]
                except Exception as x:  # noqa: BLE001 - a broken file is a row, not a failed job
                    rows.append({"path": p, "errore": str(x)[:200]})
            yield pd.DataFrame(rows, columns=["path", "errore", *names])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, f"path string, errore string, {schema}")


def table_of(spark: SparkSession, url: str, name: str, **options: str) -> DataFrame:
    """A database table over JDBC; filters and columns are pushed down. Needs the driver on the class path."""
    return spark.read.format("jdbc").options(url=url, dbtable=name, **options).load()


def native_or_scanned(pages: DataFrame, book: str, page: str, text: str, pages_seen: int = 5, least: int = 20) -> DataFrame:
    """(book, nativo): whether one of the first pages has more than `least` characters."""
    return pages.where(F.col(page) <= pages_seen).groupBy(book).agg((F.coalesce(F.max(F.length(F.trim(text))), F.lit(0)) > least).alias("nativo"))


def chat_texts(messages: DataFrame, key: str, order: str, role: str, text: str) -> DataFrame:
    """(key, testo): turns in order in a chat template."""
    turns = F.array_sort(F.collect_list(F.struct(order, role, text)))
    return messages.groupBy(key).agg(F.array_join(F.transform(turns, lambda t: F.concat(F.lit("<|"), t[role], F.lit("|>\n"), F.coalesce(t[text], F.lit("")))), "\n").alias("testo"))


def flattened(pages: DataFrame, arrays: dict[str, str], page: str = "page") -> DataFrame:
    """(page, tipologia, dati) from several typed arrays per page."""
    parts = [pages.select(page, F.lit(kind).alias("tipologia"), F.explode(column).alias("_e")).select(page, "tipologia", F.to_json("_e").alias("dati")) for column, kind in arrays.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
