"""Attribute-value rows to wide typed tables.

A first pass over the data makes the dictionary of attributes. Entities are hash-bucketed by an exchange on their id;
in a bucket, entity and attribute are encoded to row and column numbers, values are scattered into one numpy array per
type by (row, column), and Arrow tables come out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.functions import attributes as A
from scriptorium.session import slot_count

_NUMPY = {"int64": np.int64, "double": np.float64, "bool": np.bool_, "string": object}
_ARROW = {"int64": pa.int64(), "double": pa.float64(), "bool": pa.bool_(), "string": pa.string()}
_SPARK = {"int64": "bigint", "double": "double", "bool": "boolean", "string": "string"}


def once(batches: Iterator[pa.RecordBatch], key: int = 0) -> Iterator[pa.RecordBatch]:
    """Rows whose key differs from the row before; the input is sorted by key."""
    last = None
    for b in batches:
        ids = b.column(key).to_numpy(zero_copy_only=False)
        if len(ids):
            new = np.ones(len(ids), bool)
            new[1:] = ids[1:] != ids[:-1]
            new[0] = last is None or ids[0] != last
            last = ids[-1]
            yield b if new.all() else b.filter(pa.array(new))


def by_entity(df: DataFrame, key: str, columns: list[str], order: list[str] | None = None) -> DataFrame:
    """Hash buckets of the entities, sorted by key, null keys left out."""
    chosen = df.select(key, *columns).where(F.col(key).isNotNull())
    return chosen.repartition(slot_count(df.sparkSession), key).sortWithinPartitions(key, *(order or []))


#: Columns of a wide table at most; attributes beyond, the rarest, stand together in a map column.
MOST_COLUMNS = 1000


def attributes(df: DataFrame, data: str = "dati") -> DataFrame:
    """(attributo, n, tipo): every attribute name in the data, how often it occurs, and the type that all its values have (`bool`, `int64`, `double`, else `string`)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: Counter = Counter()
            for text in b.column(0).to_pylist():
                seen.update((name, _kind(value)) for name, value in A.pairs(text) or ())
            yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in seen], pa.string()) for i in (0, 1)] + [pa.array(list(seen.values()), pa.int64())], ["attributo", "tipo", "n"])

    votes = df.select(data).where(F.col(data).isNotNull()).mapInArrow(read, "attributo string, tipo string, n long").where("attributo != ''")
    kinds = votes.groupBy("attributo").agg(F.sum("n").alias("n"), F.collect_set(F.when(F.col("tipo") != "null", F.col("tipo"))).alias("_t"))
    one = F.when(F.size("_t") == 1, F.col("_t")[0]).when((F.size("_t") == 2) & F.array_contains("_t", "int64") & F.array_contains("_t", "double"), "double").otherwise("string")
    return kinds.select("attributo", "n", one.alias("tipo"))


def _kind(value: object) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int64" if abs(value) < 1 << 53 else "string"
    return "double" if isinstance(value, float) else "string"


def _as_is(value: object) -> object:
    return value


def wide(df: DataFrame, key: str = "id", data: str = "dati", kind: str = "tipologia", typed: dict | None = None, names: list[str] | None = None) -> DataFrame:
    """One row per entity: key, kind and a typed column per attribute.

    The attributes are those of `names`, or else a dictionary read from the data: those of `typed` (all of them, with
    their readings), then every other name that occurs, commonest first, as the type that all its values have. From
    MOST_COLUMNS on, names go to `altri`, a map of texts, so nothing is lost. The last entry of a repeated attribute
    counts, even if unreadable. Missing, unreadable and placeholder values are null. Null or broken `data` gives a row
    of nulls; repeated keys give one row; null keys none. Other columns of df are ignored. A name that clashes with a
    key column gets a `_` at its end.
    """
    typed = dict(typed if typed is not None else A.TYPED)
    if names is None:
        known = attributes(df, data).where(~F.col("attributo").isin(list(typed))).orderBy(F.desc("n"), "attributo").limit(MOST_COLUMNS - len(typed) + 1).collect()
        rest = len(known) > MOST_COLUMNS - len(typed)
        known = known[: MOST_COLUMNS - len(typed)]
        columns = typed | {r.attributo: (r.tipo, A.plain if r.tipo == "string" else float if r.tipo == "double" else _as_is) for r in known}
    else:
        rest = False
        columns = {n: typed.get(n, ("string", A.plain)) for n in names}
    names = list(columns)
    number = {n: j for j, n in enumerate(names)}
    of_type = {t: [j for j, n in enumerate(names) if columns[n][0] == t] for t in _NUMPY}
    shown = [n + "_" if n in (key, kind, "altri") else n for n in names]
    fields = [(key, pa.int64()), (kind, pa.string()), *[(s, _ARROW[columns[n][0]]) for s, n in zip(shown, names)]]
    schema = pa.schema(fields + [("altri", pa.map_(pa.string(), pa.string()))] * rest)

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in once(batches):
            rows, cols, values = [], [], []
            others: list[dict[str, str]] = []
            for row, text in enumerate(b.column(2).to_pylist()):  # the entity's code is its row in the bucket's batch
                more = {}
                for name, value in A.pairs(text) or ():
                    col = number.get(name)
                    if col is not None:
                        rows.append(row)
                        cols.append(col)
                        values.append(value)
                    elif rest:
                        more[name] = A.plain(value)
                others.append(more)
            n = b.num_rows
            entry = np.full((n, len(names)), -1, np.int64)
            entry[rows, cols] = np.arange(len(rows))  # of repeated cells the last stays
            out = [b.column(0).cast(pa.int64()), b.column(1).cast(pa.string())] + [None] * len(names)
            for t, js in of_type.items():
                if not js:
                    continue
                at, j = np.nonzero(entry[:, js] >= 0)
                read = [columns[names[js[c]]][1] for c in range(len(js))]
                got = [None if values[e] is None and t != "string" else read[c](values[e]) for c, e in zip(j.tolist(), entry[at, np.array(js)[j]].tolist())]
                fine = np.fromiter((v is not None for v in got), bool, len(got))
                array, mask = np.zeros((n, len(js)), _NUMPY[t]), np.ones((n, len(js)), bool)
                array[at[fine], j[fine]] = np.array([v for v in got if v is not None], _NUMPY[t])
                mask[at[fine], j[fine]] = False
                for c, col in enumerate(js):
                    out[col + 2] = pa.array(array[:, c], _ARROW[t], mask=mask[:, c])
            if rest:
                out.append(pa.array([list(m.items()) for m in others], schema.field("altri").type))
            yield pa.RecordBatch.from_arrays(out, schema=schema)

    ddl = f"{key} bigint, {kind} string, " + ", ".join(f"`{s}` {_SPARK[columns[n][0]]}" for s, n in zip(shown, names)) + ", altri map<string,string>" * rest
    return by_entity(df, key, [kind, data], [kind, data]).mapInArrow(scatter, ddl)


def narrow(table: DataFrame, key: str, names: list[str], attribute: str = "attributo", value: str = "valore") -> DataFrame:
    """The wide table back as (key, attribute, value) texts; numbers with a point and no needless zeros, nulls left out."""
    kinds = dict(table.dtypes)

    def text(n: str):
        if kinds[n] == "double":
            return F.when(F.col(n).isNotNull(), F.regexp_replace(F.regexp_replace(F.format_string("%.6f", F.col(n)), r"0+$", ""), r"\.$", ""))
        return F.col(n).cast("string")

    entries = F.array(*[F.struct(F.lit(n).alias("a"), text(n).alias("v")) for n in names])
    flat = table.select(key, F.explode(entries).alias("_e"))
    return flat.where(F.col("_e.v").isNotNull()).select(key, F.col("_e.a").alias(attribute), F.col("_e.v").alias(value))
