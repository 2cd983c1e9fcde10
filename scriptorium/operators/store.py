"""The entity store: snapshots with guarded upserts, deletes, public view and validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def guarded_upsert(base: DataFrame, batch: DataFrame, keys: list[str], state: str = "revisione", free: str = "automatica", scope: list[str] | None = None) -> DataFrame:
    """The next snapshot: new keys are inserted, stored rows replaced only in state `free`; stored free rows that the
    batch lacks go, if the batch has their scope (columns of keys) at all.

    One full outer join on the keys; merging the same batch again changes nothing. Of rows with equal keys in the batch
    the last by all columns counts.
    """
    rest = [c for c in base.columns if c not in keys]
    new = batch.select(*base.columns).groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_n"))
    old = base.select(*keys, F.struct(*rest).alias("_o"))
    both = old.join(new, keys, "full_outer")
    if scope:
        both = both.join(batch.select(*scope).distinct().withColumn("_s", F.lit(True)), scope, "left")
    else:
        both = both.withColumn("_s", F.lit(True))
    kept = F.col("_o").isNotNull() & ((F.col(f"_o.{state}") != free) | F.col("_n").isNull())
    gone = F.col("_n").isNull() & (F.col(f"_o.{state}") == free) & F.coalesce("_s", F.lit(False))
    return both.where(~gone).withColumn("_r", F.when(kept, F.col("_o")).otherwise(F.col("_n"))).select(*keys, "_r.*").select(*base.columns)


def vanished(base: DataFrame, batch: DataFrame, keys: list[str], state: str = "revisione", free: str = "automatica") -> DataFrame:
    """Free rows of the store that a batch doesn't have."""
    return base.where(F.col(state) == free).join(batch.select(*keys).distinct(), keys, "left_anti")


def public_view(entities: DataFrame, books: DataFrame, discarded: str = "scartata") -> DataFrame:
    """Entities of public books that aren't discarded, with their book's title and licence."""
    shown = books.where("pubblico").select(F.col("id").alias("libro_id"), "titolo", "licenza")
    return entities.where(F.col("revisione") != discarded).join(shown, "libro_id")


def warnings_of(name: Column, required: dict[str, Column]) -> Column:
    """Array of warnings: length of the name, a name without letters, each required value that is missing."""
    n = F.trim(F.coalesce(name, F.lit("")))
    checks = [F.when((F.length(n) < 3) | (F.length(n) > 80), "lunghezza"), F.when(~n.rlike(r"\p{L}"), "senza lettere")]
    checks += [F.when(F.trim(F.coalesce(c, F.lit(""))) == "", f"manca {k}") for k, c in required.items()]
    return F.array_compact(F.array(*checks))


def line_range(lo: Column, hi: Column, same_file: Column) -> Column:
    """Half-open range of inclusive bounds; null where they span files or are inverted."""
    return F.when(same_file & (lo <= hi), F.struct(lo.alias("lo"), (hi + 1).alias("hi")))


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by a total order."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*")


def resumed(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Items without a result yet."""
    return items.join(done.select(key).distinct(), key, "left_anti")


def sliding_counts(events: DataFrame, key: str | list[str], at: str, seconds: int) -> DataFrame:
    """events with the number of events of the same key in the last `seconds`, itself included: a RANGE frame on epoch seconds."""
    run = Window.partitionBy(*([key] if isinstance(key, str) else key)).orderBy("_t").rangeBetween(-seconds + 1, 0)
    return events.withColumn("_t", F.unix_timestamp(F.col(at).cast("timestamp"))).withColumn("recenti", F.count(F.lit(1)).over(run)).drop("_t")
