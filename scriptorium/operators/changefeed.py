"""Applying a change feed: a bucketed copy-on-write table and a fold of decisions with take-backs.

The table is a set of Parquet folders, one per hash bucket, named by a manifest. A batch of changes is routed to
buckets by the hash of its key; only touched buckets are sort-merged with the changes and written anew, all others
keep their files, and a new manifest is committed. Readers see one manifest version, so a lost job leaves the old state.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriptorium.session import fresh_path, slot_count


class BucketedTable:
    """A keyed table of hash buckets with copy-on-write merges.

    bucket_by: columns hashed to a bucket; identity: columns that name a row; order: sort order inside a bucket. Rows
    with a null in any identity column are refused by merge() (they can't be named). A row that comes again replaces
    the stored one (copies are equal, so the order of deliveries doesn't matter).
    """

    def __init__(self, spark: SparkSession, path: str, bucket_by: list[str], identity: list[str], order: list[str], buckets: int = 64):
        self.spark, self.path, self.bucket_by, self.identity, self.order, self.buckets = spark, path.rstrip("/"), bucket_by, identity, order, buckets

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def manifest(self) -> dict:
        """The newest whole manifest: version and the folder of each bucket. One that a lost writer left torn is passed over."""
        folder, fs = self._fs(f"{self.path}/_manifest")
        names = sorted((s.getPath().getName() for s in fs.listStatus(folder)), reverse=True) if fs.exists(folder) else []
        for name in names:
            stream = fs.open(self._fs(f"{self.path}/_manifest/{name}")[0])
            try:
                return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            except ValueError:
                continue
            finally:
                stream.close()
        return {"version": 0, "buckets": {}}

    def _commit(self, manifest: dict) -> None:
        """Publish by exclusive creation, which fails if another writer took the version."""
        name = f"{manifest['version']:012d}.json"
        final, fs = self._fs(f"{self.path}/_manifest/{name}")
        try:
            out = fs.create(final, False)
        except Py4JJavaError as e:
            raise RuntimeError(f"manifest {name} was committed by another writer") from e
        try:
            out.write(bytearray(json.dumps(manifest), "utf-8"))
        finally:
            out.close()

    def read(self, buckets: list[int] | None = None) -> DataFrame | None:
        """The current rows (of some buckets); None while nothing was merged."""
        files = self.manifest()["buckets"]
        paths = sorted({p for b, p in files.items() if buckets is None or int(b) in buckets})
        return self.spark.read.parquet(*[f"{self.path}/{p}" for p in paths]) if paths else None

    def merge(self, changes: DataFrame, derive: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """Route, sort-merge touched buckets, write replacement files, commit.

        derive adds columns that follow from the rows of a bucket (a window within _bucket); it is applied to the
        buckets that are written, all others keep theirs. Of several changes of one row the greatest by its columns counts.
        """
        columns = changes.columns
        rest = [c for c in columns if c not in self.identity]
        bucket = F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int").alias("_bucket")
        routed = changes.dropna(subset=self.identity)
        routed = routed.groupBy(*self.identity).agg(F.max(F.struct(*rest)).alias("_n")).select(*self.identity, "_n.*") if rest else routed.distinct()
        routed = routed.select(*columns, bucket)
        now = self.manifest()
        merged = routed
        if now["buckets"]:
            # at most `buckets` numbers come to the driver
            touched = [r[0] for r in changes.dropna(subset=self.identity).select(bucket).distinct().collect()]
            base = self.read(touched)
            if base is not None:
                keys = ["_bucket", *self.identity]
                o, n = base.select(*columns, bucket).select(*keys, F.struct(*rest, F.lit(1).alias("_in")).alias("_o")), routed.select(*keys, F.struct(*rest, F.lit(1).alias("_in")).alias("_n"))
                both = o.hint("merge").join(n, keys, "full_outer")
                merged = both.select(*self.identity, *[F.when(F.col("_n").isNotNull(), F.col(f"_n.{c}")).otherwise(F.col(f"_o.{c}")).alias(c) for c in rest], "_bucket")
        version = now["version"] + 1
        folder = f"v{version:012d}"
        placed = merged.repartition(min(self.buckets, slot_count(self.spark)), F.col("_bucket"))
        (derive(placed) if derive else placed).sortWithinPartitions("_bucket", *self.order).write.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
        at, fs = self._fs(f"{self.path}/{folder}")
        new = {s.getPath().getName().split("=")[1]: f"{folder}/{s.getPath().getName()}" for s in fs.listStatus(at) if "=" in s.getPath().getName()}
        self._commit({"version": version, "buckets": now["buckets"] | new})


def instant(ts: Column) -> Column:
    """Epoch second of a time text: ISO with blank or T, fraction, Z or offset; epoch seconds or milliseconds. Without an offset it is UTC; null if unreadable."""
    t = F.trim(ts)
    iso = F.regexp_replace(F.regexp_replace(t, r"([+-]\d{2})(\d{2})$", "$1:$2"), r"\s+(?=[+-]\d{2}:|Z$)", "")
    zoned = F.when(iso.rlike(r"(?:[zZ]|[+-]\d{2}(?::\d{2})?)$") & iso.rlike(r"\d:\d{2}"), iso).otherwise(F.concat(iso, F.lit("Z")))
    return (
        F.when(t.rlike(r"^-?\d{1,11}$"), t.try_cast("long"))
        .when(t.rlike(r"^\d{12,14}$"), F.floor(t.try_cast("long") / 1000))
        .when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), F.upper(zoned).try_cast("timestamp").try_cast("long"))
    )


#: Records of a book are folded in slots of this many seconds, so that a hot book is spread over many tasks.
SLOT_SECONDS = 900


def log_records(log: DataFrame) -> DataFrame:
    """Records with an effect, each once by (libro_id, sessione, prog): torn ones and those without identity or instant are dropped."""
    return (
        log.select("libro_id", "sessione", "prog", "id", "classe", "annulla", instant(F.col("ts")).alias("istante"))
        .where(F.col("libro_id").isNotNull() & F.col("sessione").isNotNull() & F.col("prog").isNotNull() & F.col("istante").isNotNull())
        .where(F.col("id").isNotNull() | F.coalesce("annulla", F.lit(False)))
        .withColumn("slot", F.floor(F.col("istante") / SLOT_SECONDS))
    )


def _step() -> Column:
    return F.when(F.coalesce("annulla", F.lit(False)), -1).otherwise(1)


def folded(records: DataFrame) -> DataFrame:
    """records with `_d`, the sum of steps (+1 a decision, -1 a take-back) up to each in its slot, and `_later`, the least such sum from it on."""
    run = Window.partitionBy("_bucket", "libro_id", "slot").orderBy("istante", "prog", "sessione")
    return records.withColumn("_d", F.sum(_step()).over(run.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_later", F.min("_d").over(run.rowsBetween(0, Window.unboundedFollowing)))


def in_force(local: DataFrame) -> DataFrame:
    """The decision in force of each (libro_id, id) after take-backs; local: folded records.

    A take-back removes the latest decision of the book not yet taken back, as a closing bracket pairs with the nearest
    open one: a decision at running sum d stands iff no later sum of its book falls below d. Sums and suffix minima
    are taken inside slots, when a bucket is written; slots exchange only (sum, minimum).
    """
    book = Window.partitionBy("libro_id").orderBy("slot")
    slots = (
        local.groupBy("libro_id", "slot")
        .agg(F.sum(_step()).alias("_sum"), F.min("_d").alias("_min"))
        .withColumn("_before", F.coalesce(F.sum("_sum").over(book.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("_after", F.min(F.col("_before") + F.col("_min")).over(book.rowsBetween(1, Window.unboundedFollowing)))
        .select("libro_id", "slot", "_before", "_after")
    )
    standing = (
        local.where(~F.coalesce("annulla", F.lit(False)) & (F.col("_later") >= F.col("_d")))
        .join(slots, ["libro_id", "slot"])
        .where(F.col("_after").isNull() | (F.col("_after") >= F.col("_before") + F.col("_d")))
    )
    return standing.groupBy("libro_id", "id").agg(F.max_by("classe", F.struct("istante", "prog", "sessione")).alias("classe"))


def log_table(log: DataFrame, rows_per_bucket: int = 50_000) -> BucketedTable:
    """A new table for a log; the number of buckets follows its rows (a count of Parquet rows reads footers only)."""
    buckets = min(4096, max(8, -(-log.count() // rows_per_bucket)))
    return BucketedTable(log.sparkSession, fresh_path(log.sparkSession, "decisioni"), ["libro_id", "slot"], ["libro_id", "sessione", "prog"], ["libro_id", "slot", "istante", "prog"], buckets)


def apply_log(log: DataFrame, table: BucketedTable | None = None) -> DataFrame:
    """Merge a batch of the log into its table and give the decisions in force.

    Empty logs give no rows; repeated, late and torn records leave no trace. Only buckets with records of the batch
    are merged, folded and written; the others keep their files and their folds.
    """
    table = table or log_table(log)
    records = log_records(log)
    table.merge(records, folded)
    state = table.read()
    kinds = dict(records.dtypes)
    return in_force(state if state is not None else log.sparkSession.createDataFrame([], ", ".join(f"{c} {kinds[c]}" for c in records.columns) + ", _d bigint, _later bigint"))


def replay(log: DataFrame, arrival: str, batches: int = 2) -> DataFrame:
    """The decisions in force after a whole log, applied in batches in the order of arrival: a base, then what came later.

    The batches are cut at quantiles of the arrival (one pass, a few numbers); records without one come last.
    """
    cuts = log.select(F.percentile_approx(F.col(arrival).cast("long"), [k / batches for k in range(1, batches)], 1000)).first()[0] or []
    table = log_table(log)
    at = F.coalesce(F.col(arrival).cast("long"), F.lit((1 << 63) - 1))
    out = None
    for lo, hi in zip([None, *cuts], [*cuts, None]):
        part = log.where((at > lo if lo is not None else F.lit(True)) & (at <= hi if hi is not None else F.lit(True)))
        if hi is None:
            out = apply_log(part, table)
        else:
            table.merge(log_records(part), folded)
    return out
