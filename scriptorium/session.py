"""Session settings, table access and lineage cuts shared by all operators."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str = "*", memory: str = "8g") -> SparkSession:
    """A session for tests and the bench; on a cluster the submitter makes the session."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("scriptorium")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which every executor can reach.

    Only where the setting is absent (tests, one machine) a temporary folder is made; it is removed when Python ends.
    """
    sc = spark.sparkContext
    where = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not where:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="scriptorium-")
        atexit.register(shutil.rmtree, where[7:], True)
        spark.conf.set("spark.checkpoint.dir", where)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(where)
    return where.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{shared_dir(spark)}/scriptorium/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: lineage ends here and survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_path(uri: str) -> str:
    """The mounted path of a file:// folder."""
    return uri[7:] if uri.startswith("file://") else uri[5:] if uri.startswith("file:") else uri


def slot_count(spark: SparkSession, least: int = 1) -> int:
    """Partitions for an explicit hash exchange in front of Arrow functions."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def cpu_env() -> None:
    """Python workers use one thread each; numpy would else start one per core."""
    os.environ.setdefault("OMP_NUM_THREADS", "1")
