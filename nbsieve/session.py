"""Spark session helpers.

The library never creates its own cluster settings beyond what a job needs:
``get_spark`` is for tests, the bench and local runs. On a cluster the caller's
session is used as is, and the checkpoint folder is read from
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import gc
import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "nbsieve") -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    shuffle_partitions = shuffle_partitions or int(cpus)
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; set a scratch one only when unset
    (local runs and tests). On a cluster ``spark.checkpoint.dir`` names a
    shared folder and is used untouched."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder: lineage cuts and "
                           "scratch outputs must survive the loss of an executor")
    path = tempfile.mkdtemp(prefix="nbsieve-ckpt-")  # local mode only (tests, bench)
    sc.setCheckpointDir(path)
    return path


@contextmanager
def setting(spark: SparkSession, key: str, value):
    """The session's setting ``key`` is ``value`` for the jobs run inside."""
    prev = spark.conf.get(key)
    spark.conf.set(key, str(value))
    try:
        yield
    finally:
        spark.conf.set(key, prev)


OPEN_FILES = 8              # of one task; rows of further folders are sorted
ROW_GROUP = 32 << 20        # bytes that each open file holds in memory


def cut_lineage(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: survives the loss of executors (unlike a local checkpoint), and later
    plans read only the columns and, with ``partition_by``, the folders they
    need. The folders are few, and a task keeps a file open in each: without
    that Spark would sort all rows of a task by the folder, in memory."""
    path = scratch_dir(df.sparkSession, "table")
    writer = df.write.option("compression", "zstd")
    if partition_by:
        with setting(df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", OPEN_FILES):
            writer.option("parquet.block.size", str(ROW_GROUP)).partitionBy(partition_by).parquet(path)
    else:
        writer.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    return back.select(*[f"`{c}`" for c in df.columns])


def free_shuffles(spark: SparkSession) -> None:
    """The shuffle files of tables that are stored by now stay on the executors'
    disks until the driver happens to collect its garbage: let it collect it."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def fingerprint(spark: SparkSession, *paths: str) -> tuple:
    """(path, length, modification time) of every file at ``paths``: metadata
    only, to tell whether something kept for an input is still true of it."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        for s in p.getFileSystem(conf).listStatus(p):
            out.append((str(s.getPath()), s.getLen(), s.getModificationTime()))
    return tuple(sorted(out))


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never a
    machine-local temp folder on a cluster)."""
    import uuid
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/nbsieve-scratch/{name}-{uuid.uuid4().hex[:12]}"
