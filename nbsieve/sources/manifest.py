"""Small files next to tables, on any file system that Spark reads: listing,
reading, and writing under a name that appears only when the file is whole."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder; none of a missing one."""
    fs, p = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_json(spark: SparkSession, path: str) -> dict:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def write_json(spark: SparkSession, path: str, content: dict) -> None:
    """Written under a hidden name, then renamed: the file is there whole or
    not at all. An earlier file of that name is replaced."""
    folder, _, name = path.rpartition("/")
    fs, hidden = _at(spark, f"{folder}/_{name}.{uuid.uuid4().hex[:8]}")
    _, final = _at(spark, path)
    stream = fs.create(hidden, True)
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    if not fs.rename(hidden, final):
        fs.delete(final, False)
        if not fs.rename(hidden, final):
            raise RuntimeError(f"could not write {path}")


def drop(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)
