"""Driver tables and the labelled-message view derived from them.

``messages(doc_id, source, lang, label, text)`` = documents JOIN labels,
label ``spam`` iff ``toxic = 1``. Unlabelled documents are the scoring and
streaming input (``unlabelled``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


SMALL_BYTES_PER_CORE = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. A table too small to give every core a split is dealt
    out by its id (one small shuffle); a larger one is read as it is stored."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    df = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    size = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()) \
        .getContentSummary(p).getLength()
    if size >= cores * SMALL_BYTES_PER_CORE or size < 1 << 20:
        return df
    key = next((c for c in df.columns if c.endswith("_id")), None)
    return df.repartition(cores, key) if key else df.repartition(cores)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled messages. ``labels`` is the small side of the join only by
    convention; Catalyst/AQE pick the strategy from real sizes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return (
        docs.join(labels, "doc_id")
        .select(
            "doc_id", "source", "lang",
            F.when(F.col("toxic") == 1, F.lit("spam")).otherwise(F.lit("ham")).alias("label"),
            "text",
        )
    )


def unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id")
    return docs.join(labels, "doc_id", "left_anti")


BROADCAST_IDS = 2_000_000   # rows of ids and labels, some 40 bytes each


def all_documents(spark: SparkSession, sf_dir: str, but: DataFrame | None = None) -> DataFrame:
    """Every document with its label when it has one (NULL otherwise); with ``but``
    without those whose id is there, and texts are not shuffled to labels that may
    be broadcast."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    if but is not None:
        few = lambda ids: F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
        docs, labels = docs.join(few(but), "doc_id", "left_anti"), few(labels)
    return docs.join(labels, "doc_id", "left").select(
        "doc_id", "source", "lang",
        F.when(F.col("toxic") == 1, "spam").when(F.col("toxic").isNotNull(), "ham")
        .alias("label"),
        "text",
    )
