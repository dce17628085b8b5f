"""Model bundle as Parquet tables.

A bundle is a directory of versions. ``versions/<v>/`` holds the tables
``counts`` (vocabulary counts), ``all_counts`` (unpruned counts, for the word
trace), ``stats`` (one row) and ``meta`` (one row: vocabulary size, documents
trained on, alpha, pruned size). ``manifests/<v>.json`` names the version's
tables with their row counts and checksums and is written last, under a name
that appears only when it is whole: a reader takes the newest manifest, so it
sees the old bundle or the new one and never a part of either. Versions older
than the one before the newest are removed when a newer one is complete.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nbsieve import config as C
from nbsieve.operators import nb
from nbsieve.session import cut_lineage
from nbsieve.sources import manifest

KEEP_VERSIONS = 2           # a reader of the version before may still be at work


def _checksum(df: DataFrame) -> dict:
    """Rows, and a sum of row hashes that does not depend on their order."""
    row = df.select(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).alias("h")).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor("h"), F.lit(0)).alias("x"),
        F.coalesce(F.sum(F.pmod("h", F.lit(1_000_003))), F.lit(0)).alias("s")).first()
    return {"rows": row["n"], "checksum": f"{row['x']}:{row['s']}"}


def save_model(model: nb.NBModel, path: str, alpha: float = C.ALPHA,
               pruned_size: int | None = None, true_vocab_size: int | None = None) -> str:
    """K2 (and K3 when ``pruned_size`` is given: the reported size is the
    cap even if fewer words remain, and the true size is stored too). Returns
    the new version's name."""
    p, spark = path.rstrip("/"), model.stats.sparkSession
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    meta = model.stats.select(
        (F.lit(pruned_size) if pruned_size is not None else F.col("V")).cast("bigint")
        .alias("vocabulary_size"),
        F.lit(true_vocab_size if true_vocab_size is not None else model.vocab_size).cast("bigint")
        .alias("true_vocabulary_size"),
        F.col("n_docs").alias("total_messages_trained"),
        F.lit(float(alpha)).alias("alpha"),
        F.lit(model.min_df).alias("min_df"), F.lit(float(model.max_df)).alias("max_df"))
    tables = {}
    for name, df in (("counts", model.counts), ("all_counts", model.all_counts),
                     ("stats", model.stats), ("meta", meta)):
        at = f"{p}/versions/{version}/{name}"
        df.write.parquet(at)
        tables[name] = _checksum(spark.read.parquet(at))
    manifest.write_json(spark, f"{p}/manifests/{version}.json", {"version": version, "tables": tables})
    _remove_old(spark, p)
    return version


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Complete versions, oldest first."""
    return [n.removesuffix(".json") for n in manifest.names(spark, f"{path.rstrip('/')}/manifests")
            if n.endswith(".json") and n[0] not in "_."]


def _remove_old(spark: SparkSession, path: str) -> None:
    """Older versions, and what stopped writers left before those that stay."""
    complete = _versions(spark, path)
    keep = complete[-KEEP_VERSIONS:]
    for version in complete[:-KEEP_VERSIONS]:
        manifest.drop(spark, f"{path}/manifests/{version}.json")
    for version in manifest.names(spark, f"{path}/versions"):
        if keep and version < keep[0]:
            manifest.drop(spark, f"{path}/versions/{version}")


def model_exists(spark: SparkSession, path: str) -> bool:
    return bool(_versions(spark, path))


def load_model(spark: SparkSession, path: str, verify: bool = False) -> tuple[nb.NBModel, DataFrame]:
    """The newest complete version; fails when there is none. Returns
    (model, meta). With ``verify`` the tables are read against the manifest's
    counts and checksums first."""
    p = path.rstrip("/")
    complete = _versions(spark, p)
    if not complete:
        raise RuntimeError(f"no complete model bundle under {path}: save one, or use load_or_train")
    about = manifest.read_json(spark, f"{p}/manifests/{complete[-1]}.json")
    read = {name: spark.read.parquet(f"{p}/versions/{about['version']}/{name}")
            for name in about["tables"]}
    if verify:
        wrong = [name for name, df in read.items() if _checksum(df) != about["tables"][name]]
        if wrong:
            raise RuntimeError(f"tables differ from the manifest of {about['version']}: {wrong}")
    meta, stats = read["meta"], read["stats"]
    m = meta.select("min_df", "max_df").first()
    v = stats.select("V").first()["V"]
    model = nb.NBModel(counts=read["counts"], all_counts=read["all_counts"],
                       stats=stats, vocab_size=int(v), min_df=int(m["min_df"]),
                       max_df=float(m["max_df"]))
    return model, meta


def load_or_train(spark: SparkSession, path: str,
                  sources: DataFrame | Callable[[], DataFrame]) -> nb.NBModel:
    """The saved bundle, or (when absent) a model trained with alpha = 1
    from the sources and saved. ``sources``: messages ``(label, text)``, or what
    loads them (called only when needed); tokenised messages are taken as they
    are."""
    if model_exists(spark, path):
        return load_model(spark, path)[0]
    messages = sources() if callable(sources) else sources
    if "tokens" not in messages.columns:
        messages = cut_lineage(nb.tokenize(messages.select("label", "text")))
    save_model(nb.fit(messages), path, alpha=1.0)
    return load_model(spark, path)[0]
