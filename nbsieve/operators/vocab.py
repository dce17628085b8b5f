"""Vocabulary operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nbsieve import config as C
from nbsieve.operators import nb
from nbsieve.operators.ordered import positions


def sorted_positions(v: DataFrame, key: str = "token", out: str = "position") -> DataFrame:
    """1-based position in code-point (binary) order."""
    return positions(v, [F.col(key).asc()], out)


def top_words_per_class(all_counts: DataFrame, n: int = 20) -> DataFrame:
    """Top-n tokens per class by count (ties: token ascending), with
    the cloud weight n/max(n). Per class this is a global top-k: each
    partition keeps its local top-n (window per class after a
    repartition would put a class in one task), so reduce with
    ``max_by``-free k-way selection via ``row_number`` over a bounded
    candidate set."""
    parts = []
    for c in ("spam", "ham"):
        x = all_counts.where(F.col(f"n_{c}") > 0).select(
            F.lit(c).alias("label"), "token", F.col(f"n_{c}").alias("count"))
        parts.append(x)
    u = parts[0].unionByName(parts[1])
    return top_k_per_group(u, "label", [F.desc("count"), F.asc("token")], n)


def top_k_per_group(df: DataFrame, group: str, order, k: int, rank_col: str = "rank") -> DataFrame:
    """Exact top-k per group without sending a whole group to one task:
    first keep the top-k of every (group, hash bucket) sub-group, which is
    exact (a global top-k row is in its bucket's top-k), then rank the at
    most k * buckets candidates per group."""
    buckets = 64
    x = df.withColumn("__hb", F.abs(F.xxhash64(*[c for c in df.columns if c != group])) % buckets)
    w1 = Window.partitionBy(group, "__hb").orderBy(*order)
    cand = x.withColumn("__r", F.row_number().over(w1)).where(F.col("__r") <= k).drop("__r", "__hb")
    w2 = Window.partitionBy(group).orderBy(*order)
    return cand.withColumn(rank_col, F.row_number().over(w2).cast("bigint")) \
               .where(F.col(rank_col) <= k)


def log_ratio(model: nb.NBModel, alpha: float = C.ALPHA, counts: DataFrame | None = None) -> DataFrame:
    """Per vocabulary token (of ``counts``, else all), log P(w|spam) - log
    P(w|ham) (multinomial)."""
    x = (model.counts if counts is None else counts).crossJoin(F.broadcast(model.stats.select("ntok_spam", "ntok_ham", "V")))
    a = float(alpha)
    lp = {c: F.log((F.col(f"n_{c}") + a) / (F.col(f"ntok_{c}") + a * F.col("V")))
          for c in ("spam", "ham")}
    return x.select("token", lp["spam"].alias("log_p_spam"), lp["ham"].alias("log_p_ham"),
                    (lp["spam"] - lp["ham"]).alias("score"))


def strongest(df: DataFrame, score: str, tie: str, k: int, bins: int = 4096) -> DataFrame:
    """The ``k`` rows of largest ``score`` (finite, not NULL), of equal ones
    those of smallest ``tie``; exact.

    Two counting passes refine a histogram of the score: the bin in which the
    k-th row lies, then the bin of that bin. Rows above it are in, rows below
    are out, and only those within it are put in order. Nothing is sorted whole,
    and at most ``bins`` counts come to the driver."""
    s = F.col(score)
    low, high, n = df.agg(F.min(s), F.max(s), F.count(F.lit(1))).first()
    if n <= k:
        return df
    above, bounds = 0, (low, high)
    for _ in range(2):
        low, high = bounds
        width = (high - low) / bins
        if not width:
            break
        # The bin is made from the row's score alone, so every pass sees it alike.
        at = F.least(F.lit(bins - 1), F.floor((s - low) / width)).cast("int")
        inside = df.where((s >= low) & (s <= high))
        for r in inside.groupBy(at.alias("b")).agg(
                F.count(F.lit(1)).alias("n"), F.min(s).alias("low"), F.max(s).alias("high")) \
                .orderBy(F.desc("b")).collect():
            if above + r["n"] >= k:
                bounds = (r["low"], r["high"])
                break
            above += r["n"]
    low, high = bounds
    sure = df.where(s > high)
    edge = positions(df.where((s >= low) & (s <= high)), [s.desc(), F.col(tie).asc()], "__position")
    return sure.unionByName(edge.where(F.col("__position") <= k - above).drop("__position"))


def top_k_global(df: DataFrame, order, k: int, small_k: int = 1000) -> DataFrame:
    """Global top-k in any order. Small k: ``orderBy().limit()`` (each partition
    keeps k rows, one task merges them). Large k: the distributed position of
    every row, so no task ever holds k rows from every partition; by one number,
    ``strongest`` does without the sort."""
    if k <= small_k:
        return df.orderBy(*order).limit(k)
    return positions(df, order, "__position").where(F.col("__position") <= k).drop("__position")
