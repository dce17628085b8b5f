"""Corpus profiles.

Exact medians/percentiles without collecting a class into one task: the
measured values are integers (lengths), so first count per (class, value)
-- a table bounded by the number of distinct lengths, not by the corpus --
then take cumulative counts over that small table and interpolate
linearly between the two ranks around q * (n - 1).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nbsieve import config as C
from nbsieve.functions.text import py_strip


def char_length(text: Column) -> Column:
    return F.length(text)


def word_count(text: Column) -> Column:
    """Whitespace-separated word count (Python ``str.split()``)."""
    return F.size(F.filter(F.split(text, f"[{C.PY_WHITESPACE}]+"), lambda w: F.length(w) > 0))


def exact_percentiles(df: DataFrame, by: str, value: str, qs) -> DataFrame:
    """Per group: linear-interpolated percentile for each q in ``qs``
    (columns ``p<100q>``), exact, from per-value counts."""
    cnt = df.groupBy(by, value).agg(F.count(F.lit(1)).alias("__c"))
    w = Window.partitionBy(by).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    cum = cnt.select(by, value, "__c", F.sum("__c").over(w).alias("__cum"),
                     F.sum("__c").over(Window.partitionBy(by)).alias("__n"))
    out = None
    for q in qs:
        pos = F.lit(q) * (F.col("__n") - 1)
        lo, hi = F.floor(pos), F.ceil(pos)
        # value at 0-based rank r = smallest value with cum >= r + 1
        g = cum.groupBy(by).agg(
            F.min(F.when(F.col("__cum") >= F.floor(F.lit(q) * (F.col("__n") - 1)) + 1, F.col(value)))
            .alias("__vlo"),
            F.min(F.when(F.col("__cum") >= F.ceil(F.lit(q) * (F.col("__n") - 1)) + 1, F.col(value)))
            .alias("__vhi"),
            F.max(pos - lo).alias("__frac"))
        name = f"p{int(round(q * 100))}"
        g = g.select(by, (F.col("__vlo") + F.col("__frac") * (F.col("__vhi") - F.col("__vlo")))
                     .cast("double").alias(name))
        out = g if out is None else out.join(g, by)
        _ = hi
    return out


def length_stats(msgs: DataFrame) -> DataFrame:
    """Per label and measure (char length, word count): mean, median,
    min, max, sample std."""
    x = msgs.select("label", char_length(F.col("text")).alias("length"),
                    word_count(F.col("text")).alias("word_count"))
    parts = []
    for m in ("length", "word_count"):
        agg = x.groupBy("label").agg(F.avg(m).alias("mean"), F.min(m).cast("double").alias("min"),
                                     F.max(m).cast("double").alias("max"),
                                     F.stddev_samp(m).alias("std"))
        med = exact_percentiles(x, "label", m, [0.5]).withColumnRenamed("p50", "median")
        parts.append(agg.join(med, "label").select("label", F.lit(m).alias("measure"), "mean",
                                                   "median", "min", "max", "std"))
    return parts[0].unionByName(parts[1])


def length_percentiles(msgs: DataFrame, qs=(0.25, 0.5, 0.75, 0.9, 0.95)) -> DataFrame:
    """Character-length percentiles per label."""
    x = msgs.select("label", char_length(F.col("text")).alias("length"))
    return exact_percentiles(x, "label", "length", qs)


def longer_class(msgs: DataFrame) -> DataFrame:
    """Mean length per class and which class is longer."""
    x = msgs.select("label", char_length(F.col("text")).alias("length"))
    g = x.agg(F.avg(F.when(F.col("label") == "ham", F.col("length"))).alias("avg_ham_length"),
              F.avg(F.when(F.col("label") == "spam", F.col("length"))).alias("avg_spam_length"))
    return g.withColumn("longer", F.when(F.col("avg_ham_length") > F.col("avg_spam_length"), "ham")
                        .otherwise("spam"))


def raw_label_distribution(raw: DataFrame, col: str = "raw_label") -> DataFrame:
    """Count and % of total per trimmed, lower-cased raw label."""
    x = raw.select(F.lower(py_strip(F.col(col).cast("string"))).alias("raw_label"))
    g = x.groupBy("raw_label").agg(F.count(F.lit(1)).alias("n"))
    tot = g.agg(F.sum("n").alias("__t"))
    return g.crossJoin(F.broadcast(tot)).select("raw_label", "n",
                                                (F.col("n") / F.col("__t") * 100).alias("pct"))


def mapped_label_distribution(raw: DataFrame, col: str = "raw_label") -> DataFrame:
    """The profiler's smaller label sets, then '1'/'0', else skipped;
    all three outcomes reported, with % of total."""
    r = F.lower(py_strip(F.col(col).cast("string")))
    m = F.when(r.isin(*C.PROFILE_SPAM_LABELS), "spam").when(r.isin(*C.PROFILE_HAM_LABELS), "ham") \
         .when(r == "1", "spam").when(r == "0", "ham").otherwise("skipped")
    g = raw.select(m.alias("mapped")).groupBy("mapped").agg(F.count(F.lit(1)).alias("n"))
    cats = raw.sparkSession.createDataFrame([("spam",), ("ham",), ("skipped",)], "mapped string")
    x = cats.join(g, "mapped", "left").select("mapped", F.coalesce("n", F.lit(0)).alias("n"))
    tot = x.agg(F.sum("n").alias("__t"))
    return x.crossJoin(F.broadcast(tot)).select("mapped", "n", (F.col("n") / F.col("__t") * 100).alias("pct"))


def composition(msgs: DataFrame) -> DataFrame:
    """Total / spam / ham and spam % per source and combined (rollup;
    ``source`` NULL is the combined row), plus the number of non-empty
    sources on every row."""
    g = msgs.rollup("source").agg(
        F.count(F.lit(1)).alias("total"),
        F.count(F.when(F.col("label") == "spam", 1)).alias("spam"),
        F.count(F.when(F.col("label") == "ham", 1)).alias("ham"),
        F.grouping("source").alias("__g"))
    n_src = g.where(F.col("__g") == 0).agg(F.count(F.lit(1)).alias("n_sources"))
    return g.crossJoin(F.broadcast(n_src)).select(
        "source", "total", "spam", "ham",
        F.when(F.col("total") > 0, F.col("spam") / F.col("total") * 100).otherwise(0.0).alias("spam_pct"),
        "n_sources")


def category_counts(df: DataFrame, split: str, category: str, category_id: str,
                    row_id: str) -> DataFrame:
    """Category counts per split with rank (desc, ties by category)
    and the category id of each category's first row (smallest row id)."""
    g = df.groupBy(split, category).agg(F.count(F.lit(1)).alias("n"),
                                        F.min_by(category_id, row_id).alias("first_seen_id"))
    w = Window.partitionBy(split).orderBy(F.desc("n"), F.asc(category))
    return g.withColumn("rank", F.row_number().over(w))
