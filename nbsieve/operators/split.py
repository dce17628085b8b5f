"""Stratified splits (W4) and stratified k folds (W5), deterministic.

``with_split`` sizes the parts by rounding per class; ``with_allocated_split``
by largest remainders, which keeps the parts' total sizes exact.

Order inside a class is md5('<seed>-<doc_id>'), ties by doc_id. Per class
with n rows: n_test = round(n * test_ratio), n_val = round((n - n_test) *
val_ratio / (1 - test_ratio)); the first n_test rows are test, the next
n_val are val, the rest train. Folds are ``ntile(k)`` over the same order
(the first n mod k folds get one extra row). Ranks come from
``rank_by_hash``, so a class with billions of rows is never one task.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nbsieve import config as C
from nbsieve.operators.ordered import rank_by_hash, seeded_hash


def _round_frac(n, frac: Fraction):
    """floor(n * frac + 1/2) in exact integer arithmetic."""
    return F.floor((n * (2 * frac.numerator) + frac.denominator) / (2 * frac.denominator)) \
        .cast("bigint")


def split_counts(n, val_ratio: float, test_ratio: float):
    t = Fraction(str(test_ratio))
    v = Fraction(str(val_ratio)) / (1 - t)
    n_test = _round_frac(n, t)
    n_val = _round_frac(n - n_test, v)
    return n_test, n_val


def with_split(msgs: DataFrame, val_ratio: float = C.VAL_RATIO,
               test_ratio: float = C.TEST_RATIO, seed=C.SEED) -> DataFrame:
    """Adds ``split`` in {train, val, test}."""
    x = msgs.withColumn("__h", seeded_hash(seed, "doc_id"))
    x = rank_by_hash(x, "label", "__h", "doc_id", rank_col="__rk", size_col="__n")
    n_test, n_val = split_counts(F.col("__n"), val_ratio, test_ratio)
    return x.withColumn(
        "split",
        F.when(F.col("__rk") <= n_test, "test")
        .when(F.col("__rk") <= n_test + n_val, "val")
        .otherwise("train"),
    ).drop("__h", "__rk", "__n")


def _largest_remainder(x: DataFrame, by: str) -> DataFrame:
    """Adds ``kept``: how many of a class's ``n`` rows are among ``stay`` of
    ``total``: the floor of the exact share, and one more for the largest
    remainders until all are given out (equal ones: in order of the label)."""
    whole = "(CAST(n AS DECIMAL(18, 0)) * CAST(stay AS DECIMAL(18, 0)))"
    everyone = Window.partitionBy(F.lit(0))                  # one row per class
    x = x.withColumn("share", F.expr(f"{whole} div CAST(total AS DECIMAL(18, 0))")) \
        .withColumn("rest", F.expr(f"{whole} % CAST(total AS DECIMAL(18, 0))"))
    missing = F.col("stay") - F.sum("share").over(everyone)
    turn = F.row_number().over(everyone.orderBy(F.col("rest").desc(), F.col(by)))
    return x.withColumn("kept", (F.col("share") + F.when(turn <= missing, 1).otherwise(0))
                        .cast("bigint"))


def allocated_sizes(classes: DataFrame, by: str, val_ratio: float = C.VAL_RATIO,
                    test_ratio: float = C.TEST_RATIO) -> DataFrame:
    """(class, n_test, n_val) from ``classes(class, n)``: test is cut off first,
    then val out of what is left; a part's total size is its share rounded up,
    and what stays is allocated to the classes by largest remainders."""
    everyone = Window.partitionBy(F.lit(0))                  # one row per class
    x = classes.withColumn("total", F.sum("n").over(everyone))
    for name, ratio in (("n_test", test_ratio), ("n_val", val_ratio / (1.0 - test_ratio))):
        x = x.withColumn("stay", F.col("total") - F.ceil(F.col("total") * ratio))
        x = _largest_remainder(x, by)
        x = x.withColumn(name, F.col("n") - F.col("kept"))
        x = x.withColumn("n", F.col("kept")).withColumn("total", F.col("stay"))
    return x.select(by, "n_test", "n_val")


def with_allocated_split(msgs: DataFrame, by: str = "label", val_ratio: float = C.VAL_RATIO,
                         test_ratio: float = C.TEST_RATIO, seed=C.SEED) -> DataFrame:
    """Adds ``split`` (W4) with the sizes of ``allocated_sizes`` over the
    classes of column ``by`` (NULL is a class)."""
    x = msgs.withColumn("__h", seeded_hash(seed, "doc_id")) \
            .withColumn("__by", F.coalesce(F.col(by).cast("string"), F.lit("")))
    sizes = allocated_sizes(x.groupBy("__by").agg(F.count(F.lit(1)).alias("n")), "__by",
                            val_ratio, test_ratio)
    x = rank_by_hash(x, "__by", "__h", "doc_id", rank_col="__rk", size_col="__n")
    x = x.join(F.broadcast(sizes), "__by")                   # one row per class
    return x.withColumn(
        "split",
        F.when(F.col("__rk") <= F.col("n_test"), "test")
        .when(F.col("__rk") <= F.col("n_test") + F.col("n_val"), "val")
        .otherwise("train"),
    ).drop("__h", "__by", "__rk", "__n", "n_test", "n_val")


def with_folds(msgs: DataFrame, k: int = C.K_FOLDS, seed=C.SEED) -> DataFrame:
    """Adds ``fold`` in 1..k (W5): ntile(k) within each class."""
    x = msgs.withColumn("__h", seeded_hash(seed, "doc_id"))
    x = rank_by_hash(x, "label", "__h", "doc_id", rank_col="__rk", size_col="__n")
    q = F.floor(F.col("__n") / k)
    m = F.col("__n") % k
    big = m * (q + 1)  # rows held by the first m (larger) folds
    r = F.col("__rk")
    fold = F.when(r <= big, F.floor((r - 1) / (q + 1)) + 1) \
            .otherwise(m + F.floor((r - big - 1) / q) + 1)
    return x.withColumn("fold", fold.cast("bigint")).drop("__h", "__rk", "__n")
