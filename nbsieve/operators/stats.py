"""Statistical comparison.

* Student-t CDF for any integer degrees of freedom: the finite trigonometric
  series (Abramowitz & Stegun 26.7.3-4) as one fold over its terms;
  quantiles by bisection of the same series, also as a fold.
* chi-square(1) upper tail ``erfc(sqrt(x/2))``: Spark has no erfc, so the
  Maclaurin series below z = 2.5 and the continued fraction above it, again as
  folds. All of it runs on one-row-per-comparison aggregates.

A statistic that is not defined (fewer than two folds) gives a NULL p-value,
and a NULL p-value gives a NULL verdict.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nbsieve import config as C

BISECTIONS = 120


def t_abs_cdf(t: Column, nu: Column) -> Column:
    """A(t|nu) = P(|T| <= t) for t >= 0 and integer nu >= 1 (else NULL)."""
    nu = F.when(nu >= 1, nu.cast("double"))
    theta = F.atan(t / F.sqrt(nu))
    s, c = F.sin(theta), F.cos(theta)
    odd = (nu % 2) == 1
    terms = F.when(odd, (nu - 1) / 2).otherwise(nu / 2).cast("int")  # in the sum
    zero = F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("total"))

    def step(acc: Column, j: Column) -> Column:
        ratio = F.when(odd, 2 * j / (2 * j + 1)).otherwise((2 * j - 1) / (2 * j))
        return F.struct((acc["term"] * ratio * c * c).alias("term"),
                        (acc["total"] + acc["term"]).alias("total"))

    total = F.when(terms > 0, F.aggregate(F.sequence(F.lit(1), F.greatest(terms, F.lit(1))),
                                          zero, step)["total"]).otherwise(F.lit(0.0))
    value = F.when(odd, (2 / math.pi) * (theta + s * c * total)).otherwise(s * total)
    return value


def t_two_sided_p(t: Column, df: Column) -> Column:
    """Two-sided p-value 1 - A(|t| | df)."""
    return 1 - t_abs_cdf(F.abs(t), df)


def t_critical(n: Column, q: float = 0.975) -> Column:
    """Upper t quantile for df = n - 1 (n >= 2, else NULL): bisection on a
    logarithmic scale (the quantile of one degree of freedom bounds it)."""
    target = 2 * q - 1
    top = math.log(2 / (math.pi * (1 - q))) + 1.0
    zero = F.struct(F.lit(-top).alias("lo"), F.lit(top).alias("hi"))

    def halve(acc: Column, _: Column) -> Column:
        mid = (acc["lo"] + acc["hi"]) / 2
        low = t_abs_cdf(F.exp(mid), n - 1) < target
        return F.struct(F.when(low, mid).otherwise(acc["lo"]).alias("lo"),
                        F.when(low, acc["hi"]).otherwise(mid).alias("hi"))

    found = F.aggregate(F.sequence(F.lit(1), F.lit(BISECTIONS)), zero, halve)
    return F.when(n >= 2, F.exp((found["lo"] + found["hi"]) / 2))


def erfc(z: Column) -> Column:
    """Complementary error function for z >= 0."""
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(80)),
        F.struct(z.alias("term"), z.alias("total")),
        lambda a, j: F.struct((a["term"] * 2 * z * z / (2 * j + 1)).alias("term"),
                              (a["total"] + a["term"] * 2 * z * z / (2 * j + 1)).alias("total")))
    far = F.greatest(z, F.lit(2.5))
    fraction = F.aggregate(F.sequence(F.lit(120), F.lit(1), F.lit(-1)), far,
                           lambda a, j: far + (j / 2.0) / a)
    scale = F.exp(-z * z) / math.sqrt(math.pi)
    return F.when(z < 2.5, 1 - 2 * scale * series["total"]).otherwise(scale / fraction)


def chi2_1_upper_tail(x: Column) -> Column:
    """P(chi2_1 > x)."""
    return erfc(F.sqrt(x / 2.0))


def confidence_interval(df: DataFrame, value: str, by=()) -> DataFrame:
    """Mean +- t(0.975, n-1) * s / sqrt(n) (s = sample std)."""
    by = list(by)
    g = df.groupBy(*by).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
                            F.count(F.lit(1)).alias("n"))
    moe = t_critical(F.col("n")) * F.col("std") / F.sqrt("n")
    return g.select(*by, "mean", "std", "n", moe.alias("margin_of_error"),
                    (F.col("mean") - moe).alias("ci_lower"), (F.col("mean") + moe).alias("ci_upper"))


def paired_t_test(cv: DataFrame, model_a: str, model_b: str, value: str = "accuracy",
                  alpha: float = 0.05) -> DataFrame:
    """A27 over per-fold scores (J8: join on fold). A zero variance of the
    differences uses s_d = 1e-10, as the original does."""
    a = cv.where(F.col("model") == model_a).select("fold", F.col(value).alias("a"))
    b = cv.where(F.col("model") == model_b).select("fold", F.col(value).alias("b"))
    d = a.join(b, "fold").select((F.col("a") - F.col("b")).alias("d"))
    g = d.agg(F.avg("d").alias("mean_diff"), F.var_samp("d").alias("var"),
              F.count(F.lit(1)).alias("n"))
    sd = F.when(F.col("var") > 0, F.sqrt("var")).otherwise(F.lit(1e-10))
    t = F.col("mean_diff") / (sd / F.sqrt("n"))
    x = g.select(F.lit(model_a).alias("model_a"), F.lit(model_b).alias("model_b"), "mean_diff",
                 t.alias("t_statistic"), (F.col("n") - 1).cast("bigint").alias("df"))
    x = x.withColumn("p_value", t_two_sided_p(F.col("t_statistic"), F.col("df")))
    rej = F.col("p_value") < alpha
    return x.withColumn("reject_null", rej).withColumn(
        "conclusion",
        F.when(rej & (F.col("mean_diff") > 0), C.BETTER_THAN.format(model_a, model_b))
        .when(rej, C.BETTER_THAN.format(model_b, model_a))
        .when(~rej, C.NO_DIFFERENCE))


def mcnemar(scores: DataFrame, model_a: str, others=None, truth: str = "label",
            pred: str = "raw_prediction", alpha: float = 0.05) -> DataFrame:
    """A28 (J1: join predictions on doc_id): b = A right & B wrong,
    c = A wrong & B right; chi2 with continuity correction; b + c = 0 ->
    chi2 0, p 1."""
    a = scores.where(F.col("model") == model_a).select(
        "doc_id", (F.col(pred) == F.col(truth)).alias("a_ok"))
    b = scores.where(F.col("model") != model_a)
    if others:
        b = b.where(F.col("model").isin(*others))
    b = b.select("doc_id", F.col("model").alias("model_b"), (F.col(pred) == F.col(truth)).alias("b_ok"))
    j = a.join(b, "doc_id")
    g = j.groupBy("model_b").agg(F.count(F.when(F.col("a_ok") & ~F.col("b_ok"), 1)).alias("b"),
                                 F.count(F.when(~F.col("a_ok") & F.col("b_ok"), 1)).alias("c"))
    bc = F.col("b") + F.col("c")
    chi2 = F.when(bc == 0, F.lit(0.0)).otherwise(
        F.pow(F.abs(F.col("b") - F.col("c")) - 1, 2) / bc)
    x = g.select(F.lit(model_a).alias("model_a"), "model_b", "b", "c", chi2.alias("chi2"))
    x = x.withColumn("p_value", F.when(bc == 0, F.lit(1.0))
                     .otherwise(chi2_1_upper_tail(F.col("chi2"))))
    rej = F.col("p_value") < alpha
    return x.withColumn("reject_null", rej).withColumn(
        "conclusion",
        F.when(rej & (F.col("b") > F.col("c")), C.BETTER.format(model_a))
        .when(rej, F.concat(F.col("model_b"), F.lit(C.BETTER.format(""))))
        .when(~rej, C.NO_DIFFERENCE))
