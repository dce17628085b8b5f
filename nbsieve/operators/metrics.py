"""Classification metrics.

Input: a scores table with ``model``, ``label`` (truth) and a decided
``raw_prediction`` (spam/ham) plus ``p_spam`` for the curves. Positive
class is spam; any non-positive value is negative.

Curves and AUCs are computed on per-(model, score) aggregates with running
totals from ``running_totals`` -- never one task for a whole model. ``score``
is any column that orders the documents; scores of the models are ranked by
their log-odds (``nb.score(..., log_odds=True)``), which unlike probabilities
do not run together near 0 and 1. Scores count as they are, unrounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nbsieve import config as C
from nbsieve.operators.ordered import running_totals

POS = "spam"


def _div(a: Column, b: Column) -> Column:
    """Zero division -> 0 (as the metrics library is configured)."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def _f1(p: Column, r: Column) -> Column:
    return _div(2 * p * r, p + r)


def confusion(scores: DataFrame, by=("model",), truth: str = "label",
              pred: str = "raw_prediction") -> DataFrame:
    """A10: TP, TN, FP, FN per group."""
    t = F.col(truth) == POS
    p = F.col(pred) == POS
    return scores.groupBy(*by).agg(
        F.count(F.when(t & p, 1)).alias("tp"),
        F.count(F.when(~t & ~p, 1)).alias("tn"),
        F.count(F.when(~t & p, 1)).alias("fp"),
        F.count(F.when(t & ~p, 1)).alias("fn"),
    )


def report_columns() -> list[Column]:
    """A11 + A12 from tp/tn/fp/fn columns."""
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    n = tp + tn + fp + fn
    prec, rec = _div(tp, tp + fp), _div(tp, tp + fn)
    f1 = _f1(prec, rec)
    prec_h, rec_h = _div(tn, tn + fn), _div(tn, tn + fp)
    f1_h = _f1(prec_h, rec_h)
    sup_s, sup_h = tp + fn, tn + fp
    return [
        _div(tp + tn, n).alias("accuracy"),
        prec.alias("precision"), rec.alias("recall"), f1.alias("f1"),
        ((prec + prec_h) / 2).alias("macro_precision"),
        ((rec + rec_h) / 2).alias("macro_recall"),
        ((f1 + f1_h) / 2).alias("macro_f1"),
        _div(prec * sup_s + prec_h * sup_h, n).alias("weighted_precision"),
        _div(rec * sup_s + rec_h * sup_h, n).alias("weighted_recall"),
        _div(f1 * sup_s + f1_h * sup_h, n).alias("weighted_f1"),
    ]


def score_groups(scores: DataFrame, by=("model",), truth: str = "label",
                 score: str = "p_spam", previous: bool = False) -> DataFrame:
    """Distinct scores per group with positive/negative counts and the
    running totals needed by every curve: ``pos_le``/``neg_le`` (inclusive
    ascending) plus group totals ``P``/``N``."""
    by = list(by)
    t = (F.col(truth) == POS).cast("long")
    g = scores.groupBy(*by, F.col(score).alias("s")).agg(
        F.sum(t).alias("pos"), F.sum(1 - t).alias("neg"))
    rt = running_totals(g, by, "s", ["pos", "neg"], previous)
    tot = rt.groupBy(*by).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return rt.join(tot, by) if by else rt.crossJoin(F.broadcast(tot))


def curve_metrics(scores: DataFrame, by=("model",), truth: str = "label",
                  score: str = "p_spam") -> DataFrame:
    """A13 ROC-AUC (ties count half) and A14 average precision (step sum
    over distinct thresholds, descending); NULL when a class is absent."""
    by = list(by)
    g = score_groups(scores, by, truth, score)
    neg_below = F.col("cum_neg") - F.col("neg")
    tp_ge = F.col("P") - (F.col("cum_pos") - F.col("pos"))
    fp_ge = F.col("N") - neg_below
    x = g.groupBy(*by).agg(
        F.sum(F.col("pos") * (neg_below + F.col("neg") / 2.0)).alias("__auc"),
        F.sum(F.col("pos") * tp_ge / (tp_ge + fp_ge)).alias("__ap"),
        F.max("P").alias("P"), F.max("N").alias("N"))
    ok = (F.col("P") > 0) & (F.col("N") > 0)
    return x.select(*by,
                    F.when(ok, F.col("__auc") / (F.col("P") * F.col("N"))).alias("roc_auc"),
                    F.when(ok, F.col("__ap") / F.col("P")).alias("pr_auc"))


def evaluate(scores: DataFrame, by=("model",), truth: str = "label",
             pred: str = "raw_prediction", score: str = "p_spam") -> DataFrame:
    """L4: confusion + report + curve metrics, one row per group."""
    by = list(by)
    return report(scores, by, truth, pred).join(
        curve_metrics(scores, by, truth, score), by, "left")


def report(scores: DataFrame, by=("model",), truth: str = "label",
           pred: str = "raw_prediction") -> DataFrame:
    """Confusion counts and the report, without the curves."""
    by = list(by)
    return confusion(scores, by, truth, pred).select(*by, "tp", "tn", "fp", "fn", *report_columns())


def roc_points(scores: DataFrame, by=("model",), truth: str = "label",
               score: str = "p_spam", corners: bool = False) -> DataFrame:
    """(0,0) then one (fpr, tpr) per distinct threshold, descending.
    ``threshold`` is NULL for the start point. With ``corners`` a point goes if
    the next lower threshold adds as many positives and as many negatives as it
    did itself, for then it lies on a straight line between its neighbours; the
    points of the highest and the lowest threshold stay."""
    by = list(by)
    g = score_groups(scores, by, truth, score, previous=corners)
    if corners:
        first = (F.col("cum_pos") == F.col("P")) & (F.col("cum_neg") == F.col("N"))
        bends = (F.col("prev_pos") != F.col("pos")) | (F.col("prev_neg") != F.col("neg"))
        g = g.where(first | F.col("prev_pos").isNull() | bends)
    tp_ge = F.col("P") - (F.col("cum_pos") - F.col("pos"))
    fp_ge = F.col("N") - (F.col("cum_neg") - F.col("neg"))
    pts = g.select(*by, F.col("s").alias("threshold"),
                   _div(fp_ge, F.col("N")).alias("fpr"), _div(tp_ge, F.col("P")).alias("tpr"))
    start = g.select(*by).distinct().select(*by, F.lit(None).cast("double").alias("threshold"),
                                             F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return pts.unionByName(start)


def pr_points(scores: DataFrame, by=("model",), truth: str = "label",
              score: str = "p_spam") -> DataFrame:
    """precision/recall per distinct threshold (ascending) plus the end
    point (recall 0, precision 1, threshold NULL)."""
    by = list(by)
    g = score_groups(scores, by, truth, score)
    tp_ge = F.col("P") - (F.col("cum_pos") - F.col("pos"))
    fp_ge = F.col("N") - (F.col("cum_neg") - F.col("neg"))
    rec = F.when(F.col("P") == 0, F.lit(1.0)).otherwise(tp_ge / F.col("P"))
    pts = g.select(*by, F.col("s").alias("threshold"),
                   _div(tp_ge, tp_ge + fp_ge).alias("precision"), rec.alias("recall"))
    end = g.select(*by).distinct().select(*by, F.lit(None).cast("double").alias("threshold"),
                                           F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def tuned_threshold(scores: DataFrame, by=("model",), truth: str = "label",
                    score: str = "p_spam", min_precision: float = C.THRESHOLD_MIN_PRECISION,
                    min_recall: float = C.THRESHOLD_MIN_RECALL,
                    default: float = 0.5) -> DataFrame:
    """Lowest threshold meeting both targets, else ``default``."""
    by = list(by)
    p = pr_points(scores, by, truth, score).where(F.col("threshold").isNotNull())
    ok = (F.col("precision") >= min_precision) & (F.col("recall") >= min_recall)
    groups = scores.select(*by).distinct()
    best = p.where(ok).groupBy(*by).agg(F.min("threshold").alias("__t"))
    return groups.join(best, by, "left").select(
        *by, F.coalesce(F.col("__t"), F.lit(float(default))).alias("threshold"))


def error_breakdown(scores: DataFrame, by=("model",), truth: str = "label",
                    pred: str = "raw_prediction") -> DataFrame:
    """TP/TN/FP/FN per model in long form."""
    by = list(by)
    cm = confusion(scores, by, truth, pred)
    return cm.select(*by, F.expr("stack(4, 'TP', tp, 'TN', tn, 'FP', fp, 'FN', fn)")
                     .alias("outcome", "count"))
