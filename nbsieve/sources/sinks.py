"""Sinks (K1, K4, K5, L6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# FIXED VALUES: summary column names, in file order.
SUMMARY_COLUMNS = (
    ("model", "Model"), ("accuracy", "Accuracy"), ("precision", "Precision"),
    ("recall", "Recall"), ("f1", "F1-Score"), ("macro_f1", "Macro F1"),
    ("weighted_f1", "Weighted F1"), ("roc_auc", "ROC-AUC"), ("pr_auc", "PR-AUC"),
    ("cv_mean_acc", "CV Mean Acc"), ("cv_std_acc", "CV Std Acc"),
)


def summary(metrics: DataFrame, cv_summary: DataFrame) -> DataFrame:
    """K1: one row per model: test metrics joined with the CV mean and
    sample standard deviation (models without CV keep NULLs)."""
    return metrics.join(cv_summary, "model", "left").select(*[c for c, _ in SUMMARY_COLUMNS])


def write_summary_csv(summary_df: DataFrame, path: str) -> None:
    """K1 file: header row with the published column names. The table has
    one row per model, so a single output file is written."""
    out = summary_df.select(*[F.col(c).alias(h) for c, h in SUMMARY_COLUMNS])
    out.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_messages_csv(msgs: DataFrame, path: str) -> None:
    """K4: normalised ``(label, text)`` rows as CSV (parallel part files)."""
    msgs.select("label", "text").write.mode("overwrite").option("header", True) \
        .option("escape", '"').csv(path)


def metrics_long(metrics: DataFrame, cols) -> DataFrame:
    """Wide metrics -> (model, metric, value) for charts."""
    return metrics.unpivot("model", list(cols), "metric", "value")


def write_series(df: DataFrame, path: str) -> None:
    """K5: chart series (ROC/PR points, confusion, CV, top words) as Parquet."""
    df.write.mode("overwrite").parquet(path)


def chart_series(scores: DataFrame, words: DataFrame, score: str = "p_spam") -> DataFrame:
    """K5: ``(series, model, name, x, y)``: ROC and PR points, confusion
    counts, and the top words per class (x: rank, y: count)."""
    from nbsieve.operators import metrics as M
    none, num = F.lit(None).cast("string"), F.lit(None).cast("double")
    roc = M.roc_points(scores, score=score).select(
        F.lit("roc").alias("series"), "model", none.alias("name"), F.col("fpr").alias("x"),
        F.col("tpr").alias("y"))
    pr = M.pr_points(scores, score=score).select(
        F.lit("pr").alias("series"), "model", none.alias("name"), F.col("recall").alias("x"),
        F.col("precision").alias("y"))
    cm = M.confusion(scores).unpivot("model", ["tp", "tn", "fp", "fn"], "name", "v").select(
        F.lit("confusion").alias("series"), "model", "name", num.alias("x"),
        F.col("v").cast("double").alias("y"))
    top = words.select(F.lit("top_words").alias("series"), F.col("label").alias("model"),
                       F.col("token").alias("name"), F.col("rank").cast("double").alias("x"),
                       F.col("count").cast("double").alias("y"))
    return roc.unionByName(pr).unionByName(cm).unionByName(top)
