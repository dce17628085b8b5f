"""Three-model ensemble (I6, A30, A31) and label-noise analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nbsieve import config as C
from nbsieve.operators import rules as R


def ensemble(scores: DataFrame, weights: DataFrame, boosts: DataFrame,
             ham_threshold: float = C.REQUEST_THRESHOLD) -> DataFrame:
    """I6 over long scores ``(doc_id, model, p_spam, prediction)`` computed
    at ``decision_threshold = ham_threshold`` and confidence 0.70, model
    weights ``(model, weight)`` (F1 on the test split) and per-document
    sender boosts ``(doc_id, boost)``.

    A30: weighted P(spam) = sum(w p) / sum(w); the sender boost is then
    always applied; spam iff > 1 - ham_threshold; confidence = p or 1 - p.
    A31: consensus iff at most one distinct non-uncertain prediction.
    The weights table has one row per model (broadcast, bounded)."""
    x = scores.join(F.broadcast(weights), "model")
    g = x.groupBy("doc_id").agg(
        (F.sum(F.col("weight") * F.col("p_spam")) / F.sum("weight")).alias("weighted_p_spam"),
        F.count_distinct(F.when(F.col("prediction") != "uncertain", F.col("prediction")))
        .alias("__n_pred"))
    g = g.join(boosts, "doc_id", "left")
    p = R.apply_boost(F.col("weighted_p_spam"), F.coalesce(F.col("boost"), F.lit(0.0)))
    g = g.withColumn("p_spam", p)
    spam = F.col("p_spam") > 1 - ham_threshold
    return g.select(
        "doc_id", "weighted_p_spam", "p_spam",
        F.when(spam, "spam").otherwise("ham").alias("prediction"),
        F.when(spam, F.col("p_spam")).otherwise(1 - F.col("p_spam")).alias("confidence"),
        (F.col("__n_pred") <= 1).alias("consensus"))


def label_noise(scores: DataFrame, truth: str = "label") -> DataFrame:
    """I4: category per document from confidence-gated scores:
    confident & argmax == label -> confident_correct, confident & !=
    -> confident_wrong, else uncertain (argmax ties go to ham)."""
    argmax = F.when(F.col("p_spam") > F.col("p_ham"), "spam").otherwise("ham")
    cat = F.when(~F.col("is_confident"), "uncertain") \
           .when(argmax == F.col(truth), "confident_correct").otherwise("confident_wrong")
    return scores.withColumn("argmax", argmax).withColumn("category", cat)


def noise_summary(noise: DataFrame, by=("model",)) -> DataFrame:
    """Counts and percentages per category (all three categories)."""
    by = list(by)
    cats = noise.sparkSession.createDataFrame(
        [("confident_correct",), ("confident_wrong",), ("uncertain",)], "category string")
    tot = noise.groupBy(*by).agg(F.count(F.lit(1)).alias("total"))
    cnt = noise.groupBy(*by, "category").agg(F.count(F.lit(1)).alias("n"))
    grid = tot.crossJoin(F.broadcast(cats))
    x = grid.join(cnt, by + ["category"], "left")
    n = F.coalesce(F.col("n"), F.lit(0))
    return x.select(*by, "category", n.alias("n"), "total", (n / F.col("total") * 100).alias("pct"))


def noise_examples(noise: DataFrame, tokens: DataFrame, by=("model",), k: int = 5) -> DataFrame:
    """The first ``k`` documents (by doc_id) of each non-correct
    category with a preview of their first ten tokens. The ranking window
    is per (model, category) but only keeps k rows per hash sub-group
    first, so no category is ranked in one task."""
    from nbsieve.operators.vocab import top_k_per_group
    by = list(by)
    x = noise.where(F.col("category") != "confident_correct") \
             .withColumn("__g", F.concat_ws("|", *by, "category"))
    top = top_k_per_group(x, "__g", [F.asc("doc_id")], k, rank_col="example_rank").drop("__g")
    prev = tokens.select("doc_id", F.array_join(F.slice("tokens", 1, 10), " ").alias("tokens_preview"))
    return top.join(prev, "doc_id")


def smoke_errors(scores: DataFrame, truth: str = "label", by=("model",)) -> DataFrame:
    """Messages and wrong verdicts per model, an uncertain verdict
    resolved by the larger probability (ties go to ham)."""
    verdict = F.when(F.col("prediction") != "uncertain", F.col("prediction")) \
        .when(F.col("p_spam") > F.col("p_ham"), "spam").otherwise("ham")
    return scores.groupBy(*by).agg(F.count(F.lit(1)).alias("n"),
                                   F.count(F.when(verdict != F.col(truth), 1)).alias("errors"))
