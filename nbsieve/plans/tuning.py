"""Smoothing search (L2, T8a, T8b, J11) and k-fold cross-validation (L3).

* Alpha sweep: every alpha of the grid is a set of aggregate columns (the
  grid is a bounded parameter list), not a copy of the data; a scoring pass
  takes as many alphas as fit one compiled method.
* Cross-validation without refits: counts per (fold, token) are computed
  once; the training counts of fold f are ``total - fold f``. The
  vocabulary of fold f is ``df_train >= min_df`` and ``df_train / N_train
  <= max_df`` (built from the training folds only). Every document is
  scored by the model of its own fold: the join key is (fold, token). All
  folds run as one job.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nbsieve import config as C
from nbsieve.operators import metrics as M
from nbsieve.operators import nb
from nbsieve.operators.split import with_folds
from nbsieve.session import cut_lineage

# ---------------------------------------------------------------------------
# Alpha sweep
# ---------------------------------------------------------------------------

ALPHAS_A_PASS = 9          # 36 sums; beyond, a stage may outgrow one compiled method


def alpha_sweep(model: nb.NBModel, tok_eval: DataFrame, alphas,
                models=("multinomial", "bernoulli"),
                decision_threshold: float = C.DECISION_THRESHOLD) -> DataFrame:
    """Per (model, alpha): confusion counts, accuracy, precision, recall, F1
    on the evaluation documents (predictions at ``decision_threshold``)."""
    alphas = [float(a) for a in alphas]
    if len(alphas) > ALPHAS_A_PASS:
        out = None
        for k in range(0, len(alphas), ALPHAS_A_PASS):
            x = alpha_sweep(model, tok_eval, alphas[k:k + ALPHAS_A_PASS], models, decision_threshold)
            out = x if out is None else out.unionByName(x)
        return out
    frame = nb.with_model_constants(
        nb.scored_frame(model, tok_eval, alphas, keep=("doc_id", "label"), with_features=False),
        model, alphas)
    structs = []
    for i, a in enumerate(alphas):
        lps = nb.log_posteriors(frame, model, alphas, models, i)
        for k, m in enumerate(models):
            ls, lh = lps[2 * k + 1], lps[2 * k]  # order: ham, spam per model
            structs.append(F.struct(F.lit(m).alias("model"), F.lit(a).alias("alpha"),
                                    ls.alias("ls"), lh.alias("lh")))
    # The posterior follows the generator: its terms are written out once.
    x = frame.select("doc_id", "label", "n_tokens", F.explode(F.array(*structs)).alias("s")) \
             .select("doc_id", "label", "s.model", "s.alpha",
                     *nb.posterior_struct(F.col("s.ls"), F.col("s.lh"), F.col("n_tokens")))
    x = x.withColumn("raw_prediction",
                     F.when(F.col("p_ham") > decision_threshold, "ham").otherwise("spam"))
    cm = M.confusion(x, ["model", "alpha"])
    return cm.select("model", "alpha", "tp", "tn", "fp", "fn", *M.report_columns()[:4])


def best_alpha(sweep: DataFrame, metric: str = "f1", default: float | None = None,
               floor: float | None = None) -> DataFrame:
    """Per model, the alpha with the highest ``metric``; the grid is
    scanned in ascending order and the first (smallest) alpha wins ties.
    With ``floor`` set, only a value strictly above it counts (else
    ``default``)."""
    x = sweep if floor is None else sweep.where(F.col(metric) > floor)
    best = x.groupBy("model").agg(
        F.max_by("alpha", F.struct(F.col(metric), -F.col("alpha"))).alias("alpha"),
        F.max(metric).alias(f"best_{metric}"))
    if default is None:
        return best
    models = sweep.select("model").distinct()
    return models.join(best, "model", "left").select(
        "model", F.coalesce("alpha", F.lit(float(default))).alias("alpha"), f"best_{metric}")


# ---------------------------------------------------------------------------
# Cross-validation
# ---------------------------------------------------------------------------

def fold_models(tok: DataFrame, k: int, min_df: int = C.MIN_DF, max_df: float = C.MAX_DF):
    """Training counts per fold = totals - fold counts, from ONE
    aggregation by token: conditional sums per (fold, class) give a bounded
    set of 4k columns; a generator then emits, per token, the k training
    rows (no token x fold join). The '' sentinel carries the document
    counts. Returns ``(vocab_f(fold, token, n_*, df_*), stats_f(fold,
    n_docs_*, ntok_*, n_docs, V), over_f(fold, token))``, the last one the few
    words too frequent for a fold's vocabulary."""
    x = nb.term_rows(tok, ["fold", "label"], sentinel=True)
    cnt = ["n_spam", "n_ham", "df_spam", "df_ham"]
    aggs = []
    for f in range(1, k + 1):
        for c in nb.CLASSES:
            sel = (F.col("fold") == f) & (F.col("label") == c)
            aggs.append(F.sum(F.when(sel, F.col("tf")).otherwise(0)).alias(f"n_{c}_{f}"))
            aggs.append(F.sum(F.when(sel, F.col("d")).otherwise(0)).alias(f"df_{c}_{f}"))
    wide = x.groupBy("token").agg(*aggs)
    tot = {c: sum((F.col(f"{c.split('_')[0]}_{c.split('_')[1]}_{f}") for f in range(1, k + 1)),
                  F.lit(0)) for c in cnt}
    total_df = tot["df_spam"] + tot["df_ham"]
    # A token below min_df overall can never enter a fold vocabulary.
    wide = wide.where((total_df >= min_df) | (F.col("token") == ""))
    per_fold = F.array(*[
        F.struct(F.lit(f).cast("long").alias("fold"),
                 *[(tot[c] - F.col(f"{c.split('_')[0]}_{c.split('_')[1]}_{f}")).cast("long").alias(c)
                   for c in cnt])
        for f in range(1, k + 1)])
    # One row per token is stored; the k rows of it are made as they are read.
    train = cut_lineage(wide).select("token", F.explode(per_fold).alias("r")) \
        .select(F.col("r.fold").alias("fold"), "token", *[F.col(f"r.{c}").alias(c) for c in cnt])
    docs = train.where(F.col("token") == "").select(
        "fold", F.col("df_spam").alias("n_docs_spam"), F.col("df_ham").alias("n_docs_ham"))
    # Class token totals of the training folds (every token, pruned ones too).
    ntok = tok.select("fold", "label", F.size("tokens").alias("n")).groupBy("fold").agg(
        *[F.sum(F.when(F.col("label") == c, F.col("n")).otherwise(0)).alias(f"f_{c}")
          for c in nb.CLASSES])
    allt = ntok.agg(*[F.sum(f"f_{c}").alias(f"a_{c}") for c in nb.CLASSES])
    ntok = ntok.crossJoin(allt).select(
        "fold", *[(F.col(f"a_{c}") - F.col(f"f_{c}")).alias(f"ntok_{c}") for c in nb.CLASSES])
    docs = docs.join(ntok, "fold").withColumn("n_docs", F.col("n_docs_spam") + F.col("n_docs_ham"))
    d = F.col("df_spam") + F.col("df_ham")
    known = train.join(F.broadcast(docs.select("fold", "n_docs")), "fold") \
        .where((F.col("token") != "") & (d >= min_df))
    over = d / F.col("n_docs") > max_df
    vocab = cut_lineage(known.where(~over).select("fold", "token", *cnt))
    v = vocab.groupBy("fold").agg(F.count(F.lit(1)).alias("V"))
    stats = docs.join(v, "fold", "left").select(
        "*", F.coalesce(F.col("V"), F.lit(0)).alias("__v")).drop("V") \
        .withColumnRenamed("__v", "V")
    return vocab, stats, known.where(over).select("fold", "token")


def _deviation(f: str):
    """Adds a part's n (mean - whole mean)^2 of feature ``f``."""
    return lambda s, p: s + p["n"] * F.pow(p[f"mu_{f}"] - F.col(f"mean_{f}"), 2)


def fold_gaussian(docs: DataFrame, k: int, alpha: float = C.ALPHA) -> DataFrame:
    """A9 per fold over the training folds, from one row per document with its
    features: count, mean and squared deviations per (fold, class), then the
    other folds' moments merged pairwise-exactly (k rows, no copy of a
    document). A training fold set without a class has NULL moments."""
    feats = list(C.GAUSSIAN_FEATURES)
    per = docs.groupBy("fold", "label").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(f).alias(f"mu_{f}") for f in feats],
        *[(F.var_pop(f) * F.count(f)).alias(f"m2_{f}") for f in feats])
    folds = docs.sparkSession.range(1, k + 1).select(F.col("id").alias("f"))
    x = per.join(F.broadcast(folds), F.col("f") != F.col("fold"))   # at most k * k * 2 rows
    merged = x.groupBy("f", "label").agg(
        F.sum("n").alias("N"),
        *[(F.sum(F.col("n") * F.col(f"mu_{f}")) / F.sum("n")).alias(f"mean_{f}") for f in feats],
        *[F.sum(f"m2_{f}").alias(f"within_{f}") for f in feats],
        F.collect_list(F.struct("n", *[f"mu_{f}" for f in feats])).alias("parts"))
    out = [F.col("f").alias("fold"), "label"]
    for f in feats:
        between = F.aggregate("parts", F.lit(0.0), _deviation(f))
        out += [F.col(f"mean_{f}").alias(f"mu_{f}"),
                ((F.col(f"within_{f}") + between) / F.col("N")).alias(f"v_{f}")]
    m = merged.select(*out)
    aggs = []
    for c in nb.CLASSES:
        for f in feats:
            pick = lambda col, c=c: F.max(F.when(F.col("label") == c, F.col(col)))
            aggs += [pick(f"mu_{f}").alias(f"g_mu_{c}_{f}"),
                     (pick(f"v_{f}") + alpha * C.GAUSSIAN_VAR_EPS).alias(f"g_var_{c}_{f}")]
    return m.groupBy("fold").agg(*aggs)


def cross_validate(msgs: DataFrame, k: int = C.K_FOLDS, alphas=None,
                   models=("multinomial", "bernoulli", "gaussian"),
                   seed=C.SEED, min_df: int = C.MIN_DF, max_df: float = C.MAX_DF) -> DataFrame:
    """L3: per (model, fold): n, tp, tn, fp, fn, accuracy. ``alphas`` maps
    model -> alpha (default 1.0 each). Predictions at threshold 0.5."""
    alphas = {m: 1.0 for m in models} | dict(alphas or {})
    if {"tokens", "fold"} <= set(msgs.columns):  # stored with folds (the prepared set)
        tok = msgs
    elif "tokens" in msgs.columns:
        # Folds are ranked on (doc_id, label) alone and joined to the tokens.
        fold = with_folds(msgs.select("doc_id", "label"), k=k, seed=seed).select("doc_id", "fold")
        tok = cut_lineage(msgs.select("doc_id", "label", "tokens").join(fold, "doc_id"))
    else:
        tok = cut_lineage(nb.tokenize(
            with_folds(msgs, k=k, seed=seed).select("doc_id", "label", "fold", "text")))
    vocab, stats, over = fold_models(tok, k, min_df, max_df)
    a_m, a_b = float(alphas.get("multinomial", 1.0)), float(alphas.get("bernoulli", 1.0))
    n_docs = F.broadcast(stats.select("fold", "n_docs_spam", "n_docs_ham"))
    p = {c: nb.bernoulli_p(F.col(f"df_{c}"), F.col(f"n_docs_{c}"), F.lit(a_b)) for c in nb.CLASSES}

    def weights(v: DataFrame) -> DataFrame:
        return v.join(n_docs, "fold").select("fold", "token", *[w for c in nb.CLASSES for w in (
            (F.log(F.col(f"n_{c}") + a_m) - math.log(a_m)).alias(f"m_{c}"),
            (F.log(p[c]) - F.log(1 - p[c])).alias(f"b_{c}"))])

    base = vocab.join(n_docs, "fold").groupBy("fold").agg(
        *[F.sum(F.log(1 - p[c])).alias(f"base_{c}") for c in nb.CLASSES])
    # The frequent (fold, word) pairs are broadcast; the others are joined by a shuffle.
    t = nb.make_tiers(vocab, vocab.count(), 112, lambda: cut_lineage(over), ("fold", "token"))
    if t.cold is not None:
        tok = nb.stored_terms(tok, ["doc_id", "label", "fold"])
    x = nb.term_rows(tok, ["doc_id", "label", "fold"])
    names = [(w, c) for w in ("m", "b") for c in nb.CLASSES]
    sums = [(F.col({"m": "tf", "b": "d"}[w]) * F.col(f"{w}_{c}")).alias(f"w{w}_{c}") for w, c in names]
    j = nb.weighted_rows(x, ["doc_id", "label", "fold"], sums, weights, t)
    # One pass per document: model sums and the Gaussian features (exact
    # aggregates); a small table (one row per document), checkpointed
    # because it feeds both the per-fold moments and the scoring.
    sums = j.groupBy("doc_id", "label", "fold", "n_tokens").agg(*[
        F.coalesce(F.sum(f"w{w}_{c}"), F.lit(0.0)).alias(f"w{w}_{c}") for w, c in names],
        *nb.feature_aggregates())
    sums = cut_lineage(sums.select(*[c for c in sums.columns if not c.startswith("__")],
                                   *nb.features_from_aggregates()))
    gstats = fold_gaussian(sums, k, alphas.get("gaussian", 1.0))
    gstats = gstats.select(*nb.gaussian_constant_columns(gstats.columns))
    fr = sums.join(F.broadcast(stats), "fold").join(F.broadcast(base), "fold", "left") \
        .join(F.broadcast(gstats), "fold")
    prior = {c: F.log(F.col(f"n_docs_{c}") / F.col("n_docs")) for c in nb.CLASSES}
    lp = {}
    for c in nb.CLASSES:
        lp[("multinomial", c)] = prior[c] + F.col(f"wm_{c}") + F.col("n_tokens") * (
            math.log(a_m) - F.log(F.col(f"ntok_{c}") + a_m * F.col("V")))
        lp[("bernoulli", c)] = prior[c] + F.coalesce(F.col(f"base_{c}"), F.lit(0.0)) + F.col(f"wb_{c}")
        lp[("gaussian", c)] = prior[c] + nb.gaussian_log_likelihood(c)
    structs = [F.struct(F.lit(m).alias("model"), lp[(m, "spam")].alias("ls"),
                        lp[(m, "ham")].alias("lh")) for m in models]
    s = fr.select("doc_id", "label", "fold", "n_tokens", F.explode(F.array(*structs)).alias("s")) \
          .select("doc_id", "label", "fold", "s.model",
                  *nb.posterior_struct(F.col("s.ls"), F.col("s.lh"), F.col("n_tokens")))
    s = s.withColumn("raw_prediction", F.when(F.col("p_ham") > 0.5, "ham").otherwise("spam"))
    cm = M.confusion(s, ["model", "fold"])
    n = F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")
    return cm.select("model", "fold", n.alias("n"), "tp", "tn", "fp", "fn",
                     ((F.col("tp") + F.col("tn")) / n).alias("accuracy"))


def cv_summary(cv: DataFrame) -> DataFrame:
    """Mean and sample standard deviation of the fold accuracies."""
    return cv.groupBy("model").agg(F.avg("accuracy").alias("cv_mean_acc"),
                                   F.stddev_samp("accuracy").alias("cv_std_acc"))
