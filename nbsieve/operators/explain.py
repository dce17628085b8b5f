"""Explanations and traces.

Per-document rankings keep the k ends of a document in an aggregate; corpus
rankings use ``orderBy().limit()`` (per-partition top-k, then a merge) or
``top_k_per_group``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.internal import InternalFunction

from nbsieve import config as C
from nbsieve.functions import text as T
from nbsieve.operators import nb
from nbsieve.operators.vocab import log_ratio, strongest
from nbsieve.session import cut_lineage


def doc_evidence(model: nb.NBModel, tok: DataFrame, alpha: float = C.ALPHA,
                 unigrams_only: bool = False) -> DataFrame:
    """J6 per document: distinct in-vocabulary tokens with their log-ratio
    log P(w|spam) - log P(w|ham)."""
    if not model.broadcastable(nb.JOINED_BYTES):     # else one pass does, as it comes
        tok = nb.stored_terms(tok, ["doc_id"])
    rows = term_table(tok)
    if unigrams_only:
        rows = rows.where(~F.col("token").contains("_"))
    return nb.join_words(rows.select("doc_id", "token"), model,
                         lambda c: log_ratio(model, alpha, c).select("token", "score"), gather="doc_id") \
        .select("token", "doc_id", "score")


def term_table(tok: DataFrame) -> DataFrame:
    """One row per document and distinct token ``(doc_id, token, tf)``; of stored
    terms every pass over it reads them and none tokenises again."""
    if "terms" not in tok.columns:
        tok = T.add_term_frequencies(tok.select("doc_id", "tokens"), keep=["doc_id"])
    # explode_outer + filter: an inner explode would let the optimizer push
    # size(terms) > 0 below the run-length projections (see explode_tokens).
    return tok.select("doc_id", F.explode_outer("terms").alias("t")) \
        .where(F.col("t").isNotNull()).select("doc_id", "t.token", "t.tf")


def top_evidence(ev: DataFrame, k: int) -> DataFrame:
    """T4/T5: per document the k most spam-like (rank by score desc, token
    asc) and the k most ham-like (score asc, token desc) tokens. The two orders
    are opposite, so both are ends of one, and the aggregate keeps k rows a
    document and end: nothing is sorted but these."""
    key = F.struct((-F.col("score")).alias("s"), F.col("token"))
    g = ev.groupBy("doc_id").agg(InternalFunction.collect_top_k(key, k, True).alias("first"),
                                 InternalFunction.collect_top_k(key, k, False).alias("last"))
    g = g.select("doc_id", F.explode(F.array(
        F.struct(F.lit("spam").alias("side"), F.array_sort("first").alias("words")),
        F.struct(F.lit("ham").alias("side"), F.reverse(F.array_sort("last")).alias("words")))).alias("e"))
    g = g.select("doc_id", "e.side", F.posexplode("e.words").alias("at", "w"))
    return g.select("doc_id", "side", (F.col("at") + 1).alias("rank"), "w.token", (-F.col("w.s")).alias("score"))


def evidence_bars(ev: DataFrame, k: int = 5) -> DataFrame:
    """T5: unigram evidence with the bar width min(100, |s| * 20)."""
    return top_evidence(ev, k).withColumn("bar", F.least(F.lit(100.0), F.abs("score") * 20))


def corpus_top_words(model: nb.NBModel, k: int = 10, alpha: float = C.ALPHA) -> DataFrame:
    """The k highest and k lowest log-ratios of the vocabulary
    (TakeOrdered: per-partition top-k, merged)."""
    lr = log_ratio(model, alpha)
    top = lr.orderBy(F.desc("score"), F.asc("token")).limit(k) \
            .select(F.lit("spam").alias("side"), "token", "score")
    bot = lr.orderBy(F.asc("score"), F.desc("token")).limit(k) \
            .select(F.lit("ham").alias("side"), "token", "score")
    return top.unionByName(bot)


def prune_vocabulary(model: nb.NBModel, k: int = C.MAX_VOCAB_PRUNED,
                     alpha: float = C.ALPHA) -> DataFrame:
    """The k tokens with the largest |log-ratio|, ties in vocabulary
    (alphabetical) order; found by a histogram, not by a sort."""
    lr = cut_lineage(log_ratio(model, alpha).select("token", F.abs("score").alias("abs_score")))
    return strongest(lr, "abs_score", "token", k)


def pruned_counts(model: nb.NBModel, kept: DataFrame) -> DataFrame:
    """The count table restricted to the pruned words (left semi).
    Pruned-away words then score as unseen; V is unchanged."""
    return model.counts.join(kept.select("token"), "token", "left_semi")


def rounded(c: Column, digits: int | None) -> Column:
    """``c`` with so many decimals (None: as it is); no negative zero."""
    return c if digits is None else F.round(c, digits) + F.lit(0.0)


def per_class(df: DataFrame) -> DataFrame:
    """Every row once a class, with the column ``class``; ``of_class`` reads the
    values. The array is a constant: none is made for a row."""
    return df.select("*", F.explode(F.array(*[F.lit(c) for c in nb.CLASSES])).alias("class"))


def of_class(name: str) -> Column:
    """``<name>_<class>`` of the row's class."""
    spam, ham = F.col(f"{name}_spam"), F.col(f"{name}_ham")
    return F.when(F.col("class") == "spam", spam).otherwise(ham)


def multinomial_trace(model: nb.NBModel, tok: DataFrame, alpha: float = C.ALPHA,
                      digits: int | None = None) -> DataFrame:
    """Per document, class and distinct token: occurrences, the
    per-occurrence log-likelihood (the unseen value when outside the
    vocabulary, flagged), and one total row per (document, class) with the
    log prior and log posterior (token NULL). With ``digits`` all values are
    rounded, those of a token once a word where it occurs once."""
    a = float(alpha)
    none = {c: F.log(F.lit(a) / (F.col(f"ntok_{c}") + a * F.col("V"))) for c in nb.CLASSES}
    prior = {c: F.log(F.col(f"n_docs_{c}") / F.col("n_docs")) for c in nb.CLASSES}
    st = model.stats.select(*[x for c in nb.CLASSES for x in (
        none[c].alias(f"none_{c}"), rounded(none[c], digits).alias(f"shown_none_{c}"),
        prior[c].alias(f"prior_{c}"), rounded(prior[c], digits).alias(f"shown_prior_{c}"))])
    tok = nb.stored_terms(tok, ["doc_id"])
    rows = term_table(tok)

    def likelihoods(counts: DataFrame) -> DataFrame:
        """Per class the value and what is shown of it, in one column: rows and totals
        then read the same table of words, and it is broadcast once."""
        lp = [F.log((F.col(f"n_{c}") + a) / (F.col(f"ntok_{c}") + a * F.col("V"))) for c in nb.CLASSES]
        return counts.crossJoin(F.broadcast(model.stats.select("ntok_spam", "ntok_ham", "V"))) \
            .select("token", F.array(*lp, *[rounded(x, digits) for x in lp]).alias("w"))

    # One join for both classes; a row per class leaves it.
    j = nb.join_words(rows, model, likelihoods, "left").crossJoin(F.broadcast(st))
    value = {c: F.coalesce(F.get("w", F.lit(i)), F.col(f"none_{c}")) for i, c in enumerate(nb.CLASSES)}
    shown = {c: F.coalesce(F.get("w", F.lit(i + len(nb.CLASSES))), F.col(f"shown_none_{c}"))
             for i, c in enumerate(nb.CLASSES)}
    per_tok = per_class(j.select(
        "doc_id", "token", "tf", F.col("w").isNull().alias("unseen"), *[x for c in nb.CLASSES for x in (
            value[c].alias(f"lp_{c}"), shown[c].alias(f"shown_{c}"), F.col(f"shown_prior_{c}"))])).select(
        "doc_id", "class", "token", "tf", of_class("shown").alias("log_lik"), "unseen",
        F.when(F.col("tf") == 1, of_class("shown")).otherwise(
            rounded(F.col("tf") * of_class("lp"), digits)).alias("contribution"),
        of_class("shown_prior").alias("log_prior"), F.lit(None).cast("double").alias("log_posterior"))
    # Totals: the unseen value for every token, and what a vocabulary word adds to it.
    # Documents without tokens still have a total row (likelihood 0), copies one each. No
    # join: its filter of NULL keys would keep the totals from reading the rows' shuffles.
    adds = {c: F.coalesce(F.col("tf") * (F.get("w", F.lit(i)) - F.col(f"none_{c}")), F.lit(0.0))
            for i, c in enumerate(nb.CLASSES)}
    tot = j.select("doc_id", "tf", F.lit(0).alias("copies"), *[adds[c].alias(f"s_{c}") for c in nb.CLASSES]) \
        .unionByName(tok.select("doc_id", F.lit(0).alias("tf"), F.lit(1).alias("copies"),
                                *[F.lit(0.0).alias(f"s_{c}") for c in nb.CLASSES])) \
        .groupBy("doc_id").agg(F.sum("tf").alias("n"), F.sum("copies").cast("int").alias("copies"),
                               *[F.sum(f"s_{c}").alias(f"s_{c}") for c in nb.CLASSES])
    tot = tot.crossJoin(F.broadcast(st)).select(
        "doc_id", F.explode(F.array_repeat(F.lit(1), F.col("copies"))), *[x for c in nb.CLASSES for x in (
            F.when(F.col("doc_id").isNull(), 0.0).otherwise(F.col("n") * F.col(f"none_{c}") + F.col(f"s_{c}"))
            .alias(f"s_{c}"), F.col(f"prior_{c}"), F.col(f"shown_prior_{c}"))])
    tot = per_class(tot)
    tot = tot.select("doc_id", "class", F.lit(None).cast("string").alias("token"),
                     F.lit(None).cast("int").alias("tf"), F.lit(None).cast("double").alias("log_lik"),
                     F.lit(None).cast("boolean").alias("unseen"), rounded(of_class("s"), digits).alias("contribution"),
                     of_class("shown_prior").alias("log_prior"),
                     rounded(of_class("prior") + of_class("s"), digits).alias("log_posterior"))
    return per_tok.unionByName(tot)


def bernoulli_trace(model: nb.NBModel, tok: DataFrame, alpha: float = C.ALPHA,
                    digits: int | None = None) -> DataFrame:
    """I8: per document, class and distinct in-vocabulary token: log P
    present, log P absent, delta; one total row per (document, class) with
    baseline, delta sum, log-likelihood, log prior, log posterior. ``tok`` may hold
    the distinct tokens as ``words``, stored. With ``digits`` the values of a token
    are rounded: once a word, not once a row."""
    a = float(alpha)
    st = model.stats.select("n_docs_spam", "n_docs_ham", "n_docs")
    if "words" not in tok.columns:           # no frequency is asked for
        tok = tok.select("doc_id", F.col("terms.token").alias("words")) if "terms" in tok.columns else \
            cut_lineage(tok.select("doc_id", F.array_distinct("tokens").alias("words")))
    rows = nb.explode_tokens(tok, "words", ["doc_id"])

    def logs(counts: DataFrame) -> DataFrame:
        p = {c: nb.bernoulli_p(F.col(f"df_{c}"), F.col(f"n_docs_{c}"), F.lit(a)) for c in nb.CLASSES}
        return counts.crossJoin(F.broadcast(st)).select("token", *[
            x for c in nb.CLASSES for x in (F.log(p[c]).alias(f"in_{c}"), F.log(1 - p[c]).alias(f"out_{c}"))])

    def values(counts: DataFrame) -> DataFrame:
        return logs(counts).select("token", *[rounded(x, digits).alias(f"{n}_{c}") for c in nb.CLASSES for n, x in (
            ("in", F.col(f"in_{c}")), ("out", F.col(f"out_{c}")), ("delta", F.col(f"in_{c}") - F.col(f"out_{c}")))])

    def deltas(counts: DataFrame) -> DataFrame:
        return logs(counts).select("token", *[
            (F.col(f"in_{c}") - F.col(f"out_{c}")).alias(f"delta_{c}") for c in nb.CLASSES])

    # One join for both classes; a row per class leaves it.
    per_tok = per_class(nb.join_words(rows, model, values)).select(
        "doc_id", "class", "token", of_class("in").alias("log_p_present"),
        of_class("out").alias("log_p_absent"), of_class("delta").alias("delta"))
    dsum = nb.join_words(rows, model, deltas).groupBy("doc_id").agg(*[
        F.sum(f"delta_{c}").alias(f"s_{c}") for c in nb.CLASSES])
    consts = st.crossJoin(nb.bernoulli_baselines_wide(model, [a]))
    tot = tok.select("doc_id").join(dsum, "doc_id", "left").crossJoin(F.broadcast(consts))
    tot = tot.select("doc_id", F.explode(F.array(*[
        F.struct(F.lit(c).alias("class"), F.col(f"base_{c}_0").alias("baseline"),
                 F.coalesce(f"s_{c}", F.lit(0.0)).alias("delta_sum"),
                 F.log(F.col(f"n_docs_{c}") / F.col("n_docs")).alias("log_prior"))
        for c in nb.CLASSES])).alias("c")).select("doc_id", "c.*")
    tot = tot.withColumn("log_likelihood", F.col("baseline") + F.col("delta_sum")) \
             .withColumn("log_posterior", F.col("log_prior") + F.col("log_likelihood"))
    return per_tok, tot


def absent_sample(model: nb.NBModel, n: int = 10, seed=C.SEED, alpha: float = C.ALPHA) -> DataFrame:
    """A seeded, deterministic sample of n vocabulary words (md5 order)
    with P(absent|spam), P(absent|ham) and their ratio."""
    a = float(alpha)
    x = model.counts.crossJoin(F.broadcast(model.stats.select("n_docs_spam", "n_docs_ham")))
    ps = nb.bernoulli_p(F.col("df_spam"), F.col("n_docs_spam"), F.lit(a))
    ph = nb.bernoulli_p(F.col("df_ham"), F.col("n_docs_ham"), F.lit(a))
    h = F.md5(F.concat(F.lit(f"{seed}-"), F.col("token")))
    s = x.select("token", h.alias("__h"), (1 - ps).alias("p_absent_spam"), (1 - ph).alias("p_absent_ham"))
    return s.orderBy("__h").limit(n).select(
        "token", "p_absent_spam", "p_absent_ham",
        (F.col("p_absent_spam") / F.col("p_absent_ham")).alias("ratio"))


def word_trace(model: nb.NBModel, words: DataFrame, alpha: float = C.ALPHA) -> DataFrame:
    """For any word (unseen included): unpruned count per class,
    numerator count + a, denominator N_c + aV, probability."""
    a = float(alpha)
    st = model.stats.select("ntok_spam", "ntok_ham", "V")
    x = words.select("token").join(model.all_counts.select("token", "n_spam", "n_ham"), "token", "left") \
             .crossJoin(F.broadcast(st))
    cols = []
    for c in nb.CLASSES:
        cnt = F.coalesce(F.col(f"n_{c}"), F.lit(0))
        den = F.col(f"ntok_{c}") + a * F.col("V")
        cols += [cnt.alias(f"count_{c}"), (cnt + a).alias(f"numerator_{c}"),
                 den.alias(f"denominator_{c}"), ((cnt + a) / den).alias(f"p_{c}")]
    return x.select("token", *cols)


def vocabulary_probe(model: nb.NBModel, words: DataFrame) -> DataFrame:
    """Is each probe word in the vocabulary (left join + not null)?"""
    v = model.counts.select("token", F.lit(True).alias("__in"))
    return words.select("token").join(v, "token", "left") \
                .select("token", F.coalesce("__in", F.lit(False)).alias("in_vocabulary"))


def word_clouds(all_counts: DataFrame, n: int = 100) -> DataFrame:
    """Top-n words per class by count (ties token asc) with the
    cloud weight count / max count."""
    from nbsieve.operators.vocab import top_words_per_class
    t = top_words_per_class(all_counts, n)
    w = Window.partitionBy("label")
    return t.withColumn("weight", F.col("count") / F.max("count").over(w))
