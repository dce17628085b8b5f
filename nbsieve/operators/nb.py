"""Naive Bayes as count tables.

The model is data, not code:

* ``counts(token, n_spam, n_ham, df_spam, df_ham)`` over the vocabulary;
* ``stats``: one row with class document counts, class token totals
  (``N_c`` counts *every* token, including those pruned from the
  vocabulary), the vocabulary size ``V`` and the Gaussian moments.

Smoothing ``alpha`` is applied at scoring time, so one trained table serves
every alpha. Scoring uses two identities:

* multinomial: ``LL_c(d) = n_d (ln a - ln(N_c + aV)) + sum_{t in d and V}
  tf (ln(n(t,c) + a) - ln a)`` -- tokens outside the vocabulary add a
  constant, so only in-vocabulary terms need the join;
* Bernoulli: ``LL_c(d) = sum_V ln(1-p) + sum_{t in set(d) and V} (ln p -
  ln(1-p))`` with the baseline computed once per alpha.

The join is a broadcast hash join when the vocabulary is small enough
(size checked). A larger one goes in two tiers: its most frequent words, as many
as may be broadcast, and the others, to which only rows are shuffled that
have no frequent word and pass a bit filter of the others. The per-document regroup follows an explode of one row, so the
map-side partial aggregation collapses it before the shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nbsieve import config as C
from nbsieve.functions import text as T
from nbsieve.session import cut_lineage, setting

MODELS = ("multinomial", "bernoulli", "gaussian")
CLASSES = ("ham", "spam")


# ---------------------------------------------------------------------------
# Tokenised documents
# ---------------------------------------------------------------------------

def tokenize(df: DataFrame, text_col: str = "text", lemmas: DataFrame | None = None,
             keep=None) -> DataFrame:
    """Adds ``tokens`` (F9). ``keep`` = columns to keep (default all but text)."""
    return T.add_tokens(df, text_col, "tokens", lemmas, keep=keep)


# ---------------------------------------------------------------------------
# Training
# ---------------------------------------------------------------------------

COUNT_SPLIT = 32 << 20      # bytes of stored tokens that one task counts
_SENTINEL = ""  # never a real token (tokens have length > 1)


def explode_tokens(tok: DataFrame, arr, keep) -> DataFrame:
    """One row per array element. ``explode_outer`` + a null filter: an
    inner explode makes the optimizer infer ``size(tokens) > 0`` and push
    it below the tokeniser projection, which would tokenise twice."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return tok.select(*keep, F.explode_outer(a).alias("token")) \
              .where(F.col("token").isNotNull())


def term_rows(tok: DataFrame, keep, sentinel: bool = False) -> DataFrame:
    """One row per document and distinct token: ``tf``, the occurrences, and
    ``d`` = 1. A document without tokens has one row with a NULL token and 0 in
    both; with ``sentinel`` every document also has a row of the token '' (tf 0).

    Frequencies are read where ``tok`` holds ``terms``, else formed in the row."""
    if "terms" in tok.columns:
        x = tok.select(*keep, F.aggregate("terms", F.lit(0), lambda n, t: n + t["tf"])
                       .alias("n_tokens"), "terms")
    else:
        x = T.add_term_frequencies(tok.select(*keep, F.size("tokens").alias("n_tokens"), "tokens"),
                                   keep=[*keep, "n_tokens"])
    terms = F.col("terms")
    if sentinel:
        terms = F.concat(terms, F.array(F.struct(F.lit(_SENTINEL).alias("token"),
                                                 F.lit(0).alias("tf"))).cast(T.TERMS_TYPE))
    # ``explode_outer``: an inner one would push a size filter below the tokeniser.
    x = x.select(*keep, "n_tokens", F.explode_outer(terms).alias("t"))
    return x.select(*keep, "n_tokens", "t.token", F.coalesce("t.tf", F.lit(0)).alias("tf"),
                    F.when(F.col("t").isNotNull(), 1).otherwise(0).alias("d"))


def token_class_counts(tok: DataFrame) -> DataFrame:
    """A4+A5 in one aggregation: ``(token, n_spam, n_ham, df_spam, df_ham)``
    over all tokens of labelled documents.

    One generator per row yields the distinct tokens of the row with their
    frequencies (formed in the row, so no per-document shuffle) and one sentinel
    ``''`` (its document frequency is the class document count). Map-side
    partial aggregation collapses hot tokens before the only shuffle."""
    sp = F.col("label") == "spam"
    x = term_rows(tok, ["label"], sentinel=True)
    return x.groupBy("token").agg(
        F.sum(F.when(sp, F.col("tf")).otherwise(0)).cast("bigint").alias("n_spam"),
        F.sum(F.when(~sp, F.col("tf")).otherwise(0)).cast("bigint").alias("n_ham"),
        F.sum(F.when(sp, F.col("d")).otherwise(0)).cast("bigint").alias("df_spam"),
        F.sum(F.when(~sp, F.col("d")).otherwise(0)).cast("bigint").alias("df_ham"),
    )


def gaussian_moments(tok: DataFrame, var_eps: float = C.GAUSSIAN_VAR_EPS,
                     alpha: float = C.ALPHA) -> DataFrame:
    """One row; per class and feature the mean and the population
    variance + alpha*eps. Columns ``g_mu_<cls>_<f>`` / ``g_var_<cls>_<f>``."""
    x = tok.select("label", *T.gaussian_features(F.col("tokens"))) if "terms" not in tok.columns else \
        tok.select("label", *term_aggregates()).select("label", *features_from_aggregates())
    aggs = []
    for cls in CLASSES:
        for f in C.GAUSSIAN_FEATURES:
            v = F.when(F.col("label") == cls, F.col(f))
            aggs.append(F.avg(v).alias(f"g_mu_{cls}_{f}"))
            aggs.append((F.var_pop(v) + alpha * var_eps).alias(f"g_var_{cls}_{f}"))
    return x.agg(*aggs)


@dataclass
class NBModel:
    """``counts``: vocabulary-restricted counts. ``all_counts``: every token
    (frequencies for the word trace use the unpruned table). ``stats``: one
    row. ``vocab_size``: V, known on the driver (it sizes the broadcast)."""

    counts: DataFrame
    all_counts: DataFrame
    stats: DataFrame
    vocab_size: int
    min_df: int = C.MIN_DF
    max_df: float = C.MAX_DF

    def broadcastable(self, bytes_per_row: int = 96) -> bool:
        """Whether a row per word, of so many bytes, may be broadcast."""
        return self.vocab_size * bytes_per_row <= C.BROADCAST_MAX_BYTES


def class_stats(all_counts: DataFrame) -> DataFrame:
    """A1 + class token totals, one row: n_docs_spam, n_docs_ham, n_docs,
    N_spam, N_ham (from the sentinel row and the total of all tokens)."""
    return all_counts.agg(
        F.max(F.when(F.col("token") == _SENTINEL, F.col("df_spam"))).alias("n_docs_spam"),
        F.max(F.when(F.col("token") == _SENTINEL, F.col("df_ham"))).alias("n_docs_ham"),
        F.sum("n_spam").cast("bigint").alias("ntok_spam"),
        F.sum("n_ham").cast("bigint").alias("ntok_ham"),
    ).withColumn("n_docs", F.col("n_docs_spam") + F.col("n_docs_ham"))


def vocabulary_filter(all_counts: DataFrame, n_docs: Column, min_df: int, max_df: float) -> Column:
    df = F.col("df_spam") + F.col("df_ham")
    return (F.col("token") != _SENTINEL) & (df >= min_df) & (df / n_docs <= max_df)


def fit(tok: DataFrame, min_df: int = C.MIN_DF, max_df: float = C.MAX_DF,
        gaussian_alpha: float = C.ALPHA, persist: bool = True) -> NBModel:
    """L1: train all three models from labelled tokenised documents.

    The count table, the vocabulary and the stats row are checkpointed
    (reliable, in the shared checkpoint folder): later jobs read them
    instead of recomputing, and their plans stay small. V is read on the
    driver (one number: it sizes the broadcast decision)."""
    all_counts = token_class_counts(tok)
    if persist:
        # A task counts the words of its split in memory, so large input means more splits.
        with setting(tok.sparkSession, "spark.sql.files.maxPartitionBytes", COUNT_SPLIT):
            all_counts = cut_lineage(all_counts)
    cs = class_stats(all_counts)
    vocab = all_counts.crossJoin(F.broadcast(cs.select("n_docs"))) \
        .where(vocabulary_filter(all_counts, F.col("n_docs"), min_df, max_df)) \
        .select("token", "n_spam", "n_ham", "df_spam", "df_ham")
    if persist:
        vocab = cut_lineage(vocab)
    v = vocab.count()
    stats = cs.withColumn("V", F.lit(v).cast("bigint")) \
              .crossJoin(gaussian_moments(tok, alpha=gaussian_alpha))
    if persist:
        stats = cut_lineage(stats)
    _check_classes(stats)
    return NBModel(counts=vocab, all_counts=all_counts.where(F.col("token") != _SENTINEL),
                   stats=stats, vocab_size=v, min_df=min_df, max_df=max_df)


def _check_classes(stats: DataFrame) -> None:
    row = stats.select("n_docs_spam", "n_docs_ham").first()
    if not row or not row["n_docs_spam"] or not row["n_docs_ham"]:
        raise ValueError("training data must contain both classes (log prior of an empty class)")


# ---------------------------------------------------------------------------
# Per-alpha model columns
# ---------------------------------------------------------------------------

def bernoulli_p(df_col: Column, n_docs_c: Column, alpha) -> Column:
    return (df_col + alpha) / (n_docs_c + 2 * alpha)


# ---------------------------------------------------------------------------
# Scoring
# ---------------------------------------------------------------------------

def use_level(counts: DataFrame) -> Column:
    """Words ranked by document frequency, sixteen levels a doubling."""
    df = F.col("df_spam") + F.col("df_ham")
    return F.floor(16 * F.log2(F.greatest(df, F.lit(1)))).cast("int")


def tiers(counts: DataFrame, n: int, row_bytes: int) -> tuple[DataFrame, DataFrame | None]:
    """The ``n`` rows of ``counts`` as (frequent, other): the levels of highest
    document frequency that may be broadcast at ``row_bytes`` a row, and the rest;
    None where all may be. At most some thousand level counts are read."""
    most = C.BROADCAST_MAX_BYTES // row_bytes
    if n <= most:
        return counts, None
    level, held = use_level(counts), 0
    floor = 1 << 30
    for r in counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")) \
            .orderBy(F.desc("level")).collect():
        held += r["n"]
        if held > most:
            break
        floor = r["level"]
    return counts.where(level >= floor), counts.where(level < floor)


def stored_terms(tok: DataFrame, keep) -> DataFrame:
    """``tok`` with ``terms``, fit to be read twice: as it is where it holds them
    (the prepared set is stored), else formed and stored."""
    if "terms" in tok.columns:
        return tok
    return cut_lineage(T.add_term_frequencies(tok.select(*keep, "tokens"), keep=keep))


FILTER_BITS = 1 << 29       # at most, 64 MB; 16 a word below
_PAGE = 1 << 15             # bits of one page: 512 longs


def _word_hash(by) -> Column:
    return F.xxhash64(*[F.col(c).cast("string") for c in by])    # whatever integer a fold is


def word_filter(words: DataFrame, n: int, by=("token",)) -> tuple[DataFrame, int]:
    """``(__page, __longs)``, pages of bits set where the hash of one of the ``n``
    words falls, and the number of bits. A word whose bit is not set is none of
    them, so its rows need no shuffle; of other words about n / bits pass by chance."""
    bits = _PAGE
    while bits < min(16 * n, FILTER_BITS):
        bits *= 2
    at = F.pmod(_word_hash(by), F.lit(bits))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int"))
    longs = words.select(F.shiftright(at, 6).alias("at"), bit.alias("bits")).unionByName(
        words.sparkSession.range(bits // 64).select(F.col("id").alias("at"), F.lit(0).cast("long").alias("bits")))
    longs = longs.groupBy("at").agg(F.bit_or("bits").alias("bits"))
    return cut_lineage(longs.groupBy(F.shiftright("at", 9).alias("__page")).agg(F.transform(
        F.sort_array(F.collect_list(F.struct("at", "bits"))), lambda s: s["bits"]).alias("__longs"))), bits


def may_be_in(bits: int, by=("token",)) -> Column:
    """Join condition of rows and a filter: the bit of the row's word is set."""
    at = F.pmod(_word_hash(by), F.lit(bits).cast("long"))
    long = F.get("__longs", (F.shiftright(at, 6) % 512).cast("int"))
    return (F.shiftright(at, 15) == F.col("__page")) & (F.bit_get(long, (at % 64).cast("int")) == 1)


@dataclass
class Tiers:
    """``hot``: counts of the frequent words, to be broadcast; ``cold``: of the
    others (None: there are none), with their ``filter``; ``over``: the words too
    frequent for the vocabulary, which would fill a partition of a shuffled join
    and find nothing there; ``passing``: the words of ``hot`` and ``over`` that pass
    the filter by chance, a few in a hundred. ``by`` is the key of a word."""

    hot: DataFrame
    cold: DataFrame | None = None
    filter: DataFrame | None = None
    bits: int = 0
    over: DataFrame | None = None
    by: tuple = ("token",)
    passing: DataFrame | None = None

    def rest(self, rows: DataFrame) -> DataFrame:
        """The rows that must be looked up among the other words."""
        return rows.join(F.broadcast(self.filter), may_be_in(self.bits, self.by), "left_semi") \
            .join(F.broadcast(self.passing), list(self.by), "left_anti")


def make_tiers(counts: DataFrame, n: int, row_bytes: int, over, by=("token",)) -> Tiers:
    """Tiers of ``n`` stored counts; ``over()`` gives the words too frequent."""
    hot, cold = tiers(counts, n, row_bytes)
    if cold is None:
        return Tiers(hot, by=tuple(by))
    words, bits = word_filter(cold, n, by)
    over = over().select(*by)
    passing = cut_lineage(hot.select(*by).unionByName(over).join(
        F.broadcast(words), may_be_in(bits, by), "left_semi"))
    return Tiers(hot, cold, words, bits, over, tuple(by), passing)


def model_tiers(model: NBModel, row_bytes: int) -> Tiers:
    """The vocabulary's tiers, found once per model and width."""
    kept = model.__dict__.setdefault("_tiers", {})

    def over() -> DataFrame:
        if "over" not in kept:
            df = F.col("df_spam") + F.col("df_ham")
            kept["over"] = cut_lineage(
                model.all_counts.crossJoin(F.broadcast(model.stats.select("n_docs"))).where(
                    (df >= model.min_df) & (df / F.col("n_docs") > model.max_df)).select("token"))
        return kept["over"]

    if row_bytes not in kept:
        kept[row_bytes] = make_tiers(model.counts, model.vocab_size, row_bytes, over)
    return kept[row_bytes]


# Heap that a broadcast word of ``join_words`` may take on the driver (an estimate): the
# collected row, its place in the hash table and its part of the blocks sent out.
JOINED_BYTES = 384


def join_words(rows: DataFrame, model: NBModel, weigh, how: str = "inner",
               row_bytes: int = JOINED_BYTES, gather: str | None = None) -> DataFrame:
    """``rows`` joined on ``token`` with ``weigh(counts)``, a row per word made
    from the vocabulary counts: ``how`` inner or left. Beyond the size of a
    broadcast in two tiers, for which ``rows`` is read twice. The other words
    are hashed, not sorted: a partition holds its share of the vocabulary.

    What met the other words lies by token, a row of a document in each task; with
    ``gather`` it is dealt by that column, for an aggregate with large buffers."""
    t = model_tiers(model, row_bytes)
    words = weigh(t.hot)
    if t.cold is None:
        return rows.join(F.broadcast(words), "token", how)
    rest = t.rest(rows).join(weigh(t.cold).hint("shuffle_hash"), "token", how)
    if gather:
        rest = rest.hint("rebalance", F.col(gather))
    if how == "inner":
        return rows.join(F.broadcast(words), "token").unionByName(rest)
    # Left: what is frequent, and what cannot be among the others, in one pass.
    words = words.unionByName(t.over, allowMissingColumns=True).withColumn("__known", F.lit(True))
    first = rows.join(F.broadcast(words), "token", "left").join(
        F.broadcast(t.filter), F.col("__known").isNull() & may_be_in(t.bits), "left_anti")
    return first.drop("__known").unionByName(rest)


def weighted_rows(x: DataFrame, keep, sums, weigh, t: Tiers) -> DataFrame:
    """``term_rows`` with their weights ``sums``, to be added up per document: each
    row once, with the weights of a frequent word; and, where there are others,
    what finds its word there, without token, ``tf`` and ``d``."""
    cols, by = [*keep, "n_tokens"], list(t.by)
    j = x.join(F.broadcast(weigh(t.hot)), by, "left").select(*cols, "token", "tf", "d", *sums)
    if t.cold is None:
        return j
    rest = t.rest(x.where(F.col("token").isNotNull())).join(weigh(t.cold).hint("merge"), by) \
        .select(*cols, F.lit(None).cast("string").alias("token"), F.lit(0).alias("tf"),
                F.lit(0).alias("d"), *sums)
    return j.unionByName(rest)


def token_weights(model: NBModel, alphas, parts=("m", "b"), counts: DataFrame | None = None) -> DataFrame:
    """Per vocabulary token (of ``counts``, else all) and per alpha (index i):
    multinomial weights ``wm_<c>_<i> = ln(n(t,c)+a) - ln a`` and Bernoulli weights
    ``wb_<c>_<i> = ln p - ln(1-p)``. Computed on the small side, once."""
    counts = model.counts if counts is None else counts
    x = counts.crossJoin(F.broadcast(model.stats.select("n_docs_spam", "n_docs_ham")))
    cols = []
    for i, a in enumerate(alphas):
        a = float(a)
        for c in CLASSES:
            p = bernoulli_p(F.col(f"df_{c}"), F.col(f"n_docs_{c}"), F.lit(a))
            if "m" in parts:
                cols.append((F.log(F.col(f"n_{c}") + a) - math.log(a)).alias(f"wm_{c}_{i}"))
            if "b" in parts:
                cols.append((F.log(p) - F.log(1 - p)).alias(f"wb_{c}_{i}"))
    return x.select("token", *cols)


def scored_frame(model: NBModel, tok: DataFrame, alphas, keep=("doc_id", "label"),
                 with_features: bool = True, parts=("m", "b"),
                 row_bytes: int | None = None) -> DataFrame:
    """One row per document with, per alpha i, ``m_<c>_<i>`` (sum of the
    multinomial weight over in-vocabulary occurrences) and ``b_<c>_<i>``
    (sum of the Bernoulli weight over distinct in-vocabulary tokens), the
    token count and the token-mode Gaussian features.

    One row per document and distinct token, a left join to the per-token weights
    (broadcast), one groupBy(doc_id) whose map-side partial aggregation leaves about
    one row per document per partition. Where the table's real width allows no
    broadcast of all words, the frequent ones are; rows without one of these that pass a
    bit filter of the other words are shuffled to these, and only what finds its word there goes on to the
    same groupBy. The Gaussian features are exact aggregates over the occurrences
    (the joined text has only a-z, '_' and spaces)."""
    keep = [c for c in keep if c in tok.columns]
    names = [f"{p}_{c}_{i}" for i in range(len(alphas)) for c in CLASSES for p in parts]
    t = model_tiers(model, row_bytes or 64 + 8 * len(names))
    x = term_rows(tok if t.cold is None else stored_terms(tok, keep), keep)
    # A word's weight counts each occurrence (m) or the document once (b).
    sums = [(F.col({"m": "tf", "b": "d"}[n[0]]) * F.col(f"w{n}")).alias(n) for n in names]
    j = weighted_rows(x, keep, sums, lambda counts: token_weights(model, alphas, parts, counts), t)
    aggs = [F.coalesce(F.sum(n), F.lit(0.0)).alias(n) for n in names]
    if with_features:
        aggs += feature_aggregates()
    g = j.groupBy(*keep, "n_tokens").agg(*aggs)
    if not with_features:
        return g
    rest = [c for c in g.columns if not c.startswith("__")]
    return g.select(*rest, *features_from_aggregates())


def feature_aggregates() -> list[Column]:
    """Per-document sums over ``term_rows`` from which the
    token-mode Gaussian features follow exactly (see
    ``features_from_aggregates``)."""
    o = F.col("tf")
    tlen = F.coalesce(F.length("token"), F.lit(0))
    under = tlen - F.coalesce(F.length(F.translate("token", "_", "")), F.lit(0))
    return [
        F.sum(F.col("d")).alias("__unique"),
        F.sum(o * tlen).alias("__chars"),
        F.sum(F.when(F.col("token") == C.URL_TOKEN, o).otherwise(0)).alias("__url"),
        F.sum(F.when(F.col("token") == C.EMAIL_TOKEN, o).otherwise(0)).alias("__email"),
        F.sum(o * under).alias("__under"),
    ]


def term_aggregates() -> list[Column]:
    """``n_tokens`` and what ``feature_aggregates`` gives, in the row, of ``terms``:
    one step a distinct token, and the joined text is never formed."""
    def total(of) -> Column:
        return F.aggregate("terms", F.lit(0).cast("bigint"), lambda n, t: n + t["tf"] * of(t["token"]))

    return [
        F.aggregate("terms", F.lit(0), lambda n, t: n + t["tf"]).alias("n_tokens"),
        F.size("terms").alias("__unique"),
        total(F.length).alias("__chars"),
        total(lambda t: (t == C.URL_TOKEN).cast("int")).alias("__url"),
        total(lambda t: (t == C.EMAIL_TOKEN).cast("int")).alias("__email"),
        total(lambda t: F.length(t) - F.length(F.replace(t, F.lit("_"), F.lit("")))).alias("__under"),
    ]


def features_from_aggregates() -> list[Column]:
    """The ten features from ``n_tokens`` and ``feature_aggregates``: the
    joined text has only a-z, '_' and spaces, so punctuation, upper-case
    and digit ratios are 0 and the special characters are the '_'."""
    n = F.col("n_tokens")
    text_len = F.greatest(F.lit(1), F.col("__chars") + n - 1)
    feats = [
        n.cast("double"),
        F.col("__unique").cast("double"),
        (F.col("__chars") / F.greatest(F.lit(1), n)).cast("double"),
        F.col("__url").cast("double"),
        F.col("__email").cast("double"),
        F.lit(0.0), F.lit(0.0), F.lit(0.0),
        (F.col("__under") / text_len).cast("double"),
        F.greatest(F.lit(1), F.floor(n / 10)).cast("double"),
    ]
    return [f.alias(nm) for f, nm in zip(feats, C.GAUSSIAN_FEATURES)]


def _temperature(n_tokens: Column) -> Column:
    return F.greatest(F.lit(1.0), F.greatest(F.lit(1), n_tokens) / 10.0)


def _posterior(lp_spam: Column, lp_ham: Column, n_tokens: Column, prefix: str) -> list[Column]:
    """M4 + M5: temperature and log-sum-exp normalisation."""
    t = _temperature(n_tokens)
    s_spam = lp_spam / t
    s_ham = lp_ham / t
    m = F.greatest(s_spam, s_ham)
    es = F.exp(s_spam - m)
    eh = F.exp(s_ham - m)
    return [(es / (es + eh)).alias(f"{prefix}p_spam"), (eh / (es + eh)).alias(f"{prefix}p_ham")]


def log_posteriors(frame: DataFrame, model: NBModel, alphas, models=MODELS,
                   i: int = 0) -> list[Column]:
    """Columns ``<model>_lp_<c>`` (log prior + log likelihood) for alpha
    index ``i``; ``frame`` must carry the stats row and the baselines."""
    a = float(alphas[i])
    prior = {c: F.log(F.col(f"n_docs_{c}") / F.col("n_docs")) for c in CLASSES}
    out = []
    for mdl in models:
        for c in CLASSES:
            if mdl == "multinomial":
                ll = F.col(f"m_{c}_{i}") + F.col("n_tokens") * (
                    math.log(a) - F.log(F.col(f"ntok_{c}") + a * F.col("V")))
            elif mdl == "bernoulli":
                ll = F.col(f"base_{c}_{i}") + F.col(f"b_{c}_{i}")
            else:
                ll = gaussian_log_likelihood(c)
            out.append((prior[c] + ll).alias(f"{mdl}_lp_{c}"))
    return out


def gaussian_constant_columns(keep) -> list[Column]:
    """M1 constants per class: ``g_const_<c> = sum_f -0.5 ln(2 pi v)`` and
    ``g_k_<c>_<f> = 1 / (2 v)``, so a row only needs ``C - sum k (x-mu)^2``."""
    out = [F.col(k) for k in keep]
    for c in CLASSES:
        const = F.lit(0.0)
        for f in C.GAUSSIAN_FEATURES:
            const = const - 0.5 * F.log(2 * math.pi * F.col(f"g_var_{c}_{f}"))
            out.append((1 / (2 * F.col(f"g_var_{c}_{f}"))).alias(f"g_k_{c}_{f}"))
        out.append(const.alias(f"g_const_{c}"))
    return out


def gaussian_log_likelihood(c: str) -> Column:
    """M1 from the per-class constants (see gaussian_constant_columns)."""
    ll = F.col(f"g_const_{c}")
    for f in C.GAUSSIAN_FEATURES:
        d = F.col(f) - F.col(f"g_mu_{c}_{f}")
        ll = ll - F.col(f"g_k_{c}_{f}") * d * d
    return ll


def model_constants(model: NBModel, alphas) -> DataFrame:
    """One row: the stats, the Gaussian constants and the per-alpha
    Bernoulli baselines; computed once per model and alpha set and
    checkpointed (a one-row table)."""
    key = tuple(float(a) for a in alphas)
    cache = model.__dict__.setdefault("_constants", {})
    if key not in cache:
        st = model.stats.select(*gaussian_constant_columns(model.stats.columns))
        cache[key] = cut_lineage(st.crossJoin(bernoulli_baselines_wide(model, alphas)))
    return cache[key]


def with_model_constants(frame: DataFrame, model: NBModel, alphas) -> DataFrame:
    """Attach the one-row stats and per-alpha Bernoulli baselines."""
    return frame.crossJoin(F.broadcast(model_constants(model, alphas)))


def bernoulli_baselines_wide(model: NBModel, alphas) -> DataFrame:
    """A8 for each alpha index: one row with ``base_<c>_<i>``."""
    x = model.counts.crossJoin(F.broadcast(model.stats.select("n_docs_spam", "n_docs_ham")))
    aggs = []
    for i, a in enumerate(alphas):
        for c in CLASSES:
            p = bernoulli_p(F.col(f"df_{c}"), F.col(f"n_docs_{c}"), F.lit(float(a)))
            aggs.append(F.coalesce(F.sum(F.log(1 - p)), F.lit(0.0)).alias(f"base_{c}_{i}"))
    return x.agg(*aggs)


def decide(p_spam: Column, p_ham: Column, decision_threshold, confidence_threshold) -> list[Column]:
    """I1 + I3: ham iff P(ham) > threshold else spam (ties -> spam);
    confidence = P(decided class); below the confidence threshold the
    prediction is ``uncertain``."""
    raw = F.when(p_ham > decision_threshold, F.lit("ham")).otherwise(F.lit("spam"))
    conf = F.when(p_ham > decision_threshold, p_ham).otherwise(p_spam)
    ok = conf >= confidence_threshold
    return [
        raw.alias("raw_prediction"),
        F.when(ok, raw).otherwise(F.lit("uncertain")).alias("prediction"),
        conf.alias("confidence"),
        ok.alias("is_confident"),
    ]


def posterior_struct(lp_spam: Column, lp_ham: Column, n_tokens: Column) -> list[Column]:
    return _posterior(lp_spam, lp_ham, n_tokens, "")


def score(model: NBModel, tok: DataFrame, alpha: float = C.ALPHA, models=MODELS,
          decision_threshold: float = C.DECISION_THRESHOLD,
          confidence_threshold: float = C.CONFIDENCE_THRESHOLD,
          keep=("doc_id", "label"), log_odds: bool = False,
          row_bytes: int | None = None) -> DataFrame:
    """Long table ``(doc_id, [label], model, n_tokens, p_spam, p_ham,
    raw_prediction, prediction, confidence, is_confident)``. With
    ``log_odds`` also ln(p_spam / p_ham), computed from the tempered log
    posteriors (it keeps its precision where the probabilities have become 0
    or 1) and rounded to 9 places, so that equal documents tie whatever the
    order their terms were added in. ``row_bytes``: of a broadcast word (default:
    the width of its row)."""
    alphas = [alpha]
    keep = [c for c in keep if c in tok.columns]
    frame = with_model_constants(
        scored_frame(model, tok, alphas, keep, with_features="gaussian" in models, row_bytes=row_bytes),
        model, alphas)
    lp = frame.select(*keep, "n_tokens", *log_posteriors(frame, model, alphas, models))
    per_model = F.array(*[
        F.struct(F.lit(m).alias("model"),
                 *_posterior(F.col(f"{m}_lp_spam"), F.col(f"{m}_lp_ham"), F.col("n_tokens"), ""),
                 F.round((F.col(f"{m}_lp_spam") - F.col(f"{m}_lp_ham"))
                         / _temperature(F.col("n_tokens")), 9).alias("log_odds"))
        for m in models])
    x = lp.select(*keep, "n_tokens", F.explode(per_model).alias("s")) \
          .select(*keep, "n_tokens", "s.model", "s.p_spam", "s.p_ham",
                  *(["s.log_odds"] if log_odds else []))
    return x.select("*", *decide(F.col("p_spam"), F.col("p_ham"),
                                 F.lit(decision_threshold), F.lit(confidence_threshold)))


def explanation(prediction: Column, confidence: Column, p_spam: Column, p_ham: Column,
                is_confident: Column, confidence_threshold: float) -> Column:
    """M9: the explanation string (4 decimals)."""
    thr = _py_float(confidence_threshold)
    return F.when(
        is_confident,
        F.format_string(C.CONFIDENT_TEXT.format(thr), F.upper(prediction), confidence),
    ).otherwise(F.format_string(C.UNCERTAIN_TEXT.format(thr), p_spam, p_ham))


def _py_float(x: float) -> str:
    return repr(float(x))
