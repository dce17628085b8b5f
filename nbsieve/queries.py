"""Registered queries: one per operator (or tight group) of the survey's
inventory, each a function ``(spark, sf_dir) -> DataFrame`` over the
driver tables, with the matching DuckDB statement in ``ORACLE``.

Floating outputs are rounded to 6 places on both sides (+0.0 folds -0.0)
so the value hashes compare.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nbsieve import config as C
from nbsieve import oracle as O
from nbsieve.functions import text as T
from nbsieve.operators import lemmas as LEM
from nbsieve.operators import nb
from nbsieve.plans import pipeline
from nbsieve.session import cut_lineage, free_shuffles
from nbsieve.sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 6) + F.lit(0.0)


# ---------------------------------------------------------------------------
# Text (F1-F13, W3, J5, P9)
# ---------------------------------------------------------------------------

@register("F9_tokens", "WITH " + O.tokens_cte("tok", "documents", "doc_id") + """
SELECT doc_id, CAST(len(tokens) AS BIGINT) AS n_tokens, array_to_string(tokens, ' ') AS tokens
FROM tok""")
def q_tokens(spark, sf):
    docs = tables.table(spark, sf, "documents").select("doc_id", "text")
    tok = nb.tokenize(docs)
    return tok.select("doc_id", F.size("tokens").cast("bigint").alias("n_tokens"),
                      F.array_join("tokens", " ").alias("tokens"))


@register("F13_gaussian_features", "WITH " + O.tokens_cte("tok", "documents", "doc_id") + """
SELECT doc_id, """ + ", ".join(f"round({f}, 6) + 0.0 AS {f}" for f in C.GAUSSIAN_FEATURES) + """
FROM (SELECT doc_id, """ + O.feats_sql() + " FROM tok)")
def q_features(spark, sf):
    docs = tables.table(spark, sf, "documents").select("doc_id", "text")
    tok = nb.tokenize(docs)
    return tok.select("doc_id",
                      *[r6(f).alias(n) for f, n in zip(T.gaussian_features(F.col("tokens")),
                                                         C.GAUSSIAN_FEATURES)])


@register("P9_unigram_counts", "WITH " + O.tokens_cte("tok", "documents", "doc_id") + """
SELECT doc_id, CAST(len(list_filter(tokens, lambda t: NOT contains(t, '_'))) AS BIGINT) AS n_unigrams,
       CAST(len(list_filter(tokens, lambda t: contains(t, '_'))) AS BIGINT) AS n_bigrams
FROM tok""")
def q_unigrams(spark, sf):
    tok = nb.tokenize(tables.table(spark, sf, "documents").select("doc_id", "text"))
    uni = F.size(T.unigram_only(F.col("tokens")))
    return tok.select("doc_id", uni.cast("bigint").alias("n_unigrams"),
                      (F.size("tokens") - uni).cast("bigint").alias("n_bigrams"))


# A small dictionary for F7, the same on both sides.
_LEMMAS = (("thing", "thin"), ("ention", "ent"), ("blean", "ble"), ("ending", "end"), ("reed", "read"),
           ("heed", "he"), ("stand", "stan"), ("ingly", "ing"), ("oned", "one"), ("erbe", "erb"))


@register("F7_lemmatised_tokens", "WITH " + O.tokens_cte("tok", "documents", "doc_id") + """,
u AS (SELECT doc_id, list_transform(list_filter(tokens, lambda t: NOT contains(t, '_')),
        lambda t: CASE t """ + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in _LEMMAS) + """ ELSE t END) AS u FROM tok)
SELECT doc_id, array_to_string(u, ' ') AS unigrams, array_to_string(list_transform(
  range(1, greatest(len(u), 1)), lambda i: u[i] || '_' || u[i + 1]), ' ') AS bigrams FROM u""")
def q_lemmas(spark, sf):
    """words replaced by their lemma (dictionary joined by word) before
    the bigrams are formed."""
    lemmas = spark.createDataFrame(list(_LEMMAS), "token string, lemma string")
    docs = tables.table(spark, sf, "documents").select("doc_id", "text")
    tok = nb.tokenize(docs, lemmas=lemmas)
    pairs = F.filter("tokens", lambda t: t.contains("_"))
    return tok.select("doc_id", F.array_join(T.unigram_only(F.col("tokens")), " ").alias("unigrams"),
                      F.array_join(pairs, " ").alias("bigrams"))


def _forms_sql(pos: str, word: str) -> str:
    """All forms of a word with one ending detached, the word first."""
    cases = [f"CASE WHEN ends_with({word}, '{a}') THEN substr({word}, 1, length({word}) - {len(a)}) || '{b}' END"
             for a, b in LEM.ENDINGS[pos]]
    return f"[{word}, {', '.join(cases)}]"


def _lemma_sql(pos: str, src: str, out: str) -> str:
    """The corpus is its own lexicon, so a known form is always at hand."""
    return f"""c{pos} AS (SELECT word, unnest({_forms_sql(pos, 'word')}) AS form, unnest(range(0, {len(LEM.ENDINGS[pos]) + 1})) AS k
  FROM (SELECT DISTINCT {src} AS word FROM {'voc' if pos == 'v' else 'verbs'})),
{out} AS (SELECT word, arg_min(form, length(form) * 100 + k) AS lemma
  FROM c{pos} WHERE form IN (SELECT token FROM voc) GROUP BY word)"""


@register("F7_verb_noun_lemmas", "WITH " + O.tokens_cte("tok", "documents", "doc_id") + """,
u AS (SELECT doc_id, list_filter(tokens, lambda t: NOT contains(t, '_')) AS u FROM tok),
voc AS (SELECT DISTINCT token FROM (SELECT unnest(u) AS token FROM u)),
""" + _lemma_sql("v", "token", "verbs") + ",\n" + _lemma_sql("n", "lemma", "nouns") + """,
words AS (SELECT doc_id, unnest(u) AS token, unnest(range(0, len(u))) AS k FROM u),
lem AS (SELECT doc_id, list(n.lemma ORDER BY k) AS u FROM words w JOIN verbs v ON w.token = v.word
  JOIN nouns n ON v.lemma = n.word GROUP BY doc_id)
SELECT u.doc_id, array_to_string(coalesce(lem.u, []), ' ') AS unigrams,
  array_to_string(list_transform(range(1, greatest(len(coalesce(lem.u, [])), 1)),
    lambda i: lem.u[i] || '_' || lem.u[i + 1]), ' ') AS bigrams
FROM u LEFT JOIN lem USING (doc_id)""")
def q_verb_noun(spark, sf):
    """F7 as verb, then noun, over the distinct words of all documents, which
    are the lexicon; documents are then lemmatised by that table."""
    docs = tables.table(spark, sf, "documents").select("doc_id", "text")
    tok = nb.tokenize(docs, lemmas=lambda words: cut_lineage(
        LEM.lemma_table(cut_lineage(LEM.corpus_words(words, "words")))))
    pairs = F.filter("tokens", lambda t: t.contains("_"))
    return tok.select("doc_id", F.array_join(T.unigram_only(F.col("tokens")), " ").alias("unigrams"),
                      F.array_join(pairs, " ").alias("bigrams"))


_RAW = {
    "punctuation_ratio": "length(regexp_replace(text, '[^" + "".join("\\" + c for c in C.PUNCTUATION_CHARS)
                         + "]', '', 'g')) / greatest(1, length(text))",
    "uppercase_ratio": "length(regexp_replace(text, '[^\\p{Lu}]', '', 'g')) "
                       "/ greatest(1, length(regexp_replace(text, '[^\\p{L}]', '', 'g')))",
    "digit_ratio": "length(regexp_replace(text, '[^\\p{Nd}]', '', 'g')) / greatest(1, length(text))",
    "special_char_density": "length(regexp_replace(text, '[\\p{L}\\p{N}" + C.PY_WHITESPACE
                            + "]', '', 'g')) / greatest(1, length(text))",
    "sentence_count": "CAST(greatest(1, len(regexp_split_to_array(text, '[.!?]+')) - 1) AS DOUBLE)",
}


@register("F11_F12_raw_features", "SELECT doc_id, " + ", ".join(
    f"round({v}, 6) + 0.0 AS {k}" for k, v in _RAW.items()) + " FROM documents")
def q_raw_features(spark, sf):
    """F11, F12 in raw mode: punctuation, capitals, digits, special
    characters and sentences of the text itself."""
    docs = tables.table(spark, sf, "documents").select("doc_id", "text")
    tok = nb.tokenize(docs, keep=["doc_id", "text"])
    feats = T.gaussian_features(F.col("tokens"), F.col("text"))
    return tok.select("doc_id", *feats).select("doc_id", *[r6(k).alias(k) for k in _RAW])


@register("F2_F3_page_urls", "SELECT page_id, " + O.words_sql("url") + " AS cleaned FROM pages")
def q_page_urls(spark, sf):
    pages = tables.table(spark, sf, "pages").select("page_id", "url")
    return pages.select("page_id", T.clean_text(F.col("url")).alias("cleaned"))


# ---------------------------------------------------------------------------
# Vocabulary and counts
# ---------------------------------------------------------------------------

def _prepared(spark, sf) -> pipeline.Prepared:
    return pipeline.prepare(spark, sf)


@register("A4_A5_token_counts", O.with_model() + """
SELECT token, n_spam, n_ham, df_spam, df_ham FROM cnt""")
def q_counts(spark, sf):
    p = _prepared(spark, sf)
    return p.model.all_counts


@register("A2_A3_T1_vocabulary", O.with_model() + """
SELECT token, CAST(df_spam + df_ham AS BIGINT) AS df,
       CAST(row_number() OVER (ORDER BY token COLLATE "C") AS BIGINT) AS position FROM voc""")
def q_vocab(spark, sf):
    p = _prepared(spark, sf)
    # Code-point order. A global sort is a range-partitioned sort; the
    # position needs a global row number -> distributed rank by prefix.
    v = p.model.counts.select("token", (F.col("df_spam") + F.col("df_ham")).alias("df"))
    from nbsieve.operators.vocab import sorted_positions
    return sorted_positions(v)


@register("A1_I11_priors", O.with_model() + """
SELECT label, CAST(n AS BIGINT) AS n_docs, round(n / n_docs, 6) + 0.0 AS prior,
       round(ln(n / n_docs), 6) + 0.0 AS log_prior, CAST(nt AS BIGINT) AS n_tokens
FROM (SELECT 'spam' AS label, n_docs_spam AS n, ntok_spam AS nt, n_docs FROM cls
      UNION ALL SELECT 'ham', n_docs_ham, ntok_ham, n_docs FROM cls)""")
def q_priors(spark, sf):
    p = _prepared(spark, sf)
    st = p.model.stats
    rows = [st.select(F.lit(c).alias("label"), F.col(f"n_docs_{c}").alias("n_docs"),
                      F.col("n_docs").alias("__n"), F.col(f"ntok_{c}").alias("n_tokens"))
            for c in ("spam", "ham")]
    x = rows[0].unionByName(rows[1])
    return x.select("label", "n_docs", r6(F.col("n_docs") / F.col("__n")).alias("prior"),
                    r6(F.log(F.col("n_docs") / F.col("__n"))).alias("log_prior"), "n_tokens")


@register("A6_multinomial_likelihoods", O.with_model() + """
SELECT v.token, round(ln((v.n_spam + 1.0) / (cls.ntok_spam + 1.0 * vsz.V)), 6) + 0.0 AS log_p_spam,
       round(ln((v.n_ham + 1.0) / (cls.ntok_ham + 1.0 * vsz.V)), 6) + 0.0 AS log_p_ham
FROM voc v, cls, vsz""")
def q_mult_lik(spark, sf):
    p = _prepared(spark, sf)
    x = p.model.counts.crossJoin(F.broadcast(p.model.stats.select("ntok_spam", "ntok_ham", "V")))
    a = C.ALPHA
    return x.select("token", *[
        r6(F.log((F.col(f"n_{c}") + a) / (F.col(f"ntok_{c}") + a * F.col("V")))).alias(f"log_p_{c}")
        for c in ("spam", "ham")])


@register("A7_bernoulli_likelihoods", O.with_model() + """
SELECT v.token,
  round(ln((v.df_spam + 1.0) / (cls.n_docs_spam + 2.0)), 6) + 0.0 AS log_p_spam,
  round(ln(1 - (v.df_spam + 1.0) / (cls.n_docs_spam + 2.0)), 6) + 0.0 AS log_1mp_spam,
  round(ln((v.df_ham + 1.0) / (cls.n_docs_ham + 2.0)), 6) + 0.0 AS log_p_ham,
  round(ln(1 - (v.df_ham + 1.0) / (cls.n_docs_ham + 2.0)), 6) + 0.0 AS log_1mp_ham
FROM voc v, cls""")
def q_bern_lik(spark, sf):
    p = _prepared(spark, sf)
    x = p.model.counts.crossJoin(F.broadcast(p.model.stats.select("n_docs_spam", "n_docs_ham")))
    cols = []
    for c in ("spam", "ham"):
        pr = nb.bernoulli_p(F.col(f"df_{c}"), F.col(f"n_docs_{c}"), F.lit(C.ALPHA))
        cols += [r6(F.log(pr)).alias(f"log_p_{c}"), r6(F.log(1 - pr)).alias(f"log_1mp_{c}")]
    return x.select("token", *cols)


@register("A8_bernoulli_baseline", O.with_model("b AS (SELECT 1)") + """
SELECT round(sum(ln(1 - (v.df_spam + 1.0) / (cls.n_docs_spam + 2.0))), 6) + 0.0 AS base_spam,
       round(sum(ln(1 - (v.df_ham + 1.0) / (cls.n_docs_ham + 2.0))), 6) + 0.0 AS base_ham
FROM voc v, cls""")
def q_bern_base(spark, sf):
    p = _prepared(spark, sf)
    b = nb.bernoulli_baselines_wide(p.model, [C.ALPHA])
    return b.select(r6("base_spam_0").alias("base_spam"), r6("base_ham_0").alias("base_ham"))


@register("A9_gaussian_moments", O.with_model() + """
SELECT label, feature, round(mean, 6) + 0.0 AS mean, round(var, 6) + 0.0 AS var FROM (
""" + "\nUNION ALL ".join(
    f"SELECT label, '{f}' AS feature, mu_{f} AS mean, var_{f} AS var FROM gm"
    for f in C.GAUSSIAN_FEATURES) + ")")
def q_gauss_moments(spark, sf):
    p = _prepared(spark, sf)
    st = p.model.stats
    parts = [st.select(F.lit(c).alias("label"), F.lit(f).alias("feature"),
                       r6(F.col(f"g_mu_{c}_{f}")).alias("mean"),
                       r6(F.col(f"g_var_{c}_{f}")).alias("var"))
             for c in ("spam", "ham") for f in C.GAUSSIAN_FEATURES]
    out = parts[0]
    for q in parts[1:]:
        out = out.unionByName(q)
    return out


# ---------------------------------------------------------------------------
# Scoring (I1-I3, M1-M5, J2, J3, U4, U5)
# ---------------------------------------------------------------------------

SCORE_COLS = ["doc_id", "label", "model", "n_tokens", "p_spam", "p_ham", "raw_prediction",
              "prediction", "confidence", "is_confident"]


def _round_scores(df: DataFrame) -> DataFrame:
    return df.select(*[r6(c).alias(c) if c in ("p_spam", "p_ham", "confidence") else
                       (F.col(c).cast("bigint").alias(c) if c == "n_tokens" else F.col(c))
                       for c in df.columns])


_SCORE_SQL_SELECT = """SELECT doc_id, label, model, n_tokens, round(p_spam, 6) + 0.0 AS p_spam,
  round(p_ham, 6) + 0.0 AS p_ham, raw_prediction, prediction, round(confidence, 6) + 0.0 AS confidence,
  is_confident FROM lsc"""


@register("I1_I3_score_test", O.with_model(
    "tst AS (SELECT * FROM tok WHERE split = 'test')", O.scores_cte("tst"), O.long_scores())
    + _SCORE_SQL_SELECT)
def q_score_test(spark, sf):
    p = _prepared(spark, sf)
    return _round_scores(nb.score(p.model, p.part("test")))


@register("I2_score_all_documents", O.with_model(
    O.tokens_cte("alld", "(SELECT d.doc_id, d.text, CASE WHEN l.toxic IS NULL THEN NULL WHEN l.toxic = 1 "
                 "THEN 'spam' ELSE 'ham' END AS label FROM documents d LEFT JOIN labels l "
                 "ON d.doc_id = l.doc_id)", "doc_id, label"),
    O.scores_cte("alld"), O.long_scores()) + _SCORE_SQL_SELECT)
def q_score_all(spark, sf):
    p = _prepared(spark, sf)
    docs = nb.tokenize(tables.all_documents(spark, sf).select("doc_id", "label", "text"))
    return _round_scores(nb.score(p.model, docs))


# ---------------------------------------------------------------------------
# Splits and folds
# ---------------------------------------------------------------------------

from nbsieve.operators import metrics as M  # noqa: E402
from nbsieve.operators.split import with_allocated_split, with_folds, with_split  # noqa: E402
from nbsieve.plans import tuning  # noqa: E402


@register("W4_split_assignment", "WITH " + O.MSG + ",\n" + O.split_cte() + """
SELECT doc_id, label, split FROM spl""")
def q_split(spark, sf):
    return with_split(tables.messages(spark, sf)).select("doc_id", "label", "split")


def _allocated_sql(by: str, src: str) -> str:
    """Largest-remainder sizes of a test and a validation part, per class of
    ``by``, and the assignment in md5 order."""
    ratios = (("t", "n", C.TEST_RATIO), ("v", "n - t", C.VAL_RATIO / (1 - C.TEST_RATIO)))
    steps, last = [], "k0"
    for name, left, ratio in ratios:
        steps.append(f"""s{name} AS (SELECT *, total - ceil(total * {ratio!r}::DOUBLE)::BIGINT AS stay FROM
  (SELECT *, CAST(sum({left}) OVER () AS BIGINT) AS total, {left} AS m FROM {last})),
f{name} AS (SELECT *, (m * stay) // total AS low, (m * stay) % total AS rest FROM s{name}),
k{name} AS (SELECT * EXCLUDE (total, stay, low, rest, m, missing, turn),
    m - (low + (turn <= missing)::BIGINT) AS {name}
  FROM (SELECT *, stay - sum(low) OVER () AS missing,
          row_number() OVER (ORDER BY rest DESC, c) AS turn FROM f{name}))""")
        last = f"k{name}"
    return f"""(WITH x AS (SELECT doc_id, coalesce({by}, '') AS c FROM {src}),
k0 AS (SELECT c, count(*)::BIGINT AS n FROM x GROUP BY c),
{', '.join(steps)}
SELECT doc_id, c AS class, CASE WHEN rk <= t THEN 'test' WHEN rk <= t + v THEN 'val' ELSE 'train' END AS split
FROM (SELECT x.*, row_number() OVER (PARTITION BY c ORDER BY md5('{C.SEED}-' || CAST(doc_id AS VARCHAR)), doc_id) AS rk FROM x)
JOIN kv USING (c))"""


@register("W4_allocated_split", "WITH " + O.MSG + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{name}' AS classes, doc_id, class, split FROM {_allocated_sql(by, src)}"
    for name, by, src in (("label", "label", "msg"), ("source", "source", "documents"),
                          ("lang and label", "lang || ' ' || label", "msg"))))
def q_allocated(spark, sf):
    """W4 with exact part sizes, over three sets of classes: labels, sources,
    and languages with labels."""
    msgs = tables.messages(spark, sf).select("doc_id", "label", F.concat_ws(" ", "lang", "label").alias("both"))
    docs = tables.table(spark, sf, "documents").select("doc_id", "source")
    out = None
    for name, by, df in (("label", "label", msgs), ("source", "source", docs), ("lang and label", "both", msgs)):
        x = with_allocated_split(df, by).select(F.lit(name).alias("classes"), "doc_id", F.coalesce(
            F.col(by), F.lit("")).alias("class"), "split")
        out = x if out is None else out.unionByName(x)
    return out


@register("A21_split_summary", "WITH " + O.MSG + ",\n" + O.split_cte() + """
SELECT split, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE label = 'spam') AS BIGINT) AS n_spam,
       CAST(count(*) FILTER (WHERE label = 'ham') AS BIGINT) AS n_ham FROM spl GROUP BY split""")
def q_split_summary(spark, sf):
    s = with_split(tables.messages(spark, sf))
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"),
                                  F.count(F.when(F.col("label") == "spam", 1)).alias("n_spam"),
                                  F.count(F.when(F.col("label") == "ham", 1)).alias("n_ham"))


@register("W5_U2_fold_assignment", "WITH " + O.MSG + ",\n" + O.split_cte() + ",\n"
          + O.fold_cte(src="(SELECT * FROM spl WHERE split IN ('train', 'val'))") + """
SELECT doc_id, label, fold FROM fld""")
def q_folds(spark, sf):
    s = with_split(tables.messages(spark, sf)).where(F.col("split").isin("train", "val"))
    return with_folds(s).select("doc_id", "label", "fold")


# ---------------------------------------------------------------------------
# Metrics and curves on the test split
# ---------------------------------------------------------------------------

_TEST = O.with_model("tst AS (SELECT * FROM tok WHERE split = 'test')", O.scores_cte("tst"),
                     O.long_scores(), O.metrics_sql())
_METRIC_COLS = ["accuracy", "precision", "recall", "f1", "macro_precision", "macro_recall",
                "macro_f1", "weighted_precision", "weighted_recall", "weighted_f1",
                "roc_auc", "pr_auc"]


def _probability(log_odds: str) -> Column:
    return 1 / (1 + F.exp(-F.col(log_odds)))


def _test_scores(spark, sf):
    p = _prepared(spark, sf)
    return p.once("test scores", lambda: nb.score(p.model, p.part("test"), log_odds=True))


@register("A10_A14_L4_test_metrics", _TEST + """
SELECT r.*, c.roc_auc, c.pr_auc FROM rep r LEFT JOIN cur c ON r.model = c.model""")
def q_test_metrics(spark, sf):
    ev = M.evaluate(_test_scores(spark, sf), score="log_odds")
    return ev.select("model", "tp", "tn", "fp", "fn", *[r6(c).alias(c) for c in _METRIC_COLS])


@register("W1_roc_points", _TEST + """
SELECT model, round(1 / (1 + exp(-s)), 6) + 0.0 AS threshold, round((N - cum_neg + neg) / N, 6) + 0.0 AS fpr,
       round((P - cum_pos + pos) / P, 6) + 0.0 AS tpr FROM rt
UNION ALL SELECT DISTINCT model, NULL, 0.0, 0.0 FROM rt""")
def q_roc(spark, sf):
    r = M.roc_points(_test_scores(spark, sf), score="log_odds")
    return r.select("model", r6(_probability("threshold")).alias("threshold"), r6("fpr").alias("fpr"),
                    r6("tpr").alias("tpr"))


@register("W1_roc_corners", _TEST + """,
near AS (SELECT *, lag(pos) OVER w AS lower_pos, lag(neg) OVER w AS lower_neg, lead(s) OVER w AS higher
         FROM rt WINDOW w AS (PARTITION BY model ORDER BY s))
SELECT model, round(1 / (1 + exp(-s)), 6) + 0.0 AS threshold, round((N - cum_neg + neg) / N, 6) + 0.0 AS fpr,
       round((P - cum_pos + pos) / P, 6) + 0.0 AS tpr FROM near
WHERE lower_pos IS NULL OR higher IS NULL OR lower_pos <> pos OR lower_neg <> neg
UNION ALL SELECT DISTINCT model, NULL, 0.0, 0.0 FROM rt""")
def q_roc_corners(spark, sf):
    """W1 without the points that lie on a straight line between others."""
    r = M.roc_points(_test_scores(spark, sf), score="log_odds", corners=True)
    return r.select("model", r6(_probability("threshold")).alias("threshold"), r6("fpr").alias("fpr"),
                    r6("tpr").alias("tpr"))


@register("W2_pr_points", _TEST + """
SELECT model, round(1 / (1 + exp(-s)), 6) + 0.0 AS threshold,
       round((P - cum_pos + pos) / ((P - cum_pos + pos) + (N - cum_neg + neg)), 6) + 0.0 AS precision,
       round(CASE WHEN P = 0 THEN 1.0 ELSE (P - cum_pos + pos) / P END, 6) + 0.0 AS recall FROM rt
UNION ALL SELECT DISTINCT model, NULL, 1.0, 0.0 FROM rt""")
def q_pr(spark, sf):
    r = M.pr_points(_test_scores(spark, sf), score="log_odds")
    return r.select("model", r6(_probability("threshold")).alias("threshold"), r6("precision").alias("precision"),
                    r6("recall").alias("recall"))


@register("L7_error_breakdown", _TEST + """
SELECT model, outcome, CAST(cnt AS BIGINT) AS count FROM (
  SELECT model, 'TP' AS outcome, tp AS cnt FROM cm UNION ALL SELECT model, 'TN', tn FROM cm
  UNION ALL SELECT model, 'FP', fp FROM cm UNION ALL SELECT model, 'FN', fn FROM cm)""")
def q_errors(spark, sf):
    return M.error_breakdown(_test_scores(spark, sf))


_VAL = O.with_model("val AS (SELECT * FROM tok WHERE split = 'val')", O.scores_cte("val"),
                    O.long_scores(), O.metrics_sql())


@register("T9_threshold_tuning", _VAL + """
SELECT 'multinomial' AS model, round(coalesce(min(1 / (1 + exp(-s))) FILTER (WHERE
    (P - cum_pos + pos) / ((P - cum_pos + pos) + (N - cum_neg + neg)) >= 0.95
    AND (P - cum_pos + pos) / P >= 0.9), 0.5), 6) + 0.0 AS threshold
FROM rt WHERE model = 'multinomial'""")
def q_threshold(spark, sf):
    p = _prepared(spark, sf)
    s = nb.score(p.model, p.part("val"), models=("multinomial",), log_odds=True)
    t = M.tuned_threshold(s, score="log_odds", default=0.0)
    return t.select("model", r6(_probability("threshold")).alias("threshold"))


# ---------------------------------------------------------------------------
# Smoothing search (L2, T8a, T8b, J11) on the validation split
# ---------------------------------------------------------------------------

def _sweep(spark, sf, alphas):
    p = _prepared(spark, sf)
    return p.once(f"sweep {alphas}", lambda: tuning.alpha_sweep(p.model, p.part("val"), alphas))


_SWEEP_F1 = O.with_model("val AS (SELECT * FROM tok WHERE split = 'val')",
                         O.sweep_sql(C.ALPHA_GRID_F1))
_SWEEP_ACC = O.with_model("val AS (SELECT * FROM tok WHERE split = 'val')",
                          O.sweep_sql(C.ALPHA_GRID_ACCURACY))


@register("L2_J11_alpha_sweep", _SWEEP_F1 + """
SELECT model, alpha, tp, tn, fp, fn, accuracy, precision, recall, f1 FROM rep""")
def q_sweep(spark, sf):
    s = _sweep(spark, sf, C.ALPHA_GRID_F1)
    return s.select("model", "alpha", "tp", "tn", "fp", "fn",
                    *[r6(c).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


@register("T8a_best_alpha_f1", _SWEEP_F1 + """
SELECT model, arg_max(alpha, (f1, -alpha)) AS alpha, max(f1) AS best_f1 FROM rep GROUP BY model""")
def q_best_f1(spark, sf):
    s = _sweep(spark, sf, C.ALPHA_GRID_F1).withColumn("f1", r6("f1"))
    return tuning.best_alpha(s, "f1")


@register("T8b_best_alpha_accuracy", _SWEEP_ACC + """
SELECT m.model, CAST(coalesce(b.alpha, 1.0) AS DOUBLE) AS alpha, b.best_accuracy FROM (SELECT DISTINCT model FROM rep) m
LEFT JOIN (SELECT model, arg_max(alpha, (accuracy, -alpha)) AS alpha, max(accuracy) AS best_accuracy
           FROM rep WHERE accuracy > 0 GROUP BY model) b ON m.model = b.model""")
def q_best_acc(spark, sf):
    s = _sweep(spark, sf, C.ALPHA_GRID_ACCURACY).withColumn("accuracy", r6("accuracy"))
    return tuning.best_alpha(s, "accuracy", default=1.0, floor=0.0)


# ---------------------------------------------------------------------------
# Cross-validation (L3, A25, A26, L8) and model comparison
# ---------------------------------------------------------------------------

from nbsieve.operators import stats as S  # noqa: E402


def _cv(spark, sf):
    # Train + val recombined; tokens come from the prepared set.
    p = _prepared(spark, sf)
    s = p.tok.where(F.col("split").isin("train", "val"))
    return p.once("cv", lambda: tuning.cross_validate(s.select(
        "doc_id", "label", "fold", "tokens", "terms")))


@register("L3_cross_validation", O.cv_sql() + """
SELECT model, fold, n, tp, tn, fp, fn, round((tp + tn) / n, 6) + 0.0 AS accuracy FROM cv""")
def q_cv(spark, sf):
    cv = _cv(spark, sf)
    return cv.select("model", "fold", "n", "tp", "tn", "fp", "fn", r6("accuracy").alias("accuracy"))


@register("A25_A26_cv_summary", O.cv_sql() + """, acc AS (SELECT model, fold, (tp + tn) / n AS a FROM cv)
SELECT model, round(avg(a), 6) + 0.0 AS cv_mean_acc, round(stddev_samp(a), 6) + 0.0 AS cv_std_acc,
  round(avg(a) - 2.7764451051977987 * stddev_samp(a) / sqrt(count(*)), 6) + 0.0 AS ci_lower,
  round(avg(a) + 2.7764451051977987 * stddev_samp(a) / sqrt(count(*)), 6) + 0.0 AS ci_upper
FROM acc GROUP BY model""")
def q_cv_summary(spark, sf):
    ci = S.confidence_interval(_cv(spark, sf), "accuracy", ["model"])
    return ci.select("model", r6("mean").alias("cv_mean_acc"), r6("std").alias("cv_std_acc"),
                     r6("ci_lower").alias("ci_lower"), r6("ci_upper").alias("ci_upper"))


@register("L8_cv_series", O.cv_sql() + """
SELECT model, fold, round((tp + tn) / n, 6) + 0.0 AS accuracy,
       round(avg((tp + tn) / n) OVER (PARTITION BY model), 6) + 0.0 AS mean_accuracy FROM cv""")
def q_cv_series(spark, sf):
    cv = _cv(spark, sf)
    from pyspark.sql import Window
    return cv.select("model", "fold", r6("accuracy").alias("accuracy"),
                     r6(F.avg("accuracy").over(Window.partitionBy("model"))).alias("mean_accuracy"))


@register("A27_paired_t_test", O.cv_sql() + """, acc AS (SELECT model, fold, (tp + tn) / n AS a FROM cv),
d AS (SELECT x.fold, x.a - y.a AS diff FROM acc x JOIN acc y ON x.fold = y.fold
      WHERE x.model = 'multinomial' AND y.model = 'bernoulli'),
st AS (SELECT avg(diff) AS dm, count(*) AS n,
       CASE WHEN var_samp(diff) > 0 THEN sqrt(var_samp(diff)) ELSE 1e-10 END AS sd FROM d)
SELECT 'multinomial' AS model_a, 'bernoulli' AS model_b, round(dm, 6) + 0.0 AS mean_diff,
       round(dm / (sd / sqrt(n)), 6) + 0.0 AS t_statistic, CAST(n - 1 AS BIGINT) AS df FROM st""")
def q_ttest(spark, sf):
    t = S.paired_t_test(_cv(spark, sf), "multinomial", "bernoulli")
    return t.select("model_a", "model_b", r6("mean_diff").alias("mean_diff"),
                    r6("t_statistic").alias("t_statistic"), "df")


@register("M6_t_p_value", O.cv_sql() + """, acc AS (SELECT model, fold, (tp + tn) / n AS a FROM cv),
d AS (SELECT x.fold, x.a - y.a AS diff FROM acc x JOIN acc y ON x.fold = y.fold
      WHERE x.model = 'multinomial' AND y.model = 'bernoulli'),
st AS (SELECT avg(diff) AS dm, count(*) AS n,
       CASE WHEN var_samp(diff) > 0 THEN sqrt(var_samp(diff)) ELSE 1e-10 END AS sd FROM d),
tt AS (SELECT dm, n, dm / (sd / sqrt(n)) AS t FROM st),
pv AS (SELECT *, 1 - sin(atan(abs(t) / 2)) * (1 + 0.5 * pow(cos(atan(abs(t) / 2)), 2)) AS p FROM tt)
SELECT 'multinomial' AS model_a, 'bernoulli' AS model_b, round(t, 6) + 0.0 AS t_statistic,
       CAST(n - 1 AS BIGINT) AS df, round(p, 6) + 0.0 AS p_value, p < 0.05 AS reject_null,
       CASE WHEN p < 0.05 AND dm > 0 THEN '""" + C.BETTER_THAN.format("multinomial", "bernoulli") + """'
            WHEN p < 0.05 THEN '""" + C.BETTER_THAN.format("bernoulli", "multinomial") + """'
            ELSE '""" + C.NO_DIFFERENCE + """' END AS conclusion
FROM pv""")
def q_tp(spark, sf):
    """Two-sided p-value of the paired t statistic (closed-form Student-t
    CDF for integer degrees of freedom) with the verdict."""
    t = S.paired_t_test(_cv(spark, sf), "multinomial", "bernoulli")
    return t.select("model_a", "model_b", r6("t_statistic").alias("t_statistic"), "df",
                    r6("p_value").alias("p_value"), "reject_null", "conclusion")


_MCN = _TEST + """, pr AS (SELECT doc_id, label, model, raw_prediction FROM lsc),
bc AS (SELECT b.model AS model_b,
  count(*) FILTER (WHERE a.raw_prediction = a.label AND b.raw_prediction <> b.label) AS b,
  count(*) FILTER (WHERE a.raw_prediction <> a.label AND b.raw_prediction = b.label) AS c
  FROM pr a JOIN pr b ON a.doc_id = b.doc_id WHERE a.model = 'multinomial' AND b.model <> 'multinomial'
  GROUP BY b.model)
"""


@register("A28_mcnemar", _MCN + """
SELECT 'multinomial' AS model_a, model_b, CAST(b AS BIGINT) AS b, CAST(c AS BIGINT) AS c,
  round(CASE WHEN b + c = 0 THEN 0.0 ELSE pow(abs(b - c) - 1, 2) / (b + c) END, 6) + 0.0 AS chi2
FROM bc""")
def q_mcnemar(spark, sf):
    m = S.mcnemar(_test_scores(spark, sf), "multinomial")
    return m.select("model_a", "model_b", "b", "c", r6("chi2").alias("chi2"))


_ERFC = """1 - 2 / sqrt(pi()) * exp(-z * z) * list_sum(list_transform(range(0, 90),
  lambda k: CASE WHEN z = 0 THEN 0 ELSE exp((2 * k + 1) * ln(z) + 2 * k * ln(2) + lgamma(k + 1)
    - lgamma(2 * k + 2)) END))"""


@register("M7_L5_mcnemar_p_value", _MCN + f"""
, ch AS (SELECT *, CASE WHEN b + c = 0 THEN 0.0 ELSE pow(abs(b - c) - 1, 2) / (b + c) END AS chi2 FROM bc),
pv AS (SELECT *, CASE WHEN b + c = 0 THEN 1.0 ELSE {_ERFC} END AS p FROM (SELECT *, sqrt(chi2 / 2) AS z FROM ch))
SELECT 'multinomial' AS model_a, model_b, CAST(b AS BIGINT) AS b, CAST(c AS BIGINT) AS c,
  round(chi2, 6) + 0.0 AS chi2, round(p, 6) + 0.0 AS p_value, p < 0.05 AS reject_null,
  CASE WHEN p < 0.05 AND b > c THEN '{C.BETTER.format('multinomial')}'
       WHEN p < 0.05 THEN model_b || '{C.BETTER.format('')}' ELSE '{C.NO_DIFFERENCE}' END AS conclusion
FROM pv""")
def q_mcnemar_p(spark, sf):
    m = S.mcnemar(_test_scores(spark, sf), "multinomial")
    return m.select("model_a", "model_b", "b", "c", r6("chi2").alias("chi2"),
                    r6("p_value").alias("p_value"), "reject_null", "conclusion")


# ---------------------------------------------------------------------------
# Sender rules, requests, ensemble, label noise (J9, A29, M8, S7, P8, I5, M9,
# P10, P11, I6, A30, A31, A24, I4, W7)
# ---------------------------------------------------------------------------

from nbsieve.operators import ensemble as EN  # noqa: E402
from nbsieve.operators import explain as X  # noqa: E402
from nbsieve.operators import rules as R  # noqa: E402

# Rule set used against the driver data: the fixed sender rules never match
# these documents, so two word rules exercise the matching path as well.
CUSTOM_RULES = tuple(C.SENDER_RULES) + ((r"\btrash\b", 0.30), (r"\bworthless\b", 0.40))


@register("J9_A29_M8_sender_boost", "SELECT doc_id, " + O.boost_sql("text", CUSTOM_RULES)
          + " AS boost FROM documents")
def q_boost(spark, sf):
    d = tables.table(spark, sf, "documents").select("doc_id", "text")
    return d.select("doc_id", R.sender_boost(F.col("text"), CUSTOM_RULES).alias("boost"))


@register("J9_A29_rules_table", r"""
WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z0-9]{4,}')) AS w FROM benchmark),
rules AS (SELECT w, length(w) % 3 AS kind, least(length(w), 99) / 100.0 AS boost FROM w),
runs AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}_]+')) AS r FROM documents),
hits AS (
  SELECT doc_id, boost FROM runs JOIN rules ON r = w WHERE kind = 0
  UNION ALL SELECT doc_id, boost FROM documents JOIN rules ON kind = 1 AND contains(lower(text), w)
  UNION ALL SELECT doc_id, boost FROM runs JOIN rules ON substr(r, 1, 4) = substr(w, 1, 4)
    WHERE kind = 2 AND starts_with(r, w) AND regexp_full_match(substr(r, length(w) + 1), '[a-z]*'))
SELECT d.doc_id, CAST(coalesce(max(h.boost), 0) AS DOUBLE) AS boost
FROM documents d LEFT JOIN hits h ON d.doc_id = h.doc_id GROUP BY d.doc_id""")
def q_rules_table(spark, sf):
    """A rule for every distinct word of the benchmark's items: a whole word, a
    fragment with optional endings, or a word's start."""
    words = tables.table(spark, sf, "benchmark").select(F.explode(F.regexp_extract_all(
        F.lower("text"), F.lit("[a-z0-9]{4,}"), F.lit(0))).alias("w")).distinct()
    kind = F.length("w") % 3
    pattern = F.when(kind == 0, F.concat(F.lit(r"\b"), "w", F.lit(r"\b"))) \
        .when(kind == 1, F.concat("w", F.lit("(ing|ed)?s?"))) \
        .otherwise(F.concat(F.lit(r"\b"), "w", F.lit(r"[a-z]*\b")))
    rules = words.select(pattern.alias("pattern"), (F.least(F.length("w"), F.lit(99)) / 100.0).alias("boost"))
    d = tables.table(spark, sf, "documents").select("doc_id", "text")
    return R.boosts_by_table(d, rules)


def _alld_sql():
    return O.tokens_cte(
        "alld", "(SELECT d.doc_id, d.text, CASE WHEN l.toxic IS NULL THEN NULL WHEN l.toxic = 1 "
        "THEN 'spam' ELSE 'ham' END AS label FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)",
        "doc_id, label")


_CONF_EXPL = (f"CASE WHEN is_confident THEN printf('{C.CONFIDENT_TEXT.format(0.7)}', "
              f"upper(raw_prediction), confidence) ELSE printf('{C.UNCERTAIN_TEXT.format(0.7)}', "
              "p_spam, p_ham) END")


@register("S7_I5_P8_M9_request_scoring", O.with_model(
    _alld_sql(), O.scores_cte("alld"), O.long_scores(models=("multinomial",), thr=0.65)) + f"""
, rq AS (
  SELECT l.doc_id AS request_id, l.n_tokens, l.p_spam, l.p_ham, l.raw_prediction, l.prediction,
         l.confidence, l.is_confident, {_CONF_EXPL} AS explanation,
         d.text, NOT regexp_matches(d.text, '[^{C.PY_WHITESPACE}]') AS blank, {O.boost_sql('d.text', CUSTOM_RULES)} AS boost
  FROM lsc l JOIN documents d ON l.doc_id = d.doc_id
), rb AS (
  SELECT *, CASE WHEN boost > 0 THEN least(1.0, p_spam + boost) ELSE p_spam END AS boosted FROM rq
), rc AS (SELECT *, boosted <> p_spam AS changed, boosted <> p_spam AND boosted > 1 - 0.65 AS flips FROM rb)
SELECT request_id, CASE WHEN blank THEN 'error' ELSE 'ok' END AS status,
  CASE WHEN blank THEN NULL WHEN n_tokens = 0 THEN 'uncertain' WHEN flips THEN 'spam' ELSE prediction END AS prediction,
  round(CASE WHEN blank THEN NULL WHEN n_tokens = 0 THEN 0.0 WHEN flips THEN boosted ELSE confidence END, 6) + 0.0 AS confidence,
  CASE WHEN blank THEN NULL WHEN n_tokens = 0 THEN false WHEN flips THEN true ELSE is_confident END AS is_confident,
  CASE WHEN blank THEN '{C.BLANK_TEXT}' WHEN n_tokens = 0 THEN '{C.NO_WORDS_TEXT}'
       WHEN flips THEN printf('{C.BOOSTED_TEXT}', boosted) ELSE explanation END AS explanation,
  round(CASE WHEN blank THEN NULL WHEN n_tokens = 0 THEN 0.5 WHEN changed THEN boosted ELSE p_spam END, 6) + 0.0 AS p_spam,
  round(CASE WHEN blank THEN NULL WHEN n_tokens = 0 THEN 0.5 WHEN changed THEN 1 - boosted ELSE p_ham END, 6) + 0.0 AS p_ham,
  (NOT blank AND n_tokens > 0 AND changed) AS boost_applied
FROM rc""")
def q_requests(spark, sf):
    p = _prepared(spark, sf)
    req = tables.table(spark, sf, "documents").select(
        F.col("doc_id").alias("request_id"), F.col("text").alias("message"),
        F.lit(None).cast("double").alias("decision_threshold"),
        F.lit(True).alias("use_sender_boost"))
    out = R.score_requests(p.model, req, rules=CUSTOM_RULES)
    return out.select(*[r6(c).alias(c) if c in ("confidence", "p_spam", "p_ham") else F.col(c)
                        for c in out.columns])


@register("P10_P11_inbox_badges", O.with_model(
    _alld_sql(), O.scores_cte("alld"), O.long_scores(models=("multinomial",), thr=0.65)) + """
SELECT doc_id, prediction,
  CASE WHEN prediction = 'spam' THEN printf('[SPAM %.0f%%]', confidence * 100) ELSE '[HAM]' END AS badge,
  CASE WHEN prediction = 'spam' THEN '""" + C.POPUP_SPAM + """' WHEN prediction = 'ham' THEN '""" + C.POPUP_HAM + """'
       ELSE '""" + C.POPUP_UNCERTAIN + """' END AS popup_verdict
FROM lsc""")
def q_badges(spark, sf):
    p = _prepared(spark, sf)
    docs = nb.tokenize(tables.all_documents(spark, sf).select("doc_id", "label", "text"))
    s = nb.score(p.model, docs, models=("multinomial",), decision_threshold=0.65)
    b = R.badges(F.col("prediction"), F.col("confidence"))
    return s.select("doc_id", "prediction", b[0], b[1])


# Inbox rows: subject = first line, snippet = the rest; every 40th subject is
# missing, and every 41st and 43rd row holds white space only.
_INBOX_SQL = """SELECT doc_id, CASE WHEN doc_id % 40 = 0 THEN NULL WHEN doc_id % 41 = 0 THEN chr(9) || chr(10)
    WHEN doc_id % 43 = 0 THEN chr(160) ELSE string_split(text, chr(10))[1] END AS subject,
  CASE WHEN doc_id % 41 = 0 THEN ' ' || chr(8195) WHEN doc_id % 43 = 0 THEN NULL
    ELSE substr(text, length(string_split(text, chr(10))[1]) + 2) END AS snippet FROM documents"""


def _inbox(spark, sf):
    d = tables.table(spark, sf, "documents").select("doc_id", "text")
    first = F.substring_index("text", "\n", 1)
    i = F.col("doc_id")
    return d.select(
        "doc_id",
        F.when(i % 40 == 0, F.lit(None)).when(i % 41 == 0, "\t\n").when(i % 43 == 0, "\u00a0")
        .otherwise(first).alias("subject"),
        F.when(i % 41 == 0, " \u2003").when(i % 43 == 0, F.lit(None))
        .otherwise(F.expr("substring(text, length(substring_index(text, '\\n', 1)) + 2)")).alias("snippet"))


def _not_blank(text: str) -> str:
    return f"regexp_matches({text}, '[^{C.PY_WHITESPACE}]')"


@register("P10_inbox_text", "SELECT doc_id, CASE WHEN subject IS NOT NULL AND "
          + _not_blank("subject || ' ' || coalesce(snippet, '')")
          + " THEN subject || ' ' || coalesce(snippet, '') END AS message FROM (" + _INBOX_SQL + ")")
def q_inbox_text(spark, sf):
    """P10: the text of an inbox row; NULL (skipped) without a subject or
    with nothing but white space."""
    x = _inbox(spark, sf)
    return x.select("doc_id", R.inbox_text(F.col("subject"), F.col("snippet")).alias("message"))


@register("P8_blank_requests", "SELECT doc_id AS request_id, CASE WHEN "
          + _not_blank("coalesce(subject, '') || coalesce(snippet, '')")
          + " THEN 'ok' ELSE 'error' END AS status, CASE WHEN NOT "
          + _not_blank("coalesce(subject, '') || coalesce(snippet, '')")
          + f" THEN '{C.BLANK_TEXT}' END AS error FROM (" + _INBOX_SQL + ")")
def q_blank_requests(spark, sf):
    """Requests of white space of any kind are errors, others are not."""
    p = _prepared(spark, sf)
    req = _inbox(spark, sf).select(
        F.col("doc_id").alias("request_id"),
        F.concat(F.coalesce("subject", F.lit("")), F.coalesce("snippet", F.lit(""))).alias("message"),
        F.lit(None).cast("double").alias("decision_threshold"),
        F.lit(None).cast("boolean").alias("use_sender_boost"))
    out = R.score_requests(p.model, req)
    return out.select("request_id", "status",
                      F.when(F.col("status") == "error", F.col("explanation")).alias("error"))


def _labelled_scores(p: pipeline.Prepared) -> DataFrame:
    """Every labelled message's scores, stored: totals, counts and examples read them."""
    return p.once("labelled scores", lambda: nb.score(p.model, p.tok))


@register("A32_smoke_errors", O.with_model(O.scores_cte("tok"), O.long_scores()) + """
SELECT model, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE label <> CASE
    WHEN prediction <> 'uncertain' THEN prediction WHEN p_spam > p_ham THEN 'spam' ELSE 'ham' END) AS BIGINT) AS errors
FROM lsc GROUP BY model""")
def q_smoke(spark, sf):
    """A32 over all labelled messages: uncertain verdicts resolved by the
    larger probability, mismatches with the label counted per model."""
    return EN.smoke_errors(_labelled_scores(_prepared(spark, sf)))


_ENS = O.with_model(
    "tst AS (SELECT * FROM tok WHERE split = 'test')", O.scores_cte("tst"), O.long_scores(),
    O.metrics_sql(), _alld_sql(), O.scores_cte("alld", name="sca"),
    O.long_scores("sca", thr=0.65, out="lsa")) + """
, wts AS (SELECT model, f1 AS weight FROM rep)
"""


@register("I6_A30_A31_ensemble", _ENS + f"""
, ag AS (
  SELECT s.doc_id, sum(w.weight * s.p_spam) / sum(w.weight) AS wp,
         count(DISTINCT CASE WHEN s.prediction <> 'uncertain' THEN s.prediction END) AS npred
  FROM lsa s JOIN wts w ON s.model = w.model GROUP BY s.doc_id
), bo AS (SELECT ag.*, {O.boost_sql('d.text', C.SENDER_RULES)} AS boost FROM ag JOIN documents d ON ag.doc_id = d.doc_id),
fin AS (SELECT *, CASE WHEN boost > 0 THEN least(1.0, wp + boost) ELSE wp END AS p FROM bo)
SELECT doc_id, round(wp, 6) + 0.0 AS weighted_p_spam, round(p, 6) + 0.0 AS p_spam,
  CASE WHEN p > 1 - 0.65 THEN 'spam' ELSE 'ham' END AS prediction,
  round(CASE WHEN p > 1 - 0.65 THEN p ELSE 1 - p END, 6) + 0.0 AS confidence, npred <= 1 AS consensus
FROM fin""")
def q_ensemble(spark, sf):
    p = _prepared(spark, sf)
    test = nb.score(p.model, p.part("test"))
    # Weights need only F1 (confusion counts), not the curve metrics.
    weights = M.confusion(test).select("model", r6(M.report_columns()[3]).alias("weight"))
    docs = nb.tokenize(tables.all_documents(spark, sf).select("doc_id", "label", "text"))
    s = nb.score(p.model, docs, decision_threshold=0.65)
    boosts = tables.table(spark, sf, "documents").select(
        "doc_id", R.sender_boost(F.col("text")).alias("boost"))
    e = EN.ensemble(s, weights, boosts)
    return e.select("doc_id", r6("weighted_p_spam").alias("weighted_p_spam"), r6("p_spam").alias("p_spam"),
                    "prediction", r6("confidence").alias("confidence"), "consensus")


_NOISE = O.with_model(O.scores_cte("tok"), O.long_scores()) + """
, nz AS (SELECT *, CASE WHEN NOT is_confident THEN 'uncertain'
    WHEN (CASE WHEN p_spam > p_ham THEN 'spam' ELSE 'ham' END) = label THEN 'confident_correct'
    ELSE 'confident_wrong' END AS category FROM lsc)
"""


@register("A24_I4_label_noise", _NOISE + """
, cats AS (SELECT * FROM (VALUES ('confident_correct'), ('confident_wrong'), ('uncertain')) t(category)),
tot AS (SELECT model, count(*) AS total FROM nz GROUP BY model)
SELECT t.model, c.category, CAST(coalesce(n.n, 0) AS BIGINT) AS n, CAST(t.total AS BIGINT) AS total,
  round(coalesce(n.n, 0) / t.total * 100, 6) + 0.0 AS pct
FROM tot t CROSS JOIN cats c LEFT JOIN (SELECT model, category, count(*) AS n FROM nz GROUP BY ALL) n
  ON n.model = t.model AND n.category = c.category""")
def q_noise(spark, sf):
    p = _prepared(spark, sf)
    nz = EN.label_noise(_labelled_scores(p))
    s = EN.noise_summary(nz)
    return s.select("model", "category", "n", "total", r6("pct").alias("pct"))


@register("W7_noise_examples", _NOISE + """
SELECT nz.model, nz.category, CAST(rk AS BIGINT) AS example_rank, nz.doc_id, nz.label, nz.argmax,
       round(nz.confidence, 6) + 0.0 AS confidence, array_to_string(t.tokens[1:10], ' ') AS tokens_preview
FROM (SELECT *, CASE WHEN p_spam > p_ham THEN 'spam' ELSE 'ham' END AS argmax,
             row_number() OVER (PARTITION BY model, category ORDER BY doc_id) AS rk FROM nz
      WHERE category <> 'confident_correct') nz JOIN tok t ON nz.doc_id = t.doc_id WHERE rk <= 5""")
def q_noise_examples(spark, sf):
    p = _prepared(spark, sf)
    nz = EN.label_noise(_labelled_scores(p))
    ex = EN.noise_examples(nz, p.tok)
    return ex.select("model", "category", "example_rank", "doc_id", "label", "argmax",
                     r6("confidence").alias("confidence"), "tokens_preview")


# ---------------------------------------------------------------------------
# Explanations
# ---------------------------------------------------------------------------

def _all_tokens(spark, sf):
    """Every document, labelled or not: explanations are for any message."""
    return nb.tokenize(tables.all_documents(spark, sf).select("doc_id", "label", "text"))


def _every_document(spark, sf, p, read, form):
    """Every document, labelled or not: ``read`` of the set that training stored, and
    ``form`` of the tokens of the others, stored. A document that the set holds twice
    (its id or label repeats) is one of the others, so each comes as often as it does
    in the tables."""
    once = p.once("once", lambda: p.tok.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n = 1").select("doc_id"))
    others = tables.all_documents(spark, sf, but=once).select("doc_id", "label", "text")
    held = p.tok
    if p.tok.count() != once.count():
        held = held.join(once, "doc_id", "left_semi")
    return read(held).unionByName(cut_lineage(form(nb.tokenize(others))))


def _all_terms(spark, sf, p):
    """Distinct tokens with frequencies."""
    keep = ["doc_id", "label"]
    return _every_document(spark, sf, p, lambda x: x.select(*keep, "terms"),
                           lambda x: T.add_term_frequencies(x, keep=keep))


def _all_words(spark, sf, p):
    """Distinct tokens alone."""
    return _every_document(spark, sf, p, lambda x: x.select("doc_id", F.col("terms.token").alias("words")),
                           lambda x: x.select("doc_id", F.array_distinct("tokens").alias("words")))


_LR = """lr AS (SELECT v.token, ln((v.n_spam + 1.0) / (cls.ntok_spam + 1.0 * vsz.V))
    - ln((v.n_ham + 1.0) / (cls.ntok_ham + 1.0 * vsz.V)) AS score FROM voc v, cls, vsz)"""


@register("T4_message_evidence", O.with_model(_alld_sql(), _LR) + """
, ev AS (SELECT d.doc_id, d.token, lr.score FROM (SELECT doc_id, unnest(list_distinct(tokens)) AS token FROM alld) d
         JOIN lr ON d.token = lr.token),
rk AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, token) AS r_top,
              row_number() OVER (PARTITION BY doc_id ORDER BY score, token DESC) AS r_bot FROM ev)
SELECT doc_id, 'spam' AS side, CAST(r_top AS INTEGER) AS rank, token, round(score, 6) + 0.0 AS score FROM rk WHERE r_top <= 10
UNION ALL
SELECT doc_id, 'ham', CAST(r_bot AS INTEGER), token, round(score, 6) + 0.0 FROM rk WHERE r_bot <= 10""")
def q_evidence(spark, sf):
    p = _prepared(spark, sf)
    t = X.top_evidence(X.doc_evidence(p.model, _all_tokens(spark, sf)), 10)
    return t.select("doc_id", "side", "rank", "token", r6("score").alias("score"))


@register("T5_P9_unigram_evidence", O.with_model(_alld_sql(), _LR) + """
, ev AS (SELECT d.doc_id, d.token, lr.score FROM (SELECT doc_id, unnest(list_distinct(
           list_filter(tokens, lambda t: NOT contains(t, '_')))) AS token FROM alld) d JOIN lr ON d.token = lr.token),
rk AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, token) AS r_top,
              row_number() OVER (PARTITION BY doc_id ORDER BY score, token DESC) AS r_bot FROM ev)
SELECT doc_id, 'spam' AS side, CAST(r_top AS INTEGER) AS rank, token, round(score, 6) + 0.0 AS score,
       round(least(100.0, abs(score) * 20), 6) + 0.0 AS bar FROM rk WHERE r_top <= 5
UNION ALL
SELECT doc_id, 'ham', CAST(r_bot AS INTEGER), token, round(score, 6) + 0.0, round(least(100.0, abs(score) * 20), 6) + 0.0
FROM rk WHERE r_bot <= 5""")
def q_unigram_evidence(spark, sf):
    p = _prepared(spark, sf)
    t = X.evidence_bars(X.doc_evidence(p.model, _all_tokens(spark, sf), unigrams_only=True), 5)
    return t.select("doc_id", "side", "rank", "token", r6("score").alias("score"), r6("bar").alias("bar"))


@register("T6_J6_corpus_top_words", O.with_model(_LR) + """
SELECT * FROM (SELECT 'spam' AS side, token, round(score, 6) + 0.0 AS score FROM lr ORDER BY score DESC, token LIMIT 10)
UNION ALL
SELECT * FROM (SELECT 'ham', token, round(score, 6) + 0.0 FROM lr ORDER BY score, token DESC LIMIT 10)""")
def q_corpus_top(spark, sf):
    p = _prepared(spark, sf)
    return X.corpus_top_words(p.model).select("side", "token", r6("score").alias("score"))


@register("T7_J7_pruned_vocabulary", O.with_model(_LR) + f"""
SELECT v.token, v.n_spam, v.n_ham, round(abs(lr.score), 6) + 0.0 AS abs_score
FROM voc v JOIN (SELECT * FROM lr ORDER BY abs(score) DESC, token LIMIT {C.MAX_VOCAB_PRUNED}) lr
  ON v.token = lr.token""")
def q_pruned(spark, sf):
    p = _prepared(spark, sf)
    kept = X.prune_vocabulary(p.model)
    pc = X.pruned_counts(p.model, kept)
    return pc.join(kept, "token").select("token", "n_spam", "n_ham", r6("abs_score").alias("abs_score"))


_SMALL_VOCABULARY = 2_000


@register("T7_J7_pruned_scoring", O.with_model(_LR) + f"""
, kept AS (SELECT token FROM lr ORDER BY abs(score) DESC, token LIMIT {_SMALL_VOCABULARY}),
tst AS (SELECT * FROM tok WHERE split = 'test'),
ms AS (SELECT o.doc_id, sum(ln(v.n_spam + 1.0)) AS s, sum(ln(v.n_ham + 1.0)) AS h
       FROM (SELECT doc_id, unnest(tokens) AS token FROM tst) o
       JOIN voc v ON o.token = v.token JOIN kept k ON k.token = v.token GROUP BY 1)
SELECT d.doc_id, round((ln(cls.n_docs_spam / cls.n_docs) - ln(cls.n_docs_ham / cls.n_docs)
   + coalesce(s - h, 0) - len(d.tokens) * (ln(cls.ntok_spam + vsz.V) - ln(cls.ntok_ham + vsz.V)))
   / greatest(1.0, greatest(1, len(d.tokens)) / 10.0), 6) + 0.0 AS log_odds
FROM tst d LEFT JOIN ms ON d.doc_id = ms.doc_id CROSS JOIN cls CROSS JOIN vsz""")
def q_pruned_scoring(spark, sf):
    """T7 + J7 where the cut prunes: test messages scored with the 2,000
    strongest words; the others count as unseen, V stays."""
    p = _prepared(spark, sf)
    kept = X.prune_vocabulary(p.model, _SMALL_VOCABULARY)
    pruned = nb.NBModel(counts=X.pruned_counts(p.model, kept), all_counts=p.model.all_counts,
                        stats=p.model.stats, vocab_size=_SMALL_VOCABULARY)
    s = nb.score(pruned, p.part("test"), models=("multinomial",), log_odds=True)
    return s.select("doc_id", r6("log_odds").alias("log_odds"))


@register("T7_J7_pruned_scoring_all", O.with_model(_LR, _alld_sql()) + f"""
, kept AS (SELECT token FROM lr ORDER BY abs(score) DESC, token LIMIT {_SMALL_VOCABULARY}),
ms AS (SELECT o.doc_id, sum(ln(v.n_spam + 1.0)) AS s, sum(ln(v.n_ham + 1.0)) AS h
       FROM (SELECT doc_id, unnest(tokens) AS token FROM alld) o
       JOIN voc v ON o.token = v.token JOIN kept k ON k.token = v.token GROUP BY 1)
SELECT d.doc_id, round((ln(cls.n_docs_spam / cls.n_docs) - ln(cls.n_docs_ham / cls.n_docs)
   + coalesce(s - h, 0) - len(d.tokens) * (ln(cls.ntok_spam + vsz.V) - ln(cls.ntok_ham + vsz.V)))
   / greatest(1.0, greatest(1, len(d.tokens)) / 10.0), 6) + 0.0 AS log_odds
FROM alld d LEFT JOIN ms ON d.doc_id = ms.doc_id CROSS JOIN cls CROSS JOIN vsz""")
def q_pruned_scoring_all(spark, sf):
    """T7 + J7 over every document, unlabelled ones included, with the 2,000
    strongest words; the others count as unseen, V stays."""
    p = _prepared(spark, sf)
    kept = X.prune_vocabulary(p.model, _SMALL_VOCABULARY)
    pruned = nb.NBModel(counts=X.pruned_counts(p.model, kept), all_counts=p.model.all_counts,
                        stats=p.model.stats, vocab_size=_SMALL_VOCABULARY)
    docs = nb.tokenize(tables.all_documents(spark, sf).select("doc_id", "label", "text"))
    s = nb.score(pruned, docs, models=("multinomial",), log_odds=True)
    return s.select("doc_id", r6("log_odds").alias("log_odds"))


@register("T2_T3_word_clouds", O.with_model() + """
SELECT label, token, count, CAST(rank AS BIGINT) AS rank, round(count / max(count) OVER (PARTITION BY label), 6) + 0.0 AS weight
FROM (SELECT label, token, count, row_number() OVER (PARTITION BY label ORDER BY count DESC, token) AS rank
      FROM (SELECT 'spam' AS label, token, n_spam AS count FROM cnt WHERE n_spam > 0
            UNION ALL SELECT 'ham', token, n_ham FROM cnt WHERE n_ham > 0)) WHERE rank <= 100""")
def q_clouds(spark, sf):
    p = _prepared(spark, sf)
    w = X.word_clouds(p.model.all_counts, 100)
    return w.select("label", "token", "count", "rank", r6("weight").alias("weight"))


_BENCH_WORDS = O.tokens_cte("bt", "benchmark", "item_id") + """,
words AS (SELECT DISTINCT unnest(list_filter(tokens, lambda t: NOT contains(t, '_'))) AS token FROM bt)"""


def _bench_words(spark, sf):
    b = nb.tokenize(tables.table(spark, sf, "benchmark").select("item_id", "text"))
    return nb.explode_tokens(b.select(T.unigram_only(F.col("tokens")).alias("u")), "u", []).distinct()


@register("I10_word_trace", O.with_model(_BENCH_WORDS) + """
SELECT w.token, CAST(coalesce(c.n_spam, 0) AS BIGINT) AS count_spam,
  round(coalesce(c.n_spam, 0) + 1.0, 6) + 0.0 AS numerator_spam,
  round(cls.ntok_spam + 1.0 * vsz.V, 6) + 0.0 AS denominator_spam,
  round((coalesce(c.n_spam, 0) + 1.0) / (cls.ntok_spam + 1.0 * vsz.V), 6) + 0.0 AS p_spam,
  CAST(coalesce(c.n_ham, 0) AS BIGINT) AS count_ham,
  round(coalesce(c.n_ham, 0) + 1.0, 6) + 0.0 AS numerator_ham,
  round(cls.ntok_ham + 1.0 * vsz.V, 6) + 0.0 AS denominator_ham,
  round((coalesce(c.n_ham, 0) + 1.0) / (cls.ntok_ham + 1.0 * vsz.V), 6) + 0.0 AS p_ham
FROM words w LEFT JOIN cnt c ON w.token = c.token, cls, vsz""")
def q_word_trace(spark, sf):
    p = _prepared(spark, sf)
    t = X.word_trace(p.model, _bench_words(spark, sf))
    return t.select(*[r6(c).alias(c) if c.startswith(("numerator", "denominator", "p_")) else F.col(c)
                      for c in t.columns])


@register("J12_vocabulary_probe", O.with_model(_BENCH_WORDS) + """
SELECT w.token, v.token IS NOT NULL AS in_vocabulary FROM words w LEFT JOIN voc v ON w.token = v.token""")
def q_probe(spark, sf):
    p = _prepared(spark, sf)
    return X.vocabulary_probe(p.model, _bench_words(spark, sf))


@register("I9_absent_sample", O.with_model() + """
SELECT token, round(pas, 6) + 0.0 AS p_absent_spam, round(pah, 6) + 0.0 AS p_absent_ham, round(pas / pah, 6) + 0.0 AS ratio
FROM (SELECT v.token, 1 - (v.df_spam + 1.0) / (cls.n_docs_spam + 2.0) AS pas,
             1 - (v.df_ham + 1.0) / (cls.n_docs_ham + 2.0) AS pah FROM voc v, cls
      ORDER BY md5('42-' || v.token) LIMIT 10)""")
def q_absent(spark, sf):
    p = _prepared(spark, sf)
    a = X.absent_sample(p.model)
    return a.select("token", *[r6(c).alias(c) for c in ("p_absent_spam", "p_absent_ham", "ratio")])


@register("I7_multinomial_trace", O.with_model(_alld_sql()) + """
, tf AS (SELECT doc_id, token, count(*) AS tf FROM (SELECT doc_id, unnest(tokens) AS token FROM alld) GROUP BY ALL),
cl AS (SELECT * FROM (VALUES ('spam'), ('ham')) t(class)),
pt AS (
  SELECT t.doc_id, cl.class, t.token, CAST(t.tf AS INTEGER) AS tf,
    CASE WHEN v.token IS NULL THEN ln(1.0 / (CASE WHEN cl.class = 'spam' THEN cls.ntok_spam ELSE cls.ntok_ham END + vsz.V))
         ELSE ln((CASE WHEN cl.class = 'spam' THEN v.n_spam ELSE v.n_ham END + 1.0)
                 / (CASE WHEN cl.class = 'spam' THEN cls.ntok_spam ELSE cls.ntok_ham END + vsz.V)) END AS ll,
    v.token IS NULL AS unseen,
    ln(CASE WHEN cl.class = 'spam' THEN cls.n_docs_spam ELSE cls.n_docs_ham END / cls.n_docs) AS lprior
  FROM tf t CROSS JOIN cl LEFT JOIN voc v ON t.token = v.token CROSS JOIN cls CROSS JOIN vsz),
tt AS (
  SELECT d.doc_id, cl.class, coalesce(sum(pt.tf * pt.ll), 0.0) AS contribution,
    ln(CASE WHEN cl.class = 'spam' THEN cls.n_docs_spam ELSE cls.n_docs_ham END / cls.n_docs) AS lprior
  FROM alld d CROSS JOIN cl CROSS JOIN cls LEFT JOIN pt ON pt.doc_id = d.doc_id AND pt.class = cl.class
  GROUP BY d.doc_id, cl.class, cls.n_docs_spam, cls.n_docs_ham, cls.n_docs)
SELECT doc_id, class, token, tf, round(ll, 6) + 0.0 AS log_lik, unseen, round(tf * ll, 6) + 0.0 AS contribution,
       round(lprior, 6) + 0.0 AS log_prior, CAST(NULL AS DOUBLE) AS log_posterior FROM pt
UNION ALL
SELECT doc_id, class, NULL, NULL, NULL, NULL, round(contribution, 6) + 0.0, round(lprior, 6) + 0.0,
       round(lprior + contribution, 6) + 0.0 FROM tt""")
def q_mtrace(spark, sf):
    p = _prepared(spark, sf)
    return X.multinomial_trace(p.model, _all_terms(spark, sf, p), digits=6)


_BTRACE = O.with_model(_alld_sql(), "b AS (SELECT 1)") + """
, cl AS (SELECT * FROM (VALUES ('spam'), ('ham')) t(class)),
pt AS (
  SELECT d.doc_id, cl.class, d.token,
    (CASE WHEN cl.class = 'spam' THEN v.df_spam ELSE v.df_ham END + 1.0)
      / (CASE WHEN cl.class = 'spam' THEN cls.n_docs_spam ELSE cls.n_docs_ham END + 2.0) AS p
  FROM (SELECT doc_id, unnest(list_distinct(tokens)) AS token FROM alld) d JOIN voc v ON d.token = v.token
  CROSS JOIN cl CROSS JOIN cls),
base AS (SELECT cl.class, sum(ln(1 - (CASE WHEN cl.class = 'spam' THEN v.df_spam ELSE v.df_ham END + 1.0)
    / (CASE WHEN cl.class = 'spam' THEN cls.n_docs_spam ELSE cls.n_docs_ham END + 2.0))) AS baseline
  FROM voc v CROSS JOIN cl CROSS JOIN cls GROUP BY cl.class)
"""


@register("I8_bernoulli_trace_tokens", _BTRACE + """
SELECT doc_id, class, token, round(ln(p), 6) + 0.0 AS log_p_present, round(ln(1 - p), 6) + 0.0 AS log_p_absent,
       round(ln(p) - ln(1 - p), 6) + 0.0 AS delta FROM pt""")
def q_btrace_tokens(spark, sf):
    p = _prepared(spark, sf)
    per_tok, _ = X.bernoulli_trace(p.model, _all_words(spark, sf, p), digits=6)
    return per_tok


@register("I8_bernoulli_trace_totals", _BTRACE + """
SELECT d.doc_id, cl.class, round(b.baseline, 6) + 0.0 AS baseline,
  round(coalesce(s.ds, 0.0), 6) + 0.0 AS delta_sum,
  round(ln(CASE WHEN cl.class = 'spam' THEN cls.n_docs_spam ELSE cls.n_docs_ham END / cls.n_docs), 6) + 0.0 AS log_prior,
  round(b.baseline + coalesce(s.ds, 0.0), 6) + 0.0 AS log_likelihood,
  round(ln(CASE WHEN cl.class = 'spam' THEN cls.n_docs_spam ELSE cls.n_docs_ham END / cls.n_docs)
        + b.baseline + coalesce(s.ds, 0.0), 6) + 0.0 AS log_posterior
FROM alld d CROSS JOIN cl CROSS JOIN cls JOIN base b ON b.class = cl.class
LEFT JOIN (SELECT doc_id, class, sum(ln(p) - ln(1 - p)) AS ds FROM pt GROUP BY ALL) s
  ON s.doc_id = d.doc_id AND s.class = cl.class""")
def q_btrace_totals(spark, sf):
    p = _prepared(spark, sf)
    _, tot = X.bernoulli_trace(p.model, _all_words(spark, sf, p))
    return tot.select("doc_id", "class", *[r6(c).alias(c) for c in
                                           ("baseline", "delta_sum", "log_prior", "log_likelihood",
                                            "log_posterior")])


@register("I12_message_report", O.with_model(
    _alld_sql(), O.scores_cte("alld"),
    O.long_scores(models=("multinomial",)), _LR) + f"""
, ev AS (SELECT d.doc_id, d.token, lr.score FROM (SELECT doc_id, unnest(list_distinct(tokens)) AS token FROM alld) d
         JOIN lr ON d.token = lr.token),
rk AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, token) AS r_top,
              row_number() OVER (PARTITION BY doc_id ORDER BY score, token DESC) AS r_bot FROM ev),
tops AS (SELECT doc_id, string_agg(CASE WHEN r_top <= 10 THEN token END, ' ' ORDER BY r_top) AS top_spam_words,
                string_agg(CASE WHEN r_bot <= 10 THEN token END, ' ' ORDER BY r_bot) AS top_ham_words FROM rk GROUP BY doc_id)
SELECT l.doc_id, l.prediction, round(l.confidence, 6) + 0.0 AS confidence, round(l.p_spam, 6) + 0.0 AS p_spam,
  round(l.p_ham, 6) + 0.0 AS p_ham, l.n_tokens, 1.0 AS alpha, {_CONF_EXPL} AS explanation,
  coalesce(t.top_spam_words, '') AS top_spam_words, coalesce(t.top_ham_words, '') AS top_ham_words
FROM lsc l LEFT JOIN tops t ON l.doc_id = t.doc_id""")
def q_report(spark, sf):
    p = _prepared(spark, sf)
    docs = _all_terms(spark, sf, p)         # scores and evidence read it
    # The ends of the evidence are small: stored first, its shuffles go before those of the scores.
    ev = cut_lineage(X.top_evidence(X.doc_evidence(p.model, docs), 10))
    free_shuffles(spark)
    s = nb.score(p.model, docs, models=("multinomial",), row_bytes=nb.JOINED_BYTES)    # the tiers of the evidence
    s = s.withColumn("explanation", nb.explanation(F.col("raw_prediction"), F.col("confidence"),
                                                   F.col("p_spam"), F.col("p_ham"),
                                                   F.col("is_confident"), C.CONFIDENCE_THRESHOLD))
    lists = ev.groupBy("doc_id").agg(*[
        F.array_join(F.transform(F.array_sort(F.collect_list(
            F.when(F.col("side") == side, F.struct("rank", "token")))), lambda s: s["token"]), " ")
        .alias(f"top_{side}_words") for side in ("spam", "ham")])
    out = s.join(lists, "doc_id", "left")
    return out.select("doc_id", "prediction", r6("confidence").alias("confidence"),
                      r6("p_spam").alias("p_spam"), r6("p_ham").alias("p_ham"), "n_tokens",
                      F.lit(C.ALPHA).alias("alpha"), "explanation",
                      F.coalesce("top_spam_words", F.lit("")).alias("top_spam_words"),
                      F.coalesce("top_ham_words", F.lit("")).alias("top_ham_words"))


# ---------------------------------------------------------------------------
# Profiles (A15-A20, A22, A23)
# ---------------------------------------------------------------------------

from nbsieve.operators import profile as PR  # noqa: E402

_WC = f"len(list_filter(regexp_split_to_array(text, '[{C.PY_WHITESPACE}]+'), lambda w: length(w) > 0))"


def _pct_sql(col: str, qs) -> str:
    return ", ".join(f"round(quantile_cont({col}, {q}), 6) + 0.0 AS p{int(round(q * 100))}" for q in qs)


@register("A15_length_stats", "WITH " + O.MSG + f"""
, x AS (SELECT label, length(text) AS length, {_WC} AS word_count FROM msg)
SELECT label, 'length' AS measure, round(avg(length), 6) + 0.0 AS mean, round(quantile_cont(length, 0.5), 6) + 0.0 AS median,
  CAST(min(length) AS DOUBLE) AS min, CAST(max(length) AS DOUBLE) AS max, round(stddev_samp(length), 6) + 0.0 AS std
FROM x GROUP BY label
UNION ALL
SELECT label, 'word_count', round(avg(word_count), 6) + 0.0, round(quantile_cont(word_count, 0.5), 6) + 0.0,
  CAST(min(word_count) AS DOUBLE), CAST(max(word_count) AS DOUBLE), round(stddev_samp(word_count), 6) + 0.0
FROM x GROUP BY label""")
def q_length_stats(spark, sf):
    s = PR.length_stats(tables.messages(spark, sf))
    return s.select("label", "measure", *[r6(c).alias(c) for c in ("mean", "median", "min", "max", "std")])


@register("A16_length_percentiles", "WITH " + O.MSG + """
SELECT label, """ + _pct_sql("length(text)", (0.25, 0.5, 0.75, 0.9, 0.95)) + " FROM msg GROUP BY label")
def q_length_pct(spark, sf):
    p = PR.length_percentiles(tables.messages(spark, sf))
    return p.select("label", *[r6(c).alias(c) for c in p.columns if c != "label"])


@register("A17_longer_class", "WITH " + O.MSG + """
SELECT round(avg(length(text)) FILTER (WHERE label = 'ham'), 6) + 0.0 AS avg_ham_length,
       round(avg(length(text)) FILTER (WHERE label = 'spam'), 6) + 0.0 AS avg_spam_length,
       CASE WHEN avg(length(text)) FILTER (WHERE label = 'ham') > avg(length(text)) FILTER (WHERE label = 'spam')
            THEN 'ham' ELSE 'spam' END AS longer FROM msg""")
def q_longer(spark, sf):
    x = PR.longer_class(tables.messages(spark, sf))
    return x.select(r6("avg_ham_length").alias("avg_ham_length"),
                    r6("avg_spam_length").alias("avg_spam_length"), "longer")


_RAW_LABEL = f"lower(regexp_replace(CAST(toxic AS VARCHAR), '^[{C.PY_WHITESPACE}]+|[{C.PY_WHITESPACE}]+$', '', 'g'))"


@register("A18_T10_raw_label_distribution", f"""
SELECT raw_label, CAST(n AS BIGINT) AS n, round(n / sum(n) OVER () * 100, 6) + 0.0 AS pct,
       CAST(row_number() OVER (ORDER BY n DESC, raw_label) AS BIGINT) AS rank
FROM (SELECT {_RAW_LABEL} AS raw_label, count(*) AS n FROM labels GROUP BY 1)""")
def q_raw_labels(spark, sf):
    lab = tables.table(spark, sf, "labels").select(F.col("toxic").alias("raw_label"))
    from nbsieve.operators.ordered import positions
    # Raw labels are free text, so the rank is range-partitioned.
    d = positions(PR.raw_label_distribution(lab), [F.desc("n"), F.asc("raw_label")], "rank")
    return d.select("raw_label", "n", r6("pct").alias("pct"), "rank")


@register("A19_mapped_label_distribution", f"""
WITH m AS (SELECT CASE WHEN r IN ('spam','promotion','promotional','phishing') THEN 'spam'
    WHEN r IN ('ham','update','updates','primary','personal','social','notification') THEN 'ham'
    WHEN r = '1' THEN 'spam' WHEN r = '0' THEN 'ham' ELSE 'skipped' END AS mapped
  FROM (SELECT {_RAW_LABEL} AS r FROM labels)),
c AS (SELECT * FROM (VALUES ('spam'), ('ham'), ('skipped')) t(mapped)),
g AS (SELECT c.mapped, CAST(count(m.mapped) AS BIGINT) AS n FROM c LEFT JOIN m ON c.mapped = m.mapped GROUP BY c.mapped)
SELECT mapped, n, round(n / sum(n) OVER () * 100, 6) + 0.0 AS pct FROM g""")
def q_mapped_labels(spark, sf):
    lab = tables.table(spark, sf, "labels").select(F.col("toxic").alias("raw_label"))
    d = PR.mapped_label_distribution(lab)
    return d.select("mapped", "n", r6("pct").alias("pct"))


@register("A20_U1_composition", "WITH " + O.MSG + """
, g AS (SELECT source, count(*) AS total, count(*) FILTER (WHERE label = 'spam') AS spam,
              count(*) FILTER (WHERE label = 'ham') AS ham FROM msg GROUP BY ROLLUP (source))
SELECT source, total, spam, ham, round(CASE WHEN total > 0 THEN spam / total * 100 ELSE 0 END, 6) + 0.0 AS spam_pct,
       (SELECT count(*) FROM g WHERE source IS NOT NULL) AS n_sources FROM g""")
def q_composition(spark, sf):
    c = PR.composition(tables.messages(spark, sf))
    return c.select("source", "total", "spam", "ham", r6("spam_pct").alias("spam_pct"), "n_sources")


@register("A22_token_mass", O.with_model() + """
SELECT ntok_spam AS tokens_spam, ntok_ham AS tokens_ham, V AS vocabulary_size FROM cls, vsz""")
def q_token_mass(spark, sf):
    p = _prepared(spark, sf)
    return p.model.stats.select(F.col("ntok_spam").alias("tokens_spam"),
                                F.col("ntok_ham").alias("tokens_ham"),
                                F.col("V").alias("vocabulary_size"))


@register("A23_category_counts", "WITH " + O.MSG + ",\n" + O.split_cte() + """
SELECT split, lang, CAST(count(*) AS BIGINT) AS n, arg_min(CAST(ascii(lang) AS INTEGER), doc_id) AS first_seen_id,
       CAST(row_number() OVER (PARTITION BY split ORDER BY count(*) DESC, lang) AS INTEGER) AS rank
FROM spl GROUP BY split, lang""")
def q_categories(spark, sf):
    s = with_split(tables.messages(spark, sf)).withColumn("lang_id", F.ascii("lang"))
    return PR.category_counts(s, "split", "lang", "lang_id", "doc_id")


@register("W8_sample_rows", """
SELECT source, CAST(rk AS INTEGER) AS sample_rank, doc_id, substr(text, 1, 120) AS preview FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rk FROM documents) WHERE rk <= 3""")
def q_samples(spark, sf):
    from nbsieve.operators.vocab import top_k_per_group
    d = tables.table(spark, sf, "documents").select("source", "doc_id", "text")
    t = top_k_per_group(d.select("source", "doc_id"), "source", [F.asc("doc_id")], 3, "sample_rank")
    return t.join(d.select("doc_id", F.substring("text", 1, 120).alias("preview")), "doc_id") \
            .select("source", F.col("sample_rank").cast("int").alias("sample_rank"), "doc_id", "preview")


# ---------------------------------------------------------------------------
# Leaderboard and reports
# ---------------------------------------------------------------------------

from nbsieve.session import scratch_dir  # noqa: E402
from nbsieve.sources import sinks as SK  # noqa: E402


@register("W9_leaderboard", _TEST + """
SELECT r.model, round(r.f1, 6) + 0.0 AS f1, round(r.accuracy, 6) + 0.0 AS accuracy,
       CAST(rank() OVER (ORDER BY r.f1 DESC) AS INTEGER) AS rank FROM rep r""")
def q_leaderboard(spark, sf):
    from pyspark.sql import Window
    ev = M.report(_test_scores(spark, sf)).select("model", r6("f1").alias("f1"),
                                                   r6("accuracy").alias("accuracy"))
    # One row per model (bounded): a global rank over it is a tiny window.
    return ev.withColumn("rank", F.rank().over(Window.orderBy(F.desc("f1"))))


@register("W10_champion_deltas", _TEST + """
SELECT 'multinomial' AS champion, 'bernoulli' AS baseline,
  round(max(precision) FILTER (WHERE model = 'multinomial') - max(precision) FILTER (WHERE model = 'bernoulli'), 6) + 0.0 AS d_precision,
  round(max(recall) FILTER (WHERE model = 'multinomial') - max(recall) FILTER (WHERE model = 'bernoulli'), 6) + 0.0 AS d_recall,
  round(max(f1) FILTER (WHERE model = 'multinomial') - max(f1) FILTER (WHERE model = 'bernoulli'), 6) + 0.0 AS d_f1,
  round((max(accuracy) FILTER (WHERE model = 'multinomial') - max(accuracy) FILTER (WHERE model = 'bernoulli')) * 100, 6) + 0.0 AS d_accuracy_pct
FROM rep""")
def q_deltas(spark, sf):
    ev = M.report(_test_scores(spark, sf))

    def pick(c, m):
        # The report's metrics are published rounded to 6 places.
        return F.max(F.when(F.col("model") == m, r6(c)))
    return ev.agg(
        r6(pick("precision", "multinomial") - pick("precision", "bernoulli")).alias("d_precision"),
        r6(pick("recall", "multinomial") - pick("recall", "bernoulli")).alias("d_recall"),
        r6(pick("f1", "multinomial") - pick("f1", "bernoulli")).alias("d_f1"),
        r6((pick("accuracy", "multinomial") - pick("accuracy", "bernoulli")) * 100).alias("d_accuracy_pct"),
    ).select(F.lit("multinomial").alias("champion"), F.lit("bernoulli").alias("baseline"), "*")


@register("L6_K5_metrics_long", _TEST + """
SELECT model, metric, round(value, 6) + 0.0 AS value FROM (
  UNPIVOT (SELECT model, accuracy, precision, recall, f1 FROM rep)
  ON accuracy, precision, recall, f1 INTO NAME metric VALUE value)""")
def q_metrics_long(spark, sf):
    ev = M.report(_test_scores(spark, sf))
    lg = SK.metrics_long(ev.select("model", "accuracy", "precision", "recall", "f1"),
                         ["accuracy", "precision", "recall", "f1"])
    return lg.select("model", "metric", r6("value").alias("value"))


@register("K5_chart_series", _TEST + """
, cf AS (SELECT model, unnest(['tp', 'tn', 'fp', 'fn']) AS name, unnest([tp, tn, fp, fn]) AS value FROM cm),
wd AS (SELECT label, token, count, row_number() OVER (PARTITION BY label ORDER BY count DESC, token) AS rank
       FROM (SELECT 'spam' AS label, token, n_spam AS count FROM cnt WHERE n_spam > 0
             UNION ALL SELECT 'ham', token, n_ham FROM cnt WHERE n_ham > 0))
SELECT 'roc' AS series, model, NULL AS name, round((N - cum_neg + neg) / N, 6) + 0.0 AS x,
       round((P - cum_pos + pos) / P, 6) + 0.0 AS y FROM rt
UNION ALL SELECT DISTINCT 'roc', model, NULL, 0.0, 0.0 FROM rt
UNION ALL SELECT 'pr', model, NULL, round(CASE WHEN P = 0 THEN 1.0 ELSE (P - cum_pos + pos) / P END, 6) + 0.0,
       round((P - cum_pos + pos) / ((P - cum_pos + pos) + (N - cum_neg + neg)), 6) + 0.0 FROM rt
UNION ALL SELECT DISTINCT 'pr', model, NULL, 0.0, 1.0 FROM rt
UNION ALL SELECT 'confusion', model, name, NULL, CAST(value AS DOUBLE) FROM cf
UNION ALL SELECT 'top_words', label, token, CAST(rank AS DOUBLE), CAST(count AS DOUBLE) FROM wd WHERE rank <= 20""")
def q_series(spark, sf):
    """K5: chart series (ROC, PR, confusion, top words) in long form, written
    and read back."""
    p = _prepared(spark, sf)
    path = scratch_dir(spark, "series")
    SK.write_series(SK.chart_series(_test_scores(spark, sf), X.word_clouds(p.model.all_counts, 20),
                                    score="log_odds"), path)
    x = spark.read.parquet(path)
    return x.select("series", "model", "name", r6("x").alias("x"), r6("y").alias("y"))


@register("K1_summary", "SELECT t.model, t.accuracy, t.precision, t.recall, t.f1, t.macro_f1, t.weighted_f1, "
          "t.roc_auc, t.pr_auc, c.cv_mean_acc, c.cv_std_acc FROM (" + _TEST + """
SELECT r.*, cu.roc_auc, cu.pr_auc FROM rep r LEFT JOIN cur cu ON r.model = cu.model) t LEFT JOIN (""" + O.cv_sql() + """
, acc AS (SELECT model, fold, (tp + tn) / n AS a FROM cv)
SELECT model, round(avg(a), 6) + 0.0 AS cv_mean_acc, round(stddev_samp(a), 6) + 0.0 AS cv_std_acc
FROM acc GROUP BY model) c ON t.model = c.model""")
def q_summary(spark, sf):
    """K1: test metrics (alpha 1) joined with the CV summary, also written
    as a one-file CSV under the scratch folder."""
    from nbsieve.session import scratch_dir
    ev = M.evaluate(_test_scores(spark, sf), score="log_odds")
    cv = tuning.cv_summary(_cv(spark, sf))
    s = SK.summary(ev, cv)
    SK.write_summary_csv(s, scratch_dir(spark, "summary"))
    return s.select(*[r6(c).alias(c) if c != "model" else F.col(c) for c in s.columns])


# ---------------------------------------------------------------------------
# Sources (S1-S3, S5, S6, P1-P4, W6, U1, K4) and model bundle
# ---------------------------------------------------------------------------

from nbsieve.sources import loaders as L  # noqa: E402
from nbsieve.sources import model_io as MIO  # noqa: E402
from nbsieve.session import scratch_dir  # noqa: E402


@register("S1_P2_P3_sms_tsv", "WITH " + O.MSG + f"""
SELECT 'sms' AS source, label,
  regexp_replace(regexp_replace(text, '[\\r\\n]+', ' ', 'g'), '^[{C.PY_WHITESPACE}]+|[{C.PY_WHITESPACE}]+$', '', 'g') AS text
FROM msg
WHERE length(regexp_replace(regexp_replace(text, '[\\r\\n]+', ' ', 'g'), '^[{C.PY_WHITESPACE}]+|[{C.PY_WHITESPACE}]+$', '', 'g')) > 0""")
def q_sms(spark, sf):
    """Labelled messages written as a TSV corpus (one message per line) and
    read back with the TSV loader."""
    path = scratch_dir(spark, "sms")
    m = tables.messages(spark, sf)
    m.select(F.concat(F.col("label"), F.lit("\t"),
                      F.regexp_replace("text", "[\\r\\n]+", " ")).alias("value")) \
     .write.mode("overwrite").text(path)
    return L.load_sms_tsv(spark, path)


@register("S2_S6_P1_P4_csv_directory", "WITH " + O.MSG + f"""
, t AS (SELECT CASE WHEN label = 'spam' THEN 'spam' ELSE 'ham' END AS label,
  regexp_replace(text, '^[{C.PY_WHITESPACE}]+|[{C.PY_WHITESPACE}]+$', '', 'g') AS text FROM msg)
SELECT label, text FROM t WHERE length(text) > 0""")
def q_csv_dir(spark, sf):
    """Labelled messages written as CSV files (header ``Message,Category``
    with raw 0/1 labels, multi-line quoted text) and loaded with the directory
    loader (S6 finds the columns, P1 maps 1/0)."""
    return L.load_csv_directory(spark, _csv_corpus(spark, sf)).select("label", "text")


def _csv_corpus(spark, sf) -> str:
    path = scratch_dir(spark, "csv")
    lab = tables.table(spark, sf, "labels").select("doc_id", "toxic")
    docs = tables.table(spark, sf, "documents").select("doc_id", "source", "text")
    d = docs.join(lab, "doc_id").select(F.col("text").alias("Message"),
                                        F.col("toxic").cast("string").alias("Category"), "source")
    d.drop("source").write.mode("overwrite").option("header", True) \
     .option("escape", '"').csv(path)
    return path


@register("P4_truncated_csv", "WITH " + O.MSG + f"""
, t AS (SELECT label, regexp_replace(text, '^[{C.PY_WHITESPACE}]+|[{C.PY_WHITESPACE}]+$', '', 'g') AS text FROM msg)
SELECT n AS length, label, substr(text, 1, n) AS text
FROM t, (VALUES ({C.TRUNCATE_CSV}), ({C.TRUNCATE_MAIL}), ({C.TRUNCATE_PAGE})) v(n) WHERE length(text) > 0""")
def q_truncated(spark, sf):
    """The CSV corpus cut to each of the three published lengths."""
    path = _csv_corpus(spark, sf)
    out = None
    for n in (C.TRUNCATE_CSV, C.TRUNCATE_MAIL, C.TRUNCATE_PAGE):
        x = L.load_csv_directory(spark, path, truncate=n).select(F.lit(n).alias("length"), "label", "text")
        out = x if out is None else out.unionByName(x)
    return out


def _limited_corpus(spark, messages) -> str:
    """As many files as the scan has partitions: a multi-line file is one task."""
    path = scratch_dir(spark, "limited")
    messages.select(F.col("text").alias("Body"), F.col("label").alias("Type")) \
        .write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


@register("W6_limited_csv", "WITH " + O.MSG + """
SELECT true AS limited, CAST(count(*) AS BIGINT) AS accepted FROM msg WHERE length(text) > 0""")
def q_limited(spark, sf):
    """Several files, at most seven accepted rows of each are loaded."""
    path = _limited_corpus(spark, tables.messages(spark, sf))
    whole = L.load_csv_directory(spark, path).groupBy("source").agg(F.count(F.lit(1)).alias("accepted"))
    kept = L.load_csv_directory(spark, path, limit_per_file=7).groupBy("source").agg(
        F.count(F.lit(1)).alias("kept"))
    return whole.join(kept, "source", "left").agg(
        F.bool_and(F.coalesce("kept", F.lit(0)) == F.least(F.lit(7), "accepted")).alias("limited"),
        F.sum("accepted").alias("accepted"))


@register("W6_kept_rows", f"""WITH f AS (SELECT ceil(sqrt(count(*)) / 8)::BIGINT AS files, count(*) AS n FROM documents),
t AS (SELECT doc_id % files AS file, doc_id, n // (2 * files) AS most,
  regexp_replace(text, '^[{C.PY_WHITESPACE}]+|[{C.PY_WHITESPACE}]+$', '', 'g') AS text FROM documents, f)
SELECT file, nth, text FROM (
  SELECT *, row_number() OVER (PARTITION BY file ORDER BY doc_id) AS nth FROM t WHERE length(text) > 0)
WHERE nth <= most""")
def q_kept_rows(spark, sf):
    """The documents as files of quoted CSV, each in order of the id; of
    every file the accepted rows up to half of its size, numbered."""
    docs = tables.table(spark, sf, "documents").select("doc_id", "text")
    n = docs.count()
    files = max(1, math.ceil(math.sqrt(n) / 8))
    path = scratch_dir(spark, "numbered")
    docs.withColumn("file", F.col("doc_id") % files).repartition("file") \
        .sortWithinPartitions("file", "doc_id") \
        .select("file", F.col("text").alias("Message"), F.lit("ham").alias("Label")) \
        .write.partitionBy("file").option("header", True).option("escape", '"').csv(path)
    kept = L.load_csv_directory(spark, path, limit_per_file=n // (2 * files), numbered=True, nested=True)
    nth = F.row_number().over(Window.partitionBy("path").orderBy("position"))  # at most the limit
    return kept.select(F.regexp_extract("path", "/file=(\\d+)/[^/]*$", 1).cast("bigint").alias("file"),
                       nth.cast("bigint").alias("nth"), "text")


@register("S5a_marketing_table", f"""
SELECT 'marketing' AS source, 'spam' AS label,
  regexp_replace(text, '^[{C.PY_WHITESPACE}]+|[{C.PY_WHITESPACE}]+$', '', 'g') AS text
FROM benchmark WHERE length(regexp_replace(text, '^[{C.PY_WHITESPACE}]+|[{C.PY_WHITESPACE}]+$', '', 'g')) > 0""")
def q_marketing(spark, sf):
    b = tables.table(spark, sf, "benchmark").select(F.col("text").alias("0"))
    return L.normalise_marketing(b)


@register("S5c_binary_table", f"""
SELECT 'binary' AS source, CASE WHEN l.toxic = 1 THEN 'spam' ELSE 'ham' END AS label,
  regexp_replace(d.text, '^[{C.PY_WHITESPACE}]+|[{C.PY_WHITESPACE}]+$', '', 'g') AS text
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
WHERE length(regexp_replace(d.text, '^[{C.PY_WHITESPACE}]+|[{C.PY_WHITESPACE}]+$', '', 'g')) > 0""")
def q_binary(spark, sf):
    lab = tables.table(spark, sf, "labels").select("doc_id", F.col("toxic").alias("label"))
    d = tables.table(spark, sf, "documents").select("doc_id", "text").join(lab, "doc_id")
    return L.normalise_binary(d.select("text", "label"))


_CATEGORIES = C.CATEGORY_SPAM + C.CATEGORY_HAM + ("other", " Promotions ")


@register("S5b_category_table", "WITH c(i, name) AS (VALUES "
          + ", ".join(f"({i}, '{c}')" for i, c in enumerate(_CATEGORIES)) + f"""),
x AS (SELECT lower(trim(c.name)) AS category, regexp_replace(text, '^[{C.PY_WHITESPACE}]+|[{C.PY_WHITESPACE}]+$', '', 'g') AS text
      FROM documents JOIN c ON doc_id % {len(_CATEGORIES)} = i)
SELECT 'categories' AS source, CASE WHEN category IN {C.CATEGORY_SPAM} THEN 'spam' ELSE 'ham' END AS label, text
FROM x WHERE length(text) > 0 AND category IN {C.CATEGORY_SPAM + C.CATEGORY_HAM}""")
def q_category_table(spark, sf):
    """Two splits with a category dealt from the id; unknown categories
    are dropped, case and spaces do not matter."""
    names = F.array(*[F.lit(c) for c in _CATEGORIES])
    d = tables.table(spark, sf, "documents").select(
        "doc_id", "text", F.get(names, (F.col("doc_id") % len(_CATEGORIES)).cast("int")).alias("category"))
    return L.normalise_categories(d.where("doc_id % 3 = 0"), d.where("doc_id % 3 <> 0"))


_RAW_LABELS = C.SPAM_LABELS + C.HAM_LABELS + ("1", "0", "2", "", " SPAM ", "Ham\u00a0", "unknown")


@register("P1_canonical_labels", "WITH r(i, raw, label) AS (VALUES " + ", ".join(
    f"({i}, '{r}', " + ("'spam'" if r.strip().lower() in C.SPAM_LABELS + ("1",) else
                        "'ham'" if r.strip().lower() in C.HAM_LABELS + ("0",) else "NULL") + ")"
    for i, r in enumerate(_RAW_LABELS)) + f""")
SELECT doc_id, label FROM documents JOIN r ON doc_id % {len(_RAW_LABELS)} = i""")
def q_canonical_labels(spark, sf):
    """Every published label, in odd case and spacing too, dealt from the id."""
    raw = F.array(*[F.lit(r) for r in _RAW_LABELS])
    d = tables.table(spark, sf, "documents")
    return d.select("doc_id", L.canonical_label(
        F.get(raw, (F.col("doc_id") % len(_RAW_LABELS)).cast("int"))).alias("label"))


@register("U1_union_sources", f"""
WITH d AS (SELECT doc_id, toxic, regexp_replace(text, '^[{C.PY_WHITESPACE}]+|[{C.PY_WHITESPACE}]+$', '', 'g') AS text
           FROM documents JOIN labels USING (doc_id)),
b AS (SELECT regexp_replace(text, '^[{C.PY_WHITESPACE}]+|[{C.PY_WHITESPACE}]+$', '', 'g') AS text FROM benchmark)
SELECT source, label, CAST(count(*) AS BIGINT) AS n, CAST(count(*) AS BIGINT) AS ids FROM (
  SELECT 'marketing' AS source, 'spam' AS label, text FROM b WHERE length(text) > 0
  UNION ALL SELECT 'binary', CASE WHEN toxic = 1 THEN 'spam' ELSE 'ham' END, text FROM d WHERE length(text) > 0
  UNION ALL SELECT 'binary', CASE WHEN toxic = 1 THEN 'spam' ELSE 'ham' END, text FROM d WHERE length(text) > 0)
GROUP BY source, label""")
def q_union(spark, sf):
    """Three sources (one of them twice: rows repeat) united with ids of
    their own."""
    lab = tables.table(spark, sf, "labels").select("doc_id", F.col("toxic").alias("label"))
    d = tables.table(spark, sf, "documents").select("doc_id", "text").join(lab, "doc_id").select("text", "label")
    b = tables.table(spark, sf, "benchmark").select(F.col("text").alias("0"))
    u = L.union_sources(spark, [L.normalise_marketing(b), L.normalise_binary(d), L.normalise_binary(d)])
    return u.groupBy("source", "label").agg(F.count(F.lit(1)).alias("n"),
                                            F.count_distinct("doc_id").alias("ids"))


@register("K2_S9_model_roundtrip", O.with_model() + """
SELECT token, n_spam, n_ham, df_spam, df_ham FROM voc""")
def q_model_roundtrip(spark, sf):
    """Train, save the bundle as Parquet tables, load it back: the loaded
    vocabulary counts."""
    p = _prepared(spark, sf)
    path = scratch_dir(spark, "model")
    MIO.save_model(p.model, path)
    m, _ = MIO.load_model(spark, path)
    return m.counts


@register("K3_pruned_bundle_counts", O.with_model(_LR) + f"""
, kept AS (SELECT token FROM lr ORDER BY abs(score) DESC, token LIMIT {_SMALL_VOCABULARY})
SELECT {_SMALL_VOCABULARY}::BIGINT AS vocabulary_size, token, n_spam, n_ham, df_spam, df_ham
FROM voc WHERE token IN (SELECT token FROM kept)""")
def q_pruned_counts(spark, sf):
    """T7 + K3 with a size that prunes: the bundle of the strongest words,
    saved, checked against its manifest and loaded."""
    p = _prepared(spark, sf)
    kept = X.prune_vocabulary(p.model, _SMALL_VOCABULARY)
    pruned = nb.NBModel(counts=X.pruned_counts(p.model, kept), all_counts=p.model.all_counts,
                        stats=p.model.stats, vocab_size=p.model.vocab_size)
    path = scratch_dir(spark, "pruned")
    MIO.save_model(pruned, path, pruned_size=_SMALL_VOCABULARY, true_vocab_size=kept.count())
    model, meta = MIO.load_model(spark, path, verify=True)
    return model.counts.crossJoin(F.broadcast(meta.select("vocabulary_size"))).select(
        "vocabulary_size", "token", "n_spam", "n_ham", "df_spam", "df_ham")


@register("K3_pruned_bundle_meta", O.with_model() + f"""
SELECT CAST({C.MAX_VOCAB_PRUNED} AS BIGINT) AS vocabulary_size,
       CAST(least(vsz.V, {C.MAX_VOCAB_PRUNED}) AS BIGINT) AS true_vocabulary_size,
       cls.n_docs AS total_messages_trained, CAST(1.0 AS DOUBLE) AS alpha, {C.MIN_DF} AS min_df,
       CAST({C.MAX_DF} AS DOUBLE) AS max_df FROM cls, vsz""")
def q_pruned_bundle(spark, sf):
    """T7 + K3: prune to the fixed cap, save, report the stored meta row."""
    p = _prepared(spark, sf)
    kept = X.prune_vocabulary(p.model)
    pruned = nb.NBModel(counts=X.pruned_counts(p.model, kept), all_counts=p.model.all_counts,
                        stats=p.model.stats, vocab_size=p.model.vocab_size)
    path = scratch_dir(spark, "pruned")
    MIO.save_model(pruned, path, pruned_size=C.MAX_VOCAB_PRUNED, true_vocab_size=kept.count())
    return MIO.load_model(spark, path)[1]


# ---------------------------------------------------------------------------
# Streaming inbox
# ---------------------------------------------------------------------------

from nbsieve.streaming import inbox as IB  # noqa: E402


_X1 = O.with_model(_alld_sql(), O.scores_cte("alld"), O.long_scores(models=("multinomial",), thr=0.65))


@register("X1_X4_stream_scoring", _X1 + """
SELECT l.doc_id AS request_id, 'ok' AS status, CASE WHEN n_tokens = 0 THEN 'uncertain' ELSE prediction END AS prediction,
  round(CASE WHEN n_tokens = 0 THEN 0.0 ELSE confidence END, 6) + 0.0 AS confidence,
  round(CASE WHEN n_tokens = 0 THEN 0.5 ELSE p_spam END, 6) + 0.0 AS p_spam
FROM lsc l JOIN documents d ON l.doc_id = d.doc_id
WHERE l.label IS NULL AND """ + _not_blank("d.text"))
def q_stream(spark, sf):
    """Unlabelled documents arrive as inbox rows (subject = first line,
    snippet = the rest; every row is delivered twice across files to
    exercise the seen-once de-duplication); the stream scores each message
    once. Returns the scored rows."""
    p = _prepared(spark, sf)
    base = scratch_dir(spark, "inbox")
    u = tables.unlabelled(spark, sf)
    rows = u.select(
        F.col("doc_id").alias("msg_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("doc_id")).alias("ts"),
        F.lit(None).cast("string").alias("session_id"),
        F.substring_index("text", "\n", 1).alias("subject"),
        F.expr("substring(text, length(substring_index(text, '\\n', 1)) + 2)").alias("snippet"))
    rows.write.mode("overwrite").parquet(f"{base}/src/part=1")
    rows.write.mode("overwrite").parquet(f"{base}/src/part=2")
    q = IB.start_scoring(spark, p.model, f"{base}/src", f"{base}/out", f"{base}/ckpt")
    q.awaitTermination()
    return IB.read_scored(spark, f"{base}/out").select(
        "request_id", "status", "prediction", r6("confidence").alias("confidence"), r6("p_spam").alias("p_spam"))


@register("S3_K4_exclusive_csv", "WITH " + O.MSG + f"""
, t AS (SELECT label, regexp_replace(text, '^[{C.PY_WHITESPACE}]+|[{C.PY_WHITESPACE}]+$', '', 'g') AS text FROM msg)
SELECT label, text FROM t WHERE length(text) > 0""")
def q_exclusive(spark, sf):
    """K4 writes the normalised (label, text) corpus as CSV part files; S3
    reads exactly that folder (textual labels, no 1/0 fallback, no limit)."""
    path = scratch_dir(spark, "normalised")
    SK.write_messages_csv(tables.messages(spark, sf), path)
    return L.load_exclusive_csv(spark, path).select("label", "text")


@register("S10_load_or_train", O.with_model() + """
SELECT token, n_spam, n_ham, df_spam, df_ham FROM voc""")
def q_load_or_train(spark, sf):
    """No bundle at the path: loads the training messages from CSV files,
    trains (alpha 1) and saves; a second call loads the saved bundle."""
    from nbsieve.sources import model_io as MIO2
    path, corpus = scratch_dir(spark, "bundle"), scratch_dir(spark, "corpus")
    train = with_split(tables.messages(spark, sf)).where("split = 'train'")
    SK.write_messages_csv(train, corpus)
    load = lambda: L.load_csv_directory(spark, corpus)
    MIO2.load_or_train(spark, path, load)
    return MIO2.load_or_train(spark, path, load).counts


@register("M10_request_json", """
SELECT doc_id AS request_id, text AS message, CAST(0.65 AS DOUBLE) AS decision_threshold, false AS use_sender_boost
FROM documents""")
def q_request_json(spark, sf):
    """Request bodies built as JSON from the documents (no threshold or flag
    given), parsed with from_json and defaulted as the service does."""
    d = tables.table(spark, sf, "documents").select(
        "doc_id", F.to_json(F.struct(F.col("text").alias("message"))).alias("body"))
    r = d.select("doc_id", R.parse_requests(F.col("body")).alias("r"))
    return r.select(F.col("doc_id").alias("request_id"), F.col("r.message").alias("message"),
                    F.coalesce("r.decision_threshold", F.lit(C.REQUEST_THRESHOLD)).alias("decision_threshold"),
                    F.coalesce("r.use_sender_boost", F.lit(False)).alias("use_sender_boost"))
