"""Independent DuckDB SQL for the correctness check.

These are plain SQL formulations of the same semantics (row-at-a-time list
functions, window functions over whole classes, joins on exploded
tokens); they share nothing with the Spark plans except the fixed values.
Each ``Q`` entry is a full statement over the pre-registered views.
"""

from __future__ import annotations

from nbsieve import config as C
from nbsieve.functions.text import STOP_TOKENS

STOP = ", ".join(f"'{w}'" for w in STOP_TOKENS)
NWS = C.NON_WS


def lit(x: float) -> str:
    return repr(float(x))


def _contractions(expr: str) -> str:
    for a, b in C.CONTRACTIONS:
        expr = f"regexp_replace({expr}, '\\b({a})({b})\\b', '\\1 \\2', 'g')"
    return expr


def words_sql(text: str) -> str:
    """F1-F5 on a text expression -> cleaned string."""
    s = f"lower({text})"
    s = f"regexp_replace({s}, 'http[s]?://{NWS}+|www\\.{NWS}+', ' {C.URL_TOKEN} ', 'g')"
    s = f"regexp_replace({s}, '{NWS}+@{NWS}+', ' {C.EMAIL_TOKEN} ', 'g')"
    s = f"regexp_replace({s}, '[^a-z]+', ' ', 'g')"
    return _contractions(s)


def unigrams_sql(text: str) -> str:
    return (f"list_filter(string_split(trim({words_sql(text)}), ' '), "
            f"lambda t: length(t) > 1 AND NOT list_contains([{STOP}], t))")


def tokens_cte(name: str, src: str, cols: str) -> str:
    """``name(<cols>, tokens)`` from ``src`` with a ``text`` column."""
    return f"""{name} AS (
  SELECT {cols}, list_concat(u, CASE WHEN len(u) < 2 THEN []::VARCHAR[]
      ELSE list_transform(range(1, len(u)), lambda i: u[i] || '_' || u[i + 1]) END) AS tokens
  FROM (SELECT {cols}, {unigrams_sql('text')} AS u FROM {src})
)"""


MSG = """msg AS (
  SELECT d.doc_id, d.source, d.lang, d.text,
         CASE WHEN l.toxic = 1 THEN 'spam' ELSE 'ham' END AS label
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
)"""


def split_cte(seed=C.SEED) -> str:
    # n_test = round(n*0.15) = (6n+20) div 40; n_val = round((n-n_test)*3/17)
    return f"""spl AS (
  SELECT doc_id, source, lang, text, label,
         CASE WHEN rk <= n_test THEN 'test' WHEN rk <= n_test + n_val THEN 'val'
              ELSE 'train' END AS split
  FROM (SELECT *, ((n - n_test) * 6 + 17) // 34 AS n_val FROM (
    SELECT *, (n * 6 + 20) // 40 AS n_test FROM (
      SELECT *, row_number() OVER (PARTITION BY label
                  ORDER BY md5('{seed}-' || CAST(doc_id AS VARCHAR)), doc_id) AS rk,
             count(*) OVER (PARTITION BY label) AS n
      FROM msg)))
)"""


def fold_cte(k=C.K_FOLDS, seed=C.SEED, src="msg") -> str:
    return f"""fld AS (
  SELECT *, CAST(ntile({k}) OVER (PARTITION BY label
      ORDER BY md5('{seed}-' || CAST(doc_id AS VARCHAR)), doc_id) AS BIGINT) AS fold
  FROM {src}
)"""


# The trained model over split = 'train' (vocabulary from train only).
MODEL = f"""trn AS (SELECT * FROM tok WHERE split = 'train'),
cnt AS (
  SELECT token, CAST(sum(n_spam) AS BIGINT) AS n_spam, CAST(sum(n_ham) AS BIGINT) AS n_ham,
         CAST(sum(df_spam) AS BIGINT) AS df_spam, CAST(sum(df_ham) AS BIGINT) AS df_ham
  FROM (
    SELECT token, CASE WHEN label = 'spam' THEN 1 ELSE 0 END AS n_spam,
           CASE WHEN label = 'spam' THEN 0 ELSE 1 END AS n_ham, 0 AS df_spam, 0 AS df_ham
    FROM (SELECT label, unnest(tokens) AS token FROM trn)
    UNION ALL
    SELECT token, 0, 0, CASE WHEN label = 'spam' THEN 1 ELSE 0 END,
           CASE WHEN label = 'spam' THEN 0 ELSE 1 END
    FROM (SELECT label, unnest(list_distinct(tokens)) AS token FROM trn)
  ) GROUP BY token
),
cls AS (
  SELECT count(*) FILTER (WHERE label = 'spam') AS n_docs_spam,
         count(*) FILTER (WHERE label = 'ham') AS n_docs_ham, count(*) AS n_docs,
         CAST(coalesce(sum(len(tokens)) FILTER (WHERE label = 'spam'), 0) AS BIGINT) AS ntok_spam,
         CAST(coalesce(sum(len(tokens)) FILTER (WHERE label = 'ham'), 0) AS BIGINT) AS ntok_ham
  FROM trn
),
voc AS (
  SELECT c.* FROM cnt c, cls
  WHERE c.df_spam + c.df_ham >= {C.MIN_DF} AND (c.df_spam + c.df_ham) / cls.n_docs <= {C.MAX_DF}
),
vsz AS (SELECT count(*) AS V FROM voc)"""


def feats_sql(tokens: str = "tokens") -> str:
    """The ten Gaussian features (token mode) as SQL expressions."""
    joined = f"array_to_string({tokens}, ' ')"
    tl = f"greatest(1, length({joined}))"
    return f"""CAST(len({tokens}) AS DOUBLE) AS length,
    CAST(len(list_distinct({tokens})) AS DOUBLE) AS unique_count,
    coalesce(list_sum(list_transform({tokens}, lambda t: length(t))), 0) / greatest(1, len({tokens})) AS avg_word_len,
    CAST(len(list_filter({tokens}, lambda t: t = '{C.URL_TOKEN}')) AS DOUBLE) AS url_count,
    CAST(len(list_filter({tokens}, lambda t: t = '{C.EMAIL_TOKEN}')) AS DOUBLE) AS email_count,
    0.0::DOUBLE AS punctuation_ratio, 0.0::DOUBLE AS uppercase_ratio, 0.0::DOUBLE AS digit_ratio,
    (length({joined}) - length(replace({joined}, '_', ''))) / {tl} AS special_char_density,
    CAST(greatest(1, len({tokens}) // 10) AS DOUBLE) AS sentence_count"""


GMOM = "gm AS (SELECT label, " + ", ".join(
    f"avg({f}) AS mu_{f}, var_pop({f}) + {lit(C.ALPHA * C.GAUSSIAN_VAR_EPS)} AS var_{f}"
    for f in C.GAUSSIAN_FEATURES) + " FROM (SELECT label, " + feats_sql() + " FROM trn) GROUP BY label)"


def scores_cte(src: str, alpha: float = C.ALPHA, name: str = "sco", keep: str = "label") -> str:
    """Log posteriors of the three models for the documents of ``src``
    (doc_id, tokens, <keep>) with the model above: ``name(doc_id, <keep>,
    n_tokens, mult_lp_*, bern_lp_*, gauss_lp_*)``."""
    a = lit(alpha)
    gauss = {}
    for c in ("spam", "ham"):
        terms = [f"(-0.5 * ln(2 * pi() * g{c}.var_{f}) - pow(f.{f} - g{c}.mu_{f}, 2) / (2 * g{c}.var_{f}))"
                 for f in C.GAUSSIAN_FEATURES]
        gauss[c] = " + ".join(terms)
    return f"""{name}_msum AS (
  SELECT o.doc_id, sum(ln(v.n_spam + {a}) - ln({a})) AS m_spam, sum(ln(v.n_ham + {a}) - ln({a})) AS m_ham
  FROM (SELECT doc_id, unnest(tokens) AS token FROM {src}) o JOIN voc v ON o.token = v.token
  GROUP BY o.doc_id
),
{name}_bsum AS (
  SELECT o.doc_id,
    sum(ln((v.df_spam + {a}) / (cls.n_docs_spam + 2 * {a})) - ln(1 - (v.df_spam + {a}) / (cls.n_docs_spam + 2 * {a}))) AS b_spam,
    sum(ln((v.df_ham + {a}) / (cls.n_docs_ham + 2 * {a})) - ln(1 - (v.df_ham + {a}) / (cls.n_docs_ham + 2 * {a}))) AS b_ham
  FROM (SELECT doc_id, unnest(list_distinct(tokens)) AS token FROM {src}) o JOIN voc v ON o.token = v.token, cls
  GROUP BY o.doc_id
),
{name}_base AS (
  SELECT coalesce(sum(ln(1 - (v.df_spam + {a}) / (cls.n_docs_spam + 2 * {a}))), 0) AS base_spam,
         coalesce(sum(ln(1 - (v.df_ham + {a}) / (cls.n_docs_ham + 2 * {a}))), 0) AS base_ham
  FROM voc v, cls
),
{name}_f AS (SELECT doc_id, {keep}, CAST(len(tokens) AS BIGINT) AS n_tokens, {feats_sql()} FROM {src}),
{name} AS (
  SELECT f.doc_id, f.{keep.replace(', ', ', f.')}, f.n_tokens,
    ln(cls.n_docs_spam / cls.n_docs) + coalesce(ms.m_spam, 0) + f.n_tokens * (ln({a}) - ln(cls.ntok_spam + {a} * vsz.V)) AS mult_lp_spam,
    ln(cls.n_docs_ham / cls.n_docs) + coalesce(ms.m_ham, 0) + f.n_tokens * (ln({a}) - ln(cls.ntok_ham + {a} * vsz.V)) AS mult_lp_ham,
    ln(cls.n_docs_spam / cls.n_docs) + bb.base_spam + coalesce(bs.b_spam, 0) AS bern_lp_spam,
    ln(cls.n_docs_ham / cls.n_docs) + bb.base_ham + coalesce(bs.b_ham, 0) AS bern_lp_ham,
    ln(cls.n_docs_spam / cls.n_docs) + {gauss['spam']} AS gauss_lp_spam,
    ln(cls.n_docs_ham / cls.n_docs) + {gauss['ham']} AS gauss_lp_ham
  FROM {name}_f f
  LEFT JOIN {name}_msum ms ON f.doc_id = ms.doc_id
  LEFT JOIN {name}_bsum bs ON f.doc_id = bs.doc_id
  CROSS JOIN cls CROSS JOIN vsz CROSS JOIN {name}_base bb
  CROSS JOIN (SELECT * FROM gm WHERE label = 'spam') gspam
  CROSS JOIN (SELECT * FROM gm WHERE label = 'ham') gham
)"""


def posterior_sql(lp_spam: str, lp_ham: str, n: str) -> tuple[str, str]:
    t = f"greatest(1.0, greatest(1, {n}) / 10.0)"
    ss, sh = f"(({lp_spam}) / {t})", f"(({lp_ham}) / {t})"
    m = f"greatest({ss}, {sh})"
    den = f"(exp({ss} - {m}) + exp({sh} - {m}))"
    return f"exp({ss} - {m}) / {den}", f"exp({sh} - {m}) / {den}"


def long_scores(name: str = "sco", keep: str = "label", models=("multinomial", "bernoulli", "gaussian"),
                thr: float = C.DECISION_THRESHOLD, conf: float = C.CONFIDENCE_THRESHOLD,
                out: str = "lsc") -> str:
    """``out(doc_id, <keep>, model, n_tokens, p_spam, p_ham, raw_prediction,
    prediction, confidence, is_confident)``."""
    short = {"multinomial": "mult", "bernoulli": "bern", "gaussian": "gauss"}
    parts = []
    for m in models:
        ps, ph = posterior_sql(f"{short[m]}_lp_spam", f"{short[m]}_lp_ham", "n_tokens")
        lo = (f"round(({short[m]}_lp_spam - {short[m]}_lp_ham) "
              "/ greatest(1.0, greatest(1, n_tokens) / 10.0), 9)")
        parts.append(f"SELECT doc_id, {keep}, '{m}' AS model, n_tokens, {ps} AS p_spam, {ph} AS p_ham, "
                     f"{lo} AS log_odds FROM {name}")
    u = "\n    UNION ALL ".join(parts)
    return f"""{out}_p AS ({u}),
{out} AS (
  SELECT *, CASE WHEN p_ham > {lit(thr)} THEN 'ham' ELSE 'spam' END AS raw_prediction,
         CASE WHEN (CASE WHEN p_ham > {lit(thr)} THEN p_ham ELSE p_spam END) >= {lit(conf)}
              THEN (CASE WHEN p_ham > {lit(thr)} THEN 'ham' ELSE 'spam' END) ELSE 'uncertain' END AS prediction,
         CASE WHEN p_ham > {lit(thr)} THEN p_ham ELSE p_spam END AS confidence,
         (CASE WHEN p_ham > {lit(thr)} THEN p_ham ELSE p_spam END) >= {lit(conf)} AS is_confident
  FROM {out}_p
)"""


def with_model(*ctes: str) -> str:
    """WITH msg, spl, tok, model, moments, extra ctes."""
    base = [MSG, split_cte(), tokens_cte("tok", "spl", "doc_id, source, lang, label, split"),
            MODEL, GMOM]
    return "WITH " + ",\n".join(base + list(ctes)) + "\n"


def r6(x: str) -> str:
    return f"round({x}, 6) + 0.0"


def metrics_sql(src: str = "lsc", by: str = "model") -> str:
    """Confusion + report + AUCs per ``by`` from a long scores CTE."""
    def div(a, b):
        return f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE ({a}) / ({b}) END"
    p, r = div("tp", "tp + fp"), div("tp", "tp + fn")
    ph, rh = div("tn", "tn + fn"), div("tn", "tn + fp")
    f1 = div(f"2 * ({p}) * ({r})", f"({p}) + ({r})")
    f1h = div(f"2 * ({ph}) * ({rh})", f"({ph}) + ({rh})")
    n = "(tp + tn + fp + fn)"
    cols = {
        "accuracy": div("tp + tn", n), "precision": p, "recall": r, "f1": f1,
        "macro_precision": f"(({p}) + ({ph})) / 2", "macro_recall": f"(({r}) + ({rh})) / 2",
        "macro_f1": f"(({f1}) + ({f1h})) / 2",
        "weighted_precision": div(f"({p}) * (tp + fn) + ({ph}) * (tn + fp)", n),
        "weighted_recall": div(f"({r}) * (tp + fn) + ({rh}) * (tn + fp)", n),
        "weighted_f1": div(f"({f1}) * (tp + fn) + ({f1h}) * (tn + fp)", n),
    }
    sel = ", ".join(f"round({v}, 6) + 0.0 AS {k}" for k, v in cols.items())
    return f"""cm AS (
  SELECT {by}, count(*) FILTER (WHERE label = 'spam' AND raw_prediction = 'spam') AS tp,
         count(*) FILTER (WHERE label <> 'spam' AND raw_prediction <> 'spam') AS tn,
         count(*) FILTER (WHERE label <> 'spam' AND raw_prediction = 'spam') AS fp,
         count(*) FILTER (WHERE label = 'spam' AND raw_prediction <> 'spam') AS fn
  FROM {src} GROUP BY {by}
),
rep AS (SELECT {by}, tp, tn, fp, fn, {sel} FROM cm),
sg AS (
  SELECT {by}, log_odds AS s, sum(CASE WHEN label = 'spam' THEN 1 ELSE 0 END) AS pos,
         sum(CASE WHEN label = 'spam' THEN 0 ELSE 1 END) AS neg
  FROM {src} GROUP BY {by}, log_odds
),
rt AS (
  SELECT *, sum(pos) OVER (PARTITION BY {by} ORDER BY s) AS cum_pos,
         sum(neg) OVER (PARTITION BY {by} ORDER BY s) AS cum_neg,
         sum(pos) OVER (PARTITION BY {by}) AS P, sum(neg) OVER (PARTITION BY {by}) AS N
  FROM sg
),
cur AS (
  SELECT {by},
    CASE WHEN max(P) > 0 AND max(N) > 0 THEN
      round(sum(pos * (cum_neg - neg + neg / 2.0)) / (max(P) * max(N)), 6) + 0.0 END AS roc_auc,
    CASE WHEN max(P) > 0 AND max(N) > 0 THEN
      round(sum(pos * (P - cum_pos + pos) / ((P - cum_pos + pos) + (N - cum_neg + neg))) / max(P), 6) + 0.0
    END AS pr_auc
  FROM rt GROUP BY {by}
)"""


def sweep_sql(alphas, src: str = "val", models=("multinomial", "bernoulli")) -> str:
    """Per (model, alpha) confusion and metrics over ``src`` (CTE list +
    final ``swp`` CTE)."""
    ctes, parts = [], []
    for i, a in enumerate(alphas):
        ctes.append(scores_cte(src, alpha=a, name=f"s{i}"))
        ctes.append(long_scores(f"s{i}", models=models, out=f"l{i}"))
        parts.append(f"SELECT CAST({lit(a)} AS DOUBLE) AS alpha, * FROM l{i}")
    ctes.append("sw AS (" + " UNION ALL ".join(parts) + ")")
    ctes.append(metrics_sql("sw", "model, alpha"))
    return ",\n".join(ctes)


def cv_sql(k: int = C.K_FOLDS, alpha_m: float = 1.0, alpha_b: float = 1.0) -> str:
    """Brute-force k-fold CV: each fold's training documents are copied
    per fold and counted directly (no subtraction trick)."""
    a, b = lit(alpha_m), lit(alpha_b)
    gauss = {}
    for c in ("spam", "ham"):
        gauss[c] = " + ".join(
            f"(-0.5 * ln(2 * pi() * g{c}.var_{f}) - pow(t.{f} - g{c}.mu_{f}, 2) / (2 * g{c}.var_{f}))"
            for f in C.GAUSSIAN_FEATURES)
    return "WITH " + ",\n".join([
        MSG, split_cte(),
        fold_cte(k, src="(SELECT * FROM spl WHERE split IN ('train', 'val'))"),
        tokens_cte("tok", "fld", "doc_id, label, fold"),
        f"fs AS (SELECT CAST(range AS BIGINT) AS f FROM range(1, {k + 1}))",
        "tr AS (SELECT fs.f, t.* FROM tok t, fs WHERE t.fold <> fs.f)",
        """cnt AS (
  SELECT f, token, sum(n_spam) AS n_spam, sum(n_ham) AS n_ham, sum(df_spam) AS df_spam, sum(df_ham) AS df_ham
  FROM (
    SELECT f, token, CASE WHEN label = 'spam' THEN 1 ELSE 0 END AS n_spam,
           CASE WHEN label = 'spam' THEN 0 ELSE 1 END AS n_ham, 0 AS df_spam, 0 AS df_ham
    FROM (SELECT f, label, unnest(tokens) AS token FROM tr)
    UNION ALL
    SELECT f, token, 0, 0, CASE WHEN label = 'spam' THEN 1 ELSE 0 END, CASE WHEN label = 'spam' THEN 0 ELSE 1 END
    FROM (SELECT f, label, unnest(list_distinct(tokens)) AS token FROM tr)
  ) GROUP BY f, token)""",
        """cls AS (
  SELECT f, count(*) FILTER (WHERE label = 'spam') AS n_docs_spam, count(*) FILTER (WHERE label = 'ham') AS n_docs_ham,
         count(*) AS n_docs, coalesce(sum(len(tokens)) FILTER (WHERE label = 'spam'), 0) AS ntok_spam,
         coalesce(sum(len(tokens)) FILTER (WHERE label = 'ham'), 0) AS ntok_ham
  FROM tr GROUP BY f)""",
        f"""voc AS (SELECT c.* FROM cnt c JOIN cls ON c.f = cls.f
  WHERE c.df_spam + c.df_ham >= {C.MIN_DF} AND (c.df_spam + c.df_ham) / cls.n_docs <= {C.MAX_DF})""",
        "vsz AS (SELECT f, count(*) AS V FROM voc GROUP BY f)",
        "gm AS (SELECT f, label, " + ", ".join(
            f"avg({x}) AS mu_{x}, var_pop({x}) + {lit(C.GAUSSIAN_VAR_EPS)} AS var_{x}"
            for x in C.GAUSSIAN_FEATURES) + " FROM (SELECT f, label, " + feats_sql() + " FROM tr) GROUP BY f, label)",
        f"""ms AS (SELECT o.doc_id, sum(ln(v.n_spam + {a}) - ln({a})) AS m_spam, sum(ln(v.n_ham + {a}) - ln({a})) AS m_ham
  FROM (SELECT doc_id, fold, unnest(tokens) AS token FROM tok) o JOIN voc v ON o.fold = v.f AND o.token = v.token
  GROUP BY o.doc_id)""",
        f"""bs AS (SELECT o.doc_id,
    sum(ln((v.df_spam + {b}) / (c.n_docs_spam + 2 * {b})) - ln(1 - (v.df_spam + {b}) / (c.n_docs_spam + 2 * {b}))) AS b_spam,
    sum(ln((v.df_ham + {b}) / (c.n_docs_ham + 2 * {b})) - ln(1 - (v.df_ham + {b}) / (c.n_docs_ham + 2 * {b}))) AS b_ham
  FROM (SELECT doc_id, fold, unnest(list_distinct(tokens)) AS token FROM tok) o
  JOIN voc v ON o.fold = v.f AND o.token = v.token JOIN cls c ON c.f = o.fold GROUP BY o.doc_id)""",
        f"""base AS (SELECT v.f, sum(ln(1 - (v.df_spam + {b}) / (c.n_docs_spam + 2 * {b}))) AS base_spam,
    sum(ln(1 - (v.df_ham + {b}) / (c.n_docs_ham + 2 * {b}))) AS base_ham
  FROM voc v JOIN cls c ON v.f = c.f GROUP BY v.f)""",
        f"""lp AS (
  SELECT t.doc_id, t.label, t.fold, t.length AS n_tokens,
    ln(c.n_docs_spam / c.n_docs) + coalesce(ms.m_spam, 0) + t.length * (ln({a}) - ln(c.ntok_spam + {a} * z.V)) AS mult_lp_spam,
    ln(c.n_docs_ham / c.n_docs) + coalesce(ms.m_ham, 0) + t.length * (ln({a}) - ln(c.ntok_ham + {a} * z.V)) AS mult_lp_ham,
    ln(c.n_docs_spam / c.n_docs) + coalesce(bb.base_spam, 0) + coalesce(bs.b_spam, 0) AS bern_lp_spam,
    ln(c.n_docs_ham / c.n_docs) + coalesce(bb.base_ham, 0) + coalesce(bs.b_ham, 0) AS bern_lp_ham,
    ln(c.n_docs_spam / c.n_docs) + {gauss['spam']} AS gauss_lp_spam,
    ln(c.n_docs_ham / c.n_docs) + {gauss['ham']} AS gauss_lp_ham
  FROM (SELECT doc_id, label, fold, {feats_sql()} FROM tok) t
  JOIN cls c ON c.f = t.fold JOIN vsz z ON z.f = t.fold LEFT JOIN base bb ON bb.f = t.fold
  LEFT JOIN ms ON ms.doc_id = t.doc_id LEFT JOIN bs ON bs.doc_id = t.doc_id
  JOIN gm gspam ON gspam.f = t.fold AND gspam.label = 'spam'
  JOIN gm gham ON gham.f = t.fold AND gham.label = 'ham')""",
        long_scores("lp", keep="label, fold", out="cvs"),
        """cv AS (
  SELECT model, fold, count(*) AS n,
         count(*) FILTER (WHERE label = 'spam' AND raw_prediction = 'spam') AS tp,
         count(*) FILTER (WHERE label <> 'spam' AND raw_prediction <> 'spam') AS tn,
         count(*) FILTER (WHERE label <> 'spam' AND raw_prediction = 'spam') AS fp,
         count(*) FILTER (WHERE label = 'spam' AND raw_prediction <> 'spam') AS fn
  FROM cvs GROUP BY model, fold)""",
    ]) + "\n"


W = r"[^\p{L}\p{N}_]"


def re2_rule(pattern: str) -> str:
    """A sender-rule regex in RE2 form: Python's Unicode ``\\b`` at the ends
    becomes an explicit non-word-or-edge group, ``.`` is "not a newline"."""
    p = pattern
    if r"\b.*\b" in p:
        a, b = p.split(r"\b.*\b")
        p = a + rf"[^\p{{L}}\p{{N}}_\n]([^\n]*[^\p{{L}}\p{{N}}_\n])?" + b
    if p.startswith(r"\b"):
        p = f"(^|{W})" + p[2:]
    if p.endswith(r"\b"):
        p = p[:-2] + f"({W}|$)"
    return p


def boost_sql(text: str, rules) -> str:
    parts = [f"CASE WHEN regexp_matches(lower({text}), '{re2_rule(p)}') THEN {lit(b)} ELSE 0.0 END"
             for p, b in rules]
    return "CAST(greatest(0.0, " + ", ".join(parts) + ") AS DOUBLE)"
