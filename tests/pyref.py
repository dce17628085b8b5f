"""Plain-Python restatement of the documented semantics, used as a brute
force check on small inputs (written from the specification, independent
of the Spark code)."""
import math
import re

from nbsieve import config as C

STOP = set(C.STOPWORDS_EN)


def tokens(text: str) -> list[str]:
    t = text.lower()
    t = re.sub(r"http[s]?://\S+|www\.\S+", " urltoken ", t)
    t = re.sub(r"\S+@\S+", " emailtoken ", t)
    t = re.sub(r"[^a-z\s]", " ", t)
    words = []
    for w in t.split():
        for a, b in C.CONTRACTIONS:
            if w == a + b:
                words += [a, b]
                break
        else:
            words.append(w)
    u = [w for w in words if w not in STOP and len(w) > 1]
    return u + [f"{u[i]}_{u[i + 1]}" for i in range(len(u) - 1)]


def vocabulary(docs, min_df=2, max_df=0.95):
    df = {}
    for _, toks in docs:
        for w in set(toks):
            df[w] = df.get(w, 0) + 1
    return sorted(w for w, c in df.items() if c >= min_df and c / len(docs) <= max_df)


def posterior(lp_spam, lp_ham, n):
    t = max(1.0, max(1, n) / 10.0)
    s, h = lp_spam / t, lp_ham / t
    m = max(s, h)
    ls = m + math.log(math.exp(s - m) + math.exp(h - m))
    return math.exp(s - ls), math.exp(h - ls)


def fit_predict(train, test, alpha=1.0):
    """Multinomial and Bernoulli (full O(V) formula) posteriors."""
    vocab = vocabulary(train)
    vs = set(vocab)
    cls = {"spam": [t for l, t in train if l == "spam"], "ham": [t for l, t in train if l == "ham"]}
    n = len(train)
    out = []
    for _, toks in test:
        res = {}
        for model in ("multinomial", "bernoulli"):
            lp = {}
            for c, docs in cls.items():
                prior = math.log(len(docs) / n)
                if model == "multinomial":
                    cnt = {}
                    for d in docs:
                        for w in d:
                            cnt[w] = cnt.get(w, 0) + 1
                    N = sum(cnt.values())
                    den = N + alpha * len(vocab)
                    ll = sum(math.log((cnt.get(w, 0) + alpha) / den) if w in vs
                             else math.log(alpha / den) for w in toks)
                else:
                    dfc = {}
                    for d in docs:
                        for w in set(d):
                            dfc[w] = dfc.get(w, 0) + 1
                    present = set(toks)
                    ll = 0.0
                    for w in vocab:
                        p = (dfc.get(w, 0) + alpha) / (len(docs) + 2 * alpha)
                        ll += math.log(p) if w in present else math.log(1 - p)
                lp[c] = prior + ll
            res[model] = posterior(lp["spam"], lp["ham"], len(toks))
        out.append(res)
    return out
