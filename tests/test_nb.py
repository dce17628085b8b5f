import math

from pyspark.sql import functions as F

from nbsieve.operators import nb
from tests import pyref

TRAIN = [
    ("spam", "win free cash prize now click win"), ("spam", "free prize claim now"),
    ("spam", "cash offer free free"), ("ham", "meeting lunch tomorrow office"),
    ("ham", "lunch with family tomorrow"), ("ham", "project meeting notes office"),
    ("ham", "family dinner tonight"), ("ham", "notes from the project office"),
]
TEST = ["free cash tomorrow", "meeting notes project office lunch", "zzz unseen words only",
        "", "win win win free prize cash claim now click offer"]


def _frames(spark):
    tr = spark.createDataFrame([(i, l, t) for i, (l, t) in enumerate(TRAIN)],
                               "doc_id long, label string, text string")
    te = spark.createDataFrame([(100 + i, "ham", t) for i, t in enumerate(TEST)],
                               "doc_id long, label string, text string")
    return nb.tokenize(tr), nb.tokenize(te)


def test_counts_and_vocabulary(spark):
    tr, _ = _frames(spark)
    m = nb.fit(tr)
    docs = [(l, pyref.tokens(t)) for l, t in TRAIN]
    assert sorted(r["token"] for r in m.counts.collect()) == pyref.vocabulary(docs)
    st = m.stats.first()
    assert st["n_docs_spam"] == 3 and st["n_docs_ham"] == 5
    assert st["ntok_spam"] == sum(len(t) for l, t in docs if l == "spam")
    free = m.all_counts.where(F.col("token") == "free").first()
    assert (free["n_spam"], free["df_spam"]) == (4, 3)


def test_scores_match_brute_force(spark):
    tr, te = _frames(spark)
    m = nb.fit(tr)
    for alpha in (1.0, 0.5):
        s = nb.score(m, te, alpha=alpha, models=("multinomial", "bernoulli"))
        got = {(r["doc_id"], r["model"]): (r["p_spam"], r["p_ham"]) for r in s.collect()}
        ref = pyref.fit_predict([(l, pyref.tokens(t)) for l, t in TRAIN],
                                [("ham", pyref.tokens(t)) for t in TEST], alpha)
        for i, r in enumerate(ref):
            for model, (ps, ph) in r.items():
                gs, gh = got[(100 + i, model)]
                assert math.isclose(gs, ps, rel_tol=1e-9, abs_tol=1e-12), (i, model)
                assert math.isclose(gs + gh, 1.0, rel_tol=1e-12)


def test_decision_rule_and_confidence(spark):
    df = spark.createDataFrame([(0.5, 0.5), (0.4, 0.6), (0.9, 0.1), (0.25, 0.75)], "ps double, ph double")
    rows = df.select(*nb.decide(F.col("ps"), F.col("ph"), F.lit(0.65), F.lit(0.7))).collect()
    # tie -> spam; P(ham)=0.6 at threshold 0.65 -> spam with confidence 0.4 -> uncertain
    assert rows[0]["raw_prediction"] == "spam" and rows[0]["prediction"] == "uncertain"
    assert rows[1]["raw_prediction"] == "spam" and rows[1]["confidence"] == 0.4
    assert rows[2]["prediction"] == "spam" and rows[3]["prediction"] == "ham"


def test_single_class_training_is_rejected(spark):
    df = spark.createDataFrame([(1, "spam", "a b c"), (2, "spam", "a b d")], "doc_id long, label string, text string")
    try:
        nb.fit(nb.tokenize(df))
    except ValueError:
        return
    raise AssertionError("expected a ValueError")


def test_moments_from_terms_equal_those_from_tokens(spark):
    from nbsieve.functions import text as T
    rows = [(i, "spam" if i % 3 else "ham", " ".join(
        ["win", "http://x.y/z", "cash", "a@b.cd", "cash", f"w{chr(97 + i)}x"][: i % 7] * (1 + i % 4))) for i in range(24)]
    tok = nb.tokenize(spark.createDataFrame(rows, "doc_id long, label string, text string"))
    plain = nb.gaussian_moments(tok).first().asDict()
    terms = T.add_term_frequencies(tok, keep=["label", "tokens"]).localCheckpoint()
    got = nb.gaussian_moments(terms.drop("tokens")).first().asDict()             # before: read the tokens
    assert got.keys() == plain.keys()
    assert all(abs(got[k] - plain[k]) < 1e-9 for k in plain)


def test_counting_reads_splits_of_bounded_size(spark, monkeypatch):
    key, seen, cut = "spark.sql.files.maxPartitionBytes", [], nb.cut_lineage
    before = spark.conf.get(key)
    monkeypatch.setattr(nb, "COUNT_SPLIT", 4096)
    tok = cut(nb.tokenize(spark.range(3000).select("id", F.when(F.col("id") % 2 == 0, "spam").otherwise("ham").alias(
        "label"), F.concat_ws(" ", F.lit("win"), F.translate(F.md5(F.col("id").cast("string")), "0123456789",
                                                             "ghijklmnop")).alias("text"))))
    monkeypatch.setattr(nb, "cut_lineage", lambda df: seen.append(
        (spark.conf.get(key), tok.select("label").rdd.getNumPartitions())) or cut(df))
    model = nb.fit(tok)
    assert seen[0][0] == "4096" and seen[0][1] > seen[-1][1]       # before: splits of any size
    assert spark.conf.get(key) == before and model.all_counts.where("token = 'win'").first()["n_spam"] == 1500
