import math

from pyspark.sql import functions as F

from nbsieve.operators import metrics as M
from nbsieve.operators import stats as S
from nbsieve.operators.split import with_folds, with_split
from nbsieve.sources import tables
from tests.conftest import SF


def test_split_and_folds(spark):
    msgs = tables.messages(spark, SF)
    s = with_split(msgs).collect()
    assert len({r["doc_id"] for r in s}) == len(s) == msgs.count()
    for lab in ("spam", "ham"):
        n = sum(1 for r in s if r["label"] == lab)
        n_test = sum(1 for r in s if r["label"] == lab and r["split"] == "test")
        n_val = sum(1 for r in s if r["label"] == lab and r["split"] == "val")
        assert n_test == math.floor(n * 0.15 + 0.5)
        assert n_val == math.floor((n - n_test) * 3 / 17 + 0.5)
    f = with_folds(msgs, k=5).groupBy("label", "fold").count().collect()
    for lab in ("spam", "ham"):
        sizes = sorted((r["fold"], r["count"]) for r in f if r["label"] == lab)
        counts = [c for _, c in sizes]
        assert max(counts) - min(counts) <= 1 and counts == sorted(counts, reverse=True)


def _scores(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, model string, label string, raw_prediction string, p_spam double")


def test_golden_metrics(spark):
    rows = ([(i, "m", "spam", "spam", 0.9) for i in range(623)] +
            [(1000 + i, "m", "ham", "ham", 0.1) for i in range(2441)] +
            [(5000 + i, "m", "ham", "spam", 0.8) for i in range(39)] +
            [(6000 + i, "m", "spam", "ham", 0.2) for i in range(37)])
    r = M.evaluate(_scores(spark, rows)).first()
    assert (r["tp"], r["tn"], r["fp"], r["fn"]) == (623, 2441, 39, 37)
    assert round(r["accuracy"], 6) == 0.975796 and round(r["precision"], 6) == 0.941088
    assert round(r["recall"], 6) == 0.943939 and round(r["f1"], 6) == 0.942511


def test_auc_brute_force_and_one_class(spark):
    import random
    rnd = random.Random(7)
    rows = [(i, "m", rnd.choice(["spam", "ham"]), "ham", rnd.choice([0.1, 0.2, 0.5, 0.7, 0.9, rnd.random()]))
            for i in range(300)]
    got = M.curve_metrics(_scores(spark, rows)).first()
    pos = [p for _, _, l, _, p in rows if l == "spam"]
    neg = [p for _, _, l, _, p in rows if l != "spam"]
    auc = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert math.isclose(got["roc_auc"], auc, rel_tol=1e-12)
    # average precision, step form over distinct thresholds
    th = sorted(set(p for *_, p in rows), reverse=True)
    ap, prev = 0.0, 0.0
    for t in th:
        tp = sum(1 for p in pos if p >= t)
        fp = sum(1 for q in neg if q >= t)
        rec = tp / len(pos)
        ap += (rec - prev) * tp / (tp + fp)
        prev = rec
    assert math.isclose(got["pr_auc"], ap, rel_tol=1e-12)
    one = M.curve_metrics(_scores(spark, [(1, "m", "ham", "ham", 0.3), (2, "m", "ham", "ham", 0.4)])).first()
    assert one["roc_auc"] is None and one["pr_auc"] is None


def test_stats_edge_cases(spark):
    # published t quantiles and two-sided p-values, any degrees of freedom
    q = spark.createDataFrame([(2,), (5,), (31,), (80,), (1001,), (1,)], "n long").select(
        S.t_critical(F.col("n")).alias("t"), "n").collect()
    want = [12.706204736432095, 2.7764451051977987, 2.0422724563012373, 1.990450208389443,
            1.9623390808264078, None]
    for r, t in zip(q, want, strict=True):
        assert r["t"] is None if t is None else math.isclose(r["t"], t, rel_tol=1e-9)
    pv = spark.createDataFrame([(2.0, 79), (2.0, 4), (0.5, 1), (2.0, 0), (2.0, 5000)], "t double, df long").select(
        S.t_two_sided_p(F.col("t"), F.col("df")).alias("p")).collect()
    for r, p in zip(pv, [0.04893, 0.116117, 0.704833, None, 0.045553], strict=True):
        assert r["p"] is None if p is None else abs(r["p"] - p) < 5e-5
    z = spark.createDataFrame([(x / 7,) for x in range(0, 60)], "z double").select("z", S.erfc(F.col("z")).alias("e"))
    assert all(math.isclose(r["e"], math.erfc(r["z"]), rel_tol=1e-9, abs_tol=1e-14) for r in z.collect())
    many = spark.createDataFrame([(m, f, 0.9 + (0.001 * (f % 3) if m == "a" else -0.1)) for f in range(80)
                                  for m in "ab"], "model string, fold long, accuracy double")
    far = S.paired_t_test(many, "a", "b").first()
    assert far["df"] == 79 and far["reject_null"] and far["conclusion"] == "a is SIGNIFICANTLY BETTER than b"
    none = S.paired_t_test(many.where("fold = 1"), "a", "b").first()
    assert none["p_value"] is None and none["conclusion"] is None
    ci = S.confidence_interval(many, "accuracy", ["model"]).collect()
    assert all(r["margin_of_error"] is not None for r in ci)
    cv = spark.createDataFrame([("a", f, 0.9) for f in range(1, 6)] + [("b", f, 0.8) for f in range(1, 6)],
                               "model string, fold long, accuracy double")
    t = S.paired_t_test(cv, "a", "b").first()
    # zero variance of the differences -> s_d = 1e-10
    assert math.isclose(t["t_statistic"], 0.1 / (1e-10 / math.sqrt(5)), rel_tol=1e-9)
    assert t["reject_null"] and t["conclusion"] == "a is SIGNIFICANTLY BETTER than b"
    sc = spark.createDataFrame([(1, "a", "spam", "spam"), (1, "b", "spam", "spam")],
                               "doc_id long, model string, label string, raw_prediction string")
    m = S.mcnemar(sc, "a").first()
    assert (m["b"], m["c"], m["chi2"], m["p_value"]) == (0, 0, 0.0, 1.0)


def test_curves_keep_scores_that_differ_in_the_last_place(spark):
    """Probabilities below 1e-12 are told apart."""
    rows = [(i, "m", "spam" if i % 2 else "ham", "ham", 1e-13 * (i + 1)) for i in range(50)]
    assert M.roc_points(_scores(spark, rows)).count() == 51
    hot = rows + [(100 + i, "m", "ham", "ham", 0.5) for i in range(500)]
    got = M.curve_metrics(_scores(spark, hot)).first()
    pos, neg = [r[4] for r in hot if r[2] == "spam"], [r[4] for r in hot if r[2] != "spam"]
    auc = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert math.isclose(got["roc_auc"], auc, rel_tol=1e-12)
