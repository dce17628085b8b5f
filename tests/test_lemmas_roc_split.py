"""Lemmas, corner points of the ROC curve, and allocated split sizes."""

import math
import random

import pytest
from pyspark.sql import functions as F

from nbsieve.functions import text as T
from nbsieve.operators import lemmas as LEM
from nbsieve.operators import metrics as M
from nbsieve.operators.ordered import running_totals
from nbsieve.operators.split import allocated_sizes, with_allocated_split


def forms(words, pos):
    return [w[:-len(a)] + b for w in words for a, b in LEM.ENDINGS[pos] if w.endswith(a)]


def brute_lemma(word, pos, known, exceptions):
    if (pos, word) in exceptions:
        found = [w for w in [word, *exceptions[pos, word]] if (pos, w) in known]
        return min(found, key=len) if found else word
    now = forms([word], pos)
    found = [w for w in [word, *now] if (pos, w) in known]
    while not found and now:
        now = forms(now, pos)
        found = [w for w in now if (pos, w) in known]
    return min(found, key=len) if found else word


WORDS = ["running", "runs", "run", "went", "women", "churches", "wolves", "boxes", "studies", "studied", "asses",
         "ss", "s", "es", "ing", "being", "meetings", "leaves", "aaaing", "xings", "singses", "men", "quizzes"]


def test_lemmas_equal_brute_force(spark):
    rng = random.Random(3)
    words = WORDS + ["".join(rng.choice(["s", "e", "i", "es", "ing", "ed", "ves", "b"]) for _ in range(rng.randint(1, 5)))
                     for _ in range(150)]
    known = {(p, w) for p in "vn" for w in rng.sample(sorted({f for x in words for f in [x, *forms([x], p), *forms(
        forms([x], p), p)] if f}), 120)} | {("v", "go"), ("n", "woman"), ("v", "run"), ("n", "go")}
    exc = {("v", "went"): ["go"], ("n", "men"): ["unknown"], ("v", "leaves"): ["leave", "leaf"]}
    lex = spark.createDataFrame(sorted(known), "pos string, lemma string")
    ex = spark.createDataFrame([(p, w, x) for (p, w), xs in exc.items() for x in xs],
                               "pos string, form string, lemma string")
    df = spark.createDataFrame([(w,) for w in words], "token string")
    got = {r["token"]: r["lemma"] for r in LEM.lemma_table(df, lex, ex).collect()}
    want = {}
    for w in words:
        v = brute_lemma(w, "v", known, exc)
        want[w] = brute_lemma(v, "n", known, exc)
    assert got == want
    own = {r["token"]: r["lemma"] for r in LEM.lemma_table(df).collect()}
    every = {(p, w) for p in "vn" for w in words}
    assert own == {w: brute_lemma(brute_lemma(w, "v", every, {}), "n", every, {}) for w in words}


@pytest.mark.parametrize("layout", ["repartition", "join", "sort"])
def test_lemmatised_documents_keep_their_words(spark, layout):
    df = spark.range(40_000).select("id", F.concat_ws(" ", F.lit("alpha"), F.concat(F.lit("wq"), F.translate(
        F.col("id").cast("string"), "0123456789", "abcdefghij"))).alias("text"))
    if layout == "repartition":
        df = df.repartition(7)
    elif layout == "join":
        df = df.join(spark.range(40_000).withColumn("x", F.lit(1)).hint("merge"), "id")
    else:
        df = df.orderBy(F.desc("text"))
    lemmas = spark.createDataFrame([("alpha", "beta")], "token string, lemma string")
    out = T.add_tokens(df, "text", "tokens", lemmas)
    want = F.concat(F.lit("wq"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij"))
    wrong = out.where((F.get("tokens", F.lit(0)) != "beta") | (F.get("tokens", F.lit(1)) != want)
                      | (F.size("tokens") != 3))
    assert out.count() == 40_000 and wrong.count() == 0


def test_corner_points_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, m, rng.choice(["spam", "ham"]), "ham", round(rng.random(), rng.choice([1, 2, 6])))
            for i, m in enumerate(rng.choice(["a", "b"]) for _ in range(600))]
    rows += [(1000 + i, "c", "spam", "ham", i / 50) for i in range(50)] + [(2000, "c", "ham", "ham", 0.005)]
    df = spark.createDataFrame(rows, "doc_id long, model string, label string, raw_prediction string, p_spam double")
    got = {(r["model"], r["threshold"]) for r in M.roc_points(df, corners=True).collect()}
    want = set()
    for m in "abc":
        mine = [(s, la == "spam") for _, x, la, _, s in rows if x == m]
        cuts = sorted({s for s, _ in mine}, reverse=True)
        n = [(sum(p for s, p in mine if s == c), sum(not p for s, p in mine if s == c)) for c in cuts]
        want |= {(m, None)} | {(m, c) for k, c in enumerate(cuts)
                               if k in (0, len(cuts) - 1) or n[k] != n[k + 1]}
    assert got == want
    assert sum(m == "c" for m, _ in got) < 10


def test_previous_values_cross_partitions(spark):
    df = spark.createDataFrame([(g, i * 0.5, i % 7) for g in "xyz" for i in range(200)],
                               "g string, s double, v long").repartition(9)
    rows = running_totals(df, ["g"], "s", ["v"], previous=True).collect()
    assert all(r["prev_v"] == (None if r["s"] == 0 else (2 * r["s"] - 1) % 7) for r in rows) and len(rows) == 600


def brute_sizes(counts):
    """counts: {class: n} -> {class: (n_test, n_val)}."""
    out, left = {c: [] for c in counts}, dict(counts)
    for ratio in (0.15, 0.15 / (1 - 0.15)):
        total = sum(left.values())
        stay = total - math.ceil(total * ratio)
        low = {c: n * stay // total for c, n in left.items()}
        order = sorted(left, key=lambda c: (-(left[c] * stay % total), c))
        for c in order[:stay - sum(low.values())]:
            low[c] += 1
        for c in left:
            out[c].append(left[c] - low[c])
        left = low
    return {c: tuple(v) for c, v in out.items()}


def test_allocated_sizes_equal_brute_force(spark):
    rng = random.Random(7)
    for _ in range(6):
        counts = {f"c{k}": rng.choice([1, 2, 3, 7, 10, 10, 1000, 10 ** 9]) for k in range(rng.randint(1, 9))}
        df = spark.createDataFrame(list(counts.items()), "c string, n bigint")
        got = {r["c"]: (r["n_test"], r["n_val"]) for r in allocated_sizes(df, "c").collect()}
        assert got == brute_sizes(counts)
    big = spark.createDataFrame([("a", 10 ** 11), ("b", 3 * 10 ** 10 + 1)], "c string, n bigint")
    assert {r["c"]: (r["n_test"], r["n_val"]) for r in allocated_sizes(big, "c").collect()} == brute_sizes(
        {"a": 10 ** 11, "b": 3 * 10 ** 10 + 1})


def test_allocated_split_differs_from_rounding(spark):
    rows = [(i, f"c{i % 8}") for i in range(8 * 10)]
    df = spark.createDataFrame(rows, "doc_id long, label string")
    got = with_allocated_split(df).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in got} == {"test": 12, "val": 12, "train": 56}   # rounding: 16, 16, 48
    assert with_allocated_split(df.limit(0)).collect() == []


@pytest.mark.parametrize("limit", [None, 0])
def test_only_places_that_change_are_gathered(spark, monkeypatch, limit):
    """The dictionary is made from the stored words; every place of a row may change."""
    if limit is not None:                               # the dictionary is shuffled to
        monkeypatch.setattr(T.C, "BROADCAST_MAX_BYTES", limit)
    rng = random.Random(5)
    pool, to = ["ab", "cd", "ef", "gh", "kl"], {"ab": "xx", "ef": "ef", "gh": "yy", "qq": "zz"}
    rows = [(i, [rng.choice(pool) for _ in range(rng.randint(1, 9))]) for i in range(200)]
    rows += [(200, []), (201, ["cd", "kl"]), (202, ["ab"] * 4)]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in rows] + [(203, None)], "id long, text string")
    seen = []

    def make(words):
        seen.append(sum(len(r["words"]) for r in words.where("words IS NOT NULL").collect()))
        return spark.createDataFrame([*to.items(), ("ab", "xy"), ("cd", None)], "token string, lemma string")

    out = {r["id"]: r["tokens"] for r in T.add_tokens(df, "text", "tokens", make).collect()}
    assert seen == [sum(len(w) for _, w in rows)]
    for i, w in [*rows, (203, [])]:
        u = [to.get(x, x) for x in w]
        assert out[i] == u + [f"{a}_{b}" for a, b in zip(u, u[1:])]


def test_deeper_forms_only_where_the_nearest_are_unknown(spark, monkeypatch):
    made, whole = [], LEM.candidates
    monkeypatch.setattr(LEM, "candidates", lambda w, pos: made.append(pos) or whole(w, pos))
    df = spark.createDataFrame([(w,) for w in WORDS], "token string")
    own = {r["token"]: r["lemma"] for r in LEM.lemma_table(df).collect()}
    assert own["running"] == "running" and own["runs"] == "run" and not made     # its own lexicon: none
