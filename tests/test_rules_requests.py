from pyspark.sql import functions as F

from nbsieve import config as C
from nbsieve.operators import nb
from nbsieve.operators import rules as R

RULES = ((r"\btrash\b", 0.3), (r"\btrash can\b", 0.5), (r"\bjia\b.*\bunstop\b", 0.55))


def test_boost_max_and_clamp(spark):
    df = spark.createDataFrame([("some trash can here",), ("JIA\rrom x unstop",), ("trashy",), ("nothing",)], "t string")
    got = [r[0] for r in df.select(R.sender_boost(F.col("t"), RULES)).collect()]
    # two rules match -> max; '.' crosses '\r' like Python; no partial word
    assert got == [0.5, 0.55, 0.0, 0.0]
    b = spark.createDataFrame([(0.8, 0.5), (0.2, 0.0)], "p double, b double") \
        .select(R.apply_boost(F.col("p"), F.col("b"))).collect()
    assert [r[0] for r in b] == [1.0, 0.2]
    default = [r[0] for r in df.select(R.sender_boost(F.col("t"))).collect()]
    assert default == [0.0, 0.55, 0.0, 0.0] and len(C.SENDER_RULES) == 15


def test_request_branches(spark):
    tr = spark.createDataFrame(
        [(1, "spam", "win cash prize now"), (2, "spam", "cash prize claim"), (3, "ham", "lunch meeting today"),
         (4, "ham", "meeting notes lunch"), (5, "ham", "family lunch today")],
        "doc_id long, label string, text string")
    m = nb.fit(nb.tokenize(tr))
    req = spark.createDataFrame(
        [(1, "   ", None, None), (5, "\n\t \u00a0", None, None), (2, "the and of", None, True), (3, "lunch meeting trash", 0.65, True),
         (4, "lunch meeting today", 0.65, False)],
        "request_id long, message string, decision_threshold double, use_sender_boost boolean")
    out = {r["request_id"]: r for r in R.score_requests(m, req, rules=RULES).collect()}
    for k in (1, 5):
        assert out[k]["status"] == "error" and out[k]["prediction"] is None
    assert out[2]["prediction"] == "uncertain" and out[2]["confidence"] == 0.0 and out[2]["p_spam"] == 0.5
    r3 = out[3]
    assert r3["boost_applied"]
    if r3["p_spam"] > 1 - 0.65:
        assert r3["prediction"] == "spam" and r3["explanation"].startswith("Sender-boosted SPAM (P=")
    else:
        assert r3["prediction"] != "spam" or r3["explanation"].startswith(("Confident", "UNCERTAIN"))
    assert not out[4]["boost_applied"]


def test_badges(spark):
    df = spark.createDataFrame([("spam", 0.876), ("uncertain", 0.5), ("ham", 0.9)], "p string, c double")
    rows = df.select(*R.badges(F.col("p"), F.col("c"))).collect()
    assert rows[0]["badge"] == "[SPAM 88%]" and rows[1]["badge"] == "[HAM]"
    assert rows[1]["popup_verdict"] == C.POPUP_UNCERTAIN and rows[2]["popup_confidence"] == "90.0%"


def test_rules_table_equals_rule_list(spark):
    texts = ["some trash can here", "JIA\rrom x unstop", "trashy", "nothing", None, "", "a re dd it reddit!",
             "mail noreply@reddit.com now", "worthless", "xworthless", "fooo", "foo"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rules = RULES + tuple(C.SENDER_RULES) + ((r"worthless", 0.2), (r"\bfooo?\b", 0.1), (r"\babcd|nothing", 0.7))
    want = {r[0]: r[1] for r in docs.select(
        "doc_id", R.sender_boost(F.coalesce("text", F.lit("")), rules)).collect()}
    table = spark.createDataFrame(list(rules), "pattern string, boost double")
    got = {r["doc_id"]: r["boost"] for r in R.boosts_by_table(docs, table).collect()}
    assert got == want and got[0] == 0.5 and got[10] == 0.1 and got[3] == 0.7


def test_required_literals(spark):
    want = {r"\btrash can\b": ("trash", True), r"noreply@reddit\.com": ("noreply", False), r"(abcd)+efgh": ("efgh", False),
            r"x{2}yabcd?": ("yabc", False), r"x{2}abcd?": ("", False), r"abcdefs?": ("abcdef", False), r"[a-z]{4,}abcd": ("abcd", False),
            r"abcd|efgh": ("", False), r"(?i)abcd": ("", False), r"\x61bcde": ("", False), r"\bab\b.*bcdef+": ("bcdef", False),
            r"\bab(cd(ef|gh))\bwxyz": ("wxyz", True), r"\Qabcd\E": ("", False), "ABCD": ("", False), r"lo\wdefgh": ("defgh", False)}
    table = spark.createDataFrame([(p, 0.1) for p in want], "pattern string, boost double")
    got = {r["pattern"]: (r["literal"], r["at_start"]) for r in R.required_literals(table).collect()}
    assert got == want


def test_rules_table_of_any_size(spark, monkeypatch):
    texts = ["abcdefg hij", "xxabcdefgxx", "bcde", "BCDEF! ghij", "pq", "r st uv", None, "abcé abcd", "éabcd", "noreply@reddit.com"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rules = [(r"\babcd", 0.2), (r"abcdef", 0.3), (r"cde", 0.1), (r"\bbcde(f|g)?\b", 0.4), (r"(pq|st)", 0.5),
             (r"reddit\.com$", 0.6), (r"ghij", 0.25)]
    want = {r[0]: r[1] for r in docs.select("doc_id", R.sender_boost(F.coalesce("text", F.lit("")), rules)).collect()}
    table = spark.createDataFrame(rules * 2 + [(None, 0.9)], "pattern string, boost double")
    for small, few in ((50_000, 64), (0, 64), (0, 0)):
        monkeypatch.setattr(R, "SMALL_RULES", small)
        monkeypatch.setattr(R, "FEW_PATTERNS", few)
        assert {r["doc_id"]: r["boost"] for r in R.boosts_by_table(docs, table).collect()} == want
    monkeypatch.setattr(R, "FEW_PATTERNS", 64)
    assert "NestedLoop" not in R.boosts_by_table(docs, table)._jdf.queryExecution().executedPlan().toString()
    assert R.boosts_by_table(docs, table.limit(0)).where("boost > 0").count() == 0
    assert R.boosts_by_table(docs.limit(0), table).count() == 0
