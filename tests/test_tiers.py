"""A vocabulary beyond the size of a broadcast: frequent words are broadcast,
only rows without one are shuffled, and the results stay the same."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from nbsieve import config as C
from nbsieve.operators import explain as X
from nbsieve.operators import nb
from nbsieve.plans import tuning

SMALL = 25 * 96          # bytes: of some eighty words, few may be broadcast


def _messages(spark):
    rows = []
    for i in range(60):
        words = ["every", "message"] + [f"w{chr(97 + (i * k) % 13)}{chr(97 + (i + k) % 7)}x" for k in range(9)]
        rows.append((i, "spam" if i % 3 else "ham", " ".join(words * (1 + i % 2)) if i % 11 else ""))
    rows += [(7, *rows[7][1:]), (None, "ham", rows[8][2]), (None, "ham", "wax unseenword wbx")]
    return spark.createDataFrame(rows, "doc_id long, label string, text string")


@pytest.fixture(scope="module")
def trained(spark):
    tok = nb.tokenize(_messages(spark)).localCheckpoint()
    return tok, lambda: nb.fit(tok.where("doc_id < 40"), max_df=0.6)


def _rows(df):
    num = dict(df.dtypes)
    cols = [F.round(c, 6).alias(c) if num[c] == "double" else F.col(c) for c in df.columns]
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def _plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def _both(trained, monkeypatch, make):
    """Results with the whole vocabulary broadcast, and in two tiers."""
    tok, fit = trained
    whole = _rows(make(fit(), tok))
    monkeypatch.setattr(C, "BROADCAST_MAX_BYTES", SMALL)
    model = fit()
    t = nb.model_tiers(model, 96)
    assert 0 < t.hot.count() <= 25 and t.hot.count() + t.cold.count() == model.vocab_size
    assert {"every", "message"} <= {r["token"] for r in t.over.collect()}   # over max_df
    passed = t.cold.join(t.filter, nb.may_be_in(t.bits), "left_semi").count()
    assert passed == t.cold.count()
    tiered = make(model, tok)
    assert whole and _rows(tiered) == whole
    return tiered


def test_scores_in_two_tiers(trained, monkeypatch):
    tiered = _both(trained, monkeypatch, lambda m, tok: nb.score(m, tok))
    # Frequent words are looked up where the rows are; before, every row was shuffled.
    assert "BroadcastHashJoin" in _plan(tiered) and "LeftAnti" in _plan(tiered)


def test_multinomial_trace_joins_once_a_pass(trained, monkeypatch):
    tiered = _both(trained, monkeypatch, lambda m, tok: X.multinomial_trace(m, tok))
    # Rows and totals: a pass each for the frequent and the other words, not one a class.
    assert _plan(tiered).count("SortMergeJoin") <= 3
    tok, fit = trained
    got = X.multinomial_trace(fit(), tok).where("token IS NOT NULL").groupBy("doc_id", "class").agg(
        F.sum("contribution").alias("s"))
    tot = X.multinomial_trace(fit(), tok).where("token IS NULL")
    bad = tot.join(got, ["doc_id", "class"], "left").where(
        F.abs(F.col("contribution") - F.coalesce("s", F.lit(0.0))) > 1e-8)
    assert bad.count() == 0


def test_multinomial_trace_broadcasts_its_words_once(trained, monkeypatch):
    tok, fit = trained
    monkeypatch.setattr(C, "BROADCAST_MAX_BYTES", 4 * SMALL)
    model = fit()
    t = nb.model_tiers(model, nb.JOINED_BYTES)
    # Only words that pass the filter by chance keep rows from the other words.
    chance = t.hot.select("token").unionByName(t.over).join(t.filter, nb.may_be_in(t.bits), "left_semi")
    assert _rows(t.passing) == _rows(chance) and t.passing.count() < t.hot.count()
    df = X.multinomial_trace(model, tok, digits=6)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    held = [x for x in final.splitlines() if "- BroadcastExchange HashedRelationBroadcastMode(List(input[0, string" in x]
    # Of the rows and of the totals together: the words, and those few; before, four tables of all words.
    assert t.cold is not None and 0 < len(held) <= 2, final


def test_multinomial_trace_rounds_what_it_would_return(trained):
    tok, fit = trained
    a, b = (X.multinomial_trace(fit(), tok, digits=d) for d in (None, 6))
    assert _rows(a) == _rows(b) and a.columns == b.columns


def test_bernoulli_trace_in_two_tiers(trained, monkeypatch):
    for part in (0, 1):
        with monkeypatch.context() as m:
            tiered = _both(trained, m, lambda model, tok, part=part: X.bernoulli_trace(model, tok)[part])
            assert _plan(tiered).count("Generate") <= 4      # a join for both classes, not one each


def test_bernoulli_trace_rounds_words_not_rows(trained, monkeypatch):
    tok, fit = trained
    plain = _rows(X.bernoulli_trace(fit(), tok)[0])
    monkeypatch.setattr(C, "BROADCAST_MAX_BYTES", SMALL)
    shown = X.bernoulli_trace(fit(), tok, digits=6)[0]
    assert _rows(shown) == plain
    # Rounded below the joins, where a row is a word, for the frequent and for the other words.
    plan = _plan(shown)
    assert "round(" in plan and "round(" not in plan.split("Join", 1)[0]


def test_stored_tokens_are_read_where_they_are_the_documents(spark, tmp_path, monkeypatch):
    """Documents that training stored are not tokenised again; what comes twice, has
    no id or no label comes as often as in the tables."""
    from nbsieve import queries as Q
    docs = _messages(spark).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    extra = spark.createDataFrame([(5, "every message again"), (None, "wax message"), (None, None), (900, None),
                                   (901, "unlabelled wax words")], "doc_id long, text string")
    docs.select("doc_id", "text").unionByName(extra).withColumn("source", F.lit("s")).withColumn("lang", F.lit("en")) \
        .write.parquet(f"{tmp_path}/documents.parquet")
    docs.where("doc_id < 50").select("doc_id", F.when(F.col("label") == "spam", 1).otherwise(0).alias("toxic")).unionByName(
        spark.createDataFrame([(6, 1), (8, None), (None, 0)], "doc_id long, toxic int")) \
        .write.parquet(f"{tmp_path}/labels.parquet")
    sf, formed, tokenize = str(tmp_path), [], nb.tokenize
    p = Q._prepared(spark, sf)
    monkeypatch.setattr(nb, "tokenize", lambda df, *a, **k: formed.append(df.count()) or tokenize(df, *a, **k))
    every = Q._all_tokens(spark, sf)
    assert formed.pop() == every.count() == 60 + 5 + 2      # 6 and 8 once more by their labels; a NULL id meets none
    for got, want in ((X.bernoulli_trace(p.model, Q._all_words(spark, sf, p), digits=6),
                       X.bernoulli_trace(p.model, every)),
                      ([X.multinomial_trace(p.model, Q._all_terms(spark, sf, p), digits=6)],
                       [X.multinomial_trace(p.model, every)])):
        for a, b in zip(got, want):
            assert _rows(a) == _rows(b)
    # Stored: 0 to 49 but 5, 6 and 8, which come more than once.
    assert formed == [every.count() - 47] * 2


def test_top_evidence_keeps_both_ends(spark):
    rows = [(d, f"w{(d * 7 + i * 5) % 40:02d}", float((i * i) % 7 - 3)) for d in range(5) for i in range(35)]
    rows += rows[:20] + [(None, "x", 1.0), (None, "y", 1.0), (7, "only", -0.0)]
    ev = spark.createDataFrame(rows, "doc_id long, token string, score double").repartition(3)
    want = []
    for d in {r[0] for r in rows}:
        own = sorted(((-s, t) for i, t, s in rows if i == d))
        for side, ends in (("spam", own[:10]), ("ham", own[::-1][:10])):
            want += [(d, side, k, t, -s) for k, (s, t) in enumerate(ends, 1)]
    got = X.top_evidence(ev, 10)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert dict(got.dtypes)["rank"] == "int"
    assert "Window" not in _plan(got)       # before: all rows of a document were sorted, once an end


def test_evidence_in_two_tiers(trained, monkeypatch):
    _both(trained, monkeypatch, lambda m, tok: X.doc_evidence(m, tok))
    tok, fit = trained
    assert all("_" not in r["token"] for r in X.doc_evidence(fit(), tok, unigrams_only=True).collect())


def test_cross_validation_in_two_tiers(spark, monkeypatch):
    msgs = _messages(spark).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    whole = _rows(tuning.cross_validate(msgs, k=3, max_df=0.6))
    calls = []
    rows = nb.weighted_rows
    monkeypatch.setattr(nb, "weighted_rows", lambda *a: calls.append(a[4].cold) or rows(*a))
    monkeypatch.setattr(C, "BROADCAST_MAX_BYTES", 25 * 112)
    assert _rows(tuning.cross_validate(msgs, k=3, max_df=0.6)) == whole and calls[0] is not None


def test_a_cut_by_folder_needs_no_sort(spark, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    from nbsieve.session import cut_lineage
    key, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    before = spark.conf.get(key)
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda w, *a, **k: seen.append(spark.conf.get(key)) or write(w, *a, **k))
    df = spark.range(300).select("id", F.concat(F.lit("p"), (F.col("id") % 12).cast("string")).alias("part"))
    back = cut_lineage(df, partition_by="part")         # more folders than open files
    assert int(seen[0]) > 0 and spark.conf.get(key) == before
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_shuffle_files_of_training_are_freed(spark, tmp_path):
    import time

    from nbsieve.plans import pipeline
    docs = _messages(spark).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    docs.withColumn("source", F.lit("s")).withColumn("lang", F.lit("en")).drop("label").write.parquet(f"{tmp_path}/documents.parquet")
    docs.select("doc_id", F.when(F.col("label") == "spam", 1).otherwise(0).alias("toxic")).write.parquet(f"{tmp_path}/labels.parquet")
    held = lambda: set(map(str, spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
        spark._jsc.sc().env().mapOutputTracker().shuffleStatuses().keys())))
    before = held()
    p = pipeline.prepare(spark, str(tmp_path), reuse=False)
    for _ in range(50):                 # the files go in the background
        if not held() - before:
            break
        time.sleep(0.2)
    assert not held() - before and p.model.vocab_size
