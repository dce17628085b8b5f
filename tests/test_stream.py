import datetime
import os
import tempfile

from pyspark.sql import functions as F

from nbsieve.operators import nb
from nbsieve.streaming import inbox as IB


def test_stream_scores_each_message_once(spark):
    tr = spark.createDataFrame(
        [(1, "spam", "win cash prize now"), (2, "spam", "cash prize claim"), (3, "ham", "lunch meeting today"),
         (4, "ham", "meeting notes lunch"), (5, "ham", "family lunch today")],
        "doc_id long, label string, text string")
    model = nb.fit(nb.tokenize(tr))
    base = tempfile.mkdtemp()
    ts = datetime.datetime(2026, 1, 1)
    rows = [(10, ts, None, "win cash", "prize now"), (11, ts, None, "lunch", None),
            (12, ts, None, None, "no subject element"), (10, ts, None, "win cash", "prize now")]
    df = spark.createDataFrame(rows, IB.INBOX_SCHEMA)
    df.limit(2).write.parquet(os.path.join(base, "src", "p=1"))
    df.subtract(df.limit(2)).unionByName(df.where(F.col("msg_id") == 10)) \
      .write.parquet(os.path.join(base, "src", "p=2"))
    q = IB.start_scoring(spark, model, os.path.join(base, "src"), os.path.join(base, "out"),
                         os.path.join(base, "ckpt"))
    q.awaitTermination()
    out = IB.read_scored(spark, os.path.join(base, "out"))
    ids = sorted(r["request_id"] for r in out.collect())
    assert ids == [10, 11]  # message 10 arrived twice, scored once
    dead = spark.read.parquet(os.path.join(base, "out", "dead_letter")).collect()
    assert [r["msg_id"] for r in dead] == [12]
    r10 = [r for r in out.collect() if r["request_id"] == 10][0]
    assert r10["badge"].startswith("[SPAM") == (r10["prediction"] == "spam")


def test_stream_keeps_late_messages(spark):
    """Batches of day 10, 11, 11, then messages of day 1, then day 11 again."""
    tr = spark.createDataFrame(
        [(1, "spam", "win cash prize now"), (2, "spam", "cash prize claim"), (3, "ham", "lunch meeting today"),
         (4, "ham", "meeting notes lunch")], "doc_id long, label string, text string")
    model = nb.fit(nb.tokenize(tr))
    base = tempfile.mkdtemp()
    src, out, ckpt = (os.path.join(base, x) for x in ("src", "out", "ckpt"))
    batches = [[(1, 10)], [(2, 11)], [(3, 11), (1, 10)], [(4, 11)], [(5, 1), (6, 1)], [(7, 11), (5, 1), (2, 11)]]
    for k, ids in enumerate(batches):
        rows = [(i, datetime.datetime(2026, 1, day), None, "win cash", "lunch") for i, day in ids]
        spark.createDataFrame(rows, IB.INBOX_SCHEMA).coalesce(1).write.parquet(f"{src}/p={k}")
        IB.start_scoring(spark, model, src, out, ckpt).awaitTermination()
    assert sorted(r["request_id"] for r in IB.read_scored(spark, out).collect()) == [1, 2, 3, 4, 5, 6, 7]


def test_stream_keeps_every_message_without_an_id(spark):
    tr = spark.createDataFrame([(1, "spam", "win cash prize now"), (2, "ham", "lunch meeting today")],
                               "doc_id long, label string, text string")
    base = tempfile.mkdtemp()
    src, out, ckpt = (os.path.join(base, x) for x in ("src", "out", "ckpt"))
    ts = datetime.datetime(2026, 1, 1)
    for k in range(2):
        rows = [(None, ts, None, "win cash", "prize"), (None, ts, None, "lunch", None),
                (None, ts, None, None, None), (10 + k, ts, None, "win cash", "now")]
        spark.createDataFrame(rows, IB.INBOX_SCHEMA).coalesce(1).write.parquet(f"{src}/p={k}")
        IB.start_scoring(spark, nb.fit(nb.tokenize(tr)), src, out, ckpt).awaitTermination()
    assert sorted(r["request_id"] for r in IB.read_scored(spark, out).collect()) == [10, 11]
    dead = spark.read.parquet(f"{out}/dead_letter").collect()
    assert [(r["msg_id"], r["status"]) for r in dead] == [(None, "skipped: no msg_id")] * 6


def _model(spark):
    return nb.fit(nb.tokenize(spark.createDataFrame(
        [(1, "spam", "win cash prize now"), (2, "ham", "lunch meeting today")],
        "doc_id long, label string, text string")))


def test_rows_that_make_scoring_fail_are_set_aside(spark):
    from nbsieve.operators import rules as R
    base = tempfile.mkdtemp()
    src, out, ckpt = (os.path.join(base, x) for x in ("src", "out", "ckpt"))
    ts = datetime.datetime(2026, 1, 1)
    bad = {17, 500, 999}
    rows = [(i, ts, None, "explode" if i in bad else "win cash", "now") for i in range(1000)]
    spark.createDataFrame(rows, IB.INBOX_SCHEMA).coalesce(1).write.parquet(f"{src}/p=0")

    def scorer(model, req, rules):
        message = F.when(F.col("message").startswith("explode"), F.raise_error(F.lit("cannot read this")).cast(
            "string")).otherwise(F.col("message"))
        return R.score_requests(model, req.withColumn("message", message), rules=rules)

    IB.start_scoring(spark, _model(spark), src, out, ckpt, scorer=scorer).awaitTermination()
    assert {r["request_id"] for r in IB.read_scored(spark, out).collect()} == set(range(1000)) - bad
    dead = spark.read.parquet(f"{out}/dead_letter").collect()
    assert {r["msg_id"] for r in dead} == bad and all(r["status"].startswith("failed: ") for r in dead)


def test_a_fault_that_is_not_the_rows_is_raised(spark):
    import pytest
    rows = spark.range(6).withColumnRenamed("id", "msg_id")

    def attempt(part):
        raise OSError("disk full")
    with pytest.raises(OSError):
        IB.failing_rows(rows, "msg_id", attempt)


def test_unreadable_records(spark):
    base = tempfile.mkdtemp()
    src, out, ckpt = (os.path.join(base, x) for x in ("src", "out", "ckpt"))
    os.makedirs(src)
    with open(f"{src}/a.json", "w") as f:
        f.write('{"msg_id": 1, "ts": "2026-01-01T00:00:00", "subject": "win cash"}\n{"msg_id": 2, "subj\n'
                '{"msg_id": 3, "subject": "lunch"}\n')
    IB.start_scoring(spark, _model(spark), src, out, ckpt, kind="json").awaitTermination()
    assert sorted(r["request_id"] for r in IB.read_scored(spark, out).collect()) == [1, 3]
    dead = [r["status"] for r in spark.read.parquet(f"{out}/dead_letter").collect()]
    assert dead == ['unreadable: {"msg_id": 2, "subj']


def test_seen_store_stays_small_and_survives_a_restart(spark, monkeypatch):
    monkeypatch.setattr(IB.SeenStore, "FAN", 3)
    path = os.path.join(tempfile.mkdtemp(), "seen")
    store, accepted, most = IB.SeenStore(spark, path), [], 0
    for batch in range(20):
        ids = [batch, batch, 1000 + batch, max(0, batch - 15)]
        rows = spark.createDataFrame([(i, datetime.datetime(2026, 1, 1 + i % 3)) for i in ids],
                                     "msg_id bigint, ts timestamp").coalesce(1)
        runs = []
        for _ in range(2 if batch in (7, 9) else 1):     # run again after a restart
            store.merge(batch)
            new = store.unseen(rows, batch).coalesce(1)
            runs.append(sorted(r["msg_id"] for r in new.select("msg_id").collect()))
            store.add(new, batch)
        assert runs[0] == runs[-1]
        accepted += runs[0]
        files = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
        most = max(most, len(files))
    assert len(accepted) == len(set(accepted)) == 40
    assert most <= 3 * store.FAN and len(store.live(20)) <= 2 * store.FAN


def test_messages_of_one_session_are_scored_by_many_tasks(spark):
    from nbsieve.operators import rules as R
    tr = spark.createDataFrame([(1, "spam", "win cash prize now"), (2, "ham", "lunch meeting today")],
                               "doc_id long, label string, text string")
    model = nb.fit(nb.tokenize(tr))
    base = tempfile.mkdtemp()
    src, out, ckpt = (os.path.join(base, x) for x in ("src", "out", "ckpt"))
    spark.range(400).select(F.col("id").alias("msg_id"), F.current_timestamp().alias("ts"), F.lit(None).cast(
        "string").alias("session_id"), F.lit("win").alias("subject"), F.lit("cash").alias("snippet")) \
        .repartition(4).write.parquet(f"{src}/p=0")
    tasks = []

    def scorer(model, req, rules):
        tasks.append(req.select(F.spark_partition_id()).distinct().count())
        return R.score_requests(model, req, rules=rules)

    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        IB.start_scoring(spark, model, src, out, ckpt, scorer=scorer).awaitTermination()
    finally:
        spark.conf.unset(key)
    assert tasks and min(tasks) > 1                 # before: all rows in the session's one task
    assert IB.read_scored(spark, out).count() == 400


def test_settings_beyond_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(IB, "HOT_SESSION", 10)
    rows = spark.range(60).select("id", F.when(F.col("id") < 40, "default").otherwise(
        F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).alias("session_id"))
    settings = spark.createDataFrame([("default", 0.6), ("s1", 0.7), ("s2", 0.8), ("s2", 0.9)],
                                     "session_id string, decision_threshold double")
    got, want = (sorted(map(tuple, IB.with_settings(rows, settings, small).collect()), key=repr)
                 for small in (False, True))
    assert got == want and len(got) > 60
