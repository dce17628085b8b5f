"""Streaming inbox scoring.

``readStream`` of inbox rows ``(msg_id, ts, subject, snippet)`` ->
``foreachBatch`` with the batch scorer (X1: scoring needs a per-message
regroup, which a micro-batch does without streaming state) -> results
written by batch id with overwrite (at-least-once delivery made idempotent).

Seen once (X2): a message delivered again carries the same id and time stamp,
so every batch is de-duplicated within itself and against the ids that earlier
batches stored (``SeenStore``), of the days that occur in the batch. Nothing is
dropped for being late: a message a year old is scored when it arrives.

Bad messages (X4) go to a dead-letter folder with a status and never stop the
stream: rows without an id, which cannot be told apart; records that the reader
could not parse; rows with nothing to score; and rows that make scoring fail. A
batch that fails is halved until those rows stand alone; the others are scored.
Per-session defaults come from a static settings table (X3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nbsieve import config as C
from nbsieve.operators import nb
from nbsieve.operators import rules as R
from nbsieve.sources import manifest

INBOX_SCHEMA = "msg_id bigint, ts timestamp, session_id string, subject string, snippet string"


def default_settings(spark: SparkSession) -> DataFrame:
    """One row of defaults (threshold 0.65, boost off); real sessions
    would add rows keyed by session_id."""
    return spark.createDataFrame([("default", C.REQUEST_THRESHOLD, False)],
                                 "session_id string, decision_threshold double, use_sender_boost boolean")


def inbox_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int = 1000,
                 kind: str = "parquet") -> DataFrame:
    """Inbox rows from Parquet, or from JSON lines: ``unreadable`` then holds a
    line that is no record."""
    reader = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
    if kind == "parquet":
        return reader.schema(INBOX_SCHEMA).parquet(source_dir) \
            .withColumn("unreadable", F.lit(None).cast("string"))
    return reader.schema(f"{INBOX_SCHEMA}, unreadable string").option("mode", "PERMISSIVE") \
        .option("columnNameOfCorruptRecord", "unreadable").json(source_dir)


class SeenStore:
    """Ids of the messages of earlier batches, in a bounded number of files.

    A batch leaves one segment, ``segments/b<batch>``. Before a batch begins,
    ``FAN`` segments of one level are merged into one of the next, sorted by
    day and id, and the manifest of the live segments is replaced: it appears
    when it is whole, and what it no longer names is deleted after. A merge
    takes only batches before the one at hand, so a batch that is run again
    after a restart does not find its own ids."""

    FAN = 8
    FILE_ROWS = 4_000_000
    SCHEMA = "msg_id bigint, day date"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _manifest(self) -> dict:
        found = [n for n in manifest.names(self.spark, self.path) if n == "manifest.json"]
        return manifest.read_json(self.spark, f"{self.path}/manifest.json") if found else {
            "upto": -1, "merged": []}

    def _batches(self, after: int, before: int) -> list[str]:
        ids = [int(n[1:]) for n in manifest.names(self.spark, f"{self.path}/segments") if n[0] == "b"]
        return [f"b{i}" for i in sorted(ids) if after < i < before]

    def live(self, batch_id: int) -> list[str]:
        about = self._manifest()
        return [s["name"] for s in about["merged"]] + self._batches(about["upto"], batch_id)

    def _read(self, segments: list[str]) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(
            *[f"{self.path}/segments/{name}" for name in segments])

    def merge(self, batch_id: int) -> None:
        about = self._manifest()
        small, merged = self._batches(about["upto"], batch_id), about["merged"]
        if len(small) < self.FAN:
            return
        upto, level = int(small[-1][1:]), 1
        while True:
            name = f"m{level}-{upto}"
            self._write(self._read(small), name)
            same = [s for s in merged if s["level"] == level]
            merged = [s for s in merged if s["level"] != level]
            if len(same) + 1 < self.FAN:
                merged += [*same, {"name": name, "level": level}]
                break
            small, level = [*(s["name"] for s in same), name], level + 1
        manifest.write_json(self.spark, f"{self.path}/manifest.json", {"upto": upto, "merged": merged})
        named = {s["name"] for s in merged}
        for found in manifest.names(self.spark, f"{self.path}/segments"):
            old = int(found[1:]) <= upto if found[0] == "b" else found not in named
            if old:
                manifest.drop(self.spark, f"{self.path}/segments/{found}")

    def _write(self, rows: DataFrame, name: str) -> None:
        files = max(1, -(-rows.count() // self.FILE_ROWS))
        rows.repartitionByRange(files, "day", "msg_id").sortWithinPartitions("day", "msg_id") \
            .write.mode("overwrite").parquet(f"{self.path}/segments/{name}")

    def add(self, rows: DataFrame, batch_id: int) -> None:
        rows.select("msg_id", "day").write.mode("overwrite").parquet(
            f"{self.path}/segments/b{batch_id}")

    def unseen(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Rows of the batch, one per ``msg_id``, with their ``day``, that no
        earlier batch stored. Stored days outside the batch's are not read."""
        once = batch.dropDuplicates(["msg_id"]).withColumn(
            "day", F.coalesce(F.to_date("ts"), F.lit("1970-01-01").cast("date")))
        segments = self.live(batch_id)
        if not segments:
            return once
        first, last = once.agg(F.min("day"), F.max("day")).first()
        if first is None:
            return once
        seen = self._read(segments).where(F.col("day").between(F.lit(first), F.lit(last)))
        return once.join(seen.select("msg_id"), "msg_id", "left_anti")


MOST_SETTINGS = 200_000     # rows of the settings table that may be broadcast
HOT_SESSION = 10_000        # messages of a batch; a session with more is joined apart


def with_settings(rows: DataFrame, settings: DataFrame, small: bool) -> DataFrame:
    """``rows`` with the settings of their session (X3), which stay where they are:
    most messages may be of one session, so a shuffle by it would put a whole batch
    into one task. A table that is not ``small`` is broadcast for the batch's large
    sessions alone (one in ``HOT_SESSION`` messages at most); only the messages of
    the others are shuffled. ``rows`` is then read more than once."""
    if small:
        return rows.join(F.broadcast(settings), "session_id", "left")
    hot = F.broadcast(rows.groupBy("session_id").agg(F.count(F.lit(1)).alias("n"))
                      .where(F.col("n") > HOT_SESSION).select("session_id"))
    own = F.broadcast(settings.join(hot, "session_id", "left_semi"))
    return rows.join(hot, "session_id", "left_semi").join(own, "session_id", "left").unionByName(
        rows.join(hot, "session_id", "left_anti").join(settings, "session_id", "left"))


MOST_BAD = 1_000            # rows set aside one by one; beyond it, the batch itself is at fault


def failing_rows(rows: DataFrame, key: str, attempt) -> list[tuple[int, str]]:
    """(key, error) of the rows on which ``attempt(rows)`` raises: halves by
    bits of the key's hash are tried until a failing part is one row. Rows are
    expected to be stored and their keys to differ. If no part works, or more
    than ``MOST_BAD`` rows fail, the fault is not the rows' and is raised."""
    h, bad, worked = F.xxhash64(key), [], False

    def error_of(part: DataFrame) -> Exception | None:
        try:
            attempt(part)
        except Exception as e:  # noqa: BLE001  (whatever scoring raises)
            return e
        return None

    def search(part: DataFrame, depth: int, error: Exception) -> None:
        nonlocal worked
        keys = [r[key] for r in part.select(key).limit(2).collect()]
        if not keys:
            return
        if len(keys) == 1 or depth == 64:
            bad.extend((k, str(error).split("\n")[0][:500]) for k in
                       (keys if depth < 64 else [r[key] for r in part.select(key).collect()]))
            if len(bad) > MOST_BAD:
                raise error
            return
        bit = F.call_function("shiftrightunsigned", h, F.lit(depth)).bitwiseAND(F.lit(1).cast("long"))
        known = None
        for side in (0, 1):
            half = part.where(bit == side)
            # If one half works, the other one is at fault: no attempt is needed.
            found = error if side == 1 and known == "worked" else error_of(half)
            if found is None:
                known, worked = "worked", worked or not half.isEmpty()
            else:
                search(half, depth + 1, found)

    whole = error_of(rows)
    if whole is None:
        return []
    search(rows, 0, whole)
    if not worked and len(bad) > 1:
        raise whole
    return bad


def start_scoring(spark: SparkSession, model: nb.NBModel, source_dir: str, out_dir: str,
                  checkpoint_dir: str, settings: DataFrame | None = None,
                  rules=C.SENDER_RULES,
                  state_partitions: int | None = None, kind: str = "parquet",
                  scorer=R.score_requests):
    """Start the streaming query (trigger availableNow: drain and stop).

    Each micro-batch's shuffles use ``state_partitions`` (default: two for each
    partition that the batch is read in, at least the cluster's parallelism, so a
    task's share does not grow with the batch). The stream
    runs on a clone of the session taken at start, so the caller's session
    keeps its own setting."""
    settings = settings if settings is not None else default_settings(spark)
    small = settings.limit(MOST_SETTINGS + 1).count() <= MOST_SETTINGS
    least, key = spark.sparkContext.defaultParallelism, "spark.sql.shuffle.partitions"
    stream = inbox_stream(spark, source_dir, kind=kind).withColumn("arrived", F.current_timestamp())

    def scored(rows: DataFrame) -> DataFrame:
        req = with_settings(rows, settings, small).select(
            F.col("msg_id").alias("request_id"), "message", "decision_threshold",
            "use_sender_boost")
        out = scorer(model, req, rules=rules)
        return out.select("*", *R.badges(F.col("prediction"), F.col("confidence")))

    def score_batch(batch: DataFrame, batch_id: int) -> None:
        if state_partitions is None:
            batch.sparkSession.conf.set(key, str(max(least, 2 * batch.rdd.getNumPartitions())))
        store = SeenStore(batch.sparkSession, f"{out_dir}/seen")
        store.merge(batch_id)
        new = store.unseen(batch.where("msg_id IS NOT NULL AND unreadable IS NULL"), batch_id).select(
            "msg_id", "ts", "arrived", "day",
            F.coalesce("session_id", F.lit("default")).alias("session_id"),
            R.inbox_text(F.col("subject"), F.col("snippet")).alias("message")).persist()
        rows = new.where(F.col("message").isNotNull())

        def put(name: str, df: DataFrame) -> None:
            df.withColumn("batch_id", F.lit(batch_id)) \
              .write.mode("overwrite").parquet(f"{out_dir}/{name}/batch_id={batch_id}")

        alone: list[tuple[int, str]] = []
        try:
            out = scored(rows).persist()
            put("scored", out.where(F.col("status") == "ok"))
        except Exception:  # noqa: BLE001  (raised again below unless single rows are at fault)
            alone = failing_rows(rows, "msg_id", lambda part: scored(part).write.format("noop")
                                 .mode("overwrite").save())
            without = batch.sparkSession.createDataFrame(alone, "msg_id bigint, error string")
            out = scored(rows.join(F.broadcast(without), "msg_id", "left_anti")).persist()
            put("scored", out.where(F.col("status") == "ok"))
        none = F.lit(None).cast("timestamp").alias("ts")
        dead = new.where(F.col("message").isNull()).select(
            "msg_id", "ts", F.lit("skipped: no subject or blank text").alias("status"))
        dead = dead.unionByName(out.where(F.col("status") != "ok").select(
            F.col("request_id").alias("msg_id"), none,
            F.concat(F.lit("error: "), F.col("explanation")).alias("status")))
        dead = dead.unionByName(batch.where("msg_id IS NULL OR unreadable IS NOT NULL").select(
            "msg_id", "ts", F.when(F.col("unreadable").isNotNull(), F.concat(
                F.lit("unreadable: "), F.col("unreadable"))).otherwise("skipped: no msg_id").alias("status")))
        if alone:
            dead = dead.unionByName(batch.sparkSession.createDataFrame(
                alone, "msg_id bigint, error string").select(
                "msg_id", none, F.concat(F.lit("failed: "), F.col("error")).alias("status")))
        put("dead_letter", dead)
        # Last: a batch that failed before this line is scored again in full.
        store.add(new, batch_id)
        out.unpersist()
        new.unpersist()

    prev = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions or least))
    try:
        return (stream.writeStream.foreachBatch(score_batch)
                .option("checkpointLocation", checkpoint_dir)
                .trigger(availableNow=True).start())
    finally:
        spark.conf.set(key, prev)


def read_scored(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.parquet(f"{out_dir}/scored")
