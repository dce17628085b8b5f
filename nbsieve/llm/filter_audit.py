"""Interaction of filters by the potential of the removal game (operator 11).

Every document gets the set of filters that it fails, as five bits; what is
counted per part of the corpus and such set (at most 32 rows a part) holds all
that follows. In the removal game of a part the worth v(S) of a coalition S of
filters is the number of documents that fail any of them. Its Hart-Mas-Colell
potential is found recursively over the 32 coalitions:

    P({}) = 0,    P(S) = (v(S) + sum of P(S without i) over i in S) / |S|

and a filter's Shapley value is P(all) - P(all without it). The recursion runs
on whole numbers: Q(S) = |S|! P(S) = (|S| - 1)! v(S) + sum of Q(S without i),
so the sum over all 120 orders is Q(all) - 5 Q(all without it). What a step of
an order removes is the difference of two coalitions' worth.

Filters (words: maximal ``[^\\x20\\x09-\\x0D]+``, case-sensitive): A under 200
words; B under half of the words distinct; C over 2 % of the code points A-Z;
D holds any of ``#$%&*|``; E identical to the text of any smaller doc_id. Texts
are compared by SHA-256, so no group of copies comes to one task.

Defined cases: null text is empty, null source the part ''; a null doc_id is
neither smaller than another nor fails E; rows that repeat an id are documents
of their own (copies of the smallest id do not fail E); a document with several
label rows has a label if one of them says so, and rows without doc_id have
none; documents without labels count in neither loss; an empty table gives no
rows.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nbsieve.llm.common import stored, words_of

FILTERS = "ABCDE"
ALL = 2 ** len(FILTERS) - 1
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_UPPER_PERCENT = 2
MARKS = "[#$%&*|]"
BROADCAST_ROWS = 200_000    # of a joined side (some 40 bytes each); beyond it, a shuffled join


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def document_flags(docs: DataFrame) -> DataFrame:
    """(doc_id, part, failed, digest): bits of A-D that fail, and the SHA-256
    of the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       text.alias("text"))
    rows = rows.withColumn("words", words_of(F.col("text")))
    n, distinct = F.size("words"), F.size(F.array_distinct("words"))
    upper = F.octet_length("text") - F.octet_length(F.regexp_replace("text", "[A-Z]+", ""))
    checks = [n < MIN_WORDS,
              100 * distinct < MIN_DISTINCT_PERCENT * n,
              100 * upper.cast("long") > MAX_UPPER_PERCENT * F.char_length("text").cast("long"),
              F.rlike("text", F.lit(MARKS))]
    failed = sum((F.when(c, F.lit(1 << k)).otherwise(0) for k, c in enumerate(checks)), F.lit(0))
    return rows.select("doc_id", "part", failed.alias("failed"),
                       F.unhex(F.sha2("text", 256)).alias("digest"))


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, n, good, toxic): documents per part and set of failed
    filters, and how many of them are labelled good and toxic."""
    rows = stored(document_flags(docs), "audit-rows")
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("first"),
                                        F.count(F.lit(1)).alias("copies"))
    firsts = stored(firsts.filter("copies > 1").select("digest", "first"), "audit-copies")
    marks = labels.filter("doc_id IS NOT NULL").groupBy(
        F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    marks = stored(marks.filter("good + toxic > 0"), "audit-labels")
    repeated = F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False))
    bit = F.lit(1 << FILTERS.index("E"))
    return rows.join(_few(firsts), "digest", "left").join(_few(marks), "doc_id", "left").select(
        "part", F.col("failed").bitwiseOR(F.when(repeated, bit).otherwise(0)).alias("failed"),
        "good", "toxic",
    ).groupBy("part", "failed").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))


def worths(counts: DataFrame) -> DataFrame:
    """A row per part: ``total``, and arrays by coalition (its bits as index)
    of the documents, good and toxic ones that it removes."""
    def worth(what: str) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(ALL)), lambda s: F.aggregate(
            "sets", F.lit(0).cast("long"),
            lambda acc, x: acc + F.when(x["failed"].bitwiseAND(s) != 0, x[what]).otherwise(0)))

    sets = F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("sets")  # 32 at most
    return counts.groupBy("part").agg(F.sum("n").alias("total"), sets).select(
        "part", "total", worth("n").alias("v"), worth("good").alias("v_good"),
        worth("toxic").alias("v_toxic"))


def potential(v: Column) -> Column:
    """Array of Q(S) = |S|! P(S) by coalition, for worths ``v``."""
    factorial = F.array(*(F.lit(x).cast("long") for x in (1, 1, 2, 6, 24)))

    def step(q: Column, s: Column) -> Column:
        own = F.get(factorial, F.bit_count(s) - 1) * F.get(v, s)
        for k in range(len(FILTERS)):
            own = own + F.when(s.bitwiseAND(1 << k) != 0,
                               F.get(q, s.bitwiseXOR(F.lit(1 << k)))).otherwise(0)
        return F.concat(q, F.array(own))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ALL)), F.array(F.lit(0).cast("long")), step)


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    games = stored(worths(failure_counts(docs, labels)).withColumn("q", potential(F.col("v"))),
                   "audit-games")
    orders = ",".join(map("".join, permutations(FILTERS)))
    places = F.sequence(F.lit(1), F.lit(len(FILTERS)))
    bit_of = lambda order, place: F.call_function(
        "shiftleft", F.lit(1), F.instr(F.lit(FILTERS), F.substring(order, place, F.lit(1))) - 1)
    order = F.col("filter_order")
    walk = F.transform(places, lambda i: F.struct(
        i.alias("step"), bit_of(order, i).alias("bit"),
        F.aggregate(places, F.lit(0), lambda acc, j: F.when(
            j < i, acc.bitwiseOR(bit_of(order, j))).otherwise(acc)).alias("before")))
    steps = games.withColumn("filter_order", F.explode(F.split(F.lit(orders), ","))) \
        .withColumn("walk", walk).select("*", F.inline("walk"))
    after, rest = F.col("before").bitwiseOR(F.col("bit")), F.col("bit").bitwiseXOR(F.lit(ALL))
    gain = lambda c: F.get(F.col(c), after) - F.get(F.col(c), F.col("before"))
    return steps.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"),
        (F.col("total") - F.get("v", after)).alias("kept"),
        gain("v").alias("removed"),
        (F.get("v", F.col("bit")) - gain("v")).alias("redundant"),
        (F.get("v", F.lit(ALL)) - F.get("v", rest)).alias("unique_fails"),
        gain("v_good").alias("good_lost"), gain("v_toxic").alias("toxic_lost"),
        (F.get("q", F.lit(ALL)) - 5 * F.get("q", rest)).alias("shapley"))


def op11_filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return filter_audit(docs, labels)


ORACLE = """
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first
  FROM documents),
good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1),
bad AS (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1),
flags AS (
  SELECT part,
    (len(words) < 200)::INT AS a, (100 * len(list_distinct(words)) < 50 * len(words))::INT AS b,
    (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text))::INT AS c,
    regexp_matches(text, '[#$%&*|]')::INT AS d, coalesce(first < doc_id, false)::INT AS e,
    doc_id IN (SELECT doc_id FROM good) AS good, doc_id IN (SELECT doc_id FROM bad) AS toxic
  FROM d),
sets AS (
  SELECT part, a + 2 * b + 4 * c + 8 * d + 16 * e AS failed, count(*) AS n,
    count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM flags GROUP BY ALL),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS t(l, bit)),
orders AS (
  SELECT v.l || w.l || x.l || y.l || z.l AS filter_order
  FROM letters v, letters w, letters x, letters y, letters z
  WHERE v.bit | w.bit | x.bit | y.bit | z.bit = 31),
steps AS (
  SELECT filter_order, s::INT AS step, l, bit,
    coalesce((SELECT sum(o.bit) FROM letters o WHERE instr(substr(filter_order, 1, s - 1), o.l) > 0), 0)::INT AS before
  FROM orders, range(1, 6) AS r(s), letters WHERE substr(filter_order, s, 1) = l),
found AS (
  SELECT part, filter_order, step, l,
    sum(n) FILTER (WHERE failed & (bit | before) = 0) AS kept,
    sum(n) FILTER (WHERE failed & bit <> 0 AND failed & before = 0) AS removed,
    sum(n) FILTER (WHERE failed & bit <> 0 AND failed & before <> 0) AS redundant,
    sum(n) FILTER (WHERE failed = bit) AS unique_fails,
    sum(good) FILTER (WHERE failed & bit <> 0 AND failed & before = 0) AS good_lost,
    sum(toxic) FILTER (WHERE failed & bit <> 0 AND failed & before = 0) AS toxic_lost
  FROM sets, steps GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, l), 0)::BIGINT AS shapley
FROM found"""
