"""Benchmark decontamination by containment search (operator 10),
expressions only.

A test item is the set of its distinct five-word shingles (lower-cased). It is
contained in a document that holds at least 75 % of them. Items are short and
documents long, so similarity of whole sets says little; the search is
asymmetric:

* Items are partitioned by size (powers of two of their shingle counts). An
  item's MinHash sketch is its k smallest shingle hashes, with k one more than
  the shingles a containing document may lack: by the pigeonhole principle
  every containing document holds one of them, so no item is missed.
* Each size class has one bound, the largest hash in its sketches. A document
  looks only at classes it is large enough to contain and probes with the
  hashes under their bound, from its own single pass of hashing.
* Probes that hit give candidate (document, item) pairs; only those documents
  are read again, and the pair is confirmed by counting the item's shingles
  that the document holds, as strings.

Defined cases: null and empty texts match nothing; an item of fewer than five
words is one shingle and matches only documents of the same words; items that
repeat an id are searched each by its own text; repeated documents give one
pair; null ids are carried as null; empty tables give no pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nbsieve.llm.common import SHINGLE, stored, words_of

PERCENT = 75
BROADCAST_ROWS = 2_000_000   # rows of a broadcast side; beyond it, a shuffled join


def _bounded(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if it has few rows; else as it is."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def _chain(hashes: Column, n: Column) -> Column:
    """Hash of every run of five word hashes."""
    out = hashes
    for j in range(2, SHINGLE + 1):
        out = F.zip_with(out, F.slice(hashes, j, n), lambda a, b: F.xxhash64(a, b))
    return F.slice(out, F.lit(1), n - (SHINGLE - 1))


def with_hashes(df: DataFrame) -> DataFrame:
    """Adds ``shingle_hashes``: array<long>, one for each run of five words
    (fewer words: one for the whole sequence), not yet distinct."""
    df = df.withColumn("__words", words_of(F.lower("text")))
    df = df.withColumn("__h", F.transform("__words", lambda x: F.xxhash64(x)))
    n = F.size("__h")
    whole = F.array(F.xxhash64(F.array_join("__words", " ")))
    return df.withColumn("shingle_hashes", F.when(n >= SHINGLE, _chain(F.col("__h"), n))
                         .when(n > 0, whole).otherwise(F.array().cast("array<bigint>"))) \
             .drop("__words", "__h")


def with_shingles(df: DataFrame) -> DataFrame:
    """Adds ``shingles``: distinct shingles as strings."""
    df = df.withColumn("__words", words_of(F.lower("text")))
    w = F.col("__words")
    runs = F.transform(F.sequence(F.lit(1), F.size(w) - (SHINGLE - 1)),
                       lambda i: F.array_join(F.slice(w, i, SHINGLE), " "))
    return df.withColumn("shingles", F.array_distinct(
        F.when(F.size(w) >= SHINGLE, runs).when(F.size(w) > 0, F.array(F.array_join(w, " ")))
        .otherwise(F.array().cast("array<string>")))).drop("__words")


def item_sketches(items: DataFrame) -> DataFrame:
    """(item_key, n_item, size_class, sketch) of items with words."""
    h = with_hashes(items).withColumn("__s", F.array_sort(F.array_distinct("shingle_hashes")))
    n = F.size("__s")
    may_lack = n - F.ceil(n * PERCENT / 100).cast("int")
    return h.filter(n > 0).select(
        "item_key", n.alias("n_item"), F.floor(F.log2(n)).cast("int").alias("size_class"),
        F.slice("__s", F.lit(1), may_lack + 1).alias("sketch"))


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_key, item_key, n_shared, n_item) of confirmed pairs. ``docs`` has
    (doc_key, text), ``items`` (item_key, text)."""
    sketch = stored(item_sketches(items), "item-sketches")
    classes = sketch.groupBy("size_class").agg(
        F.min("n_item").alias("least"), F.max(F.element_at("sketch", -1)).alias("bound")) \
        .orderBy("size_class").collect()           # at most 31 rows: powers of two
    probes = stored(sketch.select("item_key", "n_item", F.explode("sketch").alias("h")), "probes")

    hashed = with_hashes(docs.select("doc_key", "text")).drop("text")
    n = F.size("shingle_hashes")
    bound = F.lit(None).cast("bigint")
    top = None
    for c in classes:                              # a larger document sees more classes
        top = c["bound"] if top is None else max(top, c["bound"])
        need = -(-c["least"] * PERCENT // 100)
        bound = F.when(n >= need, F.lit(top)).otherwise(bound)
    hashed = hashed.withColumn("bound", bound)
    # explode_outer, and a filter after it: from an inner explode, or a filter
    # on the arrays, the optimizer makes a filter below the projections, which
    # evaluates the hashing once more.
    low = F.filter("shingle_hashes", lambda x: x <= F.col("bound"))
    probe = hashed.select("doc_key", n.alias("n_doc"), F.explode_outer(low).alias("h")) \
        .filter("h IS NOT NULL")
    found = probe.join(_bounded(probes), "h") \
        .filter(100 * F.col("n_doc") >= PERCENT * F.col("n_item")) \
        .select("doc_key", "item_key").distinct()
    pairs = stored(found, "candidate-pairs")

    # Confirm: only documents with a candidate, only their candidate items.
    again = docs.join(_bounded(pairs.select("doc_key").distinct()), "doc_key", "left_semi")
    theirs = with_shingles(again.select("doc_key", "text").dropDuplicates(["doc_key"])) \
        .select("doc_key", F.explode_outer("shingles").alias("shingle"))
    wanted = with_shingles(items).select(
        "item_key", F.size("shingles").alias("n_item"), F.explode_outer("shingles").alias("shingle"))
    wanted = stored(wanted, "item-shingles")
    shared = theirs.join(_bounded(wanted), "shingle").groupBy("doc_key", "item_key", "n_item") \
        .agg(F.count(F.lit(1)).alias("n_shared"))
    return shared.join(pairs, ["doc_key", "item_key"], "left_semi") \
        .filter(100 * F.col("n_shared") >= PERCENT * F.col("n_item"))


def _flat_key(df: DataFrame, id_col: str, key: str) -> DataFrame:
    """One long for (id, text): hash joins on it stay in generated code."""
    return df.select(F.col(id_col).cast("bigint").alias(id_col),
                     F.col("text").cast("string").alias("text")) \
        .withColumn(key, F.xxhash64(F.coalesce(F.col(id_col), F.lit(-1)), id_col, "text"))


def op10_decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment): the documents that
    hold an item, and which."""
    d = _flat_key(docs, "doc_id", "doc_key")
    b = _flat_key(benchmark, "item_id", "item_key").dropDuplicates(["item_key"])
    pairs = stored(contamination(d, b), "contaminated")
    ids = d.select("doc_key", "doc_id").join(
        _bounded(pairs.select("doc_key").distinct()), "doc_key", "left_semi").distinct()
    named = pairs.join(ids, "doc_key").join(_bounded(b.select("item_key", "item_id")), "item_key")
    return named.groupBy("doc_id", "item_id").agg(
        F.max(F.struct(F.col("n_shared") / F.col("n_item"), "n_shared", "n_item")).alias("m")) \
        .select("doc_id", "item_id", F.col("m.n_shared").cast("bigint").alias("n_shared"),
                F.col("m.n_item").cast("bigint").alias("n_item"),
                F.round(F.col("m.n_shared") / F.col("m.n_item"), 6).alias("containment"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` that hold no benchmark item, with their own columns."""
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-1)),
                     F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    b = _flat_key(benchmark, "item_id", "item_key").dropDuplicates(["item_key"])
    bad = stored(contamination(_flat_key(docs, "doc_id", "doc_key"), b)
                 .select(F.col("doc_key").alias("__key")).distinct(), "contaminated")
    return docs.join(_bounded(bad), key == F.col("__key"), "left_anti")


ORACLE = """
WITH dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'),
                             lambda x: x <> '') AS w FROM documents),
bw AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'),
                              lambda x: x <> '') AS w FROM benchmark),
ds AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM dw WHERE len(w) > 0)),
bs AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM bw WHERE len(w) > 0)),
n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS n_shared, n_item,
       round(count(*) / n_item, 6) AS containment
FROM ds JOIN bs USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_item HAVING 100 * count(*) >= 75 * n_item"""
