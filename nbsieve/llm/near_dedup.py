"""Near-duplicate documents by HyperMinHash (operator 1).

A document is the set of its distinct five-word shingles. Its sketch has one
register per hash function ("bucket"): the minimum over the set is stored as
its leading-zero count and ten mantissa bits, 16 bits in all. Every register
has its own hash function rather than a share of one permutation, so a
document of fifty words leaves no register empty and banding treats long and
short documents alike.

1. Documents with equal sets collapse to one representative, numbered in the
   order of their smallest ids. Nodes are these numbers, not ids: rows that
   share an id but hold different sets are different nodes.
2. Bands of compressed registers are hashed; representatives that share a
   band key are candidates. With 40 bands of 5 registers a pair of similarity
   0.75 is missed with probability 2e-5.
3. Each bucket proposes (its smallest member, member) pairs. The share of
   equal registers, corrected for chance collisions of compressed registers
   of sets of these sizes, estimates the similarity; pairs estimated 0.15 (five
   standard errors) below the threshold are set aside, all others are
   confirmed on the full sets.
4. In buckets whose members are still in different components, every member
   outside the bucket's largest component meets the members of other
   components, in cells of bounded size: best estimates first, confirmed on
   the full sets right there, and no longer tested against a component once a
   link into it is found. Only links leave a cell.

Pairs already in one component need no test: the result is the components. No
bucket is capped or skipped, no pair list of a group is emitted, and links and
labels stay in tables.

Defined cases: null or empty texts, and texts without words, have an empty
set and link with nothing; fewer than five words: the whole sequence is the
one shingle; repeated rows share a set and so a component; rows that share an
id with different sets are compared each by its own text, and a component is
named by its smallest id; rows with a null id are returned with component and
``kept`` null, and ``keep_first`` keeps them; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nbsieve.llm.common import document_shingles, mix, released, scale_parts, stored, text_slices
from nbsieve.llm.components import components

PERCENT = 75
BANDS, ROWS = 40, 5
REGISTERS = BANDS * ROWS
MANTISSA = 10
MARGIN = 0.15                # five standard errors of the estimate
BLOCK = 1024                 # rows of one bucket on either side of a cell
BLOCK_BYTES = 8 << 20        # of their shingle sets and sketches
PART_BYTES = 8 << 20         # of cells handed to Python together
BROADCAST_IDS = 2_000_000    # ids broadcast to a scan; beyond it the scan is joined

_U = np.uint64
_rng = np.random.default_rng(20)
_MULT = _rng.integers(1, 2 ** 63, size=REGISTERS, dtype=np.int64).astype(_U) * _U(2) + _U(1)
_ADD = _rng.integers(0, 2 ** 63, size=REGISTERS, dtype=np.int64).astype(_U)
_BAND = _rng.integers(1, 2 ** 63, size=ROWS, dtype=np.int64).astype(_U) * _U(2) + _U(1)

SKETCH_SCHEMA = ("doc_id bigint, text_hash bigint, n_shingles bigint, hi bigint, lo bigint, "
                 "sketch binary, bands array<bigint>")


def compress(minima: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa bits of 64-bit minima, as uint16."""
    x = minima >> _U(11)                      # 53 bits: exact in a double
    exponent = np.frexp(x.astype(np.float64))[1]
    zeros = (53 - exponent).astype(_U)
    bits = (x << zeros) >> _U(52 - MANTISSA)
    return ((zeros << _U(MANTISSA)) | (bits & _U((1 << MANTISSA) - 1))).astype(np.uint16)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """(len(sets), REGISTERS) registers; empty sets get zeros."""
    out = np.zeros((len(sets), REGISTERS), dtype=np.uint16)
    full = [i for i, s in enumerate(sets) if len(s)]
    lo = 0
    while lo < len(full):                     # blocks that stay in the cache
        hi, size = lo, 0
        while hi < len(full) and (hi == lo or size + len(sets[full[hi]]) <= 16_384):
            size += len(sets[full[hi]])
            hi += 1
        rows = full[lo:hi]
        flat = np.concatenate([sets[i] for i in rows])
        cuts = np.cumsum([0] + [len(sets[i]) for i in rows[:-1]])
        minima = np.empty((REGISTERS, len(rows)), dtype=_U)
        work = np.empty_like(flat)
        for r in range(REGISTERS):
            np.multiply(flat, _MULT[r], out=work)
            np.add(work, _ADD[r], out=work)
            minima[r] = np.minimum.reduceat(work, cuts)
        out[rows] = compress(minima).T
        lo = hi
    return out


def band_keys(registers: np.ndarray) -> np.ndarray:
    parts = registers.reshape(-1, BANDS, ROWS).astype(_U)
    key = np.arange(1, BANDS + 1, dtype=_U)[None, :] * _U(0x9E3779B97F4A7C15)
    for j in range(ROWS):
        key = mix(key + parts[:, :, j] * _BAND[j])
    return key.view(np.int64)


def _digests(sets: list[np.ndarray]) -> tuple[pa.Array, pa.Array]:
    digest = np.frombuffer(b"".join(
        hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets), dtype=np.int64)
    return pa.array(digest[0::2]), pa.array(digest[1::2])


@released
def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        sets = document_shingles(batch.column("text"))
        registers = sketches(sets)
        keys = band_keys(registers)
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), batch.column("text_hash"),
            pa.array([len(s) for s in sets], pa.int64()), *_digests(sets),
            pa.array([r.tobytes() for r in registers], pa.binary()),
            pa.ListArray.from_arrays(
                pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32)),
                pa.array(keys.ravel())),
        ], names=["doc_id", "text_hash", "n_shingles", "hi", "lo", "sketch", "bands"])


@released
def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        sets = document_shingles(batch.column("text"))
        cuts = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
        flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *_digests(sets),
             pa.ListArray.from_arrays(pa.array(cuts), pa.array(flat))],
            names=["doc_id", "hi", "lo", "shingles"])


@cache
def _collision_table() -> np.ndarray:
    """Chance that registers of disjoint sets of 2**(i/2) and 2**(j/2)
    shingles agree: sum over cells of both sets' probability of the cell."""
    zeros = np.repeat(np.arange(54), 1 << MANTISSA)
    cell = np.tile(np.arange(1 << MANTISSA), 54)
    width = 2.0 ** -(zeros + 1)
    low = width * (1 + cell / (1 << MANTISSA))
    high = low + width / (1 << MANTISSA)
    sizes = 2.0 ** (np.arange(65) / 2)
    p = np.stack([np.exp(n * np.log1p(-low)) - np.exp(n * np.log1p(-np.minimum(high, 1 - 1e-16)))
                  for n in sizes])
    return p @ p.T


def estimated(equal: np.ndarray, n: np.ndarray, m: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Similarity from counts of equal registers, corrected for collisions."""
    at = lambda x: np.clip(np.rint(2 * np.log2(np.maximum(x, 1))), 0, 64).astype(int)
    chance = table[at(n), at(m)]
    return (equal / REGISTERS - chance) / (1 - chance)


def _worth_it(equal, n, m, table) -> np.ndarray:
    """Pairs to confirm: sizes allow the threshold and so does the estimate."""
    small, large = np.minimum(n, m), np.maximum(n, m)
    return (100 * small >= PERCENT * large) & (
        estimated(equal, n, m, table) >= PERCENT / 100 - MARGIN)


@released
def _estimate_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = _collision_table()
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16)
                .reshape(-1, REGISTERS) for c in ("a_sketch", "b_sketch"))
        n, m = (batch.column(c).to_numpy() for c in ("a_n", "b_n"))
        keep = _worth_it((a == b).sum(axis=1), n, m, table)
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _cell_links(regs, rep, label, n, sets, members, outside, table) -> list[tuple[int, int]]:
    """Links of one cell: each row outside the largest component against the
    members of other components."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x]
        return x

    out = []
    for i in outside.tolist():
        likely = _worth_it((regs[members] == regs[i]).sum(axis=1), n[members], n[i], table)
        order = members[likely & (label[members] != label[i])]
        order = order[np.argsort(-(regs[order] == regs[i]).sum(axis=1), kind="stable")]
        for j in order.tolist():
            mine, theirs = find(label[i]), find(label[j])
            if mine == theirs:
                continue
            shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * shared >= PERCENT * (len(sets[i]) + len(sets[j]) - shared):
                out.append((min(rep[i], rep[j]), max(rep[i], rep[j])))
                root[max(mine, theirs)] = min(mine, theirs)
    return out


@released
def _part_links(key: tuple, rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    t = pa.Table.from_batches(list(rows)).combine_chunks()
    if not len(t):
        return
    regs = np.frombuffer(b"".join(t["sketch"].to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)
    rep, label, n, bucket, cell = (t[c].to_numpy() for c in ("rep", "label", "n", "key", "cell"))
    as_member, as_outside = (t[c].to_numpy() for c in ("member", "outside"))
    lists = t["shingles"].chunk(0)
    flat, cuts = lists.flatten().to_numpy(), np.concatenate(
        [[0], np.cumsum(lists.value_lengths().to_numpy())])
    sets = [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    order = np.lexsort((rep, cell, bucket))
    new = np.flatnonzero((np.diff(bucket[order]) != 0) | (np.diff(cell[order]) != 0)) + 1
    table, found = _collision_table(), set()
    for rows_of_cell in np.split(order, new):
        found.update(_cell_links(regs, rep, label, n, sets, rows_of_cell[as_member[rows_of_cell]],
                                 rows_of_cell[as_outside[rows_of_cell]], table))
    links = np.array(sorted(found), dtype=np.int64).reshape(-1, 2)
    yield pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])],
                                     names=["a", "b"])


def _full_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(rep, shingles) of the stored representatives ``nodes(rep, doc_id, hi, lo)``."""
    n = nodes.count()
    few = F.broadcast if n <= BROADCAST_IDS else lambda df: df
    sets = docs.join(few(nodes.select("doc_id").distinct()), "doc_id", "left_semi") \
        .mapInArrow(_set_batches, "doc_id bigint, hi bigint, lo bigint, shingles array<bigint>") \
        .join(few(nodes), ["doc_id", "hi", "lo"]).select("rep", "shingles")
    sets = stored(sets, "full-sets")
    return sets.dropDuplicates(["rep"]) if sets.count() > n else sets    # rows repeated whole


def _confirm(pairs: DataFrame, docs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs (a, b) whose full sets reach the threshold."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    sets = _full_sets(docs, stored(reps.join(ids, "rep", "left_semi"), "pair-ids"))
    a = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(a, "a").join(b, "b").select(
        "a", "b", F.size(F.array_intersect("sa", "sb")).alias("shared"),
        (F.size("sa") + F.size("sb")).alias("total"))
    return both.filter(F.expr(f"100 * shared >= {PERCENT} * (total - shared)")).select("a", "b")


def _cells(rows: DataFrame) -> DataFrame:
    """Rows of the grid that compares a bucket's ``n_outside`` rows outside
    its main component with all its ``size`` members: blocks of members by
    blocks of outside rows. A bucket of up to ``BLOCK`` rows and ``BLOCK_BYTES``
    is one cell."""
    outside = F.col("label") != F.col("main")
    m_blocks, o_blocks = (F.greatest(F.ceil(F.col(n) / BLOCK), F.ceil(F.col(b) / BLOCK_BYTES)).cast("int")
                          for n, b in (("size", "bytes"), ("n_outside", "bytes_outside")))
    mine = F.pmod(F.xxhash64("rep"), m_blocks).cast("int")
    theirs = F.pmod(F.xxhash64("rep", F.lit(1)), o_blocks).cast("int")
    as_member = F.transform(F.sequence(F.lit(0), o_blocks - 1), lambda o: mine * o_blocks + o)
    as_outside = F.when(outside, F.transform(
        F.sequence(F.lit(0), m_blocks - 1), lambda m: m * o_blocks + theirs)).otherwise(
        F.array().cast("array<int>"))
    return rows.select(
        "key", "rep", "label", "weight", as_member.alias("m"), as_outside.alias("o"),
        F.explode(F.array_union(as_member, as_outside)).alias("cell")).select(
        "key", "rep", "label", "weight", "cell", F.array_contains("m", F.col("cell")).alias("member"),
        F.array_contains("o", F.col("cell")).alias("outside"))


def _resolved(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, part, kept) of every row of
    ``docs``; ``part`` numbers the component, two of which may share an id."""
    body = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    sketched = stored(body.withColumn("text_hash", F.xxhash64("text"))
                      .mapInArrow(_sketch_batches, SKETCH_SCHEMA), "sketches")
    with_set = sketched.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    # Numbers in sorted order: the smallest number of a component is of its smallest id.
    reps = stored(with_set.groupBy("hi", "lo").agg(F.min("doc_id").alias("doc_id"))
                  .orderBy("doc_id", "hi", "lo")
                  .withColumn("rep", F.monotonically_increasing_id()), "sets")
    owner = stored(with_set.select("doc_id", "text_hash", "n_shingles", "hi", "lo").join(
        reps.withColumnRenamed("doc_id", "first"), ["hi", "lo"])
        .select("doc_id", "text_hash", "n_shingles", "rep", "first"), "representatives")
    unique = stored(with_set.join(reps, ["hi", "lo", "doc_id"]).dropDuplicates(["rep"])
                    .select("rep", F.col("n_shingles").alias("n"), "sketch", "bands"),
                    "unique-sets")

    weight = (8 * F.col("n") + 2 * REGISTERS + 100).alias("weight")   # bytes in a cell
    in_band = unique.select("rep", weight, F.explode(F.array_distinct("bands")).alias("key"))
    buckets = in_band.groupBy("key").agg(F.min("rep").alias("hub"), F.count(F.lit(1)).alias("size"))
    members = stored(in_band.join(buckets.filter("size > 1"), "key"), "buckets")
    sketch = unique.select("rep", "n", "sketch")

    def side(name: str) -> DataFrame:
        return sketch.select(F.col("rep").alias(name), F.col("n").alias(f"{name}_n"),
                             F.col("sketch").alias(f"{name}_sketch"))

    proposed = members.filter("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")) \
                      .distinct()
    tested = stored(proposed.join(side("a"), "a").join(side("b"), "b")
                    .mapInArrow(_estimate_batches, "a bigint, b bigint"), "hub-pairs")
    links = stored(_confirm(tested, body, reps), "hub-links")
    labels = components(links)

    # Buckets that still hold several components.
    placed = members.filter("size > 2").join(labels, F.col("rep") == F.col("node"), "left") \
        .select("key", "rep", "size", "weight", F.coalesce("label", "rep").alias("label"))
    groups = placed.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"),
                                                F.sum("weight").alias("w"))
    largest = F.struct("n", "label")
    main = groups.groupBy("key").agg(
        F.max_by("label", largest).alias("main"), F.sum("w").alias("bytes"),
        (F.sum("w") - F.max_by("w", largest)).alias("bytes_outside"),
        (F.sum("n") - F.max("n")).alias("n_outside")).filter("n_outside > 0")
    cells = stored(_cells(placed.join(main, "key")), "open-cells")
    size = cells.agg(F.sum("weight")).first()[0]
    if size:
        ids = cells.select("rep").distinct()
        sets = _full_sets(body, stored(reps.join(ids, "rep", "left_semi"), "open-ids"))
        parts = max(1, -(-size // PART_BYTES))
        part = F.pmod(F.xxhash64("key", "cell"), F.lit(parts)).alias("part")
        more = cells.join(sketch, "rep").join(sets, "rep").select("*", part) \
            .repartition(min(parts, 4 * scale_parts(body)), "part").groupBy("part") \
            .applyInArrow(_part_links, "a bigint, b bigint")
        links = links.unionByName(stored(more, "cell-links"))
        labels = components(links)

    roots = stored(reps.join(labels.select(F.col("label").alias("rep")).distinct(), "rep")
                   .select(F.col("rep").alias("label"), F.col("doc_id").alias("root_id")), "roots")
    side = F.broadcast(roots) if roots.count() <= BROADCAST_IDS else roots
    part = F.coalesce("label", "rep")
    found = owner.join(labels, F.col("rep") == F.col("node"), "left").join(side, "label", "left") \
        .select("doc_id", "text_hash", "n_shingles",
                F.coalesce("root_id", "first").alias("component_id"), part.alias("part"),
                ((part == F.col("rep")) & (F.col("doc_id") == F.col("first"))).alias("kept"))
    alone = sketched.filter("n_shingles = 0 OR doc_id IS NULL").select(
        "doc_id", "text_hash", "n_shingles", F.col("doc_id").alias("component_id"),
        F.lit(None).cast("bigint").alias("part"), F.lit(True).alias("kept"))
    return found.unionByName(alone)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``; kept:
    the row's id names its component. Of rows that share an id several may be
    kept so; ``keep_first`` keeps one."""
    return _resolved(docs).select("doc_id", "n_shingles", "component_id",
                                  (F.col("doc_id") == F.col("component_id")).alias("kept"))


def op1_near_dedup(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each group of near-duplicates, with the columns of ``docs``:
    a row whose id and set are those the component is named by (of several such
    rows, one), and of the rows of one id that have no words, one. Rows with a
    null id stay."""
    rows = _resolved(docs).filter("kept AND doc_id IS NOT NULL") \
        .groupBy(F.col("doc_id").alias("__id"), "part") \
        .agg(F.min("text_hash").alias("__hash"), F.count(F.lit(1)).alias("__n"))
    ids = stored(rows.select("__id", "__hash", "__n"), "kept-ids")
    n_ids, repeated = ids.agg(F.count(F.lit(1)), F.coalesce(F.max("__n"), F.lit(0)) > 1).first()
    once = ids.select("__id", "__hash")
    side = F.broadcast(once) if n_ids <= BROADCAST_IDS else once
    hashed = docs.withColumn("__text", F.xxhash64(F.col("text").cast("string")))
    kept = hashed.join(side, (F.col("doc_id") == F.col("__id")) & (F.col("__text") == F.col("__hash")),
                       "left_semi")
    if repeated:
        kept = kept.dropDuplicates(["doc_id", "__text"])
    return kept.drop("__text").unionByName(docs.filter("doc_id IS NULL"))


ORACLE = """
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b USING (s)
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  WHERE a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))),
r(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)"""
