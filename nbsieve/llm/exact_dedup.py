"""Exact duplicates with Patricia-trie owners (operator 13).

Two texts are equal when they are identical after deleting every character of
``[\\x20\\x09-\\x0D]``. Texts are compared as whole byte strings, never by hash:

1. Every scan task inserts its normalised texts into a radix trie and gives
   each distinct string a class; a document keeps its class number, and a class
   is one row with its bytes, its count and its best row. Copies are so merged
   before anything is shuffled. A trie over its memory gives up its heaviest
   subtree, whose classes are written out; later copies begin a class anew.
2. Classes are dealt to partitions by (length, content hash) and inserted into
   one trie per partition; a terminal node's owner is the best row of its
   classes. A trie over its memory gives up its heaviest subtree: the rows in
   it, and those that come for it later, stay open and are dealt again in the
   next round over more partitions. Every round settles what its tries hold.
3. Documents are joined with the owner of their class. A class number holds
   the documents of one scan task at most, so no key is hot.

Of equal texts the row with the most code points in its original text stays,
then the one of smallest id, then the first in scan order.

Defined cases: a null text is empty, and all blank texts are equal; a null id
comes after every other id, and ``keep_id`` is null where only such rows have
the most code points; of rows that repeat an id one is kept; columns of the
input besides id and text are not read; an empty table gives no rows. An
owner lists its classes: at most one per scan task and given-up subtree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nbsieve.llm.common import stored, text_buffer, text_slices
from nbsieve.llm.radix_trie import RadixTrie

BLANKS = b" \t\n\x0b\x0c\r"
LOCAL_BYTES = 64 << 20      # trie of a scan task
OWNER_BYTES = 96 << 20      # trie of a partition of classes
PART_BYTES = 32 << 20       # normalised text dealt to a partition
BATCH_BYTES = 4 << 20
LAST_ID = 2 ** 63           # stands for a null id: after all others

LOCAL = "class bigint, row bigint, doc_id bigint, points bigint, n bigint, body binary"
OWNED = ("class bigint, keep_row bigint, keep_id bigint, group_size bigint, text_sha256 string, "
         "row bigint, doc_id bigint, points bigint, n bigint, body binary")
_LOCAL_SCHEMA = pa.schema([(c, pa.int64()) for c in ("class", "row", "doc_id", "points", "n")]
                          + [("body", pa.binary())])
_OWNED_SCHEMA = pa.schema([(c, pa.int64()) for c in ("class", "keep_row", "keep_id", "group_size")]
                          + [("text_sha256", pa.string())]
                          + [(c, pa.int64()) for c in ("row", "doc_id", "points", "n")]
                          + [("body", pa.binary())])


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Record batches of about ``BATCH_BYTES`` of rows whose last field is bytes."""
    held, size = [], 0

    def batch():
        columns = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    for row in rows:
        held.append(row)
        size += 64 + len(row[-1] or b"")
        if size > BATCH_BYTES:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _better(a: tuple, b: tuple) -> tuple:
    """The better of two (-points, id, row)."""
    return a if a <= b else b


def local_classes(docs: DataFrame, memory: int = LOCAL_BYTES) -> DataFrame:
    """A row for each document (n null) and, per scan task, one for each
    distinct string (n: its documents; row, doc_id, points: the best one)."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, base = RadixTrie(), TaskContext.get().partitionId() << 40
        n_rows = n_classes = 0

        def classes(found):
            for body, (number, n, best) in found:
                points, doc_id, row = best
                yield (number, row, None if doc_id == LAST_ID else doc_id, -points, n, body)

        for batch in text_slices(batches):
            points = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_pylist()
            ids = batch.column("doc_id").to_pylist()
            buf, offsets = text_buffer(batch.column("text"))
            raw, ends = buf.tobytes(), offsets.tolist()
            numbers = np.empty(len(ids), dtype=np.int64)
            for i, doc_id in enumerate(ids):
                body = raw[ends[i]:ends[i + 1]].translate(None, BLANKS)
                best = (-points[i], LAST_ID if doc_id is None else doc_id, base + n_rows + i)
                entry = trie.entries(body)
                if entry:
                    entry[1] += 1
                    entry[2] = _better(entry[2], best)
                else:
                    entry[:] = (base + n_classes, 1, best)
                    n_classes += 1
                numbers[i] = entry[0]
                while trie.size > memory and (found := trie.give_up(remember=False)):
                    yield from _batches(classes(found), _LOCAL_SCHEMA)
            nothing = pa.nulls(len(ids), pa.int64())
            rows = pa.array(np.arange(base + n_rows, base + n_rows + len(ids)))
            n_rows += len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers), rows, batch.column("doc_id"), nothing, nothing,
                 pa.nulls(len(ids), pa.binary())], schema=_LOCAL_SCHEMA)
        yield from _batches(classes(trie), _LOCAL_SCHEMA)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(scan, LOCAL)


def owners(classes: DataFrame, parts: int, memory: int = OWNER_BYTES) -> DataFrame:
    """``classes`` with their owner, or as they came (group_size null) where
    their subtree was given up."""
    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = RadixTrie()

        def left_open(body, entries):
            for row in entries:
                yield (row[0], None, None, None, None, *row[1:], body)

        def settled():
            for body, entries in trie:
                points, doc_id, best = min(
                    (-p, LAST_ID if d is None else d, r) for _, r, d, p, _ in entries)
                size, digest = sum(e[4] for e in entries), hashlib.sha256(body).hexdigest()
                for row in entries:
                    yield (row[0], best, None if doc_id == LAST_ID else doc_id, size, digest,
                           None, None, None, None, None)

        for batch in text_slices(batches, column="body"):
            out = []
            columns = [batch.column(c).to_pylist() for c in ("class", "row", "doc_id", "points", "n")]
            for body, *row in zip(batch.column("body").to_pylist(), *columns, strict=True):
                entries = trie.entries(body)
                if entries is None:
                    out.extend(left_open(body, [row]))
                    continue
                entries.append(row)
                while trie.size > memory and (found := trie.give_up(remember=True)):
                    for key, given in found:
                        out.extend(left_open(key, given))
            yield from _batches(iter(out), _OWNED_SCHEMA)
        yield from _batches(settled(), _OWNED_SCHEMA)

    key = [F.octet_length("body"), F.xxhash64("body")]
    return classes.select("class", "row", "doc_id", "points", "n", "body") \
        .repartition(parts, *key).mapInArrow(own, OWNED)


def exact_groups(docs: DataFrame, local_bytes: int = LOCAL_BYTES, owner_bytes: int = OWNER_BYTES,
                 part_bytes: int = PART_BYTES) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of
    ``docs(doc_id, text)``."""
    local = stored(local_classes(docs, local_bytes), "exact-local")
    is_open, settled, round_no = local.filter("n IS NOT NULL"), [], 0
    while True:
        size = is_open.agg(F.sum(F.octet_length("body") + 64)).first()[0]
        if size is None:
            break
        parts = max(1, -(-size // part_bytes)) * 2 ** round_no + round_no
        owned = stored(owners(is_open, parts, owner_bytes), f"exact-owners-{round_no}")
        settled.append(owned.filter("group_size IS NOT NULL")
                       .select("class", "keep_row", "keep_id", "group_size", "text_sha256"))
        is_open = owned.filter("group_size IS NULL")
        round_no += 1
    if not settled:
        return local.limit(0).select(
            "doc_id", F.lit(None).cast("bigint").alias("keep_id"),
            F.lit(None).cast("bigint").alias("group_size"),
            F.lit(None).cast("boolean").alias("kept"),
            F.lit(None).cast("string").alias("text_sha256"))
    found = settled[0]
    for more in settled[1:]:
        found = found.unionByName(more)
    return local.filter("n IS NULL").select("class", "row", "doc_id").join(found, "class").select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        "text_sha256")


def op13_exact_dedup(docs: DataFrame) -> DataFrame:
    return exact_groups(docs)


ORACLE = """
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS points,
             regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS body FROM documents),
r AS (SELECT doc_id, body, first_value(doc_id) OVER best AS keep_id,
        row_number() OVER best AS nth, count(*) OVER (PARTITION BY body) AS group_size
      FROM n WINDOW best AS (PARTITION BY body ORDER BY points DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, nth = 1 AS kept, sha256(body) AS text_sha256
FROM r"""
