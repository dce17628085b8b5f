"""Quoted CSV read by as many tasks as plain text.

A quoted field may hold line breaks, so a line alone does not tell whether a
record begins with it. What does is the parity of the quotes before it in the
file: a doubled quote counts twice, so inside a quoted field the count is odd.

1. One pass over the lines adds up the quotes of every block (a split of a
   file) and takes the first line of every file: its header.
2. Running parities over the blocks of a file, one small row each, tell in
   which state each block begins.
3. A second pass, told the state, joins the lines of each block to whole
   records, keeps their order, and stores them. A record that crosses the end
   of a block leaves pieces, at most two per block; these are put together by
   a grouping of their own.

Records are numbered by ``position``: the block's first byte plus the record's
number in it, which rises with the order in the file. Fields are parsed by
``from_csv`` on whole records, in one scan for all headers.

Files whose quotes do not pair up (or that open a quote in the header line) are
left to Spark's own reader, one task a file; so are quotes inside unquoted
fields only where their number is odd. Line breaks are LF or CRLF; in a file whose header
line ends with CRLF, those inside fields are read as LF.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nbsieve import config as C
from nbsieve.session import cut_lineage

BLOCK_BYTES = 200           # of one block's row in the broadcast table
BATCH_BYTES = 4 << 20
WHOLE, TAIL, MIDDLE, HEAD = 0, 1, 2, 3
_PIECES = "path string, block bigint, position bigint, kind int, record binary"


def _lines(spark: SparkSession, files: list[str]) -> DataFrame:
    value = F.col("value")
    quotes = F.octet_length(value) - F.octet_length(F.replace(value, F.lit('"'), F.lit("")))
    return spark.read.option("lineSep", "\n").text(files).select(
        "value", quotes.bitwiseAND(1).alias("odd"), F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"))


def block_states(spark: SparkSession, files: list[str]) -> DataFrame:
    """(path, block, inside, header, paired): whether the block begins inside
    quotes; the file's first line; whether all its quotes pair up."""
    lines = _lines(spark, files).withColumn("n", F.monotonically_increasing_id())
    blocks = lines.groupBy("path", "block").agg(
        F.bit_xor("odd").alias("odd"),
        F.min_by(F.when(F.col("block") == 0, F.col("value")), "n").alias("header"))
    file = Window.partitionBy("path").orderBy("block")          # one row per block
    before = F.sum("odd").over(file.rowsBetween(Window.unboundedPreceding, -1))
    whole = Window.partitionBy("path")
    return blocks.select(
        "path", "block", (F.coalesce(before, F.lit(0)) % 2 == 1).alias("inside"),
        F.max("header").over(whole).alias("header"),
        (F.sum("odd").over(whole) % 2 == 0).alias("paired"))


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines, in the order of their blocks, to records and pieces of records."""
    out: list[tuple] = []
    size = 0
    block: tuple | None = None
    number, held, begun, inside = 0, [], True, 0    # held: lines of the record still open

    def put(kind: int, record: bytes) -> None:
        nonlocal number, size
        record = record.removesuffix(b"\r") if kind in (WHOLE, HEAD) else record
        out.append((*block, block[1] + number, kind, record))
        number += 1
        size += 60 + len(record)

    def close() -> None:
        if block is not None and held:               # open at the end of the block
            put(TAIL if begun else MIDDLE, b"\n".join(held))

    def flush() -> pa.RecordBatch:
        nonlocal size
        columns = list(zip(*out, strict=True))
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        batch = pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
            names=["path", "block", "position", "kind", "record"])
        out.clear()
        size = 0
        return batch

    for batch in batches:                            # bytes: they need not be UTF-8
        if not batch.num_rows:
            continue
        paths, starts = batch.column("path"), batch.column("block").to_numpy()
        path_code = pc.dictionary_encode(paths).indices.to_numpy()
        new = np.concatenate([[0], np.flatnonzero(
            (np.diff(starts) != 0) | (np.diff(path_code) != 0)) + 1, [len(starts)]])
        odd, values = batch.column("odd").to_numpy(), batch.column("value").to_pylist()
        for lo, hi in zip(new[:-1].tolist(), new[1:].tolist(), strict=True):
            here = (paths[lo].as_py(), int(starts[lo]))
            if here != block:
                close()
                inside = int(batch.column("inside")[lo].as_py())
                block, number, held, begun = here, 0, [], not inside
            state = (inside + np.cumsum(odd[lo:hi])) % 2          # after each line
            inside = int(state[-1])
            at = lo
            for end in (np.flatnonzero(state == 0) + lo + 1).tolist():
                put(WHOLE if begun else HEAD, b"\n".join([*held, *values[at:end]])
                    if held or end - at > 1 else values[at])
                held, begun, at = [], True, end
                if size > BATCH_BYTES:
                    yield flush()
            held.extend(values[at:hi])
    close()
    if out:
        yield flush()


def records(spark: SparkSession, files: list[str], states: DataFrame) -> DataFrame:
    """(path, position, record): every record of ``files``, the header among
    them; ``states`` holds their blocks."""
    known = states.select("path", "block", "inside")
    lines = _lines(spark, files).join(F.broadcast(known), ["path", "block"])
    pieces = cut_lineage(lines.select("path", "block", F.col("value").cast("binary").alias("value"), "odd", "inside")
                         .mapInArrow(_assemble, _PIECES), partition_by="kind")
    pieces = pieces.withColumn("record", F.make_valid_utf8(F.col("record").cast("string")))
    whole = pieces.where(F.col("kind") == WHOLE).select("path", "position", "record")
    parts = pieces.where(F.col("kind") != WHOLE)
    # A record's pieces follow each other: its tail, blocks it fills, its head.
    marks = parts.select("path", "block", "position", "kind")
    owner = F.last(F.when(F.col("kind") == TAIL, F.col("position")), ignorenulls=True).over(
        Window.partitionBy("path").orderBy("position"))
    joined = parts.join(marks.select("path", "position", owner.alias("first")), ["path", "position"]) \
        .groupBy("path", F.col("first").alias("position")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "record"))),
                                 lambda p: p["record"]), "\n").alias("record"))
    return whole.unionByName(joined.select("path", "position", F.regexp_replace(
        "record", "\r\\z", "").alias("record")))


def header_fields(header: str) -> list[str]:
    """Names in a header line."""
    line = header.removeprefix("﻿").removesuffix("\r")
    return next(csv.reader([line]), [])


def labelled_records(spark: SparkSession, files: list[str],
                     resolve: Callable[[list[str]], tuple[str | None, str | None]]
                     ) -> tuple[DataFrame | None, list[str], list[str]]:
    """(rows, files left to Spark's reader, headers without the columns).

    ``rows(path, position, raw_text, raw_label)`` of all files whose header
    ``resolve`` finds a text and a label column in, header records left out."""
    states = cut_lineage(block_states(spark, files))
    as_uri = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    named = {as_uri(f).toUri().toString(): f for f in files}     # paths are given as URIs
    heads = states.where("block = 0").select("path", "header", "paired")
    other = [r["path"] for r in heads.where(
        (~F.col("paired")) | ((F.length("header") - F.length(F.replace(
            F.col("header"), F.lit('"'), F.lit("")))) % 2 == 1)).collect()]
    left = states.where("paired").join(
        spark.createDataFrame([(p,) for p in other], "path string"), "path", "left_anti") \
        if other else states
    picks, missing = [], []
    for r in left.where("block = 0").select("header").distinct().collect():
        names = header_fields(r["header"] or "")
        text, label = resolve(names)
        if text is None or label is None:
            missing.append(r["header"])
        else:
            picks.append((r["header"], names.index(text), names.index(label)))
    if not picks:
        return None, [named[p] for p in other], missing
    columns = spark.createDataFrame(picks, "header string, text_at int, label_at int")
    chosen = left.join(F.broadcast(columns), "header")           # one row per header
    out, waiting = None, cut_lineage(chosen)
    paths = waiting.groupBy("path").agg(F.count(F.lit(1)).alias("n")).collect()
    width = max(max(t, la) for _, t, la in picks) + 1
    schema = ", ".join(f"c{k} string" for k in range(width))
    options = {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    for group in _groups([(r["path"], r["n"]) for r in paths]):
        mine = waiting if group is None else waiting.where(F.col("path").isin(group))
        at = mine.where("block = 0").select("path", "text_at", "label_at",
                                            F.endswith("header", F.lit("\r")).alias("crlf"))
        rows = records(spark, [named[p] for p in group or [r["path"] for r in paths]], mine).where("position > 0").join(F.broadcast(at), "path")
        record = F.when(F.col("crlf"), F.replace(F.col("record"), F.lit("\r\n"), F.lit("\n"))) \
            .otherwise(F.col("record"))
        cells = F.from_csv(record, schema, options)
        rows = rows.withColumn("cells", cells).withColumn(
            "cells", F.array(*[F.col("cells")[f"c{k}"] for k in range(width)])).select(
            "path", "position", F.get("cells", F.col("text_at")).alias("raw_text"),
            F.get("cells", F.col("label_at")).alias("raw_label"))
        out = rows if out is None else out.unionByName(rows)
    return out, [named[p] for p in other], missing


def _groups(sizes: list[tuple[str, int]], limit: int | None = None) -> list[list[str] | None]:
    """Files in groups whose tables of blocks are small enough to broadcast;
    [None] if one group takes all."""
    limit = limit or C.BROADCAST_MAX_BYTES // BLOCK_BYTES
    if sum(n for _, n in sizes) <= limit:
        return [None]
    groups, held = [[]], 0
    for path, n in sorted(sizes):
        if groups[-1] and held + n > limit:
            groups.append([])
            held = 0
        groups[-1].append(path)
        held += n
    return groups
