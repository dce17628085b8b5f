"""Helpers shared by the operators: scratch tables, the word definition, and
vectorised word and shingle hashes over Arrow text buffers.

A word is a run of ``[^\\x20\\x09-\\x0D]``; only A-Z are lower-cased. Both are
byte-level rules in UTF-8, so whole batches are cut and hashed in numpy
without a Python step per word.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nbsieve.session import scratch_dir

SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHINGLE = 5

_U = np.uint64
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[32, 9, 10, 11, 12, 13]] = False
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 2 ** 64)
_POWERS: dict[str, np.ndarray] = {}


ARROW_BYTES = 8 << 20       # of one Arrow batch on its way to Python
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh scratch table in the shared checkpoint folder
    and read it back: cuts the lineage and survives the loss of executors.
    While it is written, Arrow batches are bounded by their bytes, so that ten
    thousand long texts do not come at once; a smaller bound set by the caller
    stays."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    before = spark.conf.get(_BATCH_SETTING, None)
    mine = before is None or int(before.rstrip("bB") or 0) > ARROW_BYTES
    if mine:
        spark.conf.set(_BATCH_SETTING, str(ARROW_BYTES))
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if mine:
            spark.conf.unset(_BATCH_SETTING) if before is None else spark.conf.set(_BATCH_SETTING,
                                                                                   before)
    return spark.read.schema(df.schema).parquet(path)


def released(task: Callable) -> Callable:
    """A generator function of a task, over batches or (key, batches), that
    gives its memory back to the system when it ends: Python workers live on
    and serve later stages."""
    if task.__code__.co_argcount == 2:
        @wraps(task)
        def run(key: tuple, batches: Iterator[pa.RecordBatch]):
            try:
                yield from task(key, batches)
            finally:
                give_back()
    else:
        @wraps(task)
        def run(batches: Iterator[pa.RecordBatch]):
            try:
                yield from task(batches)
            finally:
                give_back()
    return run


def give_back() -> None:
    _POWERS.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)     # glibc
    if trim is not None:
        trim(0)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words_of(text: Column) -> Column:
    """array<string> of the words of a text (null: no words)."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE_RUN)
    return F.filter(parts, lambda x: x != "")


def fold_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def held_out(doc_id: Column, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``, equals 0 (null id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % buckets == 0,
                      F.lit(False))


def scale_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text",
                max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that one slice holds about ``max_bytes`` of text
    (or one longer text): bounds what the numpy steps hold at a time."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sizes = np.frombuffer(_binary(batch.column(column)).buffers()[1], dtype=np.int64)
        ends = sizes[: n + 1]
        lo = 0
        while lo < n:
            hi = int(np.searchsorted(ends, ends[lo] + max_bytes, side="right")) - 1
            hi = min(max(hi, lo + 1), n)
            yield batch.slice(lo, hi - lo)
            lo = hi


def _binary(column: pa.Array) -> pa.Array:
    """Null-free large_binary copy with offsets from 0."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    elif pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    column = column.cast(pa.large_binary()).fill_null(b"")
    return column if column.offset == 0 else pa.concat_arrays([column])


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes as uint8, offsets int64 of n + 1) of a text column; null: empty."""
    n = len(column)
    data = _binary(column)
    offsets = np.frombuffer(data.buffers()[1], dtype=np.int64)[: n + 1]
    raw = data.buffers()[2]
    buf = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    buf = buf[offsets[0]: offsets[-1]]
    return buf, offsets - offsets[0]


def fold_bytes(buf: np.ndarray) -> np.ndarray:
    return _FOLD[buf]


def word_spans(buf: np.ndarray, offsets: np.ndarray):
    """(starts, ends, bounds): byte spans of all words in document order and
    bounds[d]:bounds[d + 1], the words of document d."""
    n = len(buf)
    word = _IS_WORD[buf]
    before = np.zeros(n, dtype=bool)
    after = np.zeros(n, dtype=bool)
    before[1:] = word[:-1]
    after[:-1] = word[1:]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    before[cuts] = False
    after[cuts - 1] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_bounds(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The bounds of ``word_spans`` alone."""
    word = _IS_WORD[buf]
    start = word.copy()
    start[1:] &= ~word[:-1]
    cuts = offsets[offsets < len(buf)]
    start[cuts] = word[cuts]
    return np.searchsorted(np.flatnonzero(start), offsets)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            x = np.full(size, base, dtype=_U)
            x[0] = 1
            _POWERS[name] = np.multiply.accumulate(x)
    return _POWERS["up"], _POWERS["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (bijective)."""
    h = h ^ (h >> _U(33))
    h *= _U(0xFF51AFD7ED558CCD)
    h ^= h >> _U(33)
    h *= _U(0xC4CEB9FE1A85EC53)
    h ^= h >> _U(33)
    return h


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """P with P[e] - P[s] the polynomial hash of buf[s:e], up to base ** s."""
    up, _ = _powers(len(buf) + 1)
    out = np.zeros(len(buf) + 1, dtype=_U)
    np.cumsum((buf.astype(_U) + _U(1)) * up[: len(buf)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = _powers(len(prefix))
    h = (prefix[ends] - prefix[starts]) * down[starts]
    return mix(h + (ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93))


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, k: int = SHINGLE) -> list[np.ndarray]:
    """Per document the sorted distinct hashes of its k-word shingles (fewer
    words: the whole sequence as one; no words: none)."""
    total = len(words)
    mult = np.random.default_rng(5).integers(1, 2 ** 63, size=k, dtype=np.int64).astype(_U) | _U(1)
    full = np.zeros(max(total - k + 1, 0), dtype=_U)
    for j in range(k):
        full += words[j: j + len(full)] * mult[j]
    full = mix(full)
    out = []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        n = hi - lo
        if n >= k:
            out.append(np.unique(full[lo: hi - k + 1]))
        elif n:
            h = (words[lo:hi] * mult[:n]).sum(keepdims=True)
            out.append(mix(h + np.array([n], dtype=_U) * _U(0xA0761D6478BD642F)))
        else:
            out.append(full[:0])
    return out


def document_shingles(column: pa.Array) -> list[np.ndarray]:
    """Shingle sets of the texts of a slice (see ``shingle_hashes``)."""
    buf, offsets = text_buffer(column)
    buf = fold_bytes(buf)
    starts, ends, bounds = word_spans(buf, offsets)
    return shingle_hashes(span_hash(prefix_hash(buf), starts, ends), bounds)
