"""Prediction by partial matching over bytes (operator 7).

The model is a trie of byte contexts up to order 5, trained on all training
documents. It is kept as tables, one per order: (context and symbol, count).
A symbol is predicted in the longest context seen in training; a symbol not
seen there costs an escape (method C: distinct / (total + distinct)) and moves
to the next shorter context, where the symbols of the longer one are excluded
from the counts. Whatever was seen in a context was seen in its suffixes, so
what remains after an escape depends on the context left alone, and every
(context, symbol) has one code length: tables of orders 0, 1, ... are joined
upwards, each row taking its parent's result. A document's score is the sum
over its bytes and one end symbol.

No table goes to every task. Documents are dealt to chunks of bounded text, by
a hash with their row number, so that equal rows spread too, and stored once,
the rows of a chunk together. A chunk lists the distinct n-grams and words it
holds with their training counts, as sorted, delta-coded blocks, one per range
of keys. A range takes all n-grams whose last two context symbols fall into
its bucket (and, on large inputs, whose third falls into its part), so the
orders 3 to 5 of a context lie in one range: the blocks of all chunks are
merged there, the code lengths computed, and each block gets back one value
per key. Orders 0 to 2 (at most 257 ** 3 keys) are computed as tables before,
and each range is joined with its own rows of them. Where a range has blocks
of many chunks, these are merged in groups first, and values return by the
same groups, so no task holds more than ``GROUP`` blocks of a range and the
range's distinct keys.

The unigram word base of the contract uses the same exchange.

Defined cases: a null text is empty and costs its end symbol; without training
documents every symbol is uniform over 257; repeated rows are scored (and
counted) each on its own; null ids train; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nbsieve.llm.common import (fold_bytes, held_out, mix, prefix_hash, released, span_hash, stored,
                                text_buffer, text_slices, word_spans)

ORDER = 5                   # bytes of context; 9 bits each, six symbols in a long
SYMBOLS = 257               # bytes and the end
END, BITS = 256, 9
FOLDS = 10
LOW = 2                     # orders up to this one are tables
CHUNK_BYTES = 24 << 20      # text of one chunk
SLICE_BYTES = 1 << 20       # text whose keys are held at a time
RANGE_BYTES = 8 << 20       # of all text, for each range of keys
MAX_FILES = 10_000          # of the stored deal
MIN_RANGES, MAX_RANGES, BUCKETS = 16, 4096, 512
GROUP = 64                  # blocks of a range that are merged, or served, at a time
LOW_RANGE = -1

_U = np.uint64
BLOCKS = "chunk bigint, range int, keys binary, n binary"
MODEL = "range int, keys binary, value binary, total bigint, kinds bigint"
VALUES = "chunk bigint, range int, keys binary, value binary"
SCORES = ("doc_id bigint, train boolean, n_tokens bigint, n_known bigint, "
          "base_score double, score double")


def _pack(values: np.ndarray) -> bytes:
    """Eight-byte numbers, byte planes apart, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T
    return len(values).to_bytes(8, "little") + zstandard.ZstdCompressor(level=1).compress(
        planes.tobytes())


def _unpack(block: bytes, dtype=np.int64) -> np.ndarray:
    n = int.from_bytes(block[:8], "little")
    raw = zstandard.ZstdDecompressor().decompress(block[8:], max_output_size=8 * n)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, n).T).view(dtype).ravel()


def _pack_keys(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.int64(0)))


def _unpack_keys(block: bytes) -> np.ndarray:
    return np.cumsum(_unpack(block))


def _added(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    if not len(keys):
        return keys, n
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(n, first)


def symbol_keys(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, bounds): for every byte and end of every text, the symbol in the
    low bits and the five symbols before it above; text d has keys
    bounds[d]:bounds[d + 1]. Ends stand in for what precedes a text."""
    n_docs = len(offsets) - 1
    sizes = np.diff(offsets)
    doc = np.repeat(np.arange(n_docs), sizes)
    full = np.full(len(buf) + n_docs * (ORDER + 1), END, dtype=np.int16)
    full[np.arange(len(buf)) + doc * (ORDER + 1) + ORDER] = buf
    keys = full.astype(np.int64)
    for j in range(1, ORDER + 1):
        keys[j:] |= full[:-j].astype(np.int64) << (BITS * j)
    real = np.ones(len(full), dtype=bool)
    begins = offsets[:-1] + np.arange(n_docs) * (ORDER + 1)
    real[(begins[:, None] + np.arange(ORDER)[None, :]).ravel()] = False
    return keys[real], offsets + np.arange(n_docs + 1)


def word_keys(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    folded = fold_bytes(buf)
    starts, ends, bounds = word_spans(folded, offsets)
    keys = span_hash(prefix_hash(folded), starts, ends).view(np.int64) | np.int64(-2 ** 63)
    return keys, bounds


class _Counts:
    """Distinct keys of a chunk with their training counts, merged as slices
    come so that no more than the distinct keys stay."""

    def __init__(self):
        self.keys, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.parts, self.waiting = [], 0

    def add(self, keys: np.ndarray, train: np.ndarray) -> None:
        for part, weight in ((keys[train], 1), (keys[~train], 0)):
            found, n = np.unique(part, return_counts=True)
            self.parts.append((found, n * weight))
            self.waiting += len(found)
        if self.waiting > 500_000:
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self.parts)])
        n = np.concatenate([self.n, *(c for _, c in self.parts)])
        self.parts, self.waiting = [], 0
        self.keys, self.n = _added(keys, n)


def key_ranges(keys: np.ndarray, ranges: int) -> np.ndarray:
    """The range of every n-gram key: a bucket of its last two context symbols,
    and a part by the symbol before them."""
    buckets = min(ranges, BUCKETS)
    parts = ranges // buckets
    last = ((keys >> BITS) & ((1 << (2 * BITS)) - 1)).astype(_U)
    third = (keys >> (3 * BITS)) & ((1 << BITS) - 1)
    return ((mix(last + _U(1)) % _U(buckets)).astype(np.int64) * parts + third % parts).astype(np.int32)


def _blocks(chunk: int, words: _Counts, grams: _Counts, ranges: int) -> Iterator[pa.RecordBatch]:
    low = _added(grams.keys & ((1 << (BITS * (LOW + 1))) - 1), grams.n)
    rows = [(LOW_RANGE, *low)]
    for counts, of in ((grams, key_ranges(grams.keys, ranges)),
                       (words, ranges + (words.keys.view(_U) % _U(ranges)).astype(np.int32))):
        order = np.argsort(of, kind="stable")
        keys, n, of = counts.keys[order], counts.n[order], of[order]
        cuts = np.flatnonzero(np.diff(of, prepend=-2, append=-2))
        rows += [(int(of[lo]), keys[lo:hi], n[lo:hi])
                 for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
    yield pa.RecordBatch.from_arrays(
        [pa.array([chunk] * len(rows), pa.int64()), pa.array([r for r, _, _ in rows], pa.int32()),
         pa.array([_pack_keys(k) for _, k, _ in rows], pa.binary()),
         pa.array([_pack(n) for _, _, n in rows], pa.binary())],
        names=["chunk", "range", "keys", "n"])


def _chunk_blocks(ranges: int):
    """Rows of a chunk lie together; where a file is read by two tasks, both
    give blocks of it."""
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, words, grams = None, _Counts(), _Counts()
        for whole in batches:
            chunks = whole.column("chunk").to_numpy()
            cuts = np.flatnonzero(np.diff(chunks, prepend=-1, append=-1)).tolist()
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if now is not None and chunks[lo] != now:
                    words.merge(), grams.merge()
                    yield from _blocks(now, words, grams, ranges)
                    words, grams = _Counts(), _Counts()
                now = int(chunks[lo])
                for batch in text_slices(iter([whole.slice(lo, hi - lo)]), max_bytes=SLICE_BYTES):
                    train = batch.column("train").to_numpy(zero_copy_only=False)
                    buf, offsets = text_buffer(batch.column("text"))
                    for counts, (keys, bounds) in ((words, word_keys(buf, offsets)),
                                                   (grams, symbol_keys(buf, offsets))):
                        counts.add(keys, np.repeat(train, np.diff(bounds)))
        if now is not None:
            words.merge(), grams.merge()
            yield from _blocks(now, words, grams, ranges)
    return run


def _low_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for keys, n in zip(batch.column("keys"), batch.column("n"), strict=True):
            yield pa.RecordBatch.from_arrays([pa.array(_unpack_keys(keys.as_py())),
                                              pa.array(_unpack(n.as_py()))], names=["key", "n"])


def _merged(blocks) -> tuple[np.ndarray, np.ndarray]:
    """(keys, counts) of (keys, n) blocks; what waits is merged when it is as
    much as what is there."""
    have = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    parts, waiting = [], 0
    for keys, n in blocks:
        parts.append((_unpack_keys(keys.as_py()), _unpack(n.as_py())))
        waiting += len(parts[-1][0])
        if waiting > max(1_000_000, len(have[0])):
            have = _added(np.concatenate([have[0], *(k for k, _ in parts)]),
                          np.concatenate([have[1], *(c for _, c in parts)]))
            parts, waiting = [], 0
    return _added(np.concatenate([have[0], *(k for k, _ in parts)]),
                  np.concatenate([have[1], *(c for _, c in parts)]))


@released
def _merge_group(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, n = _merged(pair for batch in batches
                      for pair in zip(batch.column("keys"), batch.column("n"), strict=True))
    yield pa.RecordBatch.from_arrays(
        [pa.array([key[1].as_py()], pa.int64()), pa.array([key[0].as_py()], pa.int32()),
         pa.array([_pack_keys(keys)], pa.binary()), pa.array([_pack(n)], pa.binary())],
        names=["chunk", "range", "keys", "n"])


def _range_model(ranges: int):
    """Merged counts of a range to one value per key: a word's training count,
    an n-gram's code length."""
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        keys, n = _merged(zip(left["keys"], left["n"], strict=True))
        number, total, kinds = key[0].as_py(), 0, 0
        if number >= ranges:
            value, total, kinds = n.astype(float), int(n.sum()), int((n > 0).sum())
        else:
            value = _higher_lengths(keys, n, right.sort_by("key")) if len(keys) else np.zeros(0)
        return pa.table([pa.array([number], pa.int32()), pa.array([_pack_keys(keys)], pa.binary()),
                         pa.array([_pack(value)], pa.binary()), pa.array([total], pa.int64()),
                         pa.array([kinds], pa.int64())],
                        names=["range", "keys", "value", "total", "kinds"])
    return run


def _ranged_low(ranges: int, parts: int):
    """The rows of order ``LOW`` for each range that holds their context: one
    per part of its bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            first = key_ranges(keys, ranges)                   # these keys have no third symbol
            for part in range(parts):
                yield pa.RecordBatch.from_arrays([pa.array(first + np.int32(part)), *batch.columns],
                                                 names=["range", *batch.schema.names])
    return run


def _higher_lengths(keys: np.ndarray, n: np.ndarray, low: pa.Table) -> np.ndarray:
    """log10 probabilities of the order-5 ``keys`` (sorted) from the table of
    order ``LOW`` rows; the steps of ``code_lengths`` for the orders above."""
    below = {c: low[c].to_numpy() for c in ("key", "n", "total", "kinds", "open", "left")}
    for order in range(LOW + 1, ORDER + 1):
        at, count = (keys, n) if order == ORDER else \
            _added(keys & ((1 << (BITS * (order + 1))) - 1), n)
        up = np.searchsorted(below["key"], at & ((1 << (BITS * order)) - 1))
        p_n, p_total, p_kinds, p_open, p_left = (
            below[c][up] for c in ("n", "total", "kinds", "open", "left"))
        context = at >> BITS
        first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
        size = np.diff(first, append=len(at))
        seen = count > 0
        total, kinds, hidden = (np.repeat(np.add.reduceat(x.astype(np.int64), first), size)
                                for x in (count, seen, np.where(seen, p_n, 0)))
        # After an escape: counts and kinds that the suffix has beyond this context.
        more = p_kinds - kinds
        rest = p_total - hidden + more
        with np.errstate(divide="ignore", invalid="ignore"):
            left = np.where(rest <= 0, p_left, np.where(
                p_n > 0, np.log10(p_n / rest), np.log10(more / rest) + p_left))
            opened = np.where(total == 0, p_open, np.where(
                seen, np.log10(count / (total + kinds)), np.log10(kinds / (total + kinds)) + left))
        below = {"key": at, "n": count, "total": total, "kinds": kinds, "open": opened, "left": left}
    return below["open"]


def _served(left: pa.Table, right: pa.Table) -> pa.Table:
    """One value per key of every block, from the range's model."""
    if not left.num_rows:
        return pa.table({"chunk": pa.array([], pa.int64()), "range": pa.array([], pa.int32()),
                         "keys": pa.array([], pa.binary()), "value": pa.array([], pa.binary())})
    keys = _unpack_keys(right["keys"][0].as_py())
    value = _unpack(right["value"][0].as_py(), np.float64)
    out = [_pack(value[np.searchsorted(keys, _unpack_keys(k.as_py()))]) for k in left["keys"]]
    return left.select(["chunk", "range", "keys"]).append_column("value", pa.array(out, pa.binary()))


def code_lengths(grams: DataFrame, top: int = LOW) -> DataFrame:
    """(key, n, total, kinds, open, left) of order ``top`` for every key of
    ``grams(key, n)``, where n counts training occurrences: ``open`` is the
    log10 probability of the symbol after its context, ``left`` that after an
    escape from it; total and kinds are the context's."""
    levels = [grams]
    for order in range(top - 1, -1, -1):
        mask = (1 << (BITS * (order + 1))) - 1
        levels.append(stored(levels[-1].groupBy(F.col("key").bitwiseAND(mask).alias("key"))
                             .agg(F.sum("n").alias("n")), f"order-{order}"))
    below = None
    for order in range(top + 1):
        level = levels[top - order]
        context = F.shiftright("key", BITS)
        whole = Window.partitionBy(context)            # at most 257 rows
        seen = F.col("n") > 0
        if order == 0:
            rows = level.withColumns({"p_n": F.lit(0), "p_total": F.lit(0), "p_kinds": F.lit(0),
                                      "p_open": F.lit(0.0), "p_left": F.lit(0.0)})
        else:
            mask = (1 << (BITS * order)) - 1
            rows = level.withColumn("suffix", F.col("key").bitwiseAND(mask)).join(
                below.select(F.col("key").alias("suffix"), F.col("n").alias("p_n"),
                             F.col("total").alias("p_total"), F.col("kinds").alias("p_kinds"),
                             F.col("open").alias("p_open"), F.col("left").alias("p_left")),
                "suffix")
        rows = rows.withColumns({
            "total": F.sum("n").over(whole),
            "kinds": F.sum(seen.cast("long")).over(whole),
            "hidden": F.sum(F.when(seen, F.col("p_n")).otherwise(0)).over(whole)})
        # After an escape: counts and kinds that the suffix has beyond this context.
        rest, more = F.col("p_total") - F.col("hidden"), F.col("p_kinds") - F.col("kinds")
        if order == 0:
            left = -F.log10(F.lit(float(SYMBOLS)) - F.col("kinds"))
            left = F.when(F.col("kinds") >= SYMBOLS, F.lit(0.0)).otherwise(left)
            unseen = F.lit(-float(np.log10(SYMBOLS)))
        else:
            left = F.when(rest + more <= 0, F.col("p_left")) \
                .when(F.col("p_n") > 0, F.log10(F.col("p_n") / (rest + more))) \
                .otherwise(F.log10(more / (rest + more)) + F.col("p_left"))
            unseen = F.col("p_open")
        rows = rows.withColumn("left", left)
        size = F.col("total") + F.col("kinds")
        opened = F.when(F.col("total") == 0, unseen) \
            .when(seen, F.log10(F.col("n") / size)) \
            .otherwise(F.log10(F.col("kinds") / size) + F.col("left"))
        below = rows.select("key", "n", "total", "kinds", opened.alias("open"), "left")
        below = stored(below, f"lengths-{order}")
    return below


class _Lookup:
    """Values of sorted keys: a direct table of key hashes, and binary search
    for the keys that another one displaced there."""

    def __init__(self, keys: np.ndarray, *columns: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.columns = keys[order], [c[order] for c in columns]
        bits = max(10, int(len(keys)).bit_length() + 2)
        self.shift = _U(64 - bits)
        self.slot = np.zeros(1 << bits, dtype=np.int32)
        self.slot[self._hash(self.keys)] = np.arange(len(keys), dtype=np.int32)

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(_U) * _U(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def at(self, keys: np.ndarray) -> np.ndarray:
        found = self.slot[self._hash(keys)]
        wrong = np.flatnonzero(self.keys[found] != keys)
        found[wrong] = np.searchsorted(self.keys, keys[wrong])
        return found


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _score_chunk(docs: pa.Table, values: pa.Table, ranges: int, ends: int, size: float) -> pa.Table:
    """``ends``: training count of the end token; ``size``: N + 0.1 * (V + 1)."""
    of = values["range"].to_numpy()

    def whole(column: str, chosen: np.ndarray, read) -> np.ndarray:
        blocks = values[column].filter(pa.array(chosen))
        return np.concatenate([read(_pack(np.zeros(0))), *(read(b.as_py()) for b in blocks)])

    def floats(block: bytes) -> np.ndarray:
        return _unpack(block, np.float64)

    grams = _Lookup(whole("keys", of < ranges, _unpack_keys), whole("value", of < ranges, floats))
    count = whole("value", of >= ranges, floats)
    words = _Lookup(whole("keys", of >= ranges, _unpack_keys), np.log10((count + 0.1) / size),
                    (count > 0).astype(float))
    end_value, end_known = float(np.log10((ends + 0.1) / size)), int(ends > 0)
    out = []
    for batch in text_slices(docs.to_batches(), max_bytes=SLICE_BYTES):
        buf, offsets = text_buffer(batch.column("text"))
        keys, bounds = word_keys(buf, offsets)
        at = words.at(keys)
        n = np.diff(bounds)
        base = _sums(words.columns[0][at], bounds) + end_value
        n_known = _sums(words.columns[1][at], bounds).astype(np.int64) + end_known
        keys, bounds = symbol_keys(buf, offsets)
        score = np.add.reduceat(grams.columns[0][grams.at(keys)], bounds[:-1])
        out.append(pa.RecordBatch.from_arrays([
            batch.column("doc_id"), batch.column("train"), pa.array(n + 1),
            pa.array(n_known), pa.array(base), pa.array(score)],
            names=["doc_id", "train", "n_tokens", "n_known", "base_score", "score"]))
    return pa.Table.from_batches(out)


def _dealt(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """``docs`` with a chunk number, stored with the rows of a chunk together."""
    size = docs.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    chunks = max(1, -(-int(size) // chunk_bytes))
    row = F.xxhash64("doc_id", "text", F.monotonically_increasing_id())
    dealt = docs.withColumn("chunk", F.pmod(row, F.lit(chunks)))
    files = min(chunks, MAX_FILES)
    dealt = dealt.repartitionById(files, (F.col("chunk") % files).cast("int"))
    return stored(dealt if files == chunks else dealt.sortWithinPartitions("chunk"), "dealt")


def ppm_scores(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES,
               ranges: int | None = None) -> tuple[DataFrame, int]:
    """(scores of every row of ``docs(doc_id, text, train)``, training tokens
    with ends). ``ranges``: by default by the size of all texts."""
    dealt = _dealt(docs, chunk_bytes)
    text_bytes, ends, chunks = dealt.agg(
        F.coalesce(F.sum(F.octet_length("text") + 8), F.lit(0)),
        F.count_if("train"), F.count_distinct("chunk")).first()
    if ranges is None:
        ranges = min(MAX_RANGES, max(MIN_RANGES, -(-int(text_bytes) // RANGE_BYTES)))
    ranges -= ranges % min(ranges, BUCKETS)             # whole parts a bucket
    parts = ranges // min(ranges, BUCKETS)
    needs = stored(dealt.mapInArrow(_chunk_blocks(ranges), BLOCKS), "blocks")

    counts = needs.filter(F.col("range") == LOW_RANGE).mapInArrow(_low_rows, "key bigint, n bigint") \
        .groupBy("key").agg(F.sum("n").alias("n"))
    low = code_lengths(stored(counts, f"order-{LOW}"))
    low = low.mapInArrow(_ranged_low(ranges, parts), "range int, key bigint, n bigint, total bigint, "
                         "kinds bigint, open double, left double")
    blocks = needs.filter(F.col("range") != LOW_RANGE)
    groups = max(1, -(-int(chunks) // GROUP))
    merged, many = blocks, groups
    while many > 1:
        merged = stored(merged.withColumn("part", F.pmod(F.xxhash64("chunk"), F.lit(many)))
                        .groupBy("range", "part").applyInArrow(_merge_group, BLOCKS), "merged")
        many = -(-many // GROUP) if many > GROUP else 1
    model = stored(merged.groupBy("range").cogroup(low.groupBy("range"))
                   .applyInArrow(_range_model(ranges), MODEL), "model")
    n, v = model.agg(F.coalesce(F.sum("total"), F.lit(0)) + F.lit(ends),
                     F.coalesce(F.sum("kinds"), F.lit(0)) + F.lit(int(ends > 0))).first()

    group = F.pmod(F.xxhash64("chunk"), F.lit(groups))
    per_group = model.select("range", "keys", "value", F.explode(
        F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint"))).alias("part"))
    values = blocks.withColumn("part", group).groupBy("range", "part").cogroup(
        per_group.groupBy("range", "part")).applyInArrow(_served, VALUES)
    size = float(n + 0.1 * (v + 1))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        return _score_chunk(left, right, ranges, ends, size)

    scored = dealt.groupBy("chunk").cogroup(values.groupBy("chunk")).applyInArrow(score, SCORES)
    return scored, int(n)


def op7_ppm(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    out, n = ppm_scores(rows.withColumn("train", ~held_out(F.col("doc_id"), FOLDS)))
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
                      F.lit(n).cast("bigint").alias("train_tokens"), "base_score", "score")
