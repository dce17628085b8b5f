"""Removal of repeated byte strings by a sampled suffix array (operator 2).

Every byte covered by a 200-byte string that also starts anywhere else (in
any document, or elsewhere in its own) is removed; strings are judged on the
input. Sorting all suffixes of a corpus moves every byte many times, so the
suffix array is sampled without losing a match:

1. Each 200-byte window has an anchor: the 32-byte gram of least hash in it,
   leftmost on ties. Equal windows have equal anchors at equal places, so
   windows need comparing only with windows of the same anchor gram. Runs of
   windows that share an anchor (about 85) are one row, with hashes of the
   gram and of the run's whole text.
2. Anchors whose gram occurs once in the corpus can hold no repeat and go.
   Anchors all of whose runs have the same text repeat in every window.
3. Only anchors with several texts need looking at: their runs are read, equal
   texts collapse to one row with a count before they are gathered.
4. The suffixes from the anchors, and the reversed prefixes before them, are
   sorted by deep-shallow sorting (multikey quicksort, then blind tries; see
   ``suffix_sort``). In these two orders, strings that agree in their first d
   bytes are neighbours whose common prefixes stay at d or above, so windows
   starting o bytes before the anchor are equal exactly where both the runs at
   depth o (left) and 200 - o (right) are the same.
5. Repeated windows return to their documents as byte spans; spans are merged
   and cut out.

An anchor whose distinct texts exceed ``HOT_TEXTS`` is not gathered: its
windows are counted by their 128-bit hashes instead, spread over all tasks.

Defined cases: null and empty texts, and texts under 200 bytes, lose nothing;
a repeated row repeats every window of its text; null ids are carried; an
empty table gives no rows. Long texts are cut into overlapping segments, so
memory does not grow with the length of a text by more than the text itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nbsieve.llm.common import (mix, prefix_hash, released, span_hash, stored, text_buffer,
                                text_slices)
from nbsieve.llm.suffix_sort import deep_shallow

WINDOW = 200
GRAM = 32
SEGMENT = 1 << 20          # window starts looked at together
GROUP_TEXTS = 30_000       # distinct texts sorted together
HOT_TEXTS = 20_000         # of one anchor
SEEN = 200_000             # texts a task remembers to have sent
BROADCAST_ROWS = 2_000_000 # row ids broadcast to a scan; beyond it, a shuffled join

_U = np.uint64

# ``pos`` packs the first window's start, the bytes from there to the anchor,
# and the number of windows (the last two below 256).
ANCHORS = "gram bigint, body bigint, row bigint, pos bigint"
TEXTS = "gram bigint, body bigint, row bigint, pos bigint, text binary"


def anchors(buf: np.ndarray, offsets: np.ndarray):
    """Runs of windows with one anchor: (gram hash, text hash, first window
    start, bytes from there to the anchor, windows), over the whole buffer."""
    opens = np.zeros(len(buf) + 1, dtype=np.int64)   # windows stay in a document
    long_enough = np.diff(offsets) >= WINDOW
    np.add.at(opens, offsets[:-1][long_enough], 1)
    np.add.at(opens, offsets[1:][long_enough] - WINDOW + 1, -1)
    valid_all = np.cumsum(opens[:-1]) > 0
    out = []
    low = _U((1 << 21) - 1)
    span = WINDOW - GRAM + 1
    for seg in range(0, len(buf), SEGMENT):
        sub = buf[seg: seg + SEGMENT + WINDOW - 1]
        if len(sub) < WINDOW:
            break
        starts = np.arange(len(sub) - GRAM + 1)
        prefix = prefix_hash(sub)
        gram = span_hash(prefix, starts, starts + GRAM)
        best = (gram & ~low) | starts.astype(_U)
        width = 1
        while 2 * width <= span:
            best = np.minimum(best[:-width], best[width:])
            width *= 2
        if span > width:
            best = np.minimum(best[: width - span], best[span - width:])
        anchor = (best & low).astype(np.int64)
        valid = valid_all[seg: seg + len(anchor)]
        new = valid.copy()
        new[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
        last = valid.copy()
        last[:-1] &= ~valid[1:] | (anchor[1:] != anchor[:-1])
        lo, hi = np.flatnonzero(new), np.flatnonzero(last)
        left = anchor[lo] - lo
        body = mix(span_hash(prefix, lo, hi + WINDOW) + left.astype(_U))
        out.append((gram[anchor[lo]], body, lo + seg, left, hi - lo + 1))
    if not out:
        return tuple(np.zeros(0, t) for t in (_U, _U, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


@released
def _anchor_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        buf, offsets = text_buffer(batch.column("text"))
        gram, body, at, left, n = anchors(buf, offsets)
        if not len(at):
            continue
        doc = np.searchsorted(offsets, at, side="right") - 1
        yield pa.RecordBatch.from_arrays([
            pa.array(gram.view(np.int64)), pa.array(body.view(np.int64)),
            pa.array(batch.column("row").to_numpy()[doc]),
            pa.array(((at - offsets[doc]) << 16) | (left << 8) | n)],
            names=["gram", "body", "row", "pos"])


def _at(pos: Column) -> Column:
    return F.shiftright(pos, 16)


@released
def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Text of each run, sent once per task for equal (gram, text)."""
    seen: set[tuple[int, int]] = set()
    for batch in text_slices(batches, max_bytes=1 << 20):
        buf, offsets = text_buffer(batch.column("text"))
        raw, runs = buf.tobytes(), batch.column("runs")
        runs = runs if runs.offset == 0 else pa.concat_arrays([runs])
        flat = runs.flatten()
        gram, body, pos = (flat.field(c).to_numpy() for c in ("gram", "body", "pos"))
        doc = np.repeat(np.arange(len(runs)), runs.value_lengths().to_numpy())
        begin = offsets[doc] + (pos >> 16)
        texts = []
        for b, e, key in zip(begin.tolist(), (begin + (pos & 255) + WINDOW - 1).tolist(),
                             zip(gram.tolist(), body.tolist(), strict=True), strict=True):
            if key in seen:
                texts.append(None)
                continue
            texts.append(raw[b:e])
            if len(seen) >= SEEN:
                seen.clear()
            seen.add(key)
        yield pa.RecordBatch.from_arrays([
            pa.array(gram), pa.array(body), pa.array(batch.column("row").to_numpy()[doc]),
            pa.array(pos), pa.array(texts, pa.binary())],
            names=["gram", "body", "row", "pos", "text"])


def repeated_windows(bodies: list[bytes], gram: np.ndarray, left: np.ndarray, n: np.ndarray,
                     copies: np.ndarray) -> np.ndarray:
    """(len(bodies), windows) booleans: window k of body i occurs elsewhere,
    among the bodies of the same gram, of which there are ``copies`` each."""
    m = len(bodies)
    group = np.unique(gram, return_inverse=True)[1]
    cut = left.tolist()
    orders = [deep_shallow([b[c:] for b, c in zip(bodies, cut, strict=True)], group),
              deep_shallow([b[:c][::-1] for b, c in zip(bodies, cut, strict=True)], group)]
    head = [np.concatenate([[True], group[o][1:] != group[o][:-1]]) for o, _ in orders]
    hit = np.zeros((m, WINDOW - GRAM + 1), dtype=bool)
    run = np.empty((2, m), dtype=np.int64)
    for o in range(WINDOW - GRAM + 1):               # bytes from window start to anchor
        rows = np.flatnonzero((o <= left) & (o > left - n))
        if not len(rows):
            continue
        for side, depth in ((0, WINDOW - o), (1, o)):
            order, lcp = orders[side]
            run[side, order] = np.cumsum(head[side] | (lcp < depth))
        same = np.unique(run[0, rows] * (m + 1) + run[1, rows], return_inverse=True)[1]
        often = np.bincount(same, weights=copies[rows]) > 1
        hit[rows, (left[rows] - o)] = often[same]
    return hit


def _runs_of(hit: np.ndarray):
    """(row, first, past last) of the runs of true in each row."""
    edge = np.diff(np.pad(hit.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, first = np.nonzero(edge == 1)
    return row, first, np.nonzero(edge == -1)[1]


@released
def _sorted_group(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    t = pa.Table.from_batches(list(batches))
    gram, body, pos, copies = (t[c].to_numpy() for c in ("gram", "body", "pos", "copies"))
    hit = repeated_windows(t["text"].to_pylist(), gram, (pos >> 8) & 255, pos & 255, copies)
    row, first, past = _runs_of(hit)
    yield pa.RecordBatch.from_arrays([
        pa.array(gram[row]), pa.array(body[row]), pa.array(first.astype(np.int32)),
        pa.array((past + WINDOW - 1).astype(np.int32))], names=["gram", "body", "b", "e"])


def _hot_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for gram, body, pos, copies, text in zip(*(batch.column(c).to_pylist() for c in (
                "gram", "body", "pos", "copies", "text")), strict=True):
            for k in range(pos & 255):
                d = hashlib.blake2b(text[k: k + WINDOW], digest_size=16).digest()
                rows.append((int.from_bytes(d[:8], "little", signed=True),
                             int.from_bytes(d[8:], "little", signed=True), k, copies, gram, body))
        columns = list(zip(*rows, strict=True)) or [()] * 6
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int64(),
                                                      pa.int64(), pa.int64()), strict=True)],
            names=["w1", "w2", "k", "copies", "gram", "body"])


def _hot_spans(texts: DataFrame) -> DataFrame:
    """(gram, body, b, e) of the repeated windows of hot anchors, one by one."""
    w = stored(texts.mapInArrow(
        _hot_windows, "w1 bigint, w2 bigint, k int, copies bigint, gram bigint, body bigint"),
        "hot-windows")
    often = w.groupBy("w1", "w2").agg(F.sum("copies").alias("c")).filter("c > 1")
    return w.join(often, ["w1", "w2"]).select(
        "gram", "body", F.col("k").alias("b"), (F.col("k") + WINDOW).alias("e"))


def _rows_in(base: DataFrame, rows: DataFrame, how: str = "left_semi") -> DataFrame:
    """``base`` restricted to the row ids of a stored table, before any
    shuffle where they are few enough to broadcast."""
    ids = rows.select("row")
    return base.join(F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids, "row", how)


def repeated_spans(base: DataFrame, hot_texts: int = HOT_TEXTS) -> DataFrame:
    """(row, spans): for rows of ``base(row, text)`` that repeat something, the
    byte spans [b, e) covered by repeated windows, sorted by b, maybe
    overlapping."""
    runs = stored(base.mapInArrow(_anchor_batches, ANCHORS), "anchors")
    # Stored first: two stored sides are a join whose hot keys can be split.
    again = stored(runs.groupBy("gram").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
                   .select("gram"), "anchors-again")
    twice = stored(runs.join(again, "gram", "left_semi"), "repeated-anchors")
    grams = stored(twice.groupBy("gram").agg(F.min("body").alias("b0"), F.max("body").alias("b1"))
                   .select("gram", (F.col("b0") != F.col("b1")).alias("several")), "grams")

    # One text, many times: every window repeats, no text is needed.
    length = F.col("pos").bitwiseAND(255) + (WINDOW - 1)
    plain = twice.join(grams.filter("NOT several"), "gram", "left_semi").select(
        "row", F.struct(_at(F.col("pos")).alias("b"), (_at(F.col("pos")) + length).alias("e"))
        .alias("span"))

    # Several texts: sort them.
    by_row = stored(twice.join(grams.filter("several"), "gram", "left_semi").groupBy("row").agg(
        F.collect_list(F.struct("gram", "body", "pos")).alias("runs")), "runs-by-row")
    texts = stored(_rows_in(base, by_row).join(by_row, "row").mapInArrow(_text_batches, TEXTS),
                   "anchor-texts")
    unique = stored(texts.groupBy("gram", "body").agg(
        F.count(F.lit(1)).alias("copies"), F.first("pos").alias("pos"),
        F.first("text", ignorenulls=True).alias("text")), "unique-texts")
    per_gram = unique.groupBy("gram").agg(F.count(F.lit(1)).alias("c"))
    hot = stored(per_gram.filter(F.col("c") > hot_texts).select("gram"), "hot-grams")
    parts = max(1, -(-unique.count() // GROUP_TEXTS))
    part = F.pmod(F.xxhash64("gram"), F.lit(parts)).alias("part")
    spans = unique.join(hot, "gram", "left_anti").select("*", part).groupBy("part") \
        .applyInArrow(_sorted_group, "gram bigint, body bigint, b int, e int")
    if not hot.isEmpty():
        spans = spans.unionByName(_hot_spans(unique.join(hot, "gram", "left_semi")))
    found = texts.select("gram", "body", "row", "pos").join(spans, ["gram", "body"]).select(
        "row", F.struct((_at(F.col("pos")) + F.col("b")).alias("b"),
                        (_at(F.col("pos")) + F.col("e")).alias("e")).alias("span"))
    return stored(plain.unionByName(found).groupBy("row").agg(
        F.sort_array(F.collect_list("span")).alias("spans")), "row-spans")


def merged(begin: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs covered by spans sorted by begin."""
    if not len(begin):
        return []
    reach = np.maximum.accumulate(end)
    new = np.concatenate([[True], begin[1:] > reach[:-1]])
    past = np.concatenate([np.flatnonzero(new)[1:], [len(begin)]]) - 1
    return list(zip(begin[new].tolist(), reach[past].tolist(), strict=True))


@released
def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        buf, offsets = text_buffer(batch.column("text"))
        raw, spans = buf.tobytes(), batch.column("spans")
        out = []
        for i in range(batch.num_rows):
            text = raw[offsets[i]: offsets[i + 1]]
            s = spans[i].values
            found = merged(s.field("b").to_numpy(), s.field("e").to_numpy())
            kept, at = [], 0
            for b, e in found:
                kept.append(text[at:b])
                at = e
            kept.append(text[at:])
            out.append((len(text), sum(e - b for b, e in found), len(found), b"".join(kept)))
        yield pa.RecordBatch.from_arrays([
            batch.column("doc"), pa.array([x[0] for x in out], pa.int64()),
            pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.int64()),
            pa.array([x[3] for x in out], pa.binary())],
            names=["doc", "n_bytes", "n_removed", "n_spans", "kept"])


def cut_repeats(docs: DataFrame, hot_texts: int = HOT_TEXTS) -> DataFrame:
    """(doc, n_bytes, n_removed, n_spans, kept): the row's other columns as a
    struct, the counts, and the remaining bytes (null where the text was null).
    Rows without a repeat are not shuffled and never enter Python again."""
    other = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    base = stored(docs.select(other.alias("doc"), F.col("text").cast("string").alias("text"),
                              F.monotonically_increasing_id().alias("row")), "rows")
    spans = repeated_spans(base.select("row", "text"), hot_texts)
    doc_type = base.schema["doc"].dataType.simpleString()
    cut = _rows_in(base, spans).join(spans, "row").select("doc", "text", "spans").mapInArrow(
        _cut_batches, f"doc {doc_type}, n_bytes bigint, n_removed bigint, n_spans bigint, "
                      "kept binary")
    none = F.lit(0).cast("bigint")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    untouched = _rows_in(base, spans, "left_anti").select(
        "doc", size.alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"),
        F.col("text").cast("binary").alias("kept"))
    return untouched.unionByName(cut)


def op2_suffix_dedup(docs: DataFrame) -> DataFrame:
    out = cut_repeats(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    return out.select("doc.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2(
        F.coalesce("kept", F.lit("").cast("binary")), 256).alias("kept_sha256"))


def _whole_characters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = [b.decode("utf-8", "ignore") for b in batch.column("kept").to_pylist()]
        yield batch.drop_columns(["kept"]).append_column("kept", pa.array(text, pa.string()))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text`` (characters cut in
    two are dropped) and ``n_chars`` counted anew; other columns as they were."""
    out = cut_repeats(docs).select("doc", "n_removed", "kept")
    doc_type = out.schema["doc"].dataType.simpleString()
    changed = out.filter("n_removed > 0").select("doc", "kept").mapInArrow(
        _whole_characters, f"doc {doc_type}, kept string")
    same = out.filter("n_removed = 0").select("doc", F.col("kept").cast("string").alias("kept"))

    def columns(df: DataFrame, new: dict) -> DataFrame:
        return df.select(*[new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])

    text = {"text": F.col("kept")}
    return columns(same, text).unionByName(
        columns(changed, text | {"n_chars": F.char_length("kept").cast("bigint")}))
