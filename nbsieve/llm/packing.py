"""Best-fit packing with certified bin counts (operator 8).

Documents become token pieces of at most 2048 ids (only longer documents are
cut); pieces go to hash partitions of bounded size, and each partition runs
best-fit decreasing. Lower bounds from dual feasible functions certify bin
counts: the packing is final when the bins are as many as the bound of all
pieces together. Until then the partitions exchange documents: badly filled
bins (a certified partition's last one too, which others may fill) are dealt,
whole, to new partitions, fewer and fuller ones each round. A partition that its
bound does not certify runs best-fit decreasing again and keeps its own gain:
where that does not need fewer bins, the old bins stay. Rounds end at the
certificate, when one partition holds all open bins, or when partitions of the
largest size gain nothing more.

Tokens: white space never lies inside a pre-token, so a text's ids are the
ids of its ASCII-white-space-separated words one after the other; each worker
encodes a distinct word once (a bounded memory of words, emptied when full).

Defined cases: null and empty texts are the one id 0; repeated rows and ids
are packed each on its own; null ids are carried; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nbsieve.llm.common import released, stored, text_buffer, text_slices, word_bounds

TOKENIZER = "word_bpe_49k.json"
CAPACITY = 2048
END_ID = 0
GROUP_PIECES = 50_000       # pieces in one packing partition
OPEN_WASTE = 16             # unused tokens from which a bin is opened again
LARGEST = 16                # times GROUP_PIECES that one partition may grow to
EXCHANGE = True
WORD_BYTES = 96 << 20       # of distinct words that a worker remembers, between tasks too

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PACKED = ("row bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
          "sequence_id bigint, offset bigint, open boolean")


# A word of these letters before any of these marks is two pre-tokens whatever
# stands around it, and its letters need no normalising but lower case.
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_MARKS = b"-.,;:!?*#$%&|\"()"
_CORE = re.compile(f"[{_LATIN}]+")


def _byte_alphabet() -> dict[int, str]:
    """Printable stand-ins of byte-level vocabularies: bytes that print as
    they are stand for themselves, the others for U+0100 and after."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = (b for b in range(256) if b not in own)
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


WORD_OBJECTS = 200          # bytes of a word's entries in both memories, its own aside


class _Codes(dict):
    """Word to code; a word not known yet is encoded when it is looked up."""

    def __init__(self, encode):
        self.encode = encode
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.new.append(self.encode(word))
        code = self[word] = len(self) + 1                    # 0: the end id
        return code


class WordIds:
    """Ids of texts, by way of their distinct words. Plain words go straight
    to the tokenizer's merges, all others through the whole tokenizer."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.alphabet = _byte_alphabet()
        self.marks: dict[bytes, bytes] = {}
        self.cores: dict[bytes, bytes] = {}
        self.clear()

    def clear(self) -> None:
        self.codes = _Codes(self._ids)
        self.cores.clear()
        self.held = 0
        self.flat = np.array([END_ID], dtype=np.uint32)      # code 0: the end id
        self.starts = np.array([0], dtype=np.int64)
        self.sizes = np.array([1], dtype=np.int64)

    def _whole(self, word: str) -> bytes:
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def _ids(self, word: bytes) -> bytes:
        """Ids as bytes: the memory then holds no objects to trace."""
        core = word.rstrip(_MARKS)
        if core.isalpha():                                   # ASCII letters
            core_ids = self.cores.get(key := core.lower())
            stand_in = None if core_ids is not None else key.decode()
        else:
            text = core.decode("utf-8", "replace")
            if _CORE.fullmatch(text) is None:
                return self._whole(word.decode("utf-8", "replace"))
            core_ids = self.cores.get(key := text.lower().encode())
            stand_in = None if core_ids is not None else \
                key.decode("latin-1").translate(self.alphabet)
        if core_ids is None:
            core_ids = self.cores[key] = array("I", [t.id for t in self.merge(stand_in)]).tobytes()
            self.held += len(key) + len(core_ids)
        if len(core) == len(word):
            return core_ids
        marks = word[len(core):]
        if marks not in self.marks:
            self.marks[marks] = self._whole(marks.decode())
        return core_ids + self.marks[marks]

    def _settle(self) -> None:
        """Append the ids of the words met since the last call."""
        new, self.codes.new = self.codes.new, []
        sizes = np.fromiter(map(len, new), dtype=np.int64, count=len(new)) // 4
        self.held += WORD_OBJECTS * len(new) + 8 * int(sizes.sum())
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(new), dtype=np.uint32)])

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, bounds): each text's ids, then the end id."""
        if self.held > WORD_BYTES:
            self.clear()
        bounds = word_bounds(buf, offsets)
        glue = np.insert(buf, offsets[1:-1], 32)             # texts stay apart
        words = glue.tobytes().split()                       # ASCII white space
        code = np.fromiter(map(self.codes.__getitem__, words), dtype=np.int64, count=len(words))
        self._settle()
        code = np.insert(code, bounds[1:], 0)
        sizes = self.sizes[code]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[code] - (ends - sizes), sizes) + np.arange(ends[-1])
        text_ends = bounds[1:] + np.arange(len(bounds) - 1)
        return self.flat[at], np.concatenate([[0], ends[text_ends]])


_MEMORY: dict[str, WordIds] = {}


def _encoder(path: str | None) -> WordIds:
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(TOKENIZER)
    if path not in _MEMORY:
        _MEMORY[path] = WordIds(path)
    return _MEMORY[path]


def token_pieces(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        for batch in text_slices(batches):
            buf, offsets = text_buffer(batch.column("text"))
            ids, bounds = encoder.encode(buf, offsets)
            data = ids.astype("<u4").tobytes()
            doc, piece, start, length, crc = [], [], [], [], []
            for d, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(),
                                             strict=True)):
                for k, at in enumerate(range(lo, hi, CAPACITY)):
                    end = min(at + CAPACITY, hi)
                    doc.append(d)
                    piece.append(k)
                    start.append(at - lo)
                    length.append(end - at)
                    crc.append(zlib.crc32(data[4 * at: 4 * end]))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(pa.array(doc, pa.int64())),
                pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
            ], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(released(cut), PIECES)


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY):
    """(bin, offset) of each piece: longest first, into the fullest bin that
    still takes it. Bins wait in one stack per free space; an integer's bits
    mark the stacks in use, so the best fit is its lowest set bit."""
    order = np.argsort(-lengths, kind="stable").tolist()
    size = lengths.tolist()
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    used, n = 0, 0
    bins, offsets = [0] * len(size), [0] * len(size)
    for i in order:
        length = size[i]
        fit = used >> length
        if fit:
            free = length + (fit & -fit).bit_length() - 1
            b = stacks[free].pop()
            if not stacks[free]:
                used &= ~(1 << free)
        else:
            b, free = n, capacity
            n += 1
        bins[i], offsets[i] = b, capacity - free
        left = free - length
        if left:
            stacks[left].append(b)
            used |= 1 << left
    return np.array(bins, dtype=np.int64), np.array(offsets, dtype=np.int64), n


def lower_bound(lengths: np.ndarray | None, capacity: int = CAPACITY,
                count: np.ndarray | None = None) -> int:
    """Largest bound of three families of dual feasible functions (each maps
    sizes so that whatever fits a bin still sums to at most one bin).
    ``count``: pieces by length, in place of the lengths."""
    if count is None:
        count = np.bincount(lengths, minlength=capacity + 1)
    count = count.astype(np.int64)
    if not count.any():
        return 0
    x = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((count * x).sum()) // capacity)
    mass = np.concatenate([[0], np.cumsum(count * x)])       # of sizes below i
    many = np.concatenate([[0], np.cumsum(count)])
    for e in range(1, capacity // 2 + 1):                    # drop < e, round up > C - e
        total = capacity * int(many[-1] - many[capacity - e + 1]) \
            + int(mass[capacity - e + 1] - mass[e])
        best = max(best, -(-total // capacity))
    for k in range(1, 65):                                   # round to k-ths
        y = (k + 1) * x
        value = np.where(y % capacity == 0, k * x, (y // capacity) * capacity)
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    for e in range(2, capacity // 2 + 1, 7):                 # large ones by what fits beside them
        parts = capacity // e
        value = np.where(2 * x > capacity, 2 * parts - 2 * ((capacity - x) // e),
                         np.where(2 * x == capacity, parts, np.where(x >= e, 2, 0)))
        best = max(best, -(-int((count * value).sum()) // (2 * parts)))
    return best


def _packed(pieces: DataFrame, round_no: int, group_pieces: int, n: int) -> DataFrame:
    """One round: ``pieces`` (n of them) dealt to partitions and packed. From
    the second round on whole bins are dealt, and a partition that does not
    need fewer of them leaves them as they are."""
    groups = max(1, -(-n // group_pieces))
    fields = ["row", "doc_id", "piece", "start", "length", "ids_crc32"]

    def pack(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches)).sort_by("row")
        lengths = t["length"].to_numpy()
        names, bins, offsets = (), None, None
        if round_no > 1:
            names, bins = np.unique(t["sequence_id"].to_numpy(), return_inverse=True)
            sequence, offsets, n_bins = names[bins], t["offset"].to_numpy(), len(names)
        if not len(names) or lower_bound(lengths) < n_bins:      # else certified as it is
            new, at, n = best_fit_decreasing(lengths)
            if not len(names) or n < n_bins:
                bins, offsets, n_bins = new, at, n
                sequence = (round_no << 56 | int(key[0].as_py()) << 24) + bins
        fill = np.bincount(bins, weights=lengths, minlength=n_bins)
        is_open = CAPACITY - fill >= OPEN_WASTE
        t = t.select(fields).append_column("sequence_id", pa.array(sequence))
        t = t.append_column("offset", pa.array(offsets))
        yield from t.append_column("open", pa.array(is_open[bins])).combine_chunks().to_batches()

    dealt = "row" if round_no == 1 else "sequence_id"
    part = F.pmod(F.xxhash64(dealt, F.lit(round_no)), F.lit(groups)).alias("part")
    more = [] if round_no == 1 else ["sequence_id", "offset"]
    return stored(pieces.select(*fields, *more, part).groupBy("part")
                  .applyInArrow(pack, PACKED), f"packed-{round_no}")


def _bound(pieces: DataFrame) -> int:
    """Certified number of bins of all pieces: lengths are at most 2048 values."""
    lengths = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    count = np.zeros(CAPACITY + 1, dtype=np.int64)
    for r in lengths:
        count[r["length"]] = r["n"]
    return lower_bound(None, count=count)


def pack(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every
    piece of ``docs``."""
    pieces = stored(token_pieces(docs, tokenizer_path)
                    .withColumn("row", F.monotonically_increasing_id()), "pieces")
    # Every bin has one piece at offset 0.
    bins = F.coalesce(F.sum((F.col("offset") == 0).cast("long")), F.lit(0))
    current = _packed(pieces, 1, GROUP_PIECES, pieces.count())
    settled, round_no, size, n_settled = [], 1, 1, 0
    bound = _bound(pieces) if EXCHANGE else 0
    while EXCHANGE:
        waiting = current.filter("open")
        n_open, open_bins = waiting.agg(F.count(F.lit(1)), bins).first()
        total = n_settled + current.agg(bins).first()[0]
        if total <= bound or open_bins < 2 or (round_no > 1 and last_groups == 1):
            break
        size = min(2 * size, LARGEST)
        last_groups = max(1, -(-n_open // (size * GROUP_PIECES)))
        again = _packed(waiting, round_no + 1, size * GROUP_PIECES, n_open)
        settled.append(current.filter("NOT open"))
        n_settled = total - open_bins
        gained = open_bins - again.agg(bins).first()[0]
        current, round_no = again, round_no + 1
        if size == LARGEST and not gained:
            break
    out = current
    for s in settled:
        out = out.unionByName(s)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op8_packing(docs: DataFrame) -> DataFrame:
    return pack(docs)
