"""Language spans and language of a document (operator 6).

Script ranges narrow the candidates of every word to the languages that were
seen in that script; per-word scores are log-probabilities of the word's byte
n-grams (bounded by hashing) and of the word itself under each language; a
Viterbi pass with a penalty for switching labels spans of mixed-language text.
The document's language is the one with most letters-bearing words' bytes in
its spans, its score their share.

Learning: per language a bounded sample of labelled rows (``SAMPLE_PER_LANG``,
chosen by a hash of the id) is counted by Spark; hashed counts, whose number
is bounded by features x languages, become one small matrix that the scoring
tasks carry.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
with nothing to learn from every text is ``und``; words in a script unseen in
learning keep all candidates; equal scores go to the language that sorts
first; repeated rows are labelled each on its own; rows with a null id are
never learned from nor held out; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nbsieve.llm.common import (held_out, mix, prefix_hash, span_hash, text_buffer, text_slices,
                                word_spans)

FOLDS = 5
SAMPLE_PER_LANG = 5_000
GRAM_SIZES = (1, 2, 3, 4)
BUCKETS = 1 << 15            # hashed n-grams
WORD_BUCKETS = 1 << 15       # hashed whole words
SWITCH_PENALTY = 12.0        # nats for a change of language between two words
SMOOTHING = 0.5
SEEN_SHARE = 0.001           # of a language's words, for a script to count as seen

# First code points of blocks, and the script of each block
# (0: no letters of a script of its own).
SCRIPTS = ("common", "latin", "greek", "cyrillic", "armenian", "hebrew", "arabic", "indic",
           "thai_lao", "tibetan_myanmar", "georgian", "ethiopic", "khmer_mongolian", "kana",
           "han", "hangul")
RANGES = ((0x00, 0), (0x41, 1), (0x5B, 0), (0x61, 1), (0x7B, 0), (0xAA, 1), (0xAB, 0), (0xBA, 1),
          (0xBB, 0), (0xC0, 1), (0xD7, 0), (0xD8, 1), (0xF7, 0), (0xF8, 1), (0x2B0, 0),
          (0x370, 2), (0x400, 3), (0x530, 4), (0x590, 5), (0x600, 6), (0x700, 0), (0x750, 6),
          (0x780, 0), (0x8A0, 6), (0x900, 7), (0xE00, 8), (0xF00, 9), (0x10A0, 10), (0x1100, 15),
          (0x1200, 11), (0x13A0, 0), (0x1780, 12), (0x18B0, 0), (0x1C80, 3), (0x1C90, 10),
          (0x1CC0, 0), (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x2C60, 1), (0x2C80, 0),
          (0x2DE0, 3), (0x2E00, 0), (0x2E80, 14), (0x3000, 0), (0x3005, 14), (0x3008, 0),
          (0x3040, 13), (0x3100, 0), (0x3130, 15), (0x3190, 0), (0x31F0, 13), (0x3200, 0),
          (0x3400, 14), (0x4DC0, 0), (0x4E00, 14), (0xA000, 0), (0xA640, 3), (0xA6A0, 0),
          (0xA720, 1), (0xA800, 0), (0xAC00, 15), (0xD7B0, 0), (0xF900, 14), (0xFB00, 1),
          (0xFB13, 4), (0xFB1D, 5), (0xFB50, 6), (0xFE00, 0), (0xFE70, 6), (0xFF00, 0),
          (0xFF21, 1), (0xFF3B, 0), (0xFF41, 1), (0xFF5B, 0), (0xFF66, 13), (0xFFA0, 15),
          (0xFFE0, 0), (0x20000, 14), (0x323B0, 0))
_FIRST = np.array([a for a, _ in RANGES])
_SCRIPT = np.array([s for _, s in RANGES], dtype=np.int8)

STRETCH = 1 << 20            # bytes hashed together

_U = np.uint64
UND = "und"


def _code_points(buf: np.ndarray) -> np.ndarray:
    """Code point at every byte that begins a character, 0 elsewhere."""
    b = np.concatenate([buf, np.zeros(3, np.uint8)]).astype(np.int32)
    x, b1, b2, b3 = b[:-3], b[1:-2] & 63, b[2:-1] & 63, b[3:] & 63
    return np.select(
        [x < 0x80, x < 0xC0, x < 0xE0, x < 0xF0],
        [x, np.zeros_like(x), ((x & 31) << 6) | b1, ((x & 15) << 12) | (b1 << 6) | b2],
        ((x & 7) << 18) | (b1 << 12) | (b2 << 6) | b3)


class Words:
    """Words of a slice, its distinct words, and their scripts and features."""

    def __init__(self, column: pa.Array, scripts: bool = True):
        text = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) \
            else column
        self.buf, self.offsets = text_buffer(pc.utf8_lower(text))
        self.starts, self.ends, self.bounds = word_spans(self.buf, self.offsets)
        n = len(self.starts)
        self.hash, script = np.zeros(n, dtype=_U), np.zeros(n, dtype=np.int8)
        at = 0
        while at < n:                                # stretches of bounded size
            past = max(at + 1, int(np.searchsorted(self.ends, self.starts[at] + STRETCH)))
            lo, hi = self.starts[at], self.ends[past - 1]
            sub, begin, end = self.buf[lo:hi], self.starts[at:past] - lo, self.ends[at:past] - lo
            self.hash[at:past] = span_hash(prefix_hash(sub), begin, end)
            if scripts:
                own = _SCRIPT[np.searchsorted(_FIRST, _code_points(sub), side="right") - 1]
                edges = np.stack([begin, end], axis=1).ravel()
                script[at:past] = np.maximum.reduceat(np.append(own, np.int8(0)), edges)[::2]
            at = past
        self.keys, self.first, self.code = np.unique(self.hash, return_index=True,
                                                     return_inverse=True)
        self.script = script[self.first]
        self.size = (self.ends - self.starts)[self.first]

    def features(self, grams: tuple[int, ...] = GRAM_SIZES, buckets: int = BUCKETS,
                 word_buckets: int = WORD_BUCKETS) -> tuple[np.ndarray, np.ndarray]:
        """(feature, distinct word) pairs of all distinct words: hashed n-grams
        of the word between two spaces, and the hashed word after them."""
        n = len(self.keys)
        sizes = self.size + 2
        ends = np.cumsum(sizes)
        begin = ends - sizes
        flat = np.full(int(ends[-1]) if n else 0, 32, dtype=np.uint8)
        word = np.repeat(np.arange(n, dtype=np.int32), sizes)
        at = np.arange(len(flat)) - begin[word]
        inner = (at > 0) & (at < sizes[word] - 1)
        flat[inner] = self.buf[(self.starts[self.first][word] + at - 1)[inner]]
        out_f, out_w = [], []
        gram = np.zeros(len(flat), dtype=_U)
        for size in range(1, max(grams) + 1):
            shifted = np.zeros(len(flat), dtype=_U)
            shifted[: len(flat) - size + 1] = flat[size - 1:]
            gram = gram * _U(256) + shifted
            if size in grams:
                ok = at + size <= sizes[word]
                h = mix(gram[ok] + _U(size * 0x9E3779B97F4A7C15 % 2 ** 64))
                out_f.append((h & _U(buckets - 1)).astype(np.int32))
                out_w.append(word[ok])
        out_f.append((self.keys & _U(word_buckets - 1)).astype(np.int32) + np.int32(buckets))
        out_w.append(np.arange(n, dtype=np.int32))
        return np.concatenate(out_f), np.concatenate(out_w)


N_FEATURES = BUCKETS + WORD_BUCKETS


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per slice and language: counts of features, and of words per script
    (numbered after the features)."""
    for batch in text_slices(batches, max_bytes=2 << 20):
        words = Words(batch.column("text"))
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        doc = np.repeat(np.arange(len(langs)), np.diff(words.bounds))
        feature, word = words.features()
        for lang in sorted(set(langs)):
            mine = words.code[(langs == lang)[doc]]
            times = np.bincount(mine, minlength=len(words.keys))
            counts = np.bincount(feature, weights=times[word], minlength=N_FEATURES)
            scripts = np.bincount(words.script, weights=times, minlength=len(SCRIPTS))
            both = np.concatenate([counts, scripts])
            at = np.flatnonzero(both)
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                pa.array(both[at].astype(np.int64))], names=["lang", "feature", "n"])


class Model:
    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        grams, words = counts[:, :BUCKETS], counts[:, BUCKETS:N_FEATURES]
        self.logp = np.concatenate([self._logs(grams), self._logs(words)], axis=1) \
            .T.astype(np.float32).copy()
        scripts = counts[:, N_FEATURES:]
        seen = scripts >= SEEN_SHARE * scripts.sum(axis=1, keepdims=True).clip(1)
        seen &= scripts > 0
        self.blocked = (~seen).T & seen.any(axis=0)[:, None]
        self.blocked[0] = False

    @staticmethod
    def _logs(x: np.ndarray) -> np.ndarray:
        return np.log((x + SMOOTHING) / (x.sum(axis=1, keepdims=True) + SMOOTHING * x.shape[1]))

    def word_scores(self, words: Words) -> np.ndarray:
        """(distinct words, languages), 0 at each word's best; words without a
        letter favour none."""
        feature, word = words.features()
        out = np.empty((len(words.keys), len(self.langs)), dtype=np.float64)
        for k in range(len(self.langs)):
            out[:, k] = np.bincount(word, weights=self.logp[feature, k], minlength=len(out))
        out[self.blocked[words.script]] -= 1e4
        out -= out.max(axis=1, keepdims=True)
        out[words.script == 0] = 0.0
        return out


def learn(rows: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> Model | None:
    """Model from ``rows(doc_id, text, lang)``, all of which may be learned
    from. One count per language, and at most features x languages counts,
    come to the driver."""
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    # Of 2**62 hash values as many as leave ``per_lang`` rows: some, for any count.
    limits = rows.sparkSession.createDataFrame(
        [(lang, min(1 << 62, (per_lang << 62) // n)) for lang, n in sizes.items()],
        "lang string, below bigint")               # one row per language
    drawn = F.call_function("shiftrightunsigned", F.xxhash64("doc_id", F.lit("sample")), F.lit(2))
    sample = rows.join(F.broadcast(limits), "lang").filter(drawn < F.col("below"))
    found = sample.select("text", "lang").mapInArrow(
        _count_batches, "lang string, feature int, n bigint") \
        .groupBy("lang", "feature").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(found["lang"].to_pylist()))
    if not langs:
        return None
    counts = np.zeros((len(langs), N_FEATURES + len(SCRIPTS)))
    row = np.searchsorted(langs, found["lang"].to_pylist())
    counts[row, found["feature"].to_numpy()] = found["n"].to_numpy()
    return Model(langs, counts)


def viterbi(scores: np.ndarray, code: np.ndarray, bounds: np.ndarray,
            penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """Best language of every word, all documents of a slice in step: longest
    first, so the documents that still have words are always the first rows."""
    n = np.diff(bounds)
    order = np.argsort(-n, kind="stable")
    n, begin = n[order], bounds[:-1][order]
    steps = int(n[0]) if len(n) else 0
    active = len(n) - np.searchsorted(n[::-1], np.arange(steps), side="right")
    path = np.zeros(len(code), dtype=np.int16)
    best_from = np.zeros(len(code), dtype=np.int16)      # language to switch from
    switched = np.zeros((len(code), scores.shape[1]), dtype=bool)
    v = np.zeros((len(n), scores.shape[1]))
    for t in range(steps):
        k = active[t]
        at = begin[:k] + t
        if t:
            top = v[:k].argmax(axis=1)
            jump = v[np.arange(k), top][:, None] - penalty
            sw = v[:k] < jump
            best_from[at], switched[at] = top, sw
            v[:k] = np.where(sw, jump, v[:k])
        v[:k] += scores[code[at]]
    last = v.argmax(axis=1)
    state = last.copy()
    for t in range(steps - 1, -1, -1):
        k = active[t]
        at = begin[:k] + t
        path[at] = state[:k]
        if t:
            sw = switched[at, state[:k]]
            state[:k] = np.where(sw, best_from[at], state[:k])
    return path


def language_spans(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score, spans) of ``docs(doc_id, text)``; spans:
    array of (begin, end, lang), bytes of the lower-cased text."""
    schema = ("doc_id bigint, lang_pred string, score double, "
              "spans array<struct<begin:bigint,end:bigint,lang:string>>")
    if model is None:
        return docs.select("doc_id", F.lit(UND).alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.expr("cast(array() AS array<struct<begin:bigint,end:bigint,"
                                  "lang:string>>)").alias("spans"))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(model.langs, dtype=object)
        many = len(names)
        for batch in text_slices(batches, max_bytes=2 << 20):
            words = Words(batch.column("text"))
            docs_n = batch.num_rows
            doc = np.repeat(np.arange(docs_n), np.diff(words.bounds))
            path = viterbi(model.word_scores(words), words.code, words.bounds)
            size = (words.ends - words.starts) * (words.script[words.code] > 0)
            mass = np.bincount(doc * many + path, weights=size,
                               minlength=docs_n * many).reshape(docs_n, many)
            total = mass.sum(axis=1)
            best = mass.argmax(axis=1)
            new = np.ones(len(path), dtype=bool)
            new[1:] = (path[1:] != path[:-1]) | (doc[1:] != doc[:-1])
            first = np.flatnonzero(new)
            past = np.append(first[1:], len(path)) - 1 if len(first) else first
            span = pa.StructArray.from_arrays(
                [pa.array(words.starts[first] - words.offsets[doc[first]]),
                 pa.array(words.ends[past] - words.offsets[doc[first]]),
                 pa.array(names[path[first]], pa.string())], names=["begin", "end", "lang"])
            per_doc = np.concatenate([[0], np.cumsum(np.bincount(doc[first], minlength=docs_n))])
            known = total > 0
            if not known.all():
                known |= _other_letters(batch.column("text"), known)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"),
                pa.array(np.where(known, names[best], UND), pa.string()),
                pa.array(np.where(total > 0, mass[np.arange(docs_n), best] / np.maximum(total, 1),
                                  0.0)),
                pa.ListArray.from_arrays(pa.array(per_doc.astype(np.int32)), span)],
                names=["doc_id", "lang_pred", "score", "spans"])

    return docs.mapInArrow(label, schema)


def _other_letters(column: pa.Array, known: np.ndarray) -> np.ndarray:
    """Texts without a word of a listed script that still hold a letter."""
    out = np.zeros(len(known), dtype=bool)
    for i in np.flatnonzero(~known).tolist():
        text = column[i].as_py()
        out[i] = text is not None and any(c.isalpha() for c in text)
    return out


def op6_language_id(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.col("text").cast("string").alias("text"), "lang")
    held = held_out(F.col("doc_id"), FOLDS)
    model = learn(rows.filter(~held))
    out = language_spans(rows.select("doc_id", "text"), model)
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")
