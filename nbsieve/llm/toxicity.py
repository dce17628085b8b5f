"""Toxicity by a bidirectional gated recurrent network (operator 3).

A word enters as its own (hashed) embedding beside the mean embedding of its
character n-grams. Two gated recurrent passes read a window of 32 words in
either direction, attention pools their states, and a logistic unit scores the
window. All windows of a text, half overlapping, are scored; the text's score
is that of its highest window, calibrated.

Training is plain numpy on a bounded sample of labelled documents
(``MAX_POSITIVE``, ``MAX_NEGATIVE``, drawn from the rows found in the table).
Longer texts than ``MAX_BYTES`` join it only where a class has too few shorter
ones, with an excerpt of that size from a random place. Labels belong to
documents, not windows, so after a first round over random windows a toxic
document trains with its highest windows, a clean one with its highest and some
random ones. A fifth of the sample is kept from the network and sets the offset
of the score, so that 0.5 separates the classes; up to ``LONG_EACH`` long texts
of either class, scored whole where they lie, take part in that.

Defined cases: texts without words (null, empty) score 0; with no labelled
rows of both classes all score 0; repeated rows are scored each on its own;
null labels and ids are never learned from; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nbsieve.llm.common import held_out, stored, text_slices
from nbsieve.llm.langid import Words

FOLDS = 5
MAX_POSITIVE, MAX_NEGATIVE = 1_200, 2_400
MAX_BYTES = 32_768           # of a document in the sample
LONG_EACH = 200              # longer texts of a class that help to set the cut
GRAMS = (3, 4, 5)            # characters (bytes) of an n-gram
BUCKETS, WORD_BUCKETS = 1 << 17, 1 << 17
N_FEATURES = BUCKETS + WORD_BUCKETS
LENGTH, STRIDE = 32, 16      # words in a window, and between window starts
EMBED, HIDDEN = 8, 12        # each of word and characters; each direction
EPOCHS, BATCH, RATE, EMBED_RATE = 4, 256, 0.01, 0.002
OFTEN = 20                   # training documents, for a feature's embedding to be learned
PAD_GATE = 30.0              # keeps the state where a short window is padded


def windows(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word, words) of every window; the last one of a text
    ends with it, and texts shorter than a window have one short window."""
    n = np.diff(bounds)
    count = np.where(n == 0, 0, np.maximum(1, -(-(n - LENGTH) // STRIDE) + 1))
    doc = np.repeat(np.arange(len(n)), count)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    first = np.minimum(nth * STRIDE, np.maximum(n[doc] - LENGTH, 0))
    return doc, bounds[:-1][doc] + first, np.minimum(n[doc], LENGTH)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Network:
    """Weights, and passes over windows given as rows of projected words."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)

        def draw(*shape):
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        # Embeddings begin at zero (``train`` sets the first dimension): features
        # never seen in training say nothing.
        self.p = {"emb": np.zeros((N_FEATURES, EMBED), np.float32),
                  "att": draw(2 * HIDDEN) * 0.1, "out": draw(2 * HIDDEN),
                  "bias": np.zeros(1, np.float32)}
        for d in "fb":
            self.p[f"wx{d}"] = draw(2 * EMBED, 3 * HIDDEN) * 2
            self.p[f"wh{d}"] = draw(HIDDEN, 3 * HIDDEN)
            self.p[f"bh{d}"] = np.zeros(3 * HIDDEN, np.float32)
        self.shift, self.scale = 0.0, 1.0
        self.seen = np.zeros(0), np.zeros(0, np.int64)   # logits and labels that set the cut

    def inputs(self, features: np.ndarray, word: np.ndarray, n: np.ndarray, count: int):
        """(count, 2 * EMBED): embedding of each word, mean of its n-grams."""
        is_word = features >= BUCKETS
        x = np.zeros((count, 2 * EMBED), np.float32)
        x[word[is_word], :EMBED] = self.p["emb"][features[is_word]]
        chars, own = features[~is_word], word[~is_word]
        for k in range(EMBED):                           # a dimension at a time: less to hold
            x[:, EMBED + k] = np.bincount(own, weights=self.p["emb"][chars, k],
                                          minlength=count) / n
        return x

    def project(self, x: np.ndarray) -> list[np.ndarray]:
        """Gate inputs of both directions; one more row stands for padding."""
        out = []
        for d in "fb":
            rows = np.zeros((len(x) + 1, 3 * HIDDEN), np.float32)
            rows[:-1] = x @ self.p[f"wx{d}"] + self.p[f"bh{d}"]
            rows[-1, :HIDDEN] = PAD_GATE
            out.append(rows)
        return out

    def forward(self, projected: list[np.ndarray], ids: np.ndarray, pad: int, keep: bool = False):
        """Logits of windows ``ids`` (windows, LENGTH) of word numbers."""
        h_all = np.zeros((ids.shape[1], len(ids), 2 * HIDDEN), np.float32)
        saved = []
        for k, d in enumerate("fb"):
            wh = self.p[f"wh{d}"]
            h = np.zeros((len(ids), HIDDEN), np.float32)
            steps = range(ids.shape[1]) if d == "f" else range(ids.shape[1] - 1, -1, -1)
            trace = {}
            for t in steps:
                x = projected[k][ids[:, t]]
                a = h @ wh
                zr = _sigmoid(x[:, :2 * HIDDEN] + a[:, :2 * HIDDEN])
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                an = a[:, 2 * HIDDEN:]
                n = np.tanh(x[:, 2 * HIDDEN:] + r * an)
                new = n + z * (h - n)
                if keep:
                    trace[t] = (h, z, r, n, an)
                h = new
                h_all[t, :, k * HIDDEN:(k + 1) * HIDDEN] = h
            saved.append((list(steps), trace))
        e = h_all @ self.p["att"]
        e[(ids == pad).T] = -1e9
        e -= e.max(axis=0)
        w = np.exp(e)
        w /= w.sum(axis=0)
        pooled = np.einsum("tb,tbh->bh", w, h_all)
        logit = pooled @ self.p["out"] + self.p["bias"][0]
        return (logit, (h_all, w, pooled, saved)) if keep else logit

    def backward(self, g_logit: np.ndarray, state, projected, ids):
        """Gradients of all weights but the embeddings, and of the projected
        rows."""
        h_all, w, pooled, saved = state
        grads = {"out": pooled.T @ g_logit, "bias": np.array([g_logit.sum()], np.float32)}
        g_pool = g_logit[:, None] * self.p["out"]
        dot = np.einsum("bh,tbh->tb", g_pool, h_all)
        g_e = w * (dot - (w * dot).sum(axis=0))
        grads["att"] = np.einsum("tb,tbh->h", g_e, h_all)
        g_h = w[:, :, None] * g_pool + g_e[:, :, None] * self.p["att"]
        g_rows = []
        for k, d in enumerate("fb"):
            wh = self.p[f"wh{d}"]
            g_wh = np.zeros_like(wh)
            rows = np.zeros_like(projected[k])
            carry = np.zeros((len(ids), HIDDEN), np.float32)
            steps, trace = saved[k]
            order = np.argsort(ids, axis=None, kind="stable")
            g_x = np.empty((ids.shape[1], len(ids), 3 * HIDDEN), np.float32)
            for t in reversed(steps):
                h, z, r, n, an = trace[t]
                g = g_h[t, :, k * HIDDEN:(k + 1) * HIDDEN] + carry
                g_n = g * (1 - z) * (1 - n * n)
                g_a = np.concatenate([g * (h - n) * z * (1 - z), g_n * an * r * (1 - r), g_n * r],
                                     axis=1)
                g_x[t] = g_a
                g_x[t, :, 2 * HIDDEN:] = g_n
                g_wh += h.T @ g_a
                carry = g * z + g_a @ wh.T
            flat = g_x.transpose(1, 0, 2).reshape(-1, 3 * HIDDEN)[order]
            sorted_ids = ids.ravel()[order]
            first = np.flatnonzero(np.concatenate([[True], sorted_ids[1:] != sorted_ids[:-1]]))
            rows[sorted_ids[first]] = np.add.reduceat(flat, first, axis=0)
            grads[f"wh{d}"] = g_wh
            g_rows.append(rows[:-1])
        return grads, g_rows

    def score(self, logit: np.ndarray) -> np.ndarray:
        return _sigmoid(self.scale * (logit.astype(np.float64) - self.shift))


class _Prepared:
    """Words, features and windows of a slice of texts."""

    def __init__(self, column: pa.Array):
        words = Words(column, scripts=False)
        self.count = len(words.keys)
        features, word = words.features(GRAMS, BUCKETS, WORD_BUCKETS)
        order = np.argsort(word, kind="stable")          # the features of a word together
        self.features, self.word = features[order], word[order]
        self.cuts = np.searchsorted(self.word, np.arange(self.count + 1))
        self.grams = np.maximum(1, np.bincount(self.word[self.features < BUCKETS],
                                               minlength=self.count)).astype(np.float32)
        self.doc, self.first, self.size = windows(words.bounds)
        self.code, self.docs = words.code, len(words.bounds) - 1
        self.words_in = np.diff(words.bounds)

    def ids(self, which: np.ndarray) -> np.ndarray:
        at = self.first[which][:, None] + np.arange(LENGTH)[None, :]
        out = self.code[np.minimum(at, len(self.code) - 1)]
        out[np.arange(LENGTH)[None, :] >= self.size[which][:, None]] = self.count
        return out

    def logits(self, net: Network) -> np.ndarray:
        projected = net.project(net.inputs(self.features, self.word, self.grams, self.count))
        out = np.empty(len(self.doc), np.float32)
        for lo in range(0, len(out), 1024):
            which = np.arange(lo, min(lo + 1024, len(out)))
            out[which] = net.forward(projected, self.ids(which), self.count)
        return out

    def highest(self, logits: np.ndarray) -> np.ndarray:
        best = np.full(self.docs, -np.inf)
        np.maximum.at(best, self.doc, logits)
        return best


def _associations(data: _Prepared, labels: np.ndarray, docs: np.ndarray):
    """(start value, documents) of every feature from the training documents:
    toxic documents with it beyond what chance would give (the expected count
    and three standard errors), squashed to (0, 1)."""
    features, cuts = data.features, data.cuts
    counts = np.zeros((2, N_FEATURES), dtype=np.int64)
    bounds = np.concatenate([[0], np.cumsum(data.words_in)])
    for c in (0, 1):
        mine = np.flatnonzero(docs & (labels == c))
        for lo in range(0, len(mine), 32):           # a few documents at a time
            seen = []
            for d in mine[lo: lo + 32].tolist():
                word = np.unique(data.code[bounds[d]: bounds[d + 1]])
                sizes = cuts[word + 1] - cuts[word]
                at = np.repeat(cuts[word] - np.cumsum(sizes) + sizes, sizes) \
                    + np.arange(sizes.sum())
                seen.append(np.unique(features[at]))
            counts[c] += np.bincount(np.concatenate(seen), minlength=N_FEATURES)
    b, a = counts
    p, n = (labels[docs] == 1).sum(), (labels[docs] == 0).sum()
    expected = (a + b) * p / (p + n)
    return np.tanh(np.maximum(a - expected - 3 * np.sqrt(expected + 1), 0) / 4), a + b


def _epoch(net: Network, data: _Prepared, picked: np.ndarray, target: np.ndarray, adam: dict,
           rng, rate: float) -> None:
    features, cuts = data.features, data.cuts
    order = rng.permutation(len(picked))
    for lo in range(0, len(order), BATCH):
        which = order[lo: lo + BATCH]
        ids = data.ids(picked[which])
        used, local = np.unique(ids, return_inverse=True)
        real = used[used < data.count]
        sizes = cuts[real + 1] - cuts[real]
        at = np.repeat(cuts[real] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        feat, word = features[at], np.repeat(np.arange(len(real)), sizes)
        local = local.reshape(ids.shape)                     # padding is the last number
        local[ids == data.count] = len(real)
        grams = data.grams[real]
        x = net.inputs(feat, word, grams, len(real))
        projected = net.project(x)
        logit, state = net.forward(projected, local, len(real), keep=True)
        g = ((_sigmoid(logit) - target[which]) / len(which)).astype(np.float32)
        grads, g_rows = net.backward(g, state, projected, local)
        g_in = np.zeros_like(x)
        for d, gr in zip("fb", g_rows, strict=True):
            grads[f"wx{d}"] = x.T @ gr
            grads[f"bh{d}"] = gr.sum(axis=0)
            g_in += gr @ net.p[f"wx{d}"].T
        is_word = feat >= BUCKETS
        g_feat = np.where(is_word[:, None], g_in[word, :EMBED],
                          g_in[word, EMBED:] / grams[word][:, None])
        known = adam["often"][feat]
        touched, slot = np.unique(feat[known], return_inverse=True)
        g_feat = g_feat[known]
        g_emb = np.stack([np.bincount(slot, weights=g_feat[:, k]) for k in range(EMBED)], axis=1)
        adam["t"] += 1
        fix = rate * np.sqrt(1 - 0.999 ** adam["t"]) / (1 - 0.9 ** adam["t"])
        for name, grad in grads.items():
            m, v = adam[name]
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            net.p[name] -= (fix * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
        # Embeddings: adaptive steps for the rows of this batch only.
        acc = adam["emb"]
        acc[touched] += (g_emb * g_emb).mean(axis=1)
        net.p["emb"][touched] -= (EMBED_RATE * g_emb / (np.sqrt(acc[touched])[:, None] + 1e-6)
                                  ).astype(np.float32)


def train(texts: list[str], labels: np.ndarray, seed: int = 1) -> Network | None:
    """Network from labelled texts; None unless both classes occur."""
    labels = np.asarray(labels)
    if not len(labels) or labels.min() == labels.max():
        return None
    rng = np.random.default_rng(seed)
    net = Network(seed)
    data = _Prepared(pa.array(texts, pa.large_string()))
    kept_out = np.zeros(len(labels), dtype=bool)
    for c in (0, 1):
        mine = rng.permutation(np.flatnonzero(labels == c))
        kept_out[mine[: len(mine) // 5]] = True
    mine = np.flatnonzero(~kept_out[data.doc])
    doc, y = data.doc[mine], labels[data.doc[mine]]
    adam = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items() if k != "emb"}
    start, documents = _associations(data, labels, ~kept_out)
    net.p["emb"][:, 0] = start
    adam |= {"emb": np.zeros(N_FEATURES), "t": 0, "often": documents >= OFTEN}

    def some(order: np.ndarray, each: int) -> np.ndarray:
        """The first ``each`` windows of every document, in this order."""
        by_doc = order[np.argsort(doc[order], kind="stable")]
        d = doc[by_doc]
        nth = np.arange(len(d)) - np.searchsorted(d, d)
        return by_doc[nth < each]

    for epoch in range(EPOCHS):
        shuffled = rng.permutation(len(mine))
        if epoch == 0:
            chosen = some(shuffled, 8)
        else:
            logits = data.logits(net)[mine]
            ranked = np.argsort(-logits, kind="stable")
            top = some(ranked, 2)
            extra = some(shuffled, 3)
            chosen = np.unique(np.concatenate([top, extra[y[extra] == 0]]))
        pos, neg = chosen[y[chosen] == 1], chosen[y[chosen] == 0]
        pos = np.resize(pos, max(len(pos), len(neg) // 2))       # repeat the rarer class
        chosen = np.concatenate([pos, neg])
        _epoch(net, data, mine[chosen], y[chosen].astype(np.float32), adam, rng,
               RATE * (0.5 if epoch >= EPOCHS - 2 else 1.0))

    best = data.highest(data.logits(net))
    look = kept_out & np.isfinite(best)
    if len(set(labels[look].tolist())) < 2:
        look = np.isfinite(best)
    net.seen = best[look], labels[look]
    net.shift, net.scale = _offset(*net.seen)
    return net


def _offset(logit: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """(cut, slope): the cut with the fewest errors, in the middle of the
    widest gap among equally good ones; slope 1."""
    cuts = np.unique(logit)
    middle = np.concatenate([[cuts[0] - 1], (cuts[1:] + cuts[:-1]) / 2, [cuts[-1] + 1]])
    pos, neg = np.sort(logit[label == 1]), np.sort(logit[label == 0])
    errors = np.searchsorted(pos, middle) + len(neg) - np.searchsorted(neg, middle)
    gaps = np.concatenate([[0], np.diff(cuts), [0]])
    good = np.flatnonzero(errors == errors.min())
    return float(middle[good[np.argmax(gaps[good])]]), 1.0


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, digest, toxic, long) of the distinct labelled rows of ``docs``
    that may be learned from."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                          F.col("toxic").cast("int").alias("toxic")) \
        .filter("doc_id IS NOT NULL AND toxic IN (0, 1)") \
        .filter(~held_out(F.col("doc_id"), FOLDS))
    rows = docs.filter("text IS NOT NULL").select(
        "doc_id", F.xxhash64("text").alias("digest"),
        (F.octet_length("text") > MAX_BYTES).alias("long"))
    return stored(rows.join(known, "doc_id").distinct(), "labelled")


def _drawn(rows: DataFrame, most: dict[int, int], *first: str) -> DataFrame:
    """At most ``most[c]`` rows of class c: by ``first``, then a hash of the id."""
    rank = F.xxhash64("doc_id", F.lit("sample"))
    some = [rows.filter(F.col("toxic") == c).orderBy(*first, rank, "doc_id", "digest").limit(n)
            for c, n in most.items()]
    return some[0].unionByName(some[1])


def _rows_of(docs: DataFrame, drawn: DataFrame) -> DataFrame:
    """The rows of ``docs`` named by ``drawn`` (few), repeated rows once."""
    return docs.withColumn("digest", F.xxhash64("text")).join(
        F.broadcast(drawn), ["doc_id", "digest"]).dropDuplicates(["doc_id", "digest", "toxic"])


def sample(docs: DataFrame, drawn: DataFrame) -> tuple[list[str], np.ndarray]:
    """Texts and labels of the drawn rows; of a long text an excerpt."""
    size = MAX_BYTES // 4                             # characters of at most four bytes
    start = F.pmod(F.xxhash64("digest"), F.greatest(F.length("text") - size, F.lit(0)) + 1) + 1
    text = F.when(F.col("long"), F.substring("text", start.cast("int"), F.lit(size))).otherwise(
        F.col("text")).alias("text")
    found = _rows_of(docs, drawn).select("doc_id", text, "toxic").collect()   # bounded as above
    found.sort(key=lambda r: (r["doc_id"], r["text"]))
    return [r["text"] for r in found], np.array([r["toxic"] for r in found])


def set_cut(net: Network, docs: DataFrame, drawn: DataFrame) -> None:
    """The cut once more, with the whole texts of the drawn long rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, max_bytes=2 << 20):
            data = _Prepared(batch.column("text"))
            best = data.highest(data.logits(net)) if len(data.doc) else np.full(data.docs, -np.inf)
            yield pa.RecordBatch.from_arrays([pa.array(best), batch.column("toxic")],
                                             names=["logit", "toxic"])

    rows = _rows_of(docs, drawn).select("text", "toxic") \
        .mapInArrow(run, "logit double, toxic int").filter("logit > double('-infinity')").collect()
    best = np.concatenate([net.seen[0], [r["logit"] for r in rows]])
    net.seen = best, np.concatenate([net.seen[1], [r["toxic"] for r in rows]]).astype(np.int64)
    net.shift, net.scale = _offset(*net.seen)


def fitted(docs: DataFrame, labels: DataFrame) -> Network | None:
    rows = labelled_rows(docs, labels)
    drawn = stored(_drawn(rows, {1: MAX_POSITIVE, 0: MAX_NEGATIVE}, "long"), "sample")
    net = train(*sample(docs, drawn))
    long = rows.filter("long").join(drawn, ["doc_id", "digest", "toxic"], "left_anti")
    cutters = stored(_drawn(long, {1: LONG_EACH, 0: LONG_EACH}), "long-texts")
    if net is not None and not cutters.isEmpty():
        set_cut(net, docs, cutters)
    return net


def toxicity_scores(docs: DataFrame, net: Network | None) -> DataFrame:
    """(doc_id, score, n_windows) of ``docs(doc_id, text)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, max_bytes=2 << 20):
            data = _Prepared(batch.column("text"))
            score = np.zeros(batch.num_rows)
            if net is not None and len(data.doc):
                best = data.highest(data.logits(net))
                some = np.isfinite(best)
                score[some] = net.score(best[some])
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(score),
                pa.array(np.bincount(data.doc, minlength=batch.num_rows).astype(np.int64))],
                names=["doc_id", "score", "n_windows"])

    return docs.mapInArrow(run, "doc_id bigint, score double, n_windows bigint")


def op3_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    out = toxicity_scores(rows, fitted(rows, labels))
    return out.select("doc_id", held_out(F.col("doc_id"), FOLDS).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_windows")
