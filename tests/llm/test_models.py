"""Toxicity, language spans, PPM and packing: round trips, brute force, held-out accuracy."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from nbsieve.llm import langid, packing, ppm, toxicity
from nbsieve.llm.common import text_slices
from tests.llm.helpers import AWKWARD, FOLD, WORD, clashing, collected, frame, prose


def crc(i, k):
    return zlib.crc32(str(i).encode()) % k


# -- toxicity

def toxic_corpus(rng, n):
    stems = ["blorg", "wikket", "snarp"]
    out = []
    for _ in range(n):
        words = prose(rng, rng.randint(5, 200), "aeiouthnr", 7).split()
        bad = rng.random() < 0.3
        if bad:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(stems) + rng.choice(["", "ing", "er", "est"]))
        out.append((" ".join(words), int(bad)))
    return out


def test_toxicity_held_out(spark):
    rng = random.Random(1)
    corpus = toxic_corpus(rng, 500)
    texts = [t for t, _ in corpus] + AWKWARD
    df = clashing(frame(spark, texts))
    labels = spark.createDataFrame([(i, 1, y) for i, (_, y) in enumerate(corpus)] + [(None, 1, 1), (3, 1, None)],
                                   "doc_id bigint, quality int, toxic int")
    out = {r["doc_id"]: r for r in collected(toxicity.op3_toxicity(df, labels))}
    assert len(out) == len(texts)
    held = [i for i in range(500) if crc(i, 5) == 0]
    assert all(out[i]["held_out"] == (crc(i, 5) == 0) for i in out)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out.values())
    assert np.mean([out[i]["predicted"] == corpus[i][1] for i in held]) > 0.95
    assert [out[500 + k]["score"] for k in (0, 1, 2)] == [0, 0, 0]
    none = toxicity.op3_toxicity(df, labels.filter("toxic = 1")).agg({"score": "max"}).first()[0]
    assert none == 0
    assert toxicity.op3_toxicity(df.limit(0), labels.limit(0)).collect() == []


def test_toxicity_long_and_missing_documents(spark, monkeypatch):
    rng = random.Random(7)
    corpus = toxic_corpus(rng, 400)
    long = [(prose(rng, 400, "aeiouthnr", 7) + f" {t}", y) for t, y in corpus if y]
    rows = [(t, y) for t, y in corpus if not y] + long             # every toxic text is long
    clean = [prose(rng, 900, "aeiouthnr", 7) for _ in range(60)]
    rows += [(t, 0) for t in clean]
    monkeypatch.setattr(toxicity, "MAX_BYTES", 1_000)
    monkeypatch.setattr(toxicity, "MAX_NEGATIVE", 200)
    df = frame(spark, [t for t, _ in rows])
    labels = spark.createDataFrame(
        [(i, 1, y) for i, (_, y) in enumerate(rows)]
        + [(10_000 + i, 1, 0) for i in range(20_000)],               # ids without a document
        "doc_id bigint, quality int, toxic int")
    body = df.select("doc_id", "text")
    known = toxicity.labelled_rows(body, labels)
    assert known.filter("doc_id >= 10000").isEmpty() and known.filter("long AND toxic = 1").count() > 50
    drawn = toxicity._drawn(known, {1: 1_200, 0: 200}, "long")
    texts, marks = toxicity.sample(body, drawn)
    assert (marks == 0).sum() == 200 and max(len(t.encode()) for t in texts) <= 1_000
    net = toxicity.fitted(body, labels)
    assert net is not None and len(set(net.seen[1].tolist())) == 2
    in_sample = sum(n // 5 for n in ((marks == 0).sum(), (marks == 1).sum()))
    assert len(net.seen[0]) > in_sample                             # long clean texts set the cut too
    out = toxicity.op3_toxicity(df, labels).agg({"score": "max"}).first()[0]
    assert out > 0


def test_gradients():
    rng = np.random.default_rng(2)
    net = toxicity.Network(3)
    net.p = {k: (v + 0.1 * rng.standard_normal(v.shape)).astype(np.float64) for k, v in net.p.items()}
    x = rng.standard_normal((6, 2 * toxicity.EMBED))
    ids = rng.integers(0, 7, size=(3, 5))
    ids[0, 3:] = 6
    up = rng.standard_normal(3)

    def loss():
        return float(net.forward(net.project(x), ids, 6) @ up)

    projected = net.project(x)
    _, state = net.forward(projected, ids, 6, keep=True)
    grads, rows = net.backward(up, state, projected, ids)
    for d, g in zip("fb", rows, strict=True):
        grads[f"wx{d}"], grads[f"bh{d}"] = x.T @ g, g.sum(axis=0)
    for name, grad in grads.items():
        flat = net.p[name].reshape(-1)
        for at in rng.choice(flat.size, min(4, flat.size), replace=False):
            old = flat[at]
            flat[at] = old + 1e-3
            up_loss = loss()
            flat[at] = old - 1e-3
            down = loss()
            flat[at] = old
            assert abs((up_loss - down) / 2e-3 - grad.reshape(-1)[at]) < 2e-3, name


def test_windows_cover_all_words():
    bounds = np.cumsum([0, 0, 1, 31, 32, 33, 48, 49, 500])
    doc, first, size = toxicity.windows(bounds)
    seen = Counter(w for f, s in zip(first, size, strict=True) for w in range(f, f + s))
    assert set(seen) == set(range(bounds[-1]))
    assert all(bounds[d] <= f and f + s <= bounds[d + 1] for d, f, s in zip(doc, first, size, strict=True))


# -- languages

ALPHABETS = {"xa": "aeioutk", "xb": "lmnouyr", "ru": "абвгдеж"}


def test_languages_held_out_and_spans(spark):
    rng = random.Random(5)
    langs = [rng.choice(list(ALPHABETS)) for _ in range(300)]
    texts = [prose(rng, rng.randint(3, 60), ALPHABETS[x]) for x in langs]
    mixed = prose(rng, 30, ALPHABETS["xa"]) + " " + prose(rng, 40, ALPHABETS["xb"], 9) + " 12 ," \
        + prose(rng, 30, ALPHABETS["ru"], 9)
    df = clashing(frame(spark, texts + AWKWARD + [mixed],
                        langs=langs + [None] * (len(AWKWARD) + 1)))
    out = {r["doc_id"]: r for r in collected(langid.op6_language_id(df))}
    assert len(out) == 301 + len(AWKWARD)
    held = [i for i in range(300) if crc(i, 5) == 0]
    assert np.mean([out[i]["lang_pred"] == langs[i] for i in held]) > 0.97
    for k, t in enumerate(AWKWARD):
        letter = any(c.isalpha() for c in t or "")
        assert (out[300 + k]["lang_pred"] != "und") == letter, t
        assert 0 <= out[300 + k]["score"] <= 1
    rows = frame(spark, texts, langs=langs)
    model = langid.learn(rows)
    (spans,) = langid.language_spans(frame(spark, [mixed]).select("doc_id", "text"), model).collect()
    assert [s["lang"] for s in spans["spans"]] == ["xa", "xb", "ru"]
    none = langid.op6_language_id(frame(spark, ["abc"], langs=[None])).collect()
    assert [(r["lang_pred"], r["score"]) for r in none] == [("und", 0.0)]
    assert langid.op6_language_id(df.limit(0)).collect() == []


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(20):
        sizes = rng.integers(0, 7, size=4)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        scores = rng.standard_normal((5, 3)) * 3
        code = rng.integers(0, 5, size=bounds[-1])
        path = langid.viterbi(scores, code, bounds, penalty=2.0)

        def value(p, c):
            return sum(scores[x, k] for x, k in zip(c, p, strict=True)) - 2.0 * sum(
                a != b for a, b in zip(p, p[1:], strict=False))

        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            from itertools import product
            best = max((value(p, code[lo:hi]) for p in product(range(3), repeat=hi - lo)), default=0)
            assert value(path[lo:hi], code[lo:hi]) == pytest.approx(best)


# -- prediction by partial matching

def brute_ppm(train, texts):
    """Static model, longest context first, escapes with exclusion."""
    seen = defaultdict(Counter)

    def symbols(t):
        return [256] * ppm.ORDER + list(t.encode()) + [256]

    for t in train:
        s = symbols(t)
        for i in range(ppm.ORDER, len(s)):
            for k in range(ppm.ORDER + 1):
                seen[tuple(s[i - k:i])][s[i]] += 1
    out = []
    for t in texts:
        s, total = symbols(t), 0.0
        for i in range(ppm.ORDER, len(s)):
            hidden, p = set(), 1.0
            for k in range(ppm.ORDER, -1, -1):
                c = {x: n for x, n in seen.get(tuple(s[i - k:i]), {}).items() if x not in hidden}
                if not c:
                    continue
                size = sum(c.values()) + len(c)
                if s[i] in c:
                    p *= c[s[i]] / size
                    break
                p *= len(c) / size
                hidden |= set(c)
            else:
                p /= ppm.SYMBOLS - len(hidden)
            total += np.log10(p)
        out.append(total)
    return out


@pytest.mark.parametrize("chunk, ranges, group", [(ppm.CHUNK_BYTES, None, 64), (400, 6, 2), (30, 1030, 64)])
def test_ppm_equals_brute_force(spark, monkeypatch, chunk, ranges, group):
    monkeypatch.setattr(ppm, "GROUP", group)
    rng = random.Random(3)
    texts = AWKWARD + [prose(rng, rng.randint(0, 30), "abcé", 3) for _ in range(40)] + ["\U0001f600 zq!"]
    ids = list(range(len(texts)))
    train = [t or "" for i, t in zip(ids, texts, strict=True) if crc(i, 10)]
    want = brute_ppm(train, [t or "" for t in texts])
    from pyspark.sql import functions as F
    rows = frame(spark, texts).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    scored, n = ppm.ppm_scores(rows.withColumn("train", ~ppm.held_out(F.col("doc_id"), 10)), chunk, ranges)
    counts = Counter(w.translate(FOLD) for t in train for w in WORD.findall(t)) + Counter({None: len(train)})
    assert n == sum(counts.values())
    got = {r["doc_id"]: r for r in scored.collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        words = [w.translate(FOLD) for w in WORD.findall(t or "")] + [None]
        base = sum(np.log10((counts[w] + 0.1) / (n + 0.1 * (len(counts) + 1))) for w in words)
        assert got[i]["n_tokens"] == len(words)
        assert got[i]["n_known"] == sum(counts[w] > 0 for w in words)
        assert got[i]["base_score"] == pytest.approx(base, abs=1e-9)
        assert got[i]["score"] == pytest.approx(want[i], abs=1e-9), t


def test_ppm_without_training_or_rows(spark):
    df = clashing(frame(spark, ["abc", None], [i for i in range(99) if crc(i, 10) == 0][:2]))
    for r in ppm.op7_ppm(df).collect():
        assert r["held_out"] and r["train_tokens"] == 0 and r["base_score"] == 0
        assert r["score"] in (pytest.approx(-4 * np.log10(257)), pytest.approx(-np.log10(257)))
    assert ppm.op7_ppm(df.limit(0)).collect() == []


# -- packing

def pieces_of(rows):
    return {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows}


def test_packing_places_every_piece(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    rng = random.Random(7)
    texts = AWKWARD + ["<|endoftext|> it's O'Neil's x1y2 ́é é \x1cAİΣ \x85b"] \
        + [prose(rng, rng.randint(0, 1500)) for _ in range(80)] + [prose(rng, 9000)]
    out = collected(packing.op8_packing(clashing(frame(spark, texts))))
    tok = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    want, total = {}, 0
    for i, t in enumerate(texts):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at:at + 2048], dtype="<u4")
            want[i, k] = (at, len(part), zlib.crc32(part.tobytes()))
    assert pieces_of(out) == want and len(out) == len(want)
    per = defaultdict(list)
    for r in out:
        per[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in per.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(per) <= packing.lower_bound(np.array([r["length"] for r in out])) + 1
    assert packing.op8_packing(frame(spark, ["x"]).limit(0)).collect() == []
    twice = collected(packing.op8_packing(frame(spark, ["a b", "a b", None], [4, 4, None])))
    assert Counter((r["doc_id"], r["length"]) for r in twice) == {(4, 3): 2, (None, 1): 1}


@pytest.mark.parametrize("layout", [1, 2, 4, 8, 16])
def test_packing_exchange_between_groups(spark, monkeypatch, layout):
    monkeypatch.setattr(packing, "GROUP_PIECES", 12)
    rng = random.Random(2)
    sizes = [rng.randint(300, 1400) for _ in range(120)]
    df = frame(spark, [" ".join(["a"] * n) for n in sizes]).repartition(layout)
    out = collected(packing.op8_packing(df))
    assert len(out) == 120 and len({r["doc_id"] for r in out}) == 120
    per = defaultdict(list)
    for r in out:
        per[r["sequence_id"]].append((r["offset"], r["length"]))
    for placed in per.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 2048
    monkeypatch.setattr(packing, "EXCHANGE", False)
    alone = {r["sequence_id"] for r in packing.op8_packing(df).collect()}
    together = packing.best_fit_decreasing(np.array(sizes) + 1)[2]
    assert len(per) < len(alone) and len(per) <= together + 2


def test_best_fit_and_bounds():
    rng = np.random.default_rng(3)

    def best(items, cap):
        items = sorted(items, reverse=True)
        least = [len(items)]

        def put(i, bins):
            if len(bins) >= least[0]:
                return
            if i == len(items):
                least[0] = len(bins)
                return
            for b in range(len(bins)):
                if bins[b] + items[i] <= cap and bins[b] not in bins[:b]:
                    put(i + 1, bins[:b] + [bins[b] + items[i]] + bins[b + 1:])
            put(i + 1, bins + [items[i]])

        put(0, [])
        return least[0]

    for _ in range(60):
        x = rng.integers(1, 21, size=rng.integers(1, 10))
        bins, offsets, n = packing.best_fit_decreasing(x, 20)
        fill = np.bincount(bins, weights=x)
        assert fill.max() <= 20 and len(fill) == n
        opt = best(x.tolist(), 20)
        assert packing.lower_bound(x, 20) <= opt <= n


def test_slices_hold_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 10, None, "", "b" * 100, "c"]), pa.array(range(5))],
                                       names=["text", "i"])
    got = [s.column("i").to_pylist() for s in text_slices([batch.slice(1), batch.slice(0, 0)], max_bytes=50)]
    assert sum(got, []) == [1, 2, 3, 4] and len(got) > 1


def test_ppm_deals_equal_rows_to_many_chunks(spark):
    text = "the same row again and again"
    df = frame(spark, [text] * 600, [None] * 300 + [7] * 300).select("doc_id", "text").withColumn(
        "train", F.lit(True))
    dealt = ppm._dealt(df, 600 * (len(text) + 8) // 6)
    sizes = [r["count"] for r in dealt.groupBy("chunk").count().collect()]
    assert len(sizes) == 6 and sum(sizes) == 600 and max(sizes) < 200
    whole, n = ppm.ppm_scores(df, 1 << 30)
    parts, m = ppm.ppm_scores(df, 600 * (len(text) + 8) // 6)
    assert n == m and parts.count() == 600
    a, b = (x.agg({"score": "min"}).first()[0] for x in (whole, parts))
    assert abs(a - b) < 1e-9
