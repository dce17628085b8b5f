"""Near-duplicates and repeated strings against brute force."""

import hashlib
import random

import numpy as np
import pytest

from nbsieve.llm import near_dedup, suffix_dedup
from nbsieve.llm.components import components
from nbsieve.llm.suffix_sort import deep_shallow
from tests.llm.helpers import AWKWARD, clashing, collected, frame, prose, shingles


def brute_components(texts):
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(texts))], [len(s) for s in sets]


def near_copies():
    rng = random.Random(11)
    texts = list(AWKWARD)
    for _ in range(12):
        base = prose(rng, rng.choice([6, 20, 60, 300])).split()
        texts.append(" ".join(base))
        w = list(base)
        for _ in range(rng.randint(1, 12)):          # chains: each copy edits the one before
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                w[rng.randrange(len(w))] = prose(rng, 1)
            texts.append(" ".join(w).upper() if rng.random() < 0.2 else " ".join(w))
    shared = prose(rng, 40)
    texts += [shared + " " + prose(rng, rng.randint(5, 40)) for _ in range(40)]
    return texts


def test_near_duplicates_equal_brute_force(spark):
    texts = near_copies()
    label, sizes = brute_components(texts)
    out = {r["doc_id"]: r for r in collected(near_dedup.op1_near_dedup(clashing(frame(spark, texts))))}
    assert len(out) == len(texts)
    for i in range(len(texts)):
        assert (out[i]["n_shingles"], out[i]["component_id"], out[i]["kept"]) == (
            sizes[i], label[i], label[i] == i), (i, texts[i])


def test_near_duplicates_with_small_blocks_and_no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    monkeypatch.setattr(near_dedup, "BROADCAST_IDS", 0)
    texts = near_copies()
    label, _ = brute_components(texts)
    out = {r["doc_id"]: r["component_id"] for r in collected(near_dedup.op1_near_dedup(frame(spark, texts)))}
    assert [out[i] for i in range(len(texts))] == label


def test_near_duplicates_of_texts_that_share_an_id(spark, monkeypatch):
    rng = random.Random(3)
    a, b, c, d = (prose(rng, 40) for _ in range(4))
    rows = [(5, a), (5, b), (5, b), (1, c), (5, c + " more"), (2, a + " x"), (9, b + " y"), (9, d),
            (9, None), (9, " ")]
    df = frame(spark, [t for _, t in rows], [i for i, _ in rows])
    want = sorted([(1, 40 - 4, 1, True), (2, 37, 2, True), (5, 36, 2, False), (5, 37, 1, False),
                   (5, 36, 5, True), (5, 36, 5, True), (9, 37, 5, False), (9, 36, 9, True),
                   (9, 0, 9, True), (9, 0, 9, True)])
    tail = near_dedup.op1_near_dedup(frame(spark, [a, a + " tail"], [5, 5]))
    assert [(r["component_id"], r["kept"]) for r in tail.collect()] == [(5, True)] * 2
    for few in (2_000_000, 0):
        monkeypatch.setattr(near_dedup, "BROADCAST_IDS", few)
        assert sorted(map(tuple, near_dedup.op1_near_dedup(df).collect())) == want
        kept = sorted((r["doc_id"], (r["text"] or "").strip()) for r in near_dedup.keep_first(df).collect())
        assert kept == sorted([(1, c), (2, a + " x"), (5, b), (9, d), (9, "")])


def test_near_duplicates_odd_ids(spark):
    t = "a b c d e f g h i j k"
    df = frame(spark, [t, t, t, t, None], [7, 7, None, 9, None])
    rows = sorted(map(str, near_dedup.op1_near_dedup(df).collect()))
    assert len(rows) == 5 and sum("component_id=7" in r for r in rows) == 3
    assert sum("component_id=None, kept=None" in r for r in rows) == 2
    assert near_dedup.op1_near_dedup(df.limit(0)).collect() == []
    kept = near_dedup.keep_first(clashing(df))
    assert kept.columns == clashing(df).columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["7", "None", "None"]


def test_estimate_is_unbiased():
    rng = np.random.default_rng(0)
    table = near_dedup._collision_table()
    got = []
    for _ in range(40):
        pool = rng.integers(0, 2 ** 64, size=500, dtype=np.uint64)
        a, b = near_dedup.sketches([np.sort(pool[:400]), np.sort(pool[100:])])
        got.append(near_dedup.estimated((a == b).sum(), 400, 400, table))
    assert abs(np.mean(got) - 0.6) < 0.02


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 103), (103, 101), (200, 200)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r["node"]: r["label"] for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 103: 100}
    assert components(df.limit(0)).collect() == []


@pytest.mark.parametrize("shallow", [8, 64])
def test_deep_shallow_sorts(shallow):
    rng = random.Random(6)
    parts = [bytes(rng.choice(b"ab\0") for _ in range(rng.randint(0, 30))) for _ in range(12)]
    strings = [b"".join(rng.choice(parts) for _ in range(rng.randint(0, 8))) for _ in range(600)]
    group = np.array([rng.randint(0, 3) for _ in strings])
    order, lcp = deep_shallow(strings, group, shallow)
    assert sorted(order.tolist()) == list(range(600))
    keys = [(group[i], strings[i]) for i in order]
    assert keys == sorted(keys)
    for k in range(1, 600):
        a, b = strings[order[k - 1]], strings[order[k]]
        want = 0
        if keys[k][0] == keys[k - 1][0]:
            while want < min(len(a), len(b)) and a[want] == b[want]:
                want += 1
        assert lcp[k] == want


def brute_cut(texts, window=suffix_dedup.WINDOW):
    seen = {}
    raw = [(t or "").encode() for t in texts]
    for b in raw:
        for i in range(len(b) - window + 1):
            seen[b[i:i + window]] = seen.get(b[i:i + window], 0) + 1
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, dtype=bool)
        for i in range(len(b) - window + 1):
            if seen[b[i:i + window]] > 1:
                gone[i:i + window] = True
        runs = int(np.sum(gone[:-1] & ~np.concatenate([[False], gone[:-2]]))) if len(b) else 0
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def repeats():
    rng = random.Random(21)
    texts = list(AWKWARD) + ["ab" * 300, "z" * 199, "y" * 200, "y" * 201]
    passages = [prose(rng, n) for n in (40, 45, 60, 120)] + ["é" * 150]
    for _ in range(60):
        t = prose(rng, rng.randint(0, 120))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a, b = sorted((rng.randint(0, len(p)), rng.randint(0, len(p))))
            at = rng.randint(0, len(t))
            t = t[:at] + (p[a:b] if rng.random() < 0.7 else p) + t[at:]
        texts.append(t)
    copy = list(rng.choice([t for t in texts[20:] if len(t) > 500]))
    for _ in range(12):                              # near copies: edits at random places
        copy[rng.randrange(len(copy))] = "#"
        texts.append("".join(copy))
    return texts + [texts[-1]]


@pytest.mark.parametrize("hot", [suffix_dedup.HOT_TEXTS, 1])
def test_repeats_equal_brute_force(spark, hot):
    texts = repeats()
    from pyspark.sql import functions as F
    df = suffix_dedup.cut_repeats(clashing(frame(spark, texts)), hot_texts=hot)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["h"]) for r in df.select(
        "doc.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2(F.coalesce("kept", F.lit("").cast("binary")), 256).alias("h")).collect()}
    want = brute_cut(texts)
    assert sum(w[1] > 0 for w in want) > 30
    for i, w in enumerate(want):
        assert got[i] == w, (i, texts[i])


def test_repeats_of_segments_and_rows(spark, monkeypatch):
    rng = random.Random(8)
    texts = [prose(rng, 900), None]
    texts += [texts[0][:700] + prose(rng, 50) + texts[0][1500:]]
    buf = np.frombuffer("".join(t or "" for t in texts).encode(), dtype=np.uint8)
    offsets = np.cumsum([0] + [len((t or "").encode()) for t in texts])
    whole = suffix_dedup.anchors(buf, offsets)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 333)
    parts = suffix_dedup.anchors(buf, offsets)
    cover = lambda x: sorted((int(g), int(a + k), int(le - k)) for g, _, a, le, n in
                             zip(*x, strict=True) for k in range(n))
    assert cover(whole) == cover(parts)
    df = frame(spark, [texts[0], texts[0], None], [5, 5, None])
    rows = suffix_dedup.op2_suffix_dedup(df).collect()
    assert sorted((r["n_bytes"], r["n_removed"]) for r in rows) == [(0, 0)] + 2 * [
        (len(texts[0]), len(texts[0]))]
    assert suffix_dedup.op2_suffix_dedup(df.limit(0)).collect() == []


def test_without_repeats_keeps_columns_and_characters(spark):
    df = clashing(frame(spark, ["é" * 150 + "x", "a" + "é" * 150, "short", None]))
    out = suffix_dedup.without_repeats(df)
    assert out.columns == df.columns
    got = {r["doc_id"]: (r["text"], r["n_chars"], r["row"]) for r in out.collect()}
    assert got == {0: ("x", 1, "x"), 1: ("a", 1, "x"), 2: ("short", 5, "x"), 3: (None, None, "x")}
