"""Exact duplicates, the filter audit and vector codes against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from nbsieve.llm import exact_dedup, filter_audit, vector_codes
from nbsieve.llm.radix_trie import RadixTrie
from tests.llm.helpers import AWKWARD, DOCS, WORD, clashing, collected, frame, prose

BLANK = re.compile("[\\x20\\x09-\\x0D]")


# ---- radix trie

@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=6) | st.text("ab", max_size=8).map(str.encode), max_size=40))
def test_trie_keeps_every_string(keys):
    trie = RadixTrie()
    for i, k in enumerate(keys):
        trie.entries(k).append(i)
    got = list(trie)
    assert [k for k, _ in got] == sorted(set(keys)) and trie.terminals == len(got)
    assert sorted(i for _, e in got for i in e) == list(range(len(keys)))
    assert all(keys[i] == k for k, e in got for i in e)
    assert all(len(n.children) != 1 or n.entries is not None
               for n in nodes(trie) if n is not trie.root)


def nodes(trie):
    waiting = [trie.root]
    while waiting:
        n = waiting.pop()
        yield n
        waiting.extend(n.children.values())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab", max_size=7).map(str.encode), min_size=1, max_size=60),
       st.integers(500, 8000), st.booleans())
def test_trie_gives_up_subtrees(keys, memory, remember):
    trie, out, late = RadixTrie(), defaultdict(list), []
    for i, k in enumerate(keys):
        entry = trie.entries(k)
        if entry is None:
            late.append(i)
            continue
        entry.append(i)
        while trie.size > memory and (found := trie.give_up(remember)):
            for key, e in found:
                out[key].append(e)
    assert trie.terminals >= 1 and (remember or not late)
    for key, e in trie:
        if remember:
            assert key not in out and all(keys[i] != key for i in late)
        out[key].append(e)
    assert sorted([i for es in out.values() for e in es for i in e] + late) == list(range(len(keys)))
    assert all(keys[i] == key for key, es in out.items() for e in es for i in e)


# ---- op13

def brute_exact(rows):
    """rows: (doc_id, text) -> multiset of (doc_id, keep_id, size, kept, digest)."""
    groups = defaultdict(list)
    for i, (d, t) in enumerate(rows):
        groups[BLANK.sub("", t or "")].append((-len(t or ""), d is None, d or 0, i))
    out = Counter()
    for body, members in groups.items():
        members.sort()
        keep = None if members[0][1] else members[0][2]
        for k, (_, none, d, _) in enumerate(members):
            out[None if none else d, keep, len(members), k == 0,
                hashlib.sha256(body.encode()).hexdigest()] += 1
    return out


def as_counter(df):
    return Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"])
                   for r in df.collect())


def exact_rows(rng):
    base = [prose(rng, rng.randint(0, 40), "ab", 3) for _ in range(40)]
    texts = AWKWARD + ["a b", "ab", "a b", " a\tb\r\n", "a\x85b"]
    texts += [t.replace(" ", rng.choice([" ", "", "  ", "\n", "\x0b "])) for t in base for _ in range(4)]
    texts += ["hot text of many copies"] * 60 + [" ".join(["x" * 50] * 4000), " ".join(["x" * 50] * 4000) + " "]
    rng.shuffle(texts)
    return list(enumerate(texts)) + [(None, "ab"), (None, "only null ids"), (None, " only null ids"),
                                     (7, "twice"), (7, "twice"), (None, None)]


def test_exact_groups_equal_brute_force(spark):
    rows = exact_rows(random.Random(1))
    df = clashing(frame(spark, [t for _, t in rows], [d for d, _ in rows]).repartition(5))
    out = exact_dedup.op13_exact_dedup(df)
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert as_counter(out) == brute_exact(rows)


@pytest.mark.parametrize("local_bytes,owner_bytes,part_bytes", [(2000, 1 << 30, 1 << 30), (1, 3000, 20_000),
                                                                (5000, 1, 1 << 30)])
def test_exact_groups_with_tries_that_overflow(spark, local_bytes, owner_bytes, part_bytes):
    rows = [r for r in exact_rows(random.Random(2)) if r[0] is None or r[0] < 90]
    df = frame(spark, [t for _, t in rows], [d for d, _ in rows]).repartition(2)
    out = exact_dedup.exact_groups(df, local_bytes, owner_bytes, part_bytes)
    assert as_counter(out) == brute_exact(rows)


def test_exact_groups_of_an_empty_table(spark):
    out = exact_dedup.op13_exact_dedup(frame(spark, ["x"]).limit(0))
    assert out.collect() == [] and out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


# ---- op11

def brute_audit(docs, labels):
    """docs: (doc_id, text, source); labels: (doc_id, quality, toxic)."""
    first, fails = {}, []
    for d, t, _ in docs:
        if d is not None:
            first[t or ""] = min(first.get(t or "", d), d)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    for d, t, s in docs:
        t = t or ""
        w = WORD.findall(t)
        f = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
             "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t), "D": any(c in "#$%&*|" for c in t),
             "E": d is not None and first[t] < d}
        fails.append((s or "", {k for k, v in f.items() if v}, d in good, d in toxic))
    out, total = {}, Counter()
    for part in {x[0] for x in fails}:
        mine = [x for x in fails if x[0] == part]
        for order in map("".join, permutations("ABCDE")):
            for k, letter in enumerate(order):
                before = set(order[:k])
                here = [x for x in mine if letter in x[1] and not x[1] & before]
                total[part, letter] += len(here)
                out[part, order, k + 1] = [
                    sum(not x[1] & (before | {letter}) for x in mine), len(here),
                    sum(letter in x[1] and bool(x[1] & before) for x in mine),
                    sum(x[1] == {letter} for x in mine), sum(x[2] for x in here), sum(x[3] for x in here)]
    return {k: tuple([*v, total[k[0], k[1][k[2] - 1]]]) for k, v in out.items()}


def audit_of(df):
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    rows = collected(df)
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r[n] for n in names) for r in rows}
    assert len(got) == len(rows)
    return got


def test_filter_audit_equals_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    texts = AWKWARD + [prose(rng, rng.choice([20, 210, 260]), "ab" if rng.random() < .3 else "abcdefghijk", 5)
                       + rng.choice(["", " # ", " 100%", " LOUD" * 30]) for _ in range(60)]
    texts += [rng.choice(texts) for _ in range(40)] + ["word " * 300_000, "word " * 300_000, "É" * 49 + "A"]
    docs = [(i, t, rng.choice(["s", "s", "s", "t", "", None])) for i, t in enumerate(texts)]
    docs += [(None, "null id", "s"), (None, "null id", "s"), (3, texts[3], "s"), (9, "again", "t"), (9, "again", "s")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 120, 2)]
    labels += [(4, 1, 1), (4, 0, 0), (None, 1, 1), (10 ** 6, 1, 1)]
    df = spark.createDataFrame([(d, t, "en", s, 0) for d, t, s in docs], DOCS)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    want = brute_audit(docs, labels)
    assert audit_of(filter_audit.op11_filter_audit(clashing(df), marks)) == want
    monkeypatch.setattr(filter_audit, "BROADCAST_ROWS", -1)
    assert audit_of(filter_audit.op11_filter_audit(df, marks)) == want
    assert filter_audit.op11_filter_audit(df.limit(0), marks).collect() == []
    none = audit_of(filter_audit.op11_filter_audit(df, marks.limit(0)))
    assert {k: v[:4] for k, v in none.items()} == {k: v[:4] for k, v in want.items()}
    assert all(v[4] == v[5] == 0 for v in none.values())


def test_potential_gives_shapley_values(spark):
    rng = random.Random(8)
    v = [0] + [rng.randint(0, 1000) for _ in range(31)]
    q = spark.createDataFrame([(v,)], "v array<bigint>").select(
        filter_audit.potential(filter_audit.F.col("v")).alias("q")).first()["q"]
    sizes = [bin(s).count("1") for s in range(32)]
    p = [x / math.factorial(k) for x, k in zip(q, sizes, strict=True)]
    for k in range(5):
        gain = sum(v[s | 1 << k] - v[s] for o in permutations(range(5))
                   for s in [sum(1 << x for x in o[:o.index(k)])])
        assert q[31] - 5 * q[31 ^ 1 << k] == gain
    for s in range(1, 32):   # the potential of a coalition shares out its worth
        assert abs(sum(p[s] - p[s ^ 1 << k] for k in range(5) if s >> k & 1) - v[s]) < 1e-6


# ---- op12

VECS = "vec_id bigint, embedding array<float>, label int"


def brute_codes(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v], la) for i, v, la in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    q = np.array([v for _, v, _ in kept], dtype=object)
    w = q.shape[1] // parts
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))
    books = [[tuple(q[k, p * w:(p + 1) * w]) for k in order[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), j) for j, e in enumerate(book))

    for r in range(rounds + 1):
        codes = [[nearest(q[k, p * w:(p + 1) * w], books[p]) for p in range(parts)] for k in range(len(kept))]
        if r < rounds:
            for p in range(parts):
                new = list(books[p])
                for j in range(len(new)):
                    mine = [q[k, p * w:(p + 1) * w] for k in range(len(kept)) if codes[k][p][1] == j]
                    if mine:
                        new[j] = tuple(sum(c) // len(mine) for c in zip(*mine, strict=True))
                books[p] = new
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    error = [sum(d for d, _ in c) for c in codes]
    of = Counter()
    for (_, _, la), e in zip(kept, error, strict=True):
        of[la] += e
    return sorted(((i, "".join(f"{j:02x}" for _, j in c), e, of[la], digest)
                   for (i, _, la), c, e in zip(kept, codes, error, strict=True)), key=str)


def codes_of(df):
    return sorted(((r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"])
                   for r in df.collect()), key=str)


def vector_rows(rng, n, dim=32):
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    rows = [(i, [float(np.float32(c + rng.gauss(0, .15))) for c in rng.choice(centres)],
             rng.choice([0, 0, 1, 2, None])) for i in range(n)]
    rows += [(n + k, list(rows[3][1]), 1) for k in range(40)]
    rows += [(n + 50, [0.0] * dim, 5), (n + 51, [0.5] * dim, None), (n + 52, None, 1),
             (n + 53, [0.1] * (dim - 1) + [None], 1), (n + 54, [float("nan")] + [0.0] * (dim - 1), 1),
             (n + 55, [float("inf")] + [0.0] * (dim - 1), 1), (None, [0.25] * dim, 2), (5, rows[9][1], 2)]
    return rows


def test_vector_codes_equal_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    rows = vector_rows(rng, 260)
    df = spark.createDataFrame(rng.sample(rows, len(rows)), VECS).repartition(3)
    want = brute_codes(rows)
    assert codes_of(vector_codes.op12_vector_codes(clashing_vectors(df))) == want
    monkeypatch.setattr(vector_codes, "BROADCAST_ROWS", -1)
    assert codes_of(vector_codes.op12_vector_codes(df)) == want
    few = rows[:9]
    assert codes_of(vector_codes.op12_vector_codes(spark.createDataFrame(few, VECS))) == brute_codes(few)
    assert codes_of(vector_codes.op12_vector_codes(spark.createDataFrame(rows[:1] * 3, VECS))) \
        == brute_codes(rows[:1] * 3)
    assert vector_codes.op12_vector_codes(df.limit(0)).collect() == []
    assert vector_codes.op12_vector_codes(df.filter("embedding IS NULL")).collect() == []
    with pytest.raises(ValueError):
        vector_codes.op12_vector_codes(spark.createDataFrame([(1, [0.0] * 16, 0), (2, [0.0] * 32, 0)], VECS))


def clashing_vectors(df):
    from pyspark.sql import functions as F
    return df.withColumns({c: F.lit("x") for c in ("q", "codes", "error", "of", "part", "text")})


def test_vector_bounds_save_scans(spark):
    rng = random.Random(6)
    rows = vector_rows(rng, 900)
    df = spark.createDataFrame(rows, VECS)
    state, history = vector_codes.vector_codes(df, rounds=4)
    assert len(history) == 5
    r = state.agg({"scanned": "sum", "*": "count"}).first()
    assert r["sum(scanned)"] < 0.75 * 16 * r["count(1)"]
    assert codes_of_state(state) == brute_state(rows, history[-1])


def codes_of_state(state):
    return sorted(((r["vec_id"], tuple(r["codes"])) for r in state.select("vec_id", "codes").collect()), key=str)


def brute_state(rows, books):
    out = []
    for i, v, _ in rows:
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = np.array([math.floor(256 * float(np.float32(x))) for x in v]).reshape(16, -1)
        out.append((i, tuple(int(((books[p] - q[p]) ** 2).sum(axis=1).argmin()) for p in range(16))))
    return sorted(out, key=str)


def test_net_displacement_is_no_more_than_the_drifts():
    rng = np.random.default_rng(2)
    history = [rng.integers(-50, 50, size=(9, 4)) for _ in range(4)]
    moved = vector_codes.Displacement(history)
    drift = sum(np.sqrt(((b - a) ** 2).sum(axis=1).astype(float))
                for a, b in zip(history, history[1:], strict=False))
    assert (moved.own[0] <= drift + 1e-9).all() and (moved.own[0] < drift - 1).any()
    stamps, codes = rng.integers(0, 4, 50), rng.integers(0, 9, 50)
    want = [max(moved.own[s, j] for j in range(9) if j != c) for s, c in zip(stamps, codes, strict=True)]
    assert np.allclose(moved.others(stamps, codes), want)
