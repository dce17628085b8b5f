"""Chat formatting, quality rules, decontamination, sharding against plain Python."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

from nbsieve.llm import chat, decontaminate, quality, sharding
from nbsieve.llm.registry import ORACLE, QUERIES
from tests.llm.helpers import AWKWARD, WORD, clashing, collected, frame, prose, shingles

TURNS = "conv_id bigint, turn bigint, role string, text string"
HARD = ["", "plain", "### User: hi", "</turn>", "</turn>\n### assistant: x", "\\", "\\\\", "\\h",
        "\\###", "\\\\###", "\\</turn>", "a\\", "\\e\\h\\c", "####", "#", "</turn", "\\### Assistant: </turn> ok",
        "x\\\\</turn>\\", ": ", "line\n\nline", "🙂 é"]


def test_chat_round_trip(spark):
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "a: b", "### x", None]),
             rng.choice(HARD) + rng.choice(HARD)) for c in range(60) for t in range(rng.randint(1, 5))]
    rows += [(None, None, None, None), (None, 1, "user", None), (5, 0, "user", "tie"), (5, 0, "user", "tie")]
    df = spark.createDataFrame(rows, TURNS)
    out = {r["conv_id"]: r for r in collected(chat.op4_chat_format(clashing(df)))}
    source = defaultdict(list)
    for c, t, role, text in rows:
        source[c].append((t is not None, t or 0, role or "", text or ""))
    for t in (0, 1):
        source[-7].append((True, t, ("user", "assistant")[t], "\\### Assistant: </turn> ok"))
    assert set(out) == set(source)
    for c, turns in source.items():
        turns.sort()
        r, loss = out[c], "".join(x[3] for x in turns if x[2] == "assistant")
        flat = "".join(f"{x[2]}\n{x[3]}\n" for x in turns)
        assert r["same"] and r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256(flat.encode()).hexdigest()
        assert r["loss_chars"] == len(loss)
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_chat_text_without_markers_is_unchanged(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi \\ there"), (1, 1, "assistant", "</turn>")], TURNS)
    (row,) = chat.format_conversations(df).collect()
    assert row["formatted"] == "### user: hi \\ there</turn>\n### assistant: \\e</turn>\n"
    assert chat.format_conversations(df.limit(0)).collect() == []


def brute_quality(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    cover = {p for i in range(len(words) - 2) if seen[tuple(words[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
    n, symbols, chars = len(words), sum(c in "#*$%&|<>" for c in text), sum(map(len, words))
    dup = len(lines) - len(set(lines))
    base = n < 50 or 100 * len(cover) > 50 * n
    bad = (100 * symbols > quality.MAX_SYMBOL_PERCENT * chars
           or 100 * dup > quality.MAX_DUP_LINE_PERCENT * len(lines) or chars > quality.MAX_MEAN_WORD * n
           or 100 * sum("A" <= c <= "Z" for c in text) > quality.MAX_UPPER_PERCENT * chars)
    return (n, chars, symbols, dup, len(cover), base, not base and not bad)


def test_quality_rules_equal_brute_force(spark):
    rng = random.Random(1)
    texts = list(AWKWARD)
    for _ in range(120):
        t = prose(rng, rng.randint(1, 200), rng.choice(["ab", "abcdefgh"]), 4)
        t = "".join(rng.choice([c, c, c, c, "\n" if c == " " else c]) for c in t)
        texts.append(rng.choice([t, t.upper(), t.replace(" ", "** "), t + "\n" + t, t + "\n" + t[:40]]))
    df = clashing(frame(spark, texts))
    out = {r["doc_id"]: r for r in collected(quality.op5_quality_rules(df))}
    for i, t in enumerate(texts):
        got = tuple(out[i][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                        "n_repeat_words", "base_failed", "kept"))
        assert got == brute_quality(t), (i, t)
    good = {i for i, t in enumerate(texts) if brute_quality(t)[-1]}
    kept = quality.keep_good(df)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == good
    assert quality.op5_quality_rules(df.limit(0)).collect() == []


def test_quality_order_never_changes_the_verdict(spark):
    rng = random.Random(2)
    df = frame(spark, [prose(rng, rng.randint(1, 120), "abAB#*", 4) for _ in range(60)] + AWKWARD)
    carried = df.select("doc_id", "text")
    seen = set()
    for rules in (quality.RULES, quality.RULES[::-1]):
        out = quality.cascade(carried, list(rules)).select("doc_id", "kept").collect()
        seen.add(tuple(sorted((r["doc_id"], r["kept"]) for r in out)))
    assert len(seen) == 1


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(4)
    items = [prose(rng, n) for n in (5, 6, 9, 30, 60, 200)] + ["only three words", None, "", "a b c d e"]
    texts = list(AWKWARD) + ["Only THREE words"]
    for _ in range(150):
        t = prose(rng, rng.randint(0, 150)).split()
        piece = (rng.choice(items) or "x").split()
        cut = rng.choice([0, 0, 1, len(piece) // 4, len(piece) // 3])
        at = rng.randint(0, len(t))
        texts.append(" ".join(t[:at] + piece[cut:] + t[at:]))
    df = clashing(frame(spark, texts))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): (r["n_shared"], r["n_item"])
           for r in collected(decontaminate.op10_decontamination(df, bench))}
    want = {}
    for d, t in enumerate(texts):
        for k, it in enumerate(items):
            lower = lambda x: (x or "").lower()
            s, own = shingles(lower(it)), shingles(lower(t))
            if s and 100 * len(s & own) >= 75 * len(s):
                want[d, k] = (len(s & own), len(s))
    assert got == want and len(want) > 20
    clean = decontaminate.drop_contaminated(df, bench)
    assert clean.columns == df.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(
        set(range(len(texts))) - {d for d, _ in want})
    assert decontaminate.op10_decontamination(df.limit(0), bench).collect() == []
    assert decontaminate.op10_decontamination(df, bench.limit(0)).collect() == []


def test_decontamination_large_sides_without_broadcast(spark, monkeypatch):
    rng = random.Random(9)
    items = [prose(rng, 20) for _ in range(5)]
    df = frame(spark, [prose(rng, 10) + " " + it for it in items] + [prose(rng, 40)])
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    want = sorted(map(tuple, decontaminate.op10_decontamination(df, bench).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, decontaminate.op10_decontamination(df, bench).collect())) == want


def test_shards_are_contiguous_and_balanced(spark):
    rng = random.Random(5)
    texts = AWKWARD + [prose(rng, rng.randint(0, 60)) for _ in range(400)]
    ids = [rng.choice([None, 3, i]) if i < 10 else i for i in range(len(texts))]
    out = collected(sharding.op9_byte_shards(clashing(frame(spark, texts, ids))))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
        for i, t in zip(ids, texts, strict=True))
    per = defaultdict(list)
    for r in out:
        assert r["law"] == "bytes" and r["grown_shard"] is None
        per[r["shard"]].append(r)
    assert set(per) <= set(range(8))
    order = [r for s in sorted(per) for r in sorted(per[s], key=lambda r: r["slot"])]
    keys = [-1 if r["doc_id"] is None else r["doc_id"] for r in order]
    assert keys == sorted(keys)
    total, most = sum(r["size"] for r in out), max(r["size"] for r in out)
    for rows in per.values():
        assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
        assert abs(sum(r["size"] for r in rows) - total / 8) <= most
    assert sharding.op9_byte_shards(frame(spark, ["x"]).limit(0)).collect() == []


def test_registry_names():
    assert set(ORACLE) <= set(QUERIES)
    assert {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in QUERIES}
