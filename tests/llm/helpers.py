"""Small tables with the awkward rows every operator must take."""

from __future__ import annotations

import random
import re

WORD = re.compile("[^\\x20\\x09-\\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(rng: random.Random, n: int, alphabet: str = "abcdefghij", most: int = 5) -> str:
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(1, most)))
                    for _ in range(n))


def shingles(text: str | None) -> frozenset:
    w = [x.translate(FOLD) for x in WORD.findall(text or "")]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def frame(spark, texts, ids=None, langs=None):
    ids = list(range(len(texts))) if ids is None else ids
    langs = ["en"] * len(texts) if langs is None else langs
    rows = [(i, t, la, "s", None if t is None else len(t))
            for i, t, la in zip(ids, texts, langs, strict=True)]
    return spark.createDataFrame(rows, DOCS)


def clashing(df):
    """The same rows with columns named as operators name theirs."""
    from pyspark.sql import functions as F
    for c in ("row", "words", "n_words", "size", "part", "chunk", "kept", "key", "label", "turns",
              "spans", "n_bytes", "train", "position", "shard", "bound", "rep", "score", "doc"):
        df = df.withColumn(c, F.lit("x"))
    return df


AWKWARD = [None, "", "   \n\t ", "one", "two words", "a b c d", "a b c d e", "É ü ß 漢字 🙂 x y",
           "\u00a0\u2003", "...", "x" * 5000, "same text here twice over again", "zero\x00byte a b c d",
           "same text here twice over again"]


def collected(df):
    return [r.asDict() for r in df.collect()]
