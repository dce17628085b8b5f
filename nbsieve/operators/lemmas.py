"""Lemmas (F7): endings are detached and the results looked up in a lexicon.

A word is reduced as a verb first, and what comes out of that as a noun. For
one part of speech the candidates are the word itself and every form that one
detached ending gives; those that the lexicon knows count, and the shortest one
is the lemma (of equal length: the word, then in order of the endings). Only if
none is known, endings are detached from the forms again, and so on until a
form is known or none is left; without a known form the word stays. Words with
an exceptional form (``went``) have their listed lemmas as candidates instead.

All of it runs over distinct words, not occurrences: candidates are an array
expression, the lexicon is a semi join. Without a lexicon the corpus's own
vocabulary serves as one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# FIXED VALUES: endings and what replaces them, per part of speech, in order.
ENDINGS = {
    "v": (("s", ""), ("ies", "y"), ("es", "e"), ("es", ""), ("ed", "e"), ("ed", ""),
          ("ing", "e"), ("ing", "")),
    "n": (("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"),
          ("shes", "sh"), ("men", "man"), ("ies", "y")),
}
ORDER = ("v", "n")


def detached(word: Column, pos: str) -> Column:
    """Forms of ``word`` with one ending detached, in order of the endings."""
    forms = [F.when(F.endswith(word, F.lit(end)), F.concat(
        F.substring(word, F.lit(1), F.length(word) - len(end)), F.lit(new)))
        for end, new in ENDINGS[pos]]
    return F.array_compact(F.array(*forms))


def candidates(word: Column, pos: str) -> Column:
    """Array of (depth, form): the word and its forms at depth 0, forms of
    forms at the next depths. An ending takes a letter at least (but for one
    that cannot follow itself), so a word's length bounds the depth."""
    start = F.struct(detached(word, pos).alias("now"), F.array_union(
        F.array(word), detached(word, pos)).alias("zero"), F.array().cast(
        "array<struct<depth:int,form:string>>").alias("later"))

    def deeper(s: Column, depth: Column) -> Column:
        now = F.array_distinct(F.flatten(F.transform(s["now"], lambda w: detached(w, pos))))
        return F.struct(now.alias("now"), s["zero"].alias("zero"), F.concat(s["later"], F.transform(
            now, lambda w: F.struct(depth.alias("depth"), w.alias("form")))).alias("later"))

    found = F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(word), F.lit(1))), start, deeper)
    return F.concat(F.transform(found["zero"], lambda w: F.struct(
        F.lit(0).alias("depth"), w.alias("form"))), found["later"])


def nearest(word: Column, pos: str) -> Column:
    """The candidates of depth 0 alone, in the same places."""
    return F.transform(F.array_union(F.array(word), detached(word, pos)), lambda w: F.struct(
        F.lit(0).alias("depth"), w.alias("form")))


def _reduced(words: DataFrame, form: str, pos: str, lexicon: DataFrame,
             exceptions: DataFrame | None, closed: bool) -> DataFrame:
    """``words`` with ``form`` replaced by its lemma as ``pos``. Deeper candidates
    are formed only for words without a known one at depth 0; ``closed``: the
    lexicon holds every word, so there are none."""
    forms = words.select(F.col(form).alias("__word")).distinct()

    def listing(of: DataFrame, make) -> DataFrame:
        return of.select("__word", F.posexplode(make(F.col("__word"), pos)).alias("at", "c")) \
            .select("__word", "c.depth", "at", "c.form")

    listed = listing(forms, nearest)
    if exceptions is not None:
        own = exceptions.where(F.col("pos") == pos).select(
            F.col("form").alias("__word"), F.col("lemma").alias("form")).distinct()
        special = own.join(forms, "__word", "left_semi")
        listed = listed.join(special.select("__word").distinct(), "__word", "left_anti") \
            .unionByName(special.select("__word", F.lit(0).alias("depth"), F.lit(1).alias("at"), "form")) \
            .unionByName(special.select("__word", F.lit(0).alias("depth"), F.lit(0).alias("at"),
                                        F.col("__word").alias("form")).distinct())
    known = lexicon.where(F.col("pos") == pos).select(F.col("lemma").alias("form")).distinct()

    def best_of(listed: DataFrame) -> DataFrame:
        best = listed.join(known, "form", "left_semi").groupBy("__word").agg(F.min(
            F.struct("depth", F.length("form").alias("n"), "at", "form")).alias("b"))
        return best.select("__word", F.col("b.form").alias("__lemma"))

    best = best_of(listed)
    if not closed:
        left = forms.join(best, "__word", "left_anti")
        if exceptions is not None:
            left = left.join(special, "__word", "left_anti")
        best = best.unionByName(best_of(listing(left, candidates)))
    return words.join(best, F.col(form) == F.col("__word"), "left").withColumn(
        form, F.coalesce("__lemma", form)).drop("__word", "__lemma")


def lemma_table(words: DataFrame, lexicon: DataFrame | None = None,
                exceptions: DataFrame | None = None) -> DataFrame:
    """``(token, lemma)`` of the distinct ``words(token)``, verb then noun.

    ``lexicon(pos, lemma)`` and ``exceptions(pos, form, lemma)`` are tables of any
    size, pos ``v`` or ``n``; without a lexicon every word is one in both."""
    words = words.select("token").distinct()
    closed = lexicon is None
    if closed:
        lexicon = words.select(F.explode(F.array(*map(F.lit, ORDER))).alias("pos"),
                               F.col("token").alias("lemma"))
    out = words.withColumn("lemma", F.col("token"))
    for pos in ORDER:
        out = _reduced(out, "lemma", pos, lexicon, exceptions, closed)
    return out


def corpus_words(words_of_documents: DataFrame, column: str) -> DataFrame:
    """``(token)``: the distinct words of an array column."""
    return words_of_documents.select(F.explode(F.col(column)).alias("token")).distinct()
