"""Text cleaning, tokenising and token features as Spark column expressions.

Everything here is a built-in expression (regex + higher-order array
functions), so it runs inside whole-stage codegen with no Python worker.

Pipeline (F1-F9): lower -> URLs -> e-mails -> everything but a-z is a
separator -> tokeniser contractions -> split -> drop stopwords and
1-letter tokens -> lemma lookup -> bigrams -> unigrams ++ bigrams.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nbsieve import config as C
from nbsieve.session import cut_lineage


_WS = f"[{C.PY_WHITESPACE}]"


def py_strip(c: Column) -> Column:
    """Unicode whitespace off both ends (Spark's ``trim`` takes spaces only)."""
    return F.regexp_replace(c, f"^{_WS}+|{_WS}+$", "")


def is_blank(c: Column) -> Column:
    """Nothing but Unicode whitespace (NULL: NULL)."""
    return ~c.rlike(f"[^{C.PY_WHITESPACE}]")


# Only the stopwords a token (a-z, length > 1) could equal; more than ten
# literals, so the optimizer turns the IN into a hash-set lookup.
STOP_TOKENS = [w for w in C.STOPWORDS_EN if w.isalpha() and len(w) > 1]


# One pass inserts the split of every contraction: "cannot" -> "can not".
_CONTRACTION_RE = r"\b(" + "|".join(
    f"{a}(?={b}\\b)" for a, b in C.CONTRACTIONS) + r")"


def _url_step(s: Column) -> Column:
    # Cheap substring guard skips the regex for texts that cannot match.
    return F.when(s.contains("http") | s.contains("www."),
                  F.regexp_replace(s, C.URL_PATTERN, f" {C.URL_TOKEN} ")).otherwise(s)


def _email_step(s: Column) -> Column:
    return F.when(s.contains("@"),
                  F.regexp_replace(s, C.EMAIL_PATTERN_LINEAR, f" {C.EMAIL_TOKEN} ")).otherwise(s)


def _words_step(s: Column) -> Column:
    # Everything that is not a-z becomes a separator (Python's \s is also a
    # separator, so the whitespace definition does not matter here), then
    # the tokeniser contractions are split.
    s = F.regexp_replace(s, "[^a-z]+", " ")
    return F.regexp_replace(s, _CONTRACTION_RE, "$1 ")


def clean_text(text: Column) -> Column:
    """F1-F5 on one column (small inputs; for tables use ``add_tokens``,
    which stages each step so no step is evaluated twice)."""
    return _words_step(_email_step(_url_step(F.lower(text))))


def raw_words(text: Column) -> Column:
    """word tokens of the cleaned text (may contain stopwords)."""
    return _split_words(clean_text(text))


def _split_words(cleaned: Column) -> Column:
    return F.split(F.trim(cleaned), " ")


def _content_filter(words: Column) -> Column:
    return F.filter(words, lambda t: (F.length(t) > 1) & ~t.isin(*STOP_TOKENS))


def content_words(text: Column) -> Column:
    """drop stopwords and 1-letter tokens (tested before lemmatising)."""
    return _content_filter(raw_words(text))


def bigrams(words: Column) -> Column:
    """Adjacent pairs joined by '_'. ``words`` must be a column reference
    (lambdas re-evaluate any outer expression once per element)."""
    return F.when(F.size(words) < 2, F.array().cast("array<string>")).otherwise(
        F.transform(
            F.sequence(F.lit(1), F.size(words) - 1),
            lambda i: F.concat(F.get(words, i - 1), F.lit("_"), F.get(words, i)),
        )
    )


def add_tokens(df: DataFrame, text_col: str = "text", out: str = "tokens",
               lemmas: DataFrame | Callable[[DataFrame], DataFrame] | None = None,
               keep=None) -> DataFrame:
    """F9 as a transformation: unigrams followed by bigrams.

    Each string step is its own projected column: a value used by a guard
    and by its regex is computed once (the optimizer keeps a projection
    whose non-trivial output is read more than once), and lambdas only
    read attributes."""
    keep = list(keep) if keep is not None else [c for c in df.columns if c != text_col]
    x = df.select(*keep, F.lower(F.col(text_col)).alias("__s0"))
    x = x.select(*keep, _url_step(F.col("__s0")).alias("__s1"))
    x = x.select(*keep, _email_step(F.col("__s1")).alias("__s2"))
    x = x.select(*keep, _content_filter(_split_words(_words_step(F.col("__s2")))).alias("__u"))
    if lemmas is not None:
        x = lemmatise_by_join(x, "__u", lemmas)
    return x.select(*keep, F.concat(F.col("__u"), bigrams(F.col("__u"))).alias(out))


_LEMMA_BYTES = 96           # of a row of the broadcast dictionary


def lemmatise_by_join(df: DataFrame, words_col: str,
                      lemmas: DataFrame | Callable[[DataFrame], DataFrame]) -> DataFrame:
    """every word of the array ``words_col`` replaced by its lemma in
    ``lemmas(token, lemma)``, order kept; words without one stay. ``lemmas`` may
    also be what makes that table from ``(words)``, the stored arrays.

    A join on the word, so the dictionary may be of any size: the words that it
    changes are broadcast where their real number allows, else shuffled to.
    Only the places that change are gathered by row, in order; the gaps between
    them are filled with NULLs, which leave the word as it is."""
    row = "__row"
    # Numbered and stored before it is read more than once: a row keeps its number.
    x = cut_lineage(df.withColumn(row, F.monotonically_increasing_id()))
    if callable(lemmas):
        lemmas = lemmas(x.select(F.col(words_col).alias("words")))
    changed = lemmas.groupBy("token").agg(F.min("lemma").alias("lemma")).where("lemma <> token")
    if changed.count() * _LEMMA_BYTES <= C.BROADCAST_MAX_BYTES:
        changed = F.broadcast(changed)
    places = x.select(row, F.posexplode(words_col).alias("pos", "token")).join(changed, "token")
    back = places.groupBy(row).agg(F.sort_array(F.collect_list(F.struct("pos", "lemma"))).alias("__c"))
    before = lambda k: F.when(k == 0, F.lit(-1)).otherwise(F.get("__c", k - 1)["pos"])
    at = F.flatten(F.transform("__c", lambda s, k: F.concat(
        F.array_repeat(F.lit(None).cast("string"), s["pos"] - before(k) - 1), F.array(s["lemma"]))))
    x = x.join(back, row, "left").withColumn("__at", at)
    # Read twice, ``__at`` stays a column of its own and is not formed anew per word.
    out = F.when(F.col("__at").isNull(), F.col(words_col)).otherwise(
        F.transform(words_col, lambda w, i: F.coalesce(F.get("__at", i), w)))
    return x.withColumn(words_col, F.coalesce(out, F.array().cast("array<string>"))) \
        .drop("__at", "__c", row)


# ---------------------------------------------------------------------------
# In-row term frequencies: sort the token array, run-length encode it. This
# gives (token, tf) per document without an explode + groupBy shuffle.
# ---------------------------------------------------------------------------

TERMS_TYPE = "array<struct<token:string,tf:int>>"


def add_term_frequencies(df: DataFrame, tokens_col: str = "tokens", out: str = "terms",
                         keep=None) -> DataFrame:
    """``out`` = ARRAY<STRUCT<token, tf>> of the distinct tokens of each row,
    in token order: sort once (n log n), mark run starts, take run lengths.
    Each stage is its own column so no lambda re-evaluates the sort."""
    keep = list(keep) if keep is not None else list(df.columns)
    x = df.select(*keep, F.sort_array(F.col(tokens_col)).alias("__s"))
    s = F.col("__s")
    n = F.size(s)
    x = x.select(*keep, "__s", F.when(n == 0, F.array().cast("array<int>")).otherwise(
        F.filter(F.sequence(F.lit(0), n - 1),
                 lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))).alias("__st"))
    st = F.col("__st")
    runs = F.transform(
        st,
        lambda b, k: F.struct(
            F.get(s, b).alias("token"),
            (F.coalesce(F.get(st, k + 1), n) - b).alias("tf"),
        ),
    )
    return x.select(*keep, runs.cast(TERMS_TYPE).alias(out))


# ---------------------------------------------------------------------------
# Gaussian features
# ---------------------------------------------------------------------------

def _count_chars(text: Column, char_class: str) -> Column:
    """Number of characters of ``text`` in a regex character class."""
    return F.length(text) - F.length(F.regexp_replace(text, char_class, ""))


def gaussian_features(tok: Column, raw_text: Column | None = None) -> list[Column]:
    """The ten features in vector order. ``raw_text=None`` is the parity mode:
    the text is the tokens joined by a space, exactly as training and
    prediction call it."""
    length = F.size(tok)
    unique = F.size(F.array_distinct(tok))
    total_len = F.aggregate(tok, F.lit(0).cast("bigint"), lambda a, t: a + F.length(t))
    avg_len = total_len / F.greatest(F.lit(1), length)
    url_count = F.size(F.filter(tok, lambda t: t == C.URL_TOKEN))
    email_count = F.size(F.filter(tok, lambda t: t == C.EMAIL_TOKEN))
    if raw_text is None:
        # An empty token list gives an empty text (Python: '' is falsy).
        text = F.array_join(tok, " ")
        sentences = F.greatest(F.lit(1), F.floor(length / 10)).cast("bigint")
    else:
        text = raw_text
        sentences = F.greatest(F.lit(1), F.size(F.split(text, r"[.!?]+", -1)) - 1)
    text_len = F.greatest(F.lit(1), F.length(text))
    if raw_text is None:
        # Token text is ASCII (a-z, '_', space): count characters with
        # translate (no regex pass); exact for that alphabet.
        letters_up = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
        alnum_sp = "abcdefghijklmnopqrstuvwxyz" + letters_up + "0123456789 "
        punct = F.length(text) - F.length(F.translate(text, C.PUNCTUATION_CHARS, ""))
        letters = F.length(text) - F.length(F.translate(text, alnum_sp[:52], ""))
        upper = F.length(text) - F.length(F.translate(text, letters_up, ""))
        digits = F.length(text) - F.length(F.translate(text, "0123456789", ""))
        special = F.length(F.translate(text, alnum_sp, ""))
    else:
        punct = _count_chars(text, "[" + "".join("\\" + c for c in C.PUNCTUATION_CHARS) + "]")
        letters = _count_chars(text, r"\p{L}")
        upper = _count_chars(text, r"\p{Lu}")
        digits = _count_chars(text, r"\p{Nd}")
        special = _count_chars(text, r"[^\p{L}\p{N}" + C.PY_WHITESPACE + "]")
    feats = [
        length.cast("double"),
        unique.cast("double"),
        avg_len.cast("double"),
        url_count.cast("double"),
        email_count.cast("double"),
        (punct / text_len).cast("double"),
        (upper / F.greatest(F.lit(1), letters)).cast("double"),
        (digits / text_len).cast("double"),
        (special / text_len).cast("double"),
        sentences.cast("double"),
    ]
    return [f.alias(name) for f, name in zip(feats, C.GAUSSIAN_FEATURES)]


def unigram_only(tok: Column) -> Column:
    """Unigrams are the tokens without '_'."""
    return F.filter(tok, lambda t: ~t.contains("_"))
