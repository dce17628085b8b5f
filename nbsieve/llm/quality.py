"""Quality rules as a short-circuit cascade (operator 5), expressions only.

A rule is a metric and a rejecting test over it. On a bounded sample the
cascade measures what each rule costs (seconds over the sample) and what it
rejects (share of the sample), and orders the rules by rejection per cost. It
then evaluates a rule only for rows that no earlier rule rejected. The order
changes the work, never the verdict: a row is kept iff no rule rejects it.

Defined cases: null and empty texts have no words and fail the length rule; a
null metric never rejects; repeated rows are judged alike, each on its own; an
empty table gives no rows, and the rules keep their given order. Columns of
the input that clash with a metric's name are replaced by it.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nbsieve.llm.common import words_of

SYMBOL_CLASS = "[#*$%&|<>]+"
NOT_SPACE = "[^\\x20\\x09-\\x0D]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOL_PERCENT = 8      # of the characters in words
MAX_DUP_LINE_PERCENT = 50   # of the lines with a word
MAX_UPPER_PERCENT = 30      # A-Z, of the characters in words
MAX_MEAN_WORD = 20          # characters
SAMPLE_ROWS = 1024          # rows on which the order of the rules is estimated

ALIVE = "__alive"


@dataclass(frozen=True)
class Rule:
    name: str
    metrics: Callable[[DataFrame, Column], DataFrame]  # adds columns where the guard holds
    reject: Callable[[], Column]


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _bytes_of(pattern: str) -> Column:
    """Bytes of the text that match a pattern of ASCII characters."""
    return (F.octet_length(_text())
            - F.octet_length(F.regexp_replace(_text(), pattern, ""))).cast("long")


def add_words(df: DataFrame, on: Column) -> DataFrame:
    """``words`` as a column of its own, so that later expressions read it."""
    if "words" not in df.columns:
        df = df.withColumn("words", words_of(F.col("text")))
    return df.withColumn("n_words", F.when(on, F.size("words").cast("long")))


def add_word_chars(df: DataFrame, on: Column) -> DataFrame:
    chars = F.char_length(F.array_join("words", "")).cast("long")
    return df.withColumn("word_chars", F.when(on, chars))


def add_symbols(df: DataFrame, on: Column) -> DataFrame:
    return df.withColumn("n_symbols", F.when(on, _bytes_of(SYMBOL_CLASS)))


def add_dup_lines(df: DataFrame, on: Column) -> DataFrame:
    """``n_lines`` with a word, and those of them equal to an earlier one."""
    lines = F.filter(F.split(_text(), "\n"), lambda x: F.rlike(x, F.lit(NOT_SPACE)))
    df = df.withColumn("__lines", F.when(on, lines))
    return df.withColumn("n_lines", F.size("__lines").cast("long")).withColumn(
        "n_dup_lines",
        F.when(on, (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"))
    ).drop("__lines")


def add_repeat_words(df: DataFrame, on: Column) -> DataFrame:
    """Words in 3-word windows found twice or more in the text.

    Windows are compared by 64-bit hashes. The hash's low bits, followed by
    the window's start in as many bits as the text needs, make one long each;
    sorted, equal windows lie side by side (n log n for any length), and
    neighbours are compared by their whole hashes. Texts whose windows all
    differ skip this."""
    if "words" not in df.columns:
        df = df.withColumn("words", words_of(F.col("text")))
    h = F.transform("words", lambda x: F.xxhash64(x))
    df = df.withColumn("__h", F.when(on & (F.size("words") > 3), h))
    n = F.size("__h")
    pair = F.zip_with("__h", F.slice("__h", 2, n), lambda a, b: F.xxhash64(a, b))
    triple = F.slice(F.zip_with(pair, F.slice("__h", 3, n), lambda a, b: F.xxhash64(a, b)),
                     F.lit(1), n - 2)
    df = df.withColumn("__g", triple)
    g, bits = F.col("__g"), F.length(F.bin(F.size("__g")))
    df = df.withColumn("__bits", F.when(F.size(F.array_distinct(g)) < F.size(g), bits))
    bits = F.col("__bits")
    packed = F.transform(g, lambda x, i: F.call_function("shiftleft", x, bits).bitwiseOR(
        i.cast("long")))
    df = df.withColumn("__p", F.when(bits.isNotNull(), F.sort_array(packed)))
    p = F.col("__p")
    same = F.zip_with(p, F.slice(p, 2, F.size(p)), lambda a, b: F.call_function(
        "shiftrightunsigned", a.bitwiseXOR(b), bits) == 0)
    df = df.withColumn("__same", same)
    same = F.col("__same")
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
    at = lambda x: x.bitwiseAND(mask).cast("int")
    equal = lambda x, y: F.get(g, at(x)) == F.get(g, at(y))
    twice = F.filter(p, lambda x, i:
                     (F.get(same, i) & equal(x, F.get(p, i + 1)))
                     | ((i > 0) & F.get(same, i - 1) & equal(x, F.get(p, i - 1))))
    df = df.withColumn("__hit", F.sort_array(F.transform(twice, at)))
    hit = F.col("__hit")
    gaps = F.zip_with(hit, F.slice(hit, 2, F.size(hit)),
                      lambda x, y: F.least(F.lit(3), F.coalesce(y - x, F.lit(3))))
    total = F.aggregate(gaps, F.lit(0).cast("long"), lambda s, x: s + x)
    return df.withColumn("n_repeat_words", F.when(on, F.coalesce(total, F.lit(0).cast("long")))) \
             .drop("__h", "__g", "__bits", "__p", "__same", "__hit")


def add_upper(df: DataFrame, on: Column) -> DataFrame:
    return df.withColumn("n_upper", F.when(on, _bytes_of("[A-Z]+")))


def _nothing(df: DataFrame, on: Column) -> DataFrame:
    return df


def _all(*adders) -> Callable[[DataFrame, Column], DataFrame]:
    def add(df: DataFrame, on: Column) -> DataFrame:
        for a in adders:
            df = a(df, on)
        return df
    return add


SHORT = Rule("short", add_words, lambda: F.col("n_words") < MIN_WORDS)
REPEAT = Rule("repeat", _all(add_words, add_repeat_words),
              lambda: 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
SYMBOL = Rule("symbol", _all(add_words, add_word_chars, add_symbols),
              lambda: 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("word_chars"))
DUP_LINE = Rule("dup_line", add_dup_lines,
                lambda: 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines"))
LONG_WORD = Rule("long_word", _all(add_words, add_word_chars),
                 lambda: F.col("word_chars") > MAX_MEAN_WORD * F.col("n_words"))
SHOUT = Rule("shout", _all(add_words, add_word_chars, add_upper),
             lambda: 100 * F.col("n_upper") > MAX_UPPER_PERCENT * F.col("word_chars"))

RULES = (SHORT, REPEAT, SYMBOL, DUP_LINE, LONG_WORD, SHOUT)


def rule_order(docs: DataFrame, rules: tuple[Rule, ...] = RULES,
               sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by rejection per second, both measured on at most ``sample_rows``
    rows (the first that Spark finds: only booleans come to the driver)."""
    sample = docs.select("text").limit(sample_rows)
    gain = []
    for k, rule in enumerate(rules):
        flags = rule.metrics(sample, F.lit(True)).select(
            F.coalesce(rule.reject(), F.lit(False)).alias("no"))
        began = time.perf_counter()
        seen = [r["no"] for r in flags.collect()]
        cost = max(time.perf_counter() - began, 1e-3)
        gain.append((-(sum(seen) / max(1, len(seen))) / cost, k, rule))
    return [rule for _, _, rule in sorted(gain, key=lambda x: x[:2])]


def cascade(docs: DataFrame, rules: list[Rule], alive: Column | None = None) -> DataFrame:
    """``docs`` with the metrics that were evaluated, ``rejected_by`` (the
    first rule in this order that rejects the row, else null) and ``kept``."""
    df = docs.withColumn(ALIVE, F.lit(True) if alive is None else alive)
    df = df.withColumn("rejected_by", F.lit(None).cast("string"))
    for rule in rules:
        df = rule.metrics(df, F.col(ALIVE))
        no = F.col(ALIVE) & F.coalesce(rule.reject(), F.lit(False))
        df = df.withColumn("rejected_by", F.when(no, F.lit(rule.name))
                           .otherwise(F.col("rejected_by"))) \
               .withColumn(ALIVE, F.col(ALIVE) & F.col("rejected_by").isNull())
    return df.withColumnRenamed(ALIVE, "kept")


def op5_quality_rules(docs: DataFrame) -> DataFrame:
    """The contract's counts for every row; the other rules as a cascade over
    the rows that the base rule keeps."""
    order = rule_order(docs, (SYMBOL, DUP_LINE, LONG_WORD, SHOUT))
    df = docs.select("doc_id", "text")
    always = F.lit(True)
    for add in (add_words, add_word_chars, add_symbols, add_dup_lines, add_repeat_words):
        df = add(df, always)
    df = df.drop("words").withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                                     | (100 * F.col("n_repeat_words")
                                        > MAX_REPEAT_PERCENT * F.col("n_words")))
    have = {"symbol": _nothing, "dup_line": _nothing, "long_word": _nothing, "shout": add_upper}
    rules = [Rule(r.name, have[r.name], r.reject) for r in order]  # the rest is added above
    out = cascade(df, rules, ~F.col("base_failed"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` that no rule rejects, with their own columns."""
    carried = docs.select(F.col("text"), F.struct("*").alias("__row"))
    out = cascade(carried, rule_order(docs))
    # A filter on ``kept`` would be pushed below the projections that compute
    # it, with all of the cascade written out in it; a generator stops that.
    row = F.explode_outer(F.when(F.col("kept"), F.array("__row"))).alias("__row")
    return out.select(row).filter("__row IS NOT NULL").select("__row.*")


ORACLE = """
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
grams AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
twice AS (SELECT r, i FROM grams QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
covered AS (SELECT r, count(DISTINCT p) AS n
            FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r),
m AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) AS upper
  FROM w LEFT JOIN covered USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 100 * n_symbols > 8 * word_chars OR 100 * n_dup_lines > 50 * n_lines
       OR word_chars > 20 * n_words OR 100 * upper > 30 * word_chars) AS kept
FROM b"""
