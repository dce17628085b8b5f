"""Sender rules, request scoring and badges.

A rule set is a bounded list of (regex, boost) -- configuration, not data.
It is folded into one expression ``greatest(when(rlike(..)), ...)`` that
runs per row inside codegen: no join, no pairs. ``(?dU)``: '.' stops only
at '\\n' and ``\\b``/``\\w`` are Unicode-aware, as in Python.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nbsieve import config as C
from nbsieve.functions.text import is_blank
from nbsieve.operators import nb
from nbsieve.operators.ordered import positions
from nbsieve.session import cut_lineage


GRAM = 4                    # characters of an index key
SMALL_RULES = 50_000        # rules that are sent to every task, with their keys
FEW_PATTERNS = 64           # patterns without a literal that become one expression


def required_literals(rules: DataFrame) -> DataFrame:
    """``rules(pattern, boost)`` with ``literal``: a run of four or more of
    a-z and 0-9 that every match must contain, and ``at_start``: whether the
    match has it at the start of a word. Among several, one at a word's start
    is taken, then the longest. Runs are what remains outside groups, classes,
    escapes and quantified characters; a pattern with an alternative outside a
    group, flags, code points, references or quotations has none ('')."""
    p = F.regexp_replace("pattern", r"\\b", "^")
    p = F.regexp_replace(p, r"\\.", " ")
    p = F.regexp_replace(p, r"\[[^\]]*\]", " ")
    for _ in range(3):                                   # nested groups, inner ones first
        p = F.regexp_replace(p, r"\([^()]*\)", " ")
    p = F.regexp_replace(p, r".([?*]|\{[^}]*\})", " ")
    unsure = F.col("pattern").rlike(r"\(\?[^:]|\\[0-9acekpuxGNPQX]|\[[^\]]*[\[&]") \
        | p.rlike(r"[|()\[\]]")
    found = F.regexp_extract_all(p, F.lit(rf"(\^?[a-z0-9]{{{GRAM},}})"), F.lit(1))
    best = F.array_max(F.transform(F.when(unsure, F.array().cast("array<string>")).otherwise(found),
                                   lambda x: F.struct(x.startswith("^").alias("at_start"),
                                                      F.length(x).alias("n"),
                                                      F.ltrim(x, F.lit("^")).alias("literal"))))
    return rules.select("pattern", F.col("boost").cast("double").alias("boost"), best.alias("best")) \
        .select("pattern", "boost", F.coalesce("best.literal", F.lit("")).alias("literal"),
                F.coalesce("best.at_start", F.lit(False)).alias("at_start"))


def rule_keys(rules: DataFrame) -> DataFrame:
    """One index key per rule with a literal: '^' and its first characters where
    it stands at a word's start, else the gram of it that fewest rules share."""
    number = F.sequence(F.lit(1), F.length("literal") - (GRAM - 1))
    inner = rules.where("literal <> '' AND NOT at_start").withColumn(
        "key", F.explode(F.array_distinct(F.transform(
            number, lambda i: F.substring("literal", i, GRAM)))))
    shared = inner.groupBy("key").agg(F.count(F.lit(1)).alias("shared"))
    inner = inner.join(shared, "key").groupBy("pattern", "boost", "literal", "at_start").agg(
        F.min_by("key", F.struct("shared", "key")).alias("key"))
    start = rules.where("literal <> '' AND at_start").withColumn(
        "key", F.concat(F.lit("^"), F.substring("literal", 1, GRAM)))
    return start.unionByName(inner)


def _keyed_runs(low: Column, inside: bool) -> Column:
    """Distinct (run, key) of a lower-cased text: every word with the key of its
    start and, with ``inside``, every run of a-z and 0-9 with each of its grams."""
    runs = F.array_distinct(F.regexp_extract_all(low, F.lit(rf"(?U)\w{{{GRAM},}}"), F.lit(0)))
    out = F.transform(runs, lambda x: F.struct(
        x.alias("run"), F.concat(F.lit("^"), F.substring(x, 1, GRAM)).alias("key")))
    if inside:
        plain = F.array_distinct(F.regexp_extract_all(low, F.lit(f"[a-z0-9]{{{GRAM},}}"), F.lit(0)))
        out = F.concat(out, F.flatten(F.transform(plain, lambda x: F.transform(
            F.sequence(F.lit(1), F.length(x) - (GRAM - 1)),
            lambda i: F.struct(x.alias("run"), F.substring(x, i, GRAM).alias("key"))))))
    return out


def boosts_by_table(docs: DataFrame, rules: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """A29 for a rules *table* ``(pattern, boost)``: ``(id, boost)`` of every
    document, 0 where no rule matches.

    Rules with a literal are ranked by boost and form an index by one key each
    (``rule_keys``). A document brings its distinct words and runs with their
    keys; a rule is its candidate where a run with the rule's key holds the
    literal. First only the best candidate is kept, one small row per document,
    and its pattern is tried on the text. Only documents on which it fails gather
    their other candidates, which are tried from the highest boost on until one
    matches. Up to ``SMALL_RULES`` rules are sent to every task, beyond that the
    keys meet by a shuffle. Up to ``FEW_PATTERNS`` patterns without a literal are
    one expression over the documents, more are tried pair by pair."""
    r = required_literals(rules.where("pattern IS NOT NULL AND boost > 0").distinct())
    r = cut_lineage(r)
    n, inside, loose = r.agg(F.count(F.lit(1)), F.count_if(F.expr("literal <> '' AND NOT at_start")),
                             F.count_if(F.expr("literal = ''"))).first()
    ranked = positions(r.where("literal <> ''"), [F.col("boost"), F.col("pattern")], "rank")
    index = cut_lineage(rule_keys(r).join(ranked.select("pattern", "boost", "rank"), ["pattern", "boost"]))
    small = F.broadcast if n <= SMALL_RULES else (lambda x: x)
    low = F.col("__low")
    d = docs.select(F.col(id_col).alias("__id"), F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("__low"))

    def candidates(rows: DataFrame, *carried: str) -> DataFrame:
        keyed = rows.select("__id", *carried, F.inline(_keyed_runs(low, bool(inside))))
        held = F.when(F.col("at_start"), F.startswith("run", "literal")).otherwise(F.contains("run", "literal"))
        return keyed.join(small(index), "key").where(held)

    best = candidates(d).groupBy(F.col("__id").alias("__best_id")).agg(F.max("rank").alias("rank"))
    best = best.join(small(index.select("rank", "pattern", "boost")), "rank")
    hit = F.rlike(low, F.concat(F.lit("(?dU)"), F.col("pattern")))
    tried = d.join(best, F.col("__id").eqNullSafe(F.col("__best_id")), "left").select(
        "__id", "__low", F.col("rank").alias("__rank"),
        F.when(F.col("rank").isNull(), 0.0).when(hit, F.col("boost")).alias("__found"))
    others = candidates(tried.where("__found IS NULL"), "__rank").where("rank < __rank") \
        .groupBy(F.col("__id").alias("__other_id")).agg(F.sort_array(F.collect_set(
            F.struct("rank", "boost", "pattern", "literal")), asc=False).alias("others"))
    later = F.aggregate("others", F.lit(None).cast("double"), lambda found, rule: F.coalesce(
        found, F.when(F.contains(low, rule["literal"])
                      & F.rlike(low, F.concat(F.lit("(?dU)"), rule["pattern"])), rule["boost"])))
    boosts = [F.coalesce("__found", later, F.lit(0.0))]
    if 0 < loose <= FEW_PATTERNS:
        boosts.append(sender_boost(low, [(x["pattern"], x["boost"]) for x in r.where("literal = ''").collect()]))
    out = tried.join(others, F.col("__found").isNull() & F.col("__id").eqNullSafe(F.col("__other_id")), "left") \
        .select(F.col("__id").alias(id_col), F.greatest(F.lit(0.0), *boosts).alias("boost"))
    if loose > FEW_PATTERNS:
        pair = F.expr("rlike(__low, concat('(?dU)', pattern))")
        more = d.join(r.where("literal = ''").select("pattern", "boost"), pair) \
            .groupBy(F.col("__id").alias("__more_id")).agg(F.max("boost").alias("__more"))
        out = out.join(more, F.col(id_col).eqNullSafe(F.col("__more_id")), "left") \
            .withColumn("boost", F.greatest("boost", "__more"))
    return out.select(id_col, "boost")


def sender_boost(text: Column, rules=C.SENDER_RULES) -> Column:
    """The maximum boost of the matching rules, 0 when none."""
    low = F.lower(text)
    parts = []
    for p, b in rules:
        m = None if "|" in p else re.match(r"\\b([a-z0-9]+)(?![?*{])", p)
        hit = low.rlike("(?dU)" + p)
        if m:
            # A match starts with this literal, so containing it is
            # necessary: a cheap substring test skips most rows.
            hit = low.contains(m.group(1)) & hit
        parts.append(F.when(hit, F.lit(float(b))))
    return F.greatest(F.lit(0.0), *parts) if len(parts) > 1 else \
        F.coalesce(parts[0], F.lit(0.0)) if parts else F.lit(0.0)


def apply_boost(p_spam: Column, boost: Column) -> Column:
    """M8: min(1, p + boost) when a rule matched, else p."""
    return F.when(boost > 0, F.least(F.lit(1.0), p_spam + boost)).otherwise(p_spam)


def score_requests(model: nb.NBModel, requests: DataFrame, rules=C.SENDER_RULES,
                   alpha: float = C.ALPHA,
                   confidence_threshold: float = C.CONFIDENCE_THRESHOLD) -> DataFrame:
    """I5 over a requests table ``(request_id, message, decision_threshold,
    use_sender_boost)``; NULL parameters take the defaults (0.65, false).

    P8: a blank message is ``status='error'`` (the row stays, the job does
    not abort); no tokens -> ``uncertain`` with confidence 0 and 0.5/0.5.
    With the boost flag, a boosted P(spam) different from the raw one
    replaces both probabilities; only when it exceeds 1 - threshold does
    it also replace the verdict (otherwise the old verdict stays and
    ``boost_applied`` tells so)."""
    msg = F.coalesce(F.col("message"), F.lit(""))
    # Row-level values first (boost, blank flag): the per-request regroup
    # then carries two small columns instead of the message text.
    req = requests.select(
        "request_id", msg.alias("text"),
        F.coalesce(F.col("decision_threshold"), F.lit(C.REQUEST_THRESHOLD)).alias("thr"),
        F.coalesce(F.col("use_sender_boost"), F.lit(False)).alias("use_boost"),
        sender_boost(msg, rules).alias("boost"),
        is_blank(msg).alias("blank"))
    keep = ["thr", "use_boost", "boost", "blank"]
    tok = nb.tokenize(req.withColumnRenamed("request_id", "doc_id"), keep=["doc_id", *keep])
    frame = nb.with_model_constants(
        nb.scored_frame(model, tok, [alpha], keep=("doc_id", *keep), with_features=False),
        model, [alpha])
    lp = nb.log_posteriors(frame, model, [alpha], ("multinomial",))
    x = frame.select(F.col("doc_id").alias("request_id"), *keep,
                     "n_tokens", *nb.posterior_struct(lp[1], lp[0], F.col("n_tokens")))
    d = nb.decide(F.col("p_spam"), F.col("p_ham"), F.col("thr"), F.lit(confidence_threshold))
    x = x.select("*", *d)
    x = x.withColumn("explanation", nb.explanation(
        F.col("raw_prediction"), F.col("confidence"), F.col("p_spam"), F.col("p_ham"),
        F.col("is_confident"), confidence_threshold))
    boosted = apply_boost(F.col("p_spam"), F.col("boost"))
    x = x.withColumn("boosted", F.when(F.col("use_boost"), boosted).otherwise(F.col("p_spam")))
    changed = F.col("use_boost") & (F.col("boosted") != F.col("p_spam"))
    flips = changed & (F.col("boosted") > 1 - F.col("thr"))
    blank = F.col("blank")
    empty = F.col("n_tokens") == 0
    return x.select(
        "request_id",
        F.when(blank, "error").otherwise("ok").alias("status"),
        F.when(blank, None).when(empty, "uncertain").when(flips, "spam")
        .otherwise(F.col("prediction")).alias("prediction"),
        F.when(blank, None).when(empty, 0.0).when(flips, F.col("boosted"))
        .otherwise(F.col("confidence")).alias("confidence"),
        F.when(blank, None).when(empty, False).when(flips, True)
        .otherwise(F.col("is_confident")).alias("is_confident"),
        F.when(blank, C.BLANK_TEXT)
        .when(empty, C.NO_WORDS_TEXT)
        .when(flips, F.format_string(C.BOOSTED_TEXT, F.col("boosted")))
        .otherwise(F.col("explanation")).alias("explanation"),
        F.when(blank, None).when(empty, 0.5).when(changed, F.col("boosted"))
        .otherwise(F.col("p_spam")).alias("p_spam"),
        F.when(blank, None).when(empty, 0.5).when(changed, 1 - F.col("boosted"))
        .otherwise(F.col("p_ham")).alias("p_ham"),
        (~blank & ~empty & changed).alias("boost_applied"),
    )


def inbox_text(subject: Column, snippet: Column) -> Column:
    """P10: subject + ' ' + (snippet or ''); NULL when the subject is
    missing (the row is skipped) or the result is blank."""
    t = F.concat(subject, F.lit(" "), F.coalesce(snippet, F.lit("")))
    return F.when(subject.isNull() | is_blank(t), None).otherwise(t)


def badges(prediction: Column, confidence: Column) -> list[Column]:
    """The inline badge (spam -> ``[SPAM nn%]``, anything else,
    uncertain included -> ``[HAM]``), the three-way popup verdict and the
    popup confidence text (one decimal)."""
    conf = F.coalesce(confidence, F.lit(0.0)) * 100
    return [
        F.when(prediction == "spam", F.format_string("[SPAM %.0f%%]", conf))
        .otherwise(F.lit("[HAM]")).alias("badge"),
        F.when(prediction == "spam", F.lit(C.POPUP_SPAM)).when(prediction == "ham", F.lit(C.POPUP_HAM))
        .otherwise(F.lit(C.POPUP_UNCERTAIN)).alias("popup_verdict"),
        F.format_string("%.1f%%", conf).alias("popup_confidence"),
    ]


REQUEST_SCHEMA = "message string, decision_threshold double, use_sender_boost boolean"


def parse_requests(body: Column) -> Column:
    """A JSON request body -> struct with the S7 schema (missing fields
    NULL; ``score_requests`` applies the defaults)."""
    return F.from_json(body, REQUEST_SCHEMA)
