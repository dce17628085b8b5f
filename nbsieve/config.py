"""Parameters and fixed values.

Everything in the "FIXED VALUES" blocks must equal what the original
classifier used, otherwise results differ. They are stated plainly, in their
natural order. Everything else is a tunable default.
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# FIXED VALUES: English stopword list (the public NLTK English list, in its
# published order). Tokens are a-z only, so the entries with an apostrophe can
# never match; they are kept so the list reads as published.
# --------------------------------------------------------------------------
STOPWORDS_EN = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your "
    "yours yourself yourselves he him his himself she she's her hers herself it "
    "it's its itself they them their theirs themselves what which who whom this "
    "that that'll these those am is are was were be been being have has had "
    "having do does did doing a an the and but if or because as until while of "
    "at by for with about against between into through during before after "
    "above below to from up down in out on off over under again further then "
    "once here there when where why how all any both each few more most other "
    "some such no nor not only own same so than too very s t can will just don "
    "don't should should've now d ll m o re ve y ain aren aren't couldn "
    "couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't "
    "isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't "
    "shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't"
).split()

# --------------------------------------------------------------------------
# FIXED VALUES: word-tokeniser contractions that can survive the a-z cleaning
# (first part, second part). "cannot" -> "can not", etc.
# --------------------------------------------------------------------------
CONTRACTIONS = (
    ("can", "not"),
    ("gim", "me"),
    ("gon", "na"),
    ("got", "ta"),
    ("lem", "me"),
    ("wan", "na"),
)

# --------------------------------------------------------------------------
# FIXED VALUES: placeholder tokens and the patterns they replace.
# ``\S`` is spelled out as "not Python whitespace" so Java and RE2 agree
# with Python's Unicode-aware class.
# --------------------------------------------------------------------------
URL_TOKEN = "urltoken"
EMAIL_TOKEN = "emailtoken"
PY_WHITESPACE = (
    r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
NON_WS = f"[^{PY_WHITESPACE}]"
URL_PATTERN = rf"http[s]?://{NON_WS}+|www\.{NON_WS}+"
EMAIL_PATTERN = rf"{NON_WS}+@{NON_WS}+"
# The same replacement for a backtracking engine (Java), in linear time: a
# match of EMAIL_PATTERN is always a whole whitespace-delimited run that has
# an '@' after its first character and before its last, so anchor at run
# starts and scan each run once (possessive quantifiers, no backtracking).
EMAIL_PATTERN_LINEAR = rf"(?<!{NON_WS}){NON_WS}[^{PY_WHITESPACE}@]*+@{NON_WS}++"

# --------------------------------------------------------------------------
# FIXED VALUES: sender rules (regex on the lower-cased raw message, boost).
# The maximum boost over all matching rules is added to P(spam).
# --------------------------------------------------------------------------
SENDER_RULES = (
    (r"\breddit\b", 0.45),
    (r"\breddit\.com\b", 0.50),
    (r"\bnoreply@reddit\.com\b", 0.55),
    (r"\balibaba\b", 0.50),
    (r"\balibaba\.com\b", 0.55),
    (r"\baliexpress\b", 0.45),
    (r"\bunstop\b", 0.45),
    (r"\bunstop\.com\b", 0.50),
    (r"\bjia\b.*\bunstop\b", 0.55),
    (r"\bjia rom\b", 0.50),
    (r"\blinkedin\b", 0.30),
    (r"\blinkedin\.com\b", 0.35),
    (r"\bjobs-listings@linkedin\b", 0.40),
    (r"\bunacademy\b", 0.35),
    (r"\bunacademy\.com\b", 0.40),
)

# --------------------------------------------------------------------------
# FIXED VALUES: label canonicalisation sets (loader) and the smaller sets the
# data profiler uses.
# --------------------------------------------------------------------------
SPAM_LABELS = ("spam", "promotion", "promotional", "promotions", "phishing")
HAM_LABELS = ("ham", "update", "updates", "primary", "personal", "social",
              "notification", "forum", "verify_code", "social_media")
PROFILE_SPAM_LABELS = ("spam", "promotion", "promotional", "phishing")
PROFILE_HAM_LABELS = ("ham", "update", "updates", "primary", "personal", "social",
                      "notification")

# FIXED VALUES: header names that identify the text and label columns of a CSV.
TEXT_COLUMNS = ("text", "email", "message", "body", "content", "sms")
LABEL_COLUMNS = ("label", "category", "class", "type", "target")

# FIXED VALUES: category table mapping and raw-mail directory labels.
CATEGORY_SPAM = ("spam", "promotions")
CATEGORY_HAM = ("forum", "verify_code", "social_media", "updates")
MAIL_DIR_LABELS = (("easy_ham", "ham"), ("hard_ham", "ham"), ("spam", "spam"),
                   ("spam_2", "spam"))

# FIXED VALUES: punctuation characters counted by the Gaussian feature.
PUNCTUATION_CHARS = "!?.,;:$%&*#@^~"

# FIXED VALUES: the Gaussian feature names, in vector order.
GAUSSIAN_FEATURES = (
    "length", "unique_count", "avg_word_len", "url_count", "email_count",
    "punctuation_ratio", "uppercase_ratio", "digit_ratio",
    "special_char_density", "sentence_count",
)

# FIXED VALUES: smoothing grids.
ALPHA_GRID_F1 = (0.1, 0.5, 1.0, 2.0, 5.0, 10.0)
ALPHA_GRID_ACCURACY = (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 1.0, 1.5, 2.0)

# --------------------------------------------------------------------------
# FIXED VALUES: texts of verdicts, requests and comparisons.
# --------------------------------------------------------------------------
CONFIDENT_TEXT = "Confident %s (P=%.4f >= threshold={})"
UNCERTAIN_TEXT = ("UNCERTAIN - P(spam)=%.4f, P(ham)=%.4f. Neither class exceeds "
                  "threshold={}. This message is ambiguous — different people might "
                  "classify it differently.")
BLANK_TEXT = "Message cannot be empty"
NO_WORDS_TEXT = "No meaningful words remaining after preprocessing."
BOOSTED_TEXT = "Sender-boosted SPAM (P=%.4f)"
POPUP_SPAM = "🔴 Spam Detected"
POPUP_HAM = "🟢 Legitimate"
POPUP_UNCERTAIN = "⚠️ Uncertain"
BETTER = "{} is SIGNIFICANTLY BETTER"
BETTER_THAN = "{} is SIGNIFICANTLY BETTER than {}"
NO_DIFFERENCE = "No significant difference between the two models"

# Defaults (tunable).
SEED = 42
MIN_DF = 2
MAX_DF = 0.95
ALPHA = 1.0
DECISION_THRESHOLD = 0.5
CONFIDENCE_THRESHOLD = 0.70
REQUEST_THRESHOLD = 0.65
VAL_RATIO = 0.15
TEST_RATIO = 0.15
K_FOLDS = 5
GAUSSIAN_VAR_EPS = 1e-4
TRUNCATE_CSV = 1500
TRUNCATE_MAIL = 2000
TRUNCATE_PAGE = 5000
MAX_VOCAB_PRUNED = 50000
THRESHOLD_MIN_PRECISION = 0.95
THRESHOLD_MIN_RECALL = 0.90
# Broadcast a model side only below this many bytes (estimated from its row
# count); above it the join shuffles on the token and AQE splits hot keys.
BROADCAST_MAX_BYTES = 256 * 1024 * 1024
