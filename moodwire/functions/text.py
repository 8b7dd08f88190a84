"""Native (Catalyst) text and score expressions used by the jobs.

Everything here returns a ``Column``; nothing calls Python per row. Lambdas over
arrays (``category``) run interpreted, outside whole-stage codegen.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must equal the reference's -------------------------
# Category labels and their inclusive upper bounds (score <= bound).
CATEGORY_BOUNDS = [
    (-0.6, "F - Very Negative"),
    (-0.2, "D - Negative"),
    (0.2, "C - Neutral"),
    (0.6, "B - Positive"),
]
CATEGORY_TOP = "A - Very Positive"
# Classifier class index -> score (index 0..4); any other index -> 0.0.
CLASS_SCORES = [-0.8, -0.4, 0.0, 0.4, 0.8]
# Separator between messages inside one escalation, as the four characters
# space, backslash, n, space (a standard SQL literal, not a newline).
MESSAGE_SEPARATOR = " \\n "
# Escalation prompt pieces around the customer name, score and messages.
RESPONSE_PROMPT_PARTS = (
    'Karen Alert!!! Generate a customer service rebuttal for a customer named "',
    '" whose cumulative negative sentiment has reached ',
    '. Recent complaints include: "',
    '". ',
    "The customer has crossed our tolerance threshold. Generate a response to make them bugger off.",
)
RESPONSE_PROMPT_MESSAGE_CHARS = 500
# Scoring prompt for a chat model (the message goes between the quotes).
SENTIMENT_PROMPT_HEAD = """Analyze the sentiment of this customer service message and provide a numeric sentiment score.

        Scale:
        -1.0 = Very negative/angry (demanding manager, threats, extreme dissatisfaction)
        -0.5 = Negative (complaints, dissatisfaction, problems)
        0.0 = Neutral (factual, informational, neither positive nor negative)
        +0.5 = Positive (satisfaction, thanks, compliments)
        +1.0 = Very positive (love, amazing, exceptional experience)

        Message: \""""
SENTIMENT_PROMPT_TAIL = """\"

        Respond with only a decimal number between -1.0 and +1.0 (e.g., -0.8, 0.0, +0.7):"""
SENTIMENT_SYSTEM_PROMPT = (
    "You are a sentiment analysis expert. Respond with only a decimal number between -1.0 and +1.0."
)
# --------------------------------------------------------------------------


def _python_space_class() -> str:
    """Regex class body of every character Python's ``str.isspace`` accepts.

    Built from the rule rather than listed, so a blank test in Spark agrees
    with the ``text.strip()`` guard of the model scorers.
    """
    chars = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace()]
    out, i = [], 0
    while i < len(chars):
        j = i
        while j + 1 < len(chars) and ord(chars[j + 1]) == ord(chars[j]) + 1:
            j += 1
        lo, hi = ord(chars[i]), ord(chars[j])
        out.append(f"\\x{{{lo:x}}}" if lo == hi else f"\\x{{{lo:x}}}-\\x{{{hi:x}}}")
        i = j + 1
    return "".join(out)


PY_SPACE_CLASS = _python_space_class()
# Matches any character that Python would not strip.
NON_BLANK_RE = f"[^{PY_SPACE_CLASS}]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def non_blank(text) -> Column:
    """``text IS NOT NULL AND CHAR_LENGTH(TRIM(text)) > 0``.

    SQL ``TRIM`` removes spaces only, so a tab/newline-only text passes.
    """
    t = _c(text)
    return t.isNotNull() & (F.length(F.trim(t)) > 0)


def py_strip(text) -> Column:
    """Python ``str.strip()``: leading and trailing whitespace of every kind."""
    return F.regexp_replace(_c(text), f"^[{PY_SPACE_CLASS}]+|[{PY_SPACE_CLASS}]+$", "")


def is_blank_py(text) -> Column:
    """True when Python's ``not text or not text.strip()`` holds."""
    t = _c(text)
    return t.isNull() | ~t.rlike(NON_BLANK_RE)


def category(score) -> Column:
    """Bucket a score into its letter category; NULL stays NULL.

    The score is bound once as a lambda variable, so when a filter on the
    category is pushed below the projection the scorer still runs once.
    """
    bounds = F.array(*[F.lit(float(b)) for b, _ in CATEGORY_BOUNDS])
    labels = F.array(*[F.lit(lab) for _, lab in CATEGORY_BOUNDS], F.lit(CATEGORY_TOP))

    def label(s: Column) -> Column:
        below = F.size(F.filter(bounds, lambda b: b < s))
        return F.when(s.isNull(), F.lit(None).cast("string")).otherwise(F.element_at(labels, below + 1))

    return F.element_at(F.transform(F.array(_c(score).cast("double")), label), 1)


def class_to_score(idx) -> Column:
    """Map a classifier's class index to a score; out of range or NULL -> 0.0."""
    i = _c(idx)
    arr = F.array(*[F.lit(float(v)) for v in CLASS_SCORES])
    return F.coalesce(F.get(arr, i), F.lit(0.0))


# A reply Python's float() accepts after strip(): decimal with optional
# underscores between digits and exponent, or nan/inf/infinity, any case.
_PY_FLOAT_RE = (
    r"^[+-]?(([0-9]+(_[0-9]+)*)(\.([0-9]+(_[0-9]+)*)?)?|\.[0-9]+(_[0-9]+)*)"
    r"([eE][+-]?[0-9]+(_[0-9]+)*)?$"
)
_PY_SPECIAL_RE = r"^(?i)[+-]?(nan|inf|infinity)$"


def parse_score(reply) -> Column:
    """Model reply -> score clamped to [-1, 1]; unparseable -> 0.0.

    Follows Python ``float`` then ``max(-1, min(1, x))``: NaN ends at 1.0
    (min keeps its first argument), +inf at 1.0 and -inf at -1.0.
    """
    r = py_strip(reply)
    special = F.lower(F.regexp_replace(r, "^[+]", ""))
    as_double = F.regexp_replace(r, "_", "").try_cast("double")
    clamped = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), as_double))
    return (
        F.when(r.rlike(_PY_SPECIAL_RE),
               F.when(special.startswith("-") & ~special.contains("nan"), F.lit(-1.0)).otherwise(F.lit(1.0)))
        .when(r.rlike(_PY_FLOAT_RE), F.coalesce(clamped, F.lit(0.0)))
        .otherwise(F.lit(0.0))
    )


def sentiment_prompt(text) -> Column:
    """User prompt sent to a chat-model scorer for one message."""
    return F.concat(F.lit(SENTIMENT_PROMPT_HEAD), _c(text), F.lit(SENTIMENT_PROMPT_TAIL))


def response_prompt(name, total, messages) -> Column:
    """Prompt for the generated response to an escalation.

    ``CONCAT`` semantics: NULL when any piece is NULL. Messages are cut to
    their first 500 characters here only; the stored messages stay whole.
    """
    p = RESPONSE_PROMPT_PARTS
    return F.concat(
        F.lit(p[0]), _c(name), F.lit(p[1]), _c(total).cast("string"), F.lit(p[2]),
        F.substring(_c(messages), 1, RESPONSE_PROMPT_MESSAGE_CHARS), F.lit(p[3]), F.lit(p[4]),
    )


EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_ms_to_utc(ms) -> Column:
    """Epoch milliseconds -> zone-less UTC wall time (independent of the
    session time zone)."""
    return F.timestamp_add("MILLISECOND", _c(ms), F.expr(EPOCH_NTZ))


def utc_ntz_to_epoch_ms(ts) -> Column:
    """Zone-less UTC wall time -> epoch milliseconds (truncating microseconds)."""
    return F.floor(F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), _c(ts)) / F.lit(1000)).cast("long")


def session_id_from_uuid() -> Column:
    """``"sess_"`` followed by 8 hex characters of a fresh UUID."""
    return F.concat(F.lit("sess_"), F.substring(F.regexp_replace(F.expr("uuid()"), "-", ""), 1, 8))
