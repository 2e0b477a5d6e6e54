"""Text and label column functions (all JVM-side expressions).

Each function returns a ``Column``; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the source application's behaviour) ----
# Whitespace that Python's str.strip() removes.
WS = r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
# clean_text: printable ASCII range kept, everything else becomes a space.
NON_PRINTABLE = r"[^ -~]+"
ASCII_WS_RUN = r"\s+"
# label dictionary keys all agree with the rule "starts with fraud (any case) -> 1".
FRAUD_PREFIX = "fraud"
LABEL_POSITIVE = "Fraudulent"
LABEL_NEGATIVE = "Non_Fraudulent"
MIN_TEXT_CHARS = 3          # offline short-text rule and the length filter
MIN_TEXT_CHARS_LIVE = 2     # scoring-request short-text rule
NEUTRAL_PRIOR = 0.5
DISPLAY_CHARS = 80


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def py_strip(x) -> Column:
    """Python ``str.strip()``: drop leading/trailing Unicode whitespace."""
    return F.regexp_replace(_c(x), f"^{WS}+|{WS}+$", "")


def strip_or_empty(x) -> Column:
    """``(t or "").strip()``: null becomes the empty string."""
    return py_strip(F.coalesce(_c(x), F.lit("")))


def clean_text(x) -> Column:
    """lower, strip, non-printable runs to a space, collapse whitespace, strip.

    Null becomes "" (the source turned it into the 3-letter text "nan").
    """
    t = py_strip(F.lower(F.coalesce(_c(x), F.lit(""))))
    t = F.regexp_replace(t, NON_PRINTABLE, " ")
    t = F.regexp_replace(t, ASCII_WS_RUN, " ")
    return py_strip(t)


def label_num(label) -> Column:
    """Strip, then 1 when it starts with "fraud" in any case, else 0."""
    return F.when(F.lower(py_strip(_c(label))).startswith(FRAUD_PREFIX), F.lit(1)).otherwise(F.lit(0))


def label_name(num) -> Column:
    return F.when(_c(num) == 1, F.lit(LABEL_POSITIVE)).otherwise(F.lit(LABEL_NEGATIVE))


def text_long_enough(x, n: int = MIN_TEXT_CHARS) -> Column:
    return F.length(py_strip(F.coalesce(_c(x), F.lit("")))) >= n


def preview(x, n: int = DISPLAY_CHARS) -> Column:
    """First ``n`` characters, with "..." when the text is longer."""
    t = _c(x)
    return F.concat(F.substring(t, 1, n), F.when(F.length(t) > n, F.lit("...")).otherwise(F.lit("")))


def iso_utc(ts) -> Column:
    """Timestamp as ``YYYY-MM-DDTHH:MM:SSZ`` (whole seconds, UTC session zone)."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def call_id_from(*keys) -> Column:
    """Deterministic ``call_`` + 8 hex ids (replay-safe stand-in for a random uuid)."""
    return F.concat(F.lit("call_"), F.substring(F.md5(F.concat_ws(":", *[_c(k).cast("string") for k in keys])), 1, 8))


def weights_from_name(name) -> Column:
    """Parse ``WeightedAvg(0.5, 0.25, 0.25)`` back into ``array<double>``."""
    inner = F.regexp_extract(_c(name), r"\(([^)]*)\)", 1)
    return F.transform(F.split(inner, ","), lambda s: F.trim(s).cast("double"))


def clamp_label(x) -> Column:
    """P20: integer label clipped into {0, 1}."""
    return F.greatest(F.lit(0), F.least(F.lit(1), _c(x).cast("int")))
