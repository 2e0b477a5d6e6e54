"""Score fusion and decision expressions.

The production scorer is user supplied (see ``operators.models``); the
stand-in scorer here is deterministic and SQL-expressible so every running
and final decision can be checked against an SQL twin.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import MIN_TEXT_CHARS_LIVE, NEUTRAL_PRIOR, py_strip

# ---- fixed values ----
DEFAULT_WEIGHTS = (0.6, 0.2, 0.2)
THRESHOLD = 0.5
STATUS_POSITIVE = "FRAUDULENT"
STATUS_NEGATIVE = "Normal"
STATUS_UNSCORED = "Unscored"
API_LABEL_POSITIVE = "Fraudulent"
API_LABEL_NEGATIVE = "Non-Fraudulent"
SCORE_DECIMALS = 4


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def stand_in_text_prob(text, min_chars: int = MIN_TEXT_CHARS_LIVE) -> Column:
    """(length % 101) / 100; the neutral prior when the stripped text is short or null."""
    t = _c(text)
    short = t.isNull() | (F.length(py_strip(t)) < min_chars)
    return F.when(short, F.lit(NEUTRAL_PRIOR)).otherwise((F.length(t) % 101) / F.lit(100.0))


def matrix_prob(m, flat: bool = False) -> Column:
    """Stand-in matrix score: logistic of 10 x the mean cell; 0.5 when absent.
    ``flat``: the matrix is one array of cells."""
    flat = _c(m) if flat else F.flatten(_c(m))
    mean = F.aggregate(flat, F.lit(0.0), lambda a, x: a + x) / F.size(flat)
    return F.when(_c(m).isNull() | (F.size(flat) == 0), F.lit(NEUTRAL_PRIOR)) \
        .otherwise(F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-10.0) * mean)))


def fuse(probs: Sequence, weights: Sequence[float] = DEFAULT_WEIGHTS) -> Column:
    """Weighted fusion ``sum(w_i * p_i)``."""
    acc = None
    for p, w in zip(probs, weights):
        term = F.lit(float(w)) * _c(p)
        acc = term if acc is None else acc + term
    return acc


def fuse_mean(probs: Sequence) -> Column:
    acc = None
    for p in probs:
        acc = _c(p) if acc is None else acc + _c(p)
    return acc / F.lit(float(len(probs)))


def decide(p, threshold: float = THRESHOLD, inclusive: bool = False) -> Column:
    """1 when above the threshold (``>=`` when inclusive), else 0."""
    return F.when(_c(p) >= threshold if inclusive else _c(p) > threshold, F.lit(1)).otherwise(F.lit(0))


def status(p, threshold: float = THRESHOLD, compat: bool = False) -> Column:
    """Display status. ``compat`` scores a missing probability as 0.0 -> Normal;
    otherwise a null probability is reported as Unscored."""
    s = F.when(_c(p) > threshold, F.lit(STATUS_POSITIVE)).otherwise(F.lit(STATUS_NEGATIVE))
    if compat:
        return F.when(_c(p).isNull(), F.lit(STATUS_NEGATIVE)).otherwise(s)
    return F.when(_c(p).isNull(), F.lit(STATUS_UNSCORED)).otherwise(s)


def api_label(p) -> Column:
    """Scoring-request label: inclusive threshold."""
    return F.when(_c(p) >= THRESHOLD, F.lit(API_LABEL_POSITIVE)).otherwise(F.lit(API_LABEL_NEGATIVE))


def stand_in_scores(text, mfcc=None, spec=None, weights: Sequence[float] = DEFAULT_WEIGHTS,
                    min_chars: int = MIN_TEXT_CHARS_LIVE, flat: bool = False) -> dict[str, Column]:
    """bert/mfcc/spec/final probabilities rounded as the scoring response does."""
    bert = stand_in_text_prob(text, min_chars)
    mp = matrix_prob(mfcc, flat) if mfcc is not None else F.lit(NEUTRAL_PRIOR)
    sp = matrix_prob(spec, flat) if spec is not None else F.lit(NEUTRAL_PRIOR)
    final = fuse([bert, mp, sp], weights)
    return {
        "bert_prob": F.round(bert, SCORE_DECIMALS),
        "mfcc_prob": F.round(mp, SCORE_DECIMALS),
        "spec_prob": F.round(sp, SCORE_DECIMALS),
        "final_prob": F.round(final, SCORE_DECIMALS),
    }


# A scorer takes the text and the two mean matrices (flat arrays, null when
# there are none) and gives a struct of SCORE_FIELDS: four probabilities, or
# nulls and an error text.
SCORE_FIELDS = ("bert_prob", "mfcc_prob", "spec_prob", "final_prob")
Scorer = Callable[[Column, Column, Column], Column]


def stand_in_scorer(text: Column, mfcc: Column, spec: Column) -> Column:
    """The deterministic stand-in as a scorer; it never fails."""
    scores = stand_in_scores(text, mfcc, spec, flat=True)
    return F.struct(*[scores[f].alias(f) for f in SCORE_FIELDS], F.lit(None).cast("string").alias("error"))


def failing_scorer(scorer: Scorer, fails: Callable[[Column], Column], error: str) -> Scorer:
    """``scorer``, but with ``error`` in place of scores where ``fails(text)`` holds."""
    def score(text: Column, mfcc: Column, spec: Column) -> Column:
        s, bad = scorer(text, mfcc, spec), fails(text)
        return F.struct(*[F.when(~bad, s[f]).alias(f) for f in SCORE_FIELDS], F.when(bad, F.lit(error)).otherwise(s["error"]).alias("error"))
    return score


def score_columns(df, text: str, mfcc: str | None = None, spec: str | None = None, scorer: Scorer = stand_in_scorer, compat: bool = False,
                  error: str | None = None):
    """Add the four scores and the display status (Unscored where the scorer
    reported an error, unless ``compat``), and the error text as column ``error``."""
    empty = F.lit(None).cast("array<double>")
    out = df.withColumn("_score", scorer(F.col(text), F.col(mfcc) if mfcc else empty, F.col(spec) if spec else empty))
    out = out.select("*", *[F.col(f"_score.{f}").alias(f) for f in SCORE_FIELDS])
    final = F.when(F.col("_score.error").isNull(), F.col("final_prob"))
    out = out.withColumn("status", status(final, compat=compat))
    return (out.withColumn(error, F.col("_score.error")) if error else out).drop("_score")
