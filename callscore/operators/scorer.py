"""A batched scorer whose failures are results, row by row.

A user model scores a batch of (text, mean matrices) at once, in Arrow batches
on the executors. A batch that fails, or takes longer than the limit, is halved
until the rows that fail are alone: these get an error text and no scores, all
others are scored. k bad rows of n cost about k * log2(n) further calls.
"""

from __future__ import annotations

import signal
import threading
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import DEFAULT_WEIGHTS, NEUTRAL_PRIOR, SCORE_DECIMALS, SCORE_FIELDS, Scorer

# ---- fixed value: seconds that a scoring call may take ----
LIMIT_SECONDS = 40.0
BATCH_ROWS = 512
SCHEMA = ", ".join(f"{f} double" for f in SCORE_FIELDS) + ", error string"

#: texts, and the two flat matrices or None of each row -> probabilities, a row and three columns
Predict = Callable[[list, list, list], np.ndarray]


class _Limit:
    """Ends what runs longer than ``seconds``, where the worker's main thread runs it."""

    def __init__(self, seconds: float | None):
        self.seconds = seconds if threading.current_thread() is threading.main_thread() else None

    def __enter__(self):
        if self.seconds:
            self._old = signal.signal(signal.SIGALRM, self._end)
            signal.setitimer(signal.ITIMER_REAL, self.seconds)

    def __exit__(self, *_):
        if self.seconds:
            signal.setitimer(signal.ITIMER_REAL, 0)
            signal.signal(signal.SIGALRM, self._old)

    def _end(self, *_):
        raise TimeoutError(f"no answer in {self.seconds:g} s")


def score_rows(predict: Predict, texts: list, mfcc: list, spec: list, limit: float | None = LIMIT_SECONDS) -> tuple[np.ndarray, list]:
    """Probabilities (not a number where there are none) and error texts."""
    out, errors = np.full((len(texts), 3), np.nan), [None] * len(texts)
    todo = [(0, len(texts))] if texts else []
    while todo:
        a, b = todo.pop()
        try:
            with _Limit(limit):
                p = np.asarray(predict(texts[a:b], mfcc[a:b], spec[a:b]), dtype=np.float64)
            if p.shape != (b - a, 3):
                raise ValueError(f"{p.shape} scores for {b - a} rows")
        except Exception as e:  # noqa: BLE001  whatever a user's model raises is that row's result
            if b - a == 1:
                errors[a] = f"{type(e).__name__}: {e}"
            else:
                middle = (a + b) // 2
                todo += [(middle, b), (a, middle)]
            continue
        out[a:b] = p
        for i in np.flatnonzero(~((p >= 0) & (p <= 1)).all(axis=1)):
            out[a + i], errors[a + i] = np.nan, "ValueError: not a probability"
    return out, errors


def resilient_scorer(make_predict: Callable[[], Predict], weights: Sequence[float] = DEFAULT_WEIGHTS, batch_rows: int = BATCH_ROWS,
                     limit: float | None = LIMIT_SECONDS) -> Scorer:
    """A scorer for ``score_columns`` from a user model. ``make_predict`` runs
    once per Python task (model load)."""
    @F.pandas_udf(SCHEMA)
    def score(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        predict = make_predict()
        for columns in batches:
            parts = []
            for k in range(0, len(columns[0]), batch_rows):
                texts, mfcc, spec = ([None if x is None else x for x in c.iloc[k:k + batch_rows]] for c in columns)
                p, errors = score_rows(predict, texts, mfcc, spec, limit)
                final = sum(w * p[:, i] for i, w in enumerate(weights))
                df = pd.DataFrame(np.column_stack([p, final]), columns=list(SCORE_FIELDS)).astype(object).where(~np.isnan(np.column_stack([p, final])), None)
                parts.append(df.assign(error=errors))
            yield pd.concat(parts) if parts else pd.DataFrame(columns=[*SCORE_FIELDS, "error"])

    def rounded(text: Column, mfcc: Column, spec: Column) -> Column:
        s = F.transform(F.array(score(text, mfcc, spec)), lambda x: F.struct(
            *[F.round(x[f], SCORE_DECIMALS).alias(f) for f in SCORE_FIELDS], x["error"].alias("error")))
        return F.element_at(s, 1)

    return rounded


def observe_errors(scored: DataFrame, error: str = "error", name: str = "scorer") -> DataFrame:
    """Counters of a batch or micro-batch: rows, and rows with an error."""
    return scored.observe(name, F.count(F.lit(1)).alias("rows"), F.count(error).alias("errors"))


def stand_in_model(fails: Callable[[str], bool] | None = None, min_chars: int = 2) -> Callable[[], Predict]:
    """Loader of the deterministic stand-in as a user model; the whole batch
    raises where ``fails(text)`` holds for any of its rows."""
    def make() -> Predict:
        def predict(texts, mfcc, spec):
            if fails is not None and any(fails(t) for t in texts):
                raise RuntimeError("planted")
            words = [NEUTRAL_PRIOR if t is None or len(t.strip()) < min_chars else (len(t) % 101) / 100.0 for t in texts]
            logistic = lambda m: NEUTRAL_PRIOR if m is None or not len(m) else 1.0 / (1.0 + np.exp(-10.0 * np.mean(m)))
            return np.array([words, [logistic(m) for m in mfcc], [logistic(m) for m in spec]]).T
        return predict
    return make
