"""Quality rules: text statistics, and a calibrated classifier on hashed n-grams.

A logistic regression on hashed word n-grams (one and two words) and character
n-grams (two to four characters) is fitted on labelled rows, its scores are
turned into probabilities by a logistic curve fitted on rows that it has not
seen, and every text is scored in Arrow batches against a fixed threshold.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_text, ref, without

#: hash buckets of each of the two families
BUCKETS = 1 << 15
#: labelled rows that the classifier is fitted on at most (chosen by hash of their id)
TRAIN_ROWS = 6000
#: every FOLD-th of them calibrates
FOLD = 5
#: probability of good quality under which a text is rejected
THRESHOLD = 0.5
#: characters hashed at a time
CHUNK = 1 << 20
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
OUTPUT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "quality_score", "kept")

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_SHIFT = np.uint64(64 - BUCKETS.bit_length() + 1)
_BASE = np.uint64(0x100000001B3)
_IS_SPACE = np.zeros(64, bool)
_IS_SPACE[[ord(c) for c in SPACES]] = True


def _powers() -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    with np.errstate(over="ignore"):
        return tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(CHUNK, b), dtype=np.uint64)]) for b in (_BASE, inverse))


_POWERS: list = []


def _pieces(codes: np.ndarray) -> Iterator[np.ndarray]:
    """Parts of at most ``CHUNK`` characters, cut at white space where there is any."""
    while len(codes) > CHUNK:
        part = codes[:CHUNK]
        space = np.flatnonzero((part < 64) & _IS_SPACE[np.minimum(part, 63)])
        cut = int(space[-1]) + 1 if len(space) else CHUNK
        yield codes[:cut]
        codes = codes[cut:]
    yield codes


def ngrams(text: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of all word n-grams and of all character n-grams of a whole
    text, part by part."""
    if not _POWERS:
        _POWERS.extend(_powers())
    power, inverse = _POWERS
    for codes in _pieces(np.frombuffer(text.encode("utf-32-le"), "<u4")):
        if not len(codes):
            continue
        c = codes.astype(np.uint64)
        two = c[:-1] * _M1 + c[1:]
        three = two[:-1] * _M1 + c[2:]
        four = three[:-1] * _M1 + c[3:]
        chars = np.concatenate([(x * _M2) >> _SHIFT for x in (two, three, four)])
        space = (codes < 64) & _IS_SPACE[np.minimum(codes, 63)]
        edges = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]])))
        starts, ends = edges[::2], edges[1::2]
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((c + np.uint64(1)) * power[:len(c)], dtype=np.uint64)])
        word = (total[ends] - total[starts]) * inverse[starts] * _M1
        word ^= word >> np.uint64(29)
        pair = (word[:-1] * _M2 + word[1:]) * _M3
        words = np.concatenate([(word * _M2) >> _SHIFT, pair >> _SHIFT])
        yield words.astype(np.int64), chars.astype(np.int64)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets (characters' after the words') and their values: each
    family's counts over the family's total."""
    counts = np.zeros((2, BUCKETS))
    for words, chars in ngrams(text or ""):
        counts[0] += np.bincount(words, minlength=BUCKETS)
        counts[1] += np.bincount(chars, minlength=BUCKETS)
    at = np.flatnonzero(counts)
    totals = np.maximum(counts.sum(axis=1), 1)
    return at.astype(np.int32), (counts.ravel()[at] / totals[at // BUCKETS]).astype(np.float32)


@dataclass
class Model:
    """Weights by bucket; the two numbers of the calibration curve."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def raw(self, text: str | None) -> float:
        sums, n = [0.0, 0.0], [0, 0]
        for k, family in enumerate(zip(*ngrams(text or ""))):
            w = self.weights[k * BUCKETS:(k + 1) * BUCKETS]
            for part in family:
                sums[k] += float(w[part].sum(dtype=np.float64))
                n[k] += len(part)
        return self.bias + sum(s / max(m, 1) for s, m in zip(sums, n))

    def probability(self, text: str | None) -> float:
        z = self.slope * self.raw(text) + self.offset
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _descend(value, x: np.ndarray, steps: int, rate: float) -> np.ndarray:
    """Minimise by Adam; ``value`` gives the gradient."""
    m, v = np.zeros_like(x), np.zeros_like(x)
    for t in range(1, steps + 1):
        g = value(x)
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        x = x - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return x


class _Rows:
    """Sparse rows, one after another. Sums go block by block, so that nothing
    but the rows themselves is as large as the sample."""

    BLOCK = 128

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]]):
        sizes = np.array([len(at) for at, _ in rows], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.at = np.concatenate([r[0] for r in rows]) if rows else np.zeros(0, np.int32)
        self.x = np.concatenate([r[1] for r in rows]) if rows else np.zeros(0, np.float32)

    def __len__(self) -> int:
        return len(self.starts) - 1

    def _blocks(self):
        for r in range(0, len(self), self.BLOCK):
            end = min(r + self.BLOCK, len(self))
            a, b = self.starts[r], self.starts[end]
            yield slice(r, end), self.at[a:b], self.x[a:b], np.repeat(np.arange(end - r), np.diff(self.starts[r:end + 1]))

    def scores(self, w: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(row, weights=w[at] * x, minlength=rows.stop - rows.start) for rows, at, x, row in self._blocks()] or [np.zeros(0)])

    def back(self, error: np.ndarray) -> np.ndarray:
        """Sum of the rows, each times its error."""
        total = np.zeros(2 * BUCKETS)
        for rows, at, x, row in self._blocks():
            total += np.bincount(at, weights=x * error[rows][row], minlength=2 * BUCKETS)
        return total

    def squares(self) -> np.ndarray:
        total = np.zeros(2 * BUCKETS)
        for _, at, x, _ in self._blocks():
            total += np.bincount(at, weights=x.astype(np.float64) ** 2, minlength=2 * BUCKETS)
        return total


def fit_rows(rows: list[tuple[int, np.ndarray, np.ndarray]], l2: float = 1e-3, steps: int = 80) -> Model:
    """Fit on (label, buckets, values) rows; every ``FOLD``-th calibrates. The
    list is emptied on the way. With labels of one kind only (or none) every
    text gets that kind's probability (none: 1)."""
    labels = np.array([r[0] for r in rows], float)
    if len(set(labels)) < 2:
        return Model(np.zeros(2 * BUCKETS, np.float32), 0.0, 0.0, 30.0 if not len(labels) or labels[0] else -30.0)
    fold = np.arange(len(rows)) % FOLD == FOLD - 1
    if len(set(labels[fold])) < 2 or len(set(labels[~fold])) < 2:
        fold[:] = False         # too few rows to hold some back
    train, held = (_Rows([rows[i][1:] for i in np.flatnonzero(which)]) for which in (~fold, fold))
    rows.clear()
    y, n = labels[~fold], len(train)
    # each feature on its own scale, as rare n-grams have small values
    scale = 1 / np.sqrt(train.squares() / n + 1e-7)

    def gradient(p):
        w, b = p[:-1], p[-1]
        error = 1 / (1 + np.exp(-np.clip(train.scores(w * scale) + b, -30, 30))) - y
        return np.append(train.back(error) * scale / n + l2 * w, error.mean())

    p = _descend(gradient, np.zeros(2 * BUCKETS + 1), steps, 0.02)
    model = Model((p[:-1] * scale).astype(np.float32), float(p[-1]))
    if not fold.any():
        held = train
    z, t = held.scores(model.weights) + model.bias, labels[fold] if fold.any() else y
    # Platt's targets keep the curve finite when the held rows are parted without error
    t = np.where(t == 1, (t.sum() + 1) / (t.sum() + 2), 1 / (len(t) - t.sum() + 2))
    middle, spread = z.mean(), z.std() + 1e-9
    u = (z - middle) / spread

    def curve(q):
        error = 1 / (1 + np.exp(-np.clip(q[0] * u + q[1], -30, 30))) - t
        return np.array([(error * u).mean(), error.mean()])

    a, b = _descend(curve, np.array([1.0, 0.0]), 600, 0.05)
    model.slope, model.offset = float(a / spread), float(b - a * middle / spread)
    return model


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", train_rows: int = TRAIN_ROWS) -> Model:
    """Fit on at most ``train_rows`` labelled documents, those whose ids hash
    smallest. Features are made on the executors; the driver gets the sample's
    features (about 24 KB a row, a partition at a time) and nothing that grows
    with the corpus. Null labels and ids are left out; of rows that repeat an
    id the one with the smallest features counts, so the bound holds."""
    chosen = (labels.select(ref(doc_id).cast("long").alias("id"), ref(label).cast("int").alias("label")).dropna().dropDuplicates(["id"])
              .orderBy(F.xxhash64("id"), "id").limit(train_rows))
    # at most train_rows rows of two numbers
    sample = docs.select(ref(doc_id).cast("long").alias("id"), ref(text).cast("string").alias("text")).join(F.broadcast(chosen), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                at, x = features(batch.column(1)[i].as_py())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), batch.column(2).slice(i, 1), pa.array([at.tobytes()], pa.binary()),
                                                  pa.array([x.tobytes()], pa.binary())], names=["id", "label", "at", "x"])

    made = sample.select("id", "text", "label").mapInArrow(run, "id long, label int, at binary, x binary")
    made = made.groupBy("id").agg(F.min(F.struct("at", "x", "label")).alias("r")).select("id", "r.*")
    rows = [(r["id"], r["label"], np.frombuffer(r["at"], np.int32), np.frombuffer(r["x"], np.float32)) for r in made.toLocalIterator()]
    rows.sort(key=lambda r: (zlib.crc32(str(r[0]).encode()), r[0]))      # the order sets the folds
    rows[:] = [r[1:] for r in rows]
    return fit_rows(rows)


def repeated_words(words: list[bytes], window: int = 8) -> int:
    """Words that lie in some window of 8 words found twice or more in the
    text. Windows are compared exactly: numbers for 2, 4 and 8 words are made
    from pairs of numbers for half as many."""
    if len(words) <= window:
        return 0
    number: dict[bytes, int] = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    width, kinds = 1, len(number)
    while True:
        pairs = codes[:-width] * kinds + codes[width:]
        distinct, codes, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        kinds, width = len(distinct), 2 * width
        if kinds == len(pairs):
            return 0            # nothing of this width repeats
        if width == window:
            break
    starts = np.flatnonzero(counts[codes] > 1)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge) > 0).sum())


def statistics(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    text = text or ""
    words = text.encode().split()       # bytes split at the six ASCII white-space characters only
    word_chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    seen, doubled = set(), 0
    for line in text.split("\n"):
        if line in seen:
            doubled += 1
        elif line.strip(SPACES):
            seen.add(line)
    return len(words), word_chars, symbols, doubled, repeated_words(words)


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Every row with n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed (under 20 words, or over 30 of 100 words in
    repeated windows), quality_score (probability of good quality) and kept.

    Null texts count as empty: no words, base_failed. Texts of any length are
    read whole. Rows are judged one by one, repeated or not, without a shuffle.
    Columns called like an output column are replaced. No rows, no rows. The
    model's size does not depend on the data (``BUCKETS``).
    """
    docs = without(docs, [n for n in OUTPUT if n != text.lower()])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, quality_score double"
    names = [x.split()[0] for x in added.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = shared.value
        for batch in batches:
            texts = [t.as_py() for t in batch.column(batch.num_columns - 1)]
            counts = list(zip(*map(statistics, texts))) or [()] * 5
            arrays = [pa.array(c, pa.int64()) for c in counts] + [pa.array(map(judge.probability, texts), pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], names=[*batch.schema.names[:-1], *names])

    judged = map_text(docs, text, run, added)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    judged = judged.withColumn("base_failed", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality_score") >= threshold))
