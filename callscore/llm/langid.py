"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram's vector binds
(multiplies) the vectors of its letters, each permuted (rolled) by its place;
a text's vector bundles (adds) those of its n-grams, and a language's
prototype bundles its texts. A text is given the language whose prototype has
the largest cosine with the text's vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callscore.session import scratch_root

from .common import map_text, ref, temp_names, without

DIMENSIONS = 1024
GRAM = 3
SEED = 20240229
#: languages whose prototypes are on the driver, or broadcast, at a time
MAX_LANGUAGES = 1000
#: n-gram vectors made at a time
ROWS = 4096
#: letters counted at a time
CHUNK = 1 << 20
UNKNOWN = "und"
OUTPUT = ("lang_pred", "score")

_SPACE = 0      # stands for any run of characters that are no letters
_IS_LETTER: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _IS_LETTER:
        _IS_LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _IS_LETTER[0]


def letters(text: str | None) -> np.ndarray:
    """Code points of the lower-cased letters, other runs as one ``_SPACE``,
    also at both ends; empty without any letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le"), "<u4")
    codes = np.where(_letter_table()[codes], codes, _SPACE)
    if not codes.any():
        return codes[:0]
    codes = np.concatenate([[_SPACE], codes, [_SPACE]])
    return codes[np.concatenate([[True], (codes[1:] != _SPACE) | (codes[:-1] != _SPACE)])].astype(np.int64)


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a whole text (letters in 21 bits each) and counts."""
    s = letters(text)
    n = len(s) - GRAM + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found, counts = [], []
    for k in range(0, n, CHUNK):
        end = min(k + CHUNK, n)
        code = sum(s[k + i:end + i] << (21 * (GRAM - 1 - i)) for i in range(GRAM))
        u, c = np.unique(code, return_counts=True)
        found.append(u)
        counts.append(c)
    if len(found) == 1:
        return found[0], counts[0]
    u, inverse = np.unique(np.concatenate(found), return_inverse=True)
    return u, np.bincount(inverse, weights=np.concatenate(counts)).astype(np.int64)


class Space:
    """Letter and n-gram vectors, the same in every process for one seed."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = SEED):
        self.dimensions, self.seed = dimensions, seed
        self._letters: dict[int, np.ndarray] = {}

    def letter(self, code: int) -> np.ndarray:
        v = self._letters.get(code)
        if v is None:
            v = np.random.default_rng([self.seed, code]).integers(0, 2, self.dimensions).astype(np.int8) * 2 - 1
            if len(self._letters) < 50_000:
                self._letters[code] = v
        return v

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        """One row for every n-gram: bound, permuted letter vectors."""
        out = np.ones((len(codes), self.dimensions), np.int8)
        for i in range(GRAM):
            own, inverse = np.unique(codes >> (21 * (GRAM - 1 - i)) & 0x1FFFFF, return_inverse=True)
            table = np.stack([np.roll(self.letter(int(c)), GRAM - 1 - i) for c in own]) if len(own) else np.zeros((0, self.dimensions), np.int8)
            out *= table[inverse]
        return out

    def bundle(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Sum of n-gram vectors times their counts."""
        total = np.zeros(self.dimensions)
        for k in range(0, len(codes), ROWS):
            total += counts[k:k + ROWS].astype(np.float64) @ self.vectors(codes[k:k + ROWS]).astype(np.float64)
        return total


class _Cached(Space):
    """Keeps the vectors of n-grams met often, in a bounded table."""

    LIMIT = 32_768

    def __init__(self, dimensions: int, seed: int):
        super().__init__(dimensions, seed)
        self.known = np.zeros(0, np.int64)
        self.table = np.zeros((0, dimensions), np.int8)

    def learn(self, codes: np.ndarray) -> None:
        new = np.setdiff1d(codes, self.known)[:max(0, self.LIMIT - len(self.known))]
        if len(new):
            both = np.concatenate([self.known, new])
            order = np.argsort(both, kind="stable")
            self.known = both[order]
            self.table = np.concatenate([self.table, self.vectors(new)])[order]

    def bundle(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return super().bundle(codes, counts)
        at = np.minimum(np.searchsorted(self.known, codes), len(self.known) - 1)
        hit = self.known[at] == codes
        total = super().bundle(codes[~hit], counts[~hit]) if not hit.all() else np.zeros(self.dimensions)
        at, weights = at[hit], counts[hit].astype(np.float32)
        for k in range(0, len(at), ROWS):
            total += weights[k:k + ROWS] @ self.table[at[k:k + ROWS]].astype(np.float32)
        return total


@dataclass
class Profiles:
    """Languages in code-point order and their prototypes, each of length 1."""

    languages: list[str]
    prototypes: np.ndarray
    dimensions: int = DIMENSIONS
    seed: int = SEED

    def nearest(self, vector: np.ndarray) -> tuple[str | None, float | None]:
        """The language with the largest cosine, the first of equals, and the cosine."""
        length = float(np.linalg.norm(vector))
        if not len(self.languages) or not length:
            return None, None
        cosines = self.prototypes @ (vector / length)
        best = int(np.argmax(cosines))
        return self.languages[best], float(cosines[best])

    def predict(self, vector: np.ndarray) -> tuple[str, float]:
        found, cosine = self.nearest(vector)
        return (UNKNOWN, 0.0) if found is None else (found, min(max(cosine, 0.0), 1.0))


def sums(docs: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS, seed: int = SEED) -> DataFrame:
    """lang, place, total: the bundle of every language, from every whole text
    that has a language and a letter.

    Each task adds up its texts' n-gram counts by language and hands on one
    vector of whole numbers for each; Spark sums them, so the result does not
    depend on how rows were dealt."""
    src = docs.select(ref(lang).cast("string").alias("lang"), ref(text).cast("string").alias("text")).dropna()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, held = Space(dimensions, seed), {}

        def out() -> Iterator[pa.RecordBatch]:
            for name, total in held.items():
                yield pa.RecordBatch.from_pydict({"lang": [name] * dimensions, "place": np.arange(dimensions, dtype=np.int32), "total": total})

        for batch in batches:
            by_lang: dict[str, list] = {}
            for i in range(batch.num_rows):
                by_lang.setdefault(batch.column(0)[i].as_py(), []).append(grams(batch.column(1)[i].as_py()))
            for name, found in by_lang.items():
                codes, inverse = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
                counts = np.bincount(inverse, weights=np.concatenate([f[1] for f in found]), minlength=len(codes))
                held[name] = held.get(name, 0) + np.rint(space.bundle(codes, counts)).astype(np.int64)
                if len(held) > MAX_LANGUAGES:
                    yield from out()
                    held.clear()
        yield from out()

    parts = src.mapInArrow(run, "lang string, place int, total long")
    return parts.groupBy("lang", "place").agg(F.sum("total").alias("total"))


def _profiles(summed: DataFrame, dimensions: int, seed: int) -> Profiles:
    table: dict[str, np.ndarray] = {}
    for r in summed.toLocalIterator():
        table.setdefault(r["lang"], np.zeros(dimensions))[r["place"]] = r["total"]
        if len(table) > MAX_LANGUAGES:
            raise ValueError(f"over {MAX_LANGUAGES} languages at a time; classify() takes any number")
    names = sorted(n for n, v in table.items() if v.any())
    rows = np.array([table[n] / np.linalg.norm(table[n]) for n in names]).reshape(len(names), dimensions)
    return Profiles(names, rows, dimensions, seed)


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS, seed: int = SEED) -> Profiles:
    """The prototypes of at most ``MAX_LANGUAGES`` languages, on the driver."""
    return _profiles(sums(docs, text, lang, dimensions, seed), dimensions, seed)


def _vectors(batch: pa.RecordBatch, space: _Cached) -> list[np.ndarray | None]:
    """The vectors of the texts in the last column; None without a letter."""
    found = [grams(t.as_py()) for t in batch.column(batch.num_columns - 1)]
    if found and len(space.known) < space.LIMIT:
        space.learn(np.unique(np.concatenate([f[0] for f in found])))
    return [space.bundle(*f) if len(f[0]) else None for f in found]


def classify(docs: DataFrame, learn_from: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS, seed: int = SEED) -> DataFrame:
    """``identify`` with what ``learn_from`` teaches, for any number of languages.

    Up to ``MAX_LANGUAGES`` are one broadcast and one pass. More are cut into
    blocks of at most that many by hash; each block is one broadcast and one
    pass over the texts, which keep the best language so far, so the result is
    that of all prototypes at once."""
    scratch_root(docs.sparkSession)
    summed = sums(learn_from, text, lang, dimensions, seed).checkpoint()
    blocks = 1
    while True:
        block = F.pmod(F.xxhash64("lang"), F.lit(blocks))
        largest = summed.where("place = 0").groupBy(block.alias("block")).count().agg(F.max("count")).first()[0]
        if (largest or 0) <= MAX_LANGUAGES:
            break
        blocks *= 2
    if blocks == 1:
        return identify(docs, _profiles(summed, dimensions, seed), text)
    docs = without(docs, [n for n in OUTPUT if n != text.lower()])
    name, cosine, new, more = temp_names(docs, "name", "cosine", "new", "more")
    rows = docs.withColumn(name, F.lit(None).cast("string")).withColumn(cosine, F.lit(None).cast("double"))
    for b in range(blocks):
        rows = _better(rows, _profiles(summed.where(block == b), dimensions, seed), text, name, cosine, new, more).checkpoint()
    own = [ref(c) for c in docs.columns if c != text]
    clamped = F.greatest(F.least(F.coalesce(cosine, F.lit(0.0)), F.lit(1.0)), F.lit(0.0))
    return rows.select(*own, F.coalesce(name, F.lit(UNKNOWN)).alias("lang_pred"), clamped.alias("score"))


def _better(rows: DataFrame, profiles: Profiles, text: str, name: str, cosine: str, new: str, more: str) -> DataFrame:
    """One block: ``name`` and ``cosine`` of the better of what they were and
    the block's best; of equal cosines the first by code point."""
    shared = rows.sparkSession.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        space = _Cached(known.dimensions, known.seed)
        for batch in batches:
            found = [(None, None) if v is None else known.nearest(v) for v in _vectors(batch, space)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([n for n, _ in found], pa.string()), pa.array([c for _, c in found], pa.float64())],
                                             names=[*batch.schema.names[:-1], new, more])

    judged = map_text(rows, text, run, f"{new} string, {more} double")
    takes = F.col(more).isNotNull() & (F.col(cosine).isNull() | (F.col(more) > F.col(cosine)) | ((F.col(more) == F.col(cosine)) & (F.col(new) < F.col(name))))
    keep = [ref(c) for c in rows.columns if c not in (name, cosine)]
    return judged.select(*keep, F.when(takes, F.col(new)).otherwise(F.col(name)).alias(name), F.when(takes, F.col(more)).otherwise(F.col(cosine)).alias(cosine))


def identify(docs: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """Every row without its text, with lang_pred (``und`` for a null text or
    one without letters, or if nothing was learned) and score (the cosine, 0
    to 1).

    Only the text decides. Texts of any length are read whole; equal cosines
    give the language that is first by code point; rows are judged one by one,
    without a shuffle. Columns called like an output column are replaced. No
    rows, no rows.
    """
    docs = without(docs, [n for n in OUTPUT if n != text.lower()])
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        space = _Cached(known.dimensions, known.seed)
        for batch in batches:
            pred = [(UNKNOWN, 0.0) if v is None else known.predict(v) for v in _vectors(batch, space)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([p for p, _ in pred], pa.string()), pa.array([s for _, s in pred], pa.float64())],
                                             names=[*batch.schema.names[:-1], *OUTPUT])

    return map_text(docs, text, run, "lang_pred string, score double", keep_text=False)
