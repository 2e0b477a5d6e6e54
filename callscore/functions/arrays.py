"""Array and matrix column functions.

Matrices are ``array<array<double>>`` (rows of equal length); 1-D signals
are ``array<double>``. Everything is a higher-order SQL function evaluated
in the JVM; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values ----
PEAK_TARGET = 0.98
PEAK_MAX_GAIN = 10.0
MINMAX_EPS = 1e-6
DB_FLOOR = -80.0          # dB window is [-80, 0] -> [0, 1]
POWER_AMIN = 1e-10
TOP_DB = 80.0
PCM_SCALE = 32767
FREQ_MASK_MAX = 16
TIME_MASK_MAX = 30
MASK_P = 0.5

MATRIX = "array<array<double>>"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)


def let(value, fn) -> Column:
    """Evaluate ``value`` once and pass it to ``fn``.

    Expressions used inside a lambda are evaluated per element (Catalyst does
    not share subexpressions across lambda boundaries), so a matrix-wide value
    such as ``array_max(flatten(m))`` must be bound first or the cost becomes
    quadratic in the matrix size."""
    return F.element_at(F.transform(F.array(_c(value)), fn), 1)


def map_cells(m, fn) -> Column:
    return F.transform(_c(m), lambda row: F.transform(row, fn))


def n_rows(m) -> Column:
    return F.size(_c(m))


def n_cols(m) -> Column:
    """Width of the first row; 0 for a matrix without rows."""
    return F.coalesce(F.size(F.try_element_at(_c(m), F.lit(1))), F.when(_c(m).isNotNull(), 0))


def shape(m) -> Column:
    """``[rows, cols]``."""
    return F.array(n_rows(m), n_cols(m))


def peak_normalize(y, target: float = PEAK_TARGET, max_gain: float = PEAK_MAX_GAIN) -> Column:
    """Scale by min(target / peak, max_gain); unchanged when empty or silent."""
    def body(y):
        peak = F.array_max(F.transform(y, lambda x: F.abs(x)))
        return F.when((F.size(y) == 0) | ~(peak > 0), y).otherwise(
            let(F.least(F.lit(target) / peak, F.lit(max_gain)), lambda g: F.transform(y, lambda x: x * g)))
    return let(y, body)


def minmax_normalize(m) -> Column:
    """R2: (x - min) / (max - min + 1e-6) over the whole matrix."""
    def body(mm):
        flat = F.flatten(mm)
        return let(F.struct(F.array_min(flat).alias("lo"), F.array_max(flat).alias("hi")),
                   lambda b: map_cells(mm, lambda x: (x - b["lo"]) / (b["hi"] - b["lo"] + F.lit(MINMAX_EPS))))
    return let(m, body)


def db_window(m, floor: float = DB_FLOOR) -> Column:
    """clip((x - floor) / -floor, 0, 1)."""
    return map_cells(m, lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), (x - F.lit(floor)) / F.lit(-floor))))


def power_to_db(m, amin: float = POWER_AMIN, top_db: float = TOP_DB) -> Column:
    """10 log10(max(x, amin)) relative to the matrix maximum, floored top_db below the peak."""
    def body(mm):
        ref = F.lit(10.0) * F.log10(F.greatest(F.array_max(F.flatten(mm)), F.lit(amin)))
        db = let(ref, lambda r: map_cells(mm, lambda x: F.lit(10.0) * F.log10(F.greatest(x, F.lit(amin))) - r))
        return let(db, lambda d: let(F.array_max(F.flatten(d)),
                                     lambda top: map_cells(d, lambda x: F.greatest(x, top - F.lit(top_db)))))
    return let(m, body)


def pad_or_cut_rows(m, n: int, fill: float = 0.0) -> Column:
    """Pad with constant rows or cut to exactly ``n`` rows (a matrix
    without rows has width 0, and so have its padding rows)."""
    zero_row = F.array_repeat(F.lit(fill), n_cols(m))
    return F.slice(F.concat(_c(m), F.array_repeat(zero_row, F.lit(n))), 1, n)


def pad_or_cut_1d(y, n: int, fill: float = 0.0) -> Column:
    return F.slice(F.concat(_c(y), F.array_repeat(F.lit(fill), n)), 1, n)


def transpose(m) -> Column:
    """R6. A matrix without rows or columns becomes the empty matrix; a cell
    that a ragged row lacks is null."""
    def body(mm):
        width = n_cols(mm)
        turned = F.transform(F.sequence(F.lit(1), F.greatest(width, F.lit(1))),
                             lambda j: F.transform(mm, lambda row: F.try_element_at(row, j)))
        return F.when(width > 0, turned).when(width == 0, F.slice(turned, 1, 0))
    return let(m, body)


def stack_rows(*blocks) -> Column:
    """Concatenate matrices along the row axis."""
    return F.concat(*[_c(b) for b in blocks])


def repeat_channels(m, k: int = 3) -> Column:
    """``k`` copies of the matrix as channels."""
    return F.array_repeat(_c(m), k)


def _resize_axis(m, out: int) -> Column:
    """Linear resize of the row axis with half-pixel centres (no corner alignment)."""
    return let(m, lambda mm: _resize_rows_bound(mm, out))


def _resize_rows_bound(mm: Column, out: int) -> Column:
    n = n_rows(mm)

    def row(i):
        src = F.greatest((i.cast("double") + F.lit(0.5)) * n / F.lit(float(out)) - F.lit(0.5), F.lit(0.0))
        i0 = F.floor(src).cast("int")
        i1 = F.least(i0 + 1, n - 1)
        lam = src - i0
        r0, r1 = F.element_at(mm, i0 + 1), F.element_at(mm, i1 + 1)
        return F.zip_with(r0, r1, lambda a, b: a * (F.lit(1.0) - lam) + b * lam)

    return F.transform(F.sequence(F.lit(0), F.lit(out - 1)), row)


def resize(m, rows: int, cols: int) -> Column:
    """Bilinear resize, rows then columns. A matrix without cells stays
    empty, as there is nothing to interpolate."""
    def body(mm):
        sized = transpose(_resize_axis(transpose(_resize_axis(mm, rows)), cols))
        return F.when((n_rows(mm) > 0) & (n_cols(mm) > 0), sized).when(mm.isNotNull(), F.slice(mm, 1, 0))
    return let(m, body)


def pcm16_roundtrip(y) -> Column:
    """Quantise to 16-bit PCM (truncation) and back. Samples beyond full
    scale are clipped to it; not-a-number becomes silence."""
    def sample(x):
        v = F.least(F.greatest(x * F.lit(PCM_SCALE), F.lit(-32768.0)), F.lit(32767.0))
        return F.when(F.isnan(x), F.lit(0.0)).otherwise(v.cast("short").cast("double") / F.lit(float(PCM_SCALE)))
    return F.transform(_c(y), sample)


def zero_fallback(m, min_cells: int, rows: int, cols: int) -> Column:
    """A zero matrix when the input is null or has fewer than ``min_cells`` cells."""
    zeros = F.array_repeat(F.array_repeat(F.lit(0.0), cols), rows)
    return F.when(_c(m).isNull() | (F.size(F.flatten(_c(m))) < min_cells), zeros).otherwise(_c(m))


def softmax(v) -> Column:
    """R13 on a vector."""
    def body(v):
        e = let(F.array_max(v), lambda mx: F.transform(v, lambda x: F.exp(x - mx)))
        return let(e, lambda ee: let(_sum(ee), lambda s: F.transform(ee, lambda x: x / s)))
    return let(v, body)


def softmax_rows(m) -> Column:
    return F.transform(_c(m), lambda row: softmax(row))


def attention_pool(m, scores) -> Column:
    """sum_t softmax(scores)_t * m[t] (one pooled vector per matrix)."""
    def body(mm, a):
        zero = F.array_repeat(F.lit(0.0), n_cols(mm))
        weighted = F.zip_with(mm, a, lambda row, w: F.transform(row, lambda x: x * w))
        return F.aggregate(weighted, zero, lambda acc, row: F.zip_with(acc, row, lambda p, q: p + q))
    return let(F.struct(_c(m).alias("m"), softmax(scores).alias("a")), lambda b: body(b["m"], b["a"]))


def one_hot(label, k: int) -> Column:
    """R17."""
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.when(i == _c(label), 1).otherwise(0))


def argmax(v) -> Column:
    """Index of the largest value, ties to the first."""
    return F.array_position(_c(v), F.array_max(_c(v))) - 1


def _u(key: Column, k: int) -> Column:
    """Deterministic uniform integer in [0, 2^32) from the row key and draw number."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(k)))), 1, 8), 16, 10).cast("long")


def _randint(key: Column, k: int, lo, hi) -> Column:
    """Uniform integer in [lo, hi] (inclusive)."""
    return _c(lo) + (_u(key, k) % (_c(hi) - _c(lo) + 1))


def band_mask(m, key, seed: int = 42, freq_max: int = FREQ_MASK_MAX, time_max: int = TIME_MASK_MAX) -> Column:
    """With p = 0.5 zero 1-2 row bands of width 0..freq_max; with p = 0.5 zero one
    column band of width 0..time_max. Draws come from md5(key:seed:draw)."""
    k = F.concat_ws(":", _c(key).cast("string"), F.lit(str(seed)))

    def draws(mm):
        R, C = n_rows(mm), n_cols(mm)
        fmax = F.least(F.lit(freq_max), R)
        tmax = F.least(F.lit(time_max), C)
        f1 = _randint(k, 2, F.lit(0), fmax)
        f2 = _randint(k, 4, F.lit(0), fmax)
        t = _randint(k, 7, F.lit(0), tmax)
        return F.struct(((_u(k, 0) % 2) == 0).alias("do_f"), _randint(k, 1, F.lit(1), F.lit(2)).alias("nf"),
                        f1.alias("f1"), _randint(k, 3, F.lit(0), R - f1).alias("f10"),
                        f2.alias("f2"), _randint(k, 5, F.lit(0), R - f2).alias("f20"),
                        ((_u(k, 6) % 2) == 0).alias("do_t"), t.alias("t"), _randint(k, 8, F.lit(0), C - t).alias("t0"))

    def in_band(i, s, w):
        return (i >= s) & (i < s + w)

    def apply(mm, d):
        def row_masked(i):
            return (d["do_f"] & in_band(i, d["f10"], d["f1"])) | \
                (d["do_f"] & (d["nf"] == 2) & in_band(i, d["f20"], d["f2"]))
        return F.transform(mm, lambda row, i: F.transform(
            row, lambda x, j: F.when(row_masked(i) | (d["do_t"] & in_band(j, d["t0"], d["t"])), F.lit(0.0))
            .otherwise(x)))

    return let(m, lambda mm: let(draws(mm), lambda d: apply(mm, d)))


def parse_matrix(s) -> Column:
    """JSON text of a matrix to ``array<array<double>>``; arrays pass through."""
    return F.from_json(_c(s), MATRIX)


def matrix_json(m) -> Column:
    return F.to_json(_c(m))
