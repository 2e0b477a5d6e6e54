"""Gradient-boosted regression trees over counted cells in one process.

The trees are those of Spark's ``DecisionTreeRegressor`` (variance, every bin a
split point, a nominal feature split by the means of its categories, the first
of equal gains), in the rows of Spark ML's saved form.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

# ---- fixed values ----
EPSILON = 2.0 ** -52           # a child of less impurity is a leaf
NODES = ("treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, "
         "gain: double, leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, "
         "numCategories: int>>")
FIELDS = ("id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split")
SPLIT = ("featureIndex", "leftCategoriesOrThreshold", "numCategories")


def draws(n: int, key: int, rate: float, iters: int, seed: int) -> np.ndarray:
    """Of a cell's ``n`` rows, how many each iteration takes; by the seed and the key only."""
    return np.random.default_rng([seed, key & (2**64 - 1)]).binomial(n, rate, iters)


def grow(codes: np.ndarray, values: Sequence[np.ndarray], arity: Sequence[int], w: np.ndarray, y: np.ndarray, depth: int) -> tuple[list, np.ndarray]:
    """One tree for targets ``y`` of weights ``w``: its nodes, and what it predicts for each cell.

    ``codes[f]`` is the place of a cell's value in ``values[f]``; ``arity[f]`` is -1 for a numeric feature."""
    if not w.sum() > 0:
        raise ValueError("a tree drew no rows")
    k = max(map(len, values))
    at, every = np.zeros(len(w), np.int64), np.arange(len(w))    # the cell's node in the level; one past the last: in a leaf
    wy, seen = w * y, (w > 0).astype(np.float64)
    wyy, out, nodes, ids, last = wy * y, np.zeros(len(w)), [], [0], 0
    for level in range(depth + 1):
        m = len(ids)
        n, s, q, raw = (np.bincount(at, x, m + 1)[:m] for x in (w, wy, wyy, seen))
        impurity = (q - s * s / n) / n
        gains, ends, orders = [], [], []
        for f in range(len(codes) if level < depth else 0):
            cn, cs = (np.bincount(at * k + codes[f], x, (m + 1) * k)[:m * k].reshape(m, k) for x in (w, wy))
            order = np.broadcast_to(np.arange(k), (m, k))
            if arity[f] >= 0:
                order = np.argsort(np.where(cn > 0, cs / np.where(cn > 0, cn, 1), np.inf), axis=1, kind="stable")
            ln, ls = (np.cumsum(np.take_along_axis(x, order, 1), 1) for x in (cn, cs))
            rn, rs = n[:, None] - ln, s[:, None] - ls
            both = (ln > 0) & (rn > 0)
            gain = np.where(both, ls * ls / np.where(both, ln, 1) + rs * rs / np.where(both, rn, 1) - (s * s / n)[:, None], -np.inf) / n[:, None]
            ends.append(gain.argmax(1))
            gains.append(gain.max(1))
            orders.append(order)
        best = np.argmax(gains, axis=0) if gains else np.zeros(m, np.int64)
        feature, step, below = np.zeros(m + 1, np.int64), np.full((m + 1, k), -1), []
        for i, node in enumerate(ids):
            f = int(best[i])
            stats = (float(s[i] / n[i]), float(impurity[i]), [float(n[i]), float(s[i]), float(q[i])], int(raw[i]))
            if not gains or gains[f][i] <= 0 or (level and abs(impurity[i]) < EPSILON):
                nodes.append((node, *stats, -1.0, -1, -1, (-1, [], -1)))
                out[at == i] = stats[0]
                continue
            feature[i], end = f, ends[f][i]
            if arity[f] >= 0:
                left = np.sort(orders[f][i, :end + 1])
                split = (f, [float(v) for v in values[f][left]], arity[f])
            else:                                                # half way to the next value that any row drawn has
                after = values[f][np.unique(codes[f][w > 0])]
                after = after[after > values[f][end]][0]
                split = (f, [float((values[f][end] + after) / 2)], -1)
                left = np.flatnonzero(values[f] <= split[1][0])
            step[i] = len(below) + 1
            step[i, left] = len(below)
            below += [last + 1, last + 2]
            last += 2
            nodes.append((node, *stats, float(gains[f][i]), last - 1, last, split))
        if not below:
            break
        at = step[at, codes[feature[at], every]]
        at[at < 0] = len(below)
        ids = below
    return nodes, out


def boosted(cells: np.ndarray, label: np.ndarray, n: np.ndarray, key: np.ndarray, arity: Sequence[int], iters: int, step: float, depth: int,
            subsample: float, seed: int) -> Iterator[tuple]:
    """Rows of ``NODES`` for ``iters`` trees of log loss over cells of ``n`` rows each (``cells[f]``: the bins, ``label``: 0 or 1)."""
    by = np.lexsort([label, *cells])                             # sums in one order, however the cells came
    cells, label, n, key = cells[:, by], label[by], n[by], key[by]
    values, codes = zip(*[np.unique(c, return_inverse=True) for c in cells])
    codes = np.array(codes)
    drawn = np.empty((len(n), iters), np.min_scalar_type(int(n.max())))
    for i in range(len(n)):
        drawn[i] = draws(int(n[i]), int(key[i]), subsample, iters, seed)
    y, margin = np.where(label == 1, 1.0, -1.0), np.zeros(len(n))
    for i in range(iters):
        # the first tree is fitted to the labels, the next ones to the negative gradient
        residual = y if i == 0 else 4 * y / (1 + np.exp(2 * y * margin))
        nodes, out = grow(codes, values, arity, drawn[:, i].astype(np.float64), residual, depth)
        margin += (1.0 if i == 0 else step) * out
        for node in nodes:
            yield i, dict(zip(FIELDS, (*node[:-1], dict(zip(SPLIT, node[-1])))))
