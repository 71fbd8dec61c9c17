"""Choice of columns for linear models, from sums of products by fold.

One pass over the rows gives a matrix of sums for each fold; whatever is tried after that
costs nothing but small matrices on the driver, whose size is the number of columns.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.operators.factors import _add, check_arguments, moments

#: Variance below this share of a column's own counts as none.
TINY = 1e-10


class Folds:
    """Moments by fold: for each, the covariance of the other folds and its own products around their mean."""

    def __init__(self, parts: dict[int, tuple]):
        self.pairs = []
        for f, (n, s, p) in sorted(parts.items()):
            if not (rest := [v for j, v in parts.items() if j != f]):
                continue
            m, total, products = _add(rest)
            mean = total / m
            own = p - np.outer(s, mean) - np.outer(mean, s) + n * np.outer(mean, mean)
            around = np.diag(p) - s * s / n
            self.pairs.append((products - m * np.outer(mean, mean), own, around))

    def score(self, chosen: list[int], target: int) -> float:
        """Mean held-out r2 of the target by the chosen columns; 0 in folds where it is constant."""
        out = []
        for c, d, around in self.pairs:
            w = _weights(c, chosen, target)
            out.append(_r2(d[target, target] - 2 * w @ d[chosen, target] + w @ d[np.ix_(chosen, chosen)] @ w, around[target]))
        return float(np.mean(out)) if out else 0.0

    def with_each(self, chosen: list[int], target: int) -> np.ndarray:
        """score(chosen + [j], target) for every column j at once; minus infinity for those that are in it."""
        out = []
        for c, d, around in self.pairs:
            b = _weights(c, chosen, slice(None))
            left = np.diag(c) - (c[chosen] * b).sum(axis=0)
            ahead = c[target] - c[chosen, target] @ b
            w = np.where(left > TINY * np.diag(c), ahead / np.where(left > 0, left, 1), 0.0)
            v = b[:, [target]] - b * w
            inner = np.einsum("ij,ij->j", v, d[np.ix_(chosen, chosen)] @ v) + 2 * w * (v * d[chosen]).sum(axis=0) + w * w * np.diag(d)
            out.append(_r2(d[target, target] - 2 * (d[chosen, target] @ v + w * d[target]) + inner, around[target]))
        score = np.mean(out, axis=0) if out else np.zeros(0)
        if len(score):
            score[[*chosen, target]] = -np.inf
        return score


def _weights(c: np.ndarray, chosen: list[int], target) -> np.ndarray:
    x = c[np.ix_(chosen, chosen)]
    scale = np.sqrt(np.maximum(np.diag(x), 0))
    scale = np.where(scale > 0, scale, 1.0)
    y = (c[chosen][:, target].T / scale).T
    return (np.linalg.lstsq(x / np.outer(scale, scale), y, rcond=TINY)[0].T / scale).T


def _r2(squares, around):
    return 1 - squares / around if around > TINY else np.zeros_like(squares, dtype=float)


def floating_selection(folds: Folds, target: int, most: int, gain: float = 0.01) -> tuple[list[int], float]:
    """Columns in the order they were taken, and their held-out r2.

    Each step takes the column that lifts held-out r2 most; then those go whose loss leaves
    more than the best set of that size had. Sets may grow to two columns more than `most` on
    the way. Of the best sets of each size up to `most` the smallest counts that no larger
    one beats by `gain` for each column more.
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    chosen: list[int] = []
    while len(chosen) < most + 2:
        score = folds.with_each(chosen, target)
        if not len(score) or not np.isfinite(score.max()):
            break
        j = int(score.argmax())
        chosen = [*chosen, j]
        if len(chosen) in best and best[len(chosen)][0] >= score[j]:
            break
        best[len(chosen)] = (float(score[j]), chosen)
        while len(chosen) > 2:
            less = [[x for x in chosen if x != i] for i in chosen[:-1]]
            scores = [folds.score(x, target) for x in less]
            i = int(np.argmax(scores))
            if scores[i] <= best[len(chosen) - 1][0] + 1e-12:
                break
            chosen = less[i]
            best[len(chosen)] = (scores[i], chosen)
    size = 0
    for k in sorted(k for k in best if k <= most):
        if best[k][0] - best[size][0] >= gain * (k - size) > 0:
            size = k
    return best[size][1], best[size][0]


def _fold(key: str, folds: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(folds))


def feature_influence(pivoted: DataFrame, key: str, most: int = 3, folds: int = 5, fold: Column | None = None, gain: float = 0.01) -> DataFrame:
    """(activity, selected): how often a column is picked to predict another one.

    For each column a floating selection among the others looks for the best held-out r2 of
    a linear fit. Folds follow the key's hash, or `fold`. Everything follows from one table
    of moments, so the log is read once; null counts as 0. One fold alone selects nothing.
    """
    columns = [c for c in pivoted.columns if c != key]
    spark = pivoted.sparkSession
    counts = dict.fromkeys(columns, 0)
    if len(columns) > 1:
        known = Folds(moments(pivoted, columns[:-1], columns[-1], fold if fold is not None else _fold(key, folds)))
        for t in range(len(columns)):
            for i in floating_selection(known, t, most, gain)[0]:
                counts[columns[i]] += 1
    return spark.createDataFrame(list(counts.items()), "activity string, selected int")


def all_regressions(m: tuple, alpha: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """(W, r2): the fit of every column on all others; W[j, t] is the weight of j for t.

    All follow from one inverse P of the covariance: W[j, t] = -P[j, t] / P[t, t]. Constant
    columns have no weight. Where columns depend on each other, each fit is solved on its own.
    """
    n, s, p = m
    cov = p - np.outer(s, s) / n
    k = len(s)
    w, spread = np.zeros((k, k)), np.diag(cov)
    some = np.flatnonzero(spread > TINY * max(1.0, float(np.abs(np.diag(p)).max(initial=0))))
    c = cov[np.ix_(some, some)] + alpha * np.eye(len(some))
    scale = np.sqrt(np.diag(c))
    near = c / np.outer(scale, scale)
    if len(some) and np.linalg.eigvalsh(near)[0] > TINY:
        inverse = np.linalg.inv(near)
        part = -inverse / np.diag(inverse) * scale[None, :] / scale[:, None]
        np.fill_diagonal(part, 0)
        w[np.ix_(some, some)] = part
    else:
        for t in some.tolist():
            others = [i for i in some.tolist() if i != t]
            w[others, t] = np.linalg.lstsq(cov[np.ix_(others, others)] + alpha * np.eye(len(others)), cov[others, t], rcond=None)[0]
    u = np.eye(k) - w
    squares = np.einsum("it,ij,jt->t", u, cov, u, optimize=True)
    fit = np.where(spread > 1e-12, 1 - squares / np.where(spread > 1e-12, spread, 1), 0.0)
    return w, fit if k > 1 else np.zeros(k)


def matching_pursuit(cov: np.ndarray, most: int) -> list[int]:
    """Columns in the order of orthogonal matching pursuit of the last one."""
    chosen: list[int] = []
    spread = np.sqrt(np.maximum(np.diag(cov)[:-1], 0))
    usable = spread > 0
    for _ in range(min(most, int(usable.sum()))):
        left = cov[:-1, -1] - cov[:-1][:, chosen] @ _weights(cov, chosen, -1)
        match = np.where(usable, np.abs(left) / np.where(usable, spread, 1), -1.0)
        match[chosen] = -1.0
        chosen.append(int(match.argmax()))
    return chosen


def backward_elimination(cov: np.ndarray, least: int) -> list[int]:
    """Columns that stay when the one whose loss raises the squared error of the last column least goes, again and again."""
    chosen = [int(i) for i in np.flatnonzero(np.diag(cov)[:-1] > 0)]
    while len(chosen) > least:
        # Without column i the error rises by w_i^2 / (inverse)_ii.
        inverse = np.linalg.pinv(cov[np.ix_(chosen, chosen)], hermitian=True)
        w = inverse @ cov[chosen, -1]
        rise = w * w / np.maximum(np.diag(inverse), 1e-300)
        chosen.pop(int(rise.argmin()))
    return chosen


def best_alone(cov: np.ndarray, most: int) -> list[int]:
    spread = np.diag(cov)
    score = np.where(spread[:-1] > 0, cov[:-1, -1] ** 2 / np.where(spread[:-1] > 0, spread[:-1], 1), -1.0)
    return np.argsort(-score, kind="stable")[:most].tolist()


SELECTORS: dict[str, Callable[[np.ndarray, int], list[int]]] = {"k_best": best_alone, "matching_pursuit": matching_pursuit, "backward": backward_elimination}


def select_features(rows: DataFrame, target: str, features: list[str], held_out: Column, share: float = 0.3) -> DataFrame:
    """(selector, feature, mape, chosen): what three selectors keep, a share of the features and one at least.

    Each selector's columns are fitted by least squares on the rows that are not held out;
    mape is that of the held-out rows whose target is not 0, and the selector with the
    smallest, the first by name on ties, is chosen. Two passes over the rows.
    """
    check_arguments(rows, target, features)
    part = moments(rows, features, target, held_out.cast("int"))
    spark = rows.sparkSession
    schema = "selector string, feature string, mape double, chosen boolean"
    if 0 not in part:
        return spark.createDataFrame([], schema)
    n, s, p = part[0]
    mean = s / n
    cov = p - n * np.outer(mean, mean)
    most = max(1, int(len(features) * share))
    picked = {name: f(cov, most) for name, f in sorted(SELECTORS.items())}
    y = F.coalesce(F.col(f"`{target}`").cast("double"), F.lit(0.0))
    errors = []
    for name, chosen in picked.items():
        w = _weights(cov, chosen, -1)
        guess = F.lit(float(mean[-1] - mean[chosen] @ w))
        for i, x in zip(chosen, w.tolist(), strict=True):
            guess = guess + F.coalesce(F.col(f"`{features[i]}`").cast("double"), F.lit(0.0)) * x
        errors.append(F.avg(F.abs(y - guess) / F.abs(F.nullif(y, F.lit(0.0)))).alias(name))
    mape = rows.filter(held_out).agg(*errors).first().asDict()
    best = min(picked, key=lambda name: (mape[name] is None, mape[name] or 0.0))
    return spark.createDataFrame([(name, features[i], mape[name], name == best) for name, chosen in picked.items() for i in chosen], schema)
