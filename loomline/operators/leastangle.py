"""Least-angle regression on sums of products, and what each column adds to a row's prediction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.operators.factors import check_arguments, moments

#: Correlations this close count as equal, and a column with this share of its variance left counts as explained.
TIE = 1e-9


def least_angle(m: tuple, most: int | None = None) -> tuple[np.ndarray, float, list[tuple[int, float]]]:
    """(weights, offset, path) of the last column on the others, from moments (n, sums, products).

    Columns are scaled to unit variance. One joins when its correlation with what is left of
    the target is as large as that of those which are in; path holds it with that correlation.
    The common one falls as weights move along the direction that keeps them equal, to where
    column most + 1 would join, or to 0, where the weights are those of least squares. Equal
    correlations go by column number; constant columns, and those that columns inside
    explain, never join.
    """
    n, s, p = m
    mean = s / max(n, 1)
    cov = p / max(n, 1) - np.outer(mean, mean)
    spread = np.sqrt(np.maximum(np.diag(cov), 0))
    floor = 1e-7 * np.maximum(1.0, np.sqrt(np.maximum(np.diag(p) / max(n, 1), 0)))
    k = len(s) - 1
    path: list[tuple[int, float]] = []
    w = np.zeros(k)
    if n and spread[-1] > floor[-1]:
        usable = spread[:-1] > floor[:-1]
        scale = np.where(spread > floor, spread, 1.0)
        g = cov / np.outer(scale, scale)
        g, left = g[:-1, :-1], np.where(usable, g[:-1, -1], 0.0)
        inside: list[int] = []
        common = float(np.abs(left).max(initial=0.0))
        while common > TIE:
            ready = np.flatnonzero(usable & (np.abs(left) >= common - TIE))
            if len(ready):
                if most is not None and len(inside) >= most:
                    break
                j = int(ready[0])
                usable[j] = False
                known = np.linalg.lstsq(g[np.ix_(inside, inside)], g[inside, j], rcond=None)[0]
                if g[j, j] - g[inside, j] @ known > TIE:
                    inside.append(j)
                    path.append((j, common))
                continue
            d = np.linalg.solve(g[np.ix_(inside, inside)], np.sign(left[inside]))
            fall = g[:, inside] @ d
            with np.errstate(divide="ignore", invalid="ignore"):
                steps = np.concatenate(((common - left) / (1 - fall), (common + left) / (1 + fall)))
            ahead = steps[np.concatenate((usable, usable)) & np.isfinite(steps) & (steps > 0)]
            step = min(common, float(ahead.min(initial=common)))
            w[inside] += step * d
            left = left - step * fall
            common -= step
        w = w * scale[-1] / scale[:-1]
    return w, float(mean[-1] - mean[:-1] @ w), path


def _number(c: str) -> Column:
    return F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0))


def _fitted(rows: DataFrame, target: str, features: list[str], test: Column, most: int | None) -> tuple[np.ndarray, np.ndarray]:
    check_arguments(rows, target, features)
    parts = moments(rows, features, target, F.coalesce(test, F.lit(False)).cast("int"))
    part = parts.get(0, (0, np.zeros(len(features) + 1), np.zeros((len(features) + 1,) * 2)))
    return least_angle(part, most)[0], part[1][:-1] / max(part[0], 1)


def least_angle_path(rows: DataFrame, target: str, features: list[str], most: int | None = None) -> DataFrame:
    """(step, feature, correlation, weight): features in the order they join, and their weights at the end of the path.

    One pass over the rows; null counts as 0. Tables without rows, and targets without variance, give no rows.
    """
    check_arguments(rows, target, features)
    parts = moments(rows, features, target)
    w, _, path = least_angle(parts[0], most) if parts else (None, 0.0, [])
    out = [(i, features[j], c, float(w[j])) for i, (j, c) in enumerate(path, 1)]
    return rows.sparkSession.createDataFrame(out, "step int, feature string, correlation double, weight double")


def attributions(rows: DataFrame, keys: list[str], target: str, features: list[str], test: Column, most: int | None = None) -> DataFrame:
    """(keys, feature, attribution) of every row that `test` says, for each feature.

    The fit and the means are of the other rows (a null test among them); an attribution is
    weight * (value - mean), so that those of a row add up to its prediction less the mean
    one. Null values count as 0. Two passes over the rows, no shuffle of them.
    """
    w, mean = _fitted(rows, target, features, test, most)
    each = F.array(*(F.struct(F.lit(f).alias("feature"), (F.lit(float(a)) * (_number(f) - F.lit(float(b)))).alias("attribution")) for f, a, b in zip(features, w, mean, strict=True)))
    return rows.filter(test).select(*keys, F.explode(each).alias("_x")).select(*keys, "_x.feature", "_x.attribution")


def first_row_shares(rows: DataFrame, keys: list[str], target: str, groups: dict[str, list[str]], test: Column, most: int | None = None) -> DataFrame:
    """(feature, share): the attributions of the first test row by the keys, in percent of their sum.

    groups names the columns of each feature; several have the norm of their attributions
    over their number, so all shares are positive. Where nothing is attributed they are 0.
    """
    columns = [c for g in groups.values() for c in g]
    w, mean = _fitted(rows, target, columns, test, most)
    first = rows.filter(test).orderBy(*keys, *(F.col(f"`{c}`") for c in columns)).select(*(_number(c).alias(f"x{i}") for i, c in enumerate(columns))).limit(1).collect()
    schema = "feature string, share double"
    if not first:
        return rows.sparkSession.createDataFrame([], schema)
    own = dict(zip(columns, (w * (np.array(first[0], float) - mean)).tolist(), strict=True))
    size = {f: float(np.sqrt(sum(own[c] ** 2 for c in g))) / len(g) for f, g in groups.items()}
    whole = sum(size.values())
    return rows.sparkSession.createDataFrame([(f, 100 * x / whole if whole > 0 else 0.0) for f, x in size.items()], schema)
