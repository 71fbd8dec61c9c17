"""Boosted regression trees over histograms, their held-out errors, and permutation importance.

Values fall into bins by approximate quantiles. A level of a tree is one aggregation: tasks
sum residuals by node, column and bin for all models at once, and the driver, which sees
as many sums as there are of these, chooses the splits. Trees are arrays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.operators.ranking import permuted

#: Sums that one level may bring to the driver.
MOST = 4_000_000


@dataclass
class Forest:
    """Boosted trees of one target. Node i of a tree has its children at 2i + 1 and 2i + 2; a leaf has column -1."""

    target: str
    columns: list[str]
    start: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def nodes(self, tree: tuple[np.ndarray, np.ndarray, np.ndarray], x: np.ndarray) -> np.ndarray:
        column, cut, _ = tree
        at = np.zeros(len(x), np.int64)
        for _ in range(int(np.log2(len(column) + 1)) - 1):
            c = column[at]
            right = x[np.arange(len(x)), np.maximum(c, 0)] > cut[at]
            at = np.where(c < 0, at, 2 * at + 1 + right)
        return at

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for tree in self.trees:
            out += tree[2][self.nodes(tree, x)]
        return out


def _matrix(df: DataFrame, columns: list[str], fold: Column | None) -> DataFrame:
    x = F.array(*(F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in columns))
    return df.select((fold if fold is not None else F.lit(-1)).cast("long").alias("fold"), x.alias("x"))


def _arrays(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray]:
    return batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)


def bin_edges(df: DataFrame, columns: list[str], bins: int) -> list[np.ndarray]:
    """The upper ends of each column's bins, its approximate quantiles; the largest value ends the last bin."""
    shares = [(i + 1) / bins for i in range(bins)]
    row = df.agg(*(F.percentile_approx(F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)), shares, 10_000).alias(f"e{i}") for i, c in enumerate(columns))).first()
    return [np.unique(np.array(row[f"e{i}"] or [0.0]))[:-1] for i in range(len(columns))]


def _level(models: list[tuple[int, int, Forest]], edges: list[np.ndarray], depth: int, columns: list[str]) -> Callable:
    """Sums of residuals of the models' last trees at this depth, by model, node, column and bin."""
    k, bins = len(columns), max(len(e) for e in edges) + 1
    at = {c: i for i, c in enumerate(columns)}
    size = 1 << depth

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(models), k, 2, size * bins))
        for batch in batches:
            fold, x = _arrays(batch, k)
            binned = np.stack([np.searchsorted(e, x[:, i]) for i, e in enumerate(edges)])
            for m, (_, f, forest) in enumerate(models):
                own = fold != f if f >= 0 else np.ones(len(x), bool)
                part = x[own]
                *done, last = forest.trees
                left = part[:, at[forest.target]] - Forest(forest.target, columns, forest.start, done).predict(part)
                node = forest.nodes(last, part) - (size - 1)
                live = node >= 0
                for i in range(k):
                    if columns[i] != forest.target:
                        slot = node[live] * bins + binned[i, own][live]
                        total[m, i, 0] += np.bincount(slot, minlength=size * bins)
                        total[m, i, 1] += np.bincount(slot, left[live], minlength=size * bins)
        m, i, slot = np.nonzero(total[:, :, 0])
        yield pa.RecordBatch.from_arrays([pa.array(v.astype(np.int32)) for v in (m, i, slot)] + [pa.array(total[m, i, j, slot]) for j in (0, 1)], ["m", "i", "slot", "n", "g"])

    return run


def fit(df: DataFrame, columns: list[str], targets: list[str], fold: Column | None = None, folds: list[int] = (-1,), trees: int = 10, depth: int = 2, rate: float = 0.3, bins: int = 32, least: int = 1) -> dict[tuple[str, int], Forest]:
    """A forest for each target, from all other columns, and each fold, from the rows outside of it; fold -1 leaves none out.

    A leaf holds `least` rows at least; a node is split where the squared error falls most,
    at the first column and the lowest value on ties, and not at all if it does not fall.
    Nulls count as 0. An empty table, and a single column, give forests of their mean.
    """
    if len(targets) * len(folds) * len(columns) * bins * (1 << (depth - 1)) > MOST:
        raise ValueError("too many sums for one level: fewer targets, folds, bins or levels are needed")
    rows = _matrix(df, columns, fold)
    means = rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), *(F.sum(F.col("x")[columns.index(t)]).alias(f"s{i}") for i, t in enumerate(targets))).collect()
    models = []
    for i, t in enumerate(targets):
        for f in folds:
            n = sum(r.n for r in means if f < 0 or r.fold != f)
            models.append((i, f, Forest(t, columns, sum(r[f"s{i}"] for r in means if f < 0 or r.fold != f) / n if n else 0.0)))
    edges = bin_edges(df, columns, bins) if means and len(columns) > 1 else []
    width = max((len(e) for e in edges), default=0) + 1
    for _ in range(trees if width > 1 else 0):
        nodes = (1 << (depth + 1)) - 1
        for _, _, forest in models:
            forest.trees.append((np.full(nodes, -1), np.zeros(nodes), np.zeros(nodes)))
        for level in range(depth):
            size = 1 << level
            sums = rows.mapInArrow(_level(models, edges, level, columns), "m int, i int, slot int, n double, g double").groupBy("m", "i", "slot").agg(F.sum("n").alias("n"), F.sum("g").alias("g")).toPandas()
            total = np.zeros((len(models), len(columns), 2, size, width))
            for j, c in enumerate(("n", "g")):
                total[sums.m, sums.i, j, sums.slot // width, sums.slot % width] = sums[c]
            for m, (_, _, forest) in enumerate(models):
                _split(forest, total[m], edges, size - 1, rate, least)
    return {(targets[i], f): forest for i, f, forest in models}


def _split(forest: Forest, total: np.ndarray, edges: list[np.ndarray], first: int, rate: float, least: int) -> None:
    """Splits the nodes of one level of the last tree; total is by column, rows or residuals, node and bin."""
    column, cut, value = forest.trees[-1]
    for node in range(total.shape[2]):
        best, choice = 1e-12, None
        for i, e in enumerate(edges):
            n, g = total[i, 0, node], total[i, 1, node]
            if not n.sum() or not len(e):
                continue
            ln, lg = np.cumsum(n)[: len(e)], np.cumsum(g)[: len(e)]
            rn, rg = n.sum() - ln, g.sum() - lg
            fine = (ln >= least) & (rn >= least) & (ln > 0) & (rn > 0)
            gain = np.where(fine, lg**2 / np.maximum(ln, 1) + rg**2 / np.maximum(rn, 1) - g.sum() ** 2 / n.sum(), -1.0)
            j = int(gain.argmax())
            if gain[j] > best * (1 + 1e-9):
                best, choice = gain[j], (i, e[j], lg[j] / max(ln[j], 1), rg[j] / max(rn[j], 1))
        at = first + node
        if choice:
            column[at], cut[at] = choice[0], choice[1]
            value[2 * at + 1], value[2 * at + 2] = rate * choice[2], rate * choice[3]


def held_out_errors(df: DataFrame, key: str, targets: list[str] | None = None, folds: int = 5, fold: Column | None = None, **how) -> DataFrame:
    """(activity, n, mae, r2): how well each column of a case matrix follows from the others.

    Each row is predicted by trees learnt from the other folds, which follow the key's hash
    or `fold`, numbers from 0. r2 is 0 for a constant column.
    """
    columns = [c for c in df.columns if c != key]
    targets = targets or columns
    fold = fold if fold is not None else F.pmod(F.xxhash64(key), F.lit(folds))
    forests = fit(df, columns, targets, fold, list(range(folds)), **how)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(targets), 5))
        for batch in batches:
            of, x = _arrays(batch, len(columns))
            for i, t in enumerate(targets):
                y = x[:, columns.index(t)]
                for f in np.unique(of).tolist():
                    own = of == f
                    e = y[own] - forests[t, f].predict(x[own])
                    total[i] += len(e), np.abs(e).sum(), (e * e).sum(), y[own].sum(), (y[own] ** 2).sum()
        yield pa.RecordBatch.from_arrays([pa.array(targets), *(pa.array(c) for c in total.T)], ["activity", "n", "a", "e", "s", "q"])

    sums = _matrix(df, columns, fold).mapInArrow(run, "activity string, n double, a double, e double, s double, q double").groupBy("activity").agg(*(F.sum(c).alias(c) for c in ("n", "a", "e", "s", "q")))
    around = F.col("q") - F.col("s") ** 2 / F.nullif(F.col("n"), F.lit(0.0))
    return sums.select("activity", F.col("n").cast("long").alias("n"), (F.col("a") / F.nullif(F.col("n"), F.lit(0.0))).alias("mae"), F.when(around > 1e-9, 1 - F.col("e") / around).otherwise(0.0).alias("r2"))


def permutation_importance(df: DataFrame, key: str, columns: list[str], target: str, predict: Callable[[np.ndarray], np.ndarray], repeats: int = 10) -> DataFrame:
    """(feature, importance, spread): by how much the mean squared error of a model rises when a column is shuffled.

    predict takes an array with a column for each of columns. All columns of a row are taken
    from one other row at a time, one of them for each prediction; importance is the mean
    over the seeds 1 to repeats, spread their standard deviation. Nulls count as 0.
    """
    k = len(columns)
    values = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(f"x{i}") for i, c in enumerate((target, *columns))]
    moved = [f"x{i + 1}" for i in range(k)]
    rows = permuted(df.select(F.col(key).alias("_id"), *values), "_id", moved, list(range(1, repeats + 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((repeats + 1, k))
        n = np.zeros(repeats + 1)
        for batch in batches:
            seed, *values = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2 * k + 2))
            x, other = np.column_stack(values[: k + 1]), np.column_stack(values[k + 1 :])
            plain = (x[:, 0] - predict(x[:, 1:])) ** 2
            for i in range(k):
                mixed = x[:, 1:].copy()
                mixed[:, i] = other[:, i]
                total[:, i] += np.bincount(seed, (x[:, 0] - predict(mixed)) ** 2 - plain, minlength=repeats + 1)
            n += np.bincount(seed, minlength=repeats + 1)
        s, i = np.nonzero(np.repeat(n[:, None], k, axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(s.astype(np.int32)), pa.array([columns[j] for j in i]), pa.array(total[s, i]), pa.array(n[s])], ["seed", "feature", "e", "n"])

    sums = rows.select("seed", *(f"x{i}" for i in range(k + 1)), *(f"p_{c}" for c in moved)).mapInArrow(run, "seed int, feature string, e double, n double")
    by_seed = sums.groupBy("seed", "feature").agg((F.sum("e") / F.sum("n")).alias("rise"))
    return by_seed.groupBy("feature").agg(F.avg("rise").alias("importance"), F.stddev_pop("rise").alias("spread"))
