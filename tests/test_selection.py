"""Selection of columns against least squares on the rows themselves."""

from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomline.operators import factors, insights, selection


def data(n=400, seed=1):
    rnd = np.random.default_rng(seed)
    x = rnd.normal(size=(n, 6))
    x[:, 3] = x[:, 0] + x[:, 1] + 0.8 * rnd.normal(size=n)  # tempts the first forward step
    x[:, 4] = 7.0
    y = 3 * x[:, 0] + 3 * x[:, 1] - 2 * x[:, 2] + rnd.normal(size=n)
    return np.column_stack((x, y))


def frame(spark, x):
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "k long, " + ", ".join(f"c{i} double" for i in range(x.shape[1]))).repartition(5)


def held_out(x, fold, chosen, target):
    out = []
    for f in np.unique(fold):
        a, b = x[fold != f], x[fold == f]
        design = lambda r: np.column_stack((r[:, chosen], np.ones(len(r))))
        w = np.linalg.lstsq(design(a), a[:, target], rcond=None)[0]
        around = ((b[:, target] - b[:, target].mean()) ** 2).sum()
        out.append(1 - ((b[:, target] - design(b) @ w) ** 2).sum() / around if around > 1e-10 else 0.0)
    return float(np.mean(out))


def test_floating_selection_against_all_subsets(spark):
    x = data()
    fold = np.arange(len(x)) % 4
    names = [f"c{i}" for i in range(7)]
    folds = selection.Folds(factors.moments(frame(spark, x), names[:-1], names[-1], F.col("k") % 4))
    for target in (6, 3, 0):
        others = [i for i in range(7) if i != target]
        for size in range(4):
            for s in combinations(others, size):
                s = list(s)
                assert folds.score(s, target) == pytest.approx(held_out(x, fold, s, target), abs=1e-8)
                each = folds.with_each(s, target)
                for j in set(others) - set(s):
                    assert each[j] == pytest.approx(held_out(x, fold, [*s, j], target), abs=1e-8)
        best = max((held_out(x, fold, list(s), target), -len(s), s) for r in range(4) for s in combinations(others, r))
        chosen, score = selection.floating_selection(folds, target, 3)
        assert score >= best[0] - 0.03, (target, chosen, best)
    chosen, _ = selection.floating_selection(folds, 6, 3)
    assert set(chosen) == {0, 1, 2}  # column 3 came first and went again
    assert selection.floating_selection(folds, 4, 3) == ([], 0.0)


def test_feature_influence(spark):
    df = frame(spark, data())
    out = {r.activity: r.selected for r in selection.feature_influence(df, "k").collect()}
    assert out["c4"] == 0 and out["c0"] >= 2 and out["c5"] == 0
    assert selection.feature_influence(df.limit(0), "k").agg(F.sum("selected")).first()[0] == 0
    assert selection.feature_influence(df.select("k", "c0"), "k").collect()[0].selected == 0


def test_one_inverse_gives_all_regressions(spark):
    x = data()
    m = factors.moments(frame(spark, x), [f"c{i}" for i in range(6)], "c6")[0]
    for alpha in (0.0, 2.0):
        w, fit = selection.all_regressions(m, alpha)
        for t in (0, 1, 2, 3, 5, 6):
            own = [i for i in range(7) if i not in (t, 4)]
            a = x[:, own] - x[:, own].mean(axis=0)
            y = x[:, t] - x[:, t].mean()
            want = np.linalg.solve(a.T @ a + alpha * np.eye(len(own)), a.T @ y)
            assert w[own, t] == pytest.approx(want, abs=1e-6) and w[4, t] == 0
            assert fit[t] == pytest.approx(1 - ((y - a @ want) ** 2).sum() / (y**2).sum(), abs=1e-8)
    twice = np.column_stack((x[:, :3], x[:, 0] * 2))
    n, s, p = len(twice), twice.sum(axis=0), twice.T @ twice
    w, fit = selection.all_regressions((n, s, p))
    assert fit[0] == pytest.approx(1) and fit[3] == pytest.approx(1)


def test_thousand_columns_take_seconds():
    import time

    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(3000, 1000))
    x[:, 1] += x[:, 0]
    parts = {f: (len(b), b.sum(axis=0), b.T @ b) for f, b in enumerate(np.split(x, 3))}
    began = time.perf_counter()
    _, fit = selection.all_regressions(factors._add(parts.values()))
    folds = selection.Folds(parts)
    picks = [selection.floating_selection(folds, t, 2)[0] for t in range(20)]
    assert time.perf_counter() - began < 60
    assert picks[0] == [1] and picks[1] == [0] and fit[1] > 0.5


def test_three_selectors(spark):
    x = data()
    df = frame(spark, x)
    names = [f"c{i}" for i in range(6)]
    out = selection.select_features(df, "c6", names, F.col("k") % 5 == 0, 0.5).collect()
    own, test = x[np.arange(len(x)) % 5 != 0], x[np.arange(len(x)) % 5 == 0]
    centred = own - own.mean(axis=0)
    sse = lambda s: ((centred[:, 6] - centred[:, s] @ np.linalg.lstsq(centred[:, s], centred[:, 6], rcond=None)[0]) ** 2).sum()
    pursuit: list[int] = []
    for _ in range(3):
        left = centred[:, 6] - (centred[:, pursuit] @ np.linalg.lstsq(centred[:, pursuit], centred[:, 6], rcond=None)[0] if pursuit else 0)
        pursuit.append(max((i for i in range(6) if i != 4 and i not in pursuit), key=lambda i: abs(left @ centred[:, i]) / np.linalg.norm(centred[:, i])))
    backward = [0, 1, 2, 3, 5]
    while len(backward) > 3:
        backward.remove(min(backward, key=lambda i: sse([j for j in backward if j != i])))
    alone = sorted((i for i in range(6) if i != 4), key=sse_of(centred))[:3]
    for name, want in (("matching_pursuit", pursuit), ("backward", backward), ("k_best", alone)):
        rows = [r for r in out if r.selector == name]
        assert sorted(r.feature for r in rows) == sorted(f"c{i}" for i in want), name
        a = np.column_stack((own[:, want], np.ones(len(own))))
        w = np.linalg.lstsq(a, own[:, 6], rcond=None)[0]
        guess = np.column_stack((test[:, want], np.ones(len(test)))) @ w
        assert rows[0].mape == pytest.approx(np.abs((test[:, 6] - guess) / test[:, 6]).mean(), rel=1e-6)
    assert {r.selector for r in out if r.chosen} == {min(out, key=lambda r: (r.mape, r.selector)).selector}
    assert selection.select_features(df.limit(0), "c6", names, F.col("k") % 5 == 0).count() == 0


def sse_of(centred):
    return lambda i: -((centred[:, i] @ centred[:, 6]) ** 2) / (centred[:, i] @ centred[:, i])


def test_problem_scores_on_dependent_columns(spark):
    x = np.abs(data(60)[:, :3])
    df = frame(spark, np.column_stack((x, x[:, 0])))
    out = {r.activity: r for r in insights.problem_scores(df, "k").collect()}
    assert out["c0"].r2 == pytest.approx(1) and out["c3"].r2 == pytest.approx(1) and 0 <= out["c1"].r2 < 0.5
