"""Trees against a plain one, and shuffles against the closed form of a linear model."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomline.operators import ranking, trees


def data(n=600):
    rnd = np.random.default_rng(7)
    x = rnd.integers(0, 12, size=(n, 3)).astype(float)
    y = np.where(x[:, 0] > 5, 10.0, 0.0) + np.where(x[:, 1] > 3, 4.0, -4.0) * (x[:, 0] > 5) + rnd.normal(size=n)
    return np.column_stack((x, y))


def frame(spark, x):
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "k long, a double, b double, c double, y double").repartition(5)


def plain_tree(x, g, depth, rate, least):
    """Residuals' fit by a greedy tree over all cuts between values."""
    if depth == 0 or len(x) == 0:
        return None
    best = (1e-12, None)
    for i in range(x.shape[1]):
        for cut in np.unique(x[:, i])[:-1]:
            left = x[:, i] <= cut
            if min(left.sum(), (~left).sum()) < least:
                continue
            gain = g[left].sum() ** 2 / left.sum() + g[~left].sum() ** 2 / (~left).sum() - g.sum() ** 2 / len(g)
            if gain > best[0] * (1 + 1e-9):
                best = (gain, (i, cut))
    if best[1] is None:
        return None
    i, cut = best[1]
    left = x[:, i] <= cut
    return i, cut, rate * g[left].mean(), rate * g[~left].mean(), plain_tree(x[left], g[left], depth - 1, rate, least), plain_tree(x[~left], g[~left], depth - 1, rate, least)


def plain_predict(tree, x):
    out = np.zeros(len(x))
    for n, row in enumerate(x):
        at = tree
        while at:
            i, cut, lv, rv, lt, rt = at
            out[n], at = (lv, lt) if row[i] <= cut else (rv, rt)
    return out


def plain_forest(x, y, new, count, depth, rate, least):
    pred, out = np.full(len(x), y.mean()), np.full(len(new), y.mean())
    for _ in range(count):
        tree = plain_tree(x, y - pred, depth, rate, least)
        pred = pred + plain_predict(tree, x)
        out = out + plain_predict(tree, new)
    return out


@pytest.mark.parametrize("least", [1, 40])
def test_trees_agree_with_a_plain_one(spark, least):
    x = data()
    df = frame(spark, x)
    forest = trees.fit(df.drop("k"), ["a", "b", "c", "y"], ["y"], trees=3, depth=3, rate=0.5, least=least)["y", -1]
    assert forest.predict(x) == pytest.approx(plain_forest(x[:, :3], x[:, 3], x[:, :3], 3, 3, 0.5, least), abs=1e-9)


def test_held_out_errors(spark):
    x = data()
    df = frame(spark, x)
    fold = np.arange(len(x)) % 3
    out = {r.activity: r for r in trees.held_out_errors(df, "k", ["y"], 3, F.col("k") % 3, trees=3, depth=2).collect()}
    guess = np.zeros(len(x))
    for f in range(3):
        own = fold != f
        guess[~own] = plain_forest(x[own, :3], x[own, 3], x[~own, :3], 3, 2, 0.3, 1)
    e = x[:, 3] - guess
    assert out["y"].n == len(x) and out["y"].mae == pytest.approx(np.abs(e).mean(), abs=1e-8)
    assert out["y"].r2 == pytest.approx(1 - (e @ e) / ((x[:, 3] - x[:, 3].mean()) ** 2).sum(), abs=1e-8)
    assert {r.activity: (r.n, r.r2) for r in trees.held_out_errors(df.limit(0), "k", trees=1).collect()} in ({}, dict.fromkeys("abcy", (0, 0.0)))
    assert trees.held_out_errors(df.select("k", "a"), "k", trees=1).first().r2 < 0.05
    with pytest.raises(ValueError, match="too many"):
        trees.fit(df, ["a", "b"] * 4000, ["a"], depth=9)


def test_places_and_permutations(spark):
    rows = [(i * 7 % 500, i % 9) for i in range(500)] + [(3, 1), (3, 1)]
    df = spark.createDataFrame(rows, "k long, v long").repartition(6)
    out = ranking.placed(df, "k", "v").collect()
    assert sorted(r.place for r in out) == list(range(502))
    assert [(r.k, r.v) for r in sorted(out, key=lambda r: r.place)] == sorted(rows)
    mixed = ranking.permuted(df, "k", ["v"], [1, 2, 3])
    for seed in (1, 2, 3):
        own = mixed.filter(F.col("seed") == seed).collect()
        assert sorted((r.k, r.v) for r in own) == sorted(rows) and sorted(r.p_v for r in own) == sorted(v for _, v in rows)
        assert sum(r.v == r.p_v for r in own) < 200
    again = {(r.k, r.seed): r.p_v for r in ranking.permuted(df.filter("k <> 3"), "k", ["v"], [1, 2, 3]).collect()}
    assert again == {(r.k, r.seed): r.p_v for r in ranking.permuted(df.filter("k <> 3").repartition(2), "k", ["v"], [1, 2, 3]).collect()}
    assert ranking.permuted(df.limit(0), "k", ["v"], [1]).count() == 0


def test_shuffles_meet_the_closed_form(spark):
    """Shuffling a column of a linear model raises the squared error by twice the variance of its part."""
    x = data(2000)
    df = frame(spark, x)
    w = np.array([2.0, -1.0, 0.0])
    out = {r.feature: r for r in trees.permutation_importance(df, "k", ["a", "b", "c"], "y", lambda m: m @ w).collect()}
    # The model is not fitted, so the error of what is left out takes part: the cross term has its mean in the covariance.
    left = x[:, 3] - x[:, :3] @ w
    for i, f in enumerate("abc"):
        want = 2 * w[i] ** 2 * x[:, i].var() + 2 * w[i] * np.cov(left, x[:, i], bias=True)[0, 1]
        assert abs(out[f].importance - want) <= 4 * out[f].spread / np.sqrt(10) + 1e-9, (f, out[f], want)


def test_permuted_in_many_buckets(spark, monkeypatch):
    """The order of whole hashes, cut into buckets; rows times seeds are written nowhere."""
    import hashlib

    sizes = []
    real = ranking.written
    monkeypatch.setattr(ranking, "written", lambda df, name: (lambda out: sizes.append((name, out.count())) or out)(real(df, name)))
    monkeypatch.setattr(ranking, "BUCKET_ROWS", 7, raising=False)
    keys, seeds = [i * 3 for i in range(60)], [1, 2]
    df = spark.createDataFrame([(k, float(k)) for k in keys], "k long, v double")
    got = {(r.k, r.seed): r.p_v for r in ranking.permuted(df, "k", ["v"], seeds).collect()}
    want = {(k, s): float(o) for s in seeds for k, o in zip(keys, sorted(keys, key=lambda k, s=s: hashlib.md5(f"{k}:{s}".encode()).hexdigest()), strict=True)}
    assert got == want
    assert sum(n for name, n in sizes if name == "ranked") == 60
