"""Density clusters against all pairs."""

import numpy as np
import pytest

from loomline.operators import density


def all_pairs(keys, x, eps, least):
    """{key: (cluster, core)} by the plain rule."""
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    near = d <= eps * eps
    core = near.sum(axis=1) >= least
    label = {}
    for i in np.argsort(keys):
        if core[i] and i not in label:
            todo = [i]
            label[i] = keys[i]
            while todo:
                j = todo.pop()
                for k in np.flatnonzero(near[j] & core):
                    if k not in label:
                        label[k] = keys[i]
                        todo.append(k)
    out = {}
    for i in range(len(keys)):
        if core[i]:
            out[int(keys[i])] = (int(label[i]), True)
        else:
            best = min(((d[i, j], keys[j], label[j]) for j in np.flatnonzero(near[i] & core)), default=None)
            out[int(keys[i])] = (int(best[2]) if best else None, False)
    return out


def found(spark, keys, x, eps, least):
    names = [f"c{i}" for i in range(x.shape[1])]
    df = spark.createDataFrame([(int(k), *map(int, r)) for k, r in zip(keys, x, strict=True)], "id long, " + ", ".join(f"{n} long" for n in names))
    return {r.id: (r.cluster, r.core) for r in density.density_clusters(df, "id", names, eps, least).collect()}


@pytest.mark.parametrize(("d", "eps", "least", "spread"), [(1, 4, 3, 300), (2, 9, 4, 120), (2, 1, 2, 12), (3, 14, 5, 60)])
def test_equal_to_all_pairs(spark, monkeypatch, d, eps, least, spread):
    monkeypatch.setattr(density, "BLOCK", 3)
    rnd = np.random.default_rng(d * 10 + eps)
    x = np.concatenate((rnd.integers(-spread, spread, (150, d)), np.round(rnd.normal(0, eps, (60, d))).astype(int), np.full((7, d), spread * 2)))
    keys = rnd.permutation(len(x)) + 5
    assert found(spark, keys, x, eps, least) == all_pairs(keys, x, eps, least)


def test_full_cells_meet_by_boxes(spark):
    """Two full cells whose nearest points are just within, or just beyond, the distance."""
    rnd = np.random.default_rng(4)
    for gap in (100, 101):
        a = np.column_stack((-rnd.integers(0, 60, 200), rnd.integers(0, 60, 200)))
        b = np.column_stack((gap + rnd.integers(0, 60, 200), rnd.integers(0, 60, 200)))
        x = np.concatenate((a, b, [[0, 30], [gap, 30]]))
        keys = np.arange(len(x))
        got = found(spark, keys, x, 100, 5)
        assert got == all_pairs(keys, x, 100, 5)
        assert len({c for c, _ in got.values()}) == (1 if gap == 100 else 2)


def test_nulls_repeats_and_nothing(spark):
    df = spark.createDataFrame([(1, 0, 0), (2, 0, 0), (3, None, 0), (4, 50, 50)], "id long, a int, b int")
    got = {r.id: (r.cluster, r.core) for r in density.density_clusters(df, "id", ["a", "b"], 2, 2).collect()}
    assert got == {1: (1, True), 2: (1, True), 3: (None, False), 4: (None, False)}
    assert density.density_clusters(df.limit(0), "id", ["a", "b"], 2).isEmpty()
    for columns, eps, least in (([], 1, 1), (["a"] * 5, 1, 1), (["a"], 0, 1), (["a"], 1, 0)):
        with pytest.raises(ValueError):
            density.density_clusters(df, "id", columns, eps, least)


def test_texts(spark):
    rnd = np.random.default_rng(2)
    words = [[f"{t}{i}" for i in range(12)] for t in ("ship", "bank", "tree")]
    rows = [(i, " ".join(rnd.choice(words[i % 3], 6))) for i in range(2000)] + [(2000, None), (2001, "")]
    df = spark.createDataFrame(rows, "id long, t string")
    placed = sorted(density.projected_texts(df, "t").collect())
    keys, x = np.array([r.id for r in placed]), np.array([(r.x0, r.x1) for r in placed])
    got = {r.id: (r.cluster, r.core) for r in density.text_density_clusters(df, "id", "t", 0.03, 8).collect()}
    assert got == all_pairs(keys, x, round(0.03 * density.SCALE), 8)
