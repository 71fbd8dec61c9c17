import numpy as np
import pytest
from pyspark.sql import functions as F

from loomline.operators import leastangle


def table_of(x):
    both = np.column_stack((np.ones(len(x)), x))
    p = both.T @ both
    return len(x), p[0, 1:], p[1:, 1:]


def drawn(n=400, k=6, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, k)) * np.arange(1, k + 1) + 5
    x[:, 2] += x[:, 0]
    y = x @ np.array([2.0, 0, -1, 0.5, 0, 0.1][:k]) + rng.normal(size=n)
    return x, y


def test_whole_path_ends_at_least_squares():
    x, y = drawn()
    w, b, path = leastangle.least_angle(table_of(np.column_stack((x, y))))
    want = np.linalg.lstsq(np.column_stack((x, np.ones(len(x)))), y, rcond=None)[0]
    assert np.allclose([*w, b], want, atol=1e-6)
    assert sorted(j for j, _ in path) == list(range(6))
    assert all(a[1] >= b[1] for a, b in zip(path, path[1:], strict=False))


@pytest.mark.parametrize("most", [1, 2, 3, 5])
def test_short_path_keeps_correlations_equal(most):
    x, y = drawn()
    w, b, path = leastangle.least_angle(table_of(np.column_stack((x, y))), most)
    inside = [j for j, _ in path]
    left = y - x @ w - b
    r = np.abs([np.corrcoef(x[:, j], left)[0, 1] for j in range(6)]) * left.std()
    assert len(inside) == most and not w[[j for j in range(6) if j not in inside]].any()
    assert np.allclose(r[inside], r[inside[0]])
    # The end is where the next column is as near.
    others = [r[j] for j in range(6) if j not in inside]
    assert max(others) == pytest.approx(r[inside[0]])
    assert [j for j, _ in leastangle.least_angle(table_of(np.column_stack((x, y))))[2]][:most] == inside


def test_constant_equal_and_explained_columns():
    x, y = drawn(k=3)
    wide = np.column_stack((x, np.full(len(x), 7.0), x[:, 0], 2 * x[:, 1] - 3, y))
    w, b, path = leastangle.least_angle(table_of(wide))
    want = np.linalg.lstsq(np.column_stack((x, np.ones(len(x)))), y, rcond=None)[0]
    assert len(path) == 3 and w[3] == 0
    assert np.allclose(wide[:, :-1] @ w + b, np.column_stack((x, np.ones(len(x)))) @ want, atol=1e-6)
    assert leastangle.least_angle(table_of(np.column_stack((x, np.full(len(x), 2.0)))))[2] == []


def test_attributions_add_up_to_the_prediction(spark):
    x, y = drawn(n=60, k=3)
    rows = [(i, *map(float, r), float(t), i % 4 == 0 if i % 9 else None, "else") for i, (r, t) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(rows, "id int, a double, `b.c` double, d double, y double, test boolean, feature string")
    got = leastangle.attributions(df, ["id"], "y", ["a", "b.c", "d"], F.col("test")).groupBy("id").agg(F.sum("attribution")).collect()
    held = np.array([r[5] is True for r in rows])
    fit = np.linalg.lstsq(np.column_stack((x, np.ones(60)))[~held], y[~held], rcond=None)[0]
    assert {r[0] for r in got} == {i for i in range(60) if held[i]}
    assert all(r[1] == pytest.approx(x[r[0]] @ fit[:3] + fit[3] - y[~held].mean(), abs=1e-6) for r in got)
    shares = {r.feature: r.share for r in leastangle.first_row_shares(df, ["id"], "y", {"a": ["a"], "two": ["b.c", "d"]}, F.col("test")).collect()}
    own = fit[:3] * (x[4] - x[~held].mean(axis=0))
    size = {"a": abs(own[0]), "two": np.hypot(own[1], own[2]) / 2}
    assert all(shares[f] == pytest.approx(100 * v / sum(size.values()), abs=1e-6) for f, v in size.items())


def test_empty_null_and_repeated_rows(spark):
    schema = "id int, a double, y double"
    none = spark.createDataFrame([], schema)
    assert leastangle.least_angle_path(none, "y", ["a"]).count() == 0
    assert leastangle.attributions(none, ["id"], "y", ["a"], F.col("id") > 0).count() == 0
    assert leastangle.first_row_shares(none, ["id"], "y", {"a": ["a"]}, F.col("id") > 0).count() == 0
    df = spark.createDataFrame([(1, None, 1.0), (2, 2.0, 5.0), (2, 2.0, 5.0), (None, 1.0, 3.0), (9, 4.0, None)], schema)
    got = leastangle.attributions(df, ["id"], "y", ["a"], F.col("id") == 9).collect()
    assert [(r.id, r.feature) for r in got] == [(9, "a")] and got[0].attribution == pytest.approx(2 * 4 - 2 * 1.25)
    # All rows are held out: nothing to learn from.
    assert leastangle.attributions(df, ["id"], "y", ["a"], F.lit(True)).agg(F.sum(F.abs("attribution"))).first()[0] == 0
    with pytest.raises(ValueError):
        leastangle.least_angle_path(df, "y", ["y"])
