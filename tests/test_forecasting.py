"""State-space models against dense Gaussian likelihoods, and the search among models."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomline.operators import forecasting as fc


def simulated(n, phi, seasonal, s, seed=3):
    rnd = np.random.default_rng(seed)
    u = np.zeros(n + 200)
    for t in range(s + 1, len(u)):
        u[t] = phi * u[t - 1] + seasonal * u[t - s] - phi * seasonal * u[t - s - 1] + rnd.normal()
    return u[200:]


def dense_log_likelihood(u, phi, seasonal, s, variance):
    """That of the seen values, from the covariances of the moving average form."""
    n, long = len(u), 3000
    psi = np.zeros(long)
    psi[0] = 1.0
    for k in range(1, long):
        psi[k] = phi * psi[k - 1] + (seasonal * psi[k - s] if k >= s else 0) - (phi * seasonal * psi[k - s - 1] if k > s else 0)
    gamma = np.array([psi[: long - k] @ psi[k:] for k in range(n)]) * variance
    cov = gamma[np.abs(np.subtract.outer(np.arange(n), np.arange(n)))]
    seen = ~np.isnan(u)
    cov, v = cov[np.ix_(seen, seen)], u[seen]
    return -0.5 * (seen.sum() * np.log(2 * np.pi) + np.linalg.slogdet(cov)[1] + v @ np.linalg.solve(cov, v))


@pytest.mark.parametrize("gaps", [False, True])
def test_filter_gives_the_gaussian_likelihood(gaps):
    y = simulated(60, 0.5, 0.4, 7)
    if gaps:
        y[[3, 20, 21, 40]] = np.nan
    m = fc.fit_seasonal_ar(y, 7, "n")
    assert m.log_likelihood == pytest.approx(dense_log_likelihood(y, m.phi, m.seasonal, 7, m.variance), abs=1e-6)
    for a, b in ((0.05, 0), (-0.05, 0), (0, 0.05), (0, -0.05)):
        assert m.log_likelihood >= dense_log_likelihood(y, m.phi + a, m.seasonal + b, 7, m.variance) - 1e-6


@pytest.mark.parametrize(("trend", "add"), [("c", lambda t: 5 + 0 * t), ("ct", lambda t: 2 + 0.05 * t), ("t", lambda t: 0.1 * t)])
def test_parameters_are_recovered(trend, add):
    t = np.arange(1500.0)
    m = fc.fit_seasonal_ar(simulated(1500, 0.6, 0.3, 7) + add(t), 7, trend)
    assert m.phi == pytest.approx(0.6, abs=0.07) and m.seasonal == pytest.approx(0.3, abs=0.07) and m.variance == pytest.approx(1.0, abs=0.1)
    want = {"c": [5.0], "ct": [2.0, 0.05], "t": [0.1]}[trend]
    assert m.weights == pytest.approx(want, abs=0.9) and m.weights[-1] == pytest.approx(want[-1], abs=0.5 if trend == "c" else 0.01)


def test_forecast_follows_the_recursion():
    y = simulated(80, 0.5, 0.4, 7)
    m = fc.fit_seasonal_ar(y, 7, "n")
    past = list(y)
    for _ in range(9):
        past.append(m.phi * past[-1] + m.seasonal * past[-7] - m.phi * m.seasonal * past[-8])
    assert m.ahead(9) == pytest.approx(past[80:], abs=1e-8)


def frame(spark, series):
    day = dt.date(2024, 1, 1)
    return spark.createDataFrame([(k, day + dt.timedelta(i), float(v)) for k, y in series.items() for i, v in enumerate(y)], "k string, period date, v double").repartition(3)


def test_search_chooses_the_season_and_matches_plain_scores(spark):
    rnd = np.random.default_rng(1)
    t = np.arange(70)
    # The season's level is random by week day, so no straight line or average meets it.
    week = 20 + 8 * np.array([0, 1, -1, 0.5, -0.7, 1.5, -1.2])[t % 7] + 0.3 * rnd.normal(size=70)
    series = {"week": week, "line": 5 + 0.5 * t, "short": [1.0, 2.0, 3.0], "zero": np.zeros(40)}
    df = frame(spark, series)
    search = fc.Search(names=("drift", "last", "mean", "seasonal c"))
    scores = {(r.k, r.model, r.fold): (r.metric, r.score) for r in fc.forecast_scores(df, ["k"], "v", search).collect()}
    assert {k for k, _, _ in scores} == {"week", "line", "zero"}
    known = fc.models()
    for (k, model, fold), (metric, score) in scores.items():
        y = np.array(series[k])
        keep = max(1, len(y) // 10)
        cut = len(y) - keep * fold
        miss = y[cut : cut + keep] - np.maximum(known[model](y[:cut], keep), 0)
        assert metric == ("mse" if y.min() <= 1e-9 else "mape")
        assert score == pytest.approx(float(np.mean(miss**2 if metric == "mse" else np.abs(miss / y[cut : cut + keep]))), abs=1e-9)
    out = fc.searched_forecast(df, ["k"], "v", search, normalise=False)
    chosen = {r.k: r.model for r in out.select("k", "model").distinct().collect()}
    assert chosen["week"] == "seasonal c" and chosen["line"] == "drift" and chosen["short"] == "last"
    line = [r.forecast for r in out.filter("k = 'line'").orderBy("period").collect()]
    assert line == pytest.approx([5 + 0.5 * (70 + i) for i in range(5)])
    assert out.filter("k = 'line'").agg(F.min("period")).first()[0] == dt.date(2024, 3, 11)


def test_pairs_are_geometric_means_and_refit_is_a_choice(spark):
    t = np.arange(40)
    df = frame(spark, {"a": 10 + 3 * (t % 2), "b": 4 + 0.2 * t})
    search = fc.Search(names=("last", "mean"), pairs=True, folds=1)
    rows = {(r.k, r.model, r.step): r.forecast for r in fc.held_out_forecasts(df, ["k"], "v", search).collect()}
    for (k, model, step), v in rows.items():
        if fc.AND in model:
            a, b = model.split(fc.AND)
            assert v == pytest.approx((rows[k, a, step] * rows[k, b, step]) ** 0.5)
    assert {m for _, m, _ in rows} == {"last", "mean", "last & mean"}
    late = fc.searched_forecast(df, ["k"], "v", fc.Search(names=("drift",), folds=1, refit=False, steps=2), normalise=False)
    got = {(r.k, r.period): r.forecast for r in late.collect()}
    assert got["b", dt.date(2024, 2, 10)] == pytest.approx(12.0) and len(got) == 4
    paired = fc.searched_forecast(df.filter("k = 'a'"), ["k"], "v", fc.Search(names=("last", "mean"), pairs=True), normalise=False)
    assert paired.count() == 5


def test_nothing_and_wrong_arguments(spark):
    empty = frame(spark, {"a": [1.0]}).limit(0)
    assert fc.searched_forecast(empty, ["k"], "v").isEmpty()
    for wrong in ({"test": 0}, {"folds": 0}, {"names": ("none",)}):
        with pytest.raises(ValueError):
            fc.Search(**wrong)
