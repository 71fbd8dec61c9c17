"""Search among forecast models as a table of tasks: one row for each series, model and fold."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomline.operators.series import LAGS, blended, holt, recursive_ridge
from loomline.sources.scratch import written

SEASON = {"D": 7, "M": 12, "Y": 1}
TRENDS = ("n", "c", "t", "ct")
#: A model name stands for a pair when it holds two names with this between them.
AND = " & "
#: Below this least value a series is scored by squared errors, else by relative ones.
SMALL = 1e-9


def _design(trend: str, first: int, n: int) -> np.ndarray:
    """Columns of a trend at the times first, first + 1, ...: none, a level, a slope, or both."""
    t = np.arange(first, first + n, dtype=float)
    return np.stack([v for on, v in (("c" in trend, np.ones(n)), ("t" in trend, t)) if on] or [np.zeros(n)], axis=1)


def _companions(phi: np.ndarray, seasonal: np.ndarray, s: int) -> np.ndarray:
    """Transition matrices, one a model, of u_t = phi u_{t-1} + S u_{t-s} - phi S u_{t-s-1} + e_t."""
    m = s + 1 if s > 1 else 1
    t = np.zeros((len(phi), m, m))
    t[:, 0, 0] = phi
    if s > 1:
        t[:, 0, s - 1] += seasonal
        t[:, 0, s] -= phi * seasonal
    for i in range(1, m):
        t[:, i, i - 1] = 1.0
    return t


def _filtered(y: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kalman filter of the columns of y under all transition matrices at once.

    Returns the prediction errors over their spread (model, time, column), the logarithms of
    the errors' variances (model, time), and the last predicted states. Missing values of the first
    column, NaN, are stepped over: their errors are 0.
    """
    g, m, _ = t.shape
    q = np.zeros((g, m, m))
    q[:, 0, 0] = 1.0
    p, a = q.copy(), t.copy()
    for _ in range(14):  # the stationary spread, by doubling
        p = p + a @ p @ a.transpose(0, 2, 1)
        a = a @ a
    x = np.zeros((g, m, y.shape[1]))
    errors, spreads = np.zeros((g, len(y), y.shape[1])), np.zeros((g, len(y)))
    for i, row in enumerate(y):
        if not np.isnan(row[0]):
            f = np.maximum(p[:, 0, 0], 1e-12)
            v = row[None, :] - x[:, 0, :]
            gain = p[:, :, 0] / f[:, None]
            errors[:, i] = v / np.sqrt(f)[:, None]
            spreads[:, i] = np.log(f)
            x = x + gain[:, :, None] * v[:, None, :]
            p = p - gain[:, :, None] * p[:, None, 0, :]
        x = t @ x
        p = t @ p @ t.transpose(0, 2, 1) + q
    return errors, spreads, x


@dataclass(frozen=True)
class SeasonalAR:
    """A fitted seasonal autoregression around a trend."""

    phi: float
    seasonal: float
    weights: np.ndarray
    variance: float
    log_likelihood: float
    trend: str
    season: int
    state: np.ndarray
    length: int

    def ahead(self, steps: int) -> np.ndarray:
        t, x, out = _companions(np.array([self.phi]), np.array([self.seasonal]), self.season)[0], self.state, []
        for _ in range(steps):
            out.append(x[0])
            x = t @ x
        return np.array(out) + _design(self.trend, self.length, steps) @ self.weights


def fit_seasonal_ar(y: np.ndarray, season: int, trend: str = "c") -> SeasonalAR:
    """The likeliest seasonal autoregression of y, which may hold NaN, with trend n, c, t or ct.

    The trend's weights and the variance follow from the two coefficients by least squares
    on the filter's errors; the coefficients are found on a grid that is narrowed four times.
    """
    x = _design(trend, 0, len(y))
    seen = max(int((~np.isnan(y)).sum()), 1)
    table = np.column_stack((y, x))
    centre, reach, best = np.zeros(2), 0.96, None
    for _ in range(5):
        line = np.linspace(-reach, reach, 9)
        pairs = np.array([(a, b) for a in centre[0] + line for b in (centre[1] + line if season > 1 else [0.0])])
        pairs = np.unique(np.clip(pairs, -0.98, 0.98), axis=0)
        errors, spreads, states = _filtered(table, _companions(pairs[:, 0], pairs[:, 1], season))
        for i, (a, b) in enumerate(pairs):
            w = np.linalg.lstsq(errors[i][:, 1:], errors[i][:, 0], rcond=None)[0]
            variance = max(float(((errors[i][:, 0] - errors[i][:, 1:] @ w) ** 2).sum() / seen), 1e-18)
            fit = -0.5 * (seen * (np.log(2 * np.pi * variance) + 1) + spreads[i].sum())
            if best is None or fit > best.log_likelihood:
                best = SeasonalAR(float(a), float(b), w, variance, float(fit), trend, season, states[i][:, 0] - states[i][:, 1:] @ w, len(y))
        centre, reach = np.array([best.phi, best.seasonal]), reach / 4
    return best


def _drift(y: np.ndarray, steps: int) -> np.ndarray:
    slope = (y[-1] - y[0]) / (len(y) - 1) if len(y) > 1 else 0.0
    return y[-1] + slope * np.arange(1, steps + 1)


def models(period: str = "D", quick: bool = False) -> dict[str, Callable[[np.ndarray, int], np.ndarray]]:
    """Forecasts by name; with quick, the closed forms alone."""
    out = {"last": lambda y, n: np.repeat(y[-1], n), "mean": lambda y, n: np.repeat(y.mean(), n), "drift": _drift}
    if quick:
        return out
    for a in (0.2, 0.5, 0.8):
        for b in (0.1, 0.3):
            out[f"holt {a} {b}"] = lambda y, n, a=a, b=b: holt(y, a, b, n)[0]
    for alpha in (0.01, 1.0, 10.0):
        out[f"ridge {alpha}"] = lambda y, n, alpha=alpha: recursive_ridge(y, LAGS[period], n, alpha)
    for trend in TRENDS:
        out[f"seasonal {trend}"] = lambda y, n, trend=trend: fit_seasonal_ar(y, SEASON[period], trend).ahead(n)
    return out


@dataclass(frozen=True)
class Search:
    """What is tried: a share of each series is held out at a time, in so many folds from its end.

    names chooses models, null all of the period; pairs adds geometric means of two models;
    without refit the chosen model learns from what precedes the last fold alone.
    """

    period: str = "D"
    steps: int = 5
    test: float = 0.1
    folds: int = 3
    names: tuple[str, ...] | None = None
    pairs: bool = False
    refit: bool = True
    quick: bool = False
    least: int = 6

    def __post_init__(self):
        if not 0 < self.test < 1 or self.folds < 1 or self.steps < 1:
            raise ValueError("test must lie between 0 and 1; folds and steps are at least 1")
        unknown = set(self.names or ()) - set(models(self.period))
        if unknown:
            raise ValueError(f"unknown models: {', '.join(sorted(unknown))}")

    @property
    def tried(self) -> list[str]:
        return list(self.names or models(self.period, self.quick))


def _arrays(series: DataFrame, keys: list[str], value: str) -> DataFrame:
    """A row a series, as long as it has periods, with null values as 0."""
    pairs = F.array_sort(F.collect_list(F.struct("period", F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("y"))))
    return series.groupBy(*keys).agg(pairs.alias("_s")).select(*keys, F.transform("_s", lambda v: v["y"]).alias("_y"), F.element_at("_s", -1)["period"].alias("_end"))


def _run(tasks: DataFrame, keys: list[str], period: str) -> DataFrame:
    """(keys, model, fold, step, forecast) of tasks (keys, model, fold, _y, _steps); forecasts are never below 0."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = models(period)
        for pdf in batches:
            parts = []
            for i, (name, y, steps) in enumerate(zip(pdf["model"], pdf["_y"], pdf["_steps"], strict=True)):
                got = np.maximum(np.nan_to_num(known[name](np.asarray(y, dtype=float), int(steps))), 0.0)
                parts.append(pd.DataFrame({"_at": i, "step": np.arange(1, len(got) + 1), "forecast": got}))
            if parts:
                out = pd.concat(parts)
                yield pd.concat((pdf[[*keys, "model", "fold"]].iloc[out["_at"]].reset_index(drop=True), out[["step", "forecast"]].reset_index(drop=True)), axis=1)

    kinds = ", ".join(f"`{k}` {tasks.schema[k].dataType.simpleString()}" for k in keys)
    # Each task's hash places it, so that a series' models are spread.
    spread = tasks.repartition(*keys, "model", "fold")
    return spread.mapInPandas(run, f"{kinds}, model string, fold int, step int, forecast double")


def held_out_forecasts(series: DataFrame, keys: list[str], value: str = "probability", search: Search | None = None) -> DataFrame:
    """(keys, model, fold, step, forecast, actual, least) of every model on every held-out part.

    Fold 1 is a series' end, fold 2 the part before it. A fold that leaves fewer than
    `least` periods to learn from is not run, so short series have no rows.
    """
    search = search or Search()
    return _held_out(written(_arrays(series, keys, value), "series-arrays"), keys, search)


def _held_out(rows: DataFrame, keys: list[str], search: Search) -> DataFrame:
    n, keep = F.size("_y"), F.greatest(F.lit(1), F.floor(F.size("_y") * F.lit(search.test) + 1e-9)).cast("int")
    folds = rows.withColumn("_keep", keep).withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(search.folds)))).withColumn("_cut", n - F.col("_keep") * F.col("fold")).filter(F.col("_cut") >= search.least)
    tasks = folds.select(*keys, F.explode(F.array(*map(F.lit, search.tried))).alias("model"), "fold", F.slice("_y", F.lit(1), F.col("_cut")).alias("_y"), F.col("_keep").alias("_steps"))
    truth = folds.select(*keys, "fold", F.array_min("_y").alias("least"), F.posexplode(F.slice("_y", F.col("_cut") + 1, F.col("_keep"))).alias("_p", "actual")).withColumn("step", F.col("_p") + 1).drop("_p")
    said = _run(tasks, keys, search.period)
    if search.pairs:
        said = written(said, "series-forecasts")
        other = said.select(*keys, F.col("model").alias("_m"), "fold", "step", F.col("forecast").alias("_f"))
        both = said.join(other, [*keys, "fold", "step"]).filter(F.col("model") < F.col("_m"))
        said = said.unionByName(both.select(*keys, F.concat("model", F.lit(AND), "_m").alias("model"), "fold", "step", blended(F.col("forecast"), F.col("_f")).alias("forecast")))
    return said.join(truth, [*keys, "fold", "step"])


def forecast_scores(series: DataFrame, keys: list[str], value: str = "probability", search: Search | None = None) -> DataFrame:
    """(keys, model, fold, metric, score): mse for series that reach 0, else mape, over the fold's periods."""
    return _scored(held_out_forecasts(series, keys, value, search), keys)


def _scored(out: DataFrame, keys: list[str]) -> DataFrame:
    miss = F.col("actual") - F.col("forecast")
    relative = F.col("least") > SMALL
    score = F.when(relative, F.abs(miss / F.nullif(F.col("actual"), F.lit(0.0)))).otherwise(miss * miss)
    return out.withColumn("metric", F.when(relative, "mape").otherwise("mse")).groupBy(*keys, "model", "fold", "metric").agg(F.avg(score).alias("score"))


def best_models(scores: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, model, score): the smallest mean score over the folds; ties go to the first name."""
    mean = scores.groupBy(*keys, "model").agg(F.avg("score").alias("score"))
    return mean.groupBy(*keys).agg(F.min(F.struct("score", "model")).alias("_b")).select(*keys, F.col("_b.model").alias("model"), F.col("_b.score").alias("score"))


def searched_forecast(series: DataFrame, keys: list[str], value: str = "probability", search: Search | None = None, normalise: bool = True) -> DataFrame:
    """(keys, period, forecast, model) of the coming periods by each series' best model.

    Series too short for a fold use "last". With normalise, a period's shares add up to 1.
    """
    search = search or Search()
    rows = written(_arrays(series, keys, value), "series-arrays")
    best = best_models(_scored(_held_out(rows, keys, search), keys), keys)
    keep = F.greatest(F.lit(1), F.floor(F.size("_y") * F.lit(search.test) + 1e-9)).cast("int")
    known = rows.join(best.select(*keys, F.col("model").alias("_best")), keys, "left").withColumn("_best", F.coalesce("_best", F.lit("last")))
    behind = F.lit(0) if search.refit else F.when(F.size("_y") - keep >= search.least, keep).otherwise(0)
    known = known.withColumn("_behind", behind)
    task = known.select(*keys, F.explode(F.split("_best", AND)).alias("model"), F.lit(0).alias("fold"), F.slice("_y", F.lit(1), F.size("_y") - F.col("_behind")).alias("_y"), (F.col("_behind") + search.steps).alias("_steps"))
    said = _run(task, keys, search.period)
    # A pair's two forecasts become their geometric mean, a lone one stays as it is.
    joined = said.groupBy(*keys, "step").agg(F.when(F.count("*") > 1, F.sqrt(F.min("forecast") * F.max("forecast"))).otherwise(F.min("forecast")).alias("forecast"))
    unit = {"D": "day", "M": "month", "Y": "year"}[search.period]
    ahead = joined.join(known.select(*keys, "_end", "_best", "_behind"), keys).withColumn("_k", F.col("step") - F.col("_behind")).filter("_k > 0")
    when = F.expr(f"cast(timestampadd({unit}, _k, _end) as date)")
    out = ahead.select(*keys, when.alias("period"), "forecast", F.col("_best").alias("model"))
    if normalise:
        total = F.sum("forecast").over(Window.partitionBy("period"))
        out = out.withColumn("forecast", F.coalesce(F.col("forecast") / F.nullif(total, F.lit(0.0)), F.lit(0.0)))
    return out
