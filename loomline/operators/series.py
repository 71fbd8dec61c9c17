"""Time series of a process graph's nodes and edges, lag features and forecasts."""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.eventlog import EventLog

_STEP = {"D": "interval 1 day", "M": "interval 1 month", "Y": "interval 1 year"}
_UNIT = {"D": "DAY", "M": "MONTH", "Y": "YEAR"}
LAGS = {"D": 7, "M": 12, "Y": 5}


def bucket(ts: Column, period: str = "D", floor: bool = False) -> Column:
    """The period of a time: days to the nearest one unless floor is set, months and years down."""
    if period == "D" and not floor:
        ts = ts + F.expr("interval 12 hours")
    return F.date_trunc(_UNIT[period], ts).cast("date")


def trim_months(rows: DataFrame, ts: str = "ts") -> DataFrame:
    """rows without a partial first or last month.

    The first month is partial if its first day is not the 1st; the last one if its last day
    is before the length of the *first* month, as the source of these rules has it.
    """
    first, last = rows.agg(F.min(ts)).scalar(), rows.agg(F.max(ts)).scalar()
    month = F.date_trunc("MONTH", F.col(ts))
    early = (F.dayofmonth(first) == 1) | (month > F.date_trunc("MONTH", first))
    late = (F.dayofmonth(last) >= F.dayofmonth(F.last_day(first))) | (month < F.date_trunc("MONTH", last))
    return rows.filter(early & late)


def _dense(rows: DataFrame, keys: list[str], period: str) -> DataFrame:
    """(period, keys, n, probability, mean_duration_s) with a row for every period of the span."""
    counted = rows.groupBy("period", *keys).agg(F.count("*").alias("n"), (F.avg("duration_us") / 1e6).alias("mean_duration_s"))
    # Every object carries the span and explodes it: objects x periods rows, the result's size.
    first, last = rows.agg(F.min("period")).scalar(), rows.agg(F.max("period")).scalar()
    days = F.explode(F.sequence(first, last, F.expr(_STEP[period]))).alias("period")
    spine = rows.select(*keys).distinct().select(*keys, days)
    full = spine.join(counted, ["period", *keys], "left")
    total = F.sum("n").over(Window.partitionBy("period"))
    share = F.coalesce(F.col("n") / F.nullif(total, F.lit(0)), F.lit(0.0))
    return full.select("period", *keys, F.coalesce("n", F.lit(0)).alias("n"), share.alias("probability"), F.coalesce("mean_duration_s", F.lit(0.0)).alias("mean_duration_s"))


def node_series(log: EventLog, period: str = "D", floor: bool = False) -> DataFrame:
    """By period and activity: count, share of the period's events, mean duration in seconds."""
    rows = log.base().filter(F.col("activity").isNotNull())
    rows = trim_months(rows) if period == "M" else rows
    return _dense(rows.withColumn("period", bucket(F.col("ts"), period, floor)), ["activity"], period)


def edge_series(log: EventLog, period: str = "D", floor: bool = False) -> DataFrame:
    """By period, activity and next activity; an event counts in its own period."""
    rows = log.base().dropna(subset=["activity", "next_activity"])
    rows = trim_months(rows) if period == "M" else rows
    return _dense(rows.withColumn("period", bucket(F.col("ts"), period, floor)), ["activity", "next_activity"], period)


def lag_features(series: DataFrame, keys: list[str], value: str = "probability", period: str = "D", calendar: DataFrame | None = None, one_hot: bool = False) -> DataFrame:
    """The series with lag_1..lag_k, diff_2..diff_k (lag_1 - lag_k), month and linear trend.

    k is 7 for days, 12 for months and 5 for years; the first k periods of each object have
    no full history and are left out. A calendar (period, ...) is joined from the left. With
    one_hot, M1 to M12 say the month, but not for years.
    """
    k = LAGS[period]
    w = Window.partitionBy(*keys).orderBy("period")
    out = series.select(*keys, "period", F.col(value).alias("y"), F.row_number().over(w).alias("_nth"), *(F.lag(value, i).over(w).alias(f"lag_{i}") for i in range(1, k + 1)))
    out = out.filter(F.col("_nth") > k)
    diffs = [(F.col("lag_1") - F.col(f"lag_{i}")).alias(f"diff_{i}") for i in range(2, k + 1)]
    out = out.select("*", *diffs, F.month("period").alias("month"), (F.col("_nth") - k).alias("linear")).drop("_nth")
    if one_hot and period != "Y":
        out = out.select("*", *((F.col("month") == m).cast("int").alias(f"M{m}") for m in range(1, 13)))
    return out.join(F.broadcast(calendar), "period", "left") if calendar is not None else out


def working_days(spark, first: str, last: str) -> DataFrame:
    """(period, month_days, quarter_days, half_days): Mondays to Fridays, public holidays not known."""
    days = spark.sql(f"select explode(sequence(date'{first}', date'{last}', interval 1 day)) d").filter("dayofweek(d) between 2 and 6")
    month = days.groupBy(F.date_trunc("MONTH", "d").cast("date").alias("period")).agg(F.count("*").alias("month_days"))
    quarter = Window.partitionBy(F.year("period"), F.quarter("period"))
    half = Window.partitionBy(F.year("period"), F.quarter("period") > 2)
    return month.select("period", "month_days", F.sum("month_days").over(quarter).alias("quarter_days"), F.sum("month_days").over(half).alias("half_days"))


def chrono_split(rows: DataFrame, keys: list[str], test: float = 0.1, validation: float = 0.1) -> DataFrame:
    """rows with part: the last `test` of each object's periods, `validation` before them, else train.

    Each of the two latter parts has at least one row.
    """
    w = Window.partitionBy(*keys)
    n = F.count("*").over(w)
    nth = F.row_number().over(w.orderBy("period"))
    late = F.greatest(F.floor(n * test), F.lit(1))
    middle = F.greatest(F.floor(n * validation), F.lit(1))
    return rows.withColumn("part", F.when(nth > n - late, "test").when(nth > n - late - middle, "validation").otherwise("train"))


def _ridge(x: np.ndarray, y: np.ndarray, alpha: float) -> tuple[np.ndarray, float]:
    mean, level = x.mean(axis=0), y.mean()
    c = x - mean
    w = np.linalg.solve(c.T @ c + alpha * np.eye(x.shape[1]), c.T @ (y - level))
    return w, float(level - mean @ w)


def holt(y: np.ndarray, a: float, b: float, steps: int) -> tuple[np.ndarray, float]:
    """(forecast, mean squared one-step error) of Holt's linear trend."""
    level, trend, error = y[0], y[1] - y[0] if len(y) > 1 else 0.0, 0.0
    for v in y[1:]:
        error += (v - level - trend) ** 2
        new = a * v + (1 - a) * (level + trend)
        trend = b * (new - level) + (1 - b) * trend
        level = new
    return level + trend * np.arange(1, steps + 1), error / max(len(y) - 1, 1)


def recursive_ridge(series: np.ndarray, lags: int, n: int, alpha: float) -> np.ndarray:
    """n values ahead by ridge on the last values, each forecast being the next one's past; never below 0."""
    k = min(lags, len(series) // 2)
    x = np.stack([series[k - i - 1 : len(series) - i - 1] for i in range(k)], axis=1)
    w, b = _ridge(x, series[k:], alpha)
    past = list(series)
    for _ in range(n):
        past.append(max(0.0, float(np.array(past[: -k - 1 : -1]) @ w + b)))
    return np.array(past[-n:])


def _forecast_one(y: np.ndarray, lags: int, steps: int, kinds: tuple[str, ...], folds: int) -> tuple[np.ndarray, str]:
    """The best of ridge on lags, Holt's trend and the last value, by mean error over chronological folds.

    Each fold holds out a tenth of the series, the last one its end.
    """
    keep = max(1, len(y) // 10)
    models = {"last": lambda s, n: np.repeat(s[-1], n)}
    for a in (0.2, 0.5, 0.8):
        for b in (0.1, 0.3):
            models[f"holt {a} {b}"] = lambda s, n, a=a, b=b: np.maximum(holt(s, a, b, n)[0], 0.0)
    for alpha in (0.01, 1.0, 10.0):
        models[f"ridge {alpha}"] = lambda s, n, alpha=alpha: recursive_ridge(s, lags, n, alpha)
    cuts = [len(y) - keep * f for f in range(1, folds + 1) if len(y) - keep * f >= 6]
    models = {m: f for m, f in models.items() if m.split()[0] in kinds and (cuts or m == "last")} or {"last": models["last"]}
    error = lambda m: float(np.mean([np.mean((models[m](y[:c], keep) - y[c : c + keep]) ** 2) for c in cuts])) if cuts else 0.0
    best = min(models, key=error)
    return models[best](y, steps), best


@dataclass(frozen=True)
class Plan:
    """How to forecast: the period and number of steps, the kinds of models tried, folds, and whether shares add up to 1."""

    period: str = "D"
    steps: int = 5
    kinds: tuple[str, ...] = ("last", "holt", "ridge")
    folds: int = 3
    normalise: bool = True


def forecast(series: DataFrame, keys: list[str], value: str = "probability", period: str = "D", steps: int = 5, normalise: bool = True, plan: Plan | None = None) -> DataFrame:
    """(keys, period, forecast, model) of the next periods, never below 0.

    Each object's series is one group, bounded by the number of periods. With normalise,
    the shares of a period are scaled to add up to 1.
    """
    plan = plan or Plan(period, steps, normalise=normalise)
    lags = LAGS[plan.period]
    rule = {"D": "D", "M": "MS", "Y": "YS"}[plan.period]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("period")
        y, model = _forecast_one(pdf[value].to_numpy(dtype=float), lags, plan.steps, plan.kinds, plan.folds)
        ahead = pd.date_range(pdf["period"].iloc[-1], periods=plan.steps + 1, freq=rule)[1:]
        return pd.DataFrame({**{k: pdf[k].iloc[0] for k in keys}, "period": ahead.date, "forecast": y, "model": model})

    kinds = ", ".join(f"{k} {series.schema[k].dataType.simpleString()}" for k in keys)
    out = series.select(*keys, "period", value).groupBy(*keys).applyInPandas(run, f"{kinds}, period date, forecast double, model string")
    if plan.normalise:
        total = F.sum("forecast").over(Window.partitionBy("period"))
        out = out.withColumn("forecast", F.coalesce(F.col("forecast") / F.nullif(total, F.lit(0.0)), F.lit(0.0)))
    return out


def blend_forecasts(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, period, forecast): two forecasts as one; where only b has a row, b's."""
    other = a.select(*keys, "period", F.col("forecast").alias("_a"))
    both = other.join(b.select(*keys, "period", F.col("forecast").alias("_b")), [*keys, "period"], "right")
    return both.select(*keys, "period", F.coalesce(blended(F.col("_a"), F.col("_b")), F.col("_b")).alias("forecast"))


def forecast_table(series: DataFrame, plan: Plan | None = None, comma: bool = False) -> DataFrame:
    """One row per coming period with <activity>_prob and <activity>_duration_s for each activity of a node series.

    With comma, numbers are texts of six digits with a decimal comma.
    """
    plan = plan or Plan()
    prob = forecast(series, ["activity"], "probability", plan=plan).select("period", F.concat("activity", F.lit("_prob")).alias("name"), "forecast")
    last = forecast(series, ["activity"], "mean_duration_s", plan=replace(plan, normalise=False)).select("period", F.concat("activity", F.lit("_duration_s")).alias("name"), "forecast")
    names = sorted(r.activity for r in series.select("activity").distinct().limit(1001).collect())
    if len(names) > 1000:
        raise ValueError("more than 1000 activities; choose some first")
    wanted = [f"{n}{end}" for n in names for end in ("_prob", "_duration_s")]
    wide = prob.union(last).groupBy("period").pivot("name", wanted).agg(F.round(F.first("forecast"), 6))
    return wide.select("period", *(F.replace(F.col(f"`{c}`").cast("string"), F.lit("."), F.lit(",")).alias(c) for c in wanted)) if comma else wide


def blended(a: Column, b: Column) -> Column:
    """Two models' forecasts as one: the geometric mean."""
    return F.sqrt(a * b)
