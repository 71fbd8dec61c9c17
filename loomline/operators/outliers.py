"""Outliers of a metric: exact quantile, interquartile, density and magnitude rules.

All detectors return distinct (case_id, activity_num). A null metric in a large enough
group counts as an outlier, and a null section leaves its rows out, by SQL's rules.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.operators.quantiles import exact_quantiles, fits_one_task
from loomline.sources.scratch import small, written


@dataclass(frozen=True)
class Detector:
    """Bounds as shares of the sorted values, and the rows a group needs to be judged."""

    lower: float = 0.05
    upper: float = 0.95
    min_rows: int = 30

    def __post_init__(self):
        if not (0 <= self.lower <= self.upper <= 1):
            raise ValueError("bounds must lie in [0, 1], the upper one not below the lower")
        if self.min_rows < 0:
            raise ValueError("min_rows must not be negative")


def element_at_share(df: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """By keys, for each name the element at index floor(share * n) of the sorted non-null values."""
    return exact_quantiles(df, keys, value, shares, interpolated=False)


def _measured(df: DataFrame, *columns: str) -> DataFrame:
    """These columns of df, which is read four times; a large one, that may be costly to make, is written first."""
    return df if fits_one_task(df) else written(df.select(*dict.fromkeys(columns)), "measured")


def _flagged(df: DataFrame, bounds: DataFrame, keys: list[str], value: str, low: Column, high: Column, min_rows: int) -> DataFrame:
    """Rows outside the bounds of their group, by an inner join on non-null keys.

    Bounds of few groups are broadcast: a shuffle by them would bring a whole group to one task.
    """
    named = bounds.select(*(F.col(k).alias(f"_b_{k}") for k in keys), low.alias("_low"), high.alias("_high"), "_rows")
    if keys:
        named = small(written(named, "bounds"))
        joined = df.join(named, [F.col(k) == F.col(f"_b_{k}") for k in keys], "inner")
    else:
        joined = df.withColumns(_one_row(named))
    keep = F.col(value).between(F.col("_low"), F.col("_high")) | (F.col("_rows") < min_rows)
    return joined.filter(F.when(keep, 0).otherwise(1) == 1)


def _one_row(df: DataFrame) -> dict[str, Column]:
    """The columns of a table of one row at most, each as a scalar subquery."""
    return {f.name: df.select(f.name).scalar() for f in df.schema.fields}


def _result(rows: DataFrame, case: str, number: str | None) -> DataFrame:
    num = F.col(number).cast("int") if number else F.lit(0)
    return rows.select(F.col(case).alias("case_id"), num.alias("activity_num")).distinct()


def _bounds(df: DataFrame, keys: list[str], value: str, shares: dict[str, float], rows: Column) -> DataFrame:
    sizes = df.groupBy(*keys).agg(rows.alias("_rows"))
    values = element_at_share(df, keys, value, shares)
    if not keys:
        return sizes.withColumns(_one_row(values))
    # A group without values keeps its size, and null bounds flag its rows.
    on = [F.col(f"s.{k}") == F.col(f"v.{k}") for k in keys]
    return sizes.alias("s").join(values.alias("v"), on, "left").select(*(F.col(f"s.{k}") for k in keys), "_rows", *shares)


def quantile_activity(df: DataFrame, case: str, number: str, activity: str, metric: str, sections: list[str] = (), detector: Detector = Detector(), whole_process: bool = False) -> DataFrame:
    """Events outside the quantile bounds of their activity and sections; with whole_process, their cases."""
    keys = [activity, *sections]
    df = _measured(df, case, number, *keys, metric)
    bounds = _bounds(df, keys, metric, {"low": detector.lower, "high": detector.upper}, F.count("*"))
    return _result(_flagged(df, bounds, keys, metric, F.col("low"), F.col("high"), detector.min_rows), case, None if whole_process else number)


def iqr_activity(df: DataFrame, case: str, number: str, activity: str, metric: str, sections: list[str] = (), min_rows: int = 30, whole_process: bool = False) -> DataFrame:
    """Events beyond 1.5 interquartile ranges from the quartiles of their activity and sections."""
    keys = [activity, *sections]
    df = _measured(df, case, number, *keys, metric)
    bounds = _bounds(df, keys, metric, {"q1": 0.25, "q3": 0.75}, F.count("*"))
    reach = (F.col("q3") - F.col("q1")) * 1.5
    return _result(_flagged(df, bounds, keys, metric, F.col("q1") - reach, F.col("q3") + reach, min_rows), case, None if whole_process else number)


def _case_rows(df: DataFrame, case: str, metric: str, sections: list[str]) -> DataFrame:
    return df.select(case, metric, *sections).distinct()


def quantile_case(df: DataFrame, case: str, metric: str, sections: list[str] = (), detector: Detector = Detector()) -> DataFrame:
    """Cases outside the quantile bounds of their sections, over distinct (case, metric, sections)."""
    rows, keys = _case_rows(df, case, metric, list(sections)), list(sections)
    bounds = _bounds(rows, keys, metric, {"low": detector.lower, "high": detector.upper}, F.count_distinct(case))
    return _result(_flagged(rows, bounds, keys, metric, F.col("low"), F.col("high"), detector.min_rows), case, None)


def iqr_case(df: DataFrame, case: str, metric: str, sections: list[str] = (), min_rows: int = 30) -> DataFrame:
    rows, keys = _case_rows(df, case, metric, list(sections)), list(sections)
    bounds = _bounds(rows, keys, metric, {"q1": 0.25, "q3": 0.75}, F.count_distinct(case))
    reach = (F.col("q3") - F.col("q1")) * 1.5
    return _result(_flagged(rows, bounds, keys, metric, F.col("q1") - reach, F.col("q3") + reach, min_rows), case, None)


def quantile_interpolated(df: DataFrame, case: str, number: str, activity: str, metric: str, sections: list[str] = (), detector: Detector = Detector()) -> DataFrame:
    """As quantile_activity with interpolated quantiles, and groups sized by distinct cases."""
    keys = [activity, *sections]
    df = _measured(df, case, number, *keys, metric)
    sizes = df.groupBy(*keys).agg(F.count_distinct(case).alias("_rows"))
    bounds = sizes.join(exact_quantiles(df, keys, metric, {"low": detector.lower, "high": detector.upper}), keys, "left")
    return _result(_flagged(df, bounds, keys, metric, F.col("low"), F.col("high"), detector.min_rows), case, number)


def density_noise(df: DataFrame, value: str, eps: int, min_rows: int = 9, keys: list[str] = ()) -> DataFrame:
    """Rows of df whose value is noise of one-dimensional DBSCAN, by keys; value and eps are integers.

    A value is a core if at least min_rows values lie within eps of it, and noise if no core
    lies within eps. Distinct values are split into cells of eps, so a value's neighbours lie
    in its own and the two next cells: joins on cells take the place of one ordered window.
    """
    cell = F.floor(F.col(value) / eps)
    keys = list(keys)
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("_k")).withColumn("_cell", F.floor(F.col("_v") / eps))
    near = counted.select(*(F.col(k).alias(f"_n_{k}") for k in keys), F.col("_v").alias("_nv"), F.col("_k").alias("_nk"), F.explode(F.array(F.col("_cell") - 1, F.col("_cell"), F.col("_cell") + 1)).alias("_nc"))

    def around(left: DataFrame, right: DataFrame) -> DataFrame:
        same = [F.col(k).eqNullSafe(F.col(f"_n_{k}")) for k in keys]
        return left.join(right, [F.col("_cell") == F.col("_nc"), *same]).filter(F.abs(F.col("_v") - F.col("_nv")) <= eps)

    cores = around(counted, near).groupBy(*keys, "_v", "_cell").agg(F.sum("_nk").alias("_in")).filter(F.col("_in") >= min_rows)
    core_near = cores.select(*(F.col(k).alias(f"_n_{k}") for k in keys), F.col("_v").alias("_nv"), F.explode(F.array(F.col("_cell") - 1, F.col("_cell"), F.col("_cell") + 1)).alias("_nc"))
    covered = around(counted, core_near).select(*(F.col(k).alias(f"_c_{k}") for k in keys), F.col("_v").alias("_cv")).distinct()
    on = [F.col(value) == F.col("_cv"), *(F.col(k).eqNullSafe(F.col(f"_c_{k}")) for k in keys)]
    return df.filter(F.col(value).isNotNull()).withColumn("_cell", cell).join(covered, on, "left_anti").drop("_cell")


def small_magnitudes(df: DataFrame, value: str, share: float = 0.3) -> DataFrame:
    """Rows whose magnitude is below the given quantile of magnitudes.

    The optimum of a one-class machine with an even power kernel in one dimension, idealised:
    a solver's tolerance and ties at the edge can differ.
    """
    sized = df.withColumn("_abs", F.abs(value))
    edge = element_at_share(sized, [], "_abs", {"_edge": share})
    return sized.withColumns(_one_row(edge)).filter(F.col("_abs") < F.col("_edge")).drop("_abs", "_edge")


def ensemble(df: DataFrame, case: str, number: str, metric: str, eps: int, min_rows: int = 9, share: float = 0.3) -> DataFrame:
    """Density noise and small magnitudes of the metric, all groups pooled."""
    rows = df.select(case, number, metric).distinct()
    both = density_noise(rows, metric, eps, min_rows).unionByName(small_magnitudes(rows.filter(F.col(metric).isNotNull()), metric, share))
    return _result(both, case, number)


def detect(kind: str, df: DataFrame, case: str, number: str, activity: str, metric: str, sections: list[str] = (), **params) -> DataFrame:
    """A detector by name: default, manual, iqr or ensemble."""
    if kind == "default":
        return quantile_activity(df, case, number, activity, metric, list(sections), Detector())
    if kind == "manual":
        return quantile_activity(df, case, number, activity, metric, list(sections), Detector(**params))
    if kind == "iqr":
        return iqr_activity(df, case, number, activity, metric, list(sections), **params)
    if kind == "ensemble":
        return ensemble(df, case, number, metric, **params)
    raise ValueError(f"unknown detector {kind!r}")


#: Fields of a request and the kinds that they may have.
REQUEST = {"detector": str, "params": dict, "case": str, "number": str, "activity": str, "metric": str, "sections": list, "outlier_num": int}


def by_request(df: DataFrame, request: str | dict) -> tuple[DataFrame | None, dict]:
    """(outliers, answer) of a request, as JSON or a dict, with the fields of REQUEST.

    case, number, activity and metric, which name columns, are needed; detector is
    "default", sections none and params empty unless given. The answer holds
    response, "ok" or "error", the message of an error, and outlier_num as it came.
    Requests that cannot be read, name unknown fields or columns, have fields of a wrong
    kind or parameters that the detector refuses give an error and no outliers; errors of
    running jobs are not caught.
    """
    number = None
    try:
        asked = json.loads(request) if isinstance(request, str) else dict(request)
        if not isinstance(asked, dict):
            raise ValueError("a request is an object")
        number = asked.get("outlier_num")
        if unknown := sorted(set(asked) - set(REQUEST)):
            raise ValueError(f"unknown fields: {', '.join(unknown)}")
        if missing := [f for f in ("case", "activity", "metric", "number") if f not in asked]:
            raise ValueError(f"missing fields: {', '.join(missing)}")
        if wrong := [f for f, v in asked.items() if not isinstance(v, REQUEST[f]) or isinstance(v, bool)]:
            raise ValueError(f"fields of a wrong kind: {', '.join(wrong)}")
        columns = [asked[f] for f in ("case", "activity", "metric", "number")] + asked.get("sections", [])
        if absent := [c for c in columns if c not in df.columns]:
            raise ValueError(f"columns not found: {', '.join(map(str, absent))}")
        found = detect(asked.get("detector", "default"), df, asked["case"], asked["number"], asked["activity"], asked["metric"], asked.get("sections", []), **asked.get("params", {}))
    except (ValueError, TypeError) as e:
        return None, {"response": "error", "message": str(e), "outlier_num": number}
    return found, {"response": "ok", "message": None, "outlier_num": number}
