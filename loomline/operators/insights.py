"""Indicators of bottlenecks and repeats, and case-by-activity matrices."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.eventlog import EventLog
from loomline.functions.scalar import whole_mean
from loomline.operators.factors import moments
from loomline.operators.quantiles import exact_quantiles
from loomline.operators.selection import all_regressions
from loomline.sources.scratch import written

#: Activities that a matrix may have as columns.
PIVOT_COLUMNS = 1000


def ratio_or_one(a: Column, b: Column) -> Column:
    """a / b, and 1 where that has no finite value."""
    return F.coalesce(a / F.nullif(b, F.lit(0.0)), F.lit(1.0))


def mean_median_ratio(log: EventLog) -> DataFrame:
    """By activity: mean duration over median duration, 1 where the median is null or 0."""
    base = written(log.base().filter(F.col("activity").isNotNull()).select("activity", "duration_us"), "durations")
    mean = base.groupBy("activity").agg(whole_mean(F.col("duration_us")).alias("mean"))
    middle = exact_quantiles(base, ["activity"], "duration_us", {"median": 0.5})
    return mean.join(middle, "activity", "left").select("activity", ratio_or_one(F.col("mean"), F.col("median")).alias("mean_median_ratio"))


def bisect_ratio(log: EventLog) -> DataFrame:
    """By activity: mean duration in the second half of the log's time span over the first.

    Events up to the midpoint are in the first half. The span is a scalar subquery.
    """
    return _bisect_ratio(log.base().filter(F.col("activity").isNotNull()))


def _bisect_ratio(base: DataFrame) -> DataFrame:
    first_ts = base.agg(F.min("ts")).scalar()
    span = base.agg(F.timestamp_diff("MICROSECOND", F.min("ts"), F.max("ts"))).scalar()
    half = F.timestamp_diff("MICROSECOND", first_ts, F.col("ts")) * 2 <= span
    first, second = whole_mean(F.when(half, F.col("duration_us"))), whole_mean(F.when(~half, F.col("duration_us")))
    return base.groupBy("activity").agg(ratio_or_one(second, first).alias("bisect_ratio"))


def durations_by_activity(log: EventLog) -> DataFrame:
    """(activity, duration_us) of all known durations, long rather than one list per activity."""
    return log.base().dropna(subset=["activity", "duration_us"]).select("activity", "duration_us")


def duration_warnings(log: EventLog) -> DataFrame:
    """By activity: whether durations are missing, all zero, or too few to judge."""
    base = log.base().filter(F.col("activity").isNotNull())
    n = F.count("duration_us")
    flag = F.when(n == 0, "missing").when(F.max(F.abs("duration_us")) == 0, "zero").when(n < 2, "insufficient").otherwise("ok")
    return base.groupBy("activity").agg(flag.alias("warning"))


def pivot(log: EventLog, kind: str = "appearance", activities: list[str] | None = None, metric: str | None = None) -> DataFrame:
    """One row per case and a column per activity.

    appearance counts events, recycles those beyond the first, time is log(1 + seconds) of
    their durations; user sums a column of the log. Cases with a negative duration are left
    out of time. Without a list, the log's activities are looked up first.
    """
    if kind == "user":
        base = log.df.select(F.col(log.case).alias("case_id"), F.col(log.activity).alias("activity"), F.col(metric).alias("_v"))
    else:
        base = log.base()
    base = base.dropna(subset=["case_id", "activity"])
    if kind == "time":
        bad = base.groupBy("case_id").agg(F.min("duration_us").alias("least")).filter("least < 0").select("case_id")
        base = base.join(bad, "case_id", "left_anti")
    if activities is None:
        activities = sorted(r.activity for r in base.select("activity").distinct().limit(PIVOT_COLUMNS + 1).collect())
        if len(activities) > PIVOT_COLUMNS:
            raise ValueError(f"more than {PIVOT_COLUMNS} activities; name those that are wanted")
    grouped = base.groupBy("case_id").pivot("activity", activities)
    if kind in ("appearance", "recycles"):
        wide = grouped.agg(F.count("activity"))
    elif kind == "time":
        wide = grouped.agg(F.sum(F.coalesce(F.col("duration_us"), F.lit(0)) / 1e6))
    elif kind == "user":
        wide = grouped.agg(F.sum("_v"))
    else:
        raise ValueError(f"unknown pivot {kind!r}")
    value = lambda a: F.coalesce(F.col(f"`{a}`"), F.lit(0))
    shape = {"recycles": lambda c: F.greatest(c - 1, F.lit(0)), "time": F.log1p}.get(kind, lambda c: c)
    return wide.select("case_id", *(shape(value(a)).alias(a) for a in activities))


LABELS = {
    "mean_time": "long stage",
    "diff_time": "growing duration",
    "mean_median": "irregular duration",
    "cycles": "loops",
}


def insight_table(log: EventLog) -> DataFrame:
    """By activity: mean_time (seconds), diff_time, frequency, cycles, mean_median, duplicates_rate, activities_num, anomaly_level.

    anomaly_level is the share of known durations beyond the upper quartile by more than 1.5
    interquartile ranges; 0 without durations.
    """
    base = written(log.base().filter(F.col("activity").isNotNull()), "insight-rows")
    n, cases = F.count("*"), F.count_distinct("case_id")
    per = base.groupBy("activity").agg(
        (whole_mean(F.col("duration_us")) / 1e6).alias("mean_time"),
        (n / cases).alias("frequency"),
        ((1 - cases / n) * 100).alias("cycles"),
        ((n - cases) / n).alias("duplicates_rate"),
        n.alias("activities_num"),
        whole_mean(F.col("duration_us")).alias("_mean"),
    )
    parts = exact_quantiles(base, ["activity"], "duration_us", {"_q1": 0.25, "_q2": 0.5, "_q3": 0.75})
    known = base.select("activity", "duration_us").join(parts, "activity")
    far = F.col("duration_us") > F.col("_q3") + (F.col("_q3") - F.col("_q1")) * 1.5
    level = known.groupBy("activity").agg(F.avg(F.when(F.col("duration_us").isNotNull(), far.cast("double"))).alias("_level"), F.first("_q2").alias("_q2"))
    out = per.join(level, "activity", "left").join(_bisect_ratio(base).withColumnRenamed("bisect_ratio", "diff_time"), "activity")
    return out.select("activity", "mean_time", "frequency", "cycles", "duplicates_rate", "activities_num", ratio_or_one(F.col("_mean"), F.col("_q2")).alias("mean_median"), F.coalesce("_level", F.lit(0.0)).alias("anomaly_level"), "diff_time")


def insight_flags(log: EventLog, limits: dict[str, float] | None = None) -> DataFrame:
    """(activity, metric, value, label) of the indicators beyond their limits; rules of our own.

    The default limits are the 75 % point of mean times over activities, growth by 10 %, a
    mean of 1.5 medians and 20 % of repeats.
    """
    table = written(insight_table(log), "insights")
    limits = {"diff_time": 1.1, "mean_median": 1.5, "cycles": 20.0} | (limits or {})
    given = {m: F.lit(float(limits[m])) for m in LABELS if m in limits}
    given.setdefault("mean_time", F.coalesce(table.agg(F.percentile("mean_time", F.lit(0.75))).scalar(), F.lit(0.0)))
    table = table.withColumns({f"_{m}": c for m, c in given.items()})
    rows = F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"), F.lit(t).alias("label"), F.col(f"_{m}").alias("limit")) for m, t in LABELS.items())))
    return table.select("activity", rows.alias("r")).filter(F.col("r.value") > F.col("r.limit")).select("activity", "r.metric", "r.value", "r.label")


#: Labels of activities, and what must hold for them; the rules are our own.
STAGE_LABELS = {
    "long stage": "mean_time > slow",
    "growing duration": "diff_time > 1.1",
    "rare stage": "share < 0.5",
    "loops": "cycles > 20",
    "rare and slow bottleneck": "share < 0.5 and mean_time > slow",
    "common and uneven bottleneck": "share >= 0.5 and mean_median > 1.5",
    "many overlong runs": "anomaly_level > 0.05",
    "single overlong runs": "anomaly_level > 0 and anomaly_level <= 0.05",
    "process growth": "case_ratio > 1.1",
}
TEXT_LABELS = {
    "errors, case succeeds": "errors_won > 0",
    "errors, case fails": "errors_lost > 0",
    "design errors, case fails": "errors_lost > 0 and errors_lost = errors",
    "reversals, case succeeds": "reversals_won > 0",
    "reversals, case fails": "reversals_lost > 0",
}


def stage_labels(log: EventLog) -> DataFrame:
    """(activity, label) of time and order: STAGE_LABELS over the indicators of each activity.

    slow is the 75 % point of mean times over activities, often one of these itself, so both
    come from one written table; share is the part of cases that hold the activity,
    case_ratio the mean duration of these cases over that of all.
    """
    table = written(insight_table(log), "insights")
    base = log.base()
    cases = base.groupBy("case_id").agg(F.timestamp_diff("MICROSECOND", F.min("ts"), F.max("ts")).alias("us"))
    held = base.filter(F.col("activity").isNotNull()).select("activity", "case_id").distinct().join(cases, "case_id")
    n, mean = cases.agg(F.count("*")).scalar(), F.nullif(cases.agg(whole_mean(F.col("us"))).scalar(), F.lit(0.0))
    per = held.groupBy("activity").agg(F.count("*").alias("_n"), whole_mean(F.col("us")).alias("_us")).select("activity", (F.col("_n") / n).alias("share"), (F.col("_us") / mean).alias("case_ratio"))
    table = table.join(per, "activity").withColumn("slow", table.agg(F.percentile("mean_time", F.lit(0.75))).scalar())
    return _labelled(table, STAGE_LABELS)


def text_labels(log: EventLog, success: str, errors: list[str], reversals: list[str]) -> DataFrame:
    """(activity, label) of texts: TEXT_LABELS over events with words of errors or reversals, in cases with and without the success activity."""
    flagged = text_flags(log, errors).withColumnRenamed("has_word", "_error")
    flagged = text_flags(replace(log, df=flagged), reversals).withColumnRenamed("has_word", "_reversal")
    won = flagged.groupBy(F.col(log.case).alias("_case")).agg(F.max(F.col(log.activity) == success).alias("_won"))
    rows = flagged.join(won, F.col(log.case) == F.col("_case"))
    sums = {f"{n}_{w}": F.count_if(F.col(f"_{n[:-1]}") & (F.col("_won") == (w == "won"))) for n in ("errors", "reversals") for w in ("won", "lost")}
    table = rows.filter(F.col(log.activity).isNotNull()).groupBy(F.col(log.activity).alias("activity")).agg(F.count_if("_error").alias("errors"), *(c.alias(n) for n, c in sums.items()))
    return _labelled(table, TEXT_LABELS)


def _labelled(table: DataFrame, labels: dict[str, str]) -> DataFrame:
    found = F.array_compact(F.array(*(F.when(F.expr(rule), F.lit(label)) for label, rule in labels.items())))
    return table.select("activity", F.explode(found).alias("label"))


def insight_output(log: EventLog, mode: str = "clustered", hour_cost: float = 1.0) -> DataFrame:
    """The labels of stages in one of four shapes.

    clustered: (activity, labels) in one text; clustered_binary: a column of 0 or 1 per
    label; financial_only_effect: (activity, hours, effect), the hours beyond the median of
    every event of a labelled activity and their cost; transitions: (activity,
    next_activity, n) of the transitions out of labelled activities.
    """
    labels = stage_labels(log)
    if mode == "clustered":
        return labels.groupBy("activity").agg(F.array_join(F.sort_array(F.collect_list("label")), "; ").alias("labels"))
    if mode == "clustered_binary":
        names = list(STAGE_LABELS)
        return labels.groupBy("activity").agg(*(F.max((F.col("label") == n).cast("int")).alias(n.replace(" ", "_")) for n in names))
    named = labels.select("activity").distinct()
    base = log.base().join(named, "activity", "left_semi")
    if mode == "financial_only_effect":
        middle = exact_quantiles(base, ["activity"], "duration_us", {"_median": 0.5})
        beyond = F.sum(F.greatest(F.col("duration_us") - F.col("_median"), F.lit(0.0))) / 3.6e9
        return base.join(middle, "activity").groupBy("activity").agg(beyond.alias("hours")).withColumn("effect", F.col("hours") * hour_cost)
    if mode == "transitions":
        return base.filter(F.col("next_activity").isNotNull()).groupBy("activity", "next_activity").agg(F.count("*").alias("n"))
    raise ValueError(f"unknown output {mode!r}")


def problem_scores(pivoted: DataFrame, key: str, alpha: float = 0.0) -> DataFrame:
    """(activity, problem_score, weight, r2): how much each column of a case matrix drives the others.

    Each column is predicted from all others by a linear model, whose attribution to the row
    of the smallest key is coefficient * (value - mean); a column's attribution to itself is
    its mean. Attributions to all columns are weighted by the columns' shares of the total
    and scaled so that the largest score is 1 or -1. One pass over the matrix serves all
    models; the driver inverts one matrix of as many columns.
    """
    columns = [c for c in pivoted.columns if c != key]
    spark = pivoted.sparkSession
    schema = "activity string, problem_score double, weight double, r2 double"
    first = pivoted.orderBy(key).select(*(F.col(f"`{c}`").cast("double") for c in columns)).first() if columns else None
    if first is None:
        return spark.createDataFrame([], schema)
    n, s, p = moments(pivoted.select(*(F.col(f"`{c}`") for c in columns)), columns[:-1], columns[-1])[0]
    mean, x = s / n, np.array(first, dtype=float)
    w, fit = all_regressions((n, s, p), alpha)
    given = w * (x - mean)[:, None] + np.diag(mean)
    weight = s / s.sum() if s.sum() else np.zeros(k)
    score = given @ weight
    score = score / (np.abs(score).max() or 1.0)
    rows = [(c, float(score[i]), float(weight[i]), float(fit[i])) for i, c in enumerate(columns)]
    return spark.createDataFrame(rows, schema).orderBy(F.desc("problem_score"), "activity")


def text_flags(log: EventLog, words: list[str]) -> DataFrame:
    """The log with has_word: whether its text holds one of the words, whole and in any case."""
    if not log.text:
        raise ValueError("text flags need a text column")
    hit = F.lit(False)
    for w in words:
        hit = hit | F.coalesce(F.lower(log.text).rlike(rf"(?<!\w)\Q{w.lower()}\E(?!\w)"), F.lit(False))
    return log.df.withColumn("has_word", hit)
