"""Metric families of an event log, each one grouped aggregation over the shared base.

Metrics are columns by name, so a call asks for any of them and Spark reads only what these
need. Null keys are left out. Set-valued metrics hold whole groups, so they are computed
only when asked for by name.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.eventlog import EventLog, unit_us
from loomline.functions.scalar import whole_mean, whole_sum
from loomline.operators.quantiles import exact_quantiles, fits_one_task
from loomline.sources.scratch import written

TIME = ("total_duration", "mean_duration", "median_duration", "max_duration", "min_duration", "variance_duration", "std_duration")


def time_metrics(unit: str = "hour", duration: str = "duration_us") -> dict[str, Column]:
    """Seven statistics of durations in a unit; totals of nothing are 0, the others null.

    The variance is that of seconds, divided by the unit once. Totals are exact: those of some
    million long events have no place in 64 bits.
    """
    us = float(unit_us(unit))
    d = F.col(duration)
    total = whole_sum(d)
    seconds = d / 1e6
    return {
        "total_duration": F.coalesce(total, F.lit(0.0)) / us,
        "mean_duration": whole_mean(d) / us,
        "median_duration": F.median(d) / us,
        "max_duration": F.max(d) / us,
        "min_duration": F.min(d) / us,
        "variance_duration": F.var_pop(seconds) / (us / 1e6),
        "std_duration": F.stddev_pop(seconds) / (us / 1e6),
    }


def _sets(column: str, name: str) -> dict[str, Column]:
    return {f"unique_{name}": F.sort_array(F.collect_set(column)), f"unique_{name}_num": F.count_distinct(column)}


def _cases() -> dict[str, Column]:
    return {"unique_ids": F.sort_array(F.collect_set("case_id")), "unique_ids_num": F.count_if("new_case")}


class Metrics:
    """A family: the rows it groups, their key, and its metrics by name."""

    key: tuple[str, ...] = ()
    default: tuple[str, ...] = ()

    def __init__(self, log: EventLog, unit: str = "hour", digits: int | None = None):
        unit_us(unit)
        self.log, self.unit, self.digits = log, unit, digits

    def rows(self) -> DataFrame:
        """With new_case, which marks one row of each case and key: cases of a key are counted where their rows lie."""
        same = Window.partitionBy("case_id", *self.key).orderBy("activity_num")
        rows = self.log.base().dropna(subset=list(self.key))
        return rows.withColumn("new_case", F.col("case_id").isNotNull() & (F.row_number().over(same) == 1))

    @cached_property
    def stored(self) -> DataFrame:
        """The rows, written once: what needs several passes reads them from here."""
        return written(self.rows(), "metric-rows")

    def columns(self) -> dict[str, Column]:
        raise NotImplementedError

    def calc(self, *names: str, strict: bool = True) -> DataFrame:
        """The named metrics by key, in one aggregation. Unknown names raise unless strict is False."""
        known = self.columns()
        unknown = [n for n in names if n not in known]
        if unknown and strict:
            raise ValueError(f"unknown metrics: {', '.join(unknown)}; known are {', '.join(known)}")
        chosen = [n for n in names if n in known]
        apart = self._apart(chosen)
        plain = [self._rounded(known[n]).alias(n) if n in self._fractions() else known[n].alias(n) for n in chosen if n not in apart]
        rows = self.stored if apart else self.rows()
        out = rows.groupBy(*self.key).agg(*plain) if plain else rows.select(*self.key).distinct()
        for part in {id(x): x for x in apart.values()}.values():
            out = out.join(part, list(self.key), "left")
        return out.select(*self.key, *dict.fromkeys(chosen))

    def _apart(self, names: list[str]) -> dict[str, DataFrame]:
        """Metrics that no aggregation by the key alone should give, in tables (key, metrics).

        A median holds the distinct durations of a whole group in one task, so only that of a
        small log is one of the aggregates.
        """
        if "median_duration" not in names or fits_one_task(self.log.df):
            return {}
        median = exact_quantiles(self.stored, list(self.key), "duration_us", {"_median": 0.5})
        return {"median_duration": median.select(*self.key, self._rounded(F.col("_median") / float(unit_us(self.unit))).alias("median_duration"))}

    def _fractions(self) -> set[str]:
        return {*TIME, "aver_count_in_trace", "loop_percent", "throughput"}

    def _rounded(self, c: Column) -> Column:
        return c if self.digits is None else F.round(c, self.digits)

    def apply(self, std: bool = True) -> DataFrame:
        """All metrics but the set-valued ones, most frequent keys first where there is a count."""
        names = [n for n in self.default if std or n not in ("variance_duration", "std_duration")]
        out = self.calc(*names)
        return out.orderBy(F.desc("count"), *self.key) if "count" in names else out

    def inclusion_rate(self, activities: list[str]) -> DataFrame:
        """Share of each key's cases that hold any of these activities anywhere."""
        case = Window.partitionBy("case_id")
        hit = self.rows().withColumn("hit", F.max(F.col("activity").isin(activities)).over(case))
        share = F.count_if(F.col("new_case") & F.col("hit")) / F.nullif(F.count_if("new_case"), F.lit(0))
        return hit.groupBy(*self.key).agg(self._rounded(share).alias("inclusion_rate"))

    def success_rate(self, activities: list[str]) -> DataFrame:
        return self.inclusion_rate(activities).withColumnRenamed("inclusion_rate", "success_rate")

    def failure_rate(self, activities: list[str]) -> DataFrame:
        return self.inclusion_rate(activities).withColumnRenamed("inclusion_rate", "failure_rate")


def _per_case(key: str) -> dict[str, Column]:
    count, cases = F.count(key), F.count_if("new_case")
    return {
        "count": count,
        **_cases(),
        "aver_count_in_trace": count / F.nullif(cases, F.lit(0)),
        "loop_percent": (1 - cases / count) * 100,
    }


class ActivityMetrics(Metrics):
    """By activity."""

    key = ("activity",)

    def columns(self):
        time = time_metrics(self.unit)
        return {**_per_case("activity"), "throughput": F.count("activity") / F.nullif(time["total_duration"], F.lit(0.0)), **_sets("user", "users"), **time}

    @property
    def default(self):
        return ("count", "unique_ids_num", "aver_count_in_trace", "loop_percent", "throughput", *(("unique_users_num",) if self.log.user else ()), *TIME)


class TransitionMetrics(Metrics):
    """By pair of an activity and the next one of the case; durations are the first one's."""

    key = ("activity", "next_activity")

    def columns(self):
        time = time_metrics(self.unit)
        return {**_per_case("activity"), "throughput": F.count("activity") / F.nullif(time["total_duration"], F.lit(0.0)), **_sets("user", "users"), **time}

    @property
    def default(self):
        return ("count", "unique_ids_num", "aver_count_in_trace", "loop_percent", "throughput", *(("unique_users_num",) if self.log.user else ()), *TIME)


class CaseMetrics(Metrics):
    """By case."""

    key = ("case_id",)

    def rows(self) -> DataFrame:
        return self.log.base().dropna(subset=["case_id"])

    def columns(self):
        length, kinds = F.count("activity"), F.count_distinct("activity")
        ordered = F.array_sort(F.collect_list(F.struct("activity_num", "activity")))
        return {
            "trace": F.transform(ordered, lambda x: x["activity"]),
            "trace_length": length,
            **_sets("activity", "activities"),
            "loop_percent": (1 - kinds / F.nullif(length, F.lit(0))) * 100,
            **_sets("user", "users"),
            **time_metrics(self.unit),
        }

    def _apart(self, names):
        return {}  # a case is one group of its trace anyway

    @property
    def default(self):
        return ("trace", "trace_length", "unique_activities_num", "loop_percent", *(("unique_users_num",) if self.log.user else ()), *TIME)


class UserMetrics(Metrics):
    """By user; a log without users raises."""

    key = ("user",)

    def __init__(self, log, unit="hour", digits=None):
        if not log.user:
            raise ValueError("user metrics need a user column")
        super().__init__(log, unit, digits)

    def columns(self):
        time = time_metrics(self.unit)
        return {
            "count": F.count("user"),
            **_sets("activity", "activities"),
            **_cases(),
            "throughput": F.count("user") / F.nullif(time["total_duration"], F.lit(0.0)),
            **time,
        }

    default = ("count", "unique_activities_num", "unique_ids_num", "throughput", *TIME)

    def apply(self, std: bool = True) -> DataFrame:
        """With workload, the user's share of all events with a user."""
        out = super().apply(std)
        return out.withColumn("workload", self._rounded(F.col("count") / out.agg(F.sum("count")).scalar()))


class VariantMetrics(Metrics):
    """By trace; time metrics are of the cases' total durations."""

    key = ("trace",)

    def rows(self) -> DataFrame:
        case = CaseMetrics(self.log, self.unit)
        per = case.rows().groupBy("case_id").agg(
            case.columns()["trace"].alias("trace"),
            F.coalesce(F.sum("duration_us"), F.lit(0)).alias("duration_us"),
            *((F.collect_set("user").alias("users"),) if self.log.user else (F.array().cast("array<string>").alias("users"),)),
        )
        return per

    def columns(self):
        trace = F.first("trace")
        return {
            "count": F.count("*"),
            "ids": F.sort_array(F.collect_list("case_id")),
            "trace_length": F.size(trace),
            "unique_activities": F.sort_array(F.array_distinct(trace)),
            "unique_activities_num": F.size(F.array_distinct(trace)),
            "loop_percent": (1 - F.size(F.array_distinct(trace)) / F.size(trace)) * 100,
            "unique_users": F.sort_array(F.collect_set("user")),
            "unique_users_num": F.count_distinct("user"),
            **time_metrics(self.unit),
        }

    def _apart(self, names):
        """Besides the median the users, counted from one row per case and user."""
        out = super()._apart(names)
        some = [n for n in ("unique_users", "unique_users_num") if n in names]
        if some:
            users = self.stored.select("trace", F.explode_outer("users").alias("user")).groupBy("trace").agg(*(self.columns()[n].alias(n) for n in some))
            out |= dict.fromkeys(some, users)
        return out

    @property
    def default(self):
        return ("count", "trace_length", "unique_activities_num", "loop_percent", *(("unique_users_num",) if self.log.user else ()), *TIME)

    def inclusion_rate(self, activities: list[str]) -> DataFrame:
        """1 for variants that hold any of these activities, else 0: all cases of a variant are alike."""
        hit = F.arrays_overlap("trace", F.array(*map(F.lit, activities)))
        return self.rows().select("trace").distinct().select("trace", F.when(hit, 1.0).otherwise(0.0).alias("inclusion_rate"))


FAMILIES = {"activity": ActivityMetrics, "transition": TransitionMetrics, "case": CaseMetrics, "user": UserMetrics, "variant": VariantMetrics}


def virtual_metrics(log: EventLog) -> DataFrame:
    """One row: cases, activities, transitions, variants, and shares of repeats in the log.

    transition_percent is the share of transitions in all events, transition_cycle_percent
    that of transitions which their case has had before; shares of nothing are null.
    """
    base = log.base()
    step = F.when(F.col("next_activity").isNotNull(), F.struct("activity", "next_activity"))
    per_case = base.groupBy("case_id").agg(F.count("activity").alias("n"), F.count_distinct("activity").alias("kinds"), F.count("next_activity").alias("steps"), F.count_distinct(step).alias("step_kinds"), F.array_sort(F.collect_list(F.struct("activity_num", "activity"))).alias("t"))
    return per_case.agg(
        F.count("*").alias("case_count"),
        F.sum("n").alias("activity_count"),
        F.sum("steps").alias("transition_count"),
        F.count_distinct(F.transform("t", lambda x: x["activity"])).alias("variant_count"),
        F.sum(F.col("n") - F.col("kinds")).alias("rework_count"),
        (F.sum(F.col("n") - F.col("kinds")) / F.nullif(F.sum("n"), F.lit(0)) * 100).alias("activity_cycle_percent"),
        (F.sum("steps") / F.nullif(F.sum("n"), F.lit(0)) * 100).alias("transition_percent"),
        (F.sum(F.col("steps") - F.col("step_kinds")) / F.nullif(F.sum("steps"), F.lit(0)) * 100).alias("transition_cycle_percent"),
    )


def duration_from_start(log: EventLog) -> DataFrame:
    """By activity: events with a time, mean and longest hours since their case's first event.

    Case starts come from one aggregation and are joined, so that a long case is not sorted.
    """
    rows = log.base().filter(F.col("ts").isNotNull() & F.col("activity").isNotNull())
    starts = log.base().groupBy(F.col("case_id").alias("_case")).agg(F.min("ts").alias("_start"))
    hours = F.timestamp_diff("MICROSECOND", F.col("_start"), F.col("ts")) / 3.6e9
    joined = rows.join(starts, F.col("case_id") == F.col("_case"))
    return joined.groupBy("activity").agg(F.count("*").alias("n"), F.avg(hours).alias("mean_from_start"), F.max(hours).alias("max_from_start"))
