"""Event logs: a DataFrame whose columns have roles, and the fields derived from their order."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.sources.scratch import estimated_bytes

#: Bytes of files, by Spark's estimate, whose rows one task sorts by case; a quarter of a million rows of lineitem or more.
PART_BYTES = 8 << 20
#: Estimates of more parts are none: Spark multiplies the sides of a join.
MOST_PARTS = 20_000
#: Microseconds in a unit of time.
UNITS = {"s": 1_000_000, "m": 60_000_000, "h": 3_600_000_000, "d": 86_400_000_000, "w": 604_800_000_000}
_NAMES = {"second": "s", "minute": "m", "hour": "h", "day": "d", "week": "w"}


def unit_us(unit: str) -> int:
    """Microseconds in a unit given by its letter or name; others raise ValueError."""
    key = _NAMES.get(unit, unit)
    if key not in UNITS:
        raise ValueError(f"unknown time unit {unit!r}; known are {', '.join([*UNITS, *_NAMES])}")
    return UNITS[key]


def micros(a: Column, b: Column) -> Column:
    """Microseconds from a to b, exact for timestamps with and without time zone."""
    return F.timestamp_diff("MICROSECOND", a, b)


@dataclass(frozen=True)
class EventLog:
    """One row per activity occurrence.

    Columns of df are named by role. Within a case, events stand in the order of start, end
    and tiebreak; without unique tiebreaks the order of equal events is open. At least one
    of start, end and tiebreak must be given.
    """

    df: DataFrame
    case: str
    activity: str
    start: str | None = None
    end: str | None = None
    user: str | None = None
    text: str | None = None
    tiebreak: tuple[str, ...] = ()

    def __post_init__(self):
        named = [c for c in (self.case, self.activity, self.start, self.end, self.user, self.text, *self.tiebreak) if c]
        missing = [c for c in named if c not in self.df.columns]
        if missing:
            raise ValueError(f"columns not in the log: {', '.join(missing)}")
        if not self.order:
            raise ValueError("a log needs a start, an end or a tiebreak column to have an order")

    @property
    def order(self) -> list[str]:
        return [c for c in (self.start, self.end, *self.tiebreak) if c]

    @property
    def time(self) -> str | None:
        """The start column, or the end column where there is no start."""
        return self.start or self.end

    @property
    def by_case(self) -> DataFrame:
        """df dealt by case in parts of PART_BYTES of its files, so that what a task sorts is as large for any input.

        What has fewer parts than there are cores, and what has no estimate, is left to Spark to deal.
        """
        if self.df.isStreaming:
            return self.df
        parts = estimated_bytes(self.df) // PART_BYTES + 1
        cores = self.df.sparkSession.sparkContext.defaultParallelism
        return self.df.repartition(parts, self.case) if cores < parts <= MOST_PARTS else self.df

    def within_case(self):
        return Window.partitionBy(self.case).orderBy(*self.order)

    def duration(self) -> Column:
        """Microseconds of an event, signed.

        With both timestamps end - start; with starts alone the time to the next event of
        the case (null for the last); with ends alone the time since the one before (null
        for the first); without timestamps null.
        """
        if self.start and self.end:
            return micros(F.col(self.start), F.col(self.end))
        if self.start:
            return micros(F.col(self.start), F.lead(self.start).over(self.within_case()))
        if self.end:
            return micros(F.lag(self.end).over(self.within_case()), F.col(self.end))
        return F.lit(None).cast("bigint")

    def base(self) -> DataFrame:
        """The log under fixed names: case_id, activity, ts, user, duration_us, next_activity.

        One shuffle by case and one sort serve the duration and the next activity; all
        metric families start here and read only these columns.
        """
        null = F.lit(None).cast("string")
        return self.by_case.select(
            F.col(self.case).alias("case_id"),
            F.col(self.activity).alias("activity"),
            *((F.col(self.time).alias("ts"),) if self.time else ()),
            (F.col(self.user) if self.user else null).alias("user"),
            self.duration().alias("duration_us"),
            F.lead(self.activity).over(self.within_case()).alias("next_activity"),
            F.row_number().over(self.within_case()).alias("activity_num"),
        )

    def with_fields(self, **expressions: str) -> EventLog:
        """The log with more columns, each given by a SQL expression over the others."""
        return replace(self, df=self.df.withColumns({name: F.expr(e) for name, e in expressions.items()}))

    def enriched(self) -> DataFrame:
        """The log with derived fields of events, cases and transitions.

        activity_num, is_first, is_last, rework_num (occurrences of the activity in the case
        so far, from 0), is_rework, next_activity, duration_us, activity_end; case_start,
        case_end, case_duration_us, activity_cnt, activity_cnt_unique, transition_cnt,
        transition_cnt_unique and variant (activities joined by ">"). What belongs to a case
        is computed once a case and joined; rows without a case have none of it.
        """
        w = self.within_case()
        same = Window.partitionBy(self.case, self.activity).orderBy(*self.order)
        time = F.col(self.time) if self.time else F.lit(None).cast("timestamp")
        out = self.by_case.select(
            "*",
            F.row_number().over(w).alias("activity_num"),
            F.lead(self.activity).over(w).alias("next_activity"),
            self.duration().alias("duration_us"),
            (F.lead(self.time).over(w) if self.time else time).alias("activity_end"),
            (F.row_number().over(same) - 1).alias("rework_num"),
        )
        ordered = F.array_sort(F.collect_list(F.struct(*self.order, F.col(self.activity).alias("_a"))))
        per = self.df.filter(F.col(self.case).isNotNull()).groupBy(F.col(self.case).alias("_case")).agg(
            F.min(time).alias("case_start"),
            F.max(F.col(self.end) if self.end else time).alias("case_end"),
            F.transform(ordered, lambda x: x["_a"]).alias("_trace"),
        )
        rest = F.size("_trace") - 1
        steps = F.zip_with(F.slice("_trace", 1, rest), F.slice("_trace", 2, rest), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        per = per.withColumn("_steps", F.filter(steps, lambda x: x["b"].isNotNull())).withColumn("_known", F.filter("_trace", lambda x: x.isNotNull()))
        per = per.select(
            "_case",
            "case_start",
            "case_end",
            F.size("_known").cast("long").alias("activity_cnt"),
            F.size(F.array_distinct("_known")).alias("activity_cnt_unique"),
            micros(F.col("case_start"), F.col("case_end")).alias("case_duration_us"),
            F.size("_steps").cast("long").alias("transition_cnt"),
            F.size(F.array_distinct("_steps")).alias("transition_cnt_unique"),
            F.array_join("_trace", ">").alias("variant"),
        )
        out = out.withColumns({"is_first": F.col("activity_num") == 1, "is_last": F.col("next_activity").isNull(), "is_rework": F.col("rework_num") > 0})
        return out.join(per, F.col(self.case) == F.col("_case"), "left").drop("_case")


def with_sentinels(log: EventLog) -> DataFrame:
    """(case_id, activity, duration_us, pos): the log with a start and an end event per case.

    The first and the last event of a case bring them along, so the log is read once.
    """
    w = log.within_case()
    base = log.by_case.select(
        F.col(log.case).alias("case_id"),
        F.col(log.activity).alias("activity"),
        F.coalesce(log.duration(), F.lit(0)).cast("long").alias("duration_us"),
        F.row_number().over(w).cast("long").alias("pos"),
        F.lead(F.lit(True)).over(w).isNull().alias("last"),
    )

    def event(name, duration, pos):
        return F.struct(name.alias("activity"), duration.alias("duration_us"), pos.alias("pos"))

    none, zero = F.array().cast("array<struct<activity:string,duration_us:bigint,pos:bigint>>"), F.lit(0).cast("long")
    rows = F.concat(
        F.when(F.col("pos") == 1, F.array(event(F.lit("start"), zero, zero))).otherwise(none),
        F.array(event(F.col("activity").cast("string"), F.col("duration_us"), F.col("pos"))),
        F.when(F.col("last"), F.array(event(F.lit("end"), zero, F.col("pos") + 1))).otherwise(none),
    )
    return base.select("case_id", F.explode(rows).alias("e")).select("case_id", "e.activity", "e.duration_us", "e.pos")
