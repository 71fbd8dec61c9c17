"""Registered queries of the library, with the SQL that must give the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomline.eventlog import EventLog, with_sentinels
from loomline.functions import scalar
from loomline.operators import cluster, density, factors, forecasting, happypath, insights, leastangle, metrics, outliers, quality, ranking, selection, series, transport, trees
from loomline.plans import runner
from loomline.sources import io, scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
DIGITS = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> EventLog:
    return EventLog(table(spark, sf_dir, "events"), "user_id", "event_type", "ts", tiebreak=("event_id",))


def lines(spark: SparkSession, sf_dir: str) -> EventLog:
    tie = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return EventLog(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_returnflag", "l_shipdate", user="l_suppkey", tiebreak=tie)


def orders(spark: SparkSession, sf_dir: str) -> EventLog:
    return EventLog(table(spark, sf_dir, "orders"), "o_custkey", "o_orderstatus", "o_orderdate", tiebreak=("o_orderkey",))


def talks(spark: SparkSession, sf_dir: str) -> EventLog:
    return EventLog(table(spark, sf_dir, "conversations"), "conv_id", "role", text="text", tiebreak=("turn",))


def _log(name: str, case: str, activity: str, order: str, ts: str | None, user: str = "NULL") -> str:
    time = f"{ts} AS ts, date_diff('microsecond', {ts}, lead({ts}) OVER w) AS duration_us" if ts else "NULL::TIMESTAMP AS ts, NULL::BIGINT AS duration_us"
    return f"log AS (SELECT {case} AS case_id, {activity} AS activity, {time}, {user} AS usr, lead({activity}) OVER w AS next_activity, row_number() OVER w AS activity_num FROM {name} WINDOW w AS (PARTITION BY {case} ORDER BY {order}))"


EVENTS = _log("events", "user_id", "event_type", "ts, event_id", "ts")
LINES = _log("lineitem", "l_orderkey", "l_returnflag", "l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice", "l_shipdate", "l_suppkey")
ORDERS = _log("orders", "o_custkey", "o_orderstatus", "o_orderdate, o_orderkey", "o_orderdate")
TALKS = _log("conversations", "conv_id", "role", "turn", None)

_TIME = ", ".join(
    f"round({e}, {DIGITS}) AS {n}"
    for n, e in {
        "total_duration": "coalesce(sum(duration_us), 0) / 3.6e9",
        "mean_duration": "avg(duration_us) / 3.6e9",
        "median_duration": "median(duration_us) / 3.6e9",
        "max_duration": "max(duration_us) / 3.6e9",
        "min_duration": "min(duration_us) / 3.6e9",
        "variance_duration": "var_pop(duration_us / 1e6) / 3600",
        "std_duration": "stddev_pop(duration_us / 1e6) / 3600",
    }.items()
)
#: Durations in lineitem are of years, so a variance has fewer meaningful digits.
_TIME_LONG = _TIME.replace(f"3600, {DIGITS}) AS variance", "3600, -3) AS variance")
_CASES = f"count(activity) AS count, count(DISTINCT case_id) AS unique_ids_num, round(count(activity) / count(DISTINCT case_id), {DIGITS}) AS aver_count_in_trace, round((1 - count(DISTINCT case_id) / count(activity)) * 100, {DIGITS}) AS loop_percent, round(count(activity) / nullif(coalesce(sum(duration_us), 0) / 3.6e9, 0), {DIGITS}) AS throughput"


def _long(df: DataFrame) -> DataFrame:
    return df.withColumn("variance_duration", F.round("variance_duration", -3))


def query(name: str, sql: str | None = None):
    """Registers a function of (spark, sf_dir) under a name, with the SQL that gives its rows."""

    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return add


# Metric families.


@query("activity_metrics", f"WITH {EVENTS} SELECT activity, {_CASES}, {_TIME} FROM log WHERE activity IS NOT NULL GROUP BY activity")
def _(spark, d):
    return metrics.ActivityMetrics(events(spark, d), digits=DIGITS).apply()


@query("activity_metrics_users", f"WITH {LINES} SELECT activity, {_CASES}, count(DISTINCT usr) AS unique_users_num, {_TIME_LONG} FROM log WHERE activity IS NOT NULL GROUP BY activity")
def _(spark, d):
    return _long(metrics.ActivityMetrics(lines(spark, d), digits=DIGITS).apply())


@query("activity_time_metrics", f"WITH {EVENTS} SELECT activity, round(avg(duration_us) / 6e7, 4) AS mean_duration, round(median(duration_us) / 6e7, 4) AS median_duration FROM log GROUP BY activity")
def _(spark, d):
    return metrics.ActivityMetrics(events(spark, d), unit="m", digits=4).calc("mean_duration", "median_duration")


@query("activity_case_sets", "SELECT event_type AS activity, array_to_string(list_sort(list(DISTINCT user_id)), ',') AS unique_ids FROM events GROUP BY 1")
def _(spark, d):
    out = metrics.ActivityMetrics(events(spark, d)).calc("unique_ids")
    return out.select("activity", F.array_join(F.col("unique_ids").cast("array<string>"), ",").alias("unique_ids"))


@query("transition_metrics", f"WITH {EVENTS} SELECT activity, next_activity, {_CASES}, {_TIME} FROM log WHERE activity IS NOT NULL AND next_activity IS NOT NULL GROUP BY ALL")
def _(spark, d):
    return metrics.TransitionMetrics(events(spark, d), digits=DIGITS).apply()


@query("transition_metrics_users", f"WITH {LINES} SELECT activity, next_activity, {_CASES}, count(DISTINCT usr) AS unique_users_num, {_TIME_LONG} FROM log WHERE activity IS NOT NULL AND next_activity IS NOT NULL GROUP BY ALL")
def _(spark, d):
    return _long(metrics.TransitionMetrics(lines(spark, d), digits=DIGITS).apply())


_CASE_SQL = f"string_agg(activity, '>' ORDER BY activity_num) AS trace, count(activity) AS trace_length, count(DISTINCT activity) AS unique_activities_num, round((1 - count(DISTINCT activity) / count(activity)) * 100, {DIGITS}) AS loop_percent"


@query("case_metrics", f"WITH {EVENTS} SELECT case_id, {_CASE_SQL}, {_TIME} FROM log GROUP BY case_id")
def _(spark, d):
    return metrics.CaseMetrics(events(spark, d), digits=DIGITS).apply().withColumn("trace", F.array_join("trace", ">"))


@query("case_metrics_users", f"WITH {LINES} SELECT case_id, {_CASE_SQL}, count(DISTINCT usr) AS unique_users_num, {_TIME_LONG} FROM log GROUP BY case_id")
def _(spark, d):
    return _long(metrics.CaseMetrics(lines(spark, d), digits=DIGITS).apply()).withColumn("trace", F.array_join("trace", ">"))


@query("user_metrics", f"WITH {LINES} SELECT usr AS user, count(usr) AS count, count(DISTINCT activity) AS unique_activities_num, count(DISTINCT case_id) AS unique_ids_num, round(count(usr) / nullif(coalesce(sum(duration_us), 0) / 3.6e9, 0), 4) AS throughput, round(count(usr) / sum(count(usr)) OVER (), 4) AS workload, {_TIME_LONG} FROM log WHERE usr IS NOT NULL GROUP BY usr")
def _(spark, d):
    return _long(metrics.UserMetrics(lines(spark, d), digits=DIGITS).apply())


_VARIANT = "c AS (SELECT case_id, string_agg(activity, '>' ORDER BY activity_num) AS trace, count(activity) AS trace_length, count(DISTINCT activity) AS kinds, coalesce(sum(duration_us), 0) AS duration_us FROM log GROUP BY case_id)"
_VARIANT_SQL = f"trace, count(*) AS count, max(trace_length) AS trace_length, max(kinds) AS unique_activities_num, round((1 - max(kinds) / max(trace_length)) * 100, {DIGITS}) AS loop_percent, {_TIME_LONG}"


@query("variant_metrics", f"WITH {LINES}, {_VARIANT}, u AS (SELECT trace, count(DISTINCT usr) AS unique_users_num FROM log JOIN c USING (case_id) GROUP BY trace), v AS (SELECT {_VARIANT_SQL} FROM c GROUP BY trace) SELECT v.*, unique_users_num FROM v JOIN u USING (trace)")
def _(spark, d):
    out = _long(metrics.VariantMetrics(lines(spark, d), digits=DIGITS).apply())
    return out.withColumn("trace", F.array_join("trace", ">"))


@query("variant_cases", f"WITH {TALKS}, {_VARIANT} SELECT trace, count(*) AS count, string_agg(case_id, ',' ORDER BY case_id) AS ids FROM c GROUP BY trace")
def _(spark, d):
    out = metrics.VariantMetrics(talks(spark, d)).calc("count", "ids")
    return out.select(F.array_join("trace", ">").alias("trace"), "count", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


_HIT = "hit AS (SELECT *, max(CASE WHEN activity IN ({}) THEN 1 ELSE 0 END) OVER (PARTITION BY case_id) AS h FROM {})"


@query("activity_success_rate", f"WITH {LINES}, {_HIT.format("'R'", 'log')} SELECT activity, round(count(DISTINCT CASE WHEN h = 1 THEN case_id END) / count(DISTINCT case_id), 4) AS success_rate FROM hit GROUP BY activity")
def _(spark, d):
    return metrics.ActivityMetrics(lines(spark, d), digits=4).success_rate(["R"])


@query("transition_failure_rate", f"WITH {LINES}, steps AS (SELECT * FROM log WHERE next_activity IS NOT NULL), {_HIT.format("'A'", 'steps')} SELECT activity, next_activity, round(count(DISTINCT CASE WHEN h = 1 THEN case_id END) / count(DISTINCT case_id), 4) AS failure_rate FROM hit GROUP BY ALL")
def _(spark, d):
    return metrics.TransitionMetrics(lines(spark, d), digits=4).failure_rate(["A"])


@query("user_inclusion_rate", f"WITH {LINES}, {_HIT.format("'N'", 'log')} SELECT usr AS user, round(count(DISTINCT CASE WHEN h = 1 THEN case_id END) / count(DISTINCT case_id), 4) AS inclusion_rate FROM hit GROUP BY usr")
def _(spark, d):
    return metrics.UserMetrics(lines(spark, d), digits=4).inclusion_rate(["N"])


@query("variant_inclusion_rate", f"WITH {TALKS}, {_VARIANT} SELECT trace, CASE WHEN list_contains(string_split(trace, '>'), 'system') THEN 1.0 ELSE 0.0 END::DOUBLE AS inclusion_rate FROM c GROUP BY trace")
def _(spark, d):
    return metrics.VariantMetrics(talks(spark, d)).inclusion_rate(["system"]).withColumn("trace", F.array_join("trace", ">"))


@query("virtual_metrics", f"WITH {LINES}, c AS (SELECT case_id, count(activity) AS n, count(DISTINCT activity) AS k, count(next_activity) AS s, count(DISTINCT activity || '>' || next_activity) AS sk, string_agg(activity, '>' ORDER BY activity_num) AS t FROM log GROUP BY 1) SELECT count(*) AS case_count, sum(n)::BIGINT AS activity_count, sum(s)::BIGINT AS transition_count, count(DISTINCT t) AS variant_count, sum(n - k)::BIGINT AS rework_count, round(sum(n - k) / sum(n) * 100, 4) AS activity_cycle_percent, round(sum(s) / sum(n) * 100, 4) AS transition_percent, round(sum(s - sk) / sum(s) * 100, 4) AS transition_cycle_percent FROM c")
def _(spark, d):
    out = metrics.virtual_metrics(lines(spark, d))
    return out.withColumns({c: F.round(c, 4) for c in out.columns if c.endswith("percent")})


# Derived fields.


@query(
    "enriched_log",
    f"""WITH {EVENTS}, x AS (SELECT e.event_id, l.* FROM events e JOIN log l ON e.user_id = l.case_id AND e.ts = l.ts),
    v AS (SELECT case_id, count(*) AS activity_cnt, count(DISTINCT activity) AS activity_cnt_unique, count(next_activity) AS transition_cnt,
          count(DISTINCT CASE WHEN next_activity IS NOT NULL THEN activity || '>' || next_activity END) AS transition_cnt_unique,
          date_diff('microsecond', min(ts), max(ts)) AS case_duration_us, md5(string_agg(activity, '>' ORDER BY activity_num)) AS variant FROM log GROUP BY case_id)
    SELECT x.event_id, activity_num, next_activity, duration_us, activity_num = 1 AS is_first, next_activity IS NULL AS is_last,
           row_number() OVER (PARTITION BY x.case_id, activity ORDER BY activity_num) - 1 AS rework_num, v.* EXCLUDE (case_id)
    FROM x JOIN v USING (case_id)""",
)
def _(spark, d):
    out = events(spark, d).enriched().withColumn("variant", F.md5("variant"))
    return out.select("event_id", "activity_num", "next_activity", "duration_us", "is_first", "is_last", "rework_num", "activity_cnt", "activity_cnt_unique", "transition_cnt", "transition_cnt_unique", "case_duration_us", "variant")


@query("rework_flags", f"WITH {LINES}, r AS (SELECT activity, row_number() OVER (PARTITION BY case_id, activity ORDER BY activity_num) > 1 AS is_rework FROM log) SELECT activity, count(*) AS n, count(*) FILTER (is_rework) AS rework FROM r GROUP BY activity")
def _(spark, d):
    return lines(spark, d).enriched().groupBy(F.col("l_returnflag").alias("activity")).agg(F.count("*").alias("n"), F.count_if("is_rework").alias("rework"))


@query("sentinel_events", f"WITH {ORDERS} SELECT case_id, activity, coalesce(duration_us, 0) AS duration_us, activity_num AS pos FROM log UNION ALL SELECT case_id, 'start', 0, 0 FROM log GROUP BY case_id UNION ALL SELECT case_id, 'end', 0, max(activity_num) + 1 FROM log GROUP BY case_id")
def _(spark, d):
    return with_sentinels(orders(spark, d))


# Outliers.


def _numbered(spark, d) -> DataFrame:
    """lineitem with the number of each line in its order, and the customer-free sections it has."""
    log = lines(spark, d)
    return log.by_case.select("l_orderkey", "l_returnflag", "l_linestatus", "l_extendedprice", F.row_number().over(log.within_case()).alias("num"))


_NUM = "x AS (SELECT l_orderkey, l_returnflag, l_linestatus, l_extendedprice, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice)::INT AS num FROM lineitem)"
_AT = "list_sort(list({v}))[least(floor({p} * count({v})), count({v}) - 1)::BIGINT + 1]"


def _exact(p: float, v: str = "l_extendedprice") -> str:
    return _AT.format(v=v, p=p)


@query("outliers_quantile_activity", f"WITH {_NUM}, b AS (SELECT l_returnflag, l_linestatus, {_exact(0.05)} AS lo, {_exact(0.95)} AS hi, count(*) AS n FROM x GROUP BY 1, 2) SELECT DISTINCT l_orderkey AS case_id, num AS activity_num FROM x JOIN b USING (l_returnflag, l_linestatus) WHERE CASE WHEN l_extendedprice BETWEEN lo AND hi OR n < 30 THEN 0 ELSE 1 END = 1")
def _(spark, d):
    return outliers.detect("default", _numbered(spark, d), "l_orderkey", "num", "l_returnflag", "l_extendedprice", ["l_linestatus"])


@query("outliers_quantile_manual_cases", f"WITH {_NUM}, b AS (SELECT l_returnflag, {_exact(0.2)} AS lo, {_exact(0.8)} AS hi, count(*) AS n FROM x GROUP BY 1) SELECT DISTINCT l_orderkey AS case_id, 0 AS activity_num FROM x JOIN b USING (l_returnflag) WHERE CASE WHEN l_extendedprice BETWEEN lo AND hi OR n < 40 THEN 0 ELSE 1 END = 1")
def _(spark, d):
    return outliers.quantile_activity(_numbered(spark, d), "l_orderkey", "num", "l_returnflag", "l_extendedprice", detector=outliers.Detector(0.2, 0.8, 40), whole_process=True)


@query("outliers_iqr_activity", f"WITH {_NUM}, b AS (SELECT l_returnflag, {_exact(0.25)} AS q1, {_exact(0.75)} AS q3, count(*) AS n FROM x GROUP BY 1) SELECT DISTINCT l_orderkey AS case_id, num AS activity_num FROM x JOIN b USING (l_returnflag) WHERE CASE WHEN l_extendedprice BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5 OR n < 30 THEN 0 ELSE 1 END = 1")
def _(spark, d):
    return outliers.detect("iqr", _numbered(spark, d), "l_orderkey", "num", "l_returnflag", "l_extendedprice")


_CASE_ROWS = "x AS (SELECT DISTINCT o_custkey, o_totalprice, o_orderpriority FROM orders)"


@query("outliers_quantile_case", f"WITH {_CASE_ROWS}, b AS (SELECT o_orderpriority, {_exact(0.05, 'o_totalprice')} AS lo, {_exact(0.95, 'o_totalprice')} AS hi, count(DISTINCT o_custkey) AS n FROM x GROUP BY 1) SELECT DISTINCT o_custkey AS case_id, 0 AS activity_num FROM x JOIN b USING (o_orderpriority) WHERE NOT (o_totalprice BETWEEN lo AND hi OR n < 30)")
def _(spark, d):
    return outliers.quantile_case(table(spark, d, "orders"), "o_custkey", "o_totalprice", ["o_orderpriority"])


@query("outliers_iqr_case", f"WITH {_CASE_ROWS}, b AS (SELECT o_orderpriority, {_exact(0.25, 'o_totalprice')} AS q1, {_exact(0.75, 'o_totalprice')} AS q3, count(DISTINCT o_custkey) AS n FROM x GROUP BY 1) SELECT DISTINCT o_custkey AS case_id, 0 AS activity_num FROM x JOIN b USING (o_orderpriority) WHERE NOT (o_totalprice BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5 OR n < 30)")
def _(spark, d):
    return outliers.iqr_case(table(spark, d, "orders"), "o_custkey", "o_totalprice", ["o_orderpriority"])


@query("outliers_batch", f"WITH {_NUM}, b AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.05) AS lo, quantile_cont(l_extendedprice, 0.95) AS hi, count(DISTINCT l_orderkey) AS n FROM x GROUP BY 1) SELECT DISTINCT l_orderkey AS case_id, num AS activity_num FROM x JOIN b USING (l_returnflag) WHERE NOT (l_extendedprice BETWEEN lo AND hi OR n < 15)")
def _(spark, d):
    return outliers.quantile_interpolated(_numbered(spark, d), "l_orderkey", "num", "l_returnflag", "l_extendedprice", detector=outliers.Detector(0.05, 0.95, 15))


_CENTS = "x AS (SELECT event_id, user_id, event_type, round(value * 100)::BIGINT AS cents FROM events)"
_NOISE = "n1 AS (SELECT *, count(*) OVER (PARTITION BY event_type ORDER BY cents RANGE BETWEEN 10 PRECEDING AND 10 FOLLOWING) >= 9 AS core FROM x), n2 AS (SELECT *, count(*) FILTER (core) OVER (PARTITION BY event_type ORDER BY cents RANGE BETWEEN 10 PRECEDING AND 10 FOLLOWING) AS cores FROM n1)"


def _cents(spark, d) -> DataFrame:
    return table(spark, d, "events").select("event_id", "user_id", "event_type", F.round(F.col("value") * 100).cast("long").alias("cents"))


@query("outliers_density", f"WITH {_CENTS}, {_NOISE} SELECT event_id, event_type, cents FROM n2 WHERE cores = 0")
def _(spark, d):
    return outliers.density_noise(_cents(spark, d), "cents", 10, 9, ["event_type"]).select("event_id", "event_type", "cents")


@query(
    "outliers_ensemble",
    f"""WITH x AS (SELECT DISTINCT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)::INT AS num, round(value * 100)::BIGINT AS cents, 1 AS event_type FROM events), {_NOISE},
    e AS (SELECT {_exact(0.3, 'abs(cents)')} AS edge FROM x)
    SELECT DISTINCT user_id AS case_id, num AS activity_num FROM n2, e WHERE cores = 0 OR abs(cents) < edge""",
)
def _(spark, d):
    log = events(spark, d)
    rows = log.df.select("user_id", F.row_number().over(log.within_case()).cast("int").alias("num"), F.round(F.col("value") * 100).cast("long").alias("cents"))
    return outliers.ensemble(rows, "user_id", "num", "cents", 10)


@query("outliers_by_request", f"WITH {_NUM}, b AS (SELECT l_returnflag, l_linestatus, {_exact(0.1)} AS lo, {_exact(0.9)} AS hi, count(*) AS n FROM x GROUP BY 1, 2) SELECT DISTINCT l_orderkey AS case_id, num AS activity_num, 7 AS outlier_num FROM x JOIN b USING (l_returnflag, l_linestatus) WHERE CASE WHEN l_extendedprice BETWEEN lo AND hi OR n < 20 THEN 0 ELSE 1 END = 1")
def _(spark, d):
    request = """{"detector": "manual", "params": {"lower": 0.1, "upper": 0.9, "min_rows": 20}, "case": "l_orderkey", "number": "num", "activity": "l_returnflag", "metric": "l_extendedprice", "sections": ["l_linestatus"], "outlier_num": 7}"""
    found, answer = outliers.by_request(_numbered(spark, d), request)
    return found.withColumn("outlier_num", F.lit(answer["outlier_num"]))


# Insights.


@query("mean_median_ratio", f"WITH {EVENTS} SELECT activity, round(coalesce(avg(duration_us) / nullif(median(duration_us), 0), 1), 4) AS mean_median_ratio FROM log GROUP BY activity")
def _(spark, d):
    return insights.mean_median_ratio(events(spark, d)).withColumn("mean_median_ratio", F.round("mean_median_ratio", 4))


_BISECT = "s AS (SELECT min(ts) AS a, date_diff('microsecond', min(ts), max(ts)) AS us FROM log), r AS (SELECT activity, round(coalesce(avg(duration_us) FILTER (date_diff('microsecond', a, ts) * 2 > us) / nullif(avg(duration_us) FILTER (date_diff('microsecond', a, ts) * 2 <= us), 0), 1), 4) AS bisect_ratio FROM log, s GROUP BY activity)"


@query("bisect_ratio", f"WITH {EVENTS}, {_BISECT} SELECT * FROM r")
def _(spark, d):
    return insights.bisect_ratio(events(spark, d)).withColumn("bisect_ratio", F.round("bisect_ratio", 4))


_KINDS = ("click", "error", "purchase", "signup", "view")


@query("pivot_appearance", f"SELECT user_id AS case_id, {', '.join(f"count(*) FILTER (event_type = '{k}') AS {k}" for k in _KINDS)} FROM events GROUP BY 1")
def _(spark, d):
    return insights.pivot(events(spark, d), "appearance")


@query("pivot_recycles", f"SELECT user_id AS case_id, {', '.join(f"greatest(count(*) FILTER (event_type = '{k}') - 1, 0) AS {k}" for k in _KINDS)} FROM events GROUP BY 1")
def _(spark, d):
    return insights.pivot(events(spark, d), "recycles")


@query("pivot_time", f"WITH {EVENTS} SELECT case_id, {', '.join(f"round(ln(1 + coalesce(sum(coalesce(duration_us, 0) / 1e6) FILTER (activity = '{k}'), 0)), 4) AS {k}" for k in _KINDS)} FROM log GROUP BY 1")
def _(spark, d):
    out = insights.pivot(events(spark, d), "time")
    return out.select("case_id", *(F.round(c, 4).alias(c) for c in out.columns[1:]))


@query("pivot_user_metric", f"SELECT user_id AS case_id, {', '.join(f"round(coalesce(sum(value) FILTER (event_type = '{k}'), 0), 3) AS {k}" for k in _KINDS)} FROM events GROUP BY 1")
def _(spark, d):
    out = insights.pivot(events(spark, d), "user", metric="value")
    return out.select("case_id", *(F.round(c, 3).alias(c) for c in out.columns[1:]))


@query("duration_warnings", f"WITH {EVENTS} SELECT activity, CASE WHEN count(duration_us) = 0 THEN 'missing' WHEN max(abs(duration_us)) = 0 THEN 'zero' WHEN count(duration_us) < 2 THEN 'insufficient' ELSE 'ok' END AS warning FROM log GROUP BY activity")
def _(spark, d):
    return insights.duration_warnings(events(spark, d))


_INSIGHT = f"{_BISECT}, i AS (SELECT activity, avg(duration_us) / 1e6 AS mean_time, count(*) / count(DISTINCT case_id) AS frequency, (1 - count(DISTINCT case_id) / count(*)) * 100 AS cycles, (count(*) - count(DISTINCT case_id)) / count(*) AS duplicates_rate, count(*) AS activities_num, coalesce(avg(duration_us) / nullif(median(duration_us), 0), 1) AS mean_median FROM log GROUP BY activity), qs AS (SELECT activity, quantile_cont(duration_us, 0.25) AS q1, quantile_cont(duration_us, 0.75) AS q3 FROM log GROUP BY activity), al AS (SELECT activity, coalesce(avg(CASE WHEN duration_us > q3 + (q3 - q1) * 1.5 THEN 1.0 ELSE 0.0 END) FILTER (duration_us IS NOT NULL), 0)::DOUBLE AS anomaly_level FROM log JOIN qs USING (activity) GROUP BY activity)"


@query("insight_table", f"WITH {EVENTS}, {_INSIGHT} SELECT activity, round(mean_time, 3) AS mean_time, round(frequency, 4) AS frequency, round(cycles, 4) AS cycles, round(duplicates_rate, 4) AS duplicates_rate, activities_num, round(mean_median, 4) AS mean_median, round(anomaly_level, 6) AS anomaly_level, bisect_ratio AS diff_time FROM i JOIN r USING (activity) JOIN al USING (activity)")
def _(spark, d):
    digits = {"mean_time": 3, "anomaly_level": 6, "frequency": 4, "cycles": 4, "duplicates_rate": 4, "mean_median": 4, "diff_time": 4}
    return insights.insight_table(events(spark, d)).withColumns({c: F.round(c, n) for c, n in digits.items()})


@query("insight_flags", f"WITH {EVENTS}, {_INSIGHT}, q AS (SELECT quantile_cont(mean_time, 0.75) AS lim FROM i) SELECT activity, 'mean_time' AS metric, round(mean_time, 3) AS value, 'long stage' AS label FROM i, q WHERE mean_time > lim UNION ALL SELECT activity, 'cycles', round(cycles, 3), 'loops' FROM i WHERE cycles > 20 UNION ALL SELECT activity, 'mean_median', round(mean_median, 3), 'irregular duration' FROM i WHERE mean_median > 1.5 UNION ALL SELECT activity, 'diff_time', round(bisect_ratio, 3), 'growing duration' FROM r WHERE bisect_ratio > 1.1")
def _(spark, d):
    return insights.insight_flags(events(spark, d)).withColumn("value", F.round("value", 3))


@query("feature_influence")
def _(spark, d):
    return selection.feature_influence(insights.pivot(events(spark, d), "appearance"), "case_id")


def _held_out_picks(wide: str, key: str, columns: list[str]) -> str:
    """For each column the other one with the best held-out r2 over five folds of the key, and how often each is picked."""
    names, values = ", ".join(f"'{c}'" for c in columns), ", ".join(columns)
    return f"""WITH {wide}, u AS (SELECT {key} AS k, unnest([{names}]) AS c, unnest([{values}])::DOUBLE AS v FROM pv),
    pr AS (SELECT a.k, a.c AS target, a.v AS y, b.c AS c, b.v AS x FROM u a JOIN u b ON a.k = b.k AND a.c <> b.c),
    fits AS (SELECT target, c, f, regr_slope(y, x) AS w, regr_intercept(y, x) AS b FROM pr, (SELECT unnest([0, 1, 2, 3, 4]) AS f) WHERE k % 5 <> f GROUP BY ALL),
    sc AS (SELECT target, c, f, 1 - sum((y - b - w * x) ** 2) / (var_pop(y) * count(*)) AS r2 FROM pr JOIN fits USING (target, c) WHERE k % 5 = f GROUP BY ALL),
    m AS (SELECT target, c, avg(r2) AS r2 FROM sc GROUP BY ALL), best AS (SELECT target, arg_max(c, r2) AS c FROM m GROUP BY target HAVING max(r2) >= 0.01)
    SELECT activity, count(best.c)::INT AS selected FROM (SELECT unnest([{names}]) AS activity) n LEFT JOIN best ON best.c = activity GROUP BY activity"""


@query("feature_influence_one", _held_out_picks("pv AS (SELECT l_orderkey, sum(l_quantity) AS quantity, sum(l_extendedprice) AS price, count(*) AS parts, sum(l_tax) AS tax, sum(l_discount * l_extendedprice) AS off FROM lineitem GROUP BY 1)", "l_orderkey", ["quantity", "price", "parts", "tax", "off"]))
def _(spark, d):
    wide = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("quantity"), F.sum("l_extendedprice").alias("price"), F.count("*").alias("parts"), F.sum("l_tax").alias("tax"), F.sum(F.col("l_discount") * F.col("l_extendedprice")).alias("off"))
    return selection.feature_influence(wide, "l_orderkey", most=1, fold=F.col("l_orderkey") % 5)


_STATUS = "pv AS (SELECT l_orderkey, count(*) FILTER (l_linestatus = 'F')::DOUBLE AS f, count(*) FILTER (l_linestatus = 'O')::DOUBLE AS o FROM lineitem GROUP BY 1)"


def _status(spark, d) -> DataFrame:
    log = EventLog(table(spark, d, "lineitem"), "l_orderkey", "l_linestatus", "l_shipdate", tiebreak=("l_linenumber",))
    return insights.pivot(log, "appearance")


@query("feature_influence_two", _held_out_picks(_STATUS, "l_orderkey", ["F", "O"]).replace("[F, O]", "[f, o]"))
def _(spark, d):
    return selection.feature_influence(_status(spark, d), "case_id", fold=F.col("case_id") % 5)


@query(
    "problem_scores",
    f"""WITH {_STATUS}, x AS (SELECT f AS xf, o AS xo FROM pv ORDER BY l_orderkey LIMIT 1),
    m AS (SELECT avg(f) AS mf, avg(o) AS mo, regr_slope(f, o) AS fo, regr_slope(o, f) AS of_, regr_r2(f, o) AS r2, sum(f) / sum(f + o) AS wf, sum(o) / sum(f + o) AS wo FROM pv),
    s AS (SELECT *, mf * wf + of_ * (xf - mf) * wo AS sf, fo * (xo - mo) * wf + mo * wo AS so FROM m, x)
    SELECT 'F' AS activity, round(sf / greatest(abs(sf), abs(so)), 5) AS problem_score, round(wf, 6) AS weight, round(r2, 6) AS r2 FROM s
    UNION ALL SELECT 'O', round(so / greatest(abs(sf), abs(so)), 5), round(wo, 6), round(r2, 6) FROM s""",
)
def _(spark, d):
    return insights.problem_scores(_status(spark, d), "case_id").withColumns({"problem_score": F.round("problem_score", 5), "weight": F.round("weight", 6), "r2": F.round("r2", 6)})


_LABELLED = f"""{_INSIGHT}, cs AS (SELECT case_id, date_diff('microsecond', min(ts), max(ts)) AS us FROM log GROUP BY 1), sh AS (SELECT activity, count(*) / (SELECT count(*) FROM cs) AS share, avg(us) / (SELECT avg(us) FROM cs) AS case_ratio FROM (SELECT DISTINCT activity, case_id FROM log) JOIN cs USING (case_id) GROUP BY 1),
t AS (SELECT i.*, bisect_ratio AS diff_time, anomaly_level, share, case_ratio, (SELECT quantile_cont(mean_time, 0.75) FROM i) AS slow FROM i JOIN r USING (activity) JOIN al USING (activity) JOIN sh USING (activity)),
lb AS ({' UNION ALL '.join(f"SELECT activity, '{n}' AS label FROM t WHERE {rule}" for n, rule in insights.STAGE_LABELS.items())})"""


@query("stage_labels", f"WITH {EVENTS}, {_LABELLED} SELECT * FROM lb")
def _(spark, d):
    return insights.stage_labels(events(spark, d))


@query("insights_clustered", f"WITH {EVENTS}, {_LABELLED} SELECT activity, string_agg(label, '; ' ORDER BY label) AS labels FROM lb GROUP BY activity")
def _(spark, d):
    return insights.insight_output(events(spark, d), "clustered")


@query("insights_binary", f"WITH {EVENTS}, {_LABELLED} SELECT activity, {', '.join(f"max((label = '{n}')::INT) AS {chr(34)}{n.replace(' ', '_')}{chr(34)}" for n in insights.STAGE_LABELS)} FROM lb GROUP BY activity")
def _(spark, d):
    return insights.insight_output(events(spark, d), "clustered_binary")


@query("insights_effect", f"WITH {EVENTS}, {_LABELLED}, md AS (SELECT activity, median(duration_us) AS m FROM log GROUP BY 1) SELECT activity, round(sum(greatest(duration_us - m, 0)) / 3.6e9, 4) AS hours, round(sum(greatest(duration_us - m, 0)) / 3.6e9 * 2, 4) AS effect FROM log JOIN md USING (activity) WHERE activity IN (SELECT activity FROM lb) GROUP BY activity")
def _(spark, d):
    return insights.insight_output(events(spark, d), "financial_only_effect", 2.0).withColumns({"hours": F.round("hours", 4), "effect": F.round("effect", 4)})


@query("insights_transitions", f"WITH {EVENTS}, {_LABELLED} SELECT activity, next_activity, count(*) AS n FROM log WHERE next_activity IS NOT NULL AND activity IN (SELECT activity FROM lb) GROUP BY ALL")
def _(spark, d):
    return insights.insight_output(events(spark, d), "transitions")


_WORD = "coalesce(regexp_matches(lower(text), '(^|[^\\p{{L}}\\p{{N}}_])({})([^\\p{{L}}\\p{{N}}_]|$)'), false)"
_TEXTS = f"""tx AS (SELECT conv_id, role, {_WORD.format('error|the')} AS e, {_WORD.format('and')} AS v, max((role = 'system')::INT) OVER (PARTITION BY conv_id) = 1 AS won FROM conversations),
tt AS (SELECT role AS activity, count(*) FILTER (e) AS errors, count(*) FILTER (e AND won) AS errors_won, count(*) FILTER (e AND NOT won) AS errors_lost, count(*) FILTER (v AND won) AS reversals_won, count(*) FILTER (v AND NOT won) AS reversals_lost FROM tx GROUP BY 1)"""


@query("text_labels", f"WITH {_TEXTS} " + " UNION ALL ".join(f"SELECT activity, '{n}' AS label FROM tt WHERE {rule}" for n, rule in insights.TEXT_LABELS.items()))
def _(spark, d):
    return insights.text_labels(talks(spark, d), "system", ["error", "the"], ["and"])


@query("activity_durations", f"WITH {EVENTS} SELECT activity, duration_us FROM log WHERE duration_us IS NOT NULL AND activity IS NOT NULL")
def _(spark, d):
    return insights.durations_by_activity(events(spark, d))


@query("text_flags", "SELECT conv_id, turn, coalesce(regexp_matches(lower(text), '(^|[^\\p{L}\\p{N}_])(error|the)([^\\p{L}\\p{N}_]|$)'), false) AS has_word FROM conversations")
def _(spark, d):
    out = insights.text_flags(talks(spark, d), ["error", "the"])
    return out.select("conv_id", "turn", "has_word")


# Sources and filters.


@query("filtered_cases_semi", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 7)")
def _(spark, d):
    c = table(spark, d, "customer")
    chosen = c.select(F.col("c_custkey").alias("_caseId"), F.lit(1).alias("_workspaceId"), F.col("c_nationkey").alias("_widgetId"), F.col("c_mktsegment").alias("_widgetType"))
    rows = io.select_columns(table(spark, d, "orders"), ["o_orderkey", "o_custkey", "o_totalprice", "o_custkey"])
    return io.filter_cases(rows, "o_custkey", chosen, 1, 7, "BUILDING").select("o_orderkey", "o_custkey", "o_totalprice")


@query("negative_case_anti", "SELECT event_id, user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE value < 0.5)")
def _(spark, d):
    e = table(spark, d, "events").withColumn("_shift", F.col("value") - 0.5)
    return io.without_negative(e, "user_id", "_shift").select("event_id", "user_id")


@query("sampled_rows", "SELECT event_type, true AS near FROM events GROUP BY event_type")
def _(spark, d):
    """Whether a sample of a third of the rows holds each type about that often; below the budget all rows stay."""
    e = table(spark, d, "events").select("event_id", "event_type")
    n = e.count()
    assert io.sample_rows(e, n).count() == n
    share = io.sample_rows(e, n // 3).groupBy("event_type").agg(F.count("*").alias("k"))
    whole = e.groupBy("event_type").agg(F.count("*").alias("n"))
    return whole.join(share, "event_type").select("event_type", F.col("k").between(F.col("n") * 0.2, F.col("n") * 0.47).alias("near"))


@query("jsonl_export", """SELECT '{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}' AS value FROM orders""")
def _(spark, d):
    return io.json_lines(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"))


@query("csv_times", "SELECT o_orderkey, o_orderdate::TIMESTAMP AS placed, o_orderstatus FROM orders")
def _(spark, d):
    path = scratch.scratch_path(spark, "orders-csv")
    o = table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "dd.MM.yyyy HH:mm:ss").alias("placed"), "o_orderstatus")
    io.export_rows(o, path, "csv")
    out = io.read_files(spark, path, "csv", "o_orderkey long, placed string, o_orderstatus string", "dd.MM.yyyy HH:mm:ss", ("placed",))
    return out.withColumn("placed", F.col("placed").cast("timestamp_ntz"))


@query("export_summary", "SELECT 'csv' AS kind, count(*) AS rows, count(*) FILTER (o_orderstatus = 'F') AS nulls FROM orders UNION ALL SELECT 'json', count(*), count(*) FILTER (o_orderstatus = 'F') FROM orders UNION ALL SELECT 'parquet', count(*), count(*) FILTER (o_orderstatus = 'F') FROM orders")
def _(spark, d):
    """Exports with nulls, without one column, split and compressed, and what is read back."""
    o = table(spark, d, "orders").select("o_orderkey", F.expr("nullif(o_orderstatus, 'F')").alias("s"), "o_totalprice")
    out = []
    for kind in ("csv", "json", "parquet"):
        path = scratch.scratch_path(spark, f"export-{kind}")
        told = io.export_rows(o, path, kind, exclude=("o_totalprice",), rows_per_file=1000, null_marker="-" if kind == "csv" else None, gzip=True)
        back = io.read_files(spark, path, kind, "o_orderkey long, s string", **({"nullValue": "-"} if kind == "csv" else {}))
        assert [f["name"] for f in told["schema"]["fields"]] == ["o_orderkey", "s"]
        out.append((kind, told["rows"], back.filter("s is null").count()))
    return spark.createDataFrame(out, "kind string, rows long, nulls long")


@query("stored_outliers", f"WITH {_NUM}, b AS (SELECT l_returnflag, {_exact(0.05)} AS lo, {_exact(0.95)} AS hi, count(*) AS n FROM x GROUP BY 1) SELECT DISTINCT l_orderkey AS case_id, num AS activity_num, 2 AS copies FROM x JOIN b USING (l_returnflag) WHERE CASE WHEN l_extendedprice BETWEEN lo AND hi OR n < 30 THEN 0 ELSE 1 END = 1")
def _(spark, d):
    """Created, appended to, and refused when it is to be created again."""
    name = f"found_{uuid.uuid4().hex}"
    found = outliers.detect("default", _numbered(spark, d), "l_orderkey", "num", "l_returnflag", "l_extendedprice")
    io.save_outliers(spark, found, name, "errorifexists")
    io.save_outliers(spark, found, name)
    try:
        io.save_outliers(spark, found, name, "errorifexists")
        raise AssertionError("an existing table was created again")
    except AnalysisException:
        pass
    out = scratch.written(spark.table(name).groupBy("case_id", "activity_num").agg(F.count("*").cast("int").alias("copies")), "stored")
    spark.sql(f"DROP TABLE {name}")
    return out


@query("sampled_by_key", "SELECT event_id, event_type FROM events WHERE ('0x' || substr(md5('42:' || event_id), 1, 8))::BIGINT * (SELECT count(*) FROM events) < (SELECT count(*) // 3 FROM events) * 4294967296::BIGINT")
def _(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type")
    return io.sample_by_key(e, "event_id", e.count() // 3)


@query("cases_in_partitions", "SELECT user_id, count(*) AS events, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY user_id")
def _(spark, d):
    """Each partition adds up its own cases, so a case that is split would have several rows."""
    rows = io.by_case(table(spark, d, "events").select("user_id", "ts"), "user_id", 7)

    def own(batches):
        seen = None
        for batch in batches:
            one = pa.table({"user_id": batch.column(0), "events": pa.repeat(pa.scalar(1, pa.int64()), batch.num_rows), "first_ts": batch.column(1), "last_ts": batch.column(1)})
            seen = one if seen is None else pa.concat_tables([seen, one])
            seen = seen.group_by("user_id").aggregate([("events", "sum"), ("first_ts", "min"), ("last_ts", "max")])
            seen = seen.rename_columns(["user_id", "events", "first_ts", "last_ts"])
        if seen is not None:
            yield from seen.to_batches()

    kind = rows.schema["ts"].dataType.simpleString()
    return rows.mapInArrow(own, f"user_id long, events long, first_ts {kind}, last_ts {kind}")


@query("case_partitions", "SELECT user_id, 1 AS partitions FROM events GROUP BY user_id")
def _(spark, d):
    rows = io.by_case(table(spark, d, "events"), "user_id", 7).withColumn("p", F.spark_partition_id())
    return rows.groupBy("user_id").agg(F.count_distinct("p").cast("int").alias("partitions"))


@query("fetched_chunks", "SELECT (row_number() OVER (ORDER BY n_nationkey) - 1) // 7 AS chunk, n_nationkey FROM nation")
def _(spark, d):
    rows = table(spark, d, "nation").select("n_nationkey").orderBy("n_nationkey")  # one row per nation
    return spark.createDataFrame([(i, r.n_nationkey) for i, part in enumerate(io.chunks(rows, 7)) for r in part], "chunk long, n_nationkey int")


@query("statements", "SELECT 'a;b' AS text, count(*) AS n FROM orders WHERE o_totalprice > 1000")
def _(spark, d):
    table(spark, d, "orders").createOrReplaceTempView("statement_orders")
    return io.run_sql(spark, "select 1; -- a comment; here\n select 'a;b' as text, count(*) as n from statement_orders where o_totalprice > :least;", {"least": 1000}, split=True)


@query("virtual_fields", "SELECT o_orderkey, CASE WHEN o_totalprice > 100000 THEN 'yes' ELSE 'no' END AS large FROM orders")
def _(spark, d):
    log = orders(spark, d).with_fields(large="case when o_totalprice > 100000 then 'yes' else 'no' end")
    return log.df.select("o_orderkey", "large")


@query("partition_checks", "SELECT 'path' AS what, true AS there UNION ALL SELECT 'missing path', false UNION ALL SELECT 'partition', true UNION ALL SELECT 'missing partition', false UNION ALL SELECT 'missing table', false UNION ALL SELECT 'some rows', true UNION ALL SELECT 'no rows', false UNION ALL SELECT 'states', true")
def _(spark, d):
    name = f"parts_{uuid.uuid4().hex}"
    o = table(spark, d, "orders")
    io.to_table(spark, o.select("o_orderkey", "o_orderstatus"), name, ("o_orderstatus",))
    out = [
        ("path", io.exists(spark, f"{d}/orders.*")), ("missing path", io.exists(spark, f"{d}/nothing*")),
        ("partition", io.has_partition(spark, name, {"o_orderstatus": "F"})), ("missing partition", io.has_partition(spark, name, {"o_orderstatus": "Z"})),
        ("missing table", io.has_partition(spark, f"{name}_", {"o_orderstatus": "F"})),
        ("some rows", quality.sql_sensor(o.select(F.lit(1)))), ("no rows", quality.sql_sensor(o.limit(0))),
        ("states", quality.states_complete(spark.createDataFrame([("done", "2024-01-01"), ("done", "2024-01-02"), ("failed", "2024-01-02")], "s string, t string"), "s", ["done"], "t", ["2024-01-01", "2024-01-02"])),
    ]
    spark.sql(f"DROP TABLE {name}")
    return spark.createDataFrame(out, "what string, there boolean")


@query("saved_stats", "SELECT '2024-01-01' AS ds, 'supplier' AS table_name, count(*)::DOUBLE AS value FROM supplier UNION ALL SELECT '2024-01-02', 'supplier', count(*)::DOUBLE FROM supplier")
def _(spark, d):
    """Two days, the first one saved twice."""
    path = scratch.scratch_path(spark, "stats")
    stats = quality.table_stats(table(spark, d, "supplier"))
    for ds in ("2024-01-01", "2024-01-02", "2024-01-01"):
        quality.save_stats(stats, path, ds, "supplier", "all")
    saved = spark.read.parquet(path).filter("col = '' and metric = 'count'")
    return saved.select(F.col("ds").cast("string").alias("ds"), "table_name", "value")


@query("column_stats_by_callable", "SELECT 's_acctbal' AS col, 'spread' AS metric, round(max(s_acctbal) - min(s_acctbal), 4) AS value FROM supplier UNION ALL SELECT '', 'count', count(*) FROM supplier")
def _(spark, d):
    own = lambda c, kind: {"spread": F.max(c) - F.min(c)}
    return quality.table_stats(table(spark, d, "supplier").select("s_acctbal"), per_column=own).withColumn("value", F.round("value", 4))


@query("row_and_value_checks", "SELECT 'row' AS what, true AS ok UNION ALL SELECT 'zero', false UNION ALL SELECT 'value', true UNION ALL SELECT 'far value', false")
def _(spark, d):
    o = table(spark, d, "orders")
    n = o.count()
    out = [("row", quality.row_check(o.agg(F.count("*"), F.max("o_orderkey")))), ("zero", quality.row_check(o.agg(F.count("*"), F.count_if(F.col("o_orderkey") < 0)))), ("value", quality.value_check(n, n * 1.04, 0.05)), ("far value", quality.value_check(n, n * 2.0, 0.05))]
    return spark.createDataFrame(out, "what string, ok boolean")


@query("text_functions", "SELECT o_orderkey, o_orderstatus AS bare, o_orderstatus || 'x' AS none, o_orderpriority AS ended, len(string_split(o_orderstatus || '--' || o_orderpriority || '--z', '--'))::INT AS blocks, strftime(o_orderdate, '%d/%m/%Y') AS day FROM orders")
def _(spark, d):
    o = table(spark, d, "orders")
    s, p, quote = F.col("o_orderstatus"), F.col("o_orderpriority"), F.lit('"')
    pairs = scalar.summary_pairs(F.concat_ws("\n \n", s, p, F.lit("z")))
    return o.select("o_orderkey", scalar.unquote(F.concat(quote, s, quote)).alias("bare"), scalar.without_quotes(F.concat(quote, s, quote, F.lit("x"))).alias("none"), scalar.without_returns(F.concat(p, F.lit("\r\r"))).alias("ended"), F.size(pairs).alias("blocks"), scalar.reformat_date(F.date_format("o_orderdate", "yyyy-MM-dd"), "yyyy-MM-dd", "dd/MM/yyyy").alias("day"))


@query("trace_counts", f"WITH {EVENTS} SELECT case_id, count(*) FILTER (activity = 'click')::INT AS clicks, round((1 - count(DISTINCT activity) / count(*)) * 100, 4) AS loops FROM log GROUP BY case_id")
def _(spark, d):
    traces = metrics.CaseMetrics(events(spark, d)).calc("trace")
    kinds = F.size(F.array_distinct("trace"))
    return traces.select("case_id", scalar.occurrences(F.col("trace"), "click").alias("clicks"), F.round(scalar.loop_percent(kinds, F.size("trace")), 4).alias("loops"))


@query("json_fields", "SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events")
def _(spark, d):
    return table(spark, d, "events").select("event_id", scalar.json_fields(F.col("props"), "k int")["k"].alias("k"))


@query("epoch_features", "SELECT o_orderkey, epoch(o_orderdate)::DOUBLE AS placed FROM orders")
def _(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", factors.numeric(o, "o_orderdate").alias("placed"))


@query("typed_transfer", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_totalprice AS BIGINT) AS o_totalprice FROM orders WHERE o_totalprice - floor(o_totalprice) < 0.4 UNION ALL SELECT '-1', 7")
def _(spark, d):
    """Rows moved into a table with types of its own, and one appended."""
    name = f"typed_{uuid.uuid4().hex}"
    o = table(spark, d, "orders").filter("o_totalprice - floor(o_totalprice) < 0.4")
    io.transfer(o, lambda df: io.to_table(spark, df, name, recreate=True), columns={"o_orderkey": "string", "o_totalprice": "bigint"})
    io.insert_rows(spark, [("-1", 7)], name, "o_orderkey string, o_totalprice bigint")
    out = scratch.written(spark.table(name), "typed")
    spark.sql(f"DROP TABLE {name}")
    return out


@query("source_checks", "SELECT 'header' AS what, true AS ok UNION ALL SELECT 'other header', false UNION ALL SELECT 'source', true UNION ALL SELECT 'missing source', false")
def _(spark, d):
    path = scratch.scratch_path(spark, "header-csv")
    io.export_rows(table(spark, d, "region").select("r_regionkey", "r_name"), path, "csv")

    def fits(columns):
        try:
            io.check_header(spark, path, columns)
        except ValueError:
            return False
        return True

    out = [("header", fits(["R_REGIONKEY", "r_name"])), ("other header", fits(["r_name"])), ("source", io.connected(spark)[0]), ("missing source", io.connected(spark, lambda: spark.read.parquet(f"{d}/nothing.parquet"))[0])]
    return spark.createDataFrame(out, "what string, ok boolean")


@query("distinct_unions", "SELECT o_custkey AS case_id, array_to_string(list_sort(list_distinct(list(DISTINCT o_orderstatus) || ['X'])), ',') AS kinds FROM orders GROUP BY 1")
def _(spark, d):
    kinds = metrics.CaseMetrics(orders(spark, d)).calc("unique_activities")
    return kinds.select("case_id", F.array_join(F.sort_array(F.array_union("unique_activities", F.array(F.lit("X")))), ",").alias("kinds"))


@query("bulk_round_trip", "SELECT r_regionkey, r_name FROM region")
def _(spark, d):
    path = scratch.scratch_path(spark, "region-tab")
    r = table(spark, d, "region").select("r_regionkey", "r_name")
    io.transfer(r, lambda df: df.write.option("sep", "\t").csv(path))
    return io.read_files(spark, path, "csv", r.schema.simpleString()[7:-1].replace(":", " "), sep="\t", header="false")


@query("scalar_functions", "SELECT o_orderkey, replace(round(o_totalprice / 7, 2)::VARCHAR, '.', ',') AS comma, strftime(o_orderdate::DATE + INTERVAL 3 DAY, '%Y-%m-%d') AS later, regexp_replace(o_orderpriority, '[-0-9]', '', 'g') AS letters, o_orderstatus || '-' || o_orderpriority AS edge, date_trunc('day', o_orderdate + INTERVAL 12 HOUR)::DATE AS nearest FROM orders")
def _(spark, d):
    o = table(spark, d, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return o.select("o_orderkey", scalar.decimal_comma(F.col("o_totalprice") / 7, 2).alias("comma"), scalar.add_days(day, 3).alias("later"), scalar.letters_only(F.col("o_orderpriority")).alias("letters"), scalar.edge_label(F.col("o_orderstatus"), F.col("o_orderpriority")).alias("edge"), scalar.nearest_day(F.col("o_orderdate")).cast("date").alias("nearest"))


# Series.

_DENSE = """span AS (SELECT min(p) AS a, max(p) AS b FROM rows), days AS (SELECT unnest(generate_series(a, b, INTERVAL 1 DAY))::DATE AS p FROM span),
c AS (SELECT p, {keys}, count(*) AS n, avg(duration_us) / 1e6 AS m FROM rows GROUP BY ALL), spine AS (SELECT p, k.* FROM days, (SELECT DISTINCT {keys} FROM rows) k),
dense AS (SELECT p, {keys}, coalesce(n, 0) AS n, coalesce(n / nullif(sum(n) OVER (PARTITION BY p), 0), 0) AS probability, coalesce(m, 0) AS m FROM spine LEFT JOIN c USING (p, {keys}))"""
_NODES = f"{EVENTS}, rows AS (SELECT date_trunc('day', ts + INTERVAL 12 HOUR)::DATE AS p, * FROM log), {_DENSE.format(keys='activity')}"
_EDGES = f"{EVENTS}, rows AS (SELECT date_trunc('day', ts + INTERVAL 12 HOUR)::DATE AS p, * FROM log WHERE next_activity IS NOT NULL), {_DENSE.format(keys='activity, next_activity')}"


def _series(df: DataFrame) -> DataFrame:
    return df.withColumn("probability", F.round("probability", 6)).withColumn("mean_duration_s", F.round("mean_duration_s", 3))


@query("node_series", f"WITH {_NODES} SELECT p AS period, activity, n, round(probability, 6) AS probability, round(m, 3) AS mean_duration_s FROM dense")
def _(spark, d):
    return _series(series.node_series(events(spark, d)))


@query("edge_series", f"WITH {_EDGES} SELECT p AS period, activity, next_activity, n, round(probability, 6) AS probability, round(m, 3) AS mean_duration_s FROM dense")
def _(spark, d):
    return _series(series.edge_series(events(spark, d)))


_LAGS = ", ".join(f"lag(y, {i}) OVER w AS lag_{i}" for i in range(1, 8))
_DIFFS = ", ".join(f"round(lag_1 - lag_{i}, 6) AS diff_{i}" for i in range(2, 8))


@query("lag_features", f"WITH {_NODES}, l AS (SELECT activity, p AS period, probability AS y, row_number() OVER w AS nth, {_LAGS} FROM (SELECT activity, p, probability, probability AS y FROM dense) WINDOW w AS (PARTITION BY activity ORDER BY p)) SELECT activity, period, round(y, 6) AS y, {', '.join(f'round(lag_{i}, 6) AS lag_{i}' for i in range(1, 8))}, {_DIFFS}, month(period)::INT AS month, (nth - 7)::INT AS linear FROM l WHERE nth > 7")
def _(spark, d):
    out = series.lag_features(series.node_series(events(spark, d)), ["activity"])
    return out.select(*(F.round(c, 6).alias(c) if c == "y" or c.startswith(("lag_", "diff_")) else c for c in out.columns))


@query("chrono_split", f"WITH {_NODES}, s AS (SELECT activity, p AS period, count(*) OVER (PARTITION BY activity) AS c, row_number() OVER (PARTITION BY activity ORDER BY p) AS r FROM dense) SELECT activity, period, CASE WHEN r > c - greatest(floor(c * 0.1), 1) THEN 'test' WHEN r > c - 2 * greatest(floor(c * 0.1), 1) THEN 'validation' ELSE 'train' END AS part FROM s")
def _(spark, d):
    return series.chrono_split(series.node_series(events(spark, d)).select("activity", "period"), ["activity"])


_PERIOD = """rows AS (SELECT date_trunc('{unit}', ts)::DATE AS p, * FROM log{where}), span AS (SELECT min(p) AS a, max(p) AS b FROM rows), days AS (SELECT unnest(generate_series(a, b, INTERVAL 1 {unit}))::DATE AS p FROM span),
c AS (SELECT p, activity, count(*) AS n, avg(duration_us) / 1e6 AS m FROM rows GROUP BY ALL), spine AS (SELECT p, k.* FROM days, (SELECT DISTINCT activity FROM rows) k),
dense AS (SELECT p, activity, coalesce(n, 0) AS n, coalesce(n / nullif(sum(n) OVER (PARTITION BY p), 0), 0) AS probability, coalesce(m, 0) AS m FROM spine LEFT JOIN c USING (p, activity))"""
_WHOLE = ", ed AS (SELECT min(ts) AS a, max(ts) AS b FROM log), lg AS (SELECT log.* FROM log, ed WHERE (day(a) = 1 OR date_trunc('month', ts) > date_trunc('month', a)) AND (day(b) >= day(last_day(a)) OR date_trunc('month', ts) < date_trunc('month', b)))"
_MONTHS = ORDERS + _WHOLE + ", " + _PERIOD.format(unit="month", where="").replace("* FROM log", "* FROM lg")


@query("node_series_month", f"WITH {_MONTHS} SELECT p AS period, activity, n, round(probability, 6) AS probability, round(m, 0) AS mean_duration_s FROM dense")
def _(spark, d):
    return _series(series.node_series(orders(spark, d), "M")).withColumn("mean_duration_s", F.round("mean_duration_s", 0))


@query("node_series_year", f"WITH {ORDERS}, {_PERIOD.format(unit='year', where='')} SELECT p AS period, activity, n, round(probability, 6) AS probability, round(m, 0) AS mean_duration_s FROM dense")
def _(spark, d):
    return _series(series.node_series(orders(spark, d), "Y")).withColumn("mean_duration_s", F.round("mean_duration_s", 0))


@query("trim_months", f"WITH {ORDERS}{_WHOLE} SELECT date_trunc('month', ts)::DATE AS month, count(*) AS n FROM lg GROUP BY 1")
def _(spark, d):
    return series.trim_months(orders(spark, d).base()).groupBy(F.date_trunc("MONTH", "ts").cast("date").alias("month")).agg(F.count("*").alias("n"))


_LAGS_M = ", ".join(f"lag(probability, {i}) OVER w AS lag_{i}" for i in range(1, 13))


@query("lag_features_month", f"WITH {_MONTHS}, l AS (SELECT activity, p AS period, probability AS y, row_number() OVER w AS nth, {_LAGS_M} FROM dense WINDOW w AS (PARTITION BY activity ORDER BY p)), wd AS (SELECT date_trunc('month', d)::DATE AS period, count(*) AS month_days FROM (SELECT unnest(generate_series(DATE '1990-01-01', DATE '2025-12-31', INTERVAL 1 DAY))::DATE AS d) WHERE isodow(d) < 6 GROUP BY 1) SELECT activity, period, round(lag_1 - lag_12, 6) AS diff_12, month_days, (nth - 12)::INT AS linear, {', '.join(f'(month(period) = {m})::INT AS M{m}' for m in range(1, 13))} FROM l LEFT JOIN wd USING (period) WHERE nth > 12")
def _(spark, d):
    calendar = series.working_days(spark, "1990-01-01", "2025-12-31").select("period", "month_days")
    out = series.lag_features(series.node_series(orders(spark, d), "M"), ["activity"], period="M", calendar=calendar, one_hot=True)
    return out.select("activity", "period", F.round("diff_12", 6).alias("diff_12"), "month_days", "linear", *(f"M{m}" for m in range(1, 13)))


_SELECT = f"{_NODES}, l AS (SELECT y, nth, {', '.join(f'lag_{i}' for i in range(1, 8))} FROM (SELECT activity, p, probability AS y, row_number() OVER w AS nth, {', '.join(f'lag(probability, {i}) OVER w AS lag_{i}' for i in range(1, 8))} FROM dense WINDOW w AS (PARTITION BY activity ORDER BY p)) WHERE nth > 7)"


@query("feature_selection", f"WITH {_SELECT}, f AS ({' UNION ALL '.join(f"SELECT 'lag_{i}' AS feature, corr(y, lag_{i}) ** 2 AS r2 FROM l" for i in range(1, 8))}), o AS (SELECT *, row_number() OVER (ORDER BY r2 DESC, feature)::INT AS rank FROM f) SELECT feature, round(r2, 6) AS r2, rank FROM o WHERE rank <= 3")
def _(spark, d):
    lags = series.lag_features(series.node_series(events(spark, d)), ["activity"])
    return factors.k_best(lags, "y", [f"lag_{i}" for i in range(1, 8)], 0.5).withColumn("r2", F.round("r2", 6))


@query("feature_selectors")
def _(spark, d):
    """The last fifth of the periods is held out."""
    lags = series.lag_features(series.node_series(events(spark, d)), ["activity"]).dropna()
    ranked = lags.withColumn("part", F.percent_rank().over(Window.partitionBy("activity").orderBy("period")))
    return selection.select_features(ranked, "y", [f"lag_{i}" for i in range(1, 8)], F.col("part") > 0.8)


_AHEAD = "la AS (SELECT activity, arg_max(probability, p) AS prob, arg_max(m, p) AS dur, max(p) AS p FROM dense GROUP BY 1), ah AS (SELECT activity, (p + k)::DATE AS period, prob / sum(prob) OVER (PARTITION BY k) AS prob, dur FROM la, (SELECT unnest([1, 2, 3])::INT AS k))"
_LAST = series.Plan(steps=3, kinds=("last",))


@query("forecast_last", f"WITH {_NODES}, {_AHEAD} SELECT activity, period, round(prob, 6) AS forecast, 'last' AS model FROM ah")
def _(spark, d):
    return series.forecast(series.node_series(events(spark, d)), ["activity"], plan=_LAST).withColumn("forecast", F.round("forecast", 6))


@query("forecast_blend", f"WITH {_NODES}, {_AHEAD} SELECT activity, period, round(CASE WHEN activity = 'view' THEN dur ELSE sqrt(prob * dur) END, 4) AS forecast FROM ah")
def _(spark, d):
    nodes = series.node_series(events(spark, d))
    a = series.forecast(nodes, ["activity"], plan=_LAST).filter("activity <> 'view'")
    b = series.forecast(nodes, ["activity"], "mean_duration_s", plan=replace(_LAST, normalise=False))
    return series.blend_forecasts(a, b, ["activity"]).withColumn("forecast", F.round("forecast", 4))


_KIND_COLUMNS = ", ".join(f"max(round(prob, 6)) FILTER (activity = '{k}') AS {k}_prob, max(round(dur, 6)) FILTER (activity = '{k}') AS {k}_duration_s" for k in ("click", "error", "purchase", "signup", "view"))


@query("forecast_table", f"WITH {_NODES}, {_AHEAD} SELECT period, {_KIND_COLUMNS} FROM ah GROUP BY period")
def _(spark, d):
    return series.forecast_table(series.node_series(events(spark, d)), _LAST)


@query("forecast_errors", f"WITH {_NODES}, l AS (SELECT probability AS y, lag(probability) OVER (PARTITION BY activity ORDER BY p) AS f FROM dense) SELECT round(avg(abs(y - f) / nullif(abs(y), 0)), 6) AS mape, round(avg((y - f) ** 2), 8) AS mse FROM l WHERE f IS NOT NULL")
def _(spark, d):
    lags = series.node_series(events(spark, d)).withColumn("f", F.lag("probability").over(Window.partitionBy("activity").orderBy("period"))).filter("f is not null")
    return lags.agg(F.round(scalar.mape(F.col("probability"), F.col("f")), 6).alias("mape"), F.round(scalar.mse(F.col("probability"), F.col("f")), 8).alias("mse"))


@query("forecast_nodes")
def _(spark, d):
    return series.forecast(series.node_series(events(spark, d)), ["activity"])


_CUTS = "s AS (SELECT activity, p, probability AS y, row_number() OVER (PARTITION BY activity ORDER BY p) AS r, count(*) OVER (PARTITION BY activity) AS n, min(probability) OVER (PARTITION BY activity) AS least FROM dense), f AS (SELECT s.*, fold, n - greatest(1, floor(n * 0.1)) * fold AS cut, greatest(1, floor(n * 0.1)) AS keep FROM s, (SELECT unnest([1, 2, 3])::INT AS fold))"
_KNOWN = "k AS (SELECT activity, fold, avg(y) AS mean, arg_max(y, r) AS last, arg_min(y, r) AS first, any_value(cut) AS cut FROM f WHERE r <= cut AND cut >= 6 GROUP BY ALL), g AS (SELECT f.activity, f.fold, f.y, f.r, f.least, f.keep, k.cut, k.mean, k.last, k.first FROM f JOIN k ON f.activity = k.activity AND f.fold = k.fold WHERE f.r > k.cut AND f.r <= k.cut + f.keep)"
_GUESS = "h AS (SELECT activity, fold, least, y, 'last' AS model, greatest(last, 0) AS fc FROM g UNION ALL SELECT activity, fold, least, y, 'mean', greatest(mean, 0) FROM g UNION ALL SELECT activity, fold, least, y, 'drift', greatest(last + (last - first) / (cut - 1) * (r - cut), 0) FROM g)"
_SCORED = "sc AS (SELECT activity, model, fold, CASE WHEN least > 1e-9 THEN 'mape' ELSE 'mse' END AS metric, avg(CASE WHEN least > 1e-9 THEN abs((y - fc) / y) ELSE (y - fc) ** 2 END) AS score FROM h GROUP BY ALL)"
_SEARCH = f"{_NODES}, {_CUTS}, {_KNOWN}, {_GUESS}, {_SCORED}"
_THREE = forecasting.Search(names=("last", "mean", "drift"))


@query("forecast_scores", f"WITH {_SEARCH} SELECT activity, model, fold, metric, round(score, 6) AS score FROM sc")
def _(spark, d):
    return forecasting.forecast_scores(series.node_series(events(spark, d)), ["activity"], search=_THREE).withColumn("score", F.round("score", 6))


_PAIRED = "hp AS (SELECT activity, fold, r, least, y, model, fc FROM (SELECT activity, fold, r, least, y, unnest(['last', 'mean', 'drift']) AS model, unnest([greatest(last, 0), greatest(mean, 0), greatest(last + (last - first) / (cut - 1) * (r - cut), 0)]) AS fc FROM g)), pr AS (SELECT a.activity, a.fold, a.least, a.y, a.model || ' & ' || b.model AS model, sqrt(a.fc * b.fc) AS fc FROM hp a JOIN hp b ON a.activity = b.activity AND a.fold = b.fold AND a.r = b.r AND a.model < b.model)"


@query("forecast_pair_scores", f"WITH {_NODES}, {_CUTS}, {_KNOWN}, {_PAIRED}, {_SCORED.replace('FROM h ', 'FROM (SELECT activity, fold, least, y, model, fc FROM hp UNION ALL SELECT * FROM pr) ')} SELECT activity, model, round(avg(score), 6) AS score FROM sc GROUP BY ALL")
def _(spark, d):
    scores = forecasting.forecast_scores(series.node_series(events(spark, d)), ["activity"], search=replace(_THREE, pairs=True))
    return scores.groupBy("activity", "model").agg(F.round(F.avg("score"), 6).alias("score"))


@query("forecast_best_of_three", f"WITH {_SEARCH}, m AS (SELECT activity, model, avg(score) AS score FROM sc GROUP BY ALL), b AS (SELECT activity, arg_min(model, (score, model)) AS model FROM m GROUP BY 1), w AS (SELECT activity, avg(y) AS mean, arg_max(y, r) AS last, arg_min(y, r) AS first, max(n) AS n, max(p) AS p FROM s GROUP BY 1), o AS (SELECT activity, (p + k)::DATE AS period, model, greatest(CASE model WHEN 'last' THEN last WHEN 'mean' THEN mean ELSE last + (last - first) / (n - 1) * k END, 0) AS fc FROM w JOIN b USING (activity), (SELECT unnest([1, 2, 3, 4, 5])::INT AS k)) SELECT activity, period, round(fc / sum(fc) OVER (PARTITION BY period), 6) AS forecast, model FROM o")
def _(spark, d):
    return forecasting.searched_forecast(series.node_series(events(spark, d)), ["activity"], search=_THREE).withColumn("forecast", F.round("forecast", 6))


@query("forecast_searched")
def _(spark, d):
    """All models of days and their pairs, state-space ones among them."""
    return forecasting.searched_forecast(series.node_series(events(spark, d)), ["activity"], search=forecasting.Search(pairs=True))


@query("working_days", "WITH d AS (SELECT unnest(generate_series(DATE '2015-01-01', DATE '2025-12-31', INTERVAL 1 DAY))::DATE AS d), m AS (SELECT date_trunc('month', d)::DATE AS period, count(*) AS month_days FROM d WHERE isodow(d) < 6 GROUP BY 1) SELECT period, month_days, sum(month_days) OVER (PARTITION BY year(period), quarter(period))::BIGINT AS quarter_days, sum(month_days) OVER (PARTITION BY year(period), quarter(period) > 2)::BIGINT AS half_days FROM m")
def _(spark, d):
    return series.working_days(spark, "2015-01-01", "2025-12-31")


# Happy path.

_STEPS = f"{ORDERS}, s AS (SELECT case_id, activity, coalesce(duration_us, 0) AS duration_us, activity_num AS pos FROM log UNION ALL SELECT case_id, 'start', 0, 0 FROM log GROUP BY case_id UNION ALL SELECT case_id, 'end', 0, max(activity_num) + 1 FROM log GROUP BY case_id), st AS (SELECT activity, lead(activity) OVER (PARTITION BY case_id ORDER BY pos) AS next_activity FROM s), n AS (SELECT activity, next_activity, count(*) AS n FROM st WHERE next_activity IS NOT NULL GROUP BY ALL), p AS (SELECT *, n / sum(n) OVER (PARTITION BY activity) AS p FROM n), e AS (SELECT activity, next_activity, n, p / sum(p) OVER (PARTITION BY activity) AS probability FROM p WHERE p > 0.02), d AS (SELECT activity AS next_activity, avg(duration_us) / 6e7 AS minutes FROM s GROUP BY 1), rw AS (SELECT activity, next_activity, probability, CASE WHEN next_activity = 'end' THEN 0 ELSE -coalesce(minutes / nullif(avg(minutes) OVER (), 0), 0) END AS reward FROM e JOIN d USING (next_activity))"


@query("start_distribution", f"WITH {ORDERS}, f AS (SELECT activity, count(*) / sum(count(*)) OVER () AS probability FROM log WHERE activity_num = 1 GROUP BY activity) SELECT activity, round(probability, 6) AS probability FROM f WHERE probability > 0.05")
def _(spark, d):
    return happypath.start_distribution(orders(spark, d)).withColumn("probability", F.round("probability", 6))


@query("transition_probabilities", f"WITH {_STEPS} SELECT activity, next_activity, n, round(probability, 6) AS probability FROM e")
def _(spark, d):
    return happypath.conditional_probabilities(orders(spark, d), 0.02).withColumn("probability", F.round("probability", 6))


@query("mdp_rewards", f"WITH {_STEPS} SELECT activity, next_activity, round(probability, 6) AS probability, round(reward, 6) AS reward FROM rw")
def _(spark, d):
    return happypath.rewards(orders(spark, d), 0.02).withColumns({c: F.round(c, 6) for c in ("probability", "reward")})


@query("mdp_actions", f"WITH {_STEPS} SELECT a.activity, b.next_activity AS action, a.next_activity, round((a.probability + CASE WHEN a.next_activity = b.next_activity THEN 0.3 ELSE 0 END) / 1.3, 6) AS probability FROM rw a JOIN rw b ON a.activity = b.activity")
def _(spark, d):
    return happypath.actions(happypath.rewards(orders(spark, d), 0.02)).select("activity", "action", "next_activity", F.round("probability", 6).alias("probability"))


@query("mdp_consistency", f"WITH {_STEPS}, m AS (SELECT a.activity, b.next_activity AS action, a.next_activity, (a.probability + CASE WHEN a.next_activity = b.next_activity THEN 0.3 ELSE 0 END) / 1.3 AS probability FROM rw a JOIN rw b ON a.activity = b.activity) SELECT activity, action, round(sum(probability) FILTER (next_activity <> 'O'), 6) AS total FROM m GROUP BY ALL HAVING abs(sum(probability) FILTER (next_activity <> 'O') - 1) > 1e-10")
def _(spark, d):
    """Of a table that lacks the ways to one activity; the whole one is consistent."""
    table = happypath.actions(happypath.rewards(orders(spark, d), 0.02))
    assert happypath.inconsistent(table).isEmpty()
    return happypath.inconsistent(table.filter("next_activity <> 'O'")).withColumn("total", F.round("total", 6))


@query("case_layers", f"WITH {ORDERS} SELECT case_id, count(*) FILTER (activity = 'F') AS layer FROM log GROUP BY case_id")
def _(spark, d):
    return happypath.layers(orders(spark, d), "F")


def _edges(spark, d) -> DataFrame:
    return happypath.rewards(orders(spark, d), 0.02)


_SOLVED = f"""WITH RECURSIVE {_STEPS.replace(ORDERS, ORDERS, 1)}, st_ AS (SELECT activity FROM rw UNION SELECT next_activity FROM rw), v(i, activity, value) AS (
  SELECT 0, activity, 0.0::DOUBLE FROM st_ UNION ALL
  SELECT n.i, n.activity, coalesce(q.q, 0.0) FROM (SELECT i + 1 AS i, activity FROM v WHERE i < 200) n LEFT JOIN
    (SELECT rw.activity, (sum(probability * (reward + 0.9 * v.value)) + 0.3 * max(reward + 0.9 * v.value)) / 1.3 AS q FROM rw JOIN v ON v.activity = rw.next_activity GROUP BY rw.activity) q USING (activity)
), moved AS (SELECT b.i, max(abs(b.value - a.value)) AS m FROM v a JOIN v b ON b.i = a.i + 1 AND a.activity = b.activity GROUP BY b.i),
f AS (SELECT activity, value FROM v WHERE i = (SELECT min(i) FROM moved WHERE m < 1e-3)),
pol AS (SELECT rw.activity, min_by(rw.next_activity, (-(reward + 0.9 * f.value), rw.next_activity)) AS action FROM rw JOIN f ON f.activity = rw.next_activity GROUP BY rw.activity)"""


@query("value_iteration", f"{_SOLVED} SELECT activity, round(value, 6) AS value, action FROM f LEFT JOIN pol USING (activity)")
def _(spark, d):
    return happypath.value_iteration(_edges(spark, d)).withColumn("value", F.round("value", 6))


@query("value_iteration_joins", f"{_SOLVED} SELECT activity, round(value, 6) AS value, action FROM f LEFT JOIN pol USING (activity)")
def _(spark, d):
    """The way for edge lists beyond the driver's bound, here with a bound of none."""
    return happypath.value_iteration(_edges(spark, d), on_driver=0).withColumn("value", F.round("value", 6))


@query("happy_path", f"{_SOLVED}, path(step, activity, seen) AS (SELECT 0, 'start'::VARCHAR, ['start'::VARCHAR] UNION ALL SELECT step + 1, pol.action, list_append(seen, pol.action) FROM path JOIN pol USING (activity) WHERE pol.action IS NOT NULL AND NOT list_contains(seen, pol.action)) SELECT step::INT AS step, activity FROM path")
def _(spark, d):
    return happypath.best_path(_edges(spark, d))


@query("mdp_states", f"WITH {_STEPS}, n_ AS (SELECT activity FROM rw UNION SELECT next_activity FROM rw) SELECT n_.activity, row_number() OVER (ORDER BY n_.activity = 'end', n_.activity)::INT AS state, coalesce(string_agg(rw.next_activity, ',' ORDER BY rw.next_activity), '') AS actions FROM n_ LEFT JOIN rw USING (activity) GROUP BY n_.activity")
def _(spark, d):
    return happypath.states(_edges(spark, d)).withColumn("actions", F.array_join("actions", ","))


_LAYERED = f"""WITH {ORDERS}, ly AS (SELECT case_id, count(*) FILTER (activity = 'F')::INT AS layer FROM log GROUP BY case_id),
s AS (SELECT case_id, activity, coalesce(duration_us, 0) AS duration_us, activity_num AS pos FROM log UNION ALL SELECT case_id, 'start', 0, 0 FROM log GROUP BY case_id UNION ALL SELECT case_id, 'end', 0, max(activity_num) + 1 FROM log GROUP BY case_id),
st AS (SELECT case_id, activity, duration_us, lead(activity) OVER (PARTITION BY case_id ORDER BY pos) AS next_activity FROM s),
r AS (SELECT unnest([-2, -1, 0]) AS layer, * FROM st UNION ALL SELECT layer, st.* FROM st JOIN ly USING (case_id) WHERE layer > 0),
n AS (SELECT layer, activity, next_activity, count(*) AS n FROM r WHERE next_activity IS NOT NULL GROUP BY ALL), p AS (SELECT *, n / sum(n) OVER (PARTITION BY layer, activity) AS p FROM n),
e AS (SELECT layer, activity, next_activity, p / sum(p) OVER (PARTITION BY layer, activity) AS probability FROM p WHERE p > CASE WHEN layer = -1 THEN 0 ELSE 0.02 END),
d AS (SELECT layer, activity AS next_activity, avg(duration_us) / 6e7 AS minutes FROM r GROUP BY ALL)
SELECT layer, activity, next_activity, round(probability, 6) AS probability, round(CASE WHEN next_activity = 'end' THEN 0 WHEN next_activity = 'F' THEN CASE WHEN layer = -2 OR layer > 2 THEN -1 ELSE 1 END ELSE -coalesce(minutes / nullif(avg(minutes) OVER (PARTITION BY layer), 0), 0) END, 6) AS reward FROM e JOIN d USING (layer, next_activity)"""


@query("mdp_layers", _LAYERED)
def _(spark, d):
    out = happypath.layered_rewards(orders(spark, d), "F", floor=0.02, short_path=2)
    return out.withColumns({c: F.round(c, 6) for c in ("probability", "reward")})


_LAYERS_SOLVED = f"""WITH RECURSIVE{_LAYERED.split("WITH", 1)[1].rsplit("SELECT layer, activity, next_activity, round(probability", 1)[0].rstrip()},
rw AS (SELECT layer, activity, next_activity, probability, CASE WHEN next_activity = 'end' THEN 0 WHEN next_activity = 'F' THEN CASE WHEN layer = -2 THEN -1 WHEN layer > 2 THEN -0.5 ELSE 1 END ELSE -coalesce(minutes / nullif(avg(minutes) OVER (PARTITION BY layer), 0), 0) END AS reward FROM e JOIN d USING (layer, next_activity)),
lx AS (SELECT layer, lead(layer) OVER (ORDER BY layer) AS up FROM (SELECT DISTINCT layer FROM rw WHERE layer >= 0)),
le AS MATERIALIZED (SELECT layer, activity, CASE WHEN next_activity = 'F' THEN coalesce(up, layer) ELSE layer END AS next_layer, next_activity, probability, reward FROM rw JOIN lx USING (layer)),
ls AS MATERIALIZED (SELECT layer, activity FROM le UNION SELECT next_layer, next_activity FROM le),
v(i, layer, activity, value) AS (
  SELECT 0, layer, activity, 0.0::DOUBLE FROM ls UNION ALL
  SELECT n.i, n.layer, n.activity, coalesce(q.q, 0.0) FROM (SELECT i + 1 AS i, layer, activity FROM v WHERE i < 120) n LEFT JOIN
    (SELECT le.layer, le.activity, (sum(probability * (reward + 0.9 * v.value)) + 0.3 * max(reward + 0.9 * v.value)) / 1.3 AS q FROM le JOIN v ON v.layer = le.next_layer AND v.activity = le.next_activity GROUP BY ALL) q USING (layer, activity)
), moved AS (SELECT b.i, max(abs(b.value - a.value)) AS m FROM v a JOIN v b ON b.i = a.i + 1 AND a.layer = b.layer AND a.activity = b.activity GROUP BY b.i),
f AS (SELECT layer, activity, value FROM v WHERE i = (SELECT min(i) FROM moved WHERE m < 1e-3)),
pol AS (SELECT le.layer, le.activity, min_by({{'a': le.next_activity, 'l': le.next_layer}}, (-(reward + 0.9 * f.value), le.next_activity)) AS go FROM le JOIN f ON f.layer = le.next_layer AND f.activity = le.next_activity GROUP BY ALL)"""


def _layered_edges(spark, d) -> DataFrame:
    return happypath.layered_edges(orders(spark, d), "F", floor=0.02, short_path=2, penalty=0.5)


@query("mdp_layers_solved", f"{_LAYERS_SOLVED} SELECT layer, activity, round(value, 6) AS value, go.a AS action, go.l AS next_layer FROM f LEFT JOIN pol USING (layer, activity)")
def _(spark, d):
    return happypath.solve_layers(_layered_edges(spark, d)).withColumn("value", F.round("value", 6))


@query("happy_path_layers", f"{_LAYERS_SOLVED}, path(step, layer, activity, seen) AS (SELECT 0, 0, 'start'::VARCHAR, ['start 0'] UNION ALL SELECT step + 1, go.l, go.a, list_append(seen, go.a || ' ' || go.l) FROM path JOIN pol USING (layer, activity) WHERE NOT list_contains(seen, go.a || ' ' || go.l)) SELECT step::INT AS step, layer, activity FROM path")
def _(spark, d):
    return runner.run_model("happy_path", orders(spark, d), {"mode": "'final'", "key_node": "'F'", "floor": "0.02", "short_path": "2", "penalty": "0.5"})


@query("mdp_key_rewards", f"WITH {_STEPS} SELECT activity, next_activity, round(CASE WHEN next_activity = 'O' THEN -2 WHEN next_activity = 'end' THEN 5 ELSE reward END, 6) AS reward FROM rw")
def _(spark, d):
    return happypath.rewards(orders(spark, d), 0.02, key_node="O", key_reward=-2.0, end_reward=5.0).select("activity", "next_activity", F.round("reward", 6).alias("reward"))


# Factors.


@query("factor_encode", "SELECT c_custkey, c_acctbal, c_nationkey::DOUBLE AS c_nationkey, " + ", ".join(f"CASE WHEN c_mktsegment = '{s}' THEN 1.0 ELSE 0.0 END::DOUBLE AS \"c_mktsegment={s}\"" for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")) + " FROM customer")
def _(spark, d):
    return factors.encode(table(spark, d, "customer"), "c_acctbal", ["c_mktsegment", "c_nationkey"], keep=("c_custkey",))[0]


@query("factor_frequency", "SELECT p_partkey, count(*) OVER (PARTITION BY p_type) AS p_type_freq FROM part")
def _(spark, d):
    return factors.frequency_encoded(table(spark, d, "part"), "p_type").select("p_partkey", "p_type_freq")


@query("factor_min_max", "SELECT p_partkey, round((p_size - min(p_size) OVER ()) / (max(p_size) OVER () - min(p_size) OVER ()), 6) AS p_size FROM part")
def _(spark, d):
    return factors.min_max(table(spark, d, "part").select("p_partkey", "p_size"), ["p_size"]).withColumn("p_size", F.round("p_size", 6))


@query("factor_share", "SELECT p_brand, p_size, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY p_brand), 6) AS share FROM part GROUP BY p_brand, p_size")
def _(spark, d):
    return factors.share_within(table(spark, d, "part"), ["p_brand"], "p_size").withColumn("share", F.round("share", 6))


@query("factor_ridge", "SELECT round((regr_slope(l_extendedprice, l_quantity)), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 2) AS offset_, round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem")
def _(spark, d):
    m = factors.moments(table(spark, d, "lineitem"), ["l_quantity"], "l_extendedprice")[0]
    w, b = factors.solve(m, [0], alpha=0.0)
    return spark.createDataFrame([(round(float(w[0]), 4), round(b, 2), round(factors.r2(m, [0], w, b), 6))], "slope double, offset_ double, r2 double")


@query("factor_dropped_rows", "SELECT c_custkey, c_acctbal, c_nationkey::DOUBLE AS c_nationkey FROM customer WHERE c_nationkey <> 3")
def _(spark, d):
    c = table(spark, d, "customer").withColumn("c_nationkey", F.expr("nullif(c_nationkey, 3)")).withColumn("same", F.lit("x"))
    return factors.encode(c, "c_acctbal", ["c_nationkey", "same"], keep=("c_custkey",), drop_null=True)[0]


@query("factor_counts", "SELECT count(DISTINCT p_brand) AS p_brand, count(DISTINCT p_size) AS p_size, count(DISTINCT p_type) AS p_type FROM part")
def _(spark, d):
    n = factors.distinct_counts(table(spark, d, "part"), ["p_brand", "p_size", "p_type"])
    return spark.createDataFrame([tuple(n.values())], ", ".join(f"{c} long" for c in n))


@query("factor_importance_one", "WITH s AS (SELECT (p_size - min(p_size) OVER ()) / (max(p_size) OVER () - min(p_size) OVER ()) AS x, (p_retailprice - min(p_retailprice) OVER ()) / (max(p_retailprice) OVER () - min(p_retailprice) OVER ()) AS y FROM part), m AS (SELECT avg(x) AS mx, avg(y) AS my, covar_pop(x, y) * count(*) / (var_pop(x) * count(*) + 1) AS w FROM s) SELECT 'p_size' AS feature, 100.0::DOUBLE AS ridge, 100.0::DOUBLE AS shap, 100.0::DOUBLE AS permutation, NULL::DOUBLE AS other UNION ALL SELECT 'other', NULL, NULL, NULL, (SELECT round(100 * sum((y - (my + w * (x - mx))) ** 2) / sum((y - my) ** 2), 5) FROM s, m)")
def _(spark, d):
    out = factors.importances(table(spark, d, "part"), "p_retailprice", ["p_size"], "p_partkey")
    return out.select("feature", "ridge", "shap", "permutation", F.when(F.col("feature") == "other", F.round("score", 5)).alias("other"))


@query("happy_path_by_name", f"{_SOLVED}, path(step, activity, seen) AS (SELECT 0, 'start'::VARCHAR, ['start'::VARCHAR] UNION ALL SELECT step + 1, pol.action, list_append(seen, pol.action) FROM path JOIN pol USING (activity) WHERE pol.action IS NOT NULL AND NOT list_contains(seen, pol.action)) SELECT step::INT AS step, activity FROM path")
def _(spark, d):
    return runner.run_model("happy_path", orders(spark, d), {"floor": "0.02"})


@query("metrics_by_name", f"WITH {EVENTS} SELECT activity, count(activity) AS count, array_to_string(list_sort(list(DISTINCT case_id)), ', ') AS unique_ids FROM log GROUP BY activity")
def _(spark, d):
    return runner.run_model("metrics", events(spark, d), {"family": "'activity'", "names": "['count', 'unique_ids']"})


@query("plain_types", "SELECT o_orderkey, CASE WHEN o_totalprice > 1000 THEN 'True' ELSE 'False' END AS large, o_orderstatus || ', ' || o_orderpriority AS parts, '{{\"a\":' || o_custkey || '}}' AS record FROM orders".replace("{{", "{").replace("}}", "}"))
def _(spark, d):
    o = table(spark, d, "orders")
    return runner.plain(o.select("o_orderkey", (F.col("o_totalprice") > 1000).alias("large"), F.array("o_orderstatus", "o_orderpriority").alias("parts"), F.struct(F.col("o_custkey").alias("a")).alias("record")))


@query("factor_importances")
def _(spark, d):
    return factors.importances(table(spark, d, "part"), "p_retailprice", ["p_brand", "p_size", "p_type"], "p_partkey")


@query(
    "factor_importances_two",
    """WITH wide AS (SELECT l_orderkey AS k, sum(l_extendedprice) AS y0, sum(l_quantity) AS a0, avg(l_discount) AS b0 FROM lineitem GROUP BY 1),
    s AS (SELECT k, (y0 - min(y0) OVER ()) / (max(y0) OVER () - min(y0) OVER ()) AS y, (a0 - min(a0) OVER ()) / (max(a0) OVER () - min(a0) OVER ()) AS a, (b0 - min(b0) OVER ()) / (max(b0) OVER () - min(b0) OVER ()) AS b FROM wide),
    m AS (SELECT part, avg(a) AS ma, avg(b) AS mb, avg(y) AS my, sum(a * a) - count(*) * avg(a) ** 2 AS aa, sum(b * b) - count(*) * avg(b) ** 2 AS bb, sum(a * b) - count(*) * avg(a) * avg(b) AS ab, sum(a * y) - count(*) * avg(a) * avg(y) AS ay, sum(b * y) - count(*) * avg(b) * avg(y) AS by_, part = 'all' AS ridge
      FROM (SELECT *, unnest(CASE WHEN k % 4 = 0 THEN ['all'] ELSE ['all', 'learnt'] END) AS part FROM s) GROUP BY part),
    w AS (SELECT *, (ay * (bb + ridge::INT) - by_ * ab) / ((aa + ridge::INT) * (bb + ridge::INT) - ab * ab) AS wa, (by_ * (aa + ridge::INT) - ay * ab) / ((aa + ridge::INT) * (bb + ridge::INT) - ab * ab) AS wb FROM m),
    f AS (SELECT abs(wa * (a - ma)) AS fa, abs(wb * (b - mb)) AS fb FROM s, w WHERE part = 'learnt' AND k % 4 = 0 ORDER BY k LIMIT 1),
    p AS (SELECT abs(wa) AS ra, abs(wb) AS rb, wa * wa * aa AS pa, wb * wb * bb AS pb FROM w WHERE part = 'all'),
    o AS (SELECT 100 * sum((y - (my + wa * (a - ma) + wb * (b - mb))) ** 2) / sum((y - my) ** 2) AS other FROM s, w WHERE part = 'all')
    SELECT 'quantity' AS feature, round(100 * ra / (ra + rb), 4) AS ridge, round(100 * fa / (fa + fb), 4) AS shap, round(100 * pa / (pa + pb), 4) AS permutation, NULL::DOUBLE AS other FROM p, f
    UNION ALL SELECT 'discount', round(100 * rb / (ra + rb), 4), round(100 * fb / (fa + fb), 4), round(100 * pb / (pa + pb), 4), NULL FROM p, f
    UNION ALL SELECT 'other', NULL, NULL, NULL, round(other, 4) FROM o""",
)
def _(spark, d):
    """Of the price of an order; every fourth order is held out of the attributed fit."""
    wide = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("price"), F.sum("l_quantity").alias("quantity"), F.avg("l_discount").alias("discount"))
    out = factors.importances(wide, "price", ["quantity", "discount"], "l_orderkey", test=F.col("l_orderkey") % 4 == 0)
    return out.select("feature", *(F.round(c, 4).alias(c) for c in ("ridge", "shap", "permutation")), F.when(F.col("feature") == "other", F.round("score", 4)).alias("other"))


@query("permuted_column", "WITH s AS (SELECT unnest([1, 2]) AS seed), a AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) AS i FROM part), b AS (SELECT seed, p_size, row_number() OVER (PARTITION BY seed ORDER BY md5(p_partkey || ':' || seed), p_partkey) AS i FROM part, s) SELECT p_partkey, seed, p_size AS p_p_size FROM a JOIN b USING (i)")
def _(spark, d):
    return ranking.permuted(table(spark, d, "part").select("p_partkey", "p_size"), "p_partkey", ["p_size"], [1, 2]).drop("p_size")


@query("permutation_importances")
def _(spark, d):
    """Of boosted trees for the order's price."""
    wide = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("price"), F.sum("l_quantity").alias("quantity"), F.count("*").alias("parts"), F.avg("l_discount").alias("discount"))
    columns = ["quantity", "parts", "discount"]
    forest = trees.fit(wide.drop("l_orderkey"), [*columns, "price"], ["price"], trees=10, depth=2)["price", -1]
    return trees.permutation_importance(wide, "l_orderkey", columns, "price", lambda x: forest.predict(np.column_stack((x, np.zeros(len(x))))))


@query("activity_models")
def _(spark, d):
    return trees.held_out_errors(insights.pivot(events(spark, d), "appearance"), "case_id")


@query(
    "activity_models_of_two",
    """WITH pv AS (SELECT l_orderkey AS k, max((l_linestatus = 'F')::INT) AS f, max((l_returnflag = 'R')::INT) AS r FROM lineitem GROUP BY 1),
    u AS (SELECT k, 'f' AS activity, f AS y, r AS x FROM pv UNION ALL SELECT k, 'r', r, f FROM pv),
    g AS (SELECT activity, z, x, avg(y) AS m FROM u, (SELECT unnest([0, 1, 2, 3, 4]) AS z) WHERE k % 5 <> z GROUP BY ALL),
    e AS (SELECT u.activity, y, y - m AS e FROM u JOIN g ON u.activity = g.activity AND u.k % 5 = g.z AND u.x = g.x)
    SELECT activity, count(*) AS n, round(avg(abs(e)), 6) AS mae, round(1 - sum(e * e) / (var_pop(y) * count(*)), 6) AS r2 FROM e GROUP BY activity""",
)
def _(spark, d):
    """Two flags of an order: one split with full steps gives the means of the other folds."""
    wide = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max((F.col("l_linestatus") == "F").cast("int")).alias("f"), F.max((F.col("l_returnflag") == "R").cast("int")).alias("r"))
    out = trees.held_out_errors(wide, "l_orderkey", fold=F.col("l_orderkey") % 5, trees=1, depth=1, rate=1.0)
    return out.withColumns({c: F.round(c, 6) for c in ("mae", "r2")})


def _ols(split: str) -> str:
    """The fit of price on quantity and discount over the rows that split keeps, w1 and w2, with their means."""
    return f"""t AS (SELECT l_orderkey, l_linenumber, l_quantity AS q, l_discount AS d, l_extendedprice AS y FROM lineitem),
    c AS (SELECT avg(q) AS mq, avg(d) AS md, var_pop(q) AS qq, var_pop(d) AS dd, covar_pop(q, d) AS qd, covar_pop(q, y) AS qy, covar_pop(d, y) AS dy, var_pop(y) AS yy FROM t WHERE {split}),
    w AS (SELECT *, (qy * dd - dy * qd) / (qq * dd - qd * qd) AS w1, (dy * qq - qy * qd) / (qq * dd - qd * qd) AS w2 FROM c)"""


_PRICED = ("l_extendedprice", ["l_quantity", "l_discount"])


@query("row_attributions", f"WITH {_ols('l_orderkey % 4 <> 0')} SELECT l_orderkey, l_linenumber, 'l_quantity' AS feature, round(w1 * (q - mq), 1) AS attribution FROM t, w WHERE l_orderkey % 4 = 0 UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', round(w2 * (d - md), 1) FROM t, w WHERE l_orderkey % 4 = 0")
def _(spark, d):
    """What quantity and discount add to the price of the lines of every fourth order, by a fit of the other lines."""
    out = leastangle.attributions(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], *_PRICED, F.col("l_orderkey") % 4 == 0)
    return out.withColumn("attribution", F.round("attribution", 1))


@query("first_row_shares", f"WITH {_ols('l_orderkey % 4 <> 0')}, f AS (SELECT abs(w1 * (q - mq)) AS a, abs(w2 * (d - md)) AS b FROM t, w WHERE l_orderkey % 4 = 0 ORDER BY l_orderkey, l_linenumber, q, d LIMIT 1) SELECT 'l_quantity' AS feature, round(100 * a / (a + b), 5) AS share FROM f UNION ALL SELECT 'l_discount', round(100 * b / (a + b), 5) FROM f")
def _(spark, d):
    target, features = _PRICED
    out = leastangle.first_row_shares(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], target, {f: [f] for f in features}, F.col("l_orderkey") % 4 == 0)
    return out.withColumn("share", F.round("share", 5))


@query(
    "least_angle_two",
    f"""WITH {_ols('true')}, r AS (SELECT qy / sqrt(qq * yy) AS r1, dy / sqrt(dd * yy) AS r2, qd / sqrt(qq * dd) AS r12, w1, w2 FROM w),
    o AS (SELECT CASE WHEN abs(r1) >= abs(r2) THEN 'l_quantity' ELSE 'l_discount' END AS f1, CASE WHEN abs(r1) >= abs(r2) THEN r1 ELSE r2 END AS a, CASE WHEN abs(r1) >= abs(r2) THEN r2 ELSE r1 END AS b, r12, w1, w2 FROM r),
    s AS (SELECT *, abs(a) - least((abs(a) - b) / (1 - r12 * sign(a)), (abs(a) + b) / (1 + r12 * sign(a))) AS c2 FROM o)
    SELECT 1 AS step, f1 AS feature, round(abs(a), 6) AS correlation, round(CASE WHEN f1 = 'l_quantity' THEN w1 ELSE w2 END, 3) AS weight FROM s
    UNION ALL SELECT 2, CASE WHEN f1 = 'l_quantity' THEN 'l_discount' ELSE 'l_quantity' END, round(c2, 6), round(CASE WHEN f1 = 'l_quantity' THEN w2 ELSE w1 END, 3) FROM s""",
)
def _(spark, d):
    out = leastangle.least_angle_path(table(spark, d, "lineitem"), *_PRICED)
    return out.withColumns({"correlation": F.round("correlation", 6), "weight": F.round("weight", 3)})


@query("least_angle_path")
def _(spark, d):
    """The four features that join first, of seven lags of daily shares of events and their trend."""
    return leastangle.least_angle_path(series.lag_features(series.node_series(events(spark, d)), ["activity"]), "y", [*(f"lag_{i}" for i in range(1, 8)), "linear"], most=4)


# Clusters.


def _grams(column: str) -> str:
    return f"""w AS (SELECT DISTINCT {column} AS stage FROM part WHERE {column} IS NOT NULL AND {column} NOT IN (' ', '.', '..', '...', '')),
c AS (SELECT stage, ' ' || trim(regexp_replace(lower(regexp_replace(stage, '[^\\p{{L}}\\s]+', ' ', 'g')), '\\s+', ' ', 'g')) || ' ' AS p FROM w),
g AS (SELECT DISTINCT stage, substr(p, i, 3) AS gram FROM (SELECT stage, p, unnest(range(1, greatest(length(p) - 2, 1)::BIGINT + 1)) AS i FROM c)), z AS (SELECT stage, count(*) AS n FROM g GROUP BY 1),
pr AS (SELECT a.stage AS a, b.stage AS b, count(*) AS k FROM g a JOIN g b ON a.gram = b.gram AND a.stage < b.stage GROUP BY ALL),
ds AS (SELECT pr.a, pr.b, 1 - k / (x.n + y.n - k) AS distance FROM pr JOIN z x ON x.stage = pr.a JOIN z y ON y.stage = pr.b)"""


def _clusters(column: str, distance: float) -> str:
    links = f"SELECT a, b FROM ds WHERE distance <= {distance}"
    return f"WITH RECURSIVE {_grams(column)}, e AS ({links} UNION ALL SELECT b, a FROM ({links})), rc(v, u) AS (SELECT DISTINCT a, a FROM e UNION SELECT r.v, e.b FROM rc r JOIN e ON r.u = e.a), cl AS (SELECT v AS stage, min(u) AS cluster FROM rc GROUP BY v)"


@query("stage_clusters", _clusters("p_type", 0.425) + " SELECT w.stage, cluster FROM w LEFT JOIN cl USING (stage)")
def _(spark, d):
    return cluster.stage_clusters(table(spark, d, "part"), "p_type")


@query("similar_stages", f"WITH {_grams('p_name')} SELECT a, b, round(distance, 6) AS distance FROM ds WHERE distance <= 0.4")
def _(spark, d):
    return cluster.similar_stages(table(spark, d, "part"), "p_name", 0.4).withColumn("distance", F.round("distance", 6))


@query("stage_name_clusters", _clusters("p_name", 0.2625) + " SELECT w.stage, cluster FROM w LEFT JOIN cl USING (stage)")
def _(spark, d):
    return cluster.stage_clusters(table(spark, d, "part"), "p_name", 0.25)


@query("stage_cluster_rows", _clusters("p_name", 0.2625) + " SELECT p_partkey, cluster FROM part LEFT JOIN cl ON p_name = stage")
def _(spark, d):
    p = table(spark, d, "part")
    return cluster.with_clusters(p, "p_name", cluster.stage_clusters(p, "p_name", 0.25)).select("p_partkey", "cluster")


@query("clean_stages", "SELECT DISTINCT o_orderpriority AS stage, trim(regexp_replace(lower(regexp_replace(o_orderpriority, '[^\\p{L}\\s]+', ' ', 'g')), '\\s+', ' ', 'g')) AS cleaned FROM orders WHERE o_orderpriority NOT IN (' ', '.', '..', '...', '')")
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderpriority")
    return cluster.clean_stages(o.union(spark.createDataFrame([(None,), ("...",), (" ",), ("",)], o.schema)), "o_orderpriority")


@query("text_clusters")
def _(spark, d):
    return cluster.text_clusters(table(spark, d, "conversations").select("conv_id", "turn", "text"), "text", k=4).select("conv_id", "turn", "text_cluster")


@query("text_density")
def _(spark, d):
    return density.text_density_clusters(table(spark, d, "conversations").select(F.struct("conv_id", "turn").alias("id"), "text"), "id", "text").select("id.conv_id", "id.turn", F.struct("cluster.conv_id", "cluster.turn").alias("c"), "core").select("conv_id", "turn", F.col("c.conv_id").alias("cluster_conv"), F.col("c.turn").alias("cluster_turn"), "core")


_DENSITY = """WITH RECURSIVE p AS (SELECT c_custkey AS id, round(c_acctbal)::BIGINT AS x, c_nationkey * 400 AS y FROM customer),
n AS (SELECT a.id AS a, b.id AS b, (a.x - b.x) ** 2 + (a.y - b.y) ** 2 AS d FROM p a JOIN p b ON abs(a.x - b.x) <= 450 AND abs(a.y - b.y) <= 450 AND (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 450 ** 2),
c AS (SELECT a AS id FROM n GROUP BY 1 HAVING count(*) >= 12), e AS (SELECT n.a, n.b FROM n JOIN c ca ON ca.id = n.a JOIN c cb ON cb.id = n.b),
r AS (SELECT id, id AS root FROM c UNION SELECT e.b AS id, r.root FROM r JOIN e ON e.a = r.id WHERE r.root < e.b), l AS (SELECT id, min(root) AS cluster FROM r GROUP BY 1),
t AS (SELECT n.a AS id, arg_min(l.cluster, (n.d, n.b)) AS cluster FROM n JOIN l ON l.id = n.b GROUP BY 1)
SELECT p.id AS c_custkey, coalesce(l.cluster, t.cluster) AS cluster, l.id IS NOT NULL AS core FROM p LEFT JOIN l ON l.id = p.id LEFT JOIN t ON t.id = p.id"""


@query("density_clusters", _DENSITY)
def _(spark, d):
    placed = table(spark, d, "customer").select("c_custkey", F.round("c_acctbal").cast("long").alias("x"), (F.col("c_nationkey") * 400).alias("y"))
    return density.density_clusters(placed, "c_custkey", ["x", "y"], 450, 12)


def _named_log(spark, d) -> EventLog:
    """Orders as cases whose stages are the names of the parts."""
    rows = table(spark, d, "lineitem").join(table(spark, d, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    return EventLog(rows, "l_orderkey", "p_name", "l_shipdate", tiebreak=("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"))


_VECTORS = f"""l AS (SELECT p_name AS a, lead(p_name) OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS b FROM lineitem JOIN part ON l_partkey = p_partkey),
e AS (SELECT string_split(a, ' ') AS a, string_split(b, ' ') AS b, count(*) AS n FROM l WHERE b IS NOT NULL GROUP BY ALL),
m AS (SELECT wa, wb, sum(n) AS n FROM (SELECT wa, unnest(b) AS wb, n FROM (SELECT unnest(a) AS wa, b, n FROM e)) GROUP BY ALL),
s AS (SELECT wa AS word, 'after:' || wb AS context, n FROM m UNION ALL SELECT wb, 'before:' || wa, n FROM m),
i AS (SELECT word, context, ln(n::DOUBLE * (sum(n) OVER ()) / ((sum(n) OVER (PARTITION BY word))::DOUBLE * sum(n) OVER (PARTITION BY context))) AS weight FROM s),
k AS (SELECT * FROM i WHERE weight > 0 UNION ALL SELECT DISTINCT word, 'own:' || word, 1.0 FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM l JOIN part ON a = p_name)),
x AS (SELECT word, j, sum(CASE WHEN substr(md5(context), j, 1) < '8' THEN weight ELSE -weight END) AS x FROM k, (SELECT unnest(range(1, {transport.DIMS + 1})) AS j) GROUP BY ALL),
v AS (SELECT word, j, x / sqrt(sum(x * x) OVER (PARTITION BY word)) AS x FROM x)"""
#: The best of the two ways to move two words of equal weight onto two others.
_MOVED = f"""{_VECTORS}, c AS (SELECT p.word AS p, q.word AS q, sqrt(sum((p.x - q.x) ** 2)) AS c FROM v p JOIN v q USING (j) GROUP BY ALL),
n AS (SELECT DISTINCT p_name AS name, string_split(p_name, ' ')[1] AS f, string_split(p_name, ' ')[2] AS g FROM part JOIN l ON a = p_name),
pr AS (SELECT a.name AS a, b.name AS b, least(ff.c + gg.c, fg.c + gf.c) / 2 AS distance FROM n a JOIN n b ON a.name < b.name
  JOIN c ff ON ff.p = a.f AND ff.q = b.f JOIN c gg ON gg.p = a.g AND gg.q = b.g JOIN c fg ON fg.p = a.f AND fg.q = b.g JOIN c gf ON gf.p = a.g AND gf.q = b.f)"""


@query("word_vectors", f"WITH {_VECTORS} SELECT word, j::INT AS component, round(x, 6) AS x FROM v")
def _(spark, d):
    out = transport.word_vectors(_named_log(spark, d)).select("word", F.posexplode("vector").alias("i", "x"))
    return out.select("word", (F.col("i") + 1).alias("component"), F.round("x", 6).alias("x"))


@query("stage_transport", f"WITH {_MOVED} SELECT a, b, round(distance, 2) AS distance FROM pr WHERE distance <= 0.62")
def _(spark, d):
    return transport.transport_pairs(_named_log(spark, d), 0.62).withColumn("distance", F.round("distance", 2))


@query("stage_transport_clusters", f"WITH RECURSIVE {_MOVED}, g AS (SELECT a, b FROM pr WHERE distance <= 0.62 UNION ALL SELECT b, a FROM pr WHERE distance <= 0.62), rc(s, r) AS (SELECT name, name FROM n UNION SELECT s, g.b FROM rc JOIN g ON r = g.a) SELECT s AS stage, CASE WHEN count(*) > 1 THEN min(r) END AS cluster FROM rc GROUP BY s")
def _(spark, d):
    return transport.transport_clusters(_named_log(spark, d), 0.8)


# Quality.


@query("column_checks", "SELECT 'o_orderkey' AS \"column\", 'null_check' AS \"check\", count(*) FILTER (o_orderkey IS NULL)::DOUBLE AS value, count(*) FILTER (o_orderkey IS NULL) = 0 AS success FROM orders UNION ALL SELECT 'o_orderkey', 'unique_check', (count(o_orderkey) - count(DISTINCT o_orderkey))::DOUBLE, count(o_orderkey) = count(DISTINCT o_orderkey) FROM orders UNION ALL SELECT 'o_totalprice', 'min', min(o_totalprice), min(o_totalprice) > 0 FROM orders UNION ALL SELECT 'o_orderstatus', 'distinct_check', count(DISTINCT o_orderstatus), count(DISTINCT o_orderstatus) BETWEEN 2.7 AND 3.3 FROM orders")
def _(spark, d):
    return quality.column_checks(table(spark, d, "orders"), {"o_orderkey": {"null_check": {"equal_to": 0}, "unique_check": {"equal_to": 0}}, "o_totalprice": {"min": {"greater_than": 0}}, "o_orderstatus": {"distinct_check": {"equal_to": 3, "tolerance": 0.1}}})


@query("table_checks", "SELECT 'rows' AS \"check\", count(*) > 100 AS success FROM orders UNION ALL SELECT 'price', max(o_totalprice) < 1 FROM orders WHERE o_orderstatus = 'F'")
def _(spark, d):
    return quality.table_checks(table(spark, d, "orders"), {"rows": {"check_statement": "count(*) > 100"}, "price": {"check_statement": "max(o_totalprice) < 1", "partition_clause": "o_orderstatus = 'F'"}})


@query("interval_check", "WITH d AS (SELECT ts::DATE AS day, count(*)::DOUBLE AS n, count(DISTINCT user_id)::DOUBLE AS users FROM events GROUP BY 1), c AS (SELECT 'n' AS metric, max(n) FILTER (day = DATE '2024-01-15') AS current, max(n) FILTER (day = DATE '2024-01-08') AS reference FROM d UNION ALL SELECT 'users', max(users) FILTER (day = DATE '2024-01-15'), max(users) FILTER (day = DATE '2024-01-08') FROM d) SELECT metric, current, reference, round(greatest(current, reference) / nullif(least(current, reference), 0), 6) AS ratio, coalesce(greatest(current, reference) / nullif(least(current, reference), 0) < 1.5, false) AS success FROM c")
def _(spark, d):
    out = quality.interval_check(table(spark, d, "events"), "ts", {"n": "count(*)", "users": "count(distinct user_id)"}, "2024-01-15")
    return out.withColumn("ratio", F.round("ratio", 6))


@query("table_stats", "SELECT '' AS col, 'count' AS metric, count(*)::DOUBLE AS value FROM supplier UNION ALL SELECT 's_suppkey', 'non_null', count(s_suppkey) FROM supplier UNION ALL SELECT 's_suppkey', 'sum', sum(s_suppkey) FROM supplier UNION ALL SELECT 's_suppkey', 'min', min(s_suppkey) FROM supplier UNION ALL SELECT 's_suppkey', 'max', max(s_suppkey) FROM supplier UNION ALL SELECT 's_suppkey', 'avg', avg(s_suppkey) FROM supplier UNION ALL SELECT 's_name', 'non_null', count(s_name) FROM supplier UNION ALL SELECT 's_name', 'len', sum(length(s_name)) FROM supplier UNION ALL SELECT 's_name', 'approx_distinct', 1 UNION ALL SELECT '', 'debtors', count(*) FILTER (s_acctbal < 0) FROM supplier")
def _(spark, d):
    s = table(spark, d, "supplier")
    return quality.table_stats(s, exclude=("s_nationkey", "s_acctbal"), extra={"debtors": "count_if(s_acctbal < 0)"}).withColumn("value", F.when(F.col("metric") != "approx_distinct", F.col("value")).otherwise(F.col("value").between(s.select("s_name").distinct().count() * 0.85, s.select("s_name").distinct().count() * 1.15).cast("double")))


@query("closest_partition", "SELECT min_by(ts::DATE, (abs(date_diff('day', ts::DATE, DATE '2024-01-10')), ts::DATE)) AS closest FROM events WHERE ts::DATE <= DATE '2024-01-10'")
def _(spark, d):
    return quality.closest_partition(table(spark, d, "events"), "ts", "2024-01-10", before=True)


@query("case_sessions", "WITH o AS (SELECT user_id, ts, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 12 HOUR AS new FROM events), g AS (SELECT *, count(*) FILTER (new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM o) SELECT user_id AS case_id, min(ts) AS session_start, max(ts) + INTERVAL 12 HOUR AS session_end, count(*) AS n FROM g GROUP BY user_id, k")
def _(spark, d):
    from loomline.streaming.activity import case_progress

    out = case_progress(table(spark, d, "events"), "user_id", "event_type", "ts", "12 hours")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})


@query("date_windows", "SELECT date_trunc('day', ts) AS window_start, event_type AS activity, count(*) AS n FROM events GROUP BY ALL")
def _(spark, d):
    from loomline.streaming.activity import activity_counts

    return activity_counts(table(spark, d, "events"), "event_type", "ts").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("streamed_transitions", f"WITH {EVENTS}, m AS (SELECT epoch_ms(max(ts)) - 86400000 AS w FROM events), e AS (SELECT *, epoch_ms(lead(ts) OVER (PARTITION BY case_id ORDER BY activity_num)) AS next_ms FROM log) SELECT activity, next_activity, count(*) AS n, sum(duration_us)::BIGINT AS duration_us FROM e, m WHERE next_activity IS NOT NULL AND activity IS NOT NULL AND next_ms < w GROUP BY ALL")
def _(spark, d):
    """The log as a stream of its file; edges of the last day still wait for late events."""
    from loomline.streaming import activity

    stored = table(spark, d, "events")
    # A pattern, as a stream's path must not be one file.
    stream = spark.readStream.schema(stored.schema).parquet(f"{d}/event[s].parquet")
    edges = activity.transitions(stream, "user_id", "event_type", "ts", "event_id", late="1 day")
    done = activity.run_to_files(edges, scratch.scratch_path(spark, "streamed-edges"), scratch.scratch_path(spark, "streamed-state"))
    return done.groupBy("activity", "next_activity").agg(F.count("*").alias("n"), F.sum("duration_us").alias("duration_us"))


@query("export_by_bytes", "SELECT role, count(*) AS n, sum(strlen(text))::BIGINT AS bytes, 0::BIGINT AS over FROM conversations GROUP BY 1")
def _(spark, d):
    """What files of at most 64 KiB hold, read back; over counts files beyond the budget."""
    path = scratch.scratch_path(spark, "cut-files")
    files = io.export_by_bytes(table(spark, d, "conversations"), path, 1 << 16)
    over = files.agg(F.count_if(F.col("bytes") > (1 << 16))).scalar()
    back = spark.read.schema("conv_id long, turn long, role string, text string, file string").json(path)
    return back.groupBy("role").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).withColumn("over", over)


@query("duration_from_start", f"WITH {EVENTS}, s AS (SELECT case_id, min(ts) AS a FROM log GROUP BY 1) SELECT activity, count(*) AS n, round(avg(date_diff('microsecond', a, ts)) / 3.6e9, 4) AS mean_from_start, round(max(date_diff('microsecond', a, ts)) / 3.6e9, 4) AS max_from_start FROM log JOIN s USING (case_id) WHERE activity IS NOT NULL GROUP BY 1")
def _(spark, d):
    return metrics.duration_from_start(events(spark, d)).withColumns({c: F.round(c, 4) for c in ("mean_from_start", "max_from_start")})
