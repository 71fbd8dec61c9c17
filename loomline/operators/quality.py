"""Checks and statistics of tables: columns, statements, values, intervals, partitions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType

_CHECKS: dict[str, Callable[[str], Column]] = {
    "null_check": lambda c: F.count_if(F.col(c).isNull()),
    "distinct_check": lambda c: F.count_distinct(c),
    "unique_check": lambda c: F.count(c) - F.count_distinct(c),
    "min": lambda c: F.min(c),
    "max": lambda c: F.max(c),
}
_TESTS = {
    "greater_than": lambda v, x, t: v > x * (1 - t),
    "geq_to": lambda v, x, t: v >= x * (1 - t),
    "less_than": lambda v, x, t: v < x * (1 + t),
    "leq_to": lambda v, x, t: v <= x * (1 + t),
    "equal_to": lambda v, x, t: abs(v - x) <= abs(x) * t,
}


def column_checks(df: DataFrame, mapping: dict[str, dict[str, dict]], where: str | None = None, accept_none: bool = True) -> DataFrame:
    """(column, check, value, success) of checks such as {"id": {"null_check": {"equal_to": 0}}}.

    Conditions are greater_than, geq_to, less_than, leq_to and equal_to, loosened by the
    fraction `tolerance`. where filters the table; with accept_none a null result counts as 0.
    All checks share one aggregation.
    """
    rows = df.where(where) if where else df
    wanted = [(c, k, v) for c, checks in mapping.items() for k, v in checks.items()]
    for _, k, v in wanted:
        if k not in _CHECKS or not set(v) - {"tolerance"} or set(v) - {"tolerance", *_TESTS}:
            raise ValueError(f"bad check {k!r}: {v!r}")
    row = rows.agg(*(_CHECKS[k](c).cast("double").alias(f"v{i}") for i, (c, k, _) in enumerate(wanted))).first()
    out = []
    for i, (c, k, v) in enumerate(wanted):
        value = row[f"v{i}"]
        value = 0.0 if value is None and accept_none else value
        ok = value is not None and all(_TESTS[t](value, x, v.get("tolerance", 0.0)) for t, x in v.items() if t != "tolerance")
        out.append((c, k, value, bool(ok)))
    return df.sparkSession.createDataFrame(out, "column string, check string, value double, success boolean")


def table_checks(df: DataFrame, checks: dict[str, dict], where: str | None = None) -> DataFrame:
    """(check, success) of boolean statements over aggregates, each with a filter of its own.

    {"rows": {"check_statement": "count(*) = 1", "partition_clause": "id > 0"}}
    """
    rows = df.where(where) if where else df
    out = None
    for name, check in checks.items():
        part = rows.where(check["partition_clause"]) if check.get("partition_clause") else rows
        one = part.agg(F.coalesce(F.expr(check["check_statement"]), F.lit(False)).alias("success")).select(F.lit(name).alias("check"), "success")
        out = one if out is None else out.unionByName(one)
    return out


def row_check(df: DataFrame) -> bool:
    """Whether there is a first row and every value in it is true; 0, "" and null are not."""
    row = df.first()
    return row is not None and all(bool(v) for v in row)


def value_check(value: float, expected: float, tolerance: float = 0.0) -> bool:
    return abs(value - expected) <= abs(expected) * tolerance


def interval_check(df: DataFrame, day: str, metrics: dict[str, str], at: str, back: int = 7, thresholds: dict[str, float] | None = None, default: float = 1.5) -> DataFrame:
    """(metric, current, reference, ratio, success): metrics on a day against those `back` days before.

    metrics maps names to SQL aggregates. The ratio is the larger over the smaller value and
    must stay below the metric's threshold; null or zero values fail.
    """
    current = F.to_date(F.lit(at))
    kept = df.withColumn("_day", F.to_date(day)).filter(F.col("_day").isin(current, F.date_sub(current, back)))
    per = kept.groupBy((F.col("_day") == current).alias("_now")).agg(*(F.expr(e).cast("double").alias(n) for n, e in metrics.items()))
    long = per.selectExpr("_now", f"stack({len(metrics)}, {', '.join(f"'{n}', `{n}`" for n in metrics)}) as (metric, value)")
    both = long.groupBy("metric").agg(F.max(F.when(F.col("_now"), F.col("value"))).alias("current"), F.max(F.when(~F.col("_now"), F.col("value"))).alias("reference"))
    ratio = F.greatest("current", "reference") / F.nullif(F.least("current", "reference"), F.lit(0.0))
    limits = {n: (thresholds or {}).get(n, default) for n in metrics}
    limit = F.create_map(*(x for n, v in limits.items() for x in (F.lit(n), F.lit(float(v)))))
    missing = F.col("current").isNull() | F.col("reference").isNull()
    return both.withColumn("ratio", F.when(~missing, ratio)).withColumn("success", F.coalesce(F.col("ratio") < limit[F.col("metric")], F.lit(False)))


def table_stats(df: DataFrame, exclude: tuple[str, ...] = (), extra: dict[str, str] | None = None, per_column: Callable[[str, object], dict[str, Column]] | None = None) -> DataFrame:
    """(col, metric, value): one aggregation over the table, unpivoted.

    Row count; by column the non-null count; sum, min, max and average of numbers; true and
    false counts; total length and approximate distinct count of text. `extra` adds SQL
    aggregates, `per_column` replaces the statistics of a column.
    """

    def own(c: str, kind) -> dict[str, Column]:
        col = F.col(f"`{c}`")
        out = {"non_null": F.count(col)}
        if isinstance(kind, NumericType):
            out |= {"sum": F.sum(col), "min": F.min(col), "max": F.max(col), "avg": F.avg(col)}
        elif isinstance(kind, BooleanType):
            out |= {"true": F.count_if(col), "false": F.count_if(~col)}
        elif isinstance(kind, StringType):
            out |= {"len": F.sum(F.length(col)), "approx_distinct": F.approx_count_distinct(col)}
        return out

    aggs = [("", "count", F.count("*"))]
    for f in df.schema.fields:
        if f.name not in exclude:
            aggs += [(f.name, m, c) for m, c in (per_column or own)(f.name, f.dataType).items()]
    aggs += [("", n, F.expr(e)) for n, e in (extra or {}).items()]
    wide = df.agg(*(c.cast("double").alias(f"v{i}") for i, (_, _, c) in enumerate(aggs)))
    pairs = ", ".join(f"'{c}', '{m}', v{i}" for i, (c, m, _) in enumerate(aggs))
    return wide.selectExpr(f"stack({len(aggs)}, {pairs}) as (col, metric, value)")


def save_stats(stats: DataFrame, path: str, ds: str, table: str, partition: str) -> None:
    """Replaces the statistics of one day and table partition under path."""
    out = stats.select(F.lit(ds).alias("ds"), F.current_timestamp().alias("dttm"), F.lit(table).alias("table_name"), F.lit(partition).alias("partition_repr"), "col", "metric", "value")
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ds", "table_name", "partition_repr").parquet(path)


def sql_sensor(df: DataFrame, success: Callable | None = None, failure: Callable | None = None, fail_on_empty: bool = False) -> bool:
    """Whether the first cell is true; a failure callable that holds raises, as an empty result may."""
    row = df.first()
    if row is None:
        if fail_on_empty:
            raise RuntimeError("the query returned no rows")
        return False
    cell = row[0]
    if failure is not None and failure(cell):
        raise RuntimeError(f"the failure condition holds for {cell!r}")
    return bool(success(cell)) if success is not None else bool(cell)


def max_partition(df: DataFrame, column: str):
    return df.agg(F.max(column)).first()[0]


def closest_partition(df: DataFrame, column: str, target: str, before: bool | None = None) -> DataFrame:
    """One row (closest): the date nearest to the target, on one side of it if asked; ties to the earlier."""
    day, at = F.to_date(column), F.to_date(F.lit(target))
    kept = df if before is None else df.filter(day <= at) if before else df.filter(day >= at)
    return kept.agg(F.min_by(day, F.struct(F.abs(F.date_diff(day, at)), day)).alias("closest"))


def states_complete(df: DataFrame, state: str, states: list[str], date: str, dates: list[str], tasks: int = 1) -> bool:
    """Whether all dates have `tasks` rows each in the allowed states."""
    n = df.filter(F.col(state).isin(states) & F.to_date(date).cast("string").isin(dates)).count()
    return n / tasks == len(dates)
