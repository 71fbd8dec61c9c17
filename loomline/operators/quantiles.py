"""Exact quantiles by group from two passes: a sketch cuts each group, then a thin slice is sorted.

The first pass builds a mergeable quantile sketch for every group, map-side, and reads off
two splitters around each wanted place. The second counts what lies below a slice and
keeps, of the values in it, one row for each different one. So no task holds more of a group than the
share of its rows between two splitters, whatever the range or the shape of its values.

Tables that are estimated to fit in one task anyway are sorted by group in one aggregation,
as Spark chooses between joins; the rows are the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.sources.scratch import estimated_bytes, small, written

#: A sketch misses a place by n / ACCURACY at most; splitters stand SLACK of n to both sides.
ACCURACY = 10_000
SLACK = 5 / ACCURACY
#: Bytes of a whole table, by Spark's estimate, up to which a group may be sorted in one task.
ONE_TASK = 64 << 20
#: Groups of so many values are one slice. FEW * SLACK is 2: places are whole, shares are not.
FEW = 4_000


def _same(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """An inner join on columns of equal names, where null equals null."""
    other = right.select(*(F.col(c).alias(f"{c}_") for c in on), *(c for c in right.columns if c not in on))
    return left.join(other, [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in on]).drop(*(f"{c}_" for c in on))


def fits_one_task(df: DataFrame) -> bool:
    return estimated_bytes(df) <= ONE_TASK


def splitters(values: DataFrame, keys: list[str], value: str, shares: list[float]) -> DataFrame:
    """(keys, _n, _e): the number of non-null values of each group and, for each share, two splitters around it."""
    x = F.col(value).cast("double")
    ends = [e for p in shares for e in (max(0.0, p - SLACK), min(1.0, p + SLACK))]
    out = values.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx(x, ends, ACCURACY).alias("_e"), F.min(x).alias("_min"), F.max(x).alias("_max"))
    whole = F.array(*(F.col(c) for _ in shares for c in ("_min", "_max")))
    return out.select(*keys, "_n", F.when(F.col("_n") <= FEW, whole).otherwise(F.col("_e")).alias("_e"))


def _place(p: float, interpolated: bool) -> Column:
    """The place of a share among the _n values of a group, from 0."""
    return F.lit(float(p)) * (F.col("_n") - 1) if interpolated else F.least(F.floor(F.lit(float(p)) * F.col("_n")), F.col("_n") - 1)


def _by_sorted_groups(values: DataFrame, keys: list[str], named: list[str], shares: dict[str, float], interpolated: bool) -> DataFrame:
    groups = values.groupBy(*named).agg(F.array_sort(F.collect_list("_v")).alias("_a")).withColumn("_n", F.size("_a"))
    columns = []
    for n, p in shares.items():
        at = _place(p, interpolated)
        low, high = (F.get("_a", f(at).cast("int")) for f in (F.floor, F.ceil))
        columns.append((low + (high - low) * (at - F.floor(at)) if interpolated else low).alias(n))
    return groups.select(*(F.col(n).alias(k) for k, n in zip(keys, named, strict=True)), *columns)


def exact_quantiles(df: DataFrame, keys: list[str], value: str, shares: dict[str, float], interpolated: bool = True) -> DataFrame:
    """(keys, one column per name of shares): quantiles of the non-null values of each group.

    Of n sorted values, counted from 0, an interpolated quantile p lies at p * (n - 1), between
    two values by their distance; else it is the value at floor(p * n), or the last one.
    Groups without values have no row; a group with a null key is a group. df is read twice,
    the first time at once: one that is costly to make should be written before.
    """
    if not keys:
        return exact_quantiles(df.withColumn("_all", F.lit(0)), ["_all"], value, shares, interpolated).drop("_all")
    named = [f"_q_{i}" for i in range(len(keys))]
    values = df.select(*(F.col(k).alias(n) for k, n in zip(keys, named, strict=True)), F.col(value).alias("_v")).filter("_v IS NOT NULL")
    if fits_one_task(df):
        return _by_sorted_groups(values, keys, named, shares, interpolated)
    ends = small(written(splitters(values, named, "_v", list(shares.values())), "splitters"))

    def between(c: str, i: int) -> Column:
        return F.col(c).cast("double").between(F.col("_e")[2 * i], F.col("_e")[2 * i + 1])

    many = range(len(shares))
    inside = F.lit(False)
    for i in many:
        inside = inside | between("_v", i)
    slices = _same(values, ends, named).select(*named, F.when(inside, F.col("_v")).alias("_w"), *((F.col("_v").cast("double") < F.col("_e")[2 * i]).cast("long").alias(f"_u{i}") for i in many))
    # All values outside of the slices are one row. The splitters, arrays, would make Spark sort all rows for this; they are joined again.
    slices = _same(slices.groupBy(*named, "_w").agg(F.count(F.lit(1)).alias("_k"), *(F.sum(f"_u{i}").alias(f"_u{i}") for i in many)), ends, named)
    group = Window.partitionBy(*named)
    upto = group.orderBy("_w").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = {i: F.coalesce(between("_w", i), F.lit(False)) for i in many}
    slices = slices.withColumns({f"_b{i}": F.sum(f"_u{i}").over(group) for i in many} | {f"_t{i}": F.sum(F.when(held[i], F.col("_k")).otherwise(0)).over(upto) for i in many})
    aggregates = []
    for i, p in enumerate(shares.values()):
        at = _place(p, interpolated)
        low, high = F.floor(at), F.ceil(at)
        found = lambda place: F.min(F.when(held[i] & (F.col(f"_b{i}") <= place) & (F.col(f"_b{i}") + F.col(f"_t{i}") > place), F.col("_w")))  # noqa: B023, E731
        aggregates += [found(low).alias(f"_l{i}"), found(high).alias(f"_h{i}"), F.first(at - low).alias(f"_s{i}")]
    out = slices.groupBy(*named).agg(*aggregates)

    def sure(c: str) -> Column:
        return F.when(F.col(c).isNull(), F.raise_error(F.lit("a quantile lies outside of its splitters"))).otherwise(F.col(c))

    columns = [(sure(f"_l{i}") + (sure(f"_h{i}") - F.col(f"_l{i}")) * F.col(f"_s{i}") if interpolated else sure(f"_l{i}")).alias(n) for i, n in enumerate(shares)]
    return out.select(*(F.col(n).alias(k) for k, n in zip(keys, named, strict=True)), *columns)
