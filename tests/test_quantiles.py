"""Quantiles by splitters against numpy, and against one sort a group."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomline.eventlog import EventLog
from loomline.operators import metrics, outliers, quantiles

SHARES = {"a": 0.0, "b": 0.05, "c": 0.25, "d": 0.5, "e": 0.95, "f": 1.0}


def wanted(values, p, interpolated):
    v = sorted(values)
    if not interpolated:
        return v[min(int(p * len(v)), len(v) - 1)]
    at = p * (len(v) - 1)
    low = int(np.floor(at))
    return v[low] + (v[min(low + 1, len(v) - 1)] - v[low]) * (at - low)


@pytest.fixture
def sketched(monkeypatch):
    monkeypatch.setattr(quantiles, "ONE_TASK", -1)


@pytest.mark.parametrize(("few", "slack"), [(200, 0.01), (4000, quantiles.SLACK)])
@pytest.mark.parametrize("interpolated", [True, False])
def test_groups_of_all_kinds(spark, sketched, monkeypatch, few, slack, interpolated):
    monkeypatch.setattr(quantiles, "FEW", few)
    monkeypatch.setattr(quantiles, "SLACK", slack)
    rnd = random.Random(1)
    kinds = {"ties": lambda: rnd.choice([1, 1, 1, 2]), "signs": lambda: rnd.randint(-50, 50), "wide": lambda: rnd.choice([-1, 1]) * 10 ** rnd.randint(0, 15), "one": lambda: 7, None: lambda: rnd.randint(0, 9)}
    rows = [(k, rnd.choice([f() for _ in range(9)] + [None])) for k, f in kinds.items() for _ in range(1 if k == "one" else 700)]
    rows += [("empty", None)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(5)
    out = {r.k: r for r in quantiles.exact_quantiles(df, ["k"], "v", SHARES, interpolated).collect()}
    assert set(out) == set(kinds)
    for k in kinds:
        own = [v for g, v in rows if g == k and v is not None]
        for n, p in SHARES.items():
            assert out[k][n] == pytest.approx(wanted(own, p, interpolated), rel=1e-12), (k, n)
    whole = quantiles.exact_quantiles(df, [], "v", SHARES, interpolated).collect()
    assert [whole[0][n] for n in SHARES] == [pytest.approx(wanted([v for _, v in rows if v is not None], p, interpolated), rel=1e-12) for p in SHARES.values()]
    assert quantiles.exact_quantiles(df.limit(0), ["k"], "v", SHARES, interpolated).count() == 0


def test_slices_stay_thin_for_clustered_values(spark, sketched):
    """10^6 values within 0.1 % of each other and one far away: no slice holds a tenth of them."""
    n = 1_000_000
    base = 1_700_000_000_000_000
    df = spark.range(n, numPartitions=8).select(F.lit("x").alias("k"), (F.lit(base) + F.pmod(F.xxhash64("id"), F.lit(base // 1000))).alias("v")).union(spark.createDataFrame([("x", 0)], "k string, v long"))
    ends = quantiles.splitters(df, ["k"], "v", [0.25, 0.5]).first()
    assert ends._n == n + 1
    for low, high in zip(ends._e[::2], ends._e[1::2], strict=True):
        assert df.filter(F.col("v").cast("double").between(low, high)).count() < n / 500
    v = np.sort(np.array([r.v for r in df.select("v").toLocalIterator()]))
    out = quantiles.exact_quantiles(df, ["k"], "v", {"q": 0.25, "m": 0.5}, interpolated=False).first()
    assert (out.q, out.m) == (v[int(0.25 * (n + 1))], v[int(0.5 * (n + 1))])


def test_both_ways_agree(spark, monkeypatch):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 80), rnd.choice(["a", "b", "c", None]), f"2024-01-{rnd.randint(1, 28):02d} 10:00:{rnd.randint(0, 59):02d}", i, rnd.choice(["u", "v", None])) for i in range(1500)]
    df = spark.createDataFrame(rows, "c long, a string, t string, n long, u string").withColumn("t", F.col("t").cast("timestamp"))
    log = EventLog(df, "c", "a", "t", user="u", tiebreak=("n",))

    def all_rows():
        out = {k: sorted(map(str, f(log, digits=4).apply().collect())) for k, f in metrics.FAMILIES.items()}
        numbered = log.base()
        out["quantile"] = sorted(map(str, outliers.quantile_activity(numbered, "case_id", "activity_num", "activity", "duration_us").collect()))
        out["iqr"] = sorted(map(str, outliers.iqr_case(numbered, "case_id", "duration_us").collect()))
        return out

    one = all_rows()
    monkeypatch.setattr(quantiles, "ONE_TASK", -1)
    assert all_rows() == one
    monkeypatch.setattr(quantiles, "FEW", 100)
    monkeypatch.setattr(quantiles, "SLACK", 0.02)
    assert all_rows() == one


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_task_holds_a_group(spark, sketched, monkeypatch):
    """Bounds are broadcast whatever Spark's own threshold, and no aggregation sorts the rows."""
    df = spark.range(9000).select("id", (F.col("id") % 7).cast("int").alias("num"), F.concat(F.lit("g"), F.col("id") % 3).alias("act"), F.pmod(F.xxhash64("id"), F.lit(1000)).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = outliers.quantile_activity(df, "id", "num", "act", "v")
        assert "BroadcastHashJoin" in plan(found) and "SortMergeJoin" not in plan(found)
        assert "SortAggregate" not in plan(quantiles.exact_quantiles(df, ["act"], "v", {"m": 0.5}))
        assert 0 < found.count() < 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
