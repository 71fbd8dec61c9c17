import datetime as dt

import pytest
from pyspark.sql import functions as F

from loomline.eventlog import EventLog, unit_us
from loomline.operators import metrics

ROWS = [
    ("c1", "A", "2024-01-01 00:00", "u1"), ("c1", "B", "2024-01-01 01:00", "u2"), ("c1", "C", "2024-01-01 03:00", "u1"),
    ("c2", "A", "2024-01-01 00:30", "u1"), ("c2", "B", "2024-01-01 02:30", "u2"), ("c2", "B", "2024-01-01 03:00", "u2"), ("c2", "C", "2024-01-01 06:00", "u3"),
    ("c3", "A", "2024-01-02 00:00", "u2"), ("c3", "B", "2024-01-02 01:00", "u2"), ("c3", "C", "2024-01-02 03:00", "u3"),
]


@pytest.fixture(scope="module")
def log(spark):
    df = spark.createDataFrame(ROWS, "case string, act string, t string, user string").selectExpr("case", "act", "to_timestamp(t) ts", "user")
    return EventLog(df, "case", "act", "ts", user="user")


def rows(df, *key):
    return {tuple(r[k] for k in key) if len(key) > 1 else r[key[0]]: r.asDict() for r in df.collect()}


def test_activity(log):
    out = rows(metrics.ActivityMetrics(log, digits=6).apply(), "activity")
    assert (out["B"]["count"], out["B"]["unique_ids_num"], out["B"]["loop_percent"], out["B"]["unique_users_num"]) == (4, 3, 25.0, 1)
    assert (out["B"]["total_duration"], out["B"]["mean_duration"], out["B"]["median_duration"], out["B"]["std_duration"]) == (7.5, 1.875, 2.0, 0.892679)
    assert out["B"]["variance_duration"] == 2868.75
    assert out["C"]["total_duration"] == 0 and out["C"]["mean_duration"] is None and out["C"]["throughput"] is None


def test_transition(log):
    out = rows(metrics.TransitionMetrics(log).apply(), "activity", "next_activity")
    assert {k: (v["count"], v["unique_ids_num"], v["total_duration"]) for k, v in out.items()} == {("A", "B"): (3, 3, 4.0), ("B", "B"): (1, 1, 0.5), ("B", "C"): (3, 3, 7.0)}


def test_case_and_variant(log):
    out = rows(metrics.CaseMetrics(log).apply(), "case_id")
    assert out["c2"]["trace"] == ["A", "B", "B", "C"] and out["c2"]["loop_percent"] == 25.0 and out["c2"]["total_duration"] == 5.5 and out["c2"]["median_duration"] == 2.0
    variants = {tuple(r["trace"]): (r["count"], r["ids"]) for r in metrics.VariantMetrics(log).calc("count", "ids").collect()}
    assert variants == {("A", "B", "C"): (2, ["c1", "c3"]), ("A", "B", "B", "C"): (1, ["c2"])}


def test_user(log):
    out = rows(metrics.UserMetrics(log).apply(), "user")
    assert {k: (v["count"], v["unique_activities_num"], v["unique_ids_num"], v["total_duration"], v["workload"]) for k, v in out.items()} == {
        "u1": (3, 2, 2, 3.0, 0.3), "u2": (5, 2, 3, 8.5, 0.5), "u3": (2, 1, 2, 0.0, 0.2),
    }


def test_calc_names(log):
    family = metrics.ActivityMetrics(log)
    with pytest.raises(ValueError):
        family.calc("count", "nonsense")
    assert family.calc("count", "nonsense", strict=False).columns == ["activity", "count"]
    assert family.calc().columns == ["activity"]
    assert family.calc("count").explain is not None


def test_inclusion_rate(log):
    out = rows(metrics.ActivityMetrics(log).success_rate(["C"]), "activity")
    assert {v["success_rate"] for v in out.values()} == {1.0}
    none = rows(metrics.ActivityMetrics(log).failure_rate(["Z"]), "activity")
    assert {v["failure_rate"] for v in none.values()} == {0.0}


def test_errors(spark, log):
    with pytest.raises(ValueError):
        unit_us("fortnight")
    with pytest.raises(ValueError):
        EventLog(log.df, "case", "act")
    with pytest.raises(ValueError):
        EventLog(log.df, "case", "missing", "ts")
    with pytest.raises(ValueError):
        metrics.UserMetrics(EventLog(log.df, "case", "act", "ts"))


def test_edge_cases(spark):
    schema = "case string, act string, a timestamp, b timestamp, n int"
    t = dt.datetime(2024, 1, 1)
    empty = EventLog(spark.createDataFrame([], schema), "case", "act", "a")
    assert metrics.ActivityMetrics(empty).apply().count() == 0
    odd = [("x", "A", t, t - dt.timedelta(hours=1), 1), (None, "A", t, t, 2), ("y", None, t, t, 3), ("z", "B", t, t, 4), ("z", "C", t, t, 5)]
    df = spark.createDataFrame(odd, schema)
    both = rows(metrics.ActivityMetrics(EventLog(df, "case", "act", "a", "b", tiebreak=("n",))).apply(), "activity")
    assert both["A"]["min_duration"] == -1.0 and set(both) == {"A", "B", "C"}
    ends = EventLog(df, "case", "act", end="b", tiebreak=("n",))
    assert rows(metrics.ActivityMetrics(ends).apply(), "activity")["B"]["mean_duration"] is None
    assert rows(ends.base().filter("case_id = 'z'"), "activity")["B"]["next_activity"] == "C"


def test_enriched(log):
    out = rows(log.enriched().filter("case = 'c2'"), "activity_num")
    assert [out[i]["rework_num"] for i in (1, 2, 3, 4)] == [0, 0, 1, 0]
    assert out[1]["variant"] == "A>B>B>C" and out[4]["is_last"] and out[1]["transition_cnt"] == 3 and out[1]["case_duration_us"] == 19_800_000_000


def test_exact_quantiles_match_sorting(spark):
    import math
    import random

    from loomline.operators.quantiles import exact_quantiles

    rng = random.Random(3)
    rows = [(rng.choice("abc"), None if rng.random() < 0.05 else rng.choice((rng.uniform(-5, 5), rng.lognormvariate(0, 8), -1e12, 0.0, 3.0))) for _ in range(3000)]
    rows += [("one", 7.5), ("none", None), (None, 1.0), (None, 2.0), ("same", 4.0), ("same", 4.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    shares = {"a": 0.0, "b": 0.05, "c": 0.5, "d": 0.95, "e": 1.0}
    groups = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault(k, []).append(v)
    between = {r.k: r for r in exact_quantiles(df, ["k"], "v", shares).collect()}
    at = {r.k: r for r in exact_quantiles(df, ["k"], "v", shares, interpolated=False).collect()}
    assert set(between) == set(at) == set(groups)
    for k, values in groups.items():
        values.sort()
        n = len(values)
        for name, p in shares.items():
            x = p * (n - 1)
            low, high = values[math.floor(x)], values[math.ceil(x)]
            assert between[k][name] == pytest.approx(low + (high - low) * (x - math.floor(x)))
            assert at[k][name] == values[min(math.floor(p * n), n - 1)]
    whole = exact_quantiles(df, [], "v", {"m": 0.5}).first().m
    assert whole == pytest.approx(sorted(v for _, v in rows if v is not None)[(sum(v is not None for _, v in rows) - 1) // 2], rel=0.2)
    assert exact_quantiles(df.limit(0), ["k"], "v", shares).count() == 0


def test_variant_users_and_fields(log):
    out = {tuple(r.trace): r for r in metrics.VariantMetrics(log).calc("unique_users", "median_duration", "count", "unique_users_num").collect()}
    assert out["A", "B", "C"].unique_users == ["u1", "u2", "u3"] and out["A", "B", "C"].unique_users_num == 3 and out["A", "B", "C"]["count"] == 2
    late = log.with_fields(late="case when hour(ts) >= 2 then 'yes' else 'no' end")
    assert {r.late for r in late.df.filter("act = 'C'").collect()} == {"yes"} and late.case == log.case


def long_log(spark, n, days, kinds=1):
    """n cases of two events each, so many days apart, of one user."""
    start = F.lit("0001-01-01").cast("date").cast("timestamp")
    df = spark.range(n, numPartitions=4).select(F.col("id").alias("case"), F.explode(F.array(F.lit(0), F.lit(1))).alias("i"))
    df = df.select("case", F.concat(F.lit("A"), (F.col("case") % kinds).cast("string")).alias("act"), F.timestamp_add("DAY", F.col("i") * F.lit(days), start).alias("ts"), F.lit("u").alias("user"))
    return EventLog(df, "case", "act", "ts", user="user")


@pytest.mark.parametrize("family", ["activity", "transition", "user", "variant"])
def test_totals_beyond_64_bits(spark, family):
    """200 durations of 9 000 years are more microseconds than a long holds."""
    days, n = 3_287_000, 200
    assert n * days * 86_400_000_000 > 2**63
    out = metrics.FAMILIES[family](long_log(spark, n, days)).apply().collect()
    assert [(r.total_duration, r.mean_duration) for r in out] == [(n * days * 24.0, days * 24.0)]


@pytest.mark.parametrize("call", [lambda m, log: m.UserMetrics(log, digits=6).inclusion_rate(["C"]), lambda m, log: m.TransitionMetrics(log, digits=6).inclusion_rate(["A"]), lambda m, log: m.UserMetrics(log, digits=6).apply()])
def test_dealt_by_case(spark, log, monkeypatch, call):
    """A log of many parts is dealt in as many, counts its cases there, and gives the same rows."""
    from loomline import eventlog

    left = sorted(map(str, call(metrics, log).collect()))
    monkeypatch.setattr(eventlog, "PART_BYTES", 8)
    monkeypatch.setattr(eventlog, "MOST_PARTS", 10**9)
    out = call(metrics, EventLog(log.df.limit(99), "case", "act", "ts", user="user"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "distinct case_id" not in plan
    monkeypatch.undo()
    monkeypatch.setattr(EventLog, "by_case", property(lambda self: self.df.repartition(7, self.case)))
    assert sorted(map(str, call(metrics, log).collect())) == left
