import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomline.eventlog import EventLog
from loomline.operators import cluster, factors, happypath, insights, outliers, quality, series
from test_metrics import ROWS


@pytest.fixture(scope="module")
def log(spark):
    df = spark.createDataFrame(ROWS, "case string, act string, t string, user string").selectExpr("case", "act", "to_timestamp(t) ts", "user")
    return EventLog(df, "case", "act", "ts", user="user")


def values(spark, xs, extra=()):
    return spark.createDataFrame([(i, i, "g", None if x is None else float(x)) for i, x in enumerate([*xs, *extra])], "case long, num int, act string, x double")


def flagged(df):
    return sorted(r.case_id for r in df.collect())


def test_quantile_rule(spark):
    df = values(spark, [1.0, 2, 3, 4, 5, 6, 7, 8, 9, 100])
    shares = outliers.element_at_share(df, ["act"], "x", {"a": 0.05, "b": 0.25, "c": 0.75, "d": 0.95}).first()
    assert (shares.a, shares.b, shares.c, shares.d) == (1, 3, 8, 100)
    args = (df, "case", "num", "act", "x")
    assert flagged(outliers.quantile_activity(*args, detector=outliers.Detector(0.05, 0.95, 5))) == []
    assert flagged(outliers.iqr_activity(*args, min_rows=5)) == [9]
    assert flagged(outliers.iqr_activity(*args, min_rows=11)) == []
    with_null = (values(spark, [1.0, 2, 3, 4, 5, 6, 7, 8, 9, 10], [None]), *args[1:])
    assert flagged(outliers.iqr_activity(*with_null, min_rows=5)) == [10]
    assert flagged(outliers.iqr_case(df.drop("num", "act"), "case", "x", min_rows=5)) == [9]


def test_detector_bounds():
    with pytest.raises(ValueError):
        outliers.Detector(0.9, 0.1)
    with pytest.raises(ValueError):
        outliers.Detector(min_rows=-1)


def test_density(spark):
    rng = np.random.default_rng(1)
    xs = [int(x) for x in rng.integers(0, 400, 150)] + [1000, 1001, -50]
    df = spark.createDataFrame([(x, "a") for x in xs], "x long, k string")
    near = lambda a, b: abs(a - b) <= 7
    core = [x for x in xs if sum(near(x, y) for y in xs) >= 4]
    want = sorted(x for x in xs if not any(near(x, c) for c in core))
    assert sorted(r.x for r in outliers.density_noise(df, "x", 7, 4, ["k"]).collect()) == want


def test_ratios(log):
    got = {r.activity: round(r.mean_median_ratio, 6) for r in insights.mean_median_ratio(log).collect()}
    assert got == {"A": 1.333333, "B": 0.9375, "C": 1.0}
    got = {r.activity: round(r.bisect_ratio, 6) for r in insights.bisect_ratio(log).collect()}
    assert got == {"A": 0.666667, "B": 1.090909, "C": 1.0}


def test_pivots(log):
    out = {r.case_id: r for r in insights.pivot(log, "recycles").collect()}
    assert out["c2"].B == 1 and out["c1"].B == 0
    with pytest.raises(ValueError):
        insights.pivot(log, "nonsense")


def test_node_series(log):
    out = {(str(r.period), r.activity): r.probability for r in series.node_series(log, floor=True).collect()}
    assert out["2024-01-01", "B"] == pytest.approx(3 / 7) and out["2024-01-02", "B"] == pytest.approx(1 / 3)


def test_forecast_follows_a_trend(spark):
    rows = [(f"2024-01-{d:02d}", "A", float(d)) for d in range(1, 29)]
    df = spark.createDataFrame(rows, "p string, activity string, probability double").selectExpr("to_date(p) period", "activity", "probability")
    out = [r.forecast for r in series.forecast(df, ["activity"], steps=3, normalise=False).orderBy("period").collect()]
    assert out == pytest.approx([29, 30, 31], abs=0.5)


def test_value_iteration_is_a_fixed_point(log):
    edges = happypath.rewards(log)
    assert happypath.inconsistent(happypath.actions(edges)).isEmpty()
    v = {r.activity: r.value for r in happypath.value_iteration(edges, tolerance=1e-9).collect()}
    table = happypath.actions(edges).toPandas()
    table["q"] = table["probability"] * (table["reward"] + 0.9 * table["next_activity"].map(v))
    best = table.groupby(["activity", "action"])["q"].sum().groupby("activity").max()
    assert all(v[a] == pytest.approx(q, abs=1e-6) for a, q in best.items())
    assert [r.activity for r in happypath.best_path(edges).orderBy("step").collect()][0] == "start"
    joins = {r.activity: (r.value, r.action) for r in happypath.value_iteration(edges, tolerance=1e-9, on_driver=2).collect()}
    driver = {r.activity: (r.value, r.action) for r in happypath.value_iteration(edges, tolerance=1e-9).collect()}
    assert joins.keys() == driver.keys() and all(joins[k][1] == driver[k][1] and joins[k][0] == pytest.approx(driver[k][0], abs=1e-6) for k in joins)
    assert happypath.value_iteration(edges.limit(0)).count() == 0


def test_layers_go_on_at_the_key_node(spark):
    """Cases with one, two and four visits of B; layer 3 has none."""
    cases = ["ABC", "ABC", "ABBC", "ABABABABC", "AC"]
    rows = [(c, x, i) for c, trace in enumerate(cases) for i, x in enumerate(trace)]
    log = EventLog(spark.createDataFrame(rows, "c long, a string, n long").withColumn("t", F.timestamp_seconds(F.col("n") * 60)), "c", "a", "t", tiebreak=("n",))
    edges = happypath.layered_edges(log, "B", short_path=1, penalty=0.25)
    moves = {(r.layer, r.activity, r.next_activity): (r.next_layer, r.reward) for r in edges.collect()}
    assert moves[0, "A", "B"][0] == 1 and moves[1, "A", "B"][0] == 2 and moves[2, "B", "B"][0] == 4 and moves[4, "A", "B"][0] == 4
    assert moves[0, "A", "C"][0] == 0 and moves[0, "A", "B"][1] == 1 and moves[2, "B", "B"][1] == -0.25
    solved = {(r.layer, r.activity): r for r in happypath.solve_layers(edges, tolerance=1e-10).collect()}
    worth = lambda k: sum(r.probability * (r.reward + 0.9 * solved[r.next_layer, r.next_activity].value) for r in edges.collect() if (r.layer, r.activity) == k)
    best = lambda k: max(r.reward + 0.9 * solved[r.next_layer, r.next_activity].value for r in edges.collect() if (r.layer, r.activity) == k)
    for k, r in solved.items():
        assert r.value == pytest.approx((worth(k) + 0.3 * best(k)) / 1.3 if r.action else 0, abs=1e-8)
    path = [tuple(r) for r in happypath.best_layered_path(edges).orderBy("step").collect()]
    assert path[0] == (0, 0, "start") and path[2] == (2, 1, "B") and path == [tuple(r) for r in happypath.best_layered_path(edges, on_driver=0, tolerance=1e-2).orderBy("step").collect()]
    whole = happypath.layered_edges(log, "B", "initial")
    assert {(r.layer, r.next_layer) for r in whole.collect()} == {(0, 0)}
    with pytest.raises(ValueError, match="mode"):
        happypath.layered_edges(log, "B", "other")


def test_normal_equations_match_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3))
    y = x @ [1.0, -2.0, 0.5] + 3 + rng.normal(size=200) * 0.01
    df = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y, strict=True)], "a double, b double, c double, y double")
    m = factors.moments(df, ["a", "b", "c"], "y")[0]
    w, b = factors.solve(m, [0, 1, 2], 1e-9)
    assert [*w, b] == pytest.approx([1, -2, 0.5, 3], abs=0.01)
    assert factors.r2(m, [0, 1, 2], w, b) > 0.999


def test_importances_find_the_factor(spark):
    rows = [(i, "ab"[i % 2], i * 7 % 13, float(i % 2 * 5 + (i * 7 % 13) * 0.01)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, kind string, noise int, y double")
    out = {r.feature: r for r in factors.importances(df, "y", ["kind", "noise"], "id").collect()}
    assert out["kind"].score > out["noise"].score and out["other"].score < 5
    with pytest.raises(ValueError):
        factors.check_arguments(df, "y", [])
    with pytest.raises(ValueError):
        factors.check_arguments(df, "y", ["y"])


def test_stage_clusters(spark):
    names = ["check invoice", "check invoices 2", "approve payment", "approve payments", "ship", ".", None]
    df = spark.createDataFrame([(n,) for n in names], "s string")
    out = {r.stage: r.cluster for r in cluster.stage_clusters(df, "s", 0.4).collect()}
    assert out == {"check invoice": "check invoice", "check invoices 2": "check invoice", "approve payment": "approve payment", "approve payments": "approve payment", "ship": None}


def test_quality(spark):
    df = spark.createDataFrame([(1, "a", "2017-04-24"), (2, None, "2017-04-25"), (2, "", "2017-04-28")], "id int, s string, d string")
    out = {(r.column, r.check): (r.value, r.success) for r in quality.column_checks(df, {"id": {"unique_check": {"equal_to": 0}, "min": {"geq_to": 1}}, "s": {"null_check": {"leq_to": 1}}}).collect()}
    assert out == {("id", "unique_check"): (1.0, False), ("id", "min"): (1.0, True), ("s", "null_check"): (1.0, True)}
    assert not quality.row_check(df.filter("s = ''")) and quality.value_check(10, 11, 0.1)
    near = lambda before: str(quality.closest_partition(df, "d", "2017-04-26", before).first().closest)
    assert (near(True), near(False), near(None)) == ("2017-04-25", "2017-04-28", "2017-04-25")
    assert quality.sql_sensor(df) and not quality.sql_sensor(df.limit(0))
    with pytest.raises(RuntimeError):
        quality.sql_sensor(df.limit(0), fail_on_empty=True)
    with pytest.raises(ValueError):
        quality.column_checks(df, {"id": {"nonsense": {"equal_to": 0}}})


def test_models_by_name(log):
    from loomline.plans import runner

    assert [runner.truth(x) for x in ("Yes", "off", True, "1")] == [True, False, True, True]
    for bad in ("maybe", None):
        with pytest.raises(ValueError):
            runner.truth(bad)
    assert runner.coerced("['a', \"b\"]", list) == ["a", "b"] and runner.coerced("3", int) == 3 and runner.coerced("'x'", str) == "x"
    out = {r.activity: r for r in runner.run_model("metrics", log, {"names": "count, unique_users"}).collect()}
    assert out["B"]["count"] == 4 and out["B"].unique_users == "u2"
    with pytest.raises(ValueError):
        runner.run_model("nonsense", log)
    with pytest.raises(ValueError):
        runner.run_model("metrics", log, {"nonsense": 1})


def test_moments_and_scores_match_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 4)) @ rng.normal(size=(4, 4)) + 2
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "k long, a double, b double, c double, d double").repartition(5)
    parts = factors.moments(df, ["a", "b", "c"], "d", F.pmod("k", F.lit(3)))
    for f, (n, s, p) in parts.items():
        own = x[np.arange(300) % 3 == f]
        assert n == len(own) and s == pytest.approx(own.sum(axis=0)) and p == pytest.approx(own.T @ own)
    got = {r.activity: r for r in insights.problem_scores(df, "k").collect()}
    given = np.diag(x.mean(axis=0))
    for t in range(4):
        rest = [i for i in range(4) if i != t]
        a = np.concatenate((x[:, rest], np.ones((300, 1))), axis=1)
        w = np.linalg.lstsq(a, x[:, t], rcond=None)[0]
        given[rest, t] = w[:3] * (x[0, rest] - x[:, rest].mean(axis=0))
    score = given @ (x.sum(axis=0) / x.sum())
    assert [got[c].problem_score for c in "abcd"] == pytest.approx(score / np.abs(score).max(), abs=1e-6)
    assert insights.problem_scores(df.limit(0), "k").count() == 0
    best = [r.feature for r in factors.k_best(df, "d", ["a", "b", "c"], 0.7).orderBy("rank").collect()]
    assert best == sorted("abc", key=lambda c: -np.corrcoef(x[:, "abc".index(c)], x[:, 3])[0, 1] ** 2)[:2]


def test_extended_blend(spark):
    rows = [(i, "ab"[i % 2], i * 7 % 13, float(i % 2 * 5 + (i * 7 % 13) * 0.01)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, kind string, noise int, y double")
    out = {r.feature: r for r in factors.importances(df, "y", ["kind", "noise"], "id", extended=True).collect()}
    k = out["kind"]
    c = 0 if min(r.r2_drop for f, r in out.items() if f != "other") <= 0 else 9
    assert k.score == pytest.approx((c * k.r2_drop + k.ridge + 4 * k.shap + 4 * k.permutation) / (c + 9)) and k.permutation > 99
    dropped, _ = factors.encode(df.union(df.limit(1).withColumn("y", F.lit(None).cast("double"))), "y", ["kind", "noise"], drop_null=True)
    assert dropped.count() == 300
    share = df.select(factors.hash_split(F.col("id")).cast("int").alias("t")).agg(F.avg("t")).first()[0]
    assert 0.15 < share < 0.35


def test_similar_stages_match_all_pairs(spark):
    import itertools
    import random

    rng = random.Random(6)
    names = sorted({" ".join("".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 4))) for _ in range(120)})
    grams = {}
    for n in names:
        p = f" {n} "
        grams[n] = {p[i : i + 3] for i in range(max(1, len(p) - 2))}
    df = spark.createDataFrame([(n,) for n in names], "s string")
    for limit in (0.1, 0.45, 0.75):
        want = {(a, b) for a, b in itertools.combinations(names, 2) if 1 - len(grams[a] & grams[b]) / len(grams[a] | grams[b]) <= limit}
        assert {(r.a, r.b) for r in cluster.similar_stages(df, "s", limit).collect()} == want
    edges = spark.createDataFrame([(f"n{i:03}", f"n{i + 1:03}") for i in range(60)] + [("x", "y")], "a string, b string")
    out = {r.stage: r.cluster for r in cluster.components(edges).collect()}
    assert {v for k, v in out.items() if k.startswith("n")} == {"n000"} and out["y"] == "x"


def test_text_cluster_options(spark):
    df = spark.createDataFrame([(w,) for w in ["red apple fruit", "green apple fruit", "fast car engine", "slow car engine"] * 5] + [(None,)], "t string")
    out = cluster.text_clusters(df, "t", k=2, dimension=2, kind="bisecting", only_unique=True).collect()
    assert len(out) == 21 and len({r.text_cluster for r in out if r.t == "red apple fruit"}) == 1
    with pytest.raises(ValueError):
        cluster.text_clusters(df, "t", kind="nonsense")


def test_outputs_and_plans(log):
    with pytest.raises(ValueError):
        insights.insight_output(log, "nonsense")
    plan = series.Plan(steps=2, kinds=("last",))
    nodes = series.node_series(log, floor=True)
    wide = series.forecast_table(nodes, plan, comma=True).collect()
    assert len(wide) == 2 and wide[0].A_prob == "0,333333"
    assert insights.pivot(log, "appearance", ["A"]).columns == ["case_id", "A"]


def test_outliers_by_request(spark):
    rows = [(i, 0, "a", float(i), "p") for i in range(100)] + [(i, 1, "b", None, "p") for i in range(3)]
    df = spark.createDataFrame(rows, "id int, num int, act string, m double, section string")
    names = {"case": "id", "number": "num", "activity": "act", "metric": "m"}
    found, answer = outliers.by_request(df, json.dumps({**names, "outlier_num": 4}))
    assert answer == {"response": "ok", "message": None, "outlier_num": 4}
    assert sorted(r.case_id for r in found.collect()) == [0, 1, 2, 3, 4, 96, 97, 98, 99]
    found, _ = outliers.by_request(df, {**names, "detector": "manual", "sections": ["section"], "params": {"lower": 0.1, "upper": 1.0, "min_rows": 3}})
    assert sorted((r.case_id, r.activity_num) for r in found.collect()) == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 0), (2, 1), *((i, 0) for i in range(3, 10))]
    for bad, why in (
        ("{", "Expecting"),
        ("[1]", "object"),
        ({**names, "detector": "none"}, "unknown detector"),
        ({**names, "colour": 1}, "unknown fields: colour"),
        ({"case": "id"}, "missing fields"),
        ({**names, "metric": "nothing"}, "columns not found: nothing"),
        ({**names, "sections": [["x"]]}, "columns not found"),
        ({**names, "metric": 3}, "wrong kind: metric"),
        ({**names, "detector": "manual", "params": {"lower": 2.0}}, "bounds"),
        ({**names, "detector": "manual", "params": {"nothing": 1}}, "nothing"),
    ):
        found, answer = outliers.by_request(df, bad)
        assert found is None and answer["response"] == "error" and why in answer["message"]


def test_means_are_of_exact_sums(spark):
    """2**53 + 1 + 1 in doubles is 2**53 from the left, and more in another order."""
    from loomline.functions.scalar import whole_mean, whole_sum

    for order in ([2**53, 1, 1], [1, 1, 2**53]):
        r = spark.createDataFrame([(v,) for v in order], "v long").coalesce(1).agg(whole_sum(F.col("v")).alias("s"), whole_mean(F.col("v")).alias("m")).first()
        assert (r.s, r.m) == (2.0**53 + 2, (2**53 + 2) / 3)
    assert spark.range(0).agg(whole_mean(F.col("id")).alias("m")).first().m is None


def test_mean_times_lose_no_event(spark):
    """One event of 2**57 microseconds and 4 000 of one each: a sum of doubles loses these after the long one."""
    df = spark.range(4001, numPartitions=1).select("id", F.lit("a").alias("act"), F.timestamp_micros(F.lit(0)).alias("s"), F.timestamp_micros(F.when(F.col("id") == 0, F.lit(2**57)).otherwise(1)).alias("e"))
    log = EventLog(df, "id", "act", "s", "e")
    assert insights.insight_table(log).first().mean_time == float(2**57 + 4000) / 4001 / 1e6
    # The only activity is the 75 % point itself, and not above it.
    assert "long stage" not in {r.label for r in insights.stage_labels(log).collect()}
