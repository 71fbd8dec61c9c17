from itertools import permutations
from math import lcm

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomline.eventlog import EventLog
from loomline.operators import transport


def best(cost):
    """Optimum of moving equal shares of the rows onto equal shares of the columns: of whole parts, the best order."""
    m, n = cost.shape
    k = lcm(m, n)
    wide = np.repeat(np.repeat(cost, k // m, axis=0), k // n, axis=1)
    return min(sum(wide[i, j] for i, j in enumerate(o)) for o in permutations(range(k))) / k


@pytest.mark.parametrize("shape", [(1, 1), (1, 4), (2, 2), (2, 3), (4, 4), (6, 3), (6, 6)])
def test_costs_near_the_optimum(shape):
    cost = np.random.default_rng(sum(shape)).uniform(0, 1.5, (20, *shape))
    cost[0] = 0.0
    cost[1] = 1.0
    got = transport._plan_costs(np.full((20, shape[0]), 1 / shape[0]), np.full((20, shape[1]), 1 / shape[1]), cost)
    want = np.array([best(c) for c in cost])
    assert (got >= want - 1e-9).all() and (got <= want + 0.002 * np.log(shape[0] * shape[1]) + 0.01 * want + 1e-9).all()


def test_costs_of_long_names_have_a_plan():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(3, 40, 8)), rng.normal(size=(3, 25, 8))
    cost = np.sqrt(((x[:, :, None] - y[:, None]) ** 2).sum(-1))
    got = transport._plan_costs(np.full((3, 40), 1 / 40), np.full((3, 25), 1 / 25), cost)
    bound = np.linalg.norm(x.mean(axis=1) - y.mean(axis=1), axis=1)
    assert (got >= bound).all() and (got <= cost.mean(axis=(1, 2))).all()


NAMES = ["open claim", "open case", "close claim", "close case", "Close-case 2", "pay", "pay pay", "pay the bill", "send a bill", "bill", "...", "7", None, ""]


def log_of(spark, names=NAMES, cases=60, seed=5):
    rng = np.random.default_rng(seed)
    rows = [(c if c % 7 else None, i, names[rng.integers(len(names))] if len(names) else None, "x", 1.0) for c in range(cases) for i in range(8)]
    df = spark.createDataFrame(rows, "case int, at int, stage string, word string, vector double")
    return EventLog(df, "case", "stage", tiebreak=("at",))


def all_pairs(log, distance):
    of = {r.word: np.array(r.vector) for r in transport.word_vectors(log).collect()}
    names = {r.stage: r.cleaned.split() for r in transport.clean_stages(log.df, log.activity).collect()}
    out = {}
    for a in names:
        for b in names:
            if a < b and names[a] and names[b]:
                cost = np.array([[np.linalg.norm(of[x] - of[y]) for y in names[b]] for x in names[a]])
                if (d := best(cost)) <= distance:
                    out[a, b] = d
    return out


@pytest.mark.parametrize("distance", [0.0, 0.4, 0.9, 1.6])
@pytest.mark.parametrize("block", [2, 1024])
def test_pairs_equal_all_pairs(spark, monkeypatch, distance, block):
    monkeypatch.setattr(transport, "BLOCK", block)
    log = log_of(spark)
    got = {(r.a, r.b): r.distance for r in transport.transport_pairs(log, distance).collect()}
    want = all_pairs(log, distance)
    # "Close-case 2" and "close case" have the same words and stand for each other.
    alike = ("Close-case 2", "close case")
    assert got.pop(alike) == 0.0
    want = {p: d for p, d in want.items() if alike[1] not in p}
    assert set(got) == set(want)
    assert all(got[p] == pytest.approx(want[p], abs=0.01) for p in got)


def test_vectors_have_length_one_and_ignore_null_cases(spark):
    log = log_of(spark)
    rows = transport.word_vectors(log).collect()
    assert all(np.linalg.norm(r.vector) == pytest.approx(1.0) for r in rows)
    assert {r.word for r in rows} == {w for n in NAMES if n for w in n.lower().replace("-", " ").split() if w.isalpha()}
    kept = EventLog(log.df.filter("case IS NOT NULL"), "case", "stage", tiebreak=("at",))
    other = {r.word: r.vector for r in transport.word_vectors(kept).collect()}
    assert other.keys() == {r.word for r in rows} and all(np.allclose(other[r.word], r.vector) for r in rows)


def test_clusters_and_empty_logs(spark):
    log = log_of(spark)
    got = {r.stage: r.cluster for r in transport.transport_clusters(log, 0.0).collect()}
    assert got["close case"] == got["Close-case 2"] == "Close-case 2"
    assert set(got) == {n for n in NAMES if n and n != "..."} and got["7"] is None
    for empty in (log_of(spark, [], 3), EventLog(log.df.filter(F.lit(False)), "case", "stage", tiebreak=("at",))):
        assert transport.word_vectors(empty).count() == transport.transport_pairs(empty, 1.0).count() == transport.transport_clusters(empty).count() == 0
    # One name, always after itself.
    one = {r.stage: r.cluster for r in transport.transport_clusters(log_of(spark, ["only"], 3)).collect()}
    assert one == {"only": None}
