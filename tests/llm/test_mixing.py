import hashlib
import re

import pytest

from loomline.llm import mixing


def fill(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Targets by resharing the excess by weight until no source is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] > most * sizes[s] + 1e-9}
        if not over:
            return out | {s: level * w[s] for s in open_}
        for s in over:
            out[s] = float(most * sizes[s])
            left -= out[s]
        open_ -= over
    return out


def brute(rows):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    total = {}
    for (_, _, s), n in zip(rows, size, strict=True):
        total[s] = total.get(s, 0) + n
    target = fill(total)
    out = []
    h = [int(hashlib.md5(f"{'' if d is None else d}:{t or ''}".encode()).hexdigest()[:15], 16) for d, t, _ in rows]
    for i, (d, _, s) in enumerate(rows):
        passes = int(target[s] // total[s]) if total[s] else 0
        rest = target[s] - passes * total[s]
        upto = sum(n for n, x, r in zip(size, h, rows, strict=True) if r[2] == s and x <= h[i])
        same = sum(n for n, x, r in zip(size, h, rows, strict=True) if r[2] == s and x == h[i])
        more = upto <= rest or upto - rest < rest - (upto - same)
        out.append((d, size[i], total[s], round(target[s], 6), min(size[i] * (passes + more), 2 * size[i])))
    return sorted(out, key=str)


ROWS = [(i, "w " * (1 + i * 7 % 23), ["a", "b", "é", None, "z"][i % 5 if i % 2 else 0]) for i in range(120)] + [(500, None, "a"), (501, "", "empty"), (3, "w w", "b"), (3, "w w", "b"), (None, "x y z", "b")]
SCHEMA = "doc_id long, text string, source string"


def test_matches_brute_force(spark):
    got = [(r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in mixing.mix(spark.createDataFrame(ROWS, SCHEMA)).collect()]
    assert sorted(got, key=str) == brute(ROWS)


def test_targets_add_up_and_are_near(spark):
    out = mixing.mix(spark.createDataFrame(ROWS, SCHEMA)).toPandas()
    assert (out["taken"] <= 2 * out["size"]).all()
    assert out.drop_duplicates(["source_size", "target"])["target"].sum() == pytest.approx(1.5 * out["size"].sum())
    for (_, target), part in out.groupby(["source_size", "target"]):
        assert abs(part["taken"].sum() - target) <= part["size"].max()


def test_rows_without_ids_meet_their_target(spark):
    rows = [(None, f"w{i} x y z", "a") for i in range(500)] + [(i, "w " * 9, "b") for i in range(300)]
    out = mixing.mix(spark.createDataFrame(rows, SCHEMA)).toPandas()
    for (_, target), part in out.groupby(["source_size", "target"]):
        assert abs(part["taken"].sum() - target) <= part["size"].max()


def test_applied_mix_repeats_rows(spark):
    docs = spark.createDataFrame([r + ("x", 7) for r in ROWS], SCHEMA + ", target string, _passes int")
    out = mixing.apply_mix(docs)
    assert out.columns == docs.columns
    want = {}
    for d, n, _, _, t in brute(ROWS):
        if n:
            want[d] = want.get(d, 0) + t // n
    got = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert got == {k: v for k, v in want.items() if v}


def test_empty_table(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mixing.apply_mix(spark.createDataFrame([], SCHEMA)).count() == 0
