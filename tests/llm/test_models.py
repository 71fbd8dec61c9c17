"""Quality, language model, neighbours and the pipeline."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomline.llm import language_model, neighbours, quality

SF = "/root/testdata/sf0.001"


def noisy(rng, bad):
    w = ["".join(rng.choice("aeiourstln") for _ in range(rng.randint(1, 7))) for _ in range(rng.randint(5, 60))]
    return " ".join(x + rng.choice(("%%%", "$$$")) for x in w) if bad else " ".join(w) + "."


def test_quality(spark):
    rng = random.Random(1)
    label = [int(rng.random() < 0.7) for _ in range(500)]
    docs = spark.createDataFrame([(i, noisy(rng, not y), "s") for i, y in enumerate(label)] + [(900, None, "s"), (901, "", "s"), (None, "abc", "s"), (3, "again", "s"), (902, "x" * 300_000, "s")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y, 0) for i, y in enumerate(label)] + [(5, label[5], 1), (None, 1, 0), (6, None, 0), (7777, 1, 0)], "doc_id long, quality int, toxic int")
    out = quality.quality_scores(docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    held = [r for r in out if r.held_out and r.doc_id < 500]
    assert np.mean([r.predicted == label[r.doc_id] for r in held]) > 0.97
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    for few in (labels.limit(0), labels.filter("quality = 1")):
        assert len({r.score for r in quality.quality_scores(docs, few).collect()}) == 1
    assert quality.quality_scores(docs.limit(0), labels).count() == 0


def test_quality_against_plain_formulas(spark):
    """Ratios from counted texts, margins and scores term by term, over n-grams taken one at a time."""
    rng = random.Random(4)
    label = [int(rng.random() < 0.6) for _ in range(160)]
    rows = [(i, noisy(rng, not y) if i % 9 else None) for i, y in enumerate(label)] + [(300, "short"), (301, "é"), (302, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(list(enumerate(label)), "doc_id long, quality int")
    model = quality.fit(docs, labels)

    def grams(text):
        out = set()
        data = (text or "").encode()
        for n in quality.GRAMS:
            for i in range(len(data) - n + 1):
                acc = n
                for b in data[i : i + n]:
                    acc = (acc * 257 + b + 1) % 2**64
                out.add(int(quality.mix(np.array([acc], dtype=np.uint64))[0] >> np.uint64(64 - quality.BITS)))
        return out

    used = [(grams(t), label[i]) for i, t in rows if i < 160 and zlib.crc32(str(i).encode()) % 5]
    counts = np.ones((2, 1 << quality.BITS))
    for found, y in used:
        for g in found:
            counts[y, g] += 1
    ratio = np.log((counts[1] / counts[1].sum()) / (counts[0] / counts[0].sum()))
    assert model.ratio == pytest.approx(ratio)
    scores = {r.doc_id: r.score for r in quality.scored(docs, model).collect()}
    weight = np.where(ratio != 0, model.weight / np.where(ratio != 0, ratio, 1), 0)
    for i, t in rows:
        found = sorted(grams(t))
        norm = math.sqrt(math.fsum(ratio[g] ** 2 for g in found)) or 1.0
        margin = math.fsum(weight[g] * ratio[g] / norm for g in found) + model.bias
        assert scores[i] == pytest.approx(1 / (1 + math.exp(-(model.a * margin + model.b))), rel=1e-6)


def test_dual_descent_meets_its_conditions():
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 40, 8)).astype(np.int32) for _ in range(120)]
    y = np.array([1.0 if (r < 20).mean() > 0.5 else -1.0 for r in rows])
    ratio = np.ones(40)
    w = quality.dual_descent(rows, y, ratio, epochs=300)
    x = np.zeros((120, 41))
    for i, r in enumerate(rows):
        x[i, r] = 1 / math.sqrt(len(r))
    x[:, 40] = 1
    loss = lambda v: 0.5 * v @ v + np.maximum(0, 1 - y * (x @ v)).sum()
    assert all(loss(w) <= loss(w + rng.normal(size=41) * s) + 1e-6 for s in (1e-3, 1e-2, 0.1) for _ in range(50))


def test_language_model(spark, monkeypatch):
    monkeypatch.setattr(language_model, "FREQUENT", 300)
    rng = random.Random(3)
    one, two = [[f"{p}{i}{s}" for i in range(40)] for p, s in (("wa", "er"), ("zo", "ul"))]
    rows = []
    for i in range(400):
        words = rng.choice((one, two))
        rows.append((i, " ".join(rng.choice(words) if k % 2 else ("The", "of")[words is one] for k in range(rng.randint(1, 60))) + f" rare{i}"))
    rows += [(500, None), (501, ""), (None, "the of"), (3, rows[3][1]), (502, "the " * 50_000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, score string")
    out = language_model.lm_scores(df).collect()
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    token = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low)) + [None] for _, t in rows]
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows]
    c = collections.Counter(w for t, h in zip(token, held, strict=True) if not h for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted((str(d), h, len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), 5)) for (d, _), h, t in zip(rows, held, token, strict=True))
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in out) == want
    assert all(r.score <= 0 for r in out)
    tested = [r for r in out if r.held_out and r.doc_id < 400]
    assert sum(r.score for r in tested) > 0.8 * sum(r.base_score for r in tested)
    assert language_model.lm_scores(df.limit(0)).count() == 0
    nothing = language_model.lm_scores(df.filter("doc_id = 502 or doc_id = 501").withColumn("doc_id", F.lit(2))).collect()
    assert len(nothing) == 2 and all(math.isfinite(r.score) for r in nothing)


def plain_probability(m, counts, before, word):
    """P(word | the three words before it), term by term, from the weights; a word is (hash, suffix)."""
    n = len(m.unit_class)
    own = dict(zip(m.own.tolist(), m.own_unit.tolist(), strict=True))
    unit = lambda x: n if x is None else own.get(x[0], len(own) + max(x[1], 0))
    hashed = lambda x, size: int(language_model.mix(np.array([x % 2**64], dtype=np.uint64))[0]) % size
    one, two, three = map(unit, before)
    u = unit(word)
    c, p = int(m.unit_class[u]), int(m.unit_place[u])
    pair = one * (n + 1) + two
    rows = [0, 1 + one, 2 + n + two, 3 + 2 * n + three, 4 + 3 * n + hashed(pair, language_model.TRIGRAMS)]
    z = sum(m.by_class[r].astype(float) for r in rows)
    rows = [c] + [language_model.SIDE + hashed((x * language_model.SIDE + c) * 4 + k, language_model.WITHIN) for k, x in enumerate((one, two, pair))]
    y = sum(m.by_place[r].astype(float) for r in rows)
    out = np.exp(z[c] - z.max()) / np.exp(z - z.max()).sum() * np.exp(y[p] - y.max()) / np.exp(y - y.max()).sum()
    return out if u < len(own) else out * (counts.get(word[0], 0) + 1) / 10 ** m.rest[c]


@pytest.fixture(scope="module")
def language(spark):
    """A model of the small documents, their counts and the documents."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    training = docs.filter(~language_model.held_out(F.col("doc_id")))
    model, counts, *_ = language_model.fit(training.select("text"))
    return model, {r.word: (r.suffix, r.n) for r in counts.collect()}, docs


def test_word_probabilities_add_up(language):
    m, counts, _ = language
    frequent = sorted((w for w in counts if w != -1), key=lambda w: -counts[w][1])
    some = [(w, counts[w][0]) for w in (*frequent[:3], *frequent[5000:5003])]
    n = {w: k for w, (_, k) in counts.items()}
    rest = sorted(set(m.unit_class[len(m.own) :].tolist()))
    suffix_in = {int(m.unit_class[len(m.own) + s]): s for s in range(language_model.SUFFIXES)}
    for before in ((None, None, None), (some[0], None, None), (some[3], some[1], some[0]), (some[2], some[4], some[5]), (some[0], some[0], some[1])):
        total = math.fsum(plain_probability(m, n, before, (w, s)) for w, (s, _) in counts.items())
        total += math.fsum(plain_probability(m, n, before, (12345, suffix_in[c])) for c in rest)  # a word never seen, in each class that takes such
        assert total == pytest.approx(1.0, abs=1e-4)


def test_score_is_the_sum_of_plain_terms(spark, language):
    m, counts, docs = language
    n = {w: k for w, (_, k) in counts.items()}
    rows = {r.doc_id: r for r in language_model.lm_scores(docs).collect()}
    texts = [r for r in docs.collect() if r.text and len(r.text) < 900][:25]
    for r in texts:
        (w,) = language_model.word_slices(pa.array([r.text]))
        h, s, _, _ = language_model.tokens_of(w)
        token = list(zip(h.tolist(), s.tolist(), strict=True))
        want = sum(math.log10(plain_probability(m, n, [token[i - k] if i >= k else None for k in (1, 2, 3)], t)) for i, t in enumerate(token))
        assert rows[r.doc_id].score == pytest.approx(want, rel=2e-3)
    held = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in held) > 0.97 * sum(r.base_score for r in held)


def exact(ids, x, every, k):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = u @ u[i]
        order = [j for j in np.lexsort((ids, -np.round(s, 12))) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [int(ids[j]) for j in order]
    return out


def test_neighbours(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    monkeypatch.setattr(neighbours, "ASKED", 16)
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(12, 16))
    x = (centres[rng.integers(0, 12, 1500)] + rng.normal(size=(1500, 16)) * 0.4).astype(np.float32).astype(float)
    x[500:900] = x[500]  # one group of copies
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    odd = [(3000, None, 1), (3050, [0.0] * 16, 1), (3100, [1.0] * 3, 1), (3150, [math.nan] * 16, 1), (None, x[0].tolist(), 1), (3200, [None] * 16, 1), rows[7]]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int")
    out = neighbours.search(df, every=20).toPandas()
    want = exact(np.arange(1500), x, 20, 5)
    assert set(out["query_id"]) == set(want)
    hits = 0
    for q, part in out.groupby("query_id"):
        part = part.sort_values("rank")
        assert part["rank"].tolist() == [1, 2, 3, 4, 5] and part["score"].is_monotonic_decreasing
        hits += len(set(part["vec_id"]) & set(want[q]))
    assert hits / (5 * len(want)) >= 0.9
    assert out[out["query_id"] == 600].sort_values("rank")["vec_id"].tolist() == [500, 501, 502, 503, 504]
    few = neighbours.search(df.filter("vec_id < 4"), every=2).toPandas()
    assert few.groupby("query_id").size().tolist() == [3, 3]
    assert neighbours.search(df.limit(0)).count() == 0 and neighbours.search(df.filter("embedding is null")).count() == 0


@pytest.mark.parametrize("sample", [6000, 500])
def test_recall_at_default_constants(spark, monkeypatch, sample):
    """Vectors without clusters; with a small sample the parts are cut twice."""
    monkeypatch.setattr(neighbours, "SAMPLE", sample)
    probed = {}
    fit = neighbours.fit_router
    monkeypatch.setattr(neighbours, "fit_router", lambda x, parts, **how: probed.setdefault("top", fit(x, parts, epochs=30, **how)))
    if sample == 500:
        monkeypatch.setattr(neighbours, "DENSITY", 1.0)
    x = np.random.default_rng(5).normal(size=(2500, 24)).astype(np.float32).astype(float)
    df = spark.createDataFrame([(i, v.tolist(), None) for i, v in enumerate(x)], "vec_id long, embedding array<float>, query_id int")
    out = neighbours.search(df).toPandas()
    want = exact(np.arange(2500), x, 50, 5)
    hits = sum(len(set(part["vec_id"]) & set(want[q])) for q, part in out.groupby("query_id"))
    assert hits / (5 * len(want)) >= 0.9
    parts = probed["top"].w2.shape[1]
    assert parts == (25 if sample == 6000 else 500 // 24) or parts >= 15
    assert 1 < probed["top"].probes < parts
    for q, i, s in zip(out["query_id"], out["vec_id"], out["score"]):
        assert s == neighbours.cosine(x[q], x[i])


def test_parts_are_balanced():
    rng = np.random.default_rng(1)
    x = neighbours.unit(rng.normal(size=(600, 8)))
    part = neighbours.balanced_parts(x, neighbours.neighbour_graph(x), 6)
    assert np.bincount(part, minlength=6).max() <= math.ceil(1.1 * 100)


def test_pipeline(spark):
    import corpus_pipeline as pipeline
    from loomline.llm.decontaminate import decontamination_report
    from loomline.llm.jaccard import jaccard_components

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    step = docs
    seen = {}
    for name, stage in pipeline.STAGES:
        seen[name] = before = step
        step = stage(spark, step, SF)
        if name != "sharding":
            assert step.columns == docs.columns
            step = step.cache()
        if name == "near_duplicates":
            want = {r.component_id for r in jaccard_components(before).collect()}
            assert {r.doc_id for r in step.collect()} == want and step.count() == len(want)
        if name == "decontamination":
            report = decontamination_report(before, spark.read.parquet(f"{SF}/benchmark.parquet"))
            assert {r.doc_id for r in step.collect()} == {r.doc_id for r in report.filter("not contaminated").collect()}
    assert step.columns == [*docs.columns, "shard", "slot"]
    kept = [c for c in docs.columns]
    assert sorted(map(str, step.select(kept).collect())) == sorted(map(str, seen["sharding"].collect())) and step.count() > 0
    assert sorted(map(str, pipeline.run(spark, SF).collect())) == sorted(map(str, step.collect()))
