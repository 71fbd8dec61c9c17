"""Clusters, repeated strings and the filter audit against plain versions."""

import hashlib
import random
import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomline.llm import filter_audit, lloyd, suffixes


def plain_repeats(docs, length):
    """docs: (doc_id, text) in order; per document the bytes to remove, by a dictionary of all strings."""
    seen, out = set(), []
    for _, text in docs:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            s = data[i : i + length]
            if s in seen:
                gone[i : i + length] = True
            seen.add(s)
        out.append((data, gone))
    return out


def digest(data, gone):
    edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))) == 1)
    return len(data), int(gone.sum()), len(edges), hashlib.sha256(bytes(np.frombuffer(data, np.uint8)[~gone])).hexdigest()


def mixed_texts(seed, n, words):
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choice("abé\0z") for _ in range(rnd.randint(1, 7))) for _ in range(words)]
    text = lambda k: " ".join(rnd.choice(vocab) for _ in range(k))
    passages = [text(rnd.randint(3, 60)) for _ in range(6)]
    out = []
    for _ in range(n):
        kind = rnd.random()
        if kind < 0.1 or not out:
            out.append(rnd.choice([None, "", "short", text(80)]))
        elif kind < 0.35:
            old = (rnd.choice(out) or "").split(" ")
            for _ in range(rnd.randint(0, 3)):
                old[rnd.randrange(len(old))] = rnd.choice(vocab)
            out.append(" ".join(old))
        elif kind < 0.45:
            out.append(rnd.choice("ab") * rnd.randint(1, 400) + rnd.choice(["", "ab" * 200]))
        else:
            out.append(text(rnd.randint(0, 60)) + rnd.choice(passages) + text(rnd.randint(0, 30)) + rnd.choice(passages))
    return out


@pytest.mark.parametrize(("length", "words", "hot"), [(100, 400, 10_000), (20, 300, 10_000), (7, 30, 10_000), (20, 300, 2), (2, 5, 10_000)])
def test_repeats(spark, monkeypatch, length, words, hot):
    monkeypatch.setattr(suffixes, "HOT", hot)
    texts = mixed_texts(length, 150, words)
    docs = list(enumerate(texts)) + [(None, texts[-1]), (None, "z" * 300)]
    df = spark.createDataFrame([(d, t, 0) for d, t in docs], "doc_id long, text string, cell int").repartition(5)
    got = {(r.doc_id, r.n_bytes): (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.repeat_digests(df, length).collect()}
    nameless = sorted((docs[-2:]), key=lambda x: 0)
    want = plain_repeats(docs, length)
    for (d, t), (data, gone) in zip(docs[:-2], want[:-2], strict=True):
        assert got[d, len(data)] == digest(data, gone), (d, t)
    assert len(got) == len(docs) and len(nameless) == 2
    # Only the two null ids stand in an order of their own; the copy of the last text has gone but for what overlaps neither.
    assert got[None, len(want[-2][0])][1] == int(want[-2][1].sum())


def test_repeats_in_blocks():
    """Blocks, cut buckets and cells give what one block gives."""
    texts = [t or "" for t in mixed_texts(3, 300, 200)]
    import pyarrow as pa

    def run(block, hot, cells, batch):
        keep = suffixes.BLOCK, suffixes.HOT, suffixes.CHUNK
        suffixes.BLOCK, suffixes.HOT, suffixes.CHUNK = block, hot, 500
        try:
            docs = [pa.table({"doc_id": pa.array(range(c, len(texts), cells), pa.int64()), "text": pa.array([t.encode() for t in texts[c::cells]]), "cell": pa.array([c] * len(texts[c::cells]), pa.int32())}) for c in range(cells)]
            grams = [suffixes._grams(30)(d) for d in docs]
            total = pa.concat_tables(grams).group_by("fp").aggregate([("n", "sum")])
            total = total.filter(pa.compute.greater(total.column("n_sum"), 1)).rename_columns(["fp", "total"])
            records = pa.concat_tables([suffixes._opened(30)(d, total.append_column("cell", pa.repeat(pa.scalar(0, pa.int32()), total.num_rows))) for d in docs]).sort_by("fp")
            spans = pa.Table.from_batches(list(suffixes._sorted_blocks(30)(iter(records.to_batches(max_chunksize=batch)))))
            out = {}
            for c, d in enumerate(docs):
                for doc, text, runs in suffixes._kept(d, spans.filter(pa.compute.equal(spans.column("cell"), c))):
                    gone = np.zeros(len(text), bool)
                    for a, b in runs:
                        gone[a:b] = True
                    out[doc] = digest(text, gone)
            return [out[i] for i in range(len(texts))]
        finally:
            suffixes.BLOCK, suffixes.HOT, suffixes.CHUNK = keep

    want = [digest(*x) for x in plain_repeats(list(enumerate(texts)), 30)]
    assert run(1 << 16, 10_000, 1, 1 << 16) == want
    assert run(50, 10_000, 7, 20) == want
    assert run(40, 3, 11, 15) == want


def test_gram_hashes():
    rnd = np.random.default_rng(1)
    text = rnd.integers(0, 3, 500).astype(np.uint8)
    for k in (1, 2, 3, 7, 33):
        out = suffixes.gram_hashes(text, k)
        of = {}
        assert len(out) == len(text) - k + 1
        for i, h in enumerate(out):
            assert of.setdefault(bytes(text[i : i + k]), h) == h
        assert len(set(of.values())) == len(of)


def test_repeats_edges(spark):
    long = "x" * 3000 + "".join(chr(97 + i % 26) * (i % 5 + 1) for i in range(3000)) * 2
    df = spark.createDataFrame([(1, "é" * 100), (2, "é" * 100), (3, "a" * 99), (4, "a" * 99), (5, long), (5, long), (6, None), (7, "")], "doc_id long, text string")
    got = sorted(tuple(r) for r in suffixes.repeat_digests(df).select("doc_id", "n_bytes", "n_removed", "n_spans").collect())
    alone = int(plain_repeats([(0, long)], 100)[0][1].sum())
    spans = digest(*plain_repeats([(0, long)], 100)[0])[2]
    assert got[:4] == [(1, 200, 198, 1), (2, 200, 200, 1), (3, 99, 0, 0), (4, 99, 0, 0)]
    assert sorted(got[4:6]) == sorted([(5, len(long), alone, spans), (5, len(long), len(long), 1)])
    assert got[6:] == [(6, 0, 0, 0), (7, 0, 0, 0)]
    texts = {r.doc_id: r for r in suffixes.remove_repeats(df.filter("doc_id < 3")).collect()}
    assert texts[2].text == "" and texts[1].text == "é"
    assert [(s.start, s.end) for s in texts[2].spans] == [(0, 200)]
    assert suffixes.repeat_digests(df.limit(0)).count() == 0


def plain_lloyd(rows, k=40, rounds=5):
    kept = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [q for _, q in order[:k]]
    near = lambda q: min((sum((a - b) ** 2 for a, b in zip(q, c, strict=True)), i) for i, c in enumerate(centroids))
    for _ in range(rounds):
        own = {}
        for _, q in kept:
            own.setdefault(near(q)[1], []).append(q)
        for c, qs in own.items():
            centroids[c] = [sum(x) // len(qs) for x in zip(*qs, strict=True)]
    out = [(i, *reversed(near(q))) for i, q in kept]
    inertia = {}
    for _, c, d in out:
        inertia[c] = inertia.get(c, 0) + d
    return [(i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for i, c, d in out]


def lloyd_rows(df):
    return sorted((tuple(r) for r in lloyd.cluster_vectors(df).collect()), key=str)


def test_lloyd(spark):
    rnd = np.random.default_rng(4)
    rows = [(i, rnd.normal(size=64).astype(np.float32).tolist()) for i in range(150)]
    rows += [(7, rows[3][1]), (7, rows[3][1]), (None, rows[5][1]), (200, None), (201, [1.0] * 63), (202, [None, *[1.0] * 63]), (203, [float("nan")] * 64), (204, [float("inf")] * 64), (205, [])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, cluster int").repartition(6)
    assert lloyd_rows(df) == sorted(plain_lloyd(rows), key=str)


def test_lloyd_large_and_few(spark):
    rnd = np.random.default_rng(5)
    rows = [(i, (rnd.normal(size=64) * 1e-2 + 1e7 * (i % 2)).tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert lloyd_rows(df) == sorted(plain_lloyd(rows), key=str)
    few = spark.createDataFrame([(i, [float(i)] * 64) for i in (5, 6, 6)], "vec_id int, embedding array<double>")
    assert lloyd_rows(few) == sorted(plain_lloyd([(i, [float(i)] * 64) for i in (5, 6, 6)]), key=str)
    assert lloyd.cluster_vectors(df.limit(0)).collect() == []
    huge = spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        lloyd.cluster_vectors(huge)


def plain_audit(docs, labels):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, _ in docs]
    least = {}
    for d, t, _ in docs:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    rows = []
    for (d, t, lang), w in zip(docs, words, strict=True):
        t = t or ""
        f = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": d is not None and d > least[t]}
        mine = [x for x in labels if x[0] == d and d is not None]
        rows.append((lang or "", f, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    out = []
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        steps = []
        for order in permutations("ABCDE"):
            alive = own
            for i, f in enumerate(order):
                gone = [r for r in alive if r[1][f]]
                alive = [r for r in alive if not r[1][f]]
                total[f] += len(gone)
                steps.append((part, "".join(order), i + 1, len(alive), len(gone), sum(r[1][f] for r in own) - len(gone), sum(r[1][f] and sum(r[1].values()) == 1 for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone), f))
        out += [(*s[:9], total[s[9]]) for s in steps]
    return sorted(out)


def test_filter_audit(spark):
    rnd = random.Random(2)
    make = lambda: " ".join(rnd.choice(["Aa", "BBB", "c", "d#", "é", "x y", *map(str, range(rnd.choice([5, 300])))]) for _ in range(rnd.choice([3, 99, 100, 150])))
    texts = [None, "", " \t", "a" * 3000, *(make() for _ in range(30))]
    docs = [(rnd.choice([None, i, i // 2]), rnd.choice(texts), rnd.choice([None, "", "de", "en"])) for i in range(200)]
    docs += [(3, "same", "en"), (3, "same", "en"), (9, "same", "de"), (3, "same", "fr"), (None, "same", "fr")]
    labels = [(rnd.choice([None, i]), rnd.choice([None, 0, 1]), rnd.choice([None, 0, 1])) for i in range(150)] + [(3, 1, 0), (3, 0, 1)]
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, lang string, n int, good int").repartition(4)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = filter_audit.audit(df, lab)
    assert sorted(tuple(r) for r in out.collect()) == plain_audit(docs, labels)
    assert filter_audit.audit(df.limit(0), lab).count() == 0
    none = filter_audit.audit(df, lab.limit(0))
    assert none.agg(F.sum("good_lost"), F.sum("toxic_lost")).first() == (0, 0) and none.count() == out.count()
