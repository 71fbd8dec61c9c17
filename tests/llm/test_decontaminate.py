import hashlib
import random
import re

from loomline.llm import decontaminate


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items, span=10):
    grams = {}
    for name, t in items:
        w = words(t)
        m = min(span, len(w))
        for i in range(len(w) - m + 1 if w and name is not None else 0):
            grams.setdefault(tuple(w[i : i + m]), set()).add(str(name))
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for m in {len(g) for g in grams}:
            for i in range(len(w) - m + 1):
                if (g := tuple(w[i : i + m])) in grams:
                    hit |= set(range(i, i + m))
                    found |= grams[g]
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def tables(seed=1):
    rng = random.Random(seed)
    word = lambda: rng.choice(("a", "b", "c", "é", "zz", "q1"))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate((60, 10, 11, 9, 4, 1, 0, 25, 200))]
    items += [(3, "other TEXT of, item three"), (None, "zz zz"), (50, None), (51, items[0][1])]
    docs = []
    for i in range(60):
        w = [rng.choice(("m", "n", "a")) for _ in range(rng.randint(0, 50))]
        for _ in range(rng.choice((0, 1, 2))):
            src = words(rng.choice(items)[1])
            a = rng.randrange(len(src) + 1)
            at = rng.randrange(len(w) + 1)
            w[at:at] = src[a : a + rng.choice((3, 9, 10, 14, 60))]
        docs.append((i, rng.choice((" ", ", ", "-\n")).join(w).upper() if i % 3 else " ".join(w)))
    docs += [(None, docs[0][1]), (100, None), (101, ""), (102, items[0][1] + " " + items[0][1]), (1, docs[1][1]), (103, "x " * 30000 + items[8][1])]
    return docs, items


def run(spark, docs, items):
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, item_id string, _words long")
    b = spark.createDataFrame(items, "item_id long, text string")
    return d, b


def test_matches_brute_force(spark):
    docs, items = tables()
    d, b = run(spark, docs, items)
    assert sorted(map(tuple, decontaminate.decontamination_report(d, b).collect()), key=str) == brute(docs, items)


def test_large_benchmarks_are_joined(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 300)
    for seed in (2, 5):
        docs, items = tables(seed)
        d, b = run(spark, docs, items)
        joined = decontaminate.contamination(d, b, keep=("doc_id", "item_id"))
        assert sorted(map(tuple, decontaminate.decontamination_report(d, b).collect()), key=str) == brute(docs, items)
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 1 << 30)
        sent = decontaminate.contamination(d, b, keep=("doc_id", "item_id"))
        assert joined.columns == sent.columns and sorted(map(str, joined.collect())) == sorted(map(str, sent.collect()))
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 300)
    out = decontaminate.drop_contaminated(d, b)
    assert out.columns == d.columns
    assert sorted((r.doc_id for r in out.collect()), key=str) == sorted((r[0] for r in brute(docs, items) if not r[5]), key=str)
    assert decontaminate.drop_contaminated(d.limit(0), b).count() == 0


def test_drop(spark):
    docs, items = tables(3)
    d, b = run(spark, docs, items)
    out = decontaminate.drop_contaminated(d, b)
    assert out.columns == d.columns
    assert sorted((r.doc_id for r in out.collect()), key=str) == sorted((r[0] for r in brute(docs, items) if not r[5]), key=str)


def test_empty_tables(spark):
    d, b = run(spark, [(1, "a b")], [])
    assert [r.n_hit for r in decontaminate.decontamination_report(d, b).collect()] == [0]
    d, b = run(spark, [], [(1, "a b")])
    assert decontaminate.decontamination_report(d, b).count() == 0


def test_item_split_over_neighbouring_rows(spark):
    """Parts of an item that run on from row to row lie on one diagonal of the batch."""
    item = [f"w{i}" for i in range(45)]
    docs = [(0, "x y " + " ".join(item[:15])), (1, " ".join(item[15:30])), (2, " ".join(item[30:]) + " z"), (3, "x y z")]
    d, b = run(spark, docs, [(7, " ".join(item))])
    d = d.coalesce(1).sortWithinPartitions("doc_id")
    out = sorted(map(tuple, decontaminate.decontamination_report(d, b).collect()))
    assert [r[2] for r in out] == [15, 15, 15, 0]
    assert out == brute(docs, [(7, " ".join(item))])
    assert [r.doc_id for r in decontaminate.drop_contaminated(d, b).collect()] == [3]
