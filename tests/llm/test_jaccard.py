import random
import re

from loomline.llm import jaccard
from loomline.llm.components import connected

SCHEMA = "doc_id long, text string, g string, n long"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """Components by comparing all pairs."""
    sets = [(d, shingles(t)) for d, t, *_ in rows]
    parent = {d: d for d, _ in sets if d is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if None not in (a, b) and x and y and 100 * len(x & y) >= 80 * len(x | y):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return sorted(((d, len(s), None if d is None else find(d)) for d, s in sets), key=str)


def corpus(seed=0):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 4)))
    rows, n = [], 0
    for size in (1, 40, 25, 3, 2):
        base = [word() for _ in range(rng.randint(60, 90))]
        for k in range(size):
            w = list(base)
            for _ in range(rng.choice((0, 1, 2, 3)) if k else 0):
                w[rng.randrange(len(w))] = word()
            rows.append((n := n + 1, " ".join(w)))
    passage = [word() for _ in range(30)]
    for _ in range(30):
        rows.append((n := n + 1, " ".join([word() for _ in range(rng.randint(2, 60))] + passage)))
    chain = [word() for _ in range(60)]
    for _ in range(8):  # each links with the next, the ends do not
        chain = chain[2:] + [word(), word()]
        rows.append((n := n + 1, "  ".join(chain)))
    rows += [(n + 1, None), (n + 2, ""), (n + 3, " \t\n"), (n + 4, "One two THREE"), (n + 5, "one  two three"), (n + 6, "one two"), (n + 7, "é Ü"), (n + 8, "é ü"), (None, "one two"), (n + 4, "One two THREE"), (n + 9, "x " * 4000), (n + 10, "x " * 9000)]
    rng.shuffle(rows)
    return rows


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def test_matches_all_pairs(spark):
    rows = corpus()
    df = spark.createDataFrame([(d, t, "x", 3) for d, t in rows], SCHEMA)
    assert got(jaccard.jaccard_components(df)) == brute(rows)


def test_groups_are_opened_exactly(spark, monkeypatch):
    """Without turns the matrix has to find what the leads left over, in groups of two."""
    monkeypatch.setattr(jaccard, "TURNS", 1)
    monkeypatch.setattr(jaccard, "GROUP", 2)
    rows = corpus(7)
    assert got(jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_keeps_one_of_each(spark):
    rows = corpus(3)
    df = spark.createDataFrame([(d, t, "x", 3) for d, t in rows], SCHEMA)
    out = jaccard.keep_one(df)
    want = sorted({c for d, _, c in brute(rows) if c is not None})
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect() if r.doc_id is not None) == want


def test_empty_table(spark):
    assert jaccard.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(1, 40)] + [(100, 101), (5, 5)], "a long, b long")
    out = {r.id: r.component for r in connected(edges).collect()}
    assert {v for k, v in out.items() if k <= 40} == {1} and out[101] == 100


def test_rows_of_one_id_are_one_node(spark):
    c, a = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(3, c), (5, c), (4, a), (5, a), (9, c), (9, None), (8, ""), (7, a), (8, " "), (6, "other"), (6, "")]
    out = got(jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")))
    assert out == brute(rows)
    assert {x for d, _, x in out if d in (3, 4, 5, 7, 9)} == {3}


def test_repeated_ids_match_all_pairs_and_sql(spark, tmp_path):
    import duckdb

    rng = random.Random(11)
    rows = [(rng.randrange(60) if d is not None else None, t) for d, t in corpus(5)]
    want = brute(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(jaccard.jaccard_components(df)) == want
    df.coalesce(1).write.parquet(f"{tmp_path}/d")
    sql = duckdb.sql(jaccard.components_sql(f"'{tmp_path}/d/*.parquet'")).fetchall()
    assert sorted(sql, key=str) == want


def test_links_are_all_pairs_of_different_sets(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "GROUP", 3)
    rows = corpus(2)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {}
    for d, t in rows:
        if d is not None and shingles(t):
            sets.setdefault(frozenset(shingles(t)), []).append(d)
    reps = {min(ids): s for s, ids in sets.items()}
    want = sorted((a, b) for a, x in reps.items() for b, y in reps.items() if a < b and 100 * len(x & y) >= 80 * len(x | y))
    assert sorted((r.a, r.b) for r in jaccard.jaccard_links(df).collect()) == want and len(want) > 50
    members = {(r.doc_id, r.rep) for r in jaccard.set_members(df).collect() if r.rep is not None}
    assert members == {(d, min(ids)) for ids in sets.values() for d in ids}
    assert jaccard.jaccard_links(df.limit(0)).count() == 0


def test_unions_never_hide_a_link():
    """The bitmap of a union holds each of its tokens, so the bound can only be too high."""
    import pyarrow as pa

    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcdefghij") for _ in range(rng.randint(5, 200))) for _ in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array([i // 20 for i in range(60)], pa.int64()), pa.array(texts)], ["g", "text"])
    stored = [r for b in jaccard._unions(iter([batch]), 5) for r in b.to_pylist()]
    assert [r["g"] for r in stored] == [0, 1, 2]
    schema = pa.schema([("g", pa.int64()), ("salt", pa.int32()), ("asks", pa.bool_()), ("id", pa.int64()), ("text", pa.string()), ("least", pa.int64()), ("union", pa.binary())])
    for r in stored:
        inside = [t for i, t in enumerate(texts) if i // 20 == r["g"]]
        assert r["least"] == min(len(shingles(t)) for t in inside)
        rows = [{"g": r["g"], "salt": 0, "asks": False, "id": None, "text": None, "least": r["least"], "union": r["union"]}]
        rows += [{"g": r["g"], "salt": 0, "asks": True, "id": i, "text": t, "least": None, "union": None} for i, t in enumerate(inside)]
        out = [x for b in jaccard._bounded(5, 80, 100)(iter([pa.RecordBatch.from_pylist(rows, schema)])) for x in b.to_pylist()]
        assert [x["id"] for x in out] == list(range(20))
