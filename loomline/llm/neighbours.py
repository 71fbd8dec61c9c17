"""Approximate nearest neighbours with learned partitions.

The neighbour graph of a bounded sample is cut into balanced parts with few edges between
them, and a small classifier learns the part of a vector. It places every vector in its
most probable part and routes a query to several parts, whose vectors are then compared
exactly. How many parts are probed is learned on vectors of the sample that neither graph
cut nor classifier has seen. Parts grow in number with the square root of the vectors; where
the sample is too small for so many, each part is cut again, in a task of its own, by a
graph and a classifier fitted on a bounded sample of that part. Equal vectors are one entry
with its smallest ids, so a group of copies, however large, is one row of one part.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomline.llm.shared import small, written

#: Vectors that a graph and a classifier are fitted on, about; chosen by hash.
SAMPLE = 6_000
#: Neighbours of a vector in the graph, and vectors of the sample in a part at least.
DEGREE = 10
ROOM = 24
#: Parts are as many as this times the square root of the distinct vectors.
DENSITY = 0.5
#: Share of the sample held out from the fit, and share of its nearest that probed parts must hold.
HELD = 0.15
COVER = 0.92
#: Neighbours of a held-out vector that count for COVER.
SOUGHT = 5
#: Candidates and queries that one task compares at a time.
BLOCK = 2_048
ASKED = 512
#: Places in which one common query vector is answered.
SPREAD = 8


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def neighbour_graph(x: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """Row numbers of the nearest rows by cosine, the row itself left out."""
    degree = min(degree, len(x) - 1)
    out = np.empty((len(x), degree), dtype=np.int64)
    for a in range(0, len(x), 1000):
        near = x[a : a + 1000] @ x.T
        near[np.arange(len(near)), np.arange(a, a + len(near))] = -np.inf
        out[a : a + 1000] = np.argpartition(-near, degree - 1, axis=1)[:, :degree]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12, seed: int = 0) -> np.ndarray:
    """A part for each row: at most 1.1 times the mean size, few graph edges cut.

    Starts from nearest centres, then moves rows to the part of most of their neighbours
    that has room, in both directions of the edges.
    """
    rng = np.random.default_rng(seed)
    room = int(np.ceil(1.1 * len(x) / parts))
    centres = x[rng.choice(len(x), parts, replace=False)]
    for _ in range(8):
        near = np.argmax(x @ centres.T, axis=1)
        for p in range(parts):
            if (near == p).any():
                centres[p] = x[near == p].mean(axis=0)
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    prefer = x @ centres.T
    part = np.full(len(x), -1)
    size = np.zeros(parts, dtype=int)
    for i in np.argsort(-prefer.max(axis=1)):
        for p in np.argsort(-prefer[i]):
            if size[p] < room:
                part[i] = p
                size[p] += 1
                break
    back: list[list[int]] = [[] for _ in range(len(x))]
    for i, row in enumerate(graph):
        for j in row:
            back[j].append(i)
    around = [np.concatenate((graph[i], np.array(back[i], dtype=np.int64))) for i in range(len(x))]
    for _ in range(rounds):
        moved = 0
        for i in rng.permutation(len(x)):
            votes = np.bincount(part[around[i]], minlength=parts)
            votes[size >= room] = -1
            votes[part[i]] = max(votes[part[i]], np.count_nonzero(part[around[i]] == part[i]))
            best = int(np.argmax(votes))
            if best != part[i] and votes[best] > votes[part[i]]:
                size[part[i]] -= 1
                size[best] += 1
                part[i] = best
                moved += 1
        if moved < len(x) // 500:
            break
    return part


@dataclass
class Router:
    """A classifier with one hidden layer over unit vectors, and how many parts to probe."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def single(dim: int) -> Router:
    return Router(np.zeros((dim, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1)


def fit_router(x: np.ndarray, parts: int, epochs: int = 60, hidden: int = 96, seed: int = 0, cover: float = COVER) -> Router:
    """Learns the parts of the sample's neighbour graph; x are unit vectors, in any fixed order.

    A share HELD of them takes no part in the fit: their nearest in the whole sample say how
    many parts a query has to probe, so that these hold a share `cover` of them.
    """
    dim = x.shape[1]
    if parts <= 1:
        return single(dim)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    held, everyone = x[order[: int(len(x) * HELD)]], x
    x = x[order[int(len(x) * HELD) :]]
    graph = neighbour_graph(x)
    part = balanced_parts(x, graph, parts, seed=seed)
    net = [rng.normal(0, np.sqrt(2 / dim), (dim, hidden)) * np.sqrt(dim), np.zeros(hidden), rng.normal(0, np.sqrt(1 / hidden), (hidden, parts)), np.zeros(parts)]
    first, second = [np.zeros_like(p) for p in net], [np.zeros_like(p) for p in net]
    # The target of a row mixes its own part with those of its neighbours.
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 0.5 / graph.shape[1])
    target[np.arange(len(x)), part] += 0.5
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for a in range(0, len(x), 256):
            rows = order[a : a + 256]
            h = np.maximum(x[rows] @ net[0] + net[1], 0)
            z = h @ net[2] + net[3]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            dz = (p - target[rows]) / len(rows)
            dh = (dz @ net[2].T) * (h > 0)
            step += 1
            for k, g in enumerate((x[rows].T @ dh, dh.sum(axis=0), h.T @ dz, dz.sum(axis=0))):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                net[k] -= 0.003 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    router = Router(*(w.astype(np.float32) for w in net), probes=parts)
    if len(held):
        # The place, in each held-out row's list of parts, of the parts that hold its nearest.
        home = np.argmax(router.logits(everyone), axis=1)
        near = held @ everyone.T
        near[near > 1 - 1e-12] = -np.inf  # itself
        sought = np.argpartition(-near, min(SOUGHT, near.shape[1] - 1) - 1, axis=1)[:, : min(SOUGHT, near.shape[1] - 1)]
        logits = router.logits(held)
        rank = np.empty_like(logits, dtype=np.int64)
        np.put_along_axis(rank, np.argsort(-logits, axis=1), np.arange(parts)[None, :], axis=1)
        places = np.sort(np.take_along_axis(rank, home[sought], axis=1).ravel())
        router.probes = int(places[min(len(places) - 1, int(cover * len(places)))]) + 1
    return router


def _refined(parts: int, cover: float) -> Callable:
    """(part, model): a router within each part, from the sampled vectors (part, vec) of it."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x = unit(_matrix(pdf["vec"].sort_values()))
        model = pickle.dumps(fit_router(x, max(1, min(parts, len(x) // ROOM)), cover=cover))
        return pd.DataFrame({"part": [int(pdf["part"].iloc[0])], "model": [model]})

    return run


def _vectors(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that take part, their vectors as doubles)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.array([-1 if n is None else n for n in pa.compute.list_value_length(column).to_pylist()])
    rows = np.flatnonzero(lengths == dim)
    x = column.take(pa.array(rows)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dim)
    good = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
    return rows[good], x[good] + 0.0


def _distinct(dim: int, keep: int) -> Callable:
    """(vec, ids, salt): the distinct vectors of a task with their smallest ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = TaskContext.get().partitionId() % 64
        for batch in batches:
            found: dict[bytes, set[int]] = {}
            rows, x = _vectors(batch.column(1), dim)
            for i, v in zip(batch.column(0).take(pa.array(rows)).to_pylist(), x, strict=True):
                if i is not None:
                    found.setdefault(v.tobytes(), set()).add(i)
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array([sorted(i)[:keep] for i in found.values()], pa.list_(pa.int64())), pa.array([salt] * len(found), pa.int32())], ["vec", "ids", "salt"])

    return run


def _rows(dim: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = _vectors(batch.column(1), dim)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)).cast(pa.int64()), pa.array([v.tobytes() for v in x], pa.binary())], ["query_id", "vec"])

    return run


def _matrix(column) -> np.ndarray:
    return np.stack([np.frombuffer(v) for v in column])


def _route(routers, several: bool) -> Callable:
    """Adds `parts`, the numbers of the parts of a vector: one, or all those that a query probes."""

    def best(r: Router, x: np.ndarray) -> np.ndarray:
        logits = r.logits(x)
        n = min(r.probes, logits.shape[1]) if several else 1
        return np.argpartition(-logits, n - 1, axis=1)[:, :n]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, within = routers.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unit(_matrix(batch.column(0).to_pylist()))
            first = best(top, x)
            parts = first.tolist()
            if within:
                wide = max(r.w2.shape[1] for r in within.values())
                parts = [[] for _ in range(len(x))]
                for p in np.unique(first).tolist():
                    rows = np.flatnonzero((first == p).any(axis=1))
                    inner = best(within[p], x[rows]) if p in within else np.zeros((len(rows), 1), dtype=np.int64)
                    for i, some in zip(rows.tolist(), (p * wide + inner).tolist(), strict=True):
                        parts[i] += some
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(parts, pa.list_(pa.int32()))], [*batch.schema.names, "parts"])

    return run


def _nearest(keep: int) -> Callable:
    def run(key, asked: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(block):
            return pd.DataFrame({"q": pd.Series(dtype=int), "vec_id": pd.Series(dtype=int), "score": pd.Series(dtype=float)})
        block = block.sort_values("u")
        ids = block["ids"].tolist()
        a, b = _matrix(asked["vec"]), _matrix(block["vec"])
        score = (a @ b.T) / (np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1)[None, :])
        out = []
        for n, (q, row) in enumerate(zip(asked["q"].tolist(), score, strict=True)):
            # All that may stand at the edge are looked at; a pair's own score is summed up in
            # one fixed order, whatever the shape of the blocks.
            edge = -np.partition(-row, min(keep, len(row)) - 1)[min(keep, len(row)) - 1]
            near = np.flatnonzero(row >= edge - 1e-9)
            own = [cosine(a[n], b[j]) for j in near]
            rows = sorted((-s, i) for s, j in zip(own, near, strict=True) for i in ids[j])[:keep]
            out += [(q, i, -s) for s, i in rows]
        return pd.DataFrame(out, columns=["q", "vec_id", "score"])

    return run


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.sum(a * b) / (np.sqrt(np.sum(a * a)) * np.sqrt(np.sum(b * b))))


def search(vectors: DataFrame, every: int = 50, nearest: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found of each vec_id divisible by `every`.

    The score is the cosine in double precision of the original vectors; ties go to the
    smaller vec_id. Vectors that are null, zero, of another length than most, or hold null
    or non-finite components take no part, nor do null ids. Repeated rows count once as
    candidates, and rows with a query's own id are not its candidates. A query gets
    min(nearest, candidates) rows; an empty table gives none. Other columns play no part.
    """
    spark = vectors.sparkSession
    vectors = vectors.select("vec_id", "embedding")
    lengths = vectors.filter("vec_id is not null").groupBy(F.size("embedding").alias("n")).count().filter("n > 0").orderBy(F.desc("count"), "n").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if lengths is None:
        return spark.createDataFrame([], schema)
    dim = lengths.n
    keep = nearest + 1  # the query itself is one of the rows
    least = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep).alias("ids")
    entries = vectors.mapInArrow(_distinct(dim, keep), "vec binary, ids array<long>, salt int")
    entries = written(entries.groupBy("vec", "salt").agg(least).groupBy("vec").agg(least), "near-entries")
    total = entries.count()
    rows_in = entries.agg(F.sum(F.size("ids"))).first()[0] or 0

    place = F.pmod(F.xxhash64("vec"), F.lit(1 << 30))
    sample = entries.filter(place < int((1 << 30) * min(1.0, SAMPLE / max(total, 1)))).select("vec").toPandas()["vec"].sort_values()
    wanted = max(1, round(DENSITY * math.sqrt(total)))
    parts = max(1, min(wanted, len(sample) // ROOM))
    # What a query looks for must be in probed parts of both levels.
    cover = math.sqrt(COVER) if wanted > parts > 1 else COVER
    routers: tuple[Router, dict[int, Router]] = (fit_router(unit(_matrix(sample)), parts, cover=cover) if parts > 1 else single(dim), {})
    shared = spark.sparkContext.broadcast(routers)

    kind = "vec binary, ids array<long>, parts array<int>"
    index = entries.mapInArrow(_route(shared, False), kind)
    if wanted > parts > 1:
        # More parts than one sample can teach: each is cut again by a sample of its own.
        ranked = written(index.select("vec", F.col("parts")[0].alias("part")), "near-parts")
        share = ranked.groupBy("part").agg((F.lit(float(SAMPLE)) / F.count("*")).alias("share"))
        some = ranked.join(F.broadcast(share), "part").filter(F.pmod(F.xxhash64("vec", F.lit(1)), F.lit(1 << 30)) < F.col("share") * (1 << 30))
        inner = some.select("part", "vec").groupBy("part").applyInPandas(_refined(-(-wanted // parts), cover), "part int, model binary").collect()
        routers = (routers[0], {r.part: pickle.loads(r.model) for r in inner})
        shared = spark.sparkContext.broadcast(routers)
        index = entries.mapInArrow(_route(shared, False), kind)
    index = written(index.select("vec", "ids", F.col("ids")[0].alias("u"), F.col("parts")[0].alias("part")), "near-index")
    asking = written(vectors.filter(F.col("vec_id") % every == 0).mapInArrow(_rows(dim), "query_id long, vec binary").distinct(), "near-asking")
    # Equal query vectors are asked once.
    asked = asking.groupBy("vec").agg(F.min("query_id").alias("q"))
    routed = written(asked.mapInArrow(_route(shared, True), "vec binary, q long, parts array<int>"), "near-routed")

    def compared(routed: DataFrame) -> DataFrame:
        """The nearest rows of each (vec, q, part) from all blocks of its part."""
        blocks = index.groupBy("part").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
        groups = routed.groupBy("part").agg(F.ceil(F.count("*") / ASKED).alias("groups"))
        shape = F.broadcast(blocks.join(groups, "part"))  # one row per part

        def numbers(n: str):
            return F.explode(F.sequence(F.lit(0), (F.col(n) - 1).cast("int")))

        left = routed.join(shape, "part").withColumn("g", F.pmod(F.xxhash64("q"), F.col("groups")).cast("int")).withColumn("b", numbers("blocks"))
        right = index.join(shape, "part").withColumn("b", F.pmod(F.xxhash64("u"), F.col("blocks")).cast("int")).withColumn("g", numbers("groups"))
        left, right = left.select("part", "g", "b", "q", "vec"), right.select("part", "g", "b", "u", "vec", "ids")
        found = left.groupBy("part", "g", "b").cogroup(right.groupBy("part", "g", "b")).applyInPandas(_nearest(keep), "q long, vec_id long, score double")
        best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
        return written(found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= keep), "near-found")

    found = compared(routed.select("vec", "q", F.explode("parts").alias("part")))
    # A query whose parts hold too few rows is compared with all parts.
    full = found.groupBy("q").count().filter(F.col("count") >= min(keep, rows_in))
    poor = written(routed.join(full, "q", "left_anti").select("vec", "q"), "near-poor")
    if not poor.isEmpty():
        every_part = [r.part for r in index.select("part").distinct().collect()]  # one number per part
        again = compared(poor.withColumn("part", F.explode(F.array(*map(F.lit, every_part)))))
        found = found.join(poor, "q", "left_anti").unionByName(again)
    # Queries with equal vectors share one answer; a very common one is met in several places.
    answer = found.groupBy("q").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id", "score"))).alias("near"))
    answer = answer.join(routed.select("q", "vec"), "q").select("vec", "near", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("salt"))
    asking = asking.withColumn("salt", F.pmod(F.xxhash64("query_id"), F.lit(SPREAD)).cast("int"))
    out = asking.join(answer, ["vec", "salt"]).select("query_id", F.posexplode(F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, nearest)).alias("pos", "x"))
    return out.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {"op10_nearest": op10_nearest}
ORACLE: dict[str, str] = {}
