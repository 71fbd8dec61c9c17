"""Centroid clustering by plain Lloyd rounds in exact whole numbers."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm.shared import written

#: Below this size of a component, squared distances of 64 components fit in 64 bits with room.
_FITS = 1 << 27
#: Rows compared at once.
_ROWS = 8192


def whole_vectors(vectors: DataFrame, dims: int = 64, scale: int = 256) -> DataFrame:
    """(vec_id, q): vectors (vec_id, embedding) of dims components, none null or non-finite, as floor(scale * x)."""
    x = F.col("embedding")
    kept = vectors.select("vec_id", F.transform(x, lambda c: c.cast("double")).alias("x")).filter((F.size("x") == dims) & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    # Spark's floor to a long would cut off at its ends, and x times scale may be infinite.
    largest = F.lit(float(1 << 62) / scale)
    checked = F.transform("x", lambda c: F.when(F.abs(c) < largest, F.floor(c * scale)).otherwise(F.raise_error(F.lit("a component is too large for whole numbers of 64 bits"))).cast("long"))
    return kept.select("vec_id", checked.alias("q"))


def _nearest(q: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row, the lowest number on ties, and its squared distance."""
    exact = max(np.abs(q).max(initial=0), np.abs(centroids).max(initial=0)) < _FITS and q.shape[1] <= 64
    kind = np.int64 if exact else object
    q, best = q.astype(kind), np.empty((len(centroids), len(q)), kind)
    for i, c in enumerate(centroids.astype(kind)):
        d = q - c
        best[i] = np.einsum("ij,ij->i", d, d) if exact else (d * d).sum(axis=1)
    cluster = best.argmin(axis=0) if exact else np.array([min(range(len(centroids)), key=row.__getitem__) for row in best.T], np.int64)
    return cluster, best[cluster, np.arange(len(q))]


def _pieces(frames: Iterator[pd.DataFrame], dims: int) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    for frame in frames:
        for i in range(0, len(frame), _ROWS):
            piece = frame.iloc[i : i + _ROWS]
            yield piece, np.stack(piece["q"].to_numpy()) if len(piece) else np.zeros((0, dims), np.int64)


def _sums(shared, dims: int) -> Callable:
    """Per partition, cluster and component the sum, and as component -1 the count."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centroids = shared.value
        sums, n = np.zeros((len(centroids), dims), object), np.zeros(len(centroids), np.int64)
        for _, q in _pieces(frames, dims):
            cluster, _ = _nearest(q, centroids)
            for c in np.unique(cluster):
                own = q[cluster == c]
                sums[c] += own.sum(axis=0) if np.abs(own).max(initial=0) < _FITS else own.astype(object).sum(axis=0)
                n[c] += len(own)
        rows = [(c, i, str(x)) for c in np.flatnonzero(n) for i, x in enumerate((int(n[c]), *sums[c]), -1)]
        yield pd.DataFrame(rows, columns=["cluster", "component", "total"])

    return run


def _assigned(shared, dims: int) -> Callable:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for piece, q in _pieces(frames, dims):
            cluster, distance = _nearest(q, shared.value)
            if len(distance) and distance.max() >= 1 << 63:
                raise OverflowError("a squared distance is too large for 64 bits")
            yield pd.DataFrame({"vec_id": piece["vec_id"].to_numpy(), "cluster": cluster.astype(np.int32), "distance": distance.astype(np.int64)})

    return run


def first_centroids(whole: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors whose ids have the smallest hashes, in that order; k rows come to the driver. Equal ids go by their components, null ids last."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return np.array([r.q for r in whole.orderBy(key.asc_nulls_last(), "q").limit(k).collect()], np.int64)


def lloyd(whole: DataFrame, centroids: np.ndarray, rounds: int) -> np.ndarray:
    """Centroids after so many rounds; a round brings at most one row for each centroid and component to the driver."""
    context = whole.sparkSession.sparkContext
    for _ in range(rounds):
        shared = context.broadcast(centroids)
        parts = whole.mapInPandas(_sums(shared, centroids.shape[1]), "cluster int, component int, total string")
        totals = parts.groupBy("cluster", "component").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
        shared.unpersist()
        count = {r.cluster: int(r.total) for r in totals if r.component < 0}
        centroids = centroids.copy()
        for r in totals:
            if r.component >= 0:
                centroids[r.cluster, r.component] = int(r.total) // count[r.cluster]
    return centroids


def cluster_vectors(vectors: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2, dims: int = 64, scale: int = 256) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector kept.

    Vectors that are null, of another length or hold a null or non-finite component are
    left out; null and repeated ids take part. With fewer than k vectors each begins as a
    centroid, with none the result is empty. Ties go to the smaller number. Components of
    2^62 / scale or more, and distances beyond 64 bits, raise an error. Other columns play
    no part.
    """
    spark = vectors.sparkSession
    out = f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, cluster int, distance long"
    whole = written(whole_vectors(vectors, dims, scale), "lloyd-vectors")
    centroids = first_centroids(whole, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], f"{out}, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = lloyd(whole, centroids, rounds)
    assigned = written(whole.mapInPandas(_assigned(spark.sparkContext.broadcast(centroids), dims), out), "lloyd-assigned")
    inertia = {r.cluster: int(r.total) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    of = F.col("cluster") + 1
    return assigned.select(
        "vec_id",
        "cluster",
        "distance",
        F.element_at(F.array(*(F.lit(inertia.get(c, 0)).cast("long") for c in range(len(centroids)))), of).alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        F.element_at(F.array(*(F.lit(hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for c in centroids.tolist())), of).alias("centroid_sha256"),
    )


def op11_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _oracle(k: int = 40, rounds: int = 5, seed: int = 2, dims: int = 64, scale: int = 256) -> str:
    distance = "list_sum([(v.q[i] - c.q[i]) * (v.q[i] - c.q[i]) FOR i IN range(1, {n})])".format(n=dims + 1)
    ctes = [
        f"""e AS (
  SELECT vec_id, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q FROM embeddings
  WHERE len(embedding) = {dims} AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding])
)""",
        f"c0 AS (SELECT row_number() OVER (ORDER BY h, q) - 1 AS c, q FROM (SELECT sha256('{seed}:' || vec_id) AS h, q FROM e ORDER BY h, q LIMIT {k}))",
    ]
    for r in range(rounds + 1):
        ctes.append(f"d{r} AS MATERIALIZED (SELECT v.vec_id, v.q, c.c, CAST({distance} AS BIGINT) AS d FROM e v, c{r} c)")
        ctes.append(f"a{r} AS MATERIALIZED (SELECT vec_id, q, arg_min(c, (d, c)) AS c, min(d) AS d FROM d{r} GROUP BY vec_id, q)")
        if r < rounds:
            ctes.append(f"s{r} AS (SELECT c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (SELECT c, unnest(q) AS x, unnest(range({dims})) AS i FROM a{r}) GROUP BY c, i)")
            ctes.append(f"m{r} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS q FROM s{r} GROUP BY c)")
            ctes.append(f"c{r + 1} AS MATERIALIZED (SELECT c{r}.c, coalesce(m{r}.q, c{r}.q) AS q FROM c{r} LEFT JOIN m{r} ON c{r}.c = m{r}.c)")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT vec_id, CAST(a.c AS INT) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON a.c = c.c
"""


QUERIES = {"op11_lloyd": op11_lloyd}
ORACLE = {"op11_lloyd": _oracle()}
