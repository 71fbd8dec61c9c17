"""Quality classifier: a support vector machine on naive Bayes features.

A text is the set of its n-grams of bytes, hashed to a fixed number of features. Each
indicator is scaled by the log ratio of its frequencies in the two classes, counted over
all labelled rows. A linear hinge loss is minimised by dual coordinate descent, on a
bounded sample of labelled rows, in shards whose weights are averaged; a logistic curve on
the margins that each shard's rows get from the other shards gives scores from 0 to 1.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm.shared import packed, small, written
from loomline.llm.words import mix, text_slices

BITS = 17
GRAMS = (2, 3, 4)
#: Labelled rows on which the margin is fitted, about; they are chosen by hash of the id.
SAMPLE = 20_000
SHARDS = 8
EPOCHS = 12
COST = 1.0


def feature_sets(column: pa.Array, bits: int = BITS) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, distinct features of each row) of runs of rows; whole texts, case kept."""
    for first, data, offsets in text_slices(column):
        wide = data.astype(np.uint64)
        runs = []
        for n in GRAMS:
            acc = np.full(max(0, len(wide) - n + 1), n, dtype=np.uint64)
            for j in range(n):
                acc = acc * np.uint64(257) + wide[j : j + len(acc)] + np.uint64(1)
            runs.append((mix(acc) >> np.uint64(64 - bits)).astype(np.int32))
        seen = np.zeros(1 << bits, dtype=bool)
        out = []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            for n, run in zip(GRAMS, runs, strict=True):
                if b - a >= n:
                    seen[run[a : b - n + 1]] = True
            found = np.flatnonzero(seen).astype(np.int32)
            seen[found] = False
            out.append(found)
        yield first, out


def _class_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, 1 << BITS), dtype=np.int64)
    for batch in batches:
        labels = batch.column(1).to_numpy(zero_copy_only=False)
        for first, sets in feature_sets(batch.column(0)):
            for r, found in enumerate(sets):
                counts[int(labels[first + r])][found] += 1
    some = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[0][some]), pa.array(counts[1][some])], ["feature", "no", "yes"])


def _labelled_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, sets in feature_sets(batch.column(0)):
            yield pa.RecordBatch.from_arrays([batch.column(1).slice(first, len(sets)), batch.column(2).slice(first, len(sets)), pa.array(sets, pa.list_(pa.int32()))], ["label", "shard", "features"])


def dual_descent(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, epochs: int = EPOCHS, cost: float = COST, seed: int = 0) -> np.ndarray:
    """Weights of the hinge loss over unit vectors ratio[features]; the last one is the bias.

    Each step sets one row's multiplier, in [0, cost], to the best value with all others held.
    """
    w = np.zeros(len(ratio) + 1)
    values = []
    for found in rows:
        x = ratio[found]
        values.append(x / (np.sqrt(x @ x) or 1.0))
    alpha = np.zeros(len(rows))
    norms = [float(x @ x) + 1.0 for x in values]
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            found, x, y = rows[i], values[i], labels[i]
            slope = y * (w[found] @ x + w[-1]) - 1.0
            new = min(max(alpha[i] - slope / norms[i], 0.0), cost)
            if new != alpha[i]:
                step = (new - alpha[i]) * y
                alpha[i] = new
                w[found] += step * x
                w[-1] += step
    return w


def _train(ratio) -> Callable:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [np.asarray(x, dtype=np.int32) for x in pdf["features"]]
        w = dual_descent(rows, pdf["label"].to_numpy() * 2.0 - 1.0, ratio.value)
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "rows": [len(rows)], "w": [w.tobytes()]})

    return run


def logistic(margin: np.ndarray, a: float, b: float) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(a * margin + b, -40, 40)))


def fit_logistic(margin: np.ndarray, yes: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve of smoothed targets, by Newton's method."""
    up, down = (yes.sum() + 1) / (yes.sum() + 2), 1 / (len(yes) - yes.sum() + 2)
    target = np.where(yes > 0, up, down)
    x = np.stack((margin, np.ones(len(margin))))
    p = np.zeros(2)
    for _ in range(50):
        q = logistic(margin, *p)
        curve = (x * (q * (1 - q) + 1e-9)) @ x.T + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, x @ (q - target) + 1e-3 * p)
        size = np.abs(step).max()
        p = p - step * min(1.0, 5.0 / max(size, 1e-12))
        if size < 1e-7:
            break
    return float(p[0]), float(p[1])


@dataclass
class QualityModel:
    """weight holds the product of ratio and margin weight; a and b place the logistic curve."""

    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    a: float
    b: float

    def margins(self, sets: list[np.ndarray]) -> np.ndarray:
        out = np.empty(len(sets))
        for i, found in enumerate(sets):
            x = self.ratio[found]
            out[i] = (self.weight[found].sum() / (np.sqrt(x @ x) or 1.0)) + self.bias
        return out

    def score(self, sets: list[np.ndarray]) -> np.ndarray:
        return logistic(self.margins(sets), self.a, self.b)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, sample: int = SAMPLE) -> QualityModel:
    """A model from the labelled rows whose crc32(doc_id as text) mod `folds` is not 0.

    Class frequencies are counted over all of them; the margin sees about `sample`. Several
    labels of one id count as their rounded mean; null labels and ids count as absent. With
    no labels of a class the scores are constant: the share of label 1, or 0.5 without any.
    """
    spark = docs.sparkSession
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_id")).agg((F.avg(label) >= 0.5).cast("int").alias("_label"))
    known = known.filter(F.crc32(F.col("_id").cast("string")) % folds != 0)
    total = known.count()
    place = F.pmod(F.xxhash64("_id"), F.lit(1 << 30))
    known = known.select("_id", "_label", (place < int((1 << 30) * min(1.0, sample / max(total, 1)))).alias("_in"), F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(SHARDS)).cast("int").alias("_shard"))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(small(written(known, "quality-labels")), F.col("doc_id") == F.col("_id"))
    rows = written(rows.select("text", "_label", "_shard", "_in"), "quality-rows")
    counts = rows.select("text", "_label").mapInArrow(_class_counts, "feature int, no long, yes long").groupBy("feature").agg(F.sum("no").alias("no"), F.sum("yes").alias("yes")).toPandas()
    per = rows.groupBy("_label").count().collect()
    of = {r[0]: r[1] for r in per}
    size = 1 << BITS
    if len(of) < 2:
        share = min(max(sum(k * n for k, n in of.items()) / sum(of.values()), 1e-3), 1 - 1e-3) if of else 0.5
        return QualityModel(np.zeros(size), np.zeros(size), 0.0, 0.0, float(np.log(share / (1 - share))))
    yes, no = np.ones(size), np.ones(size)
    yes[counts["feature"]] += counts["yes"]
    no[counts["feature"]] += counts["no"]
    ratio = np.log((yes / yes.sum()) / (no / no.sum()))
    shared = spark.sparkContext.broadcast(ratio)
    chosen = rows.filter("_in").select("text", "_label", "_shard").mapInArrow(_labelled_features, "label int, shard int, features array<int>")
    fitted = chosen.groupBy("shard").applyInPandas(_train(shared), "shard int, rows long, w binary").collect()
    weights = {r.shard: np.frombuffer(r.w) for r in fitted}
    rows_of = {r.shard: r.rows for r in fitted}
    w = np.average([weights[k] for k in rows_of], axis=0, weights=[*rows_of.values()])
    model = QualityModel(ratio, w[:-1] * ratio, float(w[-1]), 1.0, 0.0)
    # The curve is fitted on the margins that the other shards' weights give a row, as those
    # of its own would look better than they are.
    others = {}
    for k in rows_of:
        rest = {j: n for j, n in rows_of.items() if j != k} or rows_of
        v = np.average([weights[j] for j in rest], axis=0, weights=[*rest.values()])
        others[k] = QualityModel(ratio, v[:-1] * ratio, float(v[-1]), 1.0, 0.0)
    held = spark.sparkContext.broadcast(others)

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in feature_sets(batch.column(0)):
                shard = batch.column(2).slice(first, len(sets)).to_pylist()
                margin = [float(held.value[k].margins([x])[0]) for k, x in zip(shard, sets, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(first, len(sets)), pa.array(margin, pa.float64())], ["label", "margin"])

    seen = rows.filter("_in").select("text", "_label", "_shard").mapInArrow(margins, "label int, margin double").toPandas()
    model.a, model.b = fit_logistic(seen["margin"].to_numpy(), seen["label"].to_numpy())
    return model


def scored(docs: DataFrame, model: QualityModel, name: str = "score") -> DataFrame:
    """docs with the model's score of each text; null and empty texts get that of no n-grams."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import DoubleType, StructField, StructType

    kind = StructType([*docs.schema.fields, StructField(name, DoubleType())])
    arrow = to_arrow_schema(kind)
    at = docs.columns.index("text")
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = [held.value.score(sets) for _, sets in feature_sets(batch.column(at).cast(pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(score) if score else [], pa.float64())], schema=arrow)

    return docs.mapInArrow(run, kind)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, held_out, score, predicted.

    held_out is whether crc32(doc_id as text) mod 5 is 0, false for a null id. The score of
    null, empty and long texts comes from the same formula over the whole text. Empty tables
    give no rows or constant scores. Other columns of docs and labels play no part.
    """
    model = fit(docs, labels)
    out = scored(docs.select("doc_id", F.col("text").cast("string").alias("text")), model)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """docs whose score reaches the threshold; their columns stay as they are."""
    model = fit(docs, labels)
    return scored(packed(docs), model).filter(F.col("score") >= threshold).select("row.*")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {"op5_quality": op5_quality}
ORACLE: dict[str, str] = {}
