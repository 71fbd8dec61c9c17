"""Distance of stage names by the cost of moving one name's words onto the other's.

Words get vectors from the log itself: what stands in the stages before and after. Names
whose mean vectors are farther apart than the wanted distance cannot be within it, as moving
words costs at least what moving their mean does; only the others are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.eventlog import EventLog
from loomline.operators.cluster import clean_stages, components
from loomline.sources.scratch import written

#: Components of a word vector: the hex digits of a context's MD5, whose upper bits are signs.
DIMS = 32
#: Coordinates whose cells bring names together, and names of a cell that meet others in one place.
AXES = 3
BLOCK = 1024


def word_vectors(log: EventLog) -> DataFrame:
    """(word, vector): unit vectors of the words of all stage names of the log.

    A word's contexts are the words of the stage before and of the stage after, in the same
    case, weighted by positive pointwise information, and the word itself with weight 1.
    Each context adds its weight to every component, with a sign of its hash. Events without
    a case or an activity are no neighbours.
    """
    stages = clean_stages(log.df, log.activity).withColumn("words", _words("cleaned"))
    cases = replace(log, df=log.df.filter(F.col(log.case).isNotNull()))
    base = cases.base().filter("activity IS NOT NULL AND next_activity IS NOT NULL")
    edges = base.groupBy("activity", "next_activity").agg(F.count(F.lit(1)).alias("n"))
    a, b = stages.select(F.col("stage").alias("activity"), F.col("words").alias("wa")), stages.select(F.col("stage").alias("next_activity"), F.col("words").alias("wb"))
    met = edges.join(a, "activity").join(b, "next_activity").select("n", F.explode("wa").alias("wa"), "wb").select("n", "wa", F.explode("wb").alias("wb"))
    met = met.groupBy("wa", "wb").agg(F.sum("n").alias("n"))
    both = F.array(F.struct(F.col("wa").alias("word"), F.concat(F.lit("after:"), "wb").alias("context")), F.struct(F.col("wb").alias("word"), F.concat(F.lit("before:"), "wa").alias("context")))
    seen = written(met.select("n", F.explode(both).alias("x")).select("x.word", "x.context", "n"), "word-contexts")
    words = seen.groupBy("word").agg(F.sum("n").alias("n_word"))
    contexts = seen.groupBy("context").agg(F.sum("n").alias("n_context"))
    total = seen.agg(F.sum("n")).first()[0] or 1
    weight = F.log(F.col("n") * F.lit(float(total)) / (F.col("n_word").cast("double") * F.col("n_context")))
    known = seen.join(words, "word").join(contexts, "context").select("word", "context", weight.alias("weight")).filter("weight > 0")
    own = stages.select(F.explode("words").alias("word")).distinct().select("word", F.concat(F.lit("own:"), "word").alias("context"), F.lit(1.0).alias("weight"))
    rows = known.unionByName(own).withColumn("signs", F.md5("context"))
    sums = [F.sum(F.when(F.substring("signs", i + 1, 1) < "8", F.col("weight")).otherwise(-F.col("weight"))) for i in range(DIMS)]
    raw = rows.groupBy("word").agg(F.array(*sums).alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    return raw.select("word", F.transform("v", lambda x: F.when(norm > 0, x / norm).otherwise(0.0)).alias("vector"))


def _words(c: str) -> Column:
    return F.array_sort(F.array_remove(F.split(c, " "), ""))


def _plan_costs(a: np.ndarray, b: np.ndarray, cost: np.ndarray, least: float = 0.002, rounds: int = 20) -> np.ndarray:
    """Cost of moving a (pairs, m) onto b (pairs, n), each adding up to 1, by Sinkhorn rounds.

    The smoothing is halved down to `least`, in logarithms; the last plan is then mended to
    have exactly the wanted sums, so that its cost is never below the optimum.
    """
    la, lb = np.log(a), np.log(b)
    f, g = np.zeros_like(a), np.zeros_like(b)

    def soft(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis=axis, keepdims=True)
        return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))

    smooth = 0.5
    while True:
        for _ in range(rounds):
            f = smooth * (la - soft((g[:, None, :] - cost) / smooth, 2))
            g = smooth * (lb - soft((f[:, :, None] - cost) / smooth, 1))
        if smooth <= least:
            break
        smooth = max(least, smooth / 2)
    plan = np.exp((f[:, :, None] + g[:, None, :] - cost) / smooth)
    plan *= np.minimum(1, a / np.maximum(plan.sum(axis=2), 1e-300))[:, :, None]
    plan *= np.minimum(1, b / np.maximum(plan.sum(axis=1), 1e-300))[:, None, :]
    more, less = a - plan.sum(axis=2), b - plan.sum(axis=1)
    rest = more.sum(axis=1)
    plan += more[:, :, None] * less[:, None, :] / np.where(rest > 1e-15, rest, 1)[:, None, None]
    return (plan * cost).sum(axis=(1, 2))


def _costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distance of each pair from their words' vectors; pairs of equal shape are done together."""
    for batch in batches:
        va, vb = batch.column("va"), batch.column("vb")
        la, lb = (np.diff(v.offsets.to_numpy()) for v in (va, vb))
        fa, fb = (v.flatten().flatten().to_numpy(zero_copy_only=False).reshape(-1, DIMS) for v in (va, vb))
        sa, sb = np.cumsum(la) - la, np.cumsum(lb) - lb
        out = np.zeros(batch.num_rows)
        for m, n in {*zip(la.tolist(), lb.tolist(), strict=True)}:
            size = max(1, (1 << 20) // (m * n))
            of = np.flatnonzero((la == m) & (lb == n))
            for i in range(0, len(of), size):
                some = of[i : i + size]
                x, y = fa[sa[some, None] + np.arange(m)], fb[sb[some, None] + np.arange(n)]
                cost = np.sqrt(np.maximum((x * x).sum(-1)[:, :, None] + (y * y).sum(-1)[:, None, :] - 2 * np.einsum("pmd,pnd->pmn", x, y), 0))
                out[some] = _plan_costs(np.full((len(some), m), 1 / m), np.full((len(some), n), 1 / n), cost)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(out)], names=["a", "b", "distance"])


def _named(stages: DataFrame, vectors: DataFrame) -> DataFrame:
    """(stage, bag, vectors, mean) of names that have words; words may repeat."""
    words = stages.select("stage", F.col("words").alias("bag"), F.posexplode("words").alias("i", "word"))
    each = words.join(vectors, "word").groupBy("stage", "bag").agg(F.collect_list("vector").alias("vectors"))
    total = F.aggregate("vectors", F.array(*[F.lit(0.0)] * DIMS), lambda s, v: F.zip_with(s, v, lambda x, y: x + y))
    return each.withColumn("mean", F.transform(total, lambda x: x / F.size("vectors")))


def _near(names: DataFrame, distance: float) -> DataFrame:
    """(a, b), a < b: names whose mean vectors lie within the distance.

    They meet through cells of that width along the axes on which means differ most; a full
    cell's names are dealt over blocks, each of which sees all that come to the cell.
    """
    wide = names.agg(*(F.var_pop(F.col("mean")[i]).alias(str(i)) for i in range(DIMS))).first()
    axes = sorted(range(DIMS), key=lambda i: (-(wide[i] or 0.0), i))[:AXES]
    width = max(distance, 1e-6)
    cells = [F.floor(F.col("mean")[i] / width) for i in axes]
    placed = written(names.select("stage", "mean", F.array(*cells).alias("cell")), "name-cells")
    full = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    left = placed.join(full, "cell").select(F.col("stage").alias("a"), F.col("mean").alias("ma"), "cell", F.pmod(F.xxhash64("stage"), F.col("blocks")).cast("int").alias("block"))
    around = F.array(*(F.array(*(F.col("cell")[k] + (j // 3**k % 3 - 1) for k in range(AXES))) for j in range(3**AXES)))
    right = placed.select(F.col("stage").alias("b"), F.col("mean").alias("mb"), F.explode(around).alias("cell")).join(full, "cell")
    right = right.select("b", "mb", "cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    apart = F.sqrt(F.aggregate(F.zip_with("ma", "mb", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    return left.join(right, ["cell", "block"]).filter((F.col("a") < F.col("b")) & (apart <= distance + 1e-9)).select("a", "b")


def transport_pairs(log: EventLog, distance: float) -> DataFrame:
    """(a, b, distance): pairs of stage names, a < b, whose words are moved onto each other at no more than that cost.

    Each word of a name has an equal share, a repeated one several; moving a share costs the
    distance of the two words' vectors. Costs come from Sinkhorn rounds: at least the optimum,
    and by less than 0.002 times the logarithm of the number of words above it once the rounds
    have settled. Names of the same words are 0 apart and appear as pairs with the smallest of
    them only, which stands for them all in other pairs. Placeholders, null, and names
    without words pair with nothing.
    """
    stages = clean_stages(log.df, log.activity).withColumn("words", _words("cleaned")).filter(F.size("words") > 0)
    stages = written(stages.select("stage", "words"), "name-bags")
    firsts = stages.groupBy("words").agg(F.min("stage").alias("first"))
    bags = written(stages.join(firsts, "words"), "name-bags")
    vectors = written(word_vectors(log), "word-vectors")
    names = written(_named(bags.filter("stage = first"), vectors), "name-vectors")
    met = _near(names, distance)
    sides = [names.select(F.col("stage").alias(s), F.col("vectors").alias(f"v{s}")) for s in "ab"]
    found = met.join(sides[0], "a").join(sides[1], "b").select("a", "b", "va", "vb")
    moved = found.mapInArrow(_costs, "a string, b string, distance double").filter(F.col("distance") <= distance)
    same = bags.filter("stage <> first").select(F.col("first").alias("a"), F.col("stage").alias("b"), F.lit(0.0).alias("distance"))
    return moved.unionByName(same)


def transport_clusters(log: EventLog, generalising: float = 0.5) -> DataFrame:
    """(stage, cluster): names linked within 0.1 + 0.65 * generalising; the cluster is its smallest name.

    Names without a link have cluster null. Values beyond [0, 1] count as 0.5.
    """
    if not 0 <= generalising <= 1:
        generalising = 0.5
    labels = components(transport_pairs(log, 0.1 + 0.65 * generalising).select("a", "b"))
    names = clean_stages(log.df, log.activity).select(F.col("stage").alias("name"))
    return names.join(labels, F.col("name") == F.col("stage"), "left").select(F.col("name").alias("stage"), "cluster")
