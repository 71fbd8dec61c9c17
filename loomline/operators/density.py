"""Density clusters of points in a few dimensions, exact, by cells and joins."""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.operators.cluster import STEP_COLUMNS, components, word_steps
from loomline.sources.scratch import small, written

#: Distinct points of a cell that one task meets; a cell with more is dealt over several.
BLOCK = 4096


def _sum(parts) -> Column:
    return reduce(lambda a, b: a + b, parts)


def _apart(a: list[Column], b: list[Column]) -> Column:
    """The squared distance of two points."""
    return _sum((x - y) * (x - y) for x, y in zip(a, b, strict=True))


class _Grid:
    """Cells so small that any two points of one lie within eps of each other."""

    def __init__(self, d: int, eps: int):
        self.d, self.eps = d, eps
        self.side = next(s for s in range(int(eps / d**0.5) + 1, 0, -1) if d * (s - 1) ** 2 <= eps * eps)
        self.reach = (eps + self.side - 1) // self.side
        # Cells further apart than eps, even at their nearest corners, never meet.
        gap = lambda o: sum((max(abs(x) - 1, 0) * self.side + (x != 0)) ** 2 for x in o)
        self.steps = [o for o in product(range(-self.reach, self.reach + 1), repeat=d) if gap(o) <= eps * eps]

    def cell(self) -> Column:
        return F.array(*(F.floor(F.col(f"x{i}") / F.lit(self.side)).cast("long") for i in range(self.d)))

    def around(self, cell: str, forward: bool = False) -> Column:
        """A row for each cell that may hold a point within eps; forward, of each pair of cells one half."""
        steps = [o for o in self.steps if not forward or o > (0,) * self.d]
        return F.explode(F.array(*(F.array(*(F.col(cell)[i] + o[i] for i in range(self.d))) for o in steps)))


def _met(left: DataFrame, right: DataFrame, grid: _Grid) -> DataFrame:
    """Pairs of left's points (x0.., cell) and right's (y0.., salted by block) within eps, with their squared distance."""
    sizes = small(written(right.groupBy("cell").agg((F.floor(F.count("*") / BLOCK) + 1).cast("int").alias("blocks")), "density-blocks"))
    point = F.struct(*(F.col(f"x{i}") for i in range(grid.d)))
    dealt = right.join(sizes, "cell").withColumn("block", F.pmod(F.xxhash64(point), F.col("blocks")).cast("int"))
    dealt = dealt.select("cell", "block", *(F.col(f"x{i}").alias(f"y{i}") for i in range(grid.d)), *(F.col(c).alias(f"y_{c}") for c in right.columns if c not in ("cell", *(f"x{i}" for i in range(grid.d)))))
    asks = left.withColumn("cell", grid.around("cell")).join(sizes, "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    apart = _apart([F.col(f"x{i}") for i in range(grid.d)], [F.col(f"y{i}") for i in range(grid.d)])
    return asks.join(dealt, ["cell", "block"]).withColumn("apart", apart).filter(F.col("apart") <= grid.eps * grid.eps)


def _boxes(cores: DataFrame, grid: _Grid, level: int) -> DataFrame:
    """Bounds and a point of the cores in each box; a cell has 2^level boxes a side, and boxes nest."""
    at = F.array(*(F.floor((F.col(f"x{i}") - F.col("cell")[i] * grid.side) * (1 << level) / grid.side).cast("long") for i in range(grid.d)))
    bounds = [g(f"x{i}").alias(f"{n}{i}") for i in range(grid.d) for g, n in ((F.min, "lo"), (F.max, "hi"))]
    return cores.groupBy("cell", at.alias("box")).agg(*bounds, F.min(F.struct(*(F.col(f"x{i}") for i in range(grid.d)))).alias("point"))


def _linked(cores: DataFrame, grid: _Grid) -> DataFrame:
    """(a, b): cells that hold two cores within eps of each other.

    Boxes of both cells are compared: all their points may be near, or none, or a point of
    each may show the link; else both are cut into halves, for as long as neither is so. No
    pairs of points are made, so cells with many points meet cheaply.
    """
    cells = cores.select("cell").distinct()
    pairs = cells.select(F.col("cell").alias("a"), grid.around("cell", forward=True).alias("b")).join(cells.select(F.col("cell").alias("b")), "b", "left_semi")
    root = F.array(*[F.lit(0).cast("long")] * grid.d)
    open_pairs = written(pairs.select("a", "b", root.alias("pa"), root.alias("pb")), "density-pairs")
    found = None
    limit = F.lit(grid.eps * grid.eps)
    for level in range(64):
        if open_pairs.isEmpty():
            break
        asked = open_pairs.select(F.col("a").alias("cell")).union(open_pairs.select("b")).distinct()
        boxes = written(_boxes(cores.join(asked, "cell", "left_semi"), grid, level), "density-boxes")
        parent = F.transform("box", lambda v: F.floor(v / 2).cast("long")) if level else F.col("box")
        named = lambda s: boxes.select(F.col("cell").alias(s), parent.alias(f"p{s}"), *(F.col(c).alias(f"{c}_{s}") for c in boxes.columns if c != "cell"))  # noqa: B023, E731
        both = open_pairs.join(named("a"), ["a", "pa"]).join(named("b"), ["b", "pb"])
        far, near = [], []
        for i in range(grid.d):
            lo_a, hi_a, lo_b, hi_b = (F.col(c) for c in (f"lo{i}_a", f"hi{i}_a", f"lo{i}_b", f"hi{i}_b"))
            gap, span = F.greatest(lo_a - hi_b, lo_b - hi_a, F.lit(0)), F.greatest(hi_a - lo_b, hi_b - lo_a)
            near.append(gap * gap)
            far.append(span * span)
        points = _apart([F.col(f"point_a.x{i}") for i in range(grid.d)], [F.col(f"point_b.x{i}") for i in range(grid.d)])
        judged = both.filter(_sum(near) <= limit).select("a", "b", F.col("box_a").alias("pa"), F.col("box_b").alias("pb"), ((_sum(far) <= limit) | (points <= limit)).alias("sure"))
        judged = written(judged, "density-judged")
        sure = judged.filter("sure").select("a", "b").distinct()
        found = sure if found is None else found.union(sure)
        open_pairs = written(judged.drop("sure").join(sure, ["a", "b"], "left_anti"), "density-pairs")
    empty = pairs.select("a", "b").limit(0)
    return found if found is not None else empty


def density_clusters(df: DataFrame, key: str, columns: list[str], eps: int, min_rows: int = 2) -> DataFrame:
    """(key, cluster, core) of every row: DBSCAN on whole-number columns, Euclidean distance.

    A row is a core if at least min_rows rows, itself included, lie within eps. Cores within
    eps share a cluster, named by its cores' smallest key. Any other row joins the cluster of
    its nearest core within eps, of several equally near the one with the smallest key; none
    near, its cluster is null: noise. Rows with a null coordinate are noise too. Equal rows
    share their fate; keys should be unique, or a key has as many rows as it came with.

    Points that fall together are counted once with their weight. A cell's side is so chosen
    that it lies within eps as a whole; so where it has min_rows rows, all are cores without
    any pairing, and only points of emptier cells, fewer than min_rows each, look around.
    Coordinates must stay below 2^30 in size and eps between 1 and 2^29; one to four columns.
    """
    d = len(columns)
    if not 1 <= d <= 4:
        raise ValueError("one to four columns are clustered")
    if not 1 <= eps < 1 << 29 or min_rows < 1:
        raise ValueError("eps must be from 1 to 2^29 and min_rows at least 1")
    grid = _Grid(d, eps)
    xs = [f"x{i}" for i in range(d)]
    rows = written(df.select(F.col(f"`{key}`").alias("key"), *(F.col(f"`{c}`").cast("long").alias(x) for c, x in zip(columns, xs, strict=True))), "density-rows")
    points = rows.dropna(subset=xs).groupBy(*xs).agg(F.count("*").alias("w"), F.min("key").alias("least")).withColumn("cell", grid.cell())
    points = written(points, "density-points")
    full = points.groupBy("cell").agg(F.sum("w").alias("n")).filter(F.col("n") >= min_rows).select("cell")
    full = written(full, "density-full")
    sparse = written(points.join(full, "cell", "left_anti"), "density-sparse")
    counted = _met(sparse.select(*xs, "cell"), points.select(*xs, "cell", "w"), grid).groupBy(*xs).agg(F.sum("y_w").alias("n")).filter(F.col("n") >= min_rows).select(*xs)
    cores = points.join(full, "cell", "left_semi").unionByName(sparse.join(counted, xs, "left_semi"))
    cores = written(cores.select(*xs, "cell", "least"), "density-cores")
    # All cores of a cell lie within eps, so cells stand for them; a cell's name is its smallest key.
    names = written(cores.groupBy("cell").agg(F.min("least").alias("name")), "density-names")
    edges = _linked(cores, grid).join(names.toDF("a", "na"), "a").join(names.toDF("b", "nb"), "b").select(F.col("na").alias("a"), F.col("nb").alias("b"))
    labels = components(edges).toDF("name", "label")
    named = written(names.join(labels, "name", "left").select("cell", F.coalesce("label", "name").alias("cluster")), "density-labels")
    inside = cores.join(named, "cell").select(*xs, "cluster", "least", F.lit(True).alias("core"))
    loose = sparse.join(cores.select(*xs), xs, "left_anti")
    touching = _met(loose.select(*xs, "cell"), inside.select(*xs, "cluster", "least").withColumn("cell", grid.cell()), grid)
    border = touching.groupBy(*xs).agg(F.min_by("y_cluster", F.struct("apart", "y_least")).alias("cluster")).select(*xs, "cluster", F.lit(False).alias("core"))
    placed = inside.drop("least").unionByName(border)
    return rows.join(placed, xs, "left").select(F.col("key").alias(key), "cluster", F.coalesce("core", F.lit(False)).alias("core"))


#: Whole numbers in a unit of projected texts.
SCALE = 1 << 20


def projected_texts(df: DataFrame, text: str, dimension: int = 2, features: int = 1 << 10, language: str = "english") -> DataFrame:
    """df with x0, x1, ...: its texts on the principal components of their words, in whole numbers. Null counts as empty."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    filled = df.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    placed = Pipeline(stages=word_steps(features, language, dimension)).fit(filled).transform(filled)
    at = vector_to_array("_pca")
    return placed.select(*(F.col(f"`{c}`") for c in df.columns), *(F.round(at[i] * SCALE).cast("long").alias(f"x{i}") for i in range(dimension)))


def text_density_clusters(df: DataFrame, key: str, text: str, eps: float = 0.02, min_rows: int = 2, dimension: int = 2, language: str = "english") -> DataFrame:
    """(key, cluster, core) of texts by density in the space of their principal components; eps is a distance there."""
    placed = written(projected_texts(df.select(key, text), text, dimension, language=language), "density-texts")
    return density_clusters(placed, key, [f"x{i}" for i in range(dimension)], max(1, round(eps * SCALE)), min_rows)
