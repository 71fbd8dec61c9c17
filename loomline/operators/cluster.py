"""Clusters of stage names by shared character n-grams, and of texts by word vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.sources.scratch import written

PLACEHOLDERS = (" ", ".", "..", "...", "")


def clean_stages(df: DataFrame, column: str) -> DataFrame:
    """(stage, cleaned): distinct names without null and placeholders; digits and punctuation go."""
    stages = df.select(F.col(column).alias("stage")).filter(F.col("stage").isNotNull() & ~F.col("stage").isin(*PLACEHOLDERS)).distinct()
    return stages.withColumn("cleaned", F.trim(F.regexp_replace(F.lower(F.regexp_replace("stage", r"[\p{Punct}\d]+", " ")), r"\s+", " ")))


def similar_stages(df: DataFrame, column: str, distance: float, n: int = 3) -> DataFrame:
    """(a, b, distance): pairs of stage names, a < b, whose n-gram Jaccard distance is at most that.

    Two such names share one of their first n-grams, rare before frequent, so pairs meet
    through these alone, where names are not too unlike in size.
    """
    stages = clean_stages(df, column)
    padded = F.concat(F.lit(" "), F.col("cleaned"), F.lit(" "))
    last = F.greatest(F.length(padded) - (n - 1), F.lit(1))
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(padded, i, F.lit(n))))
    sets = written(stages.select("stage", grams.alias("grams")), "stage-grams")
    rows = sets.select("stage", F.explode("grams").alias("gram"))
    often = rows.groupBy("gram").agg(F.count("*").alias("often"))
    least = max(0.0, 1.0 - distance)
    ranked = rows.join(often, "gram").groupBy("stage").agg(F.transform(F.array_sort(F.collect_list(F.struct("often", "gram"))), lambda x: x["gram"]).alias("grams"))
    size = F.size("grams")
    # Of names with no distance asked for, any n-gram may be the shared one.
    kept = F.greatest(size - F.ceil(size * least - 1e-9) + 1, F.lit(1)).cast("int")
    first = ranked.select("stage", size.alias("size"), F.explode(F.slice("grams", F.lit(1), F.least(kept, size))).alias("gram"))
    left, right = first.alias("a"), first.alias("b")
    near = (F.col("a.size") >= F.col("b.size") * least - 1e-9) & (F.col("b.size") >= F.col("a.size") * least - 1e-9)
    met = left.join(right, (F.col("a.gram") == F.col("b.gram")) & (F.col("a.stage") < F.col("b.stage")) & near).select(F.col("a.stage").alias("a"), F.col("b.stage").alias("b")).distinct()
    both = met.join(sets.toDF("a", "ga"), "a").join(sets.toDF("b", "gb"), "b")
    shared = F.size(F.array_intersect("ga", "gb"))
    return both.select("a", "b", (1 - shared / (F.size("ga") + F.size("gb") - shared)).alias("distance")).filter(F.col("distance") <= distance)


def components(edges: DataFrame) -> DataFrame:
    """(stage, cluster) for every end of the edges (a, b); the cluster is the smallest name reached.

    Each round maps a name to its smallest neighbour's smallest neighbour and keeps the edges
    whose ends still differ, so long chains take few rounds.
    """
    edges = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct(), "stage-edges")
    labels = edges.select(F.col("a").alias("stage")).union(edges.select("b")).distinct().withColumn("cluster", F.col("stage"))
    while not edges.isEmpty():
        ends = edges.union(edges.select("b", "a"))
        parent = written(ends.groupBy(F.col("a").alias("v")).agg(F.least(F.col("a"), F.min("b")).alias("p")), "stage-parents")
        parent = written(parent.join(parent.toDF("w", "q"), F.col("p") == F.col("w")).select("v", F.col("q").alias("p")), "stage-parents")
        labels = written(labels.join(parent, F.col("cluster") == F.col("v"), "left").select("stage", F.coalesce("p", "cluster").alias("cluster")), "stage-labels")
        moved = edges.join(parent.toDF("va", "pa"), F.col("a") == F.col("va")).join(parent.toDF("vb", "pb"), F.col("b") == F.col("vb")).filter("pa <> pb")
        edges = written(moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "stage-edges")
    return labels


def stage_clusters(df: DataFrame, column: str, generalising: float = 0.5) -> DataFrame:
    """(stage, cluster): names linked within 0.1 + 0.65 * generalising; the cluster is its smallest name.

    Names without a link are outliers with cluster null. Values beyond [0, 1] count as 0.5.
    """
    if not 0 <= generalising <= 1:
        generalising = 0.5
    labels = components(similar_stages(df, column, 0.1 + 0.65 * generalising).select("a", "b"))
    names = clean_stages(df, column).select(F.col("stage").alias("name"))
    return names.join(labels, F.col("name") == F.col("stage"), "left").select(F.col("name").alias("stage"), "cluster")


def with_clusters(df: DataFrame, column: str, clusters: DataFrame) -> DataFrame:
    """df with the cluster of its stage, null for outliers and placeholders."""
    named = clusters.select(F.col("stage").alias("_stage"), "cluster")
    return df.join(named, F.col(column) == F.col("_stage"), "left").drop("_stage")


def text_clusters(df: DataFrame, text: str, k: int = 8, features: int = 1 << 12, language: str = "english", seed: int = 1, dimension: int | None = None, kind: str = "kmeans", only_unique: bool = False) -> DataFrame:
    """df with text_cluster: clusters of hashed, weighted words, most common words left out.

    kind is kmeans or bisecting. With a dimension the words are projected on their principal
    components first; with only_unique the clusters are learnt from distinct texts, and
    equal texts share one. Null texts count as empty and get a cluster too.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.clustering import BisectingKMeans, KMeans

    kinds = {"kmeans": KMeans, "bisecting": BisectingKMeans}
    if kind not in kinds:
        raise ValueError(f"unknown kind {kind!r}; known are {', '.join(kinds)}")
    filled = df.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    steps = [*word_steps(features, language, dimension), kinds[kind](featuresCol="_pca" if dimension else "_unit", predictionCol="text_cluster", k=k, seed=seed, maxIter=10)]
    learnt = filled.select("_text").distinct() if only_unique else filled
    return Pipeline(stages=steps).fit(learnt).transform(filled).drop("_text", *STEP_COLUMNS)


STEP_COLUMNS = ("_words", "_kept", "_tf", "_idf", "_unit", "_pca")


def word_steps(features: int, language: str, dimension: int | None) -> list:
    """Stages from _text to _unit, hashed words weighted by rarity, and with a dimension to _pca."""
    from pyspark.ml.feature import IDF, PCA, HashingTF, Normalizer, RegexTokenizer, StopWordsRemover

    size = features if dimension is None else min(features, 1 << 10)
    return [
        RegexTokenizer(inputCol="_text", outputCol="_words", pattern=r"\W+"),
        StopWordsRemover(inputCol="_words", outputCol="_kept", stopWords=StopWordsRemover.loadDefaultStopWords(language)),
        HashingTF(inputCol="_kept", outputCol="_tf", numFeatures=size),
        IDF(inputCol="_tf", outputCol="_idf"),
        Normalizer(inputCol="_idf", outputCol="_unit"),
        *([PCA(inputCol="_unit", outputCol="_pca", k=dimension)] if dimension else []),
    ]
