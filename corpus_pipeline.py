"""A training corpus from raw documents: quality, near duplicates, leaks, mixing, shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomline.llm.decontaminate import drop_contaminated
from loomline.llm.jaccard import keep_one
from loomline.llm.mixing import apply_mix
from loomline.llm.quality import keep_good
from loomline.llm.shared import written
from loomline.llm.sharding import shard_documents


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier rejects.

    Null and empty texts have a score too. Without labels of both classes all scores are
    alike, so that all documents stay or go together; an empty table stays empty.
    """
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component of the n-gram Jaccard join, the one with the smallest id.

    Texts without words, and rows without an id, link with nothing and stay.
    """
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a window of a benchmark item. Texts without words, and all if there are no items, stay."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents so that their sources, null among them, meet the target weights. Texts without words go."""
    return apply_mix(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard, 0 to 23, and its place in it.

    Null and empty texts count 8 bytes; repeated rows have places of their own.
    """
    return shard_documents(docs, 24)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: A trained classifier and winnowed hits have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
