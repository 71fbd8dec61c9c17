"""Balanced contiguous shards from global byte-size prefix sums.

Documents stand in one global order. Each range partition is sorted and sums up its sizes as
it is written; the partitions' totals give every partition's offset, and a document's place
is its offset plus the running sum inside its partition. The total is cut at equal targets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomline.llm.shared import written

#: Bytes that a document counts besides its text.
OVERHEAD = 8


def _running(kind: pa.Schema, at: int) -> Callable:
    """Adds the number of the partition and the sums of sizes and of rows up to each row of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        bytes_before, rows_before = 0, 0
        for batch in batches:
            upto = bytes_before + np.cumsum(batch.column(at).to_numpy())
            nth = rows_before + np.arange(1, batch.num_rows + 1)
            if batch.num_rows:
                bytes_before, rows_before = int(upto[-1]), int(nth[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, part), pa.int32()), pa.array(upto, pa.int64()), pa.array(nth, pa.int64())], schema=kind)

    return run


def _placed(rows: DataFrame, shards: int) -> DataFrame:
    """rows (doc_id, size, text_crc32, and any others) with their shard and slot."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ("text_crc32", "doc_id")
    kind = StructType([*rows.schema.fields, *StructType.fromDDL("part int, upto long, nth long").fields])
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # Written, so that places are the same ones however often they are read.
    ranged = written(ranged.mapInArrow(_running(to_arrow_schema(kind), rows.columns.index("size")), kind), "shard-ranges")
    totals = ranged.groupBy("part").agg(F.max("upto").alias("bytes"), F.max("nth").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        F.col("part").alias("p"),
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("byte0"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("row0"),
        F.sum("bytes").over(whole).alias("all"),
    )
    offsets = written(offsets, "shard-offsets")
    # One row per range partition, whose number is a setting.
    placed = ranged.join(F.broadcast(offsets), F.col("part") == F.col("p"))
    middle = (F.col("byte0") + F.col("upto")) * 2 - F.col("size")
    placed = placed.withColumn("shard", F.least(F.floor(middle.cast("double") * shards / (F.col("all") * 2)), F.lit(shards - 1)).cast("int")).withColumn("place", F.col("row0") + F.col("nth") - 1)
    first = written(placed.groupBy("shard").agg(F.min("place").alias("first")).withColumnRenamed("shard", "s"), "shard-firsts")
    out = placed.join(F.broadcast(first), F.col("shard") == F.col("s"))
    return out.select(*rows.columns, "shard", (F.col("place") - F.col("first")).cast("long").alias("slot"))


def _measured(docs: DataFrame, *more) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), *more)


def shard(docs: DataFrame, shards: int = 24) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The order is (text_crc32, doc_id), null ids first, so equal texts stand together and
    at most shards - 1 groups of them are cut. A document belongs to the shard that holds
    the middle of its bytes, so a shard's bytes miss the equal target by at most the
    larger of the documents at its two ends. Null texts count as empty: size 8, crc 0.
    Rows with the same id and text are alike in everything returned but the slot. An empty
    table gives an empty one; other columns play no part.
    """
    out = _placed(_measured(docs), shards)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """Every row of docs with all its columns, and `shard` and `slot` as `shard` deals them.

    Texts are shuffled once, into the global order. A column of docs that is called shard or
    slot gives way. What holds for nulls, repeated rows and empty tables is said at `shard`.
    """
    columns = [c for c in docs.columns if c not in ("shard", "slot")]
    out = _placed(_measured(docs, F.struct(*(docs[f"`{c}`"] for c in columns)).alias("row")), shards)
    return out.select("row.*", "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int = 24) -> None:
    """Writes whole documents under path/shard=NN, each shard in slot order, by several tasks."""
    parts = max(shards, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    whole = shard_documents(docs, shards)
    whole.repartitionByRange(parts, "shard", "slot").sortWithinPartitions("shard", "slot").drop("slot").write.partitionBy("shard").parquet(path)


def op9_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(spark.read.parquet(f"{sf_dir}/documents.parquet"), 24)


QUERIES = {"op9_byte_shards": op9_byte_shards}
ORACLE: dict[str, str] = {}
