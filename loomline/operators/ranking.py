"""Places of rows in a global order, and seeded permutations of rows, without a window over all of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from loomline.sources.scratch import small, written

#: Rows that are sorted by hash at a time; a task takes some eight such buckets.
BUCKET_ROWS = 50_000


def placed(df: DataFrame, *order: str, name: str = "place") -> DataFrame:
    """df with each row's place, from 0, in the order of these columns.

    Ranges are sorted on their own and their rows numbered as they are written, so that
    equal rows keep their places; the counts of the ranges before give the rest.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = StructType([*df.schema.fields, *StructType.fromDDL("_part int, _nth long").fields])
    schema = to_arrow_schema(kind)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), 0
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, part), pa.int32()), pa.array(np.arange(seen, seen + b.num_rows), pa.int64())], schema=schema)
            seen += b.num_rows

    rows = written(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(number, kind), "ranked")
    counts = rows.groupBy(F.col("_part").alias("_p")).agg(F.count(F.lit(1)).alias("_rows"))
    # One row for each range; their number is a setting.
    before = counts.select("_p", F.coalesce(F.sum("_rows").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(before), F.col("_part") == F.col("_p")).select(*df.columns, (F.col("_before") + F.col("_nth")).alias(name))


def permuted(df: DataFrame, key: str, columns: list[str], seeds: list[int]) -> DataFrame:
    """Every row of df once for each seed, with `seed` and, as p_<column>, the columns of another row.

    The row at place i by key gets those of the row at place i by the MD5 of key and seed:
    a permutation of the rows that follows from the seed. Rows of equal keys are in any order.
    Hashes spread evenly, so their order is cut into buckets of about BUCKET_ROWS, which
    are counted and then sorted on their own; the hash is made again where it is needed, as it
    would be most of what is shuffled.
    """
    own = placed(df, key)
    n = own.count()
    cut = max(1, -(-n // BUCKET_ROWS))
    text = F.md5(F.concat_ws(":", F.coalesce(F.col("_key").cast("string"), F.lit("")), "seed"))
    first = F.conv(F.substring(text, 1, 15), 16, 10).cast("long")
    other = df.select(F.col(key).alias("_key"), *(F.col(c).alias(f"p_{c}") for c in columns), F.explode(F.array(*map(F.lit, seeds))).alias("seed"))
    other = other.withColumn("_bucket", F.floor(F.shiftright(first, 20) * cut / F.lit(float(1 << 40))).cast("int"))
    counts = written(other.groupBy("seed", "_bucket").agg(F.count(F.lit(1)).alias("_rows")), "buckets")
    before = counts.select(F.col("seed").alias("_s"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_rows").over(Window.partitionBy("seed").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    dealt = other.repartition(max(1, -(-n * len(seeds) // (8 * BUCKET_ROWS))), "seed", "_bucket").withColumn("_hash", text)
    nth = F.row_number().over(Window.partitionBy("seed", "_bucket").orderBy("_hash", "_key", *(f"p_{c}" for c in columns))) - 1
    dealt = dealt.withColumn("_nth", nth).join(small(before), (F.col("seed") == F.col("_s")) & (F.col("_bucket") == F.col("_b")))
    other = dealt.select("seed", *(f"p_{c}" for c in columns), (F.col("_before") + F.col("_nth")).alias("_at"))
    return own.join(other, F.col("place") == F.col("_at")).drop("place", "_at")
