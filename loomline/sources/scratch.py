"""Tables of one run in the folder that the driver and all executors share, and size-checked broadcasts."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of rows, by the sizes of their types, that may be broadcast; more are joined by shuffle.
BROADCAST_BYTES = 16 << 20
#: Folders of our own by application; Spark refuses to have this setting changed once a session runs.
_OWN: dict[str, str] = {}
_WIDTHS = {"string": 64, "boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "float": 4}


def scratch_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; one of our own only where that is unset and all tasks run on this machine."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN:
            _OWN[app] = "file://" + tempfile.mkdtemp(prefix="loomline-")
        where = _OWN[app]
    return where.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new place under that folder, removed when the application ends."""
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet and read again, which cuts its lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """df marked for broadcast if its rows fit in so many bytes; else as it is, to be shuffled.

    df should be a written table of numbers, names and short arrays, as it is read once to be counted.
    """
    width = sum(_WIDTHS.get(kind := f.dataType.simpleString(), 256 if kind.startswith(("array", "map", "struct")) else 8) for f in df.schema.fields)
    rows = limit // max(1, width)
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own estimate of the size of df, from its files; no job runs. Very large where nothing is known."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
