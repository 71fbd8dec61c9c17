"""Tables in the folder that driver and executors share, and size-checked broadcasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.sources.scratch import written

__all__ = ["packed", "small", "written"]

#: Bytes of rows, by the sizes of their types, that may be broadcast; more are joined by shuffle.
BROADCAST_BYTES = 16 << 20
_WIDTHS = {"string": 64, "boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "float": 4}


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """df marked for broadcast if its rows, of numbers and short names, fit in so many bytes; else as it is, to be shuffled.

    df should be a written table, as it is read once to be counted. A shuffled join of
    texts with ids may still prune the texts first, by Spark's own runtime filters.
    """
    width = sum(_WIDTHS.get(f.dataType.simpleString(), 8) for f in df.schema.fields)
    rows = limit // max(1, width)
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def packed(docs: DataFrame) -> DataFrame:
    """(row, text): all columns as one struct, so that none clashes with columns added to it."""
    return docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"), docs["text"].cast("string").alias("text"))
