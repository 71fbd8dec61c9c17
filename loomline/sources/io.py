"""Reading, filtering and writing logs: files, tables and JDBC."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FORMATS = ("parquet", "csv", "json", "orc", "text")


def read_files(spark: SparkSession, path: str, kind: str = "parquet", schema: str | None = None, time_format: str | None = None, times: tuple[str, ...] = (), **options) -> DataFrame:
    """A file source; columns named in `times` are parsed by time_format."""
    if kind not in FORMATS:
        raise ValueError(f"unknown format {kind!r}")
    reader = spark.read.format(kind).options(**({"header": "true"} if kind == "csv" else {}) | options)
    df = (reader.schema(schema) if schema else reader).load(path)
    return df.withColumns({c: F.to_timestamp(c, time_format) if time_format else F.to_timestamp(c) for c in times})


def read_jdbc(spark: SparkSession, url: str, table: str, column: str | None = None, lower: object = None, upper: object = None, partitions: int | None = None, fetch: int = 10_000, **options) -> DataFrame:
    """A JDBC table or query, read by ranges of a column where one is given."""
    how = {"url": url, "dbtable": table, "fetchsize": str(fetch)} | options
    if column:
        how |= {"partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper), "numPartitions": str(partitions or 8)}
    return spark.read.format("jdbc").options(**how).load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batch: int = 1000, truncate: bool = False, partitions: int | None = None, **options) -> None:
    how = {"url": url, "dbtable": table, "batchsize": str(batch), "truncate": str(truncate).lower()} | options
    if partitions:
        how["numPartitions"] = str(partitions)
    df.write.format("jdbc").options(**how).mode(mode).save()


def select_columns(df: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns once each, in order; Spark reads no others."""
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {', '.join(missing)}")
    return df.select(*dict.fromkeys(wanted))


def filter_cases(df: DataFrame, case: str, chosen: DataFrame, workspace: int, widget: int | None = None, kind: str | None = None) -> DataFrame:
    """Rows whose case a filter table (_caseId, _workspaceId, _widgetId, _widgetType) lists, by semi-join."""
    rows = chosen.filter(F.col("_workspaceId") == workspace)
    if widget is not None:
        rows = rows.filter(F.col("_widgetId") == widget)
    if kind is not None:
        rows = rows.filter(F.col("_widgetType") == kind)
    return df.join(rows.select(F.col("_caseId").alias(case)), case, "left_semi")


def sample_rows(df: DataFrame, rows: int = 1_000_000, seed: int = 42) -> DataFrame:
    """About so many rows, whole tables below that as they are; a sampling operator by purpose."""
    total = df.count()
    return df if total <= rows else df.sample(rows / total, seed)


def sample_by_key(df: DataFrame, key: str, rows: int = 1_000_000, seed: int = 42) -> DataFrame:
    """About so many rows, whole tables below that as they are; the same rows on every run and any partitioning.

    A row stays if the first 32 bits of the MD5 of seed and key are below the wanted share,
    so rows of a key stay or go together, and a smaller sample is part of a larger one. Rows
    without a key go unless all stay. A sampling operator by purpose; no shuffle.
    """
    total = df.count()
    if total <= rows:
        return df
    place = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), 1, 8), 16, 10).cast("long")
    return df.filter(place < F.lit(-(-(rows << 32) // total)))


def by_case(df: DataFrame, case: str, partitions: int) -> DataFrame:
    """df in so many partitions, none of which splits a case."""
    return df.repartition(partitions, case)


def without_negative(df: DataFrame, case: str, duration: str) -> DataFrame:
    """df without the cases that hold a negative duration."""
    bad = df.groupBy(case).agg(F.min(duration).alias("_least")).filter("_least < 0").select(case)
    return df.join(bad, case, "left_anti")


def save_outliers(spark: SparkSession, found: DataFrame, table: str, create: str = "append") -> None:
    """Writes (case_id, activity_num) sorted by both; create is append, errorifexists or overwrite."""
    found.select("case_id", "activity_num").sortWithinPartitions("case_id", "activity_num").write.mode(create).saveAsTable(table)


def export_rows(df: DataFrame, path: str, kind: str = "json", exclude: tuple[str, ...] = (), rows_per_file: int = 0, null_marker: str | None = None, gzip: bool = False, mode: str = "errorifexists") -> dict:
    """Writes df as csv, json (keys in order) or parquet and returns schema and row count."""
    out = df.drop(*exclude)
    if kind == "json":
        out = json_lines(out)
        writer, target = out.write.option("compression", "gzip" if gzip else "none"), "text"
    else:
        writer, target = out.write.option("compression", "gzip" if gzip else "snappy" if kind == "parquet" else "none"), kind
        if kind == "csv":
            writer = writer.option("header", "true")
            if null_marker is not None:
                writer = writer.option("nullValue", null_marker)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.mode(mode).format(target).save(path)
    return {"schema": json.loads(df.drop(*exclude).schema.json()), "rows": df.sparkSession.read.format(target).option("header", "true").load(path).count()}


def export_by_bytes(df: DataFrame, path: str, most: int, mode: str = "errorifexists") -> DataFrame:
    """Writes df as JSON lines into files of at most so many bytes, and returns (file, rows, bytes) of each.

    Each task cuts its own rows where the running size would pass the budget, so nothing is
    shuffled or gathered; a row larger than the budget has a file to itself. Files lie in
    folders file=<task>-<number>, and each ends in a line end.
    """
    if most < 1:
        raise ValueError("the budget must be positive")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, task = 0, 0, TaskContext.get().partitionId()
        for batch in batches:
            names = []
            for size in pc.binary_length(batch.column(0).cast(pa.binary())).to_pylist():
                if held and held + size + 1 > most:
                    number, held = number + 1, 0
                held += size + 1
                names.append(f"{task:05d}-{number:06d}")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string())], ["value", "file"])

    lines = json_lines(df).mapInArrow(cut, "value string, file string")
    lines.write.mode(mode).option("compression", "none").partitionBy("file").text(path)
    back = df.sparkSession.read.schema("value string, file string").text(path)
    return back.groupBy("file").agg(F.count("*").alias("rows"), F.sum(F.octet_length("value") + 1).alias("bytes"))


def json_lines(df: DataFrame) -> DataFrame:
    """One JSON text per row, keys sorted, nulls left out."""
    return df.select(F.to_json(F.struct(*(F.col(f"`{c}`") for c in sorted(df.columns)))).alias("value"))


def split_statements(sql: str) -> list[str]:
    """Statements between semicolons outside quotes and comments; comments and blanks go."""
    pattern = re.compile(r"--[^\n]*|/\*.*?\*/|'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|;|[^'\"`;/-]+|.", re.DOTALL)
    out, now = [], []
    for m in pattern.finditer(sql):
        t = m[0]
        if t == ";":
            out.append("".join(now).strip())
            now = []
        elif not t.startswith(("--", "/*")):
            now.append(t)
    out.append("".join(now).strip())
    return [s for s in out if s]


def run_sql(spark: SparkSession, sql: str | list[str], args: dict | None = None, handler: Callable[[DataFrame], object] | None = None, split: bool = False, last: bool = True):
    """Runs one or more statements. A lone statement gives its result; several give the last, or all as a list."""
    statements = sql if isinstance(sql, list) else split_statements(sql) if split else [sql]
    if not statements:
        raise ValueError("no statement to run")
    results = []
    for s in statements:
        df = spark.sql(s, args=args) if args else spark.sql(s)
        results.append(handler(df) if handler else df)
    return results[-1] if isinstance(sql, str) and (last or not split) else results


def chunks(df: DataFrame, rows: int) -> Iterator[list]:
    """Lists of rows, fetched partition by partition."""
    batch: list = []
    for row in df.toLocalIterator():
        batch.append(row)
        if len(batch) == rows:
            yield batch
            batch = []
    if batch:
        yield batch


def transfer(source: DataFrame, write: Callable[[DataFrame], None], exclude: tuple[str, ...] = (), columns: dict[str, str] | None = None) -> None:
    """Moves a table from any source to any sink, in parallel and never through the driver.

    columns maps target names to their types, in the target's order; others are left out.
    """
    out = source.drop(*exclude)
    write(out.select(*(F.col(f"`{c}`").cast(t).alias(c) for c, t in columns.items())) if columns else out)


def check_header(spark: SparkSession, path: str, columns: list[str], sep: str = ",") -> None:
    """Raises ValueError unless the first line of a csv file names these columns, in any case."""
    found = spark.read.option("sep", sep).option("header", "true").csv(path).columns
    if [c.lower() for c in found] != [c.lower() for c in columns]:
        raise ValueError(f"columns in the file are {', '.join(found)}")


def insert_rows(spark: SparkSession, rows: list[tuple], table: str, schema: str, replace: bool = False) -> None:
    """Appends a few rows to a table, or replaces what it holds."""
    spark.createDataFrame(rows, schema).write.mode("overwrite" if replace else "append").saveAsTable(table)


def connected(spark: SparkSession, read: Callable[[], DataFrame] | None = None) -> tuple[bool, str]:
    """Whether a source answers, and what it said: the first row of read(), or of `select 1`."""
    try:
        (read() if read else spark.sql("select 1")).first()
    except Exception as e:  # any source has failures of its own
        return False, str(e)
    return True, "connected"


def to_table(spark: SparkSession, df: DataFrame, table: str, partition: tuple[str, ...] = (), recreate: bool = False) -> None:
    writer = df.write.mode("overwrite" if recreate else "append")
    (writer.partitionBy(*partition) if partition else writer).saveAsTable(table)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, which may hold wildcards, has files; through Hadoop's file systems."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    return bool(found)


def has_partition(spark: SparkSession, table: str, partition: dict[str, str]) -> bool:
    if not spark.catalog.tableExists(table):
        return False
    wanted = {f"{k}={v}" for k, v in partition.items()}
    return any(wanted <= set(r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {table}").toLocalIterator())
