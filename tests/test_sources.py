import pytest

from loomline.sources import io
from loomline.streaming import activity


def test_statements():
    assert io.split_statements("select 1; -- no; no\nselect ';' ; /* ; */") == ["select 1", "select ';'"]


def test_run_sql(spark):
    assert io.run_sql(spark, "select 1 a; select 2 a", split=True).first().a == 2
    assert len(io.run_sql(spark, ["select 1", "select 2"])) == 2
    assert io.run_sql(spark, "select :x a", args={"x": 5}, handler=lambda df: df.first().a) == 5
    with pytest.raises(ValueError):
        io.run_sql(spark, [])


def test_round_trips(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", None), (2, "b", 0.5)], "n int, s string, x double")
    for kind in ("csv", "json", "parquet"):
        told = io.export_rows(df, f"{tmp_path}/{kind}", kind, exclude=("s",), null_marker="NA" if kind == "csv" else None)
        back = io.read_files(spark, f"{tmp_path}/{kind}", kind, schema="n int, x double", **({"nullValue": "NA"} if kind == "csv" else {}))
        assert sorted(tuple(r) for r in back.collect()) == [(1, None), (2, 0.5)]
        assert [f["name"] for f in told["schema"]["fields"]] == ["n", "x"]
    assert io.exists(spark, f"{tmp_path}/csv/*") and not io.exists(spark, f"{tmp_path}/none*")


def test_filters(spark):
    df = spark.createDataFrame([(1, -1), (1, 5), (2, 3), (3, None)], "c int, d int")
    assert sorted(r.c for r in io.without_negative(df, "c", "d").collect()) == [2, 3]
    chosen = spark.createDataFrame([(2, 1, 7, "x"), (1, 2, 7, "x")], "_caseId int, _workspaceId int, _widgetId int, _widgetType string")
    assert [r.c for r in io.filter_cases(df, "c", chosen, 1).collect()] == [2]
    assert io.filter_cases(df, "c", chosen, 1, 8).isEmpty()
    assert io.sample_rows(df, 10).count() == 4
    assert [len(b) for b in io.chunks(df, 3)] == [3, 1]
    assert {r.p: r.n for r in io.by_case(df, "c", 3).selectExpr("spark_partition_id() p", "c").distinct().groupBy("c").count().selectExpr("c p", "count n").collect()} == {1: 1, 2: 1, 3: 1}


def test_streaming_equals_batch(spark, tmp_path):
    rows = spark.createDataFrame([("A", f"2024-01-0{d} 0{h}:00:00") for d in (1, 2, 3) for h in range(5)] + [("B", "2024-01-09 00:00:00")], "act string, t string").selectExpr("act", "to_timestamp(t) ts")
    rows.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    out = activity.run_to_table(activity.activity_counts(stream, "act", "ts"), "counts", f"{tmp_path}/checkpoint", "complete")
    want = activity.activity_counts(rows, "act", "ts")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))
    assert activity.case_progress(rows, "act", "act", "ts", gap="2 hours").count() == 4


def test_files_of_at_most_so_many_bytes(spark, tmp_path):
    rows = [(i, "x" * (i * 37 % 200)) for i in range(300)] + [(300, "y" * 5000), (301, None), (302, "é" * 90)]
    df = spark.createDataFrame(rows, "n int, s string").repartition(3)
    told = {r.file: (r.rows, r.bytes) for r in io.export_by_bytes(df, f"{tmp_path}/cut", 1000).collect()}
    files = list((tmp_path / "cut").glob("file=*/*.txt"))
    assert {f.parent.name.removeprefix("file="): f.stat().st_size for f in files} == {k: b for k, (_, b) in told.items()}
    assert [n for n, b in told.values() if b > 1000] == [1]
    # Cut only where the next row would not fit, so two neighbours never fit into one file.
    for task in {k[:5] for k in told}:
        sizes = [told[k][1] for k in sorted(told) if k[:5] == task]
        assert all(a + b > 1000 for a, b in zip(sizes[:-2], sizes[1:-1], strict=True)) or len(sizes) < 3
    back = spark.read.schema("n int, s string").json(f"{tmp_path}/cut")
    assert sorted(back.select("n", "s").collect(), key=lambda r: r.n) == sorted(df.collect(), key=lambda r: r.n)
    with pytest.raises(ValueError):
        io.export_by_bytes(df, f"{tmp_path}/none", 0)
    assert io.export_by_bytes(df.limit(0), f"{tmp_path}/empty", 10).isEmpty()


def test_streamed_transitions_equal_the_sorted_log(spark, tmp_path):
    import random

    from loomline.eventlog import EventLog

    rnd = random.Random(5)
    rows = [(rnd.choice([1, 2, 3, None]), rnd.choice(["a", "b", "c", None]), 1_700_000_000 + i * 60 + rnd.choice([0, 0, 7]) - rnd.choice([0, 0, 1200]), i) for i in range(400)]
    df = spark.createDataFrame(rows, "c long, a string, s long, k long").selectExpr("c", "a", "timestamp_seconds(s) t", "k")
    where = tmp_path / "in"
    where.mkdir()
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{where}")
    edges = activity.transitions(stream, "c", "a", "t", "k", late="1 hour")
    run = lambda: activity.run_to_files(edges, f"{tmp_path}/out", f"{tmp_path}/state")
    # Rows come up to twenty minutes out of order, in files of a hundred, and the stream is stopped between two runs.
    for i in range(4):
        df.filter(f"k div 100 = {i}").coalesce(1).write.mode("append").parquet(f"{where}")
        if i in (1, 3):
            out = run()
    newest = max(r[2] for r in rows)
    log = EventLog(df.filter("c is not null"), "c", "a", "t", tiebreak=("k",)).base()
    sure = log.filter("activity is not null and next_activity is not null").filter(f"unix_micros(ts) + duration_us < ({newest} - 3600) * 1000000L")
    want = sorted(map(tuple, sure.select("case_id", "activity", "next_activity", "ts", "duration_us").collect()))
    assert len(want) > 100
    assert sorted(map(tuple, out.collect())) == want
    late = spark.createDataFrame([(1, "a", newest - 9000, 999)], "c long, a string, s long, k long").selectExpr("c", "a", "timestamp_seconds(s) t", "k")
    late.coalesce(1).write.mode("append").parquet(f"{where}")
    assert sorted(map(tuple, run().collect())) == want


def test_scratch_folder_without_a_setting(tmp_path):
    """A session of its own process, whose configuration names no folder."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    code = (
        "from pyspark.sql import SparkSession\n"
        "from loomline.sources.scratch import scratch_dir, written\n"
        "spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "assert spark.conf.get('spark.checkpoint.dir', None) is None\n"
        "assert written(spark.range(3), 'rows').count() == 3 and scratch_dir(spark) == scratch_dir(spark.newSession())\n"
    )
    root = str(Path(io.__file__).resolve().parents[2])
    env = {k: v for k, v in os.environ.items() if k not in ("PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")} | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": os.pathsep.join([root, *sys.path])}
    subprocess.run([sys.executable, "-c", code], check=True, env=env, timeout=120)


def test_samples_by_key_are_nested_and_whole_keys(spark):
    df = spark.createDataFrame([(i // 2 if i % 10 else None, i) for i in range(4000)], "k int, v int")
    small, large = ({(r.k, r.v) for r in io.sample_by_key(df.repartition(n), "k", rows).collect()} for n, rows in ((3, 800), (7, 2000)))
    assert small < large and 600 < len(small) < 1000
    for found in (small, large):
        keys = {k for k, _ in found}
        assert None not in keys and found == {(i // 2, i) for i in range(4000) if i % 10 and i // 2 in keys}
    assert io.sample_by_key(df, "k", 4000).count() == 4000 and io.sample_by_key(df.limit(0), "k", 0).count() == 0
    assert io.sample_by_key(df, "k", 0).count() == 0
