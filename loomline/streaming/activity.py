"""Structured Streaming over event logs: an addition, since logs are otherwise read whole."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def activity_counts(events: DataFrame, activity: str, ts: str, window: str = "1 day", late: str = "2 days") -> DataFrame:
    """(window_start, activity, n) by tumbling windows; rows later than the watermark are left out.

    ts must be a timestamp. State holds one count per open window and activity.
    """
    rows = events.withColumn("_ts", F.col(ts).cast("timestamp")).filter(F.col("_ts").isNotNull() & F.col(activity).isNotNull())
    counted = rows.withWatermark("_ts", late).groupBy(F.window("_ts", window).alias("w"), F.col(activity).alias("activity")).agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("window_start"), "activity", "n")


def case_progress(events: DataFrame, case: str, activity: str, ts: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """(case_id, session_start, session_end, n) by sessions of a case, closed after a gap."""
    rows = events.withColumn("_ts", F.col(ts).cast("timestamp")).filter(F.col("_ts").isNotNull())
    counted = rows.withWatermark("_ts", late).groupBy(F.session_window("_ts", gap).alias("w"), F.col(case).alias("case_id")).agg(F.count(activity).alias("n"))
    return counted.select("case_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def run_to_table(stream: DataFrame, name: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Runs a stream over all that is there now into an in-memory table, and returns it."""
    query = stream.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.table(name)


def run_to_files(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Runs an appending stream over all that is there now into Parquet files, and returns them.

    Nothing passes through the driver; run again with the same checkpoint, it goes on where it stopped.
    """
    stream.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


_EDGE = "case_id {case}, activity string, next_activity string, us long, duration_us long"
_STATE = "us array<long>, tie array<long>, activity array<string>, last_us long, last_activity string, started boolean"


def transitions(events: DataFrame, case: str, activity: str, ts: str, tie: str, late: str = "1 hour") -> DataFrame:
    """(case_id, activity, next_activity, ts, duration_us) of a stream, an edge once its second event is final.

    An event is final when the watermark, `late` behind the newest time seen, has passed it;
    until then it waits in its case's state, so events that come in any order within that
    time give the edges of the sorted log. Later ones are left out. State holds a case's waiting
    events and its last final one. ts is the first event's time and tie, a whole number,
    orders events of one time. Rows without case or time are left out; an event without an
    activity stands between its neighbours but makes no edge.
    """
    stamp = F.col(ts).cast("timestamp")
    rows = events.select(F.col(case).alias("case_id"), F.col(activity).cast("string").alias("activity"), stamp.alias("_ts"), F.unix_micros(stamp).alias("us"), F.coalesce(F.col(tie).cast("long"), F.lit(0)).alias("tie"))
    rows = rows.filter(F.col("case_id").isNotNull() & F.col("_ts").isNotNull()).withWatermark("_ts", late)

    def step(key: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        us, ties, names, last_us, last_name, started = state.get if state.exists else ([], [], [], 0, None, False)
        waiting = list(zip(us, ties, names, strict=True))
        for pdf in parts:
            # A null text is a missing value of pandas here.
            waiting += [(int(u), int(t), None if pd.isna(a) else a) for u, t, a in zip(pdf["us"], pdf["tie"], pdf["activity"], strict=True)]
        final_ms = state.getCurrentWatermarkMs()
        waiting.sort(key=lambda e: (e[0], e[1], e[2] or ""))
        ready = [e for e in waiting if e[0] // 1000 < final_ms]
        waiting = waiting[len(ready) :]
        edges = []
        for u, _, name in ready:
            if started and last_name is not None and name is not None:
                edges.append((key[0], last_name, name, last_us, u - last_us))
            last_us, last_name, started = u, name, True
        state.update(([e[0] for e in waiting], [e[1] for e in waiting], [e[2] for e in waiting], last_us, last_name, started))
        if waiting:
            state.setTimeoutTimestamp(max(waiting[0][0] // 1000, final_ms, 1))
        if edges:
            yield pd.DataFrame(edges, columns=["case_id", "activity", "next_activity", "us", "duration_us"])

    kind = rows.schema["case_id"].dataType.simpleString()
    edges = rows.groupBy("case_id").applyInPandasWithState(step, _EDGE.format(case=kind), _STATE, "append", "EventTimeTimeout")
    return edges.select("case_id", "activity", "next_activity", F.timestamp_micros("us").alias("ts"), "duration_us")
