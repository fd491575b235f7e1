"""Streams over a run's output: arrivals as they are written, and an alarm where nothing comes."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

STATE = "count long, last_change double, warned boolean"
OUTPUT = "name string, count long, since double, event string"


def new_files(spark: SparkSession, path: str, schema, pattern: str = "*.parquet", per_trigger: int = 100) -> DataFrame:
    """Files of a folder as a stream, a bounded number at a time."""
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", per_trigger).parquet(path)


def arrivals(stream: DataFrame, time: str = "ts", key: str = "batch", window: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Counts of each key in windows of time; what is later than the watermark is dropped by name, not by chance."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), key, "n")


def stalls(stream: DataFrame, key: str = "name", time: str = "ts", timeout_s: float = 300.0) -> DataFrame:
    """One event for each key that gets nothing for ``timeout_s``, and one when it goes on.

    Custom state: the count, the last change and whether it warned; timers are in
    event time, so that a replay gives the same events.
    """

    def step(k: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        count, last, warned = state.get if state.exists else (0, 0.0, False)
        if state.hasTimedOut:
            state.update((count, last, True))
            yield pd.DataFrame([(k[0], count, last, "stalled")], columns=["name", "count", "since", "event"])
            return
        times = sorted(t for f in frames for t in f["_at"])
        found = []
        for at in times:
            # A pause that ended before its timer could fire is told when it ends.
            if count and at - last > timeout_s:
                found += [] if warned else [(k[0], count, last, "stalled")]
                warned = True
            count += 1
            last = max(last, at)
            if warned:
                found.append((k[0], count, last, "resumed"))
                warned = False
        state.update((int(count), float(last), False))
        due = int((last + timeout_s) * 1000)
        state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))
        if found:
            yield pd.DataFrame(found, columns=["name", "count", "since", "event"])

    timed = stream.select(F.col(key).cast("string").alias("name"), F.col(time).cast("timestamp").alias("_ts"))
    timed = timed.withWatermark("_ts", "0 seconds").withColumn("_at", F.unix_micros("_ts") / 1e6)
    return timed.groupBy("name").applyInPandasWithState(step, OUTPUT, STATE, "append", "EventTimeTimeout")


def gaps(events: DataFrame, key: str, time: str, timeout_s: float = 300.0) -> DataFrame:
    """The same over a table: each pause of a key longer than the timeout (key, since, until, seconds)."""
    w = Window.partitionBy(key).orderBy(time)
    steps = events.select(key, F.lag(time).over(w).alias("since"), F.col(time).alias("until"))
    seconds = (F.unix_micros(F.col("until").cast("timestamp")) - F.unix_micros(F.col("since").cast("timestamp"))) / 1e6
    return steps.withColumn("seconds", seconds).where(F.col("seconds") > timeout_s)


def state_to_json(state: dict[str, dict]) -> str:
    return json.dumps(state, sort_keys=True)


def state_from_json(text: str) -> dict[str, dict]:
    """A saved state; what is no object of objects is an empty one."""
    try:
        found = json.loads(text)
    except ValueError:
        return {}
    return found if isinstance(found, dict) and all(isinstance(v, dict) for v in found.values()) else {}
