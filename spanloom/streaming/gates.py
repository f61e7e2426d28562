"""Event-time counts and gate 2 over streams of events."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def windowed_counts(events: DataFrame, time: str, key: str, width: str, lateness: str) -> DataFrame:
    """Events of each key by windows of event time; those later than lateness are left out."""
    return events.withWatermark(time, lateness).groupBy(F.window(time, width), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("from"), F.col("window.end").alias("to"), key, "n")


def gate_stream(events: DataFrame, key: str, need: float, postictal: float) -> DataFrame:
    """Gate 2 of each event as it arrives: key, start_time, stop_time, gate2.

    events: key, start_time, stop_time in seconds. State is the last stop of each key. Events of
    a key must arrive in order of their starts; within a batch they are sorted.
    """

    def judge(keys: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(frames).sort_values(["start_time", "stop_time"], kind="stable")
        last = state.get[0] if state.exists else None
        previous = rows["stop_time"].shift(1)
        if last is not None:
            previous = previous.fillna(last)
        gate = (rows["start_time"] - previous < postictal + need) & previous.notna()
        state.update((float(rows["stop_time"].iloc[-1]),))
        yield pd.DataFrame({key: keys[0], "start_time": rows["start_time"], "stop_time": rows["stop_time"], "gate2": gate})

    kind = events.schema[key].dataType.simpleString()
    return events.select(key, "start_time", "stop_time").groupBy(key).applyInPandasWithState(judge, f"{key} {kind}, start_time double, stop_time double, gate2 boolean", "last double", "append", GroupStateTimeout.NoTimeout)
