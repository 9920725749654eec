"""Streams of usage and state events: cost by window with late data, and the latest state per step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.state import call_cost


def windowed_cost(calls: DataFrame, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(window_start, label, n_calls, cost) of calls (ts, label, n_in, n_out); rows later than ``late`` are dropped.

    Works on streams and on tables alike. ts may lack a time zone; it is taken in the session's."""
    rows = calls.withColumn("ts", F.col("ts").cast("timestamp"))
    rows = rows.withWatermark("ts", late) if rows.isStreaming else rows
    agg = rows.groupBy(F.window("ts", window).alias("w"), "label").agg(F.count(F.lit(1)).alias("n_calls"), F.sum(call_cost(F.col("n_in"), F.col("n_out"))).alias("cost"))
    return agg.select(F.col("w.start").alias("window_start"), "label", "n_calls", "cost")


def running_state(events: DataFrame) -> DataFrame:
    """(step_key, status) by the latest (ts, event_id): for an update-mode stream, one row of state per step."""
    last = F.max_by("status", F.struct("ts", "event_id"))
    return events.groupBy("step_key").agg(last.alias("status"))
