"""Queries that run as streams over the files that are there."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming.windows import followed, parquet_stream, run_to_table, windowed_counts
from .base import query


@query("select time_bucket(interval 1 hour, ts) as start, event_type, count(*) as n, round(sum(value), 4) as total from events group by all")
def event_windows_streamed(spark, d):
    counts = windowed_counts(parquet_stream(spark, d, "events"), "ts", "event_type")
    return run_to_table(counts, ["start", "event_type"]).select("start", "event_type", "n", F.round("total", 4).alias("total"))


@query("select ref, max(delivered_at) as latest, count(*) as rows from decision_snapshot group by ref")
def snapshots_followed(spark, d):
    return run_to_table(followed(parquet_stream(spark, d, "decision_snapshot"), "ref", "delivered_at"), ["ref"])
