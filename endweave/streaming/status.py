"""The event log as a stream: the last status of each module, and sessions of users."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(EVENTS).parquet(folder)


def status_updates(events: DataFrame) -> DataFrame:
    """State is one row for each module, whatever the length of the log."""
    return events.groupBy("event_type").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("last_event"), F.max("ts").alias("at"), F.count(F.lit(1)).alias("events"))


def counts_per_window(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by time window; the watermark lets windows go, and late events with them."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("value"))


def sessions(events: DataFrame, gap: str = "1 hour", late: str = "2 hours") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count(F.lit(1)).alias("events"))
