"""Declared schemas: one schema for batch and stream (no inference)."""

from __future__ import annotations

from pyspark.sql import types as T

# Wire form of a user event: one JSON object per record.
WIRE_EVENT_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("content_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    # Kept as text so "12.7", 12, null and junk can be told apart.
    T.StructField("dwell_time_ms", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

WIRE_METADATA_SCHEMA = T.StructType([
    T.StructField("content_id", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("creator_id", T.StringType()),
    T.StructField("publish_timestamp", T.StringType()),
])

# Normalised events, the input of every feature function.
EVENT_COLUMNS = ["event_id", "user_id", "content_id", "event_type",
                 "dwell_time_ms", "ts"]

# Long-format feature rows (the feature table).
FEATURE_COLUMNS = ["entity_id", "feature_name", "feature_value",
                   "window_start", "window_end", "computed_at"]

# Metric rows: union of the late-event and heartbeat variants.
METRIC_SCHEMA = T.StructType([
    T.StructField("metric_offset", T.LongType()),
    T.StructField("metric_type", T.StringType()),
    T.StructField("count", T.LongType()),
    T.StructField("dropped_user_id", T.StringType()),
    T.StructField("dropped_event_ts", T.TimestampNTZType()),
    T.StructField("recorded_at", T.TimestampNTZType()),
    T.StructField("feature_computed_at", T.TimestampNTZType()),
    T.StructField("late_events_total", T.LongType()),
])

LATE_METRIC = "late_event_dropped"
HEARTBEAT_METRIC = "watermark_heartbeat"
