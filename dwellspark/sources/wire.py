"""Wire form of events: one JSON object per record in a ``value`` column.

The same parse runs over a Kafka ``value``, a text file stream, or a batch of
JSON lines.  Unreadable records are not lost: they are split off into a
quarantine frame with a reason, and counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellspark.functions.expressions import iso_instant, lenient_long
from dwellspark.schemas import WIRE_EVENT_SCHEMA, WIRE_METADATA_SCHEMA

CORRUPT = "_corrupt_record"

# Quarantine reasons, checked in this order.
REASON_MALFORMED = "malformed_json"
REASON_NO_USER = "missing_user_id"
REASON_NO_CONTENT = "missing_content_id"
REASON_NO_TYPE = "missing_event_type"
REASON_BAD_TS = "bad_timestamp"
REASON_OK = "ok"


def events_to_wire(events: DataFrame, *keep: str) -> DataFrame:
    """Normalised events → JSON text (``value``), nulls omitted as absent fields; ``keep``: columns beside it."""
    payload = F.struct(
        F.col("user_id"), F.col("content_id"), F.col("event_type"),
        F.col("dwell_time_ms"), iso_instant(F.col("ts")).alias("timestamp"))
    return events.select("event_id", *keep, F.to_json(payload).alias("value"))


def _parse(values: DataFrame, schema: T.StructType) -> DataFrame:
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return values.withColumn("_j", F.from_json(F.col("value"), with_corrupt, opts))


def classify_wire_events(values: DataFrame, timestamp_fallback: str = "quarantine") -> DataFrame:
    """Parse every record and give it a ``reason`` (``ok`` when usable).

    ``timestamp_fallback='processing_time'`` keeps rows with an unreadable
    timestamp and stamps them with the current time instead (the reference
    behaviour); the default quarantines them, since a wall-clock stamp would
    push the watermark ahead of the data.
    """
    parsed = _parse(values, WIRE_EVENT_SCHEMA)
    ts = F.try_to_timestamp(F.col("_j.timestamp"))
    if timestamp_fallback == "processing_time":
        ts = F.coalesce(ts, F.current_timestamp())
    reason = (F.when(F.col(f"_j.{CORRUPT}").isNotNull() | F.col("_j").isNull(), F.lit(REASON_MALFORMED))
               .when(F.col("_j.user_id").isNull(), F.lit(REASON_NO_USER))
               .when(F.col("_j.content_id").isNull(), F.lit(REASON_NO_CONTENT))
               .when(F.col("_j.event_type").isNull(), F.lit(REASON_NO_TYPE))
               .when(ts.isNull(), F.lit(REASON_BAD_TS))
               .otherwise(F.lit(REASON_OK)))
    keep = [c for c in values.columns if c != "value"]
    return parsed.select(
        *keep, "value",
        F.col("_j.user_id").alias("user_id"),
        F.col("_j.content_id").alias("content_id"),
        F.col("_j.event_type").alias("event_type"),
        lenient_long(F.col("_j.dwell_time_ms")).alias("dwell_time_ms"),
        ts.alias("ts"),
        reason.alias("reason"))


def good_events(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("reason") == REASON_OK).drop("reason", "value")


def quarantined(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("reason") != REASON_OK).select(
        *[c for c in classified.columns if c not in ("user_id", "content_id", "event_type",
                                                      "dwell_time_ms", "ts")])


def quarantine_counts(classified: DataFrame) -> DataFrame:
    """Rows per reason (``ok`` included) and the readable dwell they carry."""
    return (classified.groupBy("reason")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.sum(F.coalesce(F.col("dwell_time_ms"), F.lit(0))).alias("dwell_sum")))


def parse_wire_metadata(values: DataFrame) -> DataFrame:
    """Metadata JSON → (content_id, category, creator_id, publish_ts) + arrival order."""
    parsed = _parse(values, WIRE_METADATA_SCHEMA)
    keep = [c for c in values.columns if c != "value"]
    return (parsed.where(F.col(f"_j.{CORRUPT}").isNull() & F.col("_j.content_id").isNotNull())
            .select(*keep,
                    F.col("_j.content_id").alias("content_id"),
                    F.col("_j.category").alias("category"),
                    F.col("_j.creator_id").alias("creator_id"),
                    F.try_to_timestamp(F.col("_j.publish_timestamp")).alias("publish_ts")))
