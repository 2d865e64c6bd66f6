"""Batch-versus-stream divergence report for the user features.

The batch side aggregates every event; the stream side only what the
watermark accepted.  Both sides come from the same events, so instead of
computing two aggregates and full-outer-joining them on (user, window), each
record is tagged late / on time once and a single aggregate produces both
sides as conditional sums — one shuffle, no join.  A window whose events
were all late has no stream row: ``stream_event_count = 0`` and null stream
rates.  The reason follows from the values: equal rates match, whatever was
late; differing ones come from late events, or else from the case rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellspark.functions.expressions import count_where, type_match
from dwellspark.operators import late
from dwellspark.spec import FeatureSpec, interval_seconds

# Divergence reasons.
REASON_MATCH = "match"
REASON_LATE = "late_events_excluded"
REASON_ALL_LATE = "all_events_late"
REASON_CASE = "case_rule"


def divergence_report(events_with_arrival: DataFrame, stream_spec: FeatureSpec,
                      batch_spec: FeatureSpec) -> DataFrame:
    size_s = interval_seconds(stream_spec.user_window)
    geom = late.Geometry("user", size_s, size_s, stream_spec.watermark_delay_s)
    tagged = late.classify(
        events_with_arrival.select("event_id", "user_id", "event_type", "dwell_time_ms",
                                   "ts", "arrival_ts"), [geom])
    on_time = ~F.col("is_late")
    dwell = F.coalesce(F.col("dwell_time_ms"), F.lit(0))
    b_click = type_match(F.col("event_type"), batch_spec.click_types, batch_spec.case_sensitive)
    s_click = type_match(F.col("event_type"), stream_spec.click_types, stream_spec.case_sensitive)
    agg = (tagged.groupBy("user_id", "window_start", "window_end")
           .agg(F.count(F.lit(1)).alias("batch_event_count"),
                count_where(b_click).alias("batch_clicks"),
                F.sum(dwell).alias("batch_dwell"),
                count_where(on_time).alias("stream_event_count"),
                count_where(s_click & on_time).alias("stream_clicks"),
                F.sum(F.when(on_time, dwell).otherwise(F.lit(0))).alias("stream_dwell"),
                count_where(F.col("is_late")).alias("late_count")))
    has_stream = F.col("stream_event_count") > 0
    b_rate = F.col("batch_clicks") / F.col("batch_event_count")
    s_rate = F.when(has_stream, F.col("stream_clicks") / F.col("stream_event_count"))
    b_dwell = F.col("batch_dwell") / F.col("batch_event_count")
    s_dwell = F.when(has_stream, F.col("stream_dwell") / F.col("stream_event_count"))
    reason = (F.when(~has_stream, F.lit(REASON_ALL_LATE))
               .when((b_rate == s_rate) & (b_dwell == s_dwell), F.lit(REASON_MATCH))
               .when(F.col("late_count") > 0, F.lit(REASON_LATE))
               .otherwise(F.lit(REASON_CASE)))
    return agg.select(
        "user_id", "window_start", "window_end",
        b_rate.alias("batch_click_rate"), s_rate.alias("stream_click_rate"),
        F.abs(b_rate - s_rate).alias("click_rate_delta"),
        b_dwell.alias("batch_avg_dwell_time"), s_dwell.alias("stream_avg_dwell_time"),
        F.abs(b_dwell - s_dwell).alias("avg_dwell_delta"),
        "batch_event_count",
        "stream_event_count",
        "late_count", reason.alias("reason"))


REASON_OPEN = "open_window"
REASON_UNMATCHED = "content_without_metadata"


def counted_rows(user: DataFrame, content: DataFrame, affinity: DataFrame) -> DataFrame:
    """Feature results in long form with the events behind each value (NTZ windows)."""
    window = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")]
    pairs = F.explode(F.array(F.struct(F.lit("click_rate").alias("n"), F.col("click_rate").alias("v")),
                              F.struct(F.lit("avg_dwell_time").alias("n"), F.col("avg_dwell_time").alias("v"))))
    u = user.select(F.col("user_id").alias("entity_id"), *window, F.col("event_count").alias("events"), pairs.alias("p"))
    u = u.select("entity_id", F.col("p.n").alias("feature_name"), "window_start", "window_end", F.col("p.v").alias("value"), "events")
    c = content.select(F.col("content_id").alias("entity_id"), F.lit("engagement_rate").alias("feature_name"), *window,
                       F.col("engagement_rate").alias("value"), F.col("event_count").alias("events"))
    score = F.col("category_affinity_score")
    a = affinity.select(F.col("user_id").alias("entity_id"), "feature_name", *window, score.cast("double").alias("value"), score.alias("events"))
    return u.unionByName(c).unionByName(a)


def feature_comparison(batch: DataFrame, stream: DataFrame, closed_until, unknown_feature: str) -> DataFrame:
    """Batch feature table against the stream's own output, row by row.

    Both sides are ``counted_rows``; ``closed_until`` is the stream's last
    watermark (windows that end after it were not emitted).  The reason follows
    from what is there: a window still open, content without metadata (counted
    by the batch only), all or some events late, or the same events under
    another case rule.
    """
    key = ["entity_id", "feature_name", "window_start", "window_end"]
    b = batch.select(*key, F.col("value").alias("batch_value"), F.col("events").alias("batch_events"))
    s = stream.select(*key, F.col("value").alias("stream_value"), F.col("events").alias("stream_events"))
    both = b.join(s, key, "full_outer")
    reason = (F.when(F.col("batch_value") == F.col("stream_value"), F.lit(REASON_MATCH))
              .when(F.col("stream_value").isNull() & (F.col("window_end") > closed_until), F.lit(REASON_OPEN))
              .when(F.col("stream_value").isNull() & (F.col("feature_name") == unknown_feature), F.lit(REASON_UNMATCHED))
              .when(F.col("stream_value").isNull(), F.lit(REASON_ALL_LATE))
              .when(F.col("stream_events") < F.col("batch_events"), F.lit(REASON_LATE))
              .otherwise(F.lit(REASON_CASE)))
    return both.select(*key, "batch_value", "stream_value", F.abs(F.col("batch_value") - F.col("stream_value")).alias("delta"),
                       reason.alias("reason"))
