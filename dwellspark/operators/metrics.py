"""Pipeline-health metrics: late-event and heartbeat rows, and their fold.

Replay semantics (no wall clock): a late event's metric row is recorded at
its own arrival, carrying the running number of late events so far; each
user-window result emits one heartbeat (two per window, one per feature
row) at the arrival of the record that advanced the watermark past the
window, carrying the late total at that point.  ``metric_offset`` is the
position in the metrics topic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellspark.functions.expressions import count_where, epoch_millis, iso_instant
from dwellspark.operators import late
from dwellspark.operators.enrich import checked_broadcast
from dwellspark.operators.ordered import running_sums
from dwellspark.schemas import HEARTBEAT_METRIC, LATE_METRIC
from dwellspark.spec import FeatureSpec

LAG_WARNING_MS = 60_000


def metric_rows(events_with_arrival: DataFrame, user_windows: DataFrame, spec: FeatureSpec,
                size_s: int = 3600) -> DataFrame:
    """Late-event rows and heartbeat rows with running counts and offsets."""
    geom = late.Geometry("user", size_s, size_s, spec.watermark_delay_s)
    ev = events_with_arrival.select("event_id", "user_id", "ts", "arrival_ts")
    sm = late.threshold_table(ev, [geom])
    tagged = late.classify(ev, [geom], thresholds=sm)
    late_rows = tagged.where(F.col("is_late")).select(
        late.arrival_key().alias("o_key"),
        F.lit(None).cast(ev.schema["ts"].dataType).alias("o_window_end"),
        F.lit(None).cast("string").alias("o_user_id"), F.lit(0).alias("o_feat"),
        F.lit(LATE_METRIC).alias("metric_type"),
        F.col("user_id").alias("dropped_user_id"), F.col("ts").alias("dropped_event_ts"),
        F.col("arrival_ts").alias("recorded_at"),
        F.lit(None).cast(ev.schema["ts"].dataType).alias("feature_computed_at"),
        F.lit(1).alias("w_late"))

    # the record that closes a window: first arrival with ts >= end + delay
    wins = user_windows.select(
        "user_id", "window_end",
        late.grid_index(F.col("window_start"), geom).alias("k"), F.lit(geom.name).alias("geom"))
    fired = wins.join(checked_broadcast(sm), ["geom", "k"], "inner").where(F.col("sm").isNotNull())
    feat_idx = F.explode(F.array(F.lit(1), F.lit(2)))  # one heartbeat per feature row
    beats = fired.select(
        F.col("sm").alias("o_key"),
        F.col("window_end").alias("o_window_end"), F.col("user_id").alias("o_user_id"),
        feat_idx.alias("o_feat"),
        F.lit(HEARTBEAT_METRIC).alias("metric_type"),
        F.lit(None).cast("string").alias("dropped_user_id"),
        F.lit(None).cast(ev.schema["ts"].dataType).alias("dropped_event_ts"),
        F.lit(None).cast(ev.schema["ts"].dataType).alias("recorded_at"),
        (F.col("window_end") + F.make_interval(secs=F.lit(spec.watermark_delay_s))).alias("feature_computed_at"),
        F.lit(0).alias("w_late"))

    rows = late_rows.unionByName(beats).withColumn("w_one", F.lit(1))
    order = ["o_key", "o_window_end", "o_user_id", "o_feat"]
    ranked = running_sums(rows, order, {"late_so_far": "w_late", "metric_offset": "w_one"})
    is_late = F.col("metric_type") == LATE_METRIC
    return ranked.select(
        "metric_offset", "metric_type",
        F.when(is_late, F.col("late_so_far")).cast("bigint").alias("count"),
        "dropped_user_id", "dropped_event_ts", "recorded_at", "feature_computed_at",
        F.when(~is_late, F.col("late_so_far")).cast("bigint").alias("late_events_total"))


def fold_metrics(metrics: DataFrame, as_of) -> DataFrame:
    """Fold metric rows (in ``metric_offset`` order) into the health snapshot.

    A late row with ``count`` or a heartbeat with ``late_events_total`` *sets*
    the total; a late row without ``count`` adds one — but only if no set
    happened after it.  Other metric types are ignored.  Two aggregates: the
    offset of the last set (a scalar subquery), then everything else.
    """
    is_late = F.col("metric_type") == LATE_METRIC
    is_beat = F.col("metric_type") == HEARTBEAT_METRIC
    set_value = (F.when(is_late & F.col("count").isNotNull(), F.col("count"))
                  .when(is_beat & F.col("late_events_total").isNotNull(), F.col("late_events_total")))
    m = metrics.withColumn("_set", set_value)
    last_set_offset = m.where(F.col("_set").isNotNull()).agg(
        F.coalesce(F.max("metric_offset"), F.lit(-1)).cast("bigint")).scalar()
    as_of_col = F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of
    agg = m.agg(
        F.max_by(F.col("_set"), F.when(F.col("_set").isNotNull(), F.col("metric_offset"))).alias("last_set"),
        count_where(is_late & F.col("count").isNull() & (F.col("metric_offset") > last_set_offset)).alias("adds"),
        F.max_by(F.col("feature_computed_at"), F.when(is_beat, F.col("metric_offset"))).alias("last_watermark_time"),
        count_where(is_beat).alias("heartbeat_count"),
        count_where(is_late).alias("late_metric_count"))
    lag = epoch_millis(as_of_col) - epoch_millis(F.col("last_watermark_time"))
    return agg.select(
        (F.coalesce(F.col("last_set"), F.lit(0)) + F.col("adds")).cast("bigint").alias("late_events_dropped"),
        "last_watermark_time",
        F.coalesce(lag, F.lit(-1)).cast("bigint").alias("watermark_lag_ms"),
        F.coalesce(lag > LAG_WARNING_MS, F.lit(False)).alias("lag_warning"),
        "heartbeat_count", "late_metric_count")


FOLD = ("first_offset bigint, last_set_offset bigint, last_set bigint, adds bigint, beat_offset bigint, "
        "last_watermark_time timestamp_ntz, heartbeat_count bigint, late_metric_count bigint")


def fold_state(metrics: DataFrame) -> DataFrame:
    """One mergeable row (``FOLD``) of the metric rows of one slice of offsets.

    ``adds`` are the late rows without a count after the slice's last set.
    """
    is_late = F.col("metric_type") == LATE_METRIC
    is_beat = F.col("metric_type") == HEARTBEAT_METRIC
    value = (F.when(is_late & F.col("count").isNotNull(), F.col("count"))
              .when(is_beat & F.col("late_events_total").isNotNull(), F.col("late_events_total")))
    set_at = F.when(value.isNotNull(), F.col("metric_offset"))
    last = metrics.agg(F.coalesce(F.max(set_at), F.lit(-1)).cast("bigint")).scalar()
    return metrics.agg(
        F.min("metric_offset").alias("first_offset"), F.max(set_at).alias("last_set_offset"), F.max_by(value, set_at).alias("last_set"),
        count_where(is_late & F.col("count").isNull() & (F.col("metric_offset") > last)).alias("adds"),
        F.max(F.when(is_beat, F.col("metric_offset"))).alias("beat_offset"),
        F.max_by("feature_computed_at", F.when(is_beat, F.col("metric_offset"))).alias("last_watermark_time"),
        count_where(is_beat).alias("heartbeat_count"), count_where(is_late).alias("late_metric_count"))


def merge_folds(states: DataFrame) -> DataFrame:
    """The state of several slices (disjoint ranges of offsets) together; associative.

    A slice's adds count unless a later slice sets the total.
    """
    last = states.agg(F.coalesce(F.max("last_set_offset"), F.lit(-1)).cast("bigint")).scalar()
    counts = F.coalesce("last_set_offset", "first_offset", F.lit(-1)) >= last
    return states.agg(
        F.min("first_offset").alias("first_offset"), F.max("last_set_offset").alias("last_set_offset"),
        F.max_by("last_set", "last_set_offset").alias("last_set"), F.coalesce(F.sum(F.when(counts, F.col("adds"))), F.lit(0)).alias("adds"),
        F.max("beat_offset").alias("beat_offset"), F.max_by("last_watermark_time", "beat_offset").alias("last_watermark_time"),
        F.coalesce(F.sum("heartbeat_count"), F.lit(0)).alias("heartbeat_count"),
        F.coalesce(F.sum("late_metric_count"), F.lit(0)).alias("late_metric_count"))


def fold_snapshot(state: DataFrame, as_of) -> DataFrame:
    """The health snapshot of a fold state; equals ``fold_metrics`` over the rows behind it."""
    as_of_col = F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of
    lag = epoch_millis(as_of_col) - epoch_millis(F.col("last_watermark_time"))
    return state.select(
        (F.coalesce(F.col("last_set"), F.lit(0)) + F.col("adds")).cast("bigint").alias("late_events_dropped"),
        "last_watermark_time",
        F.coalesce(lag, F.lit(-1)).cast("bigint").alias("watermark_lag_ms"),
        F.coalesce(lag > LAG_WARNING_MS, F.lit(False)).alias("lag_warning"),
        "heartbeat_count", "late_metric_count")


def snapshot_json(state: DataFrame) -> DataFrame:
    """The health snapshot as one JSON object per row (the serving payload):
    ``{"lateEventsDropped":…, "watermarkLagMs":…, "lastWatermarkTime":"…"}``."""
    return state.select(F.to_json(F.struct(
        F.col("late_events_dropped").alias("lateEventsDropped"),
        F.col("watermark_lag_ms").alias("watermarkLagMs"),
        iso_instant(F.col("last_watermark_time")).alias("lastWatermarkTime"))).alias("snapshot"))
