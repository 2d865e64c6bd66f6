"""Registered queries over the driver tables: (spark, sf_dir) → DataFrame.

Each query reads the given tables (or data Spark derives from them) in
full; oracle SQL for each lives in ``plans/oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellspark.functions.expressions import count_where
from dwellspark.operators import compare, enrich, features, late, lateness, metrics, profile, serving
from dwellspark.plans import batch_job, replay
from dwellspark.session import cut_lineage, remove_path, shared_path
from dwellspark.sources import tables, wire
from dwellspark.spec import DRIVER_SPEC
from dwellspark.streaming import job as stream_job
from dwellspark.streaming import progress

SPEC = DRIVER_SPEC
BATCH_SPEC = DRIVER_SPEC.batch()


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.driver_events(spark, sf_dir)


def _latest_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.latest_metadata(tables.driver_content_metadata(spark, sf_dir))


def q01_user_hourly_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.user_hourly_features(_events(spark, sf_dir), SPEC)


def q02_user_features_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    feats = features.user_hourly_features(_events(spark, sf_dir), SPEC)
    return features.drop_wire_extras(features.user_feature_rows(feats, SPEC))


def q03_content_engagement_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.content_engagement(_events(spark, sf_dir), SPEC, sliding=True)


def q04_content_engagement_15m(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = features.content_engagement(_events(spark, sf_dir), BATCH_SPEC, sliding=False)
    return out.select("content_id", "window_start", "window_end",
                      "engagement_rate", "view_count")


def q05_category_affinity_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = enrich.enrich_events(_events(spark, sf_dir), _latest_meta(spark, sf_dir), how="inner")
    return features.category_affinity(enriched, SPEC, keep_unmatched=False)


def q06_category_affinity_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = enrich.enrich_events(_events(spark, sf_dir), _latest_meta(spark, sf_dir), how="left")
    return features.category_affinity(enriched, BATCH_SPEC, keep_unmatched=True)


def q07_latest_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latest_meta(spark, sf_dir)


def q08_enriched_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = enrich.enrich_events(_events(spark, sf_dir), _latest_meta(spark, sf_dir), how="left")
    return enriched.select("event_id", "user_id", "content_id", "event_type",
                           "dwell_time_ms", "ts", "category", "creator_id")


def _arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.with_arrival(_events(spark, sf_dir))


def q09_late_events_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events the 1-hour user windows drop as late (30 s watermark), by replay."""
    out = late.late_events(_arrivals(spark, sf_dir), size_s=3600, delay_s=SPEC.watermark_delay_s)
    return out.select("event_id", "user_id", "event_type", "ts", "arrival_ts",
                      "window_start", "window_end")


LATE_DELAYS = (0, 30, 120)


def q10_late_counts_by_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late counts per window family for watermark delays 0 / 30 / 120 s."""
    geoms = []
    for d in LATE_DELAYS:
        geoms.append(late.Geometry(f"user|{d}", 3600, 3600, d))
        geoms.append(late.Geometry(f"content|{d}", 900, 300, d))
    enriched = enrich.enrich_events(_arrivals(spark, sf_dir), _latest_meta(spark, sf_dir), how="left")
    flagged, flag_cols = late.late_flags(enriched.select("event_id", "ts", "arrival_ts", "category"), geoms)
    has_cat = F.col("category").isNotNull()
    # one aggregate: per geometry its late count, and for the user windows
    # the late rows that carry a category (the affinity family)
    sums = flagged.agg(*[count_where(F.col(c)).alias(c) for c in flag_cols.values()],
                       *[count_where(F.col(c) & has_cat).alias(f"{c}_cat") for c in flag_cols.values()])
    rows = []
    for g in geoms:
        family, delay = g.name.split("|")
        c = flag_cols[g.name]
        rows.append(F.struct(F.lit(family).alias("window_family"), F.lit(int(delay)).alias("delay_s"),
                             F.col(c).alias("late_count")))
        if family == "user":
            rows.append(F.struct(F.lit("affinity").alias("window_family"), F.lit(int(delay)).alias("delay_s"),
                                 F.col(f"{c}_cat").alias("late_count")))
    return sums.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _all_features(spark: SparkSession, sf_dir: str, entity_id: str | None = None) -> DataFrame:
    """All feature rows: one scan, one aggregate, whatever the metadata's size
    (the planner broadcasts it or shuffles).  ``entity_id`` restricts the work
    to the events that can feed that entity."""
    meta = _latest_meta(spark, sf_dir).select("content_id", "category", "creator_id")
    enriched = _events(spark, sf_dir).join(meta, "content_id", "left")
    if entity_id is not None:
        return features.drop_wire_extras(features.feature_rows_for_entity(enriched, entity_id, SPEC))
    return features.drop_wire_extras(features.all_feature_rows_one_pass(enriched, SPEC))


def q20_all_features_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_features(spark, sf_dir)


def q11_latest_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.latest_features(_all_features(spark, sf_dir))


# Check ids: the reference's test user / content (user2, content3).
LOOKUP_ENTITY = "2"
# Fixed "now" for freshness in replays (after the last window closes).
AS_OF = "2024-01-31 00:15:00"


def q12_entity_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _all_features(spark, sf_dir, entity_id=LOOKUP_ENTITY)
    return serving.entity_lookup(serving.latest_features(rows), LOOKUP_ENTITY)


def q13_feature_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.feature_freshness(serving.latest_features(_all_features(spark, sf_dir)), AS_OF)


def q14_dataset_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.combined_profile(_events(spark, sf_dir), _all_features(spark, sf_dir))


def q15_event_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.event_type_counts(_events(spark, sf_dir))


def q18_recent_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.recent_features(_all_features(spark, sf_dir), 60)


def q21_quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event through the JSON wire form, every 50th damaged; rows per reason."""
    damaged = replay.damaged(wire.events_to_wire(_events(spark, sf_dir)), every=50)
    return wire.quarantine_counts(wire.classify_wire_events(damaged))


def q17_divergence_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch (all events) vs stream (watermark-accepted events), per user window."""
    return compare.divergence_report(_arrivals(spark, sf_dir), SPEC, BATCH_SPEC)


def _metric_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    windows = features.user_hourly_features(events, SPEC)
    return metrics.metric_rows(replay.with_arrival(events), windows, SPEC)


def q19_metrics_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Health snapshot folded from the replayed metric rows, at a fixed "now"."""
    return metrics.fold_metrics(_metric_rows(spark, sf_dir), AS_OF)


def q22_metric_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late-event and heartbeat metric rows with the running late count.

    ``running_late_count`` is the row's ``count`` (late rows) or
    ``late_events_total`` (heartbeats) — one non-null column.
    """
    rows = _metric_rows(spark, sf_dir)
    return rows.select("metric_offset", "metric_type",
                       F.coalesce("count", "late_events_total").alias("running_late_count"),
                       "dropped_user_id", "dropped_event_ts", "recorded_at", "feature_computed_at")


REPLAY_SLICES = 6


def _replayed(spark: SparkSession, events: DataFrame, name: str, slices: int, order_col: str, **options):
    """(job, source): the events staged in ``order_col`` order, one slice per micro-batch."""
    root = shared_path(spark, name)
    rows, files = replay.stage_replay_files(events, f"{root}/in", slices, order_col)
    parts = stream_job.state_partitions_for(spark, -(-rows // slices))
    job = stream_job.FeatureStreamJob(spark, root, SPEC, state_partitions=parts, **options)
    return job, lambda: stream_job.wire_file_stream(spark, f"{root}/in", files)


def _finished(job: stream_job.FeatureStreamJob, result: DataFrame) -> DataFrame:
    """The result as a checkpoint; the run's folder (input, sinks, state) goes."""
    result = cut_lineage(result)
    remove_path(job.spark, job.root)
    return result


def q16_user_features_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User features computed by the Structured Streaming job.

    All events are replayed in event-time order as JSON lines (one slice per
    micro-batch) through parse → watermark → 1 h windows → parquet
    sink; the result is every window the watermark closed.
    """
    job, source = _replayed(spark, _events(spark, sf_dir), "q16", REPLAY_SLICES, "ts")
    job.run_all(source, families=("user",), audit=False)
    return _finished(job, job.features("user").select("user_id", "window_start", "window_end", "click_rate",
                                                      "avg_dwell_time", "event_count"))


AUDIT_SLICES = 8


def q23_late_audit_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late events found by the streaming audit when events arrive out of order.

    All events are replayed in arrival order (every 20th 3 h late), one slice
    per micro-batch; the foreachBatch audit flags a row when its hour window
    ended at or before the max event time of the earlier micro-batches minus
    the 30 s delay.
    """
    job, source = _replayed(spark, _arrivals(spark, sf_dir), "q23", AUDIT_SLICES, "arrival_ts")
    job.run_all(source, families=(), audit=True)
    audit = stream_job.LateAudit(job.path("audit"), SPEC)
    return _finished(job, audit.late_events(spark).select(
        "user_id", "content_id", "event_type",
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end")))


def q24_user_features_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User windows of the stream when events arrive out of order: late ones are dropped."""
    job, source = _replayed(spark, _arrivals(spark, sf_dir), "q24", AUDIT_SLICES, "arrival_ts")
    job.run_all(source, families=("user",), audit=False)
    return _finished(job, job.features("user").select("user_id", "window_start", "window_end", "click_rate",
                                                      "avg_dwell_time", "event_count"))


def q25_content_engagement_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding content windows of the stream when events arrive out of order."""
    job, source = _replayed(spark, _arrivals(spark, sf_dir), "q25", AUDIT_SLICES, "arrival_ts")
    job.run_all(source, families=("content",), audit=False)
    return _finished(job, job.features("content").select("content_id", "window_start", "window_end", "engagement_rate",
                                                         "view_count", "engagement_count", "event_count"))


def q26_stream_metrics_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metric rows that the streaming audit wrote, folded into the late total."""
    job, source = _replayed(spark, _arrivals(spark, sf_dir), "q26", AUDIT_SLICES, "arrival_ts")
    job.run_all(source, families=(), audit=True)
    audit = stream_job.LateAudit(job.path("audit"), SPEC)
    return _finished(job, metrics.fold_metrics(audit.metrics(spark), AS_OF).select(
        "late_events_dropped", "heartbeat_count", "late_metric_count"))


def q27_latest_table_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entity from the latest-value table that the stream's user features were upserted into."""
    job, source = _replayed(spark, _events(spark, sf_dir), "q27", REPLAY_SLICES, "ts")
    job.run_all(source, families=("user",), audit=False)
    stream_job.wait_for([job.start_latest_upsert(families=("user",))])
    return _finished(job, job.latest().lookup(spark, LOOKUP_ENTITY))


def q28_quarantine_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged records that the stream's quarantine sink took, rows per reason."""
    root = shared_path(spark, "q28")
    values = replay.damaged(wire.events_to_wire(_events(spark, sf_dir)))
    values.select("value").write.text(f"{root}/in")
    job = stream_job.FeatureStreamJob(spark, root, SPEC)
    stream_job.wait_for([job.start_quarantine(stream_job.wire_file_stream(spark, f"{root}/in", 1000))])
    return _finished(job, job.quarantined().groupBy("reason").agg(F.count("*").alias("n")))


def q29_affinity_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed category affinity, the metadata opened anew for every micro-batch."""
    job, source = _replayed(spark, _events(spark, sf_dir), "q29", REPLAY_SLICES, "ts",
                            metadata=lambda s: tables.driver_content_metadata(s, sf_dir))
    job.run_all(source, families=("affinity",), audit=False)
    return _finished(job, job.features("affinity").select("user_id", "window_start", "window_end", "category",
                                                          "category_affinity_score", "feature_name"))


def q30_batch_against_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch features against what the stream wrote for the same events out of order.

    Content features are compared on the batch job's 15-minute windows, which are
    every third of the stream's sliding ones.
    """
    events = _events(spark, sf_dir)
    job, source = _replayed(spark, _arrivals(spark, sf_dir), "q30", AUDIT_SLICES, "arrival_ts",
                            metadata=lambda s: tables.driver_content_metadata(s, sf_dir))
    job.run_all(source, audit=False)
    content = job.features("content").where(F.unix_seconds(F.col("window_start").cast("timestamp")) % 900 == 0)
    stream = compare.counted_rows(job.features("user"), content, job.features("affinity"))
    enriched = enrich.enrich_events(events, _latest_meta(spark, sf_dir), how="left")
    batch = compare.counted_rows(
        features.user_hourly_features(events, BATCH_SPEC), features.content_engagement(events, BATCH_SPEC, sliding=False),
        features.category_affinity(enriched, BATCH_SPEC, keep_unmatched=True))
    until = events.agg((F.max("ts") - F.make_interval(secs=F.lit(SPEC.watermark_delay_s))).alias("t")).scalar()
    unknown = f"{SPEC.affinity_prefix}{SPEC.unknown_category}"
    return _finished(job, compare.feature_comparison(batch, stream, until, unknown))


def q31_first_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bounded consume: the first 5000 events in arrival order."""
    return batch_job.first_events(_arrivals(spark, sf_dir), FIRST_EVENTS, ("arrival_ts", "event_id")).select(
        "event_id", "user_id", "content_id", "event_type", "ts", "arrival_ts")


def q32_top_user_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The console summary: the first 20 user features by user and window."""
    rows = features.user_hourly_features(_events(spark, sf_dir), BATCH_SPEC)
    return serving.top_rows(rows, ["user_id", "window_start"], 20)


def q33_entities_with_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities that have an engagement rate, and the text that is served for it."""
    latest = serving.latest_features(_all_features(spark, sf_dir))
    served = serving.served_value_text(F.col("feature_name"), F.col("feature_value"))
    with_it = serving.entities_with_feature(latest, "engagement_rate")
    affinity = latest.where(F.startswith("feature_name", F.lit(SPEC.affinity_prefix)))
    return with_it.select("entity_id", F.lit("engagement_rate").alias("feature_name"), F.lit(None).cast("string").alias("served")).unionByName(
        affinity.select("entity_id", "feature_name", served.alias("served")))


def _outputs(spark: SparkSession, sf_dir: str, name: str):
    """(job, outputs): the one stateful query over all events in arrival order, one slice per micro-batch."""
    job, source = _replayed(spark, _arrivals(spark, sf_dir), name, AUDIT_SLICES, "arrival_ts",
                            metadata=lambda s: tables.driver_content_metadata(s, sf_dir))
    stream_job.wait_for([job.start_outputs(source())])
    return job, job.outputs()


def q34_windows_and_late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed windows of all families and their late events, from one stateful query."""
    job, outputs = _outputs(spark, sf_dir, "q34")
    time = lambda c: F.timestamp_micros(F.col(c)).cast("timestamp_ntz")
    return _finished(job, outputs.closed(spark).select(
        "kind", "family", "entity_id", "category", time("start_us").alias("window_start"), time("end_us").alias("window_end"),
        "clicks", "views", "engagements", "dwell_sum", "event_count", time("ts_us").alias("ts"), "content_id", "event_type"))


def q35_feature_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The (key, value) JSON records of the long feature sink; ``emitted_here``: stamped by this run's batches."""
    began = spark.range(1).select(F.unix_micros(F.current_timestamp()).alias("t")).first()["t"]
    job, outputs = _outputs(spark, sf_dir, "q35")
    field = lambda name: F.get_json_object("value", f"$.{name}")
    return _finished(job, outputs.records(spark).select(
        "key", field("entity_id").alias("entity_id"), field("feature_name").alias("feature_name"),
        field("feature_value").cast("double").alias("feature_value"), (~F.contains(field("feature_value"), F.lit("."))).alias("is_whole"),
        (F.unix_micros(F.to_timestamp(field("computed_at"))) >= F.lit(began // 1000 * 1000)).alias("emitted_here")))


def q36_stream_metric_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric rows of the one query: late events with their running count, a heartbeat per user feature row."""
    job, outputs = _outputs(spark, sf_dir, "q36")
    rows = outputs.metrics(spark)
    return _finished(job, rows.select("metric_offset", "metric_type", F.coalesce("count", "late_events_total").alias("running_late_count"),
                                      "dropped_user_id", "dropped_event_ts"))


def _served(spark: SparkSession, sf_dir: str, name: str):
    """(job, latest-value table) after the stream's user and content features were upserted into it."""
    job, source = _replayed(spark, _events(spark, sf_dir), name, REPLAY_SLICES, "ts")
    job.run_all(source, families=("user", "content"), audit=False)
    stream_job.wait_for([job.start_latest_upsert(families=("user", "content"))])
    return job, job.latest()


def q39_entities_from_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities that have a click rate or an engagement rate, from the feature index of the latest-value table."""
    job, latest = _served(spark, sf_dir, "q39")
    found = [latest.entities_with(spark, f).withColumn("feature_name", F.lit(f)) for f in ("click_rate", "engagement_rate")]
    return _finished(job, found[0].unionByName(found[1]))


def q40_freshness_from_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freshness of the stream's features, from the summary of the latest-value table."""
    job, latest = _served(spark, sf_dir, "q40")
    return _finished(job, serving.freshness_from_summary(latest.freshness(spark), AS_OF))


def q41_stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watermark and input of every micro-batch, as the progress listener wrote them."""
    job, source = _replayed(spark, _arrivals(spark, sf_dir), "q41", AUDIT_SLICES, "arrival_ts")
    listener = progress.ProgressMetrics(spark, job.path("progress"), "^features_user_.*q41")
    spark.streams.addListener(listener)
    try:
        query = job.start_user(source())
        stream_job.wait_for([query])
        if not listener.wait(query) or listener.failed:
            raise RuntimeError(f"progress reports are missing: {listener.failed}")
    finally:
        spark.streams.removeListener(listener)
    rows = progress.progress_metrics(spark, job.path("progress")).where("input_rows > 0")
    return _finished(job, rows.select("metric_type", "batch_id", F.col("watermark").cast("timestamp_ntz").alias("watermark"), "input_rows"))


def q42_profile_from_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile merged from one part per day; distinct counts are told as within 3 % of the exact ones."""
    events = _events(spark, sf_dir)
    parts = profile.profile_sketches(events.withColumn("day", F.to_date("ts")), "day")
    exact = profile.event_profile(events).select(F.col("distinct_users").alias("users"), F.col("distinct_contents").alias("contents"))
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= 0.03 * F.col(b)
    # two tables of one row each
    return profile.merged_profile(parts).join(exact, F.lit(True)).select(
        "event_count", "min_ts", "max_ts", near("distinct_users", "users").alias("users_within"),
        near("distinct_contents", "contents").alias("contents_within"))


FAMILIES = [late.Geometry("user", 3600, 3600, 0), late.Geometry("content", 900, 300, 0)]
MORE_DELAYS = (0, 30, 120, 600, 3600, 7200, 9000)


def _lateness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lateness of every event per window family, with whether its content has a category."""
    enriched = enrich.enrich_events(_arrivals(spark, sf_dir), _latest_meta(spark, sf_dir), how="left")
    return lateness.lateness(enriched.select("event_id", "ts", "arrival_ts", F.col("category").isNotNull().alias("has_category")), FAMILIES)


def q37_lateness_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How late events are, in whole seconds behind the end of their last window."""
    return lateness.lateness_histogram(_lateness(spark, sf_dir)).withColumnRenamed("geom", "window_family")


def q38_late_counts_any_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late counts of all three families for seven delays, read off one histogram."""
    by = ("geom", "has_category")
    hist = lateness.lateness_histogram(_lateness(spark, sf_dir), ("has_category",))
    affinity = hist.where("geom = 'user' AND has_category").withColumn("geom", F.lit("affinity"))
    counts = lateness.late_counts(hist.unionByName(affinity), MORE_DELAYS, by)
    return counts.groupBy(F.col("geom").alias("window_family"), "delay_s").agg(F.sum("late_count").alias("late_count"))


# Fixed value: the bounded consume's default number of events.
FIRST_EVENTS = 5000

QUERIES = {
    "q01_user_hourly_features": q01_user_hourly_features,
    "q02_user_features_long": q02_user_features_long,
    "q03_content_engagement_sliding": q03_content_engagement_sliding,
    "q04_content_engagement_15m": q04_content_engagement_15m,
    "q05_category_affinity_stream": q05_category_affinity_stream,
    "q06_category_affinity_batch": q06_category_affinity_batch,
    "q07_latest_metadata": q07_latest_metadata,
    "q08_enriched_events": q08_enriched_events,
    "q09_late_events_replay": q09_late_events_replay,
    "q10_late_counts_by_delay": q10_late_counts_by_delay,
    "q11_latest_features": q11_latest_features,
    "q12_entity_lookup": q12_entity_lookup,
    "q13_feature_freshness": q13_feature_freshness,
    "q14_dataset_profile": q14_dataset_profile,
    "q15_event_type_counts": q15_event_type_counts,
    "q16_user_features_streamed": q16_user_features_streamed,
    "q17_divergence_report": q17_divergence_report,
    "q18_recent_features": q18_recent_features,
    "q19_metrics_state": q19_metrics_state,
    "q20_all_features_union": q20_all_features_union,
    "q21_quarantine_counts": q21_quarantine_counts,
    "q22_metric_rows": q22_metric_rows,
    "q23_late_audit_streamed": q23_late_audit_streamed,
    "q24_user_features_out_of_order": q24_user_features_out_of_order,
    "q25_content_engagement_out_of_order": q25_content_engagement_out_of_order,
    "q26_stream_metrics_fold": q26_stream_metrics_fold,
    "q27_latest_table_lookup": q27_latest_table_lookup,
    "q28_quarantine_streamed": q28_quarantine_streamed,
    "q29_affinity_streamed": q29_affinity_streamed,
    "q30_batch_against_stream": q30_batch_against_stream,
    "q31_first_events": q31_first_events,
    "q32_top_user_rows": q32_top_user_rows,
    "q33_entities_with_feature": q33_entities_with_feature,
    "q34_windows_and_late_events": q34_windows_and_late_events,
    "q35_feature_records": q35_feature_records,
    "q36_stream_metric_rows": q36_stream_metric_rows,
    "q37_lateness_histogram": q37_lateness_histogram,
    "q38_late_counts_any_delay": q38_late_counts_any_delay,
    "q39_entities_from_index": q39_entities_from_index,
    "q40_freshness_from_summary": q40_freshness_from_summary,
    "q41_stream_progress": q41_stream_progress,
    "q42_profile_from_sketches": q42_profile_from_sketches,
}
