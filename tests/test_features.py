"""Micro-fixtures with hand-computed expectations (FIXTURES.md §3)."""

import json

from pyspark.sql import functions as F

from dwellspark.functions.expressions import format_duration, lenient_long
from dwellspark.operators import enrich, features, metrics, serving
from dwellspark.sinks.files import feature_wire_json
from dwellspark.sources import wire
from dwellspark.spec import WIRE_SPEC
from helpers import events


def _one(df, col):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0][col]


def test_m1_case_rule_stream_vs_batch(spark):
    ev = events(spark, [("u1", "c1", "click", 1, "10:01:00"), ("u1", "c1", "CLICK", 1, "10:02:00"),
                        ("u1", "c1", "view", 1, "10:03:00"), ("u1", "c1", "like", 1, "10:04:00")])
    assert _one(features.user_hourly_features(ev, WIRE_SPEC), "click_rate") == 0.5
    assert _one(features.user_hourly_features(ev, WIRE_SPEC.batch()), "click_rate") == 0.25


def test_m2_null_dwell_counts_as_zero(spark):
    ev = events(spark, [("u1", "c1", "view", 10, "10:01:00"), ("u1", "c1", "view", None, "10:02:00"),
                        ("u1", "c1", "view", 20, "10:03:00")])
    assert _one(features.user_hourly_features(ev, WIRE_SPEC), "avg_dwell_time") == 10.0


def test_m3_m4_engagement_rate(spark):
    no_views = events(spark, [("u1", "c1", "like", 1, "10:01:00"), ("u1", "c1", "share", 1, "10:02:00")])
    out = features.content_engagement(no_views, WIRE_SPEC, sliding=False)
    assert _one(out, "engagement_rate") == 0.0
    over_one = events(spark, [("u1", "c1", "view", 1, "10:01:00"), ("u1", "c1", "like", 1, "10:02:00"),
                              ("u1", "c1", "share", 1, "10:03:00")])
    assert _one(features.content_engagement(over_one, WIRE_SPEC, sliding=False), "engagement_rate") == 2.0


def test_m5_sliding_memberships(spark):
    ev = events(spark, [("u1", "c1", "view", 1, "10:07:00")])
    out = features.content_engagement(ev, WIRE_SPEC, sliding=True)
    starts = sorted(r["window_start"].strftime("%H:%M") for r in out.collect())
    assert starts == ["09:55", "10:00", "10:05"]


def _meta(spark, rows):
    return spark.createDataFrame(rows, "content_id string, category string, creator_id string, seq bigint")


def test_m6_unmatched_content(spark):
    ev = events(spark, [("u1", "c9", "view", 1, "10:07:00")])
    meta = enrich.latest_metadata(_meta(spark, [("c1", "scifi", "creator-A", 1)]))
    stream = features.category_affinity(enrich.enrich_events(ev, meta, how="inner"), WIRE_SPEC, keep_unmatched=False)
    assert stream.count() == 0
    batch = features.category_affinity(enrich.enrich_events(ev, meta, how="left"), WIRE_SPEC.batch(), keep_unmatched=True)
    row = batch.collect()[0]
    assert (row["feature_name"], row["category_affinity_score"]) == ("category_affinity_unknown", 1)


def test_m7_latest_metadata_wins(spark):
    meta = enrich.latest_metadata(_meta(spark, [("c1", "scifi", "creator-A", 1), ("c1", "news", "creator-B", 2)]))
    assert _one(meta, "category") == "news"


def test_m8_quarantine_reasons(spark):
    lines = [
        '{"user_id":"u1","content_id":"c1","event_type":"view","dwell_time_ms":5,"timestamp":"2024-01-01T10:00:00Z"}',
        '{"user_id":"u1","content_id":"c1","event_type":"view","dwell_time_ms":5,"timestamp":"2024-01-01T10:0',
        '{"user_id":"u1","content_id":"c1","event_type":"view","dwell_time_ms":5,"timestamp":"yesterday"}',
        '{"content_id":"c1","event_type":"view","dwell_time_ms":5,"timestamp":"2024-01-01T10:00:00Z"}',
    ]
    cl = wire.classify_wire_events(spark.createDataFrame([(x,) for x in lines], "value string"))
    reasons = sorted(r["reason"] for r in wire.quarantined(cl).collect())
    assert reasons == ["bad_timestamp", "malformed_json", "missing_user_id"]
    assert wire.good_events(cl).count() == 1


def test_lenient_dwell_reads(spark):
    df = spark.createDataFrame([("12.7",), ("12",), ("x",), (None,)], "d string")
    got = [r[0] for r in df.select(lenient_long(F.col("d"))).collect()]
    assert got == [12, 12, None, None]


def test_m12_metric_fold(spark):
    rows = [(0, "late_event_dropped", 3, None), (1, "late_event_dropped", None, None),
            (2, "watermark_heartbeat", None, 5), (3, "late_event_dropped", None, None),
            (4, "some_other_metric", 100, 100)]
    m = (spark.createDataFrame(rows, "metric_offset bigint, metric_type string, count bigint, late_events_total bigint")
         .withColumn("feature_computed_at", F.when(F.col("metric_offset") == 2,
                                                  F.lit("2024-01-01 10:00:00").cast("timestamp_ntz"))))
    state = metrics.fold_metrics(m, "2024-01-01 10:02:30")
    snap = state.collect()[0]
    assert snap["late_events_dropped"] == 6
    payload = json.loads(metrics.snapshot_json(state).first()["snapshot"])
    assert payload == {"lateEventsDropped": 6, "watermarkLagMs": 150000,
                       "lastWatermarkTime": "2024-01-01T10:00:00Z"}
    assert snap["watermark_lag_ms"] == 150000
    assert snap["lag_warning"] is True


def test_m13_freshness(spark):
    latest = spark.createDataFrame(
        [("u1", "click_rate", 0.5, "2024-01-01 09:57:30")],
        "entity_id string, feature_name string, feature_value double, computed_at string"
    ).withColumn("computed_at", F.col("computed_at").cast("timestamp_ntz"))
    out = {r["feature_name"]: r for r in serving.feature_freshness(latest, "2024-01-01 10:00:00").collect()}
    assert out["click_rate"]["age_ms"] == 150000
    assert out["click_rate"]["freshness_pct"] == 50.0
    assert out["click_rate"]["age_text"] == "2.5 min"
    assert out["engagement_rate"]["age_ms"] == -1
    one = serving.entity_freshness(latest, "u1", "avg_dwell_time", "2024-01-01 10:00:00").collect()[0]
    assert one["freshness_ms"] == -1


def test_format_duration(spark):
    df = spark.createDataFrame([(-5,), (999,), (1250,), (59999,), (60000,), (150000,)], "ms bigint")
    got = [r[0] for r in df.select(format_duration(F.col("ms"))).collect()]
    assert got == ["—", "999 ms", "1.3 s", "60.0 s", "1.0 min", "2.5 min"]


def test_m14_wire_form(spark):
    ev = events(spark, [("u1", "c1", "click", 1, "10:01:00"), ("u1", "c1", "view", 1, "10:02:00")])
    meta = enrich.latest_metadata(_meta(spark, [("c1", "scifi", "creator-A", 1)]))
    enriched = enrich.enrich_events(ev, meta, how="inner")
    feats = features.all_feature_rows(ev, enriched, WIRE_SPEC)
    recs = {json.loads(r["value"])["feature_name"]: r["value"] for r in feature_wire_json(feats).collect()}
    assert '"feature_value":0.5' in recs["click_rate"]
    assert '"feature_value":2,' in recs["category_affinity_scifi"]
    assert json.loads(recs["click_rate"])["computed_at"] == "2024-01-01T11:00:30Z"


def test_latest_features_and_lookup(spark):
    rows = [("u1", "click_rate", 0.1, "2024-01-01 10:00:00", "2024-01-01 11:00:00", "2024-01-01 11:00:30"),
            ("u1", "click_rate", 0.2, "2024-01-01 11:00:00", "2024-01-01 12:00:00", "2024-01-01 12:00:30"),
            ("u2", "click_rate", 0.3, "2024-01-01 10:00:00", "2024-01-01 11:00:00", "2024-01-01 11:00:30")]
    df = spark.createDataFrame(rows, "entity_id string, feature_name string, feature_value double, "
                                     "window_start string, window_end string, computed_at string")
    for c in ("window_start", "window_end", "computed_at"):
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    latest = serving.latest_features(df)
    assert _one(serving.entity_lookup(latest, "u1"), "feature_value") == 0.2
    assert serving.entity_lookup(latest, "nobody").count() == 0


def test_one_pass_features_equal_per_family_plans(spark):
    from dwellspark.sources import tables
    from dwellspark.spec import DRIVER_SPEC
    sf = "/root/testdata/sf0.001"
    ev = tables.driver_events(spark, sf)
    meta = enrich.latest_metadata(tables.driver_content_metadata(spark, sf))
    left = enrich.enrich_events(ev, meta, how="left")
    inner = enrich.enrich_events(ev, meta, how="inner")
    one = features.all_feature_rows_one_pass(left, DRIVER_SPEC)
    three = features.all_feature_rows(ev, inner, DRIVER_SPEC)
    assert one.count() == three.count() > 0
    assert one.exceptAll(three).count() == 0 and three.exceptAll(one).count() == 0


def test_bad_timestamp_processing_time_fallback(spark):
    lines = ['{"user_id":"u1","content_id":"c1","event_type":"view","dwell_time_ms":5,"timestamp":"yesterday"}']
    cl = wire.classify_wire_events(spark.createDataFrame([(x,) for x in lines], "value string"),
                                   timestamp_fallback="processing_time")
    row = cl.collect()[0]
    assert row["reason"] == "ok" and row["ts"] is not None


def test_wire_metadata_last_write_wins(spark):
    lines = [(0, '{"content_id":"c1","category":"scifi","creator_id":"creator-A","publish_timestamp":"2024-01-01T00:00:00Z"}'),
             (1, '{"content_id":"c1","category":"news","creator_id":"creator-B","publish_timestamp":"2023-01-01T00:00:00Z"}'),
             (2, '{"content_id":"c2","category":"sports"'),
             (3, '{"content_id":"c3","category":"comedy","creator_id":"creator-C","publish_timestamp":"x"}')]
    parsed = wire.parse_wire_metadata(spark.createDataFrame(lines, "offset bigint, value string"))
    latest = {r["content_id"]: r["category"] for r in enrich.latest_metadata(parsed, order_col="offset").collect()}
    assert latest == {"c1": "news", "c3": "comedy"}


def test_pane_strategy_equals_native_sliding(spark):
    from dwellspark.sources import tables
    from dwellspark.spec import DRIVER_SPEC
    ev = tables.driver_events(spark, "/root/testdata/sf0.001")
    native = features.content_engagement(ev, DRIVER_SPEC, sliding=True)
    panes = features.content_engagement(ev, DRIVER_SPEC, sliding=True, strategy="panes")
    assert native.count() == panes.count() > 0
    assert native.exceptAll(panes).count() == 0 and panes.exceptAll(native).count() == 0


def test_profile_exact_and_approx(spark):
    from dwellspark.operators import profile
    from dwellspark.sources import tables
    ev = tables.driver_events(spark, "/root/testdata/sf0.001")
    exact = profile.event_profile(ev).first()
    approx = profile.event_profile(ev, approx=True).first()
    assert exact["event_count"] == approx["event_count"] == ev.count()
    assert abs(approx["distinct_users"] - exact["distinct_users"]) <= 0.05 * exact["distinct_users"] + 1


def test_strict_cast_raises_and_served_text(spark):
    import pytest
    from dwellspark.functions.expressions import strict_long
    bad = spark.createDataFrame([("12x",)], "d string")
    with pytest.raises(Exception):
        bad.select(strict_long(F.col("d"))).collect()
    vals = spark.createDataFrame([("category_affinity_scifi", 5.0), ("click_rate", 0.5)],
                                 "feature_name string, feature_value double")
    got = [r[0] for r in vals.select(serving.served_value_text(F.col("feature_name"), F.col("feature_value"))).collect()]
    assert got == ["5", "0.5"]


def test_iso_instant_keeps_sub_second_digits(spark):
    from dwellspark.functions.expressions import iso_instant
    df = spark.createDataFrame([("2024-01-01 10:00:30",), ("2024-01-01 10:00:30.112",),
                                ("2024-01-01 10:00:30.112465",)], "t string")
    got = [r[0] for r in df.select(iso_instant(F.col("t").cast("timestamp_ntz"))).collect()]
    assert got == ["2024-01-01T10:00:30Z", "2024-01-01T10:00:30.112Z", "2024-01-01T10:00:30.112465Z"]
