"""Progress reports as metric rows, and mergeable profiles."""

import os

from pyspark.sql import functions as F

from dwellspark.operators import profile
from dwellspark.session import list_paths
from dwellspark.streaming import progress


def _report(batch, mark, dropped=0, name="q", when="2024-01-01T12:00:00.000Z"):
    return {"id": "x", "name": name, "batchId": batch, "timestamp": when, "numInputRows": 5, "eventTime": {"watermark": mark} if mark else {},
            "stateOperators": [{"numRowsTotal": 3, "memoryUsedBytes": 10, "numRowsDroppedByWatermark": dropped}, {"numRowsTotal": 4}]}


def test_progress_rows(spark, scratch):
    path = os.path.join(scratch, "progress")
    assert progress.progress_metrics(spark, path).count() == 0
    listener = progress.ProgressMetrics(spark, path, "^q", keep=20)
    for batch in range(41):
        listener.record(_report(batch, "2024-01-01T11:58:59.000Z" if batch else "1970-01-01T00:00:00.000Z", batch % 2))
    listener.record(_report(40, "2024-01-01T11:59:30.000Z", 0))  # reported again
    listener.record(_report(0, None, name="q b/c"))
    listener.record(_report(0, None, name="other"))
    rows = progress.progress_metrics(spark, path)
    assert rows.where("query = 'q' AND batch_id = 40").select("watermark_lag_ms", "state_rows", "state_bytes").collect() == [(30_000, 7, 10)]
    assert len(list_paths(spark, f"{path}/query=q/*.json")) == 20
    newest = {r["query"]: r for r in progress.latest_progress(rows).collect()}
    assert set(newest) == {"q", "q b/c"} and newest["q"]["total_dropped"] == 10 and not newest["q"]["lag_warning"]
    assert newest["q b/c"]["watermark_lag_ms"] == -1
    assert rows.where("batch_id = 39").first()["watermark_lag_ms"] == 61_000


def test_profile_parts_merge(spark):
    events = spark.range(30_000).select(
        F.concat(F.lit("u"), F.col("id") % 7000).alias("user_id"), F.when(F.col("id") % 5 > 0, (F.col("id") % 11).cast("string")).alias("content_id"),
        F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("ts"), (F.col("id") % 13).alias("batch"))
    exact = profile.event_profile(events).first()
    for parts in (profile.profile_sketches(events, "batch"), profile.profile_sketches(events)):
        got = profile.merged_profile(parts).first()
        assert (got["event_count"], got["min_ts"], got["max_ts"]) == (exact["event_count"], exact["min_ts"], exact["max_ts"])
        assert abs(got["distinct_users"] - 7000) <= 0.03 * 7000 and got["distinct_contents"] == exact["distinct_contents"] == 11
    assert tuple(profile.merged_profile(profile.profile_sketches(events.limit(0), "batch")).first()) == (0, 0, 0, None, None)
