"""Answers follow the files: tables that grow from outside between two calls."""

import os
import shutil

from pyspark.sql import functions as F

from dwellspark.operators import enrich, features, late
from dwellspark.spec import DRIVER_SPEC

DDL = "event_id bigint, user_id string, content_id string, event_type string, dwell_time_ms bigint, ts timestamp_ntz, arrival_ts timestamp_ntz"


def event(i, ts, arrival=None):
    return f"select {i}L event_id, 'u' user_id, 'c1' content_id, 'view' event_type, 1L dwell_time_ms, timestamp_ntz'2024-01-01 {ts}' ts, timestamp_ntz'2024-01-01 {arrival or ts}' arrival_ts"


def grow(spark, scratch, folder, sql):
    """Write elsewhere, then copy the file in: Spark does not learn of it."""
    spark.sql(sql).coalesce(1).write.mode("overwrite").parquet(os.path.join(scratch, "side"))
    side, to = (os.path.join(scratch, x).removeprefix("file:") for x in ("side", folder))
    os.makedirs(to, exist_ok=True)
    for name in os.listdir(side):
        if name.startswith("part-"):
            shutil.copy(os.path.join(side, name), to)


def test_grown_metadata_and_events(spark, scratch):
    meta, events = os.path.join(scratch, "meta"), os.path.join(scratch, "events")
    grow(spark, scratch, "meta", "select 'c1' content_id, 'scifi' category, 'a' creator_id, 1L seq")
    grow(spark, scratch, "events", event(1, "10:10:00"))

    def categories():
        rows = spark.read.parquet(events).drop("arrival_ts")
        return {r["category"] for r in enrich.enrich_events(rows, enrich.latest_metadata(spark.read.parquet(meta))).collect()}

    def late_ids():
        return sorted(r["event_id"] for r in late.late_events(spark.read.parquet(events)).collect())

    assert categories() == {"scifi"} and late_ids() == []
    grow(spark, scratch, "meta", "select 'c1' content_id, 'news' category, 'a' creator_id, 2L seq")
    grow(spark, scratch, "events", event(2, "12:00:00") + " union all " + event(3, "10:20:00", "12:30:00"))
    assert categories() == {"news"} and late_ids() == [3]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_both_feature_plans_leave_null_times_out(spark):
    rows = spark.sql(event(1, "10:10:00") + " union all select 2L, 'u', 'c1', 'view', 1L, null, null").drop("arrival_ts")
    enriched = rows.withColumn("category", F.lit("scifi")).withColumn("creator_id", F.lit("a"))
    one = features.all_feature_rows_one_pass(enriched, DRIVER_SPEC)
    three = features.all_feature_rows(rows, enriched, DRIVER_SPEC)
    assert sorted(map(tuple, one.select(three.columns).collect()), key=str) == sorted(map(tuple, three.collect()), key=str)
    assert one.count() == 6
