"""Batch CLI: profile, top-20 summaries and CSV export on the smallest tables."""

import os

from pyspark.sql import functions as F

from dwellspark.plans import batch_job
from dwellspark.sources import tables
from dwellspark.spec import DRIVER_SPEC

SF = "/root/testdata/sf0.001"


def test_batch_job_writes_three_csvs(spark, scratch):
    events = tables.driver_events(spark, SF)
    meta = tables.driver_content_metadata(spark, SF).where("content_id <> '7'")  # so one content is unmatched
    out = batch_job.run(spark, events, meta, DRIVER_SPEC, scratch, show=5)
    for name in ("user", "content", "affinity"):
        back = spark.read.option("header", True).csv(os.path.join(scratch, f"batch_{name}_features"))
        assert back.count() == out[name].count() > 0
    assert out["affinity"].where(F.col("category") == "unknown").count() > 0


def test_first_events_in_arrival_order(spark):
    events = tables.driver_events(spark, SF)
    first = batch_job.first_events(events, 10)
    got = [r["event_id"] for r in first.collect()]
    want = [r["event_id"] for r in events.orderBy("ts", "event_id").take(10)]
    assert got == want
    assert batch_job.first_events(events, None).count() == events.count()


def test_batch_cli_on_wire_input_with_limit(spark, scratch):
    from dwellspark.sources import wire
    events_dir = os.path.join(scratch, "wire")
    wire.events_to_wire(tables.driver_events(spark, SF)).select("value").coalesce(1).write.text(events_dir)
    out = os.path.join(scratch, "out")
    assert batch_job.main(["--events", events_dir, "--wire", "--limit", "100", "--output", out]) == 0
    user = spark.read.option("header", True).csv(os.path.join(out, "batch_user_features"))
    total = user.agg(F.sum(F.col("event_count").cast("bigint"))).first()[0]
    assert total == 100


def test_wire_limit_keeps_the_older_file(spark, scratch):
    import time
    line = '{"user_id":"%s","content_id":"content1","event_type":"click","dwell_time_ms":"5","timestamp":"2024-01-01T10:00:00Z"}'
    folder = os.path.join(scratch, "wire")
    for user, lines in (("old", [line % "old", "{bad"]), ("new", [line % "new"] * 500)):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(folder)
        time.sleep(1.1)
    out = os.path.join(scratch, "out")
    assert batch_job.main(["--events", folder, "--wire", "--limit", "1", "--output", out]) == 0
    read = lambda name: spark.read.option("header", True).csv(os.path.join(out, name))
    assert [r["user_id"] for r in read("batch_user_features").collect()] == ["old"]
    assert [r["category"] for r in read("batch_affinity_features").collect()] == ["scifi"]
    assert [r["reason"] for r in read("batch_quarantine").collect()] == ["malformed_json"]


def test_metadata_argument_is_read_itself(spark, scratch):
    part = os.path.join(scratch, "other_name.parquet")
    spark.read.parquet(os.path.join(SF, "part.parquet")).selectExpr("p_partkey", "'mine' p_type", "p_brand").write.parquet(part)
    out = os.path.join(scratch, "out")
    assert batch_job.main(["--events", os.path.join(SF, "events.parquet"), "--metadata", part, "--output", out]) == 0
    got = spark.read.option("header", True).csv(os.path.join(out, "batch_affinity_features"))
    assert {r["category"] for r in got.select("category").distinct().collect()} == {"mine"}
