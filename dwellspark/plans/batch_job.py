"""Batch recomputation of the streamed features (command line).

    python -m dwellspark.plans.batch_job --events <parquet dir|file> [--wire]
        [--metadata <parquet> | --metadata-json <dir>] [--limit N] [--output <dir>]

Reads events (driver parquet layout, or JSON wire lines with ``--wire``),
prints the profile and the first 20 rows of each feature table, and writes
three CSV folders; unreadable wire records go to a fourth with their
reasons.  Wire input without metadata uses the fixed content lookup.
``--limit N`` keeps the first N events in arrival order
(the reference job's bounded consume); by default every event is used.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellspark.operators import enrich, features, profile, serving
from dwellspark.functions.expressions import strict_long
from dwellspark.session import build_session, cut_lineage
from dwellspark.sinks.files import write_csv
from dwellspark.sources import tables, wire
from dwellspark.spec import DRIVER_SPEC, WIRE_SPEC, FeatureSpec
from dwellspark.streaming.job import json_metadata


def first_events(events: DataFrame, limit: int | None, order=("ts", "event_id")) -> DataFrame:
    """First ``limit`` events in arrival order (global top-n, per-partition first)."""
    if limit is None:
        return events
    return events.orderBy(*order).limit(limit)


def run(spark: SparkSession, events: DataFrame, metadata: DataFrame | None, spec: FeatureSpec,
        output: str | None, show: int = 20) -> dict[str, DataFrame]:
    bspec = spec.batch()
    user = features.user_hourly_features(events, bspec)
    content = features.content_engagement(events, bspec, sliding=False).select(
        "content_id", "window_start", "window_end", "engagement_rate", "view_count")
    if metadata is not None:
        enriched = enrich.enrich_events(events, enrich.latest_metadata(metadata), how="left")
    else:
        enriched = events.withColumn("category", F.lit(None).cast("string"))
    affinity = features.category_affinity(enriched, bspec, keep_unmatched=True)

    # each result is read twice, for the summary and the export: aggregate once
    user, content, affinity = (cut_lineage(x) for x in (user, content, affinity))
    profile.event_profile(events).show(truncate=False)
    profile.event_type_counts(events).show(truncate=False)
    for name, df, keys in (("user", user, ["user_id", "window_start"]),
                           ("content", content, ["content_id", "window_start"]),
                           ("affinity", affinity, ["user_id", "window_start", "category"])):
        print(f"=== {name} features (first {show}) ===")
        serving.top_rows(df, keys, show).show(show, truncate=False)
    out = {"user": user, "content": content, "affinity": affinity}
    if output:
        for name, df in out.items():
            write_csv(df, os.path.join(output, f"batch_{name}_features"))
    return out


def main(argv=None) -> int:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--events", required=True)
    p.add_argument("--wire", action="store_true", help="events are JSON lines")
    p.add_argument("--metadata", default=None, help="parquet in the layout of the driver's 'part' table")
    p.add_argument("--metadata-json", default=None, help="folder of content-metadata JSON lines")
    p.add_argument("--limit", type=int, default=None)
    p.add_argument("--output", default=None)
    p.add_argument("--master", default=None)
    a = p.parse_args(argv)
    spark = build_session(a.master)
    if a.wire:
        # files by age, then the place in the file, stand in for the topic's arrival order
        lines = spark.read.text(a.events).select(
            "value", F.col("_metadata.file_modification_time").alias("file_time"), F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"))
        read = wire.classify_wire_events(lines)
        # the batch job's strict integer: an unreadable dwell time is an error, not a null
        dwell = strict_long(F.coalesce(F.get_json_object("value", "$.dwell_time_ms"), F.lit("0")))
        events = wire.good_events(read.withColumn("dwell_time_ms", F.when(F.col("reason") == wire.REASON_OK, dwell)))
        spec, order = WIRE_SPEC, ("file_time", "file", "block", "place")
        bad = wire.quarantined(read).select("value", "reason")
        bad.groupBy("reason").count().show(truncate=False)
        if a.output:
            write_csv(bad, os.path.join(a.output, "batch_quarantine"))
    else:
        events = tables.normalize_driver_events(spark.read.parquet(a.events))
        spec, order = DRIVER_SPEC, ("ts", "event_id")
    events = first_events(events, a.limit, order)
    if a.limit is not None:
        events = cut_lineage(events)  # the top-n runs once, not once per result
    metadata = None
    if a.metadata_json:
        metadata = json_metadata(a.metadata_json)(spark)
    elif a.metadata:
        metadata = tables.content_metadata(spark.read.parquet(a.metadata))
    elif a.wire:
        metadata = tables.fixed_category_lookup(spark).select(
            "content_id", "category", F.lit(None).cast("string").alias("creator_id"), F.lit(1).cast("bigint").alias("seq"))
    run(spark, events, metadata, spec, a.output)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
