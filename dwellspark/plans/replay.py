"""Replay inputs for the registered queries: arrival times, wire files, damaged records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellspark.session import list_paths, path_exists, remove_path
from dwellspark.sources import wire


def with_arrival(events: DataFrame, delayed_every: int = 20, delay_hours: int = 3) -> DataFrame:
    """Arrival time for replays: every ``delayed_every``-th event arrives late.

    ``arrival_ts = ts + delay`` where ``event_id % delayed_every = 0``;
    arrival order is (arrival_ts, event_id).
    """
    delayed = (F.col("event_id") % F.lit(delayed_every)) == 0
    return events.withColumn(
        "arrival_ts",
        F.when(delayed, F.col("ts") + F.make_interval(hours=F.lit(delay_hours)))
         .otherwise(F.col("ts")))


def stage_replay_files(events: DataFrame, path: str, n_slices: int, order_col: str = "ts",
                       rows_per_file: int = 25_000) -> tuple[int, int]:
    """Write events as JSON-line files in ``order_col`` order; (rows, files per slice).

    ``n_slices`` equal spans of ``order_col`` (event time, or an arrival time to
    replay out-of-order delivery) are told apart in one pass over the events and
    written one job after the other, each as the same number of files, so a file
    stream that takes that many files per trigger reads slice by slice.  Events without a time cannot be placed in an
    order; they go with the first slice.
    """
    us = F.unix_micros(F.col(order_col).cast("timestamp"))
    bounds = events.agg(F.min(us).alias("lo"), F.max(us).alias("hi"), F.count(F.lit(1)).alias("n")).first()
    if bounds is None or bounds["lo"] is None:
        return 0, 1
    lo, span, n = int(bounds["lo"]), int(bounds["hi"]) - int(bounds["lo"]) + 1, int(bounds["n"])
    # exact integer microsecond cut points
    cuts = [lo + -(-(i * span) // n_slices) for i in range(n_slices + 1)]
    files = max(1, n // n_slices // rows_per_file)
    spark, staged = events.sparkSession, f"{path}-slices"
    nth = sum(((us >= F.lit(c)).cast("int") for c in cuts[1:-1]), F.lit(0))
    wire.events_to_wire(events.select("*", F.coalesce(nth, F.lit(0)).alias("slice")), "slice").select(
        "slice", "value").write.partitionBy("slice").parquet(staged)
    for i in range(n_slices):
        part = (spark.read.schema("value string").parquet(f"{staged}/slice={i}") if path_exists(spark, f"{staged}/slice={i}")
                else spark.createDataFrame([], "value string"))
        (part.coalesce(1) if files == 1 else part.repartition(files)).write.mode("append").text(path)
        # a slice of few rows leaves some of its files out; empty ones keep the slices apart
        for _ in range(files * (i + 1) - len(list_paths(spark, f"{path}/part-*"))):
            spark.createDataFrame([], "value string").coalesce(1).write.mode("append").text(path)
    remove_path(spark, staged)
    return n, files


def damaged(values: DataFrame, every: int = 50) -> DataFrame:
    """Damage every ``every``-th record, in turn: truncated JSON, unreadable time, no user_id."""
    hit = (F.col("event_id") % every) == 0
    kind = F.pmod((F.col("event_id") / every).cast("bigint"), F.lit(3))
    truncated = F.expr("substring(value, 1, length(value) - 3)")
    bad_ts = F.regexp_replace(F.col("value"), '"timestamp":"[^"]*"', '"timestamp":"not-a-time"')
    no_user = F.regexp_replace(F.col("value"), '"user_id":"[^"]*",', "")
    value = (F.when(~hit, F.col("value"))
              .when(kind == 0, truncated)
              .when(kind == 1, bad_ts)
              .otherwise(no_user))
    return values.withColumn("value", value)
