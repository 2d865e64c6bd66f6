"""Dataset profile and event-type histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def event_profile(events: DataFrame, approx: bool = False) -> DataFrame:
    """One row: events consumed, distinct users / contents, event-time range.

    Exact distinct counts shuffle the distinct keys; ``approx=True`` uses
    HyperLogLog++ sketches (``approx_count_distinct``, ~2 % error) that merge
    map-side and ship one small sketch per task.
    """
    distinct = F.approx_count_distinct if approx else F.count_distinct
    return events.agg(
        F.count(F.lit(1)).alias("event_count"),
        distinct("user_id").alias("distinct_users"),
        distinct("content_id").alias("distinct_contents"),
        F.min("ts").alias("min_ts"),
        F.max("ts").alias("max_ts"))


def profile_sketches(events: DataFrame, *by: str, lg_k: int = 14) -> DataFrame:
    """The profile as mergeable parts, one per ``by`` (a batch, a day): counts, times, and a sketch per distinct count.

    A sketch has at most 2^``lg_k`` bytes or so whatever the number of keys; its
    relative standard error is about 0.83 / sqrt(2^lg_k) (0.65 % by default).
    """
    aggregates = [F.count(F.lit(1)).alias("event_count"), F.hll_sketch_agg("user_id", lg_k).alias("users"),
                  F.hll_sketch_agg("content_id", lg_k).alias("contents"), F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts")]
    return events.groupBy(*by).agg(*aggregates) if by else events.agg(*aggregates)


def merged_profile(sketches: DataFrame) -> DataFrame:
    """:func:`event_profile` of all parts together, without the events: the distinct counts are estimates."""
    distinct = lambda c: F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0))
    return sketches.agg(F.coalesce(F.sum("event_count"), F.lit(0)).alias("event_count"), distinct("users").alias("distinct_users"),
                        distinct("contents").alias("distinct_contents"), F.min("min_ts").alias("min_ts"), F.max("max_ts").alias("max_ts"))


def feature_profile(features: DataFrame) -> DataFrame:
    """One row: feature rows emitted and distinct entities served."""
    return features.agg(
        F.count(F.lit(1)).alias("total_features"),
        F.count_distinct("entity_id").alias("distinct_entities"))


def combined_profile(events: DataFrame, features: DataFrame) -> DataFrame:
    """Both one-row profiles side by side.

    The two single-row aggregates are stacked (union) and folded with
    ``max``; no join is needed.
    """
    a = event_profile(events)
    b = feature_profile(features)
    stacked = a.unionByName(b, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in a.columns + b.columns])


def event_type_counts(events: DataFrame) -> DataFrame:
    """Histogram of event types, most frequent first."""
    return (events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), F.col("event_type")))
