"""Feature serving: latest-value table, entity lookup, freshness, recent feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellspark.functions.expressions import (epoch_millis, format_duration,
                                              format_value, freshness_pct, packed_order)
from dwellspark.functions.literals import literal_table

# Features the dashboard tracks for freshness.
TRACKED_FEATURES = ("click_rate", "avg_dwell_time", "engagement_rate")
# 5-minute freshness horizon; lag warning above 60 s.
FRESHNESS_HORIZON_MS = 300_000
LAG_WARNING_MS = 60_000


def latest_features(features: DataFrame) -> DataFrame:
    """(entity_id, feature_name) → newest record; last write wins.

    Ordered by (computed_at, window_end) so ties on computed_at resolve the
    same way on every run.  One aggregate with map-side combine; the
    ordering is packed into one fixed-width key and every carried column is
    fixed-width, so Spark runs it as a hash aggregate.
    """
    key = packed_order(F.unix_micros(F.col("computed_at").cast("timestamp")),
                       F.unix_micros(F.col("window_end").cast("timestamp")))
    # a feature without an entity cannot be served (ignored, as the UI does)
    return (features.where(F.col("entity_id").isNotNull()).withColumn("_k", key)
            .groupBy("entity_id", "feature_name")
            .agg(F.max_by("feature_value", "_k").alias("feature_value"),
                 F.max_by("window_start", "_k").alias("window_start"),
                 F.max_by("computed_at", "_k").alias("computed_at"),
                 F.max_by("window_end", "_k").alias("window_end")))


def served_value_text(feature_name: Column, value: Column,
                      int_prefix: str = "category_affinity_") -> Column:
    """The value as the serving layer stores it (text): integer features
    (category affinity counts) print without a fraction ("5"), rates as
    doubles ("0.5")."""
    return (F.when(feature_name.startswith(int_prefix), value.cast("bigint").cast("string"))
             .otherwise(value.cast("string")))


def entity_lookup(latest: DataFrame, entity_id: str) -> DataFrame:
    """All latest features of one entity (empty when unknown).

    The equality on ``entity_id`` is pushed below the latest-value aggregate
    (it is a grouping key) into every feature branch.
    """
    return latest.where(F.col("entity_id") == F.lit(entity_id))


def entities_with_feature(latest: DataFrame, feature_name: str) -> DataFrame:
    return latest.where(F.col("feature_name") == F.lit(feature_name)).select("entity_id").distinct()


def feature_freshness(latest: DataFrame, as_of, tracked: Sequence[str] = TRACKED_FEATURES) -> DataFrame:
    """Per feature: newest computed_at over all entities and its age at ``as_of``.

    ``age_ms`` is -1 for a tracked feature never seen.  ``freshness_pct`` is
    100 at age 0 down to 0 at five minutes (low end clamped only).
    """
    return _freshness(latest.select("feature_name", "computed_at", F.lit(1).alias("w")), as_of, tracked)


def freshness_summary(latest: DataFrame, *by: str) -> DataFrame:
    """``by``, feature_name, entity_count, last_computed_at: mergeable (add, max) over parts of the entities."""
    return latest.groupBy(*by, "feature_name").agg(F.count(F.lit(1)).alias("entity_count"),
                                                   F.max("computed_at").alias("last_computed_at"))


def freshness_from_summary(summary: DataFrame, as_of, tracked: Sequence[str] = TRACKED_FEATURES) -> DataFrame:
    """:func:`feature_freshness` from parts of the summary instead of the rows."""
    return _freshness(summary.select("feature_name", F.col("last_computed_at").alias("computed_at"),
                                     F.col("entity_count").alias("w")), as_of, tracked)


def _freshness(seen: DataFrame, as_of, tracked: Sequence[str]) -> DataFrame:
    as_of_col = F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of
    # Tracked names are unioned in with a zero weight and folded by the same
    # aggregate (equivalent to a full outer join on distinct keys, without
    # the join and its two exchanges).
    wanted = literal_table(seen.sparkSession, [(f,) for f in tracked], "feature_name string").select(
        "feature_name", F.lit(None).cast(seen.schema["computed_at"].dataType).alias("computed_at"),
        F.lit(0).alias("w"))
    joined = (seen.unionByName(wanted).groupBy("feature_name")
              .agg(F.max("computed_at").alias("last_computed_at"),
                   F.sum("w").cast("bigint").alias("entity_count")))
    age = epoch_millis(as_of_col) - epoch_millis(F.col("last_computed_at"))
    return joined.select(
        "feature_name",
        F.coalesce(F.col("entity_count"), F.lit(0)).cast("bigint").alias("entity_count"),
        "last_computed_at",
        F.coalesce(age, F.lit(-1)).cast("bigint").alias("age_ms"),
        F.when(F.col("last_computed_at").isNull(), F.lit(None).cast("double"))
         .otherwise(freshness_pct(age, FRESHNESS_HORIZON_MS)).alias("freshness_pct"),
        format_duration(F.coalesce(age, F.lit(-1))).alias("age_text"))


def entity_freshness(latest: DataFrame, entity_id: str, feature_name: str, as_of) -> DataFrame:
    """Age in ms of one (entity, feature); one row with -1 when unseen."""
    as_of_col = F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of
    hit = (latest.where((F.col("entity_id") == entity_id) & (F.col("feature_name") == feature_name))
           .agg(F.max("computed_at").alias("computed_at")))
    return hit.select(
        F.lit(entity_id).alias("entity_id"), F.lit(feature_name).alias("feature_name"),
        F.coalesce(epoch_millis(as_of_col) - epoch_millis(F.col("computed_at")), F.lit(-1))
         .cast("bigint").alias("freshness_ms"))


def recent_features(features: DataFrame, n: int = 60) -> DataFrame:
    """The live feed: newest ``n`` feature rows with the value shown to 4 decimals.

    Total order (computed_at desc, then identity columns) so the cut at ``n``
    is deterministic; planned as a per-partition top-n (TakeOrderedAndProject).
    """
    return (features
            .orderBy(F.col("computed_at").desc(), F.col("feature_name"), F.col("entity_id"),
                     F.col("window_start").desc())
            .limit(n)
            .select("entity_id", "feature_name", "feature_value",
                    format_value(F.col("feature_value")).alias("value_text"),
                    "window_start", "window_end", "computed_at"))


def top_rows(df: DataFrame, keys: Sequence[str], n: int = 20) -> DataFrame:
    """Sorted-by-keys first ``n`` rows (the console summary of each result)."""
    return df.orderBy(*keys).limit(n)
