"""Batch scans of the driver's parquet tables, mapped onto the event model.

The driver's ``events`` table has no content, dwell or like/share columns;
the adapter below maps it onto the wire model the same way the oracle SQL
does (see FIXTURES.md §2).  Only the columns a query needs are read:
Catalyst prunes the parquet scan to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellspark.functions.literals import literal_table
from dwellspark.session import table_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def normalize_driver_events(raw: DataFrame) -> DataFrame:
    """``events`` → (event_id, user_id, content_id, event_type, dwell_time_ms, ts).

    * user_id as text (ids are text on the wire)
    * content_id = ``props.k`` as text
    * dwell_time_ms = round(value * 1000) as BIGINT (round before the cast:
      engines differ on whether a cast rounds or truncates)
    * ts stays TIMESTAMP_NTZ (UTC wall clock) for batch work.
    """
    return raw.select(
        F.col("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.get_json_object("props", "$.k").alias("content_id"),
        F.col("event_type"),
        F.round(F.col("value") * F.lit(1000)).cast("bigint").alias("dwell_time_ms"),
        F.col("ts"),
    )


def driver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_driver_events(read_table(spark, sf_dir, "events"))


def driver_content_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versioned content metadata derived from the ``part`` table of ``sf_dir``."""
    return content_metadata(read_table(spark, sf_dir, "part"))


def content_metadata(part: DataFrame) -> DataFrame:
    """Versioned content metadata derived from a table like ``part``.

    content_id = p_partkey (text), category = p_type, creator_id = p_brand,
    seq = 1.  Keys with p_partkey % 7 = 0 get a second, later version
    (seq = 2) whose category is lower-cased, so latest-wins is observable.
    """
    part = part.select("p_partkey", "p_type", "p_brand")
    v1 = part.select(
        F.col("p_partkey").cast("string").alias("content_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("creator_id"),
        F.lit(1).cast("bigint").alias("seq"))
    v2 = part.where(F.col("p_partkey") % 7 == 0).select(
        F.col("p_partkey").cast("string").alias("content_id"),
        F.lower(F.col("p_type")).alias("category"),
        F.col("p_brand").alias("creator_id"),
        F.lit(2).cast("bigint").alias("seq"))
    return v1.unionByName(v2)


def fixed_category_lookup(spark: SparkSession) -> DataFrame:
    """The batch job's hard-coded content → category map (four rows)."""
    # The batch job's lookup.
    rows = [("content1", "scifi"), ("content2", "news"),
            ("content3", "sports"), ("content4", "comedy")]
    return literal_table(spark, rows, "content_id string, category string")
