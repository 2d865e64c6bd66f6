"""What a micro-batch of closed windows and late events gives: feature rows, records, metrics.

One ``foreachBatch`` writer with several outputs, each below a folder named by batch id
and overwritten as a whole:

    closed/        the batch as the stateful query made it, windows' parts added up; all else is made from it
    features/      long feature rows, ``computed_at`` = the batch's emission stamp
    records/       the same rows as (key, value) JSON records, or Kafka
    late_events/   late events with their running count
    metrics/       a metric row per late event, a heartbeat per user feature row
    fold/          the fold of all metric rows so far, one row
    ledger/        the stamp (written first) and the totals after the batch (written last)

A batch that is in the ledger is not written again.  One that failed half-way is: the
stateful query makes the same rows from the same input, the stamp is kept, the totals
before it come from the ledger, so every row appears once with the same values.
"""

from __future__ import annotations

import os
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellspark.functions.literals import literal_table
from dwellspark.operators import metrics
from dwellspark.operators.ordered import running_sums
from dwellspark.schemas import HEARTBEAT_METRIC, LATE_METRIC
from dwellspark.session import list_paths, path_exists
from dwellspark.sinks.files import feature_wire_json, write_kafka
from dwellspark.spec import FeatureSpec
from dwellspark.streaming.stateful import CLOSED, LATE, feature_values, merged

FEATURES = ("family string, entity_id string, feature_name string, feature_value double, feature_value_int bigint, "
            "window_start timestamp_ntz, window_end timestamp_ntz, computed_at timestamp_ntz")
RECORDS = "key string, value string"
LATE_EVENTS = "user_id string, content_id string, event_type string, ts timestamp_ntz, window_end timestamp_ntz, late_count bigint"
METRICS = ("metric_offset bigint, metric_type string, count bigint, dropped_user_id string, dropped_event_ts timestamp_ntz, "
           "recorded_at timestamp_ntz, feature_computed_at timestamp_ntz, late_events_total bigint")
STAMP = "emitted_us bigint"
TOTALS = "late_total bigint, metric_total bigint, feature_total bigint"


class FeatureOutputs:
    """The folders of one job; ``process`` is the batch writer."""

    def __init__(self, root: str, spec: FeatureSpec, kafka: tuple[str, str, str] | None = None):
        """``kafka``: (servers, feature topic, metrics topic) to send records there as well."""
        self.root, self.spec, self.kafka = root, spec, kafka

    def _folder(self, name: str, batch_id: int | None = None) -> str:
        path = os.path.join(self.root, name)
        return path if batch_id is None else os.path.join(path, f"batch_id={batch_id}")

    def _write(self, rows: DataFrame, name: str, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(self._folder(name, batch_id))

    def _done(self, spark: SparkSession, name: str, batch_id: int) -> bool:
        return path_exists(spark, os.path.join(self._folder(name, batch_id), "_SUCCESS"))

    def _stamp(self, spark: SparkSession, batch_id: int) -> int:
        """When the batch was first emitted, in microseconds."""
        if not self._done(spark, "ledger/stamps", batch_id):
            now = int(datetime.now(timezone.utc).timestamp() * 1_000_000)
            self._write(literal_table(spark, [(now,)], STAMP), "ledger/stamps", batch_id)
        return spark.read.schema(STAMP).parquet(self._folder("ledger/stamps", batch_id)).first()["emitted_us"]

    def _totals_before(self, spark: SparkSession, batch_id: int) -> tuple[int, int, int]:
        """Totals after the newest earlier batch; batches follow each other without a gap."""
        if batch_id and self._done(spark, "ledger/totals", batch_id - 1):
            return tuple(spark.read.schema(TOTALS).parquet(self._folder("ledger/totals", batch_id - 1)).first())
        earlier = self.read(spark, "ledger/totals", TOTALS).where(F.col("batch_id") < batch_id)
        row = earlier.orderBy(F.col("batch_id").desc()).drop("batch_id").first()
        return (0, 0, 0) if row is None else tuple(row)

    def _fold_before(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """The newest fold state of an earlier batch (batches without metric rows have none)."""
        earlier = [int(p.rsplit("=", 1)[1]) for p in list_paths(spark, self._folder("fold") + "/batch_id=*")]
        last = max((k for k in earlier if k < batch_id), default=None)
        return None if last is None else spark.read.schema(metrics.FOLD).parquet(self._folder("fold", last))

    def health(self, spark: SparkSession, as_of) -> DataFrame:
        """The health snapshot after the newest batch; reads one row."""
        totals = self.totals(spark).agg(F.max("batch_id")).first()[0]
        state = None if totals is None else self._fold_before(spark, totals + 1)
        empty = spark.createDataFrame([], METRICS)
        return metrics.fold_snapshot(metrics.fold_state(empty) if state is None else state, as_of)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if self._done(spark, "ledger/totals", batch_id):
            return
        stamp = F.timestamp_micros(F.lit(self._stamp(spark, batch_id))).cast("timestamp_ntz")
        late_total, metric_total, feature_total = self._totals_before(spark, batch_id)
        self._write(merged(batch), "closed", batch_id)
        closed = spark.read.schema(CLOSED).parquet(self._folder("closed", batch_id))
        sizes = closed.groupBy("kind", "family").count().collect()  # a row per kind and family
        n = {(r["kind"], r["family"]): r["count"] for r in sizes}
        n_late, n_user = n.get((LATE, "user"), 0), n.get(("window", "user"), 0)
        n_features = sum(c for (kind, family), c in n.items() if kind == "window") + n_user  # two per user window

        features = feature_values(closed, self.spec).withColumn("computed_at", stamp)
        if n_features:
            rows = features.select(*[c.split()[0] for c in FEATURES.split(", ")])
            self._write(rows, "features", batch_id)
            records = feature_wire_json(spark.read.schema(FEATURES).parquet(self._folder("features", batch_id)))
            self._write(records, "records", batch_id)
            if self.kafka:
                write_kafka(records, self.kafka[0], self.kafka[1])
        if n_late or n_user:
            self._metrics(closed, features, stamp, late_total, metric_total, n_late, batch_id)
        after = (late_total + n_late, metric_total + n_late + 2 * n_user, feature_total + n_features)
        self._write(literal_table(spark, [after], TOTALS), "ledger/totals", batch_id)

    def _metrics(self, closed: DataFrame, features: DataFrame, stamp, late_total: int, metric_total: int, n_late: int,
                 batch_id: int) -> None:
        """Late rows by (time, user, content, type), then heartbeats by (window, user, feature)."""
        spark = closed.sparkSession
        none = lambda kind: F.lit(None).cast(kind)
        time = lambda c: F.timestamp_micros(F.col(c)).cast("timestamp_ntz")
        late = closed.where((F.col("kind") == LATE) & (F.col("family") == "user")).select(
            F.lit(0).alias("o_kind"), F.col("ts_us").alias("o_time"), F.col("user_id").alias("o_user"),
            F.coalesce("content_id", F.lit("")).alias("o_more"), F.col("event_type").alias("o_last"),
            F.lit(1).alias("one"), F.lit(1).alias("w_late"), "content_id", "event_type", time("ts_us").alias("ts"), time("end_us").alias("window_end"))
        beats = features.where(F.col("family") == "user").select(
            F.lit(1).alias("o_kind"), F.unix_micros(F.col("window_end").cast("timestamp")).alias("o_time"), F.col("entity_id").alias("o_user"),
            F.col("feature_no").cast("string").alias("o_more"), F.lit("").alias("o_last"), F.lit(1).alias("one"), F.lit(0).alias("w_late"),
            none("string").alias("content_id"), none("string").alias("event_type"), none("timestamp_ntz").alias("ts"), none("timestamp_ntz").alias("window_end"))
        order = ["o_kind", "o_time", "o_user", "o_more", "o_last"]
        placed = running_sums(late.unionByName(beats), order, {"nth": "one", "late_so_far": "w_late"})
        is_late = F.col("o_kind") == 0
        count = (F.lit(late_total) + F.col("late_so_far")).cast("bigint")
        rows = placed.select(
            (F.lit(metric_total) + F.col("nth")).cast("bigint").alias("metric_offset"),
            F.when(is_late, F.lit(LATE_METRIC)).otherwise(F.lit(HEARTBEAT_METRIC)).alias("metric_type"),
            F.when(is_late, count).alias("count"), F.when(is_late, F.col("o_user")).alias("dropped_user_id"),
            F.col("ts").alias("dropped_event_ts"), F.when(is_late, stamp).alias("recorded_at"),
            F.when(~is_late, stamp).alias("feature_computed_at"), F.when(~is_late, count).alias("late_events_total"))
        self._write(rows, "metrics", batch_id)
        # the fold of all metric rows so far: the state before and the rows of this batch only
        new = metrics.fold_state(spark.read.schema(METRICS).parquet(self._folder("metrics", batch_id)))
        before = self._fold_before(spark, batch_id)
        self._write(new if before is None else metrics.merge_folds(before.unionByName(new)), "fold", batch_id)
        if n_late:
            self._write(placed.where(is_late).select(F.col("o_user").alias("user_id"), "content_id", "event_type", "ts", "window_end",
                                                     count.alias("late_count")), "late_events", batch_id)
        if self.kafka:
            written = spark.read.schema(METRICS).parquet(self._folder("metrics", batch_id))
            write_kafka(written.select("metric_type", F.to_json(F.struct("*")).alias("value")).withColumnRenamed("metric_type", "key"),
                        self.kafka[0], self.kafka[2])

    def read(self, spark: SparkSession, name: str, ddl: str) -> DataFrame:
        """An output of all batches in the ledger, with ``batch_id`` (empty before the first one)."""
        path = self._folder(name)
        if not path_exists(spark, path):
            return spark.createDataFrame([], ddl + ", batch_id int")
        rows = spark.read.schema(ddl + ", batch_id int").parquet(path)
        if name.startswith("ledger/") or not path_exists(spark, self._folder("ledger/totals")):
            return rows
        ledger = spark.read.schema(TOTALS + ", batch_id int").parquet(self._folder("ledger/totals")).select("batch_id")
        return rows.join(ledger, "batch_id", "left_semi")

    def features(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, "features", FEATURES)

    def records(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, "records", RECORDS)

    def late_events(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, "late_events", LATE_EVENTS)

    def metrics(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, "metrics", METRICS)

    def closed(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, "closed", CLOSED)

    def totals(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, "ledger/totals", TOTALS)
