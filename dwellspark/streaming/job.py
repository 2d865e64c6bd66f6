"""Structured Streaming feature job.

The feature functions of ``operators/features.py`` run unchanged on a
watermarked streaming DataFrame:

    wire values ─ parse/quarantine ─ withWatermark(ts, delay) ─┬─ user windows    → features/family=user
                                                               ├─ content windows → features/family=content
                                                               ├─ ⋈ metadata → affinity → features/family=affinity
                                                               └─ foreachBatch late audit → late_events, metrics

Each family is its own append-mode query with one stateful operator (no
chained stateful operators, so ``statefulOperator.allowMultiple=false`` is
safe and late rows are dropped in the batch whose watermark closes their
window).  Sinks are parquet file sinks: exactly-once through the sink's
commit log and the query checkpoint; a restarted query resumes from its
checkpoint.  A Kafka source drops in for the file source unchanged (the
Kafka connector jar must be on the classpath; it is not in this image).
"""

from __future__ import annotations

import os
import re
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dwellspark.functions.expressions import count_where, packed_order
from dwellspark.functions.literals import literal_table
from dwellspark.operators import enrich, features
from dwellspark.schemas import HEARTBEAT_METRIC, LATE_METRIC
from dwellspark.session import cut_lineage, path_exists
from dwellspark.sinks.files import LatestFeatureTable
from dwellspark.sources import wire
from dwellspark.spec import FeatureSpec
from dwellspark.streaming import stateful
from dwellspark.streaming.outputs import FeatureOutputs
from dwellspark.streaming.progress import ProgressMetrics


# --------------------------------------------------------------------- sources

def wire_file_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Text files of JSON lines as a stream of ``value`` strings (oldest first)."""
    return (spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
            .option("latestFirst", "false").text(path))


def kafka_stream(spark: SparkSession, servers: str, topic: str,
                 starting_offsets: str = "earliest", max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Kafka topic as a stream of ``value`` strings with their offsets."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load().selectExpr("CAST(value AS STRING) AS value", "partition", "offset")


def state_partitions_for(spark: SparkSession, rows_per_trigger: int, rows_per_partition: int = 10_000) -> int:
    """State-store partitions for a stream: enough for the per-trigger volume,
    never more than the session's shuffle partitions.  Fixed at first start."""
    cap = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(cap, -(-rows_per_trigger // rows_per_partition)))


# ------------------------------------------------------------------- the job

def parsed_events(values: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Good events with a watermark on event time (TIMESTAMP, UTC)."""
    good = wire.good_events(wire.classify_wire_events(values))
    return good.withWatermark("ts", f"{spec.watermark_delay_s} seconds")


ENRICHED_DDL = ("user_id string, content_id string, event_type string, dwell_time_ms bigint, ts timestamp, "
                "category string, creator_id string")


def _ntz(df: DataFrame, cols=("window_start", "window_end")) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


@dataclass
class FeatureStreamJob:
    """Owns the paths of one streaming deployment (all under a shared folder)."""

    spark: SparkSession
    root: str
    spec: FeatureSpec
    # opens the content metadata; called for every micro-batch
    metadata: Callable[[SparkSession], DataFrame] | None = None
    trigger: dict = field(default_factory=lambda: {"availableNow": True})
    # shuffle / state-store partitions of the stateful queries; fixed in the
    # checkpoint at first start (None: the session's setting)
    state_partitions: int | None = None

    def path(self, *parts: str) -> str:
        return os.path.join(self.root, *parts)

    def _start(self, writer) -> StreamingQuery:
        """Start with ``state_partitions`` in effect (the query clones the
        session conf at start; the session's own value is restored)."""
        if self.state_partitions is None:
            return writer.start()
        key = "spark.sql.shuffle.partitions"
        before = self.spark.conf.get(key)
        self.spark.conf.set(key, str(self.state_partitions))
        try:
            return writer.start()
        finally:
            self.spark.conf.set(key, before)

    def _sink(self, df: DataFrame, name: str, trigger: dict | None = None) -> StreamingQuery:
        return self._start(df.writeStream.format("parquet").outputMode("append")
                           .option("path", self.path("features", f"family={name}"))
                           .option("checkpointLocation", self.path("checkpoints", name))
                           .trigger(**(trigger or self.trigger))
                           .queryName(f"features_{name}_{os.path.basename(self.root)}"))

    # one query per feature family
    def start_user(self, values: DataFrame) -> StreamingQuery:
        feats = features.user_hourly_features(parsed_events(values, self.spec), self.spec)
        return self._sink(_ntz(feats), "user")

    def start_content(self, values: DataFrame) -> StreamingQuery:
        feats = features.content_engagement(parsed_events(values, self.spec), self.spec, sliding=True)
        return self._sink(_ntz(feats), "content")

    def start_affinity(self, values: DataFrame) -> StreamingQuery:
        """Affinity windows over events enriched with the metadata of their micro-batch.

        A frame over files lists them once, so the metadata is opened anew for
        each micro-batch (``metadata`` is called): the batch's events are
        enriched and written, and the window query takes them in as one
        micro-batch of its own before the next one starts.
        """
        if self.metadata is None:
            raise ValueError("affinity needs content metadata")
        enriched = self.path("enriched")

        def enrich_batch(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            folder = os.path.join(enriched, f"batch_id={batch_id}")
            if not path_exists(spark, os.path.join(folder, "_SUCCESS")):  # a repeated batch is written once
                meta = enrich.latest_metadata(self.metadata(spark))
                rows = enrich.enrich_events(batch, meta, how="left")
                columns = [c.split()[0] for c in ENRICHED_DDL.split(", ")]
                rows.select(*columns).write.mode("overwrite").parquet(folder)
            window = self._affinity_windows(spark)
            window.awaitTermination()

        good = wire.good_events(wire.classify_wire_events(values))
        return self._start(good.writeStream.foreachBatch(enrich_batch)
                           .option("checkpointLocation", self.path("checkpoints", "enrich"))
                           .trigger(**self.trigger)
                           .queryName(f"enrich_{os.path.basename(self.root)}"))

    def _affinity_windows(self, spark: SparkSession) -> StreamingQuery:
        rows = spark.readStream.schema(ENRICHED_DDL).parquet(os.path.join(self.path("enriched"), "*"))
        rows = rows.withWatermark("ts", f"{self.spec.watermark_delay_s} seconds")
        # unmatched events move the watermark too: tied to ts, the filter on the
        # category is not pushed below it
        rows = rows.withColumn("category", F.when(F.col("ts").isNotNull(), F.col("category")))
        feats = features.category_affinity(rows, self.spec, keep_unmatched=False)
        return self._sink(_ntz(feats), "affinity", trigger={"availableNow": True})

    def start_outputs(self, values: DataFrame, families: tuple[str, ...] = ("user", "content", "affinity"),
                      kafka: tuple[str, str, str] | None = None) -> StreamingQuery:
        """One query for the windows of all families, their late events, feature records and metrics.

        Windows and late events come from one stateful operator (``stateful``), the sinks from
        one batch writer (``outputs``).  The metadata for affinity is opened when the query starts.
        """
        events = wire.good_events(wire.classify_wire_events(values))
        if "affinity" in families:
            if self.metadata is None:
                raise ValueError("affinity needs content metadata")
            # worked out once, not in every micro-batch
            latest = cut_lineage(enrich.latest_metadata(self.metadata(self.spark)))
            events = enrich.enrich_events(events, latest, how="left")
        partitions = self.state_partitions or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        closed = stateful.closed_windows(events, self.spec, families, buckets=4 * partitions)
        return self._start(closed.writeStream.foreachBatch(self.outputs(kafka).process).outputMode("append")
                           .option("checkpointLocation", self.path("checkpoints", "outputs"))
                           .trigger(**self.trigger)
                           .queryName(f"outputs_{os.path.basename(self.root)}"))

    def outputs(self, kafka: tuple[str, str, str] | None = None) -> FeatureOutputs:
        return FeatureOutputs(self.path("outputs"), self.spec, kafka)

    def start_quarantine(self, values: DataFrame) -> StreamingQuery:
        """Unreadable records with their reason, as they came."""
        bad = wire.quarantined(wire.classify_wire_events(values))
        return self._start(bad.writeStream.format("parquet").outputMode("append")
                           .option("path", self.path("quarantine"))
                           .option("checkpointLocation", self.path("checkpoints", "quarantine"))
                           .trigger(**self.trigger))

    def quarantined(self) -> DataFrame:
        """The quarantine table (empty where nothing was written)."""
        return read_if_there(self.spark, self.path("quarantine"), "value string, reason string")

    def start_late_audit(self, values: DataFrame) -> StreamingQuery:
        audit = LateAudit(self.path("audit"), self.spec)
        good = wire.good_events(wire.classify_wire_events(values))
        return self._start(good.writeStream.foreachBatch(audit.process)
                           .option("checkpointLocation", self.path("checkpoints", "audit"))
                           .trigger(**self.trigger))

    def run_all(self, values_factory, families=("user", "content", "affinity"),
                audit: bool = True, timeout_s: float | None = None) -> None:
        """Start the chosen queries on fresh source frames and wait until all have ended.

        A query that fails stops the others and raises; so does ``timeout_s``
        (no limit by default): a stream never counts as done before its end.
        """
        starters = {"user": self.start_user, "content": self.start_content,
                    "affinity": self.start_affinity}
        queries = []
        until = None if timeout_s is None else time.monotonic() + timeout_s
        try:
            for f in families:
                queries.append(starters[f](values_factory()))
            if audit:
                queries.append(self.start_late_audit(values_factory()))
            wait_for(queries, until)
        except BaseException:
            for q in queries:
                if q.isActive:
                    q.stop()
            raise

    def start_latest_upsert(self, families=("user", "content", "affinity")) -> StreamingQuery:
        """Feature sink → long rows → latest-value table, one version per batch.

        Reads the family sinks as file streams (committed files only, via the
        sinks' metadata logs) and upserts through ``foreachBatch``.
        """
        table = LatestFeatureTable(self.path("latest"))
        longs = None
        for fam in families:
            src = self.path("features", f"family={fam}")
            wide = self.spark.readStream.schema(self.family_schema(fam)).parquet(src)
            if fam == "user":
                rows = features.user_feature_rows(wide, self.spec)
            elif fam == "content":
                rows = features.content_feature_rows(wide, self.spec)
            else:
                rows = features.affinity_feature_rows(wide, self.spec)
            rows = features.drop_wire_extras(rows)
            longs = rows if longs is None else longs.unionByName(rows)
        return self._start(longs.writeStream.foreachBatch(table.upsert)
                           .option("checkpointLocation", self.path("checkpoints", "latest"))
                           .trigger(**self.trigger))

    def family_schema(self, family: str):
        """Schema of a family sink, derived from the feature function itself
        (so a reader can start before the first file is written)."""
        empty = self.spark.createDataFrame(
            [], "user_id string, content_id string, event_type string, dwell_time_ms bigint, "
                "ts timestamp, category string, creator_id string")
        if family == "user":
            out = features.user_hourly_features(empty, self.spec)
        elif family == "content":
            out = features.content_engagement(empty, self.spec, sliding=True)
        else:
            out = features.category_affinity(empty, self.spec, keep_unmatched=False)
        return _ntz(out).schema

    def latest(self) -> "LatestFeatureTable":
        return LatestFeatureTable(self.path("latest"))

    def features(self, family: str | None = None) -> DataFrame:
        p = self.path("features") if family is None else self.path("features", f"family={family}")
        return self.spark.read.parquet(p)


def read_if_there(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A parquet table of ours; empty if it does not exist yet.  Any other error is raised."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).parquet(path)


def wait_for(queries: list[StreamingQuery], until: float | None = None) -> None:
    """Wait for the end of all queries; raise as soon as one has failed or the time is over."""
    open_ = list(queries)
    while open_:
        for q in list(open_):
            if q.awaitTermination(1):  # raises if the query has failed
                open_.remove(q)
        if open_ and until is not None and time.monotonic() > until:
            raise TimeoutError(f"{len(open_)} of {len(queries)} streams have not ended in time")


def progress_health(query: StreamingQuery) -> dict:
    """Health signals from the last progress report of a feature query.

    ``watermark`` is the true event-time watermark; ``rows_dropped_by_watermark``
    counts rows the stateful operator discarded *after* partial aggregation
    (a health signal, not the late-event count — that comes from LateAudit).
    """
    progress = query.lastProgress or {}
    event_time = progress.get("eventTime") or {}
    dropped = sum(int(op.get("numRowsDroppedByWatermark", 0)) for op in progress.get("stateOperators", []))
    state_rows = sum(int(op.get("numRowsTotal", 0)) for op in progress.get("stateOperators", []))
    return {"batch_id": progress.get("batchId"), "watermark": event_time.get("watermark"),
            "rows_dropped_by_watermark": dropped, "state_rows": state_rows,
            "input_rows": progress.get("numInputRows")}


class LateAudit:
    """foreachBatch audit of late events for the user windows.

    For micro-batch k the watermark is ``max(ts of batches < k) - delay``
    (what the windowed aggregation uses for batch k when
    ``allowMultiple=false``).  Rows whose window ended at or before it go to
    ``late_events``, with a metric row each; a heartbeat per batch records the
    late total and the watermark.  Every write targets a folder named by
    batch id and overwrites it, so a retried batch is idempotent.  Both
    queries must cut micro-batches alike (same ``maxFilesPerTrigger`` /
    ``maxOffsetsPerTrigger`` and start point) for the audit to equal the
    aggregation's drops.
    """

    def __init__(self, root: str, spec: FeatureSpec):
        self.root = root
        self.spec = spec

    STATE_DDL = "running_max_us bigint, late_total bigint"
    METRIC_DDL = ("metric_type string, count bigint, dropped_user_id string, dropped_event_ts timestamp_ntz, "
                  "recorded_at timestamp_ntz, feature_computed_at timestamp_ntz, late_events_total bigint, "
                  "watermark timestamp_ntz, metric_offset bigint, batch_id int")

    def _state_before(self, spark: SparkSession, batch_id: int):
        """(running maximum, late total) of the newest batch before this one."""
        state = os.path.join(self.root, "state")
        last = os.path.join(state, f"batch_id={batch_id - 1}")
        if path_exists(spark, last):  # common case: one small file
            row = spark.read.schema(self.STATE_DDL).parquet(last).first()
        else:  # a gap in batch ids
            row = (read_if_there(spark, state, self.STATE_DDL + ", batch_id int").where(F.col("batch_id") < batch_id)
                   .orderBy(F.col("batch_id").desc()).limit(1).first())
        return (None, 0) if row is None else (row["running_max_us"], int(row["late_total"]))

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()  # read twice below; the source is not re-scanned
        running_max, late_total = self._state_before(spark, batch_id)
        win = F.window("ts", self.spec.user_window)
        tagged = batch.select("user_id", "content_id", "event_type", "ts",
                              win.start.alias("window_start"), win.end.alias("window_end"))
        # times travel as epoch microseconds (no driver-side time zones)
        delay_us = self.spec.watermark_delay_s * 1_000_000
        if running_max is not None:
            is_late = F.unix_micros(F.col("window_end")) <= F.lit(running_max - delay_us)
        else:
            is_late = F.lit(False)
        # one pass over the (cached) batch: its max event time and late count
        stats = tagged.agg(F.max(F.unix_micros("ts")).alias("m"), count_where(is_late).alias("n")).first()
        batch_max, n_late = stats["m"], int(stats["n"])
        if n_late:
            late_path = os.path.join(self.root, "late_events", f"batch_id={batch_id}")
            tagged.where(is_late).write.mode("overwrite").parquet(late_path)
        new_max = max([x for x in (running_max, batch_max) if x is not None], default=None)
        new_total = late_total + n_late
        state = literal_table(spark, [(new_max, new_total)], self.STATE_DDL)
        state.write.mode("overwrite").parquet(os.path.join(self.root, "state", f"batch_id={batch_id}"))
        # a metric row per late event (it adds one), and a heartbeat with the total
        now, none = F.current_timestamp().cast("timestamp_ntz"), F.lit(None)
        watermark = (F.timestamp_micros(F.lit(new_max - delay_us)).cast("timestamp_ntz")
                     if new_max is not None else none.cast("timestamp_ntz"))
        beat = spark.range(1).select(
            F.lit(HEARTBEAT_METRIC).alias("metric_type"), none.cast("bigint").alias("count"),
            none.cast("string").alias("dropped_user_id"), none.cast("timestamp_ntz").alias("dropped_event_ts"),
            none.cast("timestamp_ntz").alias("recorded_at"), now.alias("feature_computed_at"),
            F.lit(new_total).cast("bigint").alias("late_events_total"), watermark.alias("watermark"),
            F.lit(2 * batch_id + 1).cast("bigint").alias("metric_offset"))
        rows = beat
        if n_late:
            rows = tagged.where(is_late).select(
                F.lit(LATE_METRIC).alias("metric_type"), none.cast("bigint").alias("count"),
                F.col("user_id").alias("dropped_user_id"), F.col("ts").cast("timestamp_ntz").alias("dropped_event_ts"),
                now.alias("recorded_at"), none.cast("timestamp_ntz").alias("feature_computed_at"),
                none.cast("bigint").alias("late_events_total"), none.cast("timestamp_ntz").alias("watermark"),
                F.lit(2 * batch_id).cast("bigint").alias("metric_offset")).unionByName(beat)
        rows.write.mode("overwrite").parquet(os.path.join(self.root, "metrics", f"batch_id={batch_id}"))
        batch.unpersist()

    LATE_DDL = ("user_id string, content_id string, event_type string, ts timestamp, "
                "window_start timestamp, window_end timestamp, batch_id int")

    def late_events(self, spark: SparkSession) -> DataFrame:
        """All audited late rows (an empty frame before the first one)."""
        return read_if_there(spark, os.path.join(self.root, "late_events"), self.LATE_DDL)

    def metrics(self, spark: SparkSession) -> DataFrame:
        """All metric rows: late events with user and times, heartbeats with the total."""
        return read_if_there(spark, os.path.join(self.root, "metrics"), self.METRIC_DDL)


def main(argv=None) -> int:
    """Run the feature pipeline as a stream.

        python -m dwellspark.streaming.job --root <shared dir> \\
            (--input-dir <JSON-line files> | --kafka-servers host:9092 --topic user-events) \\
            [--metadata-json <dir of metadata JSON lines>] [--once] [--interval "60 seconds"] [--one-query]

    Starts one append query per feature family, the late-event audit and the
    latest-value upsert, all checkpointed under ``--root``.  ``--once``
    processes what is available and stops (availableNow); otherwise the
    queries run on a processing-time trigger until stopped.  ``--one-query``
    runs one stateful query instead, with long feature rows and JSON records.
    """
    import argparse

    from dwellspark.session import build_session
    from dwellspark.spec import WIRE_SPEC

    p = argparse.ArgumentParser(description="dwellspark streaming feature job")
    p.add_argument("--root", required=True, help="shared folder for sinks and checkpoints")
    p.add_argument("--input-dir")
    p.add_argument("--kafka-servers")
    p.add_argument("--topic", default="user-events")
    p.add_argument("--metadata-json", help="folder of content-metadata JSON lines")
    p.add_argument("--max-per-trigger", type=int, default=None)
    p.add_argument("--once", action="store_true")
    p.add_argument("--interval", default="60 seconds")
    p.add_argument("--one-query", action="store_true",
                   help="windows, late events, feature records and metrics from one stateful query")
    p.add_argument("--feature-topic", help="with --one-query and --kafka-servers: topic for feature records")
    p.add_argument("--metrics-topic", default="pipeline-metrics")
    p.add_argument("--master", default=None)
    a = p.parse_args(argv)
    if not (a.input_dir or a.kafka_servers):
        p.error("give --input-dir or --kafka-servers")

    spark = build_session(a.master, app_name="dwellspark-stream")

    def source() -> DataFrame:
        if a.kafka_servers:
            return kafka_stream(spark, a.kafka_servers, a.topic, max_offsets_per_trigger=a.max_per_trigger)
        return wire_file_stream(spark, a.input_dir, a.max_per_trigger or 1)

    metadata = None
    if a.metadata_json:
        metadata = json_metadata(a.metadata_json)
    trigger = {"availableNow": True} if a.once else {"processingTime": a.interval}
    job = FeatureStreamJob(spark, a.root, WIRE_SPEC, metadata=metadata, trigger=trigger)
    listener = ProgressMetrics(spark, job.path("progress"), f"_{re.escape(os.path.basename(job.root))}$")
    spark.streams.addListener(listener)
    try:
        return run_command(spark, job, source, a)
    finally:
        spark.streams.removeListener(listener)


def run_command(spark: SparkSession, job: FeatureStreamJob, source: Callable[[], DataFrame], a) -> int:
    """Runs what the command line ``a`` asks for; returns when its queries have ended."""
    metadata = job.metadata
    families = ("user", "content", "affinity") if metadata is not None else ("user", "content")
    if a.one_query:
        kafka = (a.kafka_servers, a.feature_topic, a.metrics_topic) if a.kafka_servers and a.feature_topic else None
        wait_for([job.start_outputs(source(), families=families, kafka=kafka), job.start_quarantine(source())])
        return 0
    if a.once:
        job.run_all(source, families=families, audit=True)
        wait_for([job.start_quarantine(source()), job.start_latest_upsert(families=families)])
        return 0
    starters = {"user": job.start_user, "content": job.start_content, "affinity": job.start_affinity}
    queries = [starters[fam](source()) for fam in families]
    queries += [job.start_late_audit(source()), job.start_quarantine(source()), job.start_latest_upsert(families=families)]
    try:
        spark.streams.awaitAnyTermination()  # raises if the one that ended has failed
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
    return 0


def json_metadata(folder: str) -> Callable[[SparkSession], DataFrame]:
    """Opens a folder of metadata JSON lines.  Version order: newest file first,
    then the latest publish time within it."""
    def open_(spark: SparkSession) -> DataFrame:
        raw = spark.read.text(folder).select("value", F.col("_metadata.file_modification_time").alias("file_time"))
        return wire.parse_wire_metadata(raw).withColumn("seq", packed_order(
            F.unix_micros(F.col("file_time")), F.coalesce(F.unix_micros(F.col("publish_ts")), F.lit(0))))
    return open_


if __name__ == "__main__":
    raise SystemExit(main())
