"""Sinks: CSV export, feature wire JSON, Kafka, latest-value table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellspark.functions.expressions import iso_instant
from dwellspark.operators.serving import freshness_summary, latest_features
from dwellspark.session import content_bytes, list_paths, remove_path


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header row, one folder of part files (no index column)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def feature_wire_json(features: DataFrame) -> DataFrame:
    """Feature rows → (key, value) JSON records for the feature topic.

    Integer features (category affinity) are written as JSON integers
    (``5``), rates as JSON doubles (``0.5``).  The key is
    ``entity_id|feature_name`` so a compacted topic keeps the latest value
    per feature.
    """
    has_int = "feature_value_int" in features.columns
    as_int = F.to_json(F.struct(
        F.col("entity_id"), F.col("feature_name"),
        (F.col("feature_value_int") if has_int else F.lit(None).cast("bigint")).alias("feature_value"),
        iso_instant(F.col("computed_at")).alias("computed_at")))
    as_double = F.to_json(F.struct(
        F.col("entity_id"), F.col("feature_name"), F.col("feature_value"),
        iso_instant(F.col("computed_at")).alias("computed_at")))
    value = F.when(F.col("feature_value_int").isNotNull(), as_int).otherwise(as_double) if has_int else as_double
    return features.select(F.concat_ws("|", "entity_id", "feature_name").alias("key"), value.alias("value"))


def write_kafka(records: DataFrame, servers: str, topic: str) -> None:
    """Batch write of (key, value) records to Kafka (needs the Kafka jar)."""
    (records.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
     .write.format("kafka").option("kafka.bootstrap.servers", servers)
     .option("topic", topic).save())


class DeltaFolders:
    """A small table kept as a base folder and the deltas after it, in the order of their numbers.

    A delta written again under its number replaces itself.  When there are
    ``limit`` deltas they are merged into a new base; what it replaces stays until
    the next merge, for readers that have listed it.
    """

    def __init__(self, path: str, ddl: str, limit: int = 16, partition: str | None = None):
        self.path, self.ddl, self.limit, self.partition = path, ddl, limit, partition

    def _committed(self, spark: SparkSession) -> tuple[list[str], list[str]]:
        """Numbers of (bases, deltas), oldest first."""
        names = sorted(p.rsplit("/", 2)[1].removeprefix("seq=") for p in list_paths(spark, f"{self.path}/seq=*/_SUCCESS"))
        return [n[:-2] for n in names if n.endswith("-b")], [n[:-2] for n in names if n.endswith("-d")]

    @staticmethod
    def _after(bases: list[str], deltas: list[str]) -> list[str]:
        return [d for d in deltas if not bases or d > bases[-1]]

    def _folder(self, number: str, kind: str) -> str:
        return f"{self.path}/seq={number}-{kind}"

    def read(self, spark: SparkSession) -> DataFrame:
        bases, deltas = self._committed(spark)
        folders = [self._folder(n, "b") for n in bases[-1:]] + [self._folder(n, "d") for n in self._after(bases, deltas)]
        empty = spark.createDataFrame([], self.ddl)
        if not folders:
            return empty
        return spark.read.schema(self.ddl).option("basePath", self.path).parquet(*folders).select(*empty.columns)

    def _write(self, rows: DataFrame, folder: str) -> None:
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (writer.partitionBy(self.partition) if self.partition else writer).parquet(folder)

    def append(self, rows: DataFrame, number: tuple[int, int]) -> None:
        self._write(rows, self._folder("{:06d}-{:012d}".format(*number), "d"))

    def merge(self, spark: SparkSession, merged: Callable[[DataFrame], DataFrame]) -> None:
        bases, deltas = self._committed(spark)
        new = self._after(bases, deltas)
        if len(new) < self.limit:
            return
        self._write(merged(self.read(spark)), self._folder(new[-1], "b"))
        for kind, old in (("b", bases[:-1]), ("d", [d for d in deltas if d not in new])):
            for number in old:
                remove_path(spark, self._folder(number, kind))


class LatestFeatureTable:
    """Latest value per (entity_id, feature_name), upserted per micro-batch.

    Without a table format offering MERGE, the table is split into buckets by a
    hash of entity_id and each bucket is versioned on its own:
    ``gen=<generation>-<buckets>/bucket=<b>/version=<v>``.  An upsert rewrites
    the buckets that the batch touches (their newest version merged with the
    batch by ``latest_features``) under the next version number, which is the
    table's own, so a new checkpoint's batch ids do not matter; a repeated batch
    merges to the same rows.  A bucket keeps its newest version and the one
    before it (for readers that have listed it).  The number of buckets follows
    the size: it is chosen from the first batch, and when the buckets have grown
    past four times ``bucket_bytes`` on average the table is dealt anew into the
    next generation.  A point lookup reads one bucket's newest files.

    Two small tables are kept with it.  The *index* has every (feature, entity)
    pair once, dealt by feature, so the entities that have a feature are read from
    one folder; an upsert adds only pairs that its buckets do not hold yet, and
    writes them before the table, so that a failure in between leaves no entity out.
    The *summary* has the newest ``computed_at`` and the number of entities per
    feature and version of a bucket: counted from what was written, so that a
    repeated batch changes nothing.  A bucket whose summary is not there yet is
    read itself.
    """

    PARTS = 16

    COLS = ["entity_id", "feature_name", "feature_value", "window_start", "window_end", "computed_at"]
    DDL = ("entity_id string, feature_name string, feature_value double, window_start timestamp_ntz, "
           "window_end timestamp_ntz, computed_at timestamp_ntz")

    def __init__(self, path: str, buckets: int | None = None, rows_per_bucket: int = 500_000,
                 bucket_bytes: int = 64 << 20):
        self.path = path
        self.buckets = buckets
        self.rows_per_bucket = rows_per_bucket
        self.bucket_bytes = bucket_bytes
        self.index = DeltaFolders(f"{path}/index", "feature_name string, entity_id string, part int", partition="part")
        self.summary = DeltaFolders(f"{path}/summary", "number int, bucket int, version bigint, feature_name string, "
                                    "entity_count bigint, last_computed_at timestamp_ntz")

    def _generation(self, spark: SparkSession) -> tuple[int, int, str] | None:
        """(number, buckets, folder) of the newest committed generation."""
        found = []
        for folder in list_paths(spark, f"{self.path}/gen=*/_SUCCESS"):
            name = folder.rsplit("/", 2)[1]
            number, buckets = name.removeprefix("gen=").split("-")
            found.append((int(number), int(buckets), f"{self.path}/{name}"))
        return max(found, default=None)

    @staticmethod
    def _versions(spark: SparkSession, folder: str, bucket: str = "*") -> dict[int, list[tuple[int, str]]]:
        """Per bucket its versions, newest first: as many entries as there are buckets."""
        out: dict[int, list[tuple[int, str]]] = {}
        for p in list_paths(spark, f"{folder}/bucket={bucket}/version=*"):
            b, v = (int(x.split("=")[1]) for x in p.rsplit("/", 2)[1:])
            out.setdefault(b, []).append((v, p))
        return {b: sorted(v, reverse=True) for b, v in out.items()}

    def _read(self, spark: SparkSession, folders: list[str]) -> DataFrame:
        if not folders:
            return spark.createDataFrame([], self.DDL)
        return spark.read.schema(self.DDL).parquet(*folders)

    @staticmethod
    def _bucket(buckets: int):
        return F.pmod(F.hash(F.col("entity_id")), F.lit(buckets))

    def _write(self, rows: DataFrame, folder: str, buckets: int, version: int) -> None:
        merged = latest_features(rows).select(*self.COLS).withColumn("bucket", self._bucket(buckets))
        merged = merged.withColumn("version", F.lit(version).cast("bigint")).repartition("bucket")
        # a generation begins with one whole write, whose _SUCCESS makes it valid
        kind = "static" if version == 0 else "dynamic"
        (merged.write.mode("overwrite").option("partitionOverwriteMode", kind)
         .partitionBy("bucket", "version").parquet(folder))

    def _part(self, feature_name):
        return F.pmod(F.hash(feature_name), F.lit(self.PARTS))

    def _dealt(self, pairs: DataFrame) -> DataFrame:
        """By feature, a feature over several tasks: a third of all pairs may have the same one."""
        salts = max(1, int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // self.PARTS)
        return pairs.repartition("part", F.pmod(F.xxhash64("entity_id"), F.lit(salts)))

    def _index(self, rows: DataFrame, old: DataFrame, number: tuple[int, int]) -> None:
        pairs = ["feature_name", "entity_id"]
        known = old.select(F.col("feature_name").alias("f"), F.col("entity_id").alias("e"))
        new = rows.select(*pairs).distinct().join(
            known, F.col("feature_name").eqNullSafe(F.col("f")) & (F.col("entity_id") == F.col("e")), "left_anti")
        self.index.append(self._dealt(new.withColumn("part", self._part(F.col("feature_name")))), number)
        self.index.merge(rows.sparkSession, lambda all_: self._dealt(all_.distinct()))

    def _newest(self, spark: SparkSession) -> tuple[int, dict[int, list[tuple[int, str]]]]:
        now = self._generation(spark)
        if now is None:
            raise FileNotFoundError(self.path)
        return now[0], self._versions(spark, now[2])

    def _summarise(self, spark: SparkSession, number: tuple[int, int]) -> None:
        """Adds the summary of the buckets written under ``number``, read from what was written."""
        generation, versions = self._newest(spark)
        written = {b: p for b, v in versions.items() for version, p in v if version == number[1]}
        parts = self._summary_of(spark, list(written.values())).withColumn("version", F.lit(number[1]).cast("bigint"))
        self.summary.append(parts.withColumn("number", F.lit(generation)), number)
        valid = [f"{b}:{v[0][0]}" for b, v in versions.items()]
        self.summary.merge(spark, lambda all_: all_.where(
            (F.col("number") == generation) & F.concat_ws(":", "bucket", "version").isin(valid)))

    def _summary_of(self, spark: SparkSession, folders: list[str]) -> DataFrame:
        rows = self._read(spark, folders).withColumn("bucket", F.regexp_extract(F.input_file_name(), "/bucket=([0-9]+)/", 1).cast("int"))
        return freshness_summary(rows, "bucket")

    def freshness(self, spark: SparkSession) -> DataFrame:
        """bucket, feature_name, entity_count, last_computed_at of the newest versions, from the summary."""
        generation, versions = self._newest(spark)
        valid = spark.createDataFrame([(generation, b, v[0][0]) for b, v in versions.items()], "number int, bucket int, version bigint")
        kept = self.summary.read(spark).join(F.broadcast(valid), ["number", "bucket", "version"])  # a row per bucket
        there = {r["bucket"] for r in kept.select("bucket").distinct().collect()}  # at most the buckets
        missing = self._summary_of(spark, [v[0][1] for b, v in versions.items() if b not in there])
        columns = ["bucket", "feature_name", "entity_count", "last_computed_at"]
        return kept.select(*columns).unionByName(missing.select(*columns))

    def entities_with(self, spark: SparkSession, feature_name: str) -> DataFrame:
        """entity_id of all entities that have the feature, from the index alone."""
        part = spark.range(1).select(self._part(F.lit(feature_name))).first()[0]
        return (self.index.read(spark).where((F.col("part") == part) & (F.col("feature_name") == feature_name))
                .select("entity_id").distinct())

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.select(*self.COLS).where(F.col("entity_id").isNotNull())
        now = self._generation(spark)
        if now is None:
            buckets = self.buckets or max(1, -(-rows.count() // self.rows_per_bucket))
            self._index(rows, self._read(spark, []), (0, 0))
            self._write(rows, f"{self.path}/gen=0-{buckets}", buckets, 0)
            self._summarise(spark, (0, 0))
            return
        number, buckets, folder = now
        versions = self._versions(spark, folder)
        touched = [r[0] for r in rows.select(self._bucket(buckets).alias("b")).distinct().collect()]  # at most the buckets
        old = self._read(spark, [versions[b][0][1] for b in touched if b in versions])
        newest = max((v[0][0] for v in versions.values()), default=-1)
        self._index(rows, old, (number, newest + 1))
        self._write(old.unionByName(rows), folder, buckets, newest + 1)
        self._summarise(spark, (number, newest + 1))
        for some in self._versions(spark, folder).values():
            for _, p in some[2:]:
                remove_path(spark, p)
        if self.buckets is None and content_bytes(spark, folder) > 8 * buckets * self.bucket_bytes:  # two versions each
            more = 4 * buckets
            self._write(self.current(spark).select(*self.COLS), f"{self.path}/gen={number + 1}-{more}", more, 0)
            self._summarise(spark, (number + 1, 0))
            remove_path(spark, folder)

    def current(self, spark: SparkSession) -> DataFrame:
        now = self._generation(spark)
        if now is None:
            raise FileNotFoundError(self.path)
        return self._read(spark, [v[0][1] for v in self._versions(spark, now[2]).values()])

    def lookup(self, spark: SparkSession, entity_id: str) -> DataFrame:
        """Point lookup: reads the newest version of one bucket."""
        now = self._generation(spark)
        if now is None:
            raise FileNotFoundError(self.path)
        bucket = spark.range(1).select(F.pmod(F.hash(F.lit(entity_id)), F.lit(now[1]))).first()[0]
        found = self._versions(spark, now[2], str(bucket)).get(bucket, [])
        return self._read(spark, [p for _, p in found[:1]]).where(F.col("entity_id") == entity_id)
