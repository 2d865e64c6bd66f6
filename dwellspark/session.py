"""Session construction and shared-storage helpers.

Everything that must outlive a task (checkpoints, streaming state, scratch
tables written to cut lineage) goes under the folder the cluster names in
``spark.checkpoint.dir``.  Only when that is unset (local tests, the bench)
do we create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session of ours wants; cluster deployments may override
# partition counts, but the time zone and AQE settings are part of the
# semantics (windows are UTC-aligned; skew handling relies on AQE).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # A late row must be dropped in the very micro-batch whose watermark
    # closes its window (reference parity); see streaming/job.py.
    "spark.sql.streaming.statefulOperator.allowMultiple": "false",
}


def build_session(master: str | None = None, app_name: str = "dwellspark",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Set the semantic SQL confs on an existing session (e.g. the driver's)."""
    for k in ("spark.sql.session.timeZone",
              "spark.sql.streaming.statefulOperator.allowMultiple"):
        if spark.conf.get(k, None) != BASE_CONF[k]:
            spark.conf.set(k, BASE_CONF[k])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    Where none is configured a local one is made, on a local master only: on a
    cluster the executors could not see it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="dwellspark-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint dir (never reused)."""
    base = ensure_checkpoint_dir(spark)
    sep = "" if base.endswith("/") else "/"
    return f"{base}{sep}{name}-{uuid.uuid4().hex[:12]}"


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_path(spark, path)
    return fs.exists(p)


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, on any file system of the cluster."""
    fs, p = _hadoop_path(spark, pattern)
    return [str(x.getPath()) for x in fs.globStatus(p) or []]


def content_bytes(spark: SparkSession, path: str) -> int:
    fs, p = _hadoop_path(spark, path)
    return fs.getContentSummary(p).getLength()


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder of ours (replay input, superseded versions)."""
    fs, p = _hadoop_path(spark, path)
    fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file of ours, written over an older one of its name."""
    fs, p = _hadoop_path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared dir (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
