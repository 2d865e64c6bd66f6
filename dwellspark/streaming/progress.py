"""Progress of the streaming queries as metric rows: true watermark lag, drops, state size.

A listener on the session takes every micro-batch's progress report and writes one
small JSON file per query and batch, named by both, so a batch reported again
replaces its file.  No Spark job is started for it.  The newest ``keep`` reports of
a query stay (default 1000), which bounds the folder however long the query runs.
"""

from __future__ import annotations

import json
import re
import threading

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from dwellspark.functions.expressions import epoch_millis
from dwellspark.operators.serving import LAG_WARNING_MS
from dwellspark.session import list_paths, remove_path, write_text

PROGRESS_METRIC = "watermark_lag"
DDL = ("metric_type string, query string, batch_id bigint, recorded_at timestamp, watermark timestamp, max_event_time timestamp, "
       "input_rows bigint, rows_dropped bigint, state_rows bigint, state_bytes bigint")


def progress_row(report: dict) -> dict:
    """The metric row of one progress report; a watermark that has not begun is left out."""
    times, states = report.get("eventTime") or {}, report.get("stateOperators") or []
    mark = times.get("watermark")
    return {"metric_type": PROGRESS_METRIC, "query": report.get("name") or report["id"], "batch_id": report["batchId"],
            "recorded_at": report["timestamp"], "watermark": None if (mark or "").startswith("1970-01-01T00:00:00") else mark,
            "max_event_time": times.get("max"), "input_rows": report.get("numInputRows") or 0,
            "rows_dropped": sum(s.get("numRowsDroppedByWatermark") or 0 for s in states),
            "state_rows": sum(s.get("numRowsTotal") or 0 for s in states),
            "state_bytes": sum(s.get("memoryUsedBytes") or 0 for s in states)}


class ProgressMetrics(StreamingQueryListener):
    """Writes the progress of all queries whose name fits ``names`` (a pattern; all by default) below ``path``."""

    def __init__(self, spark: SparkSession, path: str, names: str = "", keep: int = 1000):
        self.spark, self.path, self.names, self.keep = spark, path, re.compile(names), keep
        self.ended: dict[str, threading.Event] = {}
        self.failed: list[str] = []

    def _end(self, run_id: str) -> threading.Event:
        return self.ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        try:
            self.record(json.loads(event.progress.json))
        except Exception as error:  # a report that cannot be written must not stop the stream; it is told by `failed`
            self.failed.append(repr(error))

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def record(self, report: dict) -> None:
        row = progress_row(report)
        if not self.names.search(row["query"]):
            return
        folder = f"{self.path}/query={re.sub('[^A-Za-z0-9_.-]', '_', row['query'])}"
        write_text(self.spark, f"{folder}/{row['batch_id']:012d}.json", json.dumps(row) + "\n")
        if row["batch_id"] % max(1, self.keep // 10) == 0:
            for old in sorted(list_paths(self.spark, f"{folder}/*.json"))[:-self.keep]:
                remove_path(self.spark, old)

    def wait(self, query, timeout_s: float = 60.0) -> bool:
        """Whether the reports of an ended query are all in (they come on a thread of their own)."""
        return self._end(str(query.runId)).wait(timeout_s)


def progress_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The metric rows below ``path`` with ``watermark_lag_ms`` (processing time less watermark; -1 before the first)."""
    files = list_paths(spark, f"{path}/query=*/*.json")
    rows = spark.read.schema(DDL).json([f"{path}/query=*/*.json"]) if files else spark.createDataFrame([], DDL)
    lag = epoch_millis(F.col("recorded_at")) - epoch_millis(F.col("watermark"))
    return rows.withColumn("watermark_lag_ms", F.coalesce(lag, F.lit(-1)).cast("bigint"))


def latest_progress(metrics: DataFrame) -> DataFrame:
    """Per query the newest row, its drops over all reports, and whether the lag calls for a warning."""
    by = Window.partitionBy("query")
    newest = (metrics.withColumn("total_dropped", F.sum("rows_dropped").over(by))
              .withColumn("_k", F.row_number().over(by.orderBy(F.desc("batch_id")))).where("_k = 1").drop("_k"))
    return newest.withColumn("lag_warning", F.col("watermark_lag_ms") > LAG_WARNING_MS)
