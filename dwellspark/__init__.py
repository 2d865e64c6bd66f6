"""dwellspark — a Spark-native behavioural feature engine.

Click-stream events become windowed features (click rate, dwell time,
engagement rate, category affinity) with the same DataFrame functions on
batch tables and on Structured Streaming, plus late-event auditing, a
latest-value feature table, freshness and pipeline-health metrics, and a
batch-versus-stream divergence report.
"""

from dwellspark.spec import FeatureSpec, DRIVER_SPEC, WIRE_SPEC

__all__ = ["FeatureSpec", "DRIVER_SPEC", "WIRE_SPEC"]
