"""Property test: the distributed metric fold equals a sequential fold."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dwellspark.operators import metrics

record = st.one_of(
    st.tuples(st.just("late_event_dropped"), st.one_of(st.none(), st.integers(0, 50)), st.none()),
    st.tuples(st.just("watermark_heartbeat"), st.none(), st.one_of(st.none(), st.integers(0, 50))),
    st.tuples(st.just("other"), st.integers(0, 50), st.integers(0, 50)),
)


def sequential(records):
    total = 0
    for kind, count, late_total in records:
        if kind == "late_event_dropped":
            total = count if count is not None else total + 1
        elif kind == "watermark_heartbeat" and late_total is not None:
            total = late_total
    return total


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(record, min_size=0, max_size=12))
def test_fold_matches_sequential(spark, records):
    rows = [(i, k, c, t) for i, (k, c, t) in enumerate(records)]
    df = spark.createDataFrame(rows, "metric_offset bigint, metric_type string, count bigint, late_events_total bigint")
    df = df.withColumn("feature_computed_at", F.lit(None).cast("timestamp_ntz"))
    got = metrics.fold_metrics(df, "2024-01-01 00:00:00").collect()[0]["late_events_dropped"]
    assert got == sequential(records)
