from datetime import datetime

from pyspark.sql import functions as F

EVENT_DDL = "event_id bigint, user_id string, content_id string, event_type string, dwell_time_ms bigint, ts timestamp_ntz"


def t(hms: str, day: str = "2024-01-01") -> datetime:
    return datetime.fromisoformat(f"{day}T{hms}")


def events(spark, rows):
    """rows: (user_id, content_id, event_type, dwell, 'HH:MM:SS[.fff]') with ids assigned in order."""
    data = [(i, u, c, e, d, t(ts)) for i, (u, c, e, d, ts) in enumerate(rows)]
    return spark.createDataFrame(data, EVENT_DDL)


def with_arrival(df, arrivals):
    """arrivals: list of 'HH:MM:SS' per event_id (same order as rows)."""
    m = F.create_map(*[x for i, a in enumerate(arrivals)
                       for x in (F.lit(i).cast("bigint"), F.lit(f"2024-01-01 {a}").cast("timestamp_ntz"))])
    return df.withColumn("arrival_ts", m[F.col("event_id")])
