"""All feature windows and their late events from one stateful query.

Each event becomes one entry per family (user, content, and affinity where its content
has a category).  Entries are dealt to ``buckets`` groups per family, and a group's state
holds the sums of all its open windows, so a micro-batch costs one vectorised step per
bucket, not one per entity.  For a micro-batch with watermark W an entry is added to its
windows with ``end > W``; an entry that has none left is emitted as a late event.
Windows with ``end <= W`` are emitted and forgotten, by the entries that arrive or by an
event-time timer.  Windows and late events come from the same decision, so every entry is
counted in its windows or emitted late, however the trigger cuts the stream.

The entries of one entity go to ``salts`` buckets, so a hot entity is shared by several
tasks.  All parts of a window close in the same micro-batch, where ``merged`` adds them up.

The engine would drop entries below the watermark before a stateful function sees them,
by the column that carries the watermark.  The entries therefore carry a second
watermark on a column in the far future: the query's watermark is the lowest of both,
which is the events' own, and no entry is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from dwellspark.functions.expressions import type_match
from dwellspark.operators.features import _start
from dwellspark.spec import FeatureSpec, interval_seconds

SUMS = ["clicks", "views", "engagements", "dwell_sum", "event_count"]
KEYS = ["entity_id", "category", "start_us"]
STATE = "windows binary"  # a bucket's open windows, as one Arrow stream
PENDING_ROWS = 500_000  # entries held in a task before they are added up
CLOSED = ("kind string, family string, entity_id string, category string, start_us bigint, end_us bigint, "
          + ", ".join(f"{c} bigint" for c in SUMS)
          + ", user_id string, content_id string, event_type string, ts_us bigint, watermark_us bigint")
WINDOW, LATE = "window", "late"
FAR = "2260-01-01 00:00:00"  # within pandas' nanosecond times


def geometry(spec: FeatureSpec) -> dict[str, tuple[int, int]]:
    """(size, slide) of each family's windows in microseconds."""
    us = lambda text: interval_seconds(text) * 1_000_000
    return {"user": (us(spec.user_window), us(spec.user_window)), "content": (us(spec.content_window), us(spec.content_slide)),
            "affinity": (us(spec.affinity_window), us(spec.affinity_window))}


def entries(events: DataFrame, spec: FeatureSpec, families: tuple[str, ...]) -> DataFrame:
    """One row per event and family, under both watermarks (see above)."""
    kinds = {"is_click": spec.click_types, "is_view": spec.view_types, "is_eng": spec.engagement_types}
    ev = (events.withWatermark("ts", f"{spec.watermark_delay_s} seconds")
          .withColumn("far", F.lit(FAR).cast("timestamp")).withWatermark("far", "0 seconds"))
    ts_us = F.unix_micros("ts")
    slides = {f: slide for f, (_, slide) in geometry(spec).items()}
    entity = {"user": F.col("user_id"), "content": F.col("content_id"), "affinity": F.col("user_id")}
    category = {f: F.col("category") if f == "affinity" else F.lit(None).cast("string") for f in entity}

    def entry(family: str):
        e = F.struct(F.lit(family).alias("family"), entity[family].alias("entity_id"), category[family].alias("category"),
                     _start(ts_us, slides[family] // 1_000_000).alias("start_us"))
        return F.when(F.col("category").isNotNull(), e) if family == "affinity" else e

    flat = ev.select(
        F.explode(F.array(*[entry(f) for f in families])).alias("e"), "far", ts_us.alias("ts_us"), "user_id", "content_id", "event_type",
        F.coalesce(F.col("dwell_time_ms"), F.lit(0)).cast("bigint").alias("dwell"),
        *[F.coalesce(type_match(F.col("event_type"), types, spec.case_sensitive), F.lit(False)).cast("bigint").alias(c)
          for c, types in kinds.items()])
    return flat.where("e IS NOT NULL").select("e.*", "far", "ts_us", "user_id", "content_id", "event_type", "dwell", *kinds)


def _bucket(buckets: int, salts: int):
    entity = F.xxhash64("entity_id", "category")
    salt = F.pmod(F.xxhash64("user_id", "content_id", "ts_us"), F.lit(salts)) if salts > 1 else F.lit(0)
    return F.pmod(entity + salt * F.lit(buckets // salts), F.lit(buckets)).cast("int")


def _added(parts: list[pd.DataFrame], by: list[str]) -> pd.DataFrame:
    return pd.concat(parts).groupby(by, dropna=False, sort=False, as_index=False).sum()


def _packed(sums: pd.DataFrame) -> bytes:
    """Open windows as an Arrow stream: one value for the state store instead of a list per column."""
    texts = [c for c in KEYS[:2] if c in sums.columns]
    schema = pa.schema([(c, pa.string()) for c in texts] + [(c, pa.int64()) for c in ["start_us", *SUMS]])
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as to:
        to.write_table(pa.Table.from_pandas(sums, schema, preserve_index=False))
    return out.getvalue().to_pybytes()


def _unpacked(windows) -> pd.DataFrame:
    return pa.ipc.open_stream(bytes(windows)).read_all().to_pandas()


def merged(closed: DataFrame) -> DataFrame:
    """A micro-batch's rows with the parts of each window added up.

    One pass, so the stateful step above it runs once.  Late entries pass through the same
    aggregate: equal ones meet there and are told apart again by their count.
    """
    is_late = F.col("kind") == LATE
    keys = ["kind", "family", "entity_id", "category", "start_us", "end_us", "user_id", "content_id", "event_type", "ts_us"]
    sums = closed.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS], F.max("watermark_us").alias("watermark_us"))
    once = sums.withColumn("one", F.explode(F.array_repeat(F.lit(1), F.when(is_late, F.col("event_count").cast("int")).otherwise(1))))
    return once.withColumn("event_count", F.when(is_late, F.lit(1)).otherwise(F.col("event_count")).cast("bigint")).select(*COLUMNS)


def closed_windows(events: DataFrame, spec: FeatureSpec, families: tuple[str, ...] = ("user", "content", "affinity"),
                   buckets: int = 64, salts: int = 4) -> DataFrame:
    """Streaming rows of ``CLOSED``: the parts of each closed window (see ``merged``), and late entries.

    ``events`` is a stream without a watermark; ``category`` is needed for affinity.
    ``buckets`` is fixed at the query's first start: as many as keep the open windows of
    one bucket in a task's memory.
    """
    sizes = geometry(spec)

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        family = key[0]
        size, slide = sizes[family]
        by = KEYS if family == "affinity" else ["entity_id", "start_us"]  # the others have no category
        mark = state.getCurrentWatermarkMs() * 1000
        held = state.getOption
        fresh, pending, out = [], 0, []
        for rows in batches:
            if not len(rows):
                continue
            rows = rows.rename(columns={"is_click": "clicks", "is_view": "views", "is_eng": "engagements", "dwell": "dwell_sum"})
            late = (rows["start_us"] + size <= mark).to_numpy()  # its last window: no other ends later
            if late.any():
                gone = rows.loc[late, ["entity_id", "category", "start_us", "user_id", "content_id", "event_type", "ts_us"]]
                out.append(gone.assign(category=gone["category"].fillna(""), kind=LATE, event_count=1, **{c: 0 for c in SUMS[:-1]}))
                rows = rows[~late]
            fresh.append(rows[by + SUMS[:-1]].assign(event_count=1))
            pending += len(rows)
            if pending > PENDING_ROWS:
                fresh = [_added(fresh, by)]
                pending = 0
        parts = [] if held is None else [_unpacked(held[0])]
        if fresh:
            slides = _added(fresh, by)  # entries of one slide belong to the same windows
            for back in range(size // slide):
                some = slides.assign(start_us=slides["start_us"] - back * slide)
                parts.append(some[some["start_us"] + size > mark])
        sums = _added(parts, by) if len(parts) > 1 else parts[0] if parts else None
        if sums is not None:
            done = (sums["start_us"] + size <= mark).to_numpy()
            if done.any():
                closed = sums[done].assign(kind=WINDOW, user_id="", content_id="", event_type="", ts_us=0)
                out.append(closed if "category" in by else closed.assign(category=""))
                sums = sums[~done]
        if sums is not None and len(sums):
            state.update((_packed(sums),))
            state.setTimeoutTimestamp((int(sums["start_us"].min()) + size) // 1000 - 1)  # timers fire above their time, windows close at it
        elif state.exists:
            state.remove()
        for frame in out:
            yield frame.assign(family=family, end_us=frame["start_us"] + size, watermark_us=mark)[COLUMNS]

    dealt = entries(events, spec, families).withColumn("bucket", _bucket(buckets, min(salts, buckets)))
    rows = dealt.groupBy("family", "bucket").applyInPandasWithState(
        advance, CLOSED, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    # what a row has not got travels as 0 or "" and is null from here on
    is_late = F.col("kind") == LATE
    there = {c: ~is_late for c in SUMS[:-1]} | {c: is_late for c in ("user_id", "content_id", "event_type", "ts_us")}
    there["category"] = F.col("family") == "affinity"
    return rows.select(*[F.when(there[c], F.col(c)).alias(c) if c in there else F.col(c) for c in COLUMNS])


COLUMNS = [c.split()[0] for c in CLOSED.split(", ")]


def feature_values(closed: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Long feature rows of closed windows (two per user window), without ``computed_at``."""
    family, n = F.col("family"), F.col("event_count")
    none = F.lit(None).cast("bigint")
    pair = lambda name, value, whole=none: F.struct(name.alias("n"), value.cast("double").alias("v"), whole.alias("i"))
    rate = F.when(F.col("views") > 0, F.col("engagements") / F.col("views")).otherwise(F.lit(0.0))
    values = (F.when(family == "user", F.array(pair(F.lit("click_rate"), F.col("clicks") / n),
                                               pair(F.lit("avg_dwell_time"), F.col("dwell_sum") / n)))
              .when(family == "content", F.array(pair(F.lit("engagement_rate"), rate)))
              .otherwise(F.array(pair(F.concat(F.lit(spec.affinity_prefix), F.col("category")), n, n))))
    time = lambda c: F.timestamp_micros(F.col(c)).cast("timestamp_ntz")
    return closed.where(F.col("kind") == WINDOW).select(
        "family", "entity_id", time("start_us").alias("window_start"), time("end_us").alias("window_end"),
        F.posexplode(values).alias("feature_no", "f")).select(
        "family", "entity_id", F.col("f.n").alias("feature_name"), F.col("f.v").alias("feature_value"),
        F.col("f.i").alias("feature_value_int"), "window_start", "window_end", "feature_no")
