"""Late-event classification for replays (exact, per record, no global sort).

Rule (same as a window operator with zero allowed lateness): the watermark a
record meets is ``max(ts of all records that arrived before it) - delay``;
the record is late when the *last* window it belongs to has already closed,
i.e. ``last_window_end <= watermark``.  For windows of size S sliding by L
(tumbling: L = S) the last window end is ``floor(ts / L) * L + S``.

Computing a running max over the arrival order would need one global sort.
Instead we invert the question: a record r is late iff some record p that
arrived earlier has ``ts_p >= last_end(r) + delay``.  Thresholds
``m*L + S + delay`` sit on a grid, so with

    b(p) = floor((ts_p - S - delay) / L)        (bucket of p)
    m(r) = floor(ts_r / L)                      (grid index of r's threshold)

r is late iff ``first_arrival(b >= m(r)) < arrival(r)``, where
``first_arrival(k)`` is the earliest arrival key among records in bucket k.
That is:

1. one aggregate: earliest arrival key per (geometry, bucket) — combined
   map-side, one row per bucket;
2. a suffix minimum over the bucket keys (size bounded by time span / L,
   not by data volume), computed in two levels so no window group exceeds
   ``_BLOCK`` keys;
3. an equi-join of every record to that small table on (geometry, m), and
   one comparison.

Every record is classified; several window geometries and watermark delays
are handled in the same two scans.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dwellspark.functions.expressions import packed_order
from dwellspark.operators.enrich import DEFAULT_BROADCAST_MAX_ROWS, checked_broadcast
from dwellspark.session import cut_lineage

_BLOCK = 4096
_US = 1_000_000


@dataclass(frozen=True)
class Geometry:
    """A window family and watermark delay to classify against."""

    name: str
    size_s: int
    slide_s: int
    delay_s: int


def _floor_div(x, d: int):
    """Exact floor(x / d) for BIGINT x and positive constant d (integer division)."""
    return F.call_function("div", x - F.pmod(x, F.lit(d)), F.lit(d))


def _ts_us(col: str = "ts"):
    return F.unix_micros(F.col(col).cast("timestamp"))


def arrival_key(arrival_col: str = "arrival_ts", id_col: str = "event_id"):
    """(arrival_ts, event_id) packed into one order-preserving DECIMAL(38,0).

    Lexicographic order on the pair equals numeric order on the result, and
    a fixed-width key keeps ``min`` in a hash aggregate.
    """
    return packed_order(_ts_us(arrival_col), F.col(id_col))


def _geometry_array(geoms: list[Geometry], key_fn) -> F.Column:
    return F.array(*[F.struct(F.lit(g.name).alias("geom"), key_fn(g).alias("k"))
                     for g in geoms])


def _suffix_min(keys: DataFrame) -> DataFrame:
    """(geom, k, first) → (geom, k, sm) with sm(k) = min(first over k' >= k).

    Two levels: inside blocks of _BLOCK consecutive keys a window running
    min (and the block's own min, same partitioning); across blocks an
    exclusive suffix min over one row per block, broadcast back.  The key
    table (bounded by time span / slide) is checkpointed, so the events are
    scanned once for both levels, and so is the result, which the caller
    counts and joins; nothing is cached by path.
    """
    blk = cut_lineage(keys).withColumn("blk", _floor_div(F.col("k"), _BLOCK))
    part = Window.partitionBy("geom", "blk")
    w_in = part.orderBy(F.col("k").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = (blk.withColumn("sm_in", F.min("first").over(w_in))
             .withColumn("blk_first", F.min("first").over(part)))
    per_blk = inner.groupBy("geom", "blk").agg(F.min("blk_first").alias("blk_first"))
    w_out = (Window.partitionBy("geom").orderBy(F.col("blk").desc())
             .rowsBetween(Window.unboundedPreceding, -1))
    # one row per block: bounded by time span / (slide * _BLOCK)
    outer = per_blk.withColumn("sm_out", F.min("blk_first").over(w_out)).select("geom", "blk", "sm_out")
    return cut_lineage(inner.join(F.broadcast(outer), ["geom", "blk"], "left")
                       .select("geom", "k", F.least(F.col("sm_in"), F.col("sm_out")).alias("sm")))


def grid_index(ts_col, g: Geometry):
    """Index of the grid point ``floor(ts / slide)`` (a window start / slide)."""
    return _floor_div(F.unix_micros(ts_col.cast("timestamp")), g.slide_s * _US)


def threshold_table(events: DataFrame, geoms: list[Geometry]) -> DataFrame:
    """(geom, k, sm): the first arrival among records with ts >= k*L + S + delay.

    ``sm`` is also when a window starting at ``k*L`` is closed (the arrival
    of the record that advances the watermark past its end).  Bounded by
    time span / slide; checkpointed because the size check and the joins read
    it several times.
    """
    arrival = arrival_key()
    ts_us = _ts_us()
    no_key = F.lit(None).cast("decimal(38,0)")

    # one scan, one aggregate: per (geometry, key) the earliest arrival of a
    # record in threshold bucket `key`, plus a null entry for every grid index
    # a record will ask about (so the lookup below is an equi-join).
    entries = []
    for g in geoms:
        entries.append(F.struct(F.lit(g.name).alias("geom"),
                                _floor_div(ts_us - F.lit((g.size_s + g.delay_s) * _US),
                                           g.slide_s * _US).alias("k"),
                                arrival.alias("first")))
        entries.append(F.struct(F.lit(g.name).alias("geom"),
                                _floor_div(ts_us, g.slide_s * _US).alias("k"),
                                no_key.alias("first")))
    keys = (events.select(F.explode(F.array(*entries)).alias("e"))
            .groupBy(F.col("e.geom").alias("geom"), F.col("e.k").alias("k"))
            .agg(F.min("e.first").alias("first")))
    return _suffix_min(keys)


def classify(events: DataFrame, geoms: list[Geometry], broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
             thresholds: DataFrame | None = None) -> DataFrame:
    """Tag every (record, geometry) pair with ``is_late``.

    ``events`` needs ``event_id``, ``ts`` and ``arrival_ts``; all its columns
    are carried through.  Output has one row per record and geometry with
    ``geom``, ``window_start``/``window_end`` of the record's last window and
    ``is_late``.
    """
    arrival = arrival_key()
    ts_us = _ts_us()
    sm = thresholds if thresholds is not None else threshold_table(events, geoms)

    # 3. classify each record
    per_geom = events.withColumn("gm", F.explode(_geometry_array(
        geoms, lambda g: _floor_div(ts_us, g.slide_s * _US))))
    size_by_geom = F.create_map(*[x for g in geoms for x in (F.lit(g.name), F.lit(g.size_s).cast("bigint"))])
    slide_by_geom = F.create_map(*[x for g in geoms for x in (F.lit(g.name), F.lit(g.slide_s).cast("bigint"))])
    per_geom = per_geom.select(
        "*", F.col("gm.geom").alias("geom"), F.col("gm.k").alias("k")).drop("gm")
    last_start_us = F.col("k") * slide_by_geom[F.col("geom")] * F.lit(_US)
    out = (per_geom.join(checked_broadcast(sm, broadcast_max_rows), ["geom", "k"], "left")
           .withColumn("is_late", F.coalesce(F.col("sm") < arrival, F.lit(False)))
           .withColumn("window_start", F.timestamp_micros(last_start_us).cast(events.schema["ts"].dataType))
           .withColumn("window_end", F.timestamp_micros(
               last_start_us + size_by_geom[F.col("geom")] * F.lit(_US)).cast(events.schema["ts"].dataType))
           .drop("k", "sm"))
    return out


def late_flags(events: DataFrame, geoms: list[Geometry],
               broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> tuple[DataFrame, dict[str, str]]:
    """Late flags for many geometries with one row per (record, slide grid).

    Geometries that share a slide share the grid index a record asks about,
    so the threshold table is widened to one row per (slide, k) with a
    column per geometry, and each record is joined once per distinct slide
    instead of once per geometry.  Returns the frame (``events`` columns plus
    one boolean per geometry, false on rows of another slide) and the map
    geometry name → flag column.  Summing a flag counts each record once.
    """
    sm = threshold_table(events, geoms)
    flag_cols = {g.name: f"late__{i}" for i, g in enumerate(geoms)}
    slide_of = F.create_map(*[x for g in geoms for x in (F.lit(g.name), F.lit(g.slide_s).cast("bigint"))])
    wide = (sm.withColumn("slide", slide_of[F.col("geom")])
            .groupBy("slide", "k")
            .agg(*[F.max(F.when(F.col("geom") == g.name, F.col("sm"))).alias(f"sm__{i}")
                   for i, g in enumerate(geoms)]))
    wide = checked_broadcast(wide, broadcast_max_rows)
    ts_us = _ts_us()
    slides = sorted({g.slide_s for g in geoms})
    grid = F.explode(F.array(*[F.struct(F.lit(sl).cast("bigint").alias("slide"),
                                         _floor_div(ts_us, sl * _US).alias("k")) for sl in slides]))
    rows = events.withColumn("_g", grid).select("*", "_g.slide", "_g.k").drop("_g")
    joined = rows.join(wide, ["slide", "k"], "left")
    arrival = arrival_key()
    out = joined.select(*events.columns, *[
        F.coalesce(F.col(f"sm__{i}") < arrival, F.lit(False)).alias(flag_cols[g.name])
        for i, g in enumerate(geoms)])
    return out, flag_cols


def late_events(events: DataFrame, size_s: int = 3600, slide_s: int | None = None,
                delay_s: int = 30) -> DataFrame:
    """Records that a window family of the given geometry would drop as late."""
    g = Geometry("w", size_s, slide_s or size_s, delay_s)
    return classify(events, [g]).where(F.col("is_late")).drop("geom", "is_late")


def on_time_events(events: DataFrame, size_s: int = 3600, slide_s: int | None = None,
                   delay_s: int = 30) -> DataFrame:
    """The complement of :func:`late_events` (what the stream aggregates)."""
    g = Geometry("w", size_s, slide_s or size_s, delay_s)
    return (classify(events, [g]).where(~F.col("is_late"))
            .drop("geom", "is_late", "window_start", "window_end"))
