"""How late events are: the least watermark delay that each one needs.

``late.py`` answers whether a record is late under given delays.  Here the
running maximum of event time over the arrival order gives every record its
lateness,

    lateness = max(ts of all earlier arrivals) - end of the record's last window,

and the record is late under a delay iff ``lateness >= delay``.  One histogram of
the lateness in whole seconds therefore answers every delay of whole seconds
exactly, without a second pass over the events: the trade-off between waiting and
dropping can be read off for any delay.

Cost: one range shuffle of the columns that are needed, written once.  The
histogram has at most a row per family and second of the time span.

Records without a time, an arrival or an id have no place in the order and no
lateness; they are left out, as the window operator and ``late.py`` do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dwellspark.operators.late import Geometry, grid_index
from dwellspark.operators.ordered import running_max

_US = 1_000_000


def lateness(events: DataFrame, geoms: list[Geometry]) -> DataFrame:
    """One row per record and geometry: the columns of ``events``, ``geom`` and ``lateness_us`` (null: nothing came before).

    ``delay_s`` of the geometries is not used.
    """
    placed = events.where("ts IS NOT NULL AND arrival_ts IS NOT NULL AND event_id IS NOT NULL")
    placed = placed.withColumn("_us", F.unix_micros(F.col("ts").cast("timestamp")))
    seen = running_max(placed, ("arrival_ts", "event_id"), "_us", "_before_us")
    per_geom = [F.struct(F.lit(g.name).alias("geom"),
                         (F.col("_before_us") - (grid_index(F.col("ts"), g) * g.slide_s + g.size_s) * _US).alias("lateness_us"))
                for g in geoms]
    rows = seen.withColumn("_g", F.explode(F.array(*per_geom)))
    return rows.select(*events.columns, "_g.geom", "_g.lateness_us")


def lateness_histogram(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """geom, ``by``, lateness_s, n of the records that a delay of 0 s would drop."""
    whole = F.call_function("div", F.col("lateness_us"), F.lit(_US))  # not negative, so this is the floor
    return (rows.where("lateness_us >= 0").groupBy("geom", *by, whole.alias("lateness_s"))
            .agg(F.count(F.lit(1)).alias("n")))


def late_counts(histogram: DataFrame, delays: Sequence[int], by: Sequence[str] = ("geom",)) -> DataFrame:
    """``by``, delay_s, late_count for any delays, from the histogram alone."""
    sums = histogram.groupBy(*by).agg(*[F.sum(F.when(F.col("lateness_s") >= d, F.col("n")).otherwise(0)).alias(f"_{d}") for d in delays])
    counts = F.explode(F.array(*[F.struct(F.lit(d).alias("delay_s"), F.col(f"_{d}").alias("late_count")) for d in delays]))
    return sums.select(*by, counts.alias("_c")).select(*by, "_c.*")


def least_delay(histogram: DataFrame, shares: Sequence[float], total: DataFrame) -> DataFrame:
    """geom, share, delay_s: the least delay in whole seconds that drops at most ``share`` of all records.

    ``total`` is (geom, n) over all records.  A running sum over a geometry's
    histogram, which is bounded by the time span and not by the records.
    """
    above = Window.partitionBy("geom").orderBy(F.desc("lateness_s")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per = histogram.groupBy("geom", "lateness_s").agg(F.sum("n").alias("n"))
    dropped = per.withColumn("dropped", F.sum("n").over(above)).join(total.select("geom", F.col("n").alias("all")), "geom")
    # a delay of lateness_s still drops the records of that lateness; one second more does not
    need = [F.coalesce(F.max(F.when(F.col("dropped") > F.lit(s) * F.col("all"), F.col("lateness_s") + 1)), F.lit(0)).alias(f"_{k}")
            for k, s in enumerate(shares)]
    wide = dropped.groupBy("geom").agg(*need)
    rows = F.explode(F.array(*[F.struct(F.lit(s).alias("share"), F.col(f"_{k}").cast("bigint").alias("delay_s")) for k, s in enumerate(shares)]))
    found = wide.select("geom", rows.alias("_r")).select("geom", "_r.*")
    none = total.join(histogram, "geom", "left_anti").select(
        "geom", F.explode(F.array(*[F.lit(s) for s in shares])).alias("share"), F.lit(0).cast("bigint").alias("delay_s"))
    return found.unionByName(none)
