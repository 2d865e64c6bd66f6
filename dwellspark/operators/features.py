"""Windowed feature aggregates — pure DataFrame → DataFrame.

The same functions run on a batch DataFrame and on a streaming one (after
``withWatermark``).  Every aggregate is algebraic (conditional counts and
sums), so Spark plans partial aggregation before the shuffle: a map task
emits at most one row per (key, window) it saw, which keeps hot users or
contents from concentrating raw rows in one reducer.  Rates are a single
division of exact integers, so batch, stream and any SQL engine agree
bit for bit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellspark.functions.expressions import count_where, type_match
from dwellspark.spec import FeatureSpec, interval_seconds


def _bounds(window_col: str = "window"):
    return [F.col(f"{window_col}.start").alias("window_start"),
            F.col(f"{window_col}.end").alias("window_end")]


def user_hourly_features(events: DataFrame, spec: FeatureSpec) -> DataFrame:
    """click_rate and avg_dwell_time per (user, tumbling window).

    avg_dwell_time counts a missing dwell as 0 in the sum and 1 in the
    count (sum/count, not ``avg``, which would skip nulls).
    """
    is_click = type_match(F.col("event_type"), spec.click_types, spec.case_sensitive)
    agg = (events
           .groupBy(F.window("ts", spec.user_window).alias("window"), F.col("user_id"))
           .agg(count_where(is_click).alias("clicks"),
                F.sum(F.coalesce(F.col("dwell_time_ms"), F.lit(0))).alias("dwell_sum"),
                F.count(F.lit(1)).alias("event_count")))
    return agg.select(
        "user_id", *_bounds(),
        (F.col("clicks") / F.col("event_count")).alias("click_rate"),
        (F.col("dwell_sum") / F.col("event_count")).alias("avg_dwell_time"),
        F.col("event_count"))


def content_engagement(events: DataFrame, spec: FeatureSpec,
                       sliding: bool = True, strategy: str = "native") -> DataFrame:
    """engagement_rate = engagements / views per (content, window); 0.0 without views.

    ``sliding=True`` is the streaming geometry (15 min windows every 5 min,
    each event in three windows); ``sliding=False`` the batch job's fixed
    15-minute buckets.

    ``strategy`` (batch, sliding only): ``"native"`` lets ``window()`` expand
    every event into its three windows before the partial aggregate (one
    shuffle); ``"panes"`` first aggregates slide-sized panes, then fans each
    pane row out to its windows (a second, smaller shuffle, but a third of
    the map-side expansion) — the better plan when contents receive many
    events per pane.  Both give identical rows.
    """
    is_view = type_match(F.col("event_type"), spec.view_types, spec.case_sensitive)
    is_eng = type_match(F.col("event_type"), spec.engagement_types, spec.case_sensitive)
    if sliding and strategy == "panes":
        return _content_engagement_panes(events, spec, is_view, is_eng)
    if sliding:
        win = F.window("ts", spec.content_window, spec.content_slide)
    else:
        win = F.window("ts", spec.content_window)
    agg = (events
           .groupBy(win.alias("window"), F.col("content_id"))
           .agg(count_where(is_view).alias("view_count"),
                count_where(is_eng).alias("engagement_count"),
                F.count(F.lit(1)).alias("event_count")))
    rate = (F.when(F.col("view_count") > 0,
                   F.col("engagement_count") / F.col("view_count"))
             .otherwise(F.lit(0.0)))
    return agg.select("content_id", *_bounds(), rate.alias("engagement_rate"),
                      "view_count", "engagement_count", "event_count")


def _content_engagement_panes(events: DataFrame, spec: FeatureSpec, is_view, is_eng) -> DataFrame:
    size_s, slide_s = interval_seconds(spec.content_window), interval_seconds(spec.content_slide)
    if size_s % slide_s:
        raise ValueError("pane strategy needs the window size to be a multiple of the slide")
    panes = (events.groupBy(F.window("ts", spec.content_slide).start.alias("pane_start"), F.col("content_id"))
             .agg(count_where(is_view).alias("v"), count_where(is_eng).alias("e"),
                  F.count(F.lit(1)).alias("n")))
    back = F.explode(F.array(*[F.lit(i * slide_s) for i in range(size_s // slide_s)]))
    fanned = panes.select("content_id", "v", "e", "n", "pane_start", back.alias("back_s"))
    start = F.col("pane_start") - F.make_interval(secs=F.col("back_s"))
    agg = (fanned.groupBy(start.alias("window_start"), F.col("content_id"))
           .agg(F.sum("v").cast("bigint").alias("view_count"),
                F.sum("e").cast("bigint").alias("engagement_count"),
                F.sum("n").cast("bigint").alias("event_count")))
    rate = (F.when(F.col("view_count") > 0, F.col("engagement_count") / F.col("view_count"))
             .otherwise(F.lit(0.0)))
    return agg.select("content_id", "window_start",
                      (F.col("window_start") + F.make_interval(secs=F.lit(size_s))).alias("window_end"),
                      rate.alias("engagement_rate"), "view_count", "engagement_count", "event_count")


def category_affinity(enriched: DataFrame, spec: FeatureSpec,
                      keep_unmatched: bool) -> DataFrame:
    """Event count per (user, window, category) as ``category_affinity_<c>``.

    ``keep_unmatched=False`` is the streaming rule (events without metadata
    are filtered out); ``True`` is the batch rule (they count under
    ``unknown``).
    """
    if keep_unmatched:
        src = enriched.withColumn(
            "category", F.coalesce(F.col("category"), F.lit(spec.unknown_category)))
    else:
        src = enriched.where(F.col("category").isNotNull())
    agg = (src
           .groupBy(F.window("ts", spec.affinity_window).alias("window"),
                    F.col("user_id"), F.col("category"))
           .agg(F.count(F.lit(1)).alias("category_affinity_score")))
    return agg.select(
        "user_id", *_bounds(), "category", "category_affinity_score",
        F.concat(F.lit(spec.affinity_prefix), F.col("category")).alias("feature_name"))


# ---------------------------------------------------------------- long format

def _computed_at(spec: FeatureSpec):
    # A window is emitted when the watermark passes its end; in replays the
    # emission time is end + watermark delay.
    return (F.col("window_end") + F.make_interval(secs=F.lit(spec.watermark_delay_s))).alias("computed_at")


def _long_row(entity_col: str, name, value, spec: FeatureSpec,
              int_value=None) -> list:
    cols = [F.col(entity_col).alias("entity_id"),
            (name if not isinstance(name, str) else F.lit(name)).alias("feature_name"),
            value.cast("double").alias("feature_value"),
            F.col("window_start"), F.col("window_end"), _computed_at(spec),
            (int_value.cast("bigint") if int_value is not None
             else F.lit(None).cast("bigint")).alias("feature_value_int")]
    return cols


def user_feature_rows(user_feats: DataFrame, spec: FeatureSpec) -> DataFrame:
    """One window result → two feature rows (click_rate, avg_dwell_time).

    A single aggregate followed by a generator (no union of two projections,
    which Catalyst would prune into two separate aggregations).  A filter on
    entity_id still pushes below the generator: it only references the
    pass-through column.
    """
    pairs = F.explode(F.array(
        F.struct(F.lit("click_rate").alias("n"), F.col("click_rate").cast("double").alias("v")),
        F.struct(F.lit("avg_dwell_time").alias("n"), F.col("avg_dwell_time").cast("double").alias("v"))))
    exploded = user_feats.select(F.col("user_id").alias("entity_id"), "window_start", "window_end",
                                 pairs.alias("p"))
    return exploded.select(
        "entity_id", F.col("p.n").alias("feature_name"), F.col("p.v").alias("feature_value"),
        "window_start", "window_end", _computed_at(spec),
        F.lit(None).cast("bigint").alias("feature_value_int"))


def content_feature_rows(content_feats: DataFrame, spec: FeatureSpec) -> DataFrame:
    return content_feats.select(
        *_long_row("content_id", "engagement_rate", F.col("engagement_rate"), spec))


def affinity_feature_rows(affinity: DataFrame, spec: FeatureSpec) -> DataFrame:
    return affinity.select(
        *_long_row("user_id", F.col("feature_name"), F.col("category_affinity_score"),
                   spec, int_value=F.col("category_affinity_score")))


def all_feature_rows(events: DataFrame, enriched: DataFrame, spec: FeatureSpec) -> DataFrame:
    """The three feature families unioned into one long table (one sink)."""
    return (user_feature_rows(user_hourly_features(events, spec), spec)
            .unionByName(content_feature_rows(content_engagement(events, spec, sliding=True), spec))
            .unionByName(affinity_feature_rows(category_affinity(enriched, spec, keep_unmatched=False), spec)))


def _start(ts_us, size_s: int, back: int = 0):
    """Epoch-aligned window start (same alignment as ``window()``), ``back`` slides earlier."""
    size_us = size_s * 1_000_000
    return ts_us - F.pmod(ts_us, F.lit(size_us)) - F.lit(back * size_us)


def all_feature_rows_one_pass(enriched: DataFrame, spec: FeatureSpec) -> DataFrame:
    """The three feature families from ONE scan and ONE aggregate.

    Each event is expanded into family-tagged window keys — one user
    window, ``size/slide`` content windows, one affinity window when it has
    a category — and all are aggregated together on (family, entity,
    category, window).  Compared with three separate aggregations this reads
    the events once and shuffles once; partial aggregation still combines
    map-side.  ``enriched`` is the left-enriched event stream (category null
    when unmatched).  Results equal :func:`all_feature_rows`.
    """
    user_s, aff_s = interval_seconds(spec.user_window), interval_seconds(spec.affinity_window)
    c_size, c_slide = interval_seconds(spec.content_window), interval_seconds(spec.content_slide)
    if c_size % c_slide:
        raise ValueError("content window must be a multiple of its slide")
    ts_type = enriched.schema["ts"].dataType
    ts_us = F.unix_micros(F.col("ts").cast("timestamp"))
    is_click = type_match(F.col("event_type"), spec.click_types, spec.case_sensitive)
    is_view = type_match(F.col("event_type"), spec.view_types, spec.case_sensitive)
    is_eng = type_match(F.col("event_type"), spec.engagement_types, spec.case_sensitive)
    # per-event values computed once; the generator below only references them
    base = enriched.where(F.col("ts").isNotNull()).select(  # window() leaves null times out, so does this
        "user_id", "content_id", "category",
        _start(ts_us, user_s).alias("u_start"), _start(ts_us, aff_s).alias("a_start"),
        _start(ts_us, c_slide).alias("c_start"),
        is_click.cast("int").alias("is_click"), is_view.cast("int").alias("is_view"),
        is_eng.cast("int").alias("is_eng"),
        F.coalesce(F.col("dwell_time_ms"), F.lit(0)).alias("dwell"))

    def key(family, entity, category, start_us, size_s):
        return F.struct(F.lit(family).alias("family"), entity.alias("entity_id"),
                        category.alias("category"), start_us.alias("start_us"),
                        F.lit(size_s * 1_000_000).alias("size_us"))

    no_cat = F.lit(None).cast("string")
    entries = [key("user", F.col("user_id"), no_cat, F.col("u_start"), user_s)]
    entries += [key("content", F.col("content_id"), no_cat,
                    F.col("c_start") - F.lit(i * c_slide * 1_000_000), c_size)
                for i in range(c_size // c_slide)]
    entries.append(F.when(F.col("category").isNotNull(),
                          key("affinity", F.col("user_id"), F.col("category"), F.col("a_start"), aff_s)))
    flags = base.select(F.explode(F.array(*entries)).alias("g"), "is_click", "is_view", "is_eng", "dwell")
    agg = (flags.where(F.col("g").isNotNull())
           .groupBy(F.col("g.family").alias("family"), F.col("g.entity_id").alias("entity_id"),
                    F.col("g.category").alias("category"), F.col("g.start_us").alias("start_us"),
                    F.col("g.size_us").alias("size_us"))
           .agg(F.count(F.lit(1)).alias("n"), F.sum("is_click").cast("bigint").alias("clicks"),
                F.sum("dwell").alias("dwell_sum"), F.sum("is_view").cast("bigint").alias("views"),
                F.sum("is_eng").cast("bigint").alias("engagements")))
    fam = F.col("family")
    rate = F.when(F.col("views") > 0, F.col("engagements") / F.col("views")).otherwise(F.lit(0.0))
    values = F.explode(
        F.when(fam == "user", F.array(
            F.struct(F.lit("click_rate").alias("name"), (F.col("clicks") / F.col("n")).alias("v"),
                     F.lit(None).cast("bigint").alias("i")),
            F.struct(F.lit("avg_dwell_time").alias("name"), (F.col("dwell_sum") / F.col("n")).alias("v"),
                     F.lit(None).cast("bigint").alias("i"))))
        .when(fam == "content", F.array(
            F.struct(F.lit("engagement_rate").alias("name"), rate.alias("v"), F.lit(None).cast("bigint").alias("i"))))
        .otherwise(F.array(
            F.struct(F.concat(F.lit(spec.affinity_prefix), F.col("category")).alias("name"),
                     F.col("n").cast("double").alias("v"), F.col("n").alias("i")))))
    long = agg.select("entity_id", "start_us", "size_us", values.alias("x"))
    return long.select(
        "entity_id", F.col("x.name").alias("feature_name"), F.col("x.v").cast("double").alias("feature_value"),
        F.timestamp_micros(F.col("start_us")).cast(ts_type).alias("window_start"),
        F.timestamp_micros(F.col("start_us") + F.col("size_us")).cast(ts_type).alias("window_end"),
        (F.timestamp_micros(F.col("start_us") + F.col("size_us")).cast(ts_type)
         + F.make_interval(secs=F.lit(spec.watermark_delay_s))).alias("computed_at"),
        F.col("x.i").alias("feature_value_int"))


def feature_rows_for_entity(enriched: DataFrame, entity_id: str, spec: FeatureSpec) -> DataFrame:
    """Feature rows of one entity, reading only the events that can feed it.

    A user's rows come from events with that user_id (user and affinity
    families), a content's rows from events with that content_id; the
    disjunction is a plain predicate that reaches the scan.
    """
    relevant = enriched.where((F.col("user_id") == entity_id) | (F.col("content_id") == entity_id))
    return all_feature_rows_one_pass(relevant, spec).where(F.col("entity_id") == entity_id)


def drop_wire_extras(features: DataFrame) -> DataFrame:
    return features.drop("feature_value_int")
