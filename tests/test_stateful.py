"""The one stateful query and its batch writer: late events, records, heartbeats, running counts, retries."""

import json
import os
import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from dwellspark.operators import metrics as M
from dwellspark.schemas import METRIC_SCHEMA
from dwellspark.session import remove_path
from dwellspark.spec import WIRE_SPEC
from dwellspark.streaming import job as J
from dwellspark.streaming import outputs as O
from dwellspark.streaming import stateful as S

DAY = datetime(2024, 1, 1)
META = [("c0", "scifi", "a", 1), ("c1", "news", "b", 1)]


def _events(n, seed):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        at = DAY + timedelta(seconds=40 * k - rng.choice([0, 0, 0, 0, 3000, 5000, 9000]))
        out.append((rng.choice(["hot"] * 4 + ["u1", "u2"]), f"c{rng.randrange(3)}", rng.choice(["click", "VIEW", "like"]), rng.choice([5, None]), at))
    return out


def _stage(spark, folder, events, per_file):
    for k in range(0, len(events), per_file):
        lines = [json.dumps({"user_id": u, "content_id": c, "event_type": e, "dwell_time_ms": d, "timestamp": f"{t:%Y-%m-%dT%H:%M:%S}Z"})
                 for u, c, e, d, t in events[k:k + per_file]]
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(folder)


def _run(spark, root, events, per_file, files=1):
    _stage(spark, os.path.join(root, "in"), events, per_file)
    meta = spark.createDataFrame(META, "content_id string, category string, creator_id string, seq bigint")
    job = J.FeatureStreamJob(spark, root, WIRE_SPEC, metadata=lambda s: meta, state_partitions=2)
    J.wait_for([job.start_outputs(J.wire_file_stream(spark, os.path.join(root, "in"), files))])
    return job.outputs()


def _plain(events, cut):
    """Per family the closed windows' counts and late entries, by walking the batches."""
    open_, closed, late, top = {}, {}, [], None
    for k in range(0, len(events) + cut, cut):
        mark = None if top is None else top - timedelta(seconds=30)
        for u, c, e, d, t in events[k:k + cut]:
            hour = t.replace(minute=0, second=0)
            five = t - timedelta(minutes=t.minute % 5, seconds=t.second)
            named = dict((m[0], m[1]) for m in META).get(c)
            for family, key, starts, size in [("user", u, [hour], 60), ("content", c, [five - timedelta(minutes=5 * i) for i in range(3)], 15),
                                              *([("affinity", (u, named), [hour], 60)] if named else [])]:
                there = [s for s in starts if mark is None or s + timedelta(minutes=size) > mark]
                for s in there:
                    open_[family, key, s, size] = open_.get((family, key, s, size), 0) + 1
                if not there:
                    late.append((family, u, t))
            top = t if top is None else max(top, t)
        for w in [w for w in open_ if mark is not None and w[2] + timedelta(minutes=w[3]) <= mark]:
            closed[w] = closed.get(w, 0) + open_.pop(w)
    return closed, late


@pytest.mark.parametrize("per_file,files", [(100, 1), (40, 4)])
def test_events_are_aggregated_or_late(spark, scratch, per_file, files):
    events = _events(300, 1)
    events.append(("end", "c9", "view", 1, DAY + timedelta(days=2)))  # closes all windows
    out = _run(spark, scratch, events, per_file, files)
    closed, late = _plain(events, per_file * files)
    rows = out.closed(spark).collect()
    got = {(r["family"], (r["entity_id"], r["category"]) if r["family"] == "affinity" else r["entity_id"], r["start_us"]): r["event_count"]
           for r in rows if r["kind"] == "window"}
    epoch = datetime(1970, 1, 1)
    assert got == {(f, k, (s - epoch) // timedelta(microseconds=1)): n for (f, k, s, _), n in closed.items()}
    assert sorted((r["family"], r["user_id"], r["ts_us"]) for r in rows if r["kind"] == "late") == sorted(
        (f, u, (t - epoch) // timedelta(microseconds=1)) for f, u, t in late)
    # events = aggregated + late, but for the one that closed the rest
    user = [r for r in rows if r["family"] == "user"]
    assert sum(r["event_count"] for r in user) == len(events) - 1
    assert any(r["kind"] == "late" for r in user)


def test_sinks_of_a_run(spark, scratch):
    events = _events(200, 2)
    out = _run(spark, scratch, events, 70)
    features = out.features(spark).collect()
    records = [(r["key"], json.loads(r["value"]), r["value"]) for r in out.records(spark).collect()]
    assert len(records) == len(features) > 0
    for key, value, text in records:
        assert key == f"{value['entity_id']}|{value['feature_name']}"
        whole = value["feature_name"].startswith("category_affinity_")
        assert isinstance(value["feature_value"], int if whole else float), text
    # emitted now, though the windows are old: a delayed job shows its age
    assert all(r["computed_at"] - r["window_end"] > timedelta(days=365) for r in features)
    assert len({(r["batch_id"], r["computed_at"]) for r in features}) == len({r["batch_id"] for r in features})
    # two heartbeats per user window; running counts without a gap
    metrics = sorted(out.metrics(spark).collect(), key=lambda r: r["metric_offset"])
    assert [r["metric_offset"] for r in metrics] == list(range(1, len(metrics) + 1))
    n_user = sum(r["family"] == "user" for r in features)
    assert sum(r["metric_type"] == "watermark_heartbeat" for r in metrics) == n_user
    late = [r for r in metrics if r["metric_type"] == "late_event_dropped"]
    assert [r["count"] for r in late] == list(range(1, len(late) + 1)) and len(late) == out.late_events(spark).count() > 0
    seen = 0
    for r in metrics:
        seen += r["metric_type"] == "late_event_dropped"
        assert seen == (r["count"] if r["count"] is not None else r["late_events_total"])
    as_of = "2030-01-01 00:00:00"  # the fold kept batch by batch is the fold of all rows
    assert out.health(spark, as_of).first() == M.fold_metrics(out.metrics(spark), as_of).first()
    totals = out.totals(spark).orderBy(F.col("batch_id").desc()).first()
    assert (totals["late_total"], totals["metric_total"], totals["feature_total"]) == (len(late), len(metrics), len(features))


def test_a_repeated_batch_appears_once(spark, scratch):
    out = _run(spark, scratch, _events(120, 3), 60)
    last = max(r["batch_id"] for r in out.features(spark).select("batch_id").distinct().collect())
    tables = ["features", "records", "late_events", "metrics"]
    read = lambda: [sorted(map(str, getattr(out, t)(spark).collect())) for t in tables]
    before = read()
    batch = out.closed(spark).where(F.col("batch_id") == last).drop("batch_id").checkpoint()
    out.process(batch, last)  # in the ledger: nothing is written
    assert read() == before
    remove_path(spark, out._folder("ledger/totals", last))  # as if the writer had failed before its end
    assert any(len(a) > len(b) for a, b in zip(before, read()))  # what is not in the ledger is not read
    out.process(batch, last)
    assert read() == before


def test_retry_keeps_the_stamp(spark, scratch):
    out = O.FeatureOutputs(os.path.join(scratch, "o"), WIRE_SPEC)
    assert out._stamp(spark, 4) == out._stamp(spark, 4) > 0
    assert out.features(spark).count() == out.metrics(spark).count() == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_folds_of_slices_equal_the_fold(spark, seed):
    rng = random.Random(seed)
    kinds = ["late_event_dropped"] * 3 + ["watermark_heartbeat", "other"]
    rows = [(k, rng.choice(kinds), rng.choice([None, None, None, 7 * k]), None, None, None, rng.choice([None, DAY + timedelta(hours=k)]),
             rng.choice([None, None, 5 * k])) for k in range(24)]
    cuts = sorted(rng.sample(range(25), 3))
    parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, 24])]
    frame = lambda some: spark.createDataFrame(some, METRIC_SCHEMA).coalesce(1)
    state = M.fold_state(frame(parts[0]))
    for part in parts[1:]:
        state = M.merge_folds(state.unionByName(M.fold_state(frame(part)))).checkpoint()
    as_of = "2024-02-01 00:00:00"
    assert M.fold_snapshot(state, as_of).first() == M.fold_metrics(frame(rows), as_of).first()


def test_merged_reads_the_stateful_step_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    part = lambda n: ("window", "user", "u", None, 0, 3600, 1, 2, None, 10, n, None, None, None, None, 7)
    late = lambda user: ("late", "user", user, None, 0, 3600, None, None, None, None, 1, user, "c", "view", 5, 7)
    rows = [part(3), part(4), late("u"), late("u"), late("v")]
    out = S.merged(spark.createDataFrame(rows, S.CLOSED).mapInPandas(counted, S.CLOSED)).collect()
    assert seen.value == len(rows)
    # a window's parts are one row, equal late entries stay as many
    assert [(r["clicks"], r["views"], r["engagements"], r["dwell_sum"], r["event_count"]) for r in out if r["kind"] == "window"] == [(2, 4, None, 20, 7)]
    assert sorted((r["user_id"], r["event_count"], r["clicks"], r["ts_us"]) for r in out if r["kind"] == "late") == [
        ("u", 1, None, 5), ("u", 1, None, 5), ("v", 1, None, 5)]


@pytest.mark.parametrize("category", [["a", ""], None])
def test_state_is_one_value(category):
    sums = pd.DataFrame({"entity_id": ["x", None], **({} if category is None else {"category": category}), "start_us": [0, 300],
                         **{c: [1, 2] for c in S.SUMS}})
    packed = S._packed(sums)
    assert isinstance(packed, bytes)
    pd.testing.assert_frame_equal(S._unpacked(bytearray(packed)), sums)
    assert S.STATE.count(",") == 0


def test_partitions_follow_the_rows_of_a_trigger(spark):
    assert J.state_partitions_for(spark, 1000) == 1
    assert J.state_partitions_for(spark, 25_000) == 3
    assert J.state_partitions_for(spark, 10_000_000) == int(spark.conf.get("spark.sql.shuffle.partitions"))
