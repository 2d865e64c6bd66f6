"""Late classifier and running sums against brute force on small fixtures."""

import random
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import functions as F

from dwellspark.operators import late, lateness
from dwellspark.operators.ordered import running_max, running_sums
from helpers import events, with_arrival

BASE = datetime(2024, 1, 1)


def _fixture(spark, n=600, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        ts = BASE + timedelta(seconds=int(i * 37 + rnd.randint(0, 20)))
        lag = rnd.choice([0, 0, 0, 0, 5, 40, 95, 400, 4000])
        rows.append((i, f"u{rnd.randint(1, 5)}", ts, ts + timedelta(seconds=lag)))
    pdf = pd.DataFrame(rows, columns=["event_id", "user_id", "ts", "arrival_ts"])
    df = spark.createDataFrame(pdf, "event_id bigint, user_id string, ts timestamp_ntz, arrival_ts timestamp_ntz")
    return pdf, df


def _brute(pdf, size_s, slide_s, delay_s):
    order = pdf.sort_values(["arrival_ts", "event_id"]).reset_index(drop=True)
    out, running_max = set(), None
    for r in order.itertuples():
        secs = int((r.ts - BASE).total_seconds())
        base_s = int((BASE - datetime(1970, 1, 1)).total_seconds())
        abs_s = base_s + secs
        last_end = (abs_s // slide_s) * slide_s + size_s
        if running_max is not None:
            wm = int((running_max - datetime(1970, 1, 1)).total_seconds()) - delay_s
            if last_end <= wm:
                out.add(r.event_id)
        running_max = r.ts if running_max is None else max(running_max, r.ts)
    return out


def test_classifier_matches_brute_force(spark):
    pdf, df = _fixture(spark)
    geoms = [late.Geometry("h30", 3600, 3600, 30), late.Geometry("h0", 3600, 3600, 0),
             late.Geometry("s", 900, 300, 30), late.Geometry("m", 60, 60, 120)]
    tagged = late.classify(df, geoms).where(F.col("is_late")).select("geom", "event_id").collect()
    got = {}
    for r in tagged:
        got.setdefault(r["geom"], set()).add(r["event_id"])
    for g in geoms:
        want = _brute(pdf, g.size_s, g.slide_s, g.delay_s)
        assert got.get(g.name, set()) == want, g
    assert any(got.values())
    flagged, cols = late.late_flags(df, geoms)
    rows = flagged.collect()
    for g in geoms:
        assert {r["event_id"] for r in rows if r[cols[g.name]]} == got.get(g.name, set()), g


def test_m11_behind_watermark_but_window_open(spark):
    ev = with_arrival(events(spark, [("u1", "c1", "view", 1, "10:30:00"), ("u1", "c1", "view", 1, "10:28:58")]),
                      ["10:30:00", "10:30:01"])
    assert late.late_events(ev, 3600, delay_s=30).count() == 0


def test_m9_late_after_close(spark):
    ev = with_arrival(events(spark, [("u1", "c1", "view", 1, "10:10:00"), ("u1", "c1", "view", 1, "10:50:00"),
                                     ("u1", "c1", "view", 1, "11:00:30"), ("u1", "c1", "view", 1, "10:59:59")]),
                      ["10:10:00", "10:50:00", "11:00:30", "11:00:31"])
    got = [r["event_id"] for r in late.late_events(ev, 3600, delay_s=30).collect()]
    assert got == [3]


def test_running_sums_match_cumsum(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.randint(0, 50), rnd.choice([0, 1, 1, 2])) for i in range(2000)]
    df = spark.createDataFrame(rows, "id bigint, k bigint, w bigint")
    out = running_sums(df, ["k", "id"], {"cs": "w"}, num_partitions=7)
    got = {r["id"]: r["cs"] for r in out.collect()}
    pdf = pd.DataFrame(rows, columns=["id", "k", "w"]).sort_values(["k", "id"])
    pdf["cs"] = pdf["w"].cumsum()
    assert got == dict(zip(pdf["id"], pdf["cs"]))


def test_classifier_property_with_ties(spark):
    """Coarse times force ties in ts and in arrival (event_id breaks them)."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    geoms = [late.Geometry("t", 600, 600, 60), late.Geometry("s", 600, 300, 0)]
    event = st.tuples(st.integers(0, 40), st.sampled_from([0, 0, 0, 60, 120, 900, 1800]))

    @settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
    @given(st.lists(event, min_size=1, max_size=25))
    def check(evs):
        rows = [(i, "u", BASE + timedelta(seconds=60 * m), BASE + timedelta(seconds=60 * m + lag))
                for i, (m, lag) in enumerate(evs)]
        pdf = pd.DataFrame(rows, columns=["event_id", "user_id", "ts", "arrival_ts"])
        df = spark.createDataFrame(pdf, "event_id bigint, user_id string, ts timestamp_ntz, arrival_ts timestamp_ntz")
        got = {}
        for r in late.classify(df, geoms).where(F.col("is_late")).select("geom", "event_id").collect():
            got.setdefault(r["geom"], set()).add(r["event_id"])
        for g in geoms:
            assert got.get(g.name, set()) == _brute(pdf, g.size_s, g.slide_s, g.delay_s), (g, evs)

    check()


def test_running_max_is_of_the_rows_before(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice([None, rnd.randint(-(1 << 62), 1 << 62)]), "x") for i in range(500)]
    got = running_max(spark.createDataFrame(rows, "id long, v long, other string"), ["id"], "v", "before", 7)
    top, want = None, {}
    for i, v, _ in rows:
        want[i] = top
        top = v if top is None else top if v is None else max(top, v)
    assert {r["id"]: r["before"] for r in got.collect()} == want
    assert running_max(spark.createDataFrame([], "id long, v long"), ["id"], "v", "before").count() == 0


def test_lateness_answers_every_delay(spark):
    """The histogram against the brute-force running maximum, for delays it was not made for."""
    pdf, df = _fixture(spark)
    geoms = [late.Geometry("hour", 3600, 3600, 0), late.Geometry("slide", 900, 300, 0)]
    more = df.unionByName(spark.sql("SELECT bigint(null) event_id, 'u' user_id, timestamp_ntz'2030-01-01 00:00:00' ts, timestamp_ntz'2024-01-01 00:00:00' arrival_ts"))
    rows = lateness.lateness(more, geoms)
    hist = lateness.lateness_histogram(rows)
    delays = (0, 1, 17, 30, 120, 500, 3000, 100_000)
    got = {(r["geom"], r["delay_s"]): r["late_count"] for r in lateness.late_counts(hist, delays).collect()}
    assert rows.count() == 2 * len(pdf)
    for g in geoms:
        for d in delays:
            assert got[g.name, d] == len(_brute(pdf, g.size_s, g.slide_s, d)), (g, d)
    total = rows.groupBy("geom").count().withColumnRenamed("count", "n")
    for r in lateness.least_delay(hist, (0.0, 0.01, 0.9), total).collect():
        g = next(x for x in geoms if x.name == r["geom"])
        assert len(_brute(pdf, g.size_s, g.slide_s, r["delay_s"])) <= r["share"] * len(pdf)
        assert r["delay_s"] == 0 or len(_brute(pdf, g.size_s, g.slide_s, r["delay_s"] - 1)) > r["share"] * len(pdf)
    assert lateness.lateness_histogram(lateness.lateness(df.limit(0), geoms)).count() == 0
