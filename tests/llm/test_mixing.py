"""Mixing against a plain apportionment and the contract's bounds."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dwellspark.llm.mixing import apportion, mix


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free} if free else {}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: most * sizes[s] for s in over}


def plain_seats(strength, seats, cap):
    """Sainte-Lague, seat by seat."""
    won = dict.fromkeys(strength, 0)
    for _ in range(seats):
        free = [p for p in strength if won[p] < cap[p]]
        if not free:
            break
        best = max(free, key=lambda p: (strength[p] / (2 * won[p] + 1), [-ord(c) for c in p]))
        won[best] += 1
    return won


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(1, 500), min_size=1, max_size=7), st.integers(0, 120))
def test_seats_are_those_of_highest_quotients(spark, strengths, seats):
    rows = [(chr(97 + i), float(s), seats, 10_000) for i, s in enumerate(strengths)]
    df = spark.createDataFrame(rows, "p string, s double, seats long, cap long")
    got = {r["p"]: r["quota"] for r in apportion(df, ["p"], [], "s", "seats", "cap", 1).collect()}
    assert got == plain_seats({r[0]: r[1] for r in rows}, seats, {r[0]: 10_000 for r in rows})


def test_mix_meets_targets(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 90)), ["b", "a", None, "c", "tiny"][i % 5 if i % 11 else 0], 1) for i in range(400)]
    rows += [(1000, None, "a", 1), (1001, "", "b", 1), (1002, "x y z", "emptyé", 1), (3, "w w w", "a", 1), (3, "w w w", "a", 1), (None, "w w", "c", 1)]
    rows.append((5000, "w " * 30_000, "c", 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, taken int")
    got = mix(docs, shard_words=5_000).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mix(docs, shard_words=5_000).collect()), key=str)
    assert len(got) == len(rows)
    sizes, taken, target = {}, {}, {}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"] and 0 <= r["copies"] <= 3
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
    words = {}
    for _, t, s, _ in rows:
        words[s] = words.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sizes == words
    want = plain_targets(words)
    for s in want:
        assert abs(target[s] - want[s]) < 1e-6 and abs(taken[s] - want[s]) <= 120


def test_mix_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mix(empty).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, " ", "a")], empty.schema)
    assert [(r["size"], r["target"], r["taken"], r["copies"]) for r in mix(blank).collect()] == [(0, 0.0, 0, 0)] * 2
