"""The join against brute force over all pairs."""

import random
import re

import pytest

from dwellspark.llm import jaccard
from dwellspark.llm.graph import components


def brute(rows, n=5, num=75, den=100):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets.append(frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else []))
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j]:
                same = len(a & sets[j])
                if den * same >= num * (len(a) + len(sets[j]) - same):
                    up[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(d, low.get(root(i), d))
    return sorted(((d, len(s), low.get(root(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"W{i}" for i in range(400)]
    make = lambda n: [rng.choice(words) for _ in range(n)]
    passage = make(40)
    texts = []
    for family in range(12):
        base = make(rng.choice([6, 30, 80, 200]))
        for _ in range(rng.choice([1, 3, 25])):
            t = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 6])):
                t[rng.randrange(len(t))] = rng.choice(words)
            if rng.random() < 0.2:
                t = t[:int(len(t) * rng.uniform(0.6, 1))]
            texts.append(t)
    texts += [make(20) + passage + make(25) for _ in range(40)]
    chain = make(120)
    for _ in range(30):  # a chain: neighbours link, the ends do not
        chain = chain[4:] + make(4)
        texts.append(list(chain))
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = corpus(seed) + [(5000, None), (5001, ""), (5002, " \n"), (5003, "One two"), (5004, "one TWO"), (5005, "a b c d"), (5006, "b c d e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    members, links = jaccard.jaccard_join(docs)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in members.collect()), key=str)
    assert got == brute(rows)
    assert all(100 * r["common"] >= 75 * (r["size_a"] + r["size_b"] - r["common"]) for r in links.collect())


def test_blocks_are_compared_member_by_member(spark):
    """Two groups whose leaders do not link, but some of their members do."""
    rng = random.Random(7)
    base = [f"w{i}" for i in range(140)]
    rows = []
    for i in range(40):
        near, far = list(base), list(base)
        near[0], far[0] = f"n{i}", f"f{i}"
        k = rng.randrange(0, 5)
        for j in range(k):
            near[20 + 9 * j] = "x"
            far[20 + 9 * j] = "x"
        for j in range(k, 5):
            far[20 + 9 * j] = f"y{j}"
        rows += [(2 * i, " ".join(near)), (2 * i + 1, " ".join(far))]
    members, _ = jaccard.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in members.collect()), key=str) == brute(rows)


def test_without_broadcasts_and_in_small_groups(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL", 0)
    monkeypatch.setattr(jaccard, "GROUP", 2)
    monkeypatch.setattr(jaccard, "MOST_FREQUENT", 3)
    rows = corpus(4)[:150]
    members, _ = jaccard.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in members.collect()), key=str) == brute(rows)


@pytest.mark.parametrize("num,longest", [(75, 8), (75, 10**6), (50, 8), (90, 16)])
def test_lists_cut_into_blocks(spark, monkeypatch, num, longest):
    """Lists cut by owner and size class, sizes far apart and on the edge of a link, other thresholds."""
    monkeypatch.setattr(jaccard, "LIST", longest)
    rng = random.Random(num)
    rows = corpus(5)[:120]
    for i in range(25):  # heads of one text: sizes from equal to beyond the edge
        rows.append((1000 + i, " ".join(f"h{k}" for k in range(4 + 90 + 4 * i))))
    shared = [f"s{k}" for k in range(30)]
    for i in range(40):  # short texts of little but one passage: frequent shingles in the prefixes
        rows.append((2000 + i, " ".join(shared + [f"e{i}x{k}" for k in range(rng.randrange(14))])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    members, links = jaccard.jaccard_join(docs, num=num)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in members.collect()), key=str)
    assert got == brute(rows, num=num)


def test_positions_skip_entries_of_lists(spark):
    """An entry visits the block of larger sizes only with enough shingles left; the index is made once for both sides."""
    import contextlib
    import io

    order = jaccard.Order(spark, 27, jaccard.np.zeros(0, jaccard.np.uint64), jaccard.np.zeros(0, jaccard.np.int64))
    sizes = [90, 100, 110, 120, 140, 160]
    rows = [(n, n << 32 | n, " ".join(f"w{k}" for k in range(n + 4))) for n in sizes]
    index = jaccard.prefix_index(spark.createDataFrame(rows, "owner long, span long, text string"), order, 5, 75, 100)
    found = index.collect()
    home = {(r["t"], r["owner"]): r for r in found if r["role"] == jaccard.BOTH}
    up = {(r["t"], r["owner"]): r for r in found if r["role"] == jaccard.LESS}
    assert set(up) < set(home) and 0 < len(up) < len(home)
    classes = {r["owner"]: r["block"] for r in home.values()}
    for (t, a), x in home.items():
        for (u, b), y in home.items():
            if t == u and classes[a] + 1 == classes[b] and min(x["left"], y["left"]) >= -(-(a + b) * 75 // 175):
                assert (t, a) in up
    found = jaccard.candidates(index, spark.createDataFrame([(n, n) for n in sizes], "owner long, leader long"), 75, 100)
    pairs = {frozenset((r["a"], r["b"])) for r in found.collect()}
    assert pairs == {frozenset((a, b)) for a in sizes for b in sizes if a < b and 100 * a >= 75 * b}
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        found.explain()
    assert "ReusedExchange" in shown.getvalue().split("== Initial Plan ==")[0]


def test_repeated_and_missing_ids(spark):
    t = "one two three four five six seven"
    rows = [(1, t), (1, t), (2, t + " eight"), (2, "quite another text with words of its own"), (None, t), (None, None)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, component_id int")
    members, _ = jaccard.jaccard_join(docs)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in members.collect()), key=str) == brute(rows)
    assert jaccard.jaccard_join(docs.limit(0))[0].count() == 0


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (200, 201)], "a long, b long")
    got = {r["id"]: r["component"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 200: 200, 201: 200}
