"""The manifest against a plain tree over sorted rows."""

import random
import zlib
from hashlib import sha256

import pytest

from dwellspark.llm import merkle

DDL = "doc_id long, text string, lang string, source string, n_chars long, rank int, leaf string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(row, lower=False):
    d, text, lang, source, n = row[:5]
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return h("".join(field(v) for v in (d, source, lang, n, text)))


def tree(nodes):
    """Levels up to the root."""
    out = [nodes]
    while len(out[-1]) > 1:
        last = out[-1]
        out.append([h(*last[k:k + 8]) for k in range(0, len(last), 8)])
    return out


def path(levels, k):
    steps = []
    for nodes in levels[:-1]:
        run = k - k % 8
        steps.append((nodes[run:k], nodes[k + 1:run + 8]))
        k //= 8
    return steps


def plain(rows):
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r)
    langs = sorted(by, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in langs:
        by[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[g] = tree([leaf_of(r) for r in by[g]])
    top = tree([trees[g][-1][0] for g in langs])
    out = []
    for k, g in enumerate(langs):
        for i, r in enumerate(by[g]):
            steps = path(trees[g], i) + path(top, k)
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            node = leaf_of(r, tampered)
            for left, right in steps:
                node = h(*left, node, *right)
            out.append((r[0], leaf_of(r), trees[g][-1][0], top[-1][0], h(*[x for s in steps for part in s for x in part]),
                        node, node == top[-1][0]))
    return sorted(out, key=str)


def check(spark, rows, **options):
    docs = spark.createDataFrame(rows, DDL).repartition(5)
    got = [tuple(r) for r in merkle.verify(merkle.manifest(docs, **options)).collect()]
    assert sorted(got, key=str) == plain(rows)


def row(d, text, lang="en", source="s", n=3):
    return (d, text, lang, source, n, 1, "clash")


@pytest.mark.parametrize("n,spread", [(700, 1), (600, 1 << 40)])
def test_against_plain_tree(spark, n, spread):
    rng = random.Random(n)
    ids = rng.sample(range(-3 * n, 3 * n), n)
    rows = [row(d * spread, rng.choice(["Ab", "É Z", "", None]), rng.choice(["en", "en", "en", "de", "ÿ", "", None]),
                rng.choice([None, "web"]), rng.choice([None, 5])) for d in ids]
    check(spark, rows)


def test_deep_tree_small_slots(spark, monkeypatch):
    """Several rounds of slot arrays."""
    monkeypatch.setattr(merkle, "RADIX_BITS", 2)
    rng = random.Random(4)
    check(spark, [row(d, rng.choice(["Ab", "x"]), rng.choice(["en", "de", "g%d" % (d % 70)])) for d in range(600)], depth=1)


def test_repeated_and_missing_ids(spark):
    rows = [row(None, "a"), row(None, "a"), row(None, "B"), row(None, None, None), row(7, "x"), row(7, "x"), row(7, "Y"), row(8, "A"),
            row(7, "x", "de"), row(-1, "q"), row(2 ** 62, "long " * 50_000), row(-2 ** 62, "K"), row(64, ""), row(63, "")]
    check(spark, rows)


@pytest.mark.parametrize("n", [0, 1, 8, 9])
def test_small_tables(spark, n):
    check(spark, [row(k, "T") for k in range(n)])
