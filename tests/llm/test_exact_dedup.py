"""Exact dedup against brute force, with hash collisions, nulls, ties and clashing columns."""

import hashlib

import pytest
from pyspark.sql import functions as F

from dwellspark.llm.exact_dedup import drop_copies, exact_groups

ROWS = [(1, "a", "x"), (2, "a", "y"), (3, None, "z"), (4, "", "z"), (5, "b", None), (7, "b", "q"), (7, "b", "r"),
        (8, "é" * 50_000, "s"), (9, "é" * 50_000, "t"), (None, "c", "u"), (None, "a", "u")]
DDL = "doc_id long, text string, kept string"


def brute(rows, pick):
    groups = {}
    for d, t, _ in rows:
        groups.setdefault(t or "", []).append(d)
    out, seen = [], set()
    for d, t, _ in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = pick(ids) if ids else None
        out.append((d, keep, len(groups[t or ""]), d == keep and (d, t or "") not in seen, hashlib.sha256((t or "").encode()).hexdigest()))
        seen.add((d, t or ""))
    return sorted(out, key=str)


@pytest.mark.parametrize("keep,pick", [("max", max), ("min", min)])
@pytest.mark.parametrize("digest", [None, lambda t: F.substring(F.unhex(F.md5(t)), 1, 0), lambda t: F.lit("same")])
def test_groups_equal_brute_force(spark, keep, pick, digest):
    docs = spark.createDataFrame(ROWS, DDL)
    options = {"digest": digest} if digest else {}
    got = exact_groups(docs, keep=keep, **options).drop("content_hash").collect()
    assert sorted(map(tuple, got), key=str) == brute(ROWS, pick)


def test_drop_copies_keeps_columns_and_one_row_of_each(spark):
    got = drop_copies(spark.createDataFrame(ROWS, DDL))
    assert got.columns == ["doc_id", "text", "kept"]
    assert sorted((r["doc_id"] or 0, (r["text"] or "")[:1]) for r in got.collect()) == [(0, "c"), (2, "a"), (4, ""), (7, "b"), (9, "é")]


def test_normalised_text_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "A b"), (2, "a B")], "doc_id long, text string")
    assert exact_groups(docs, text=F.lower).where("kept").select("doc_id").collect()[0][0] == 2
    assert exact_groups(docs.limit(0)).count() == 0 and drop_copies(docs.limit(0)).count() == 0


def test_a_large_group_is_split(spark):
    """Half of all rows are equal: adaptive execution splits the join at their hash."""
    docs = spark.range(40_000).selectExpr("id AS doc_id", "IF(id % 2 = 0, 'the same text', CONCAT('text ', id)) AS text").repartition(8)
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        groups = exact_groups(docs)
        rows = groups.collect()
        plan = groups._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan
    assert sum(r["kept"] for r in rows) == 20_001 and max(r["group_size"] for r in rows) == 20_000
