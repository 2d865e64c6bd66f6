"""Connected components of a distributed edge list."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellspark.llm.common import cut_lineage


PART = 250_000  # edges per partition


def contracted(edges: DataFrame) -> DataFrame:
    """Each partition's edges as stars: (a, b) with b the smallest id that a reaches inside it.

    At most as many edges as before, which connect the same ids.
    """
    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict[int, int] = {}

        def root(x: int) -> int:
            while (y := up.setdefault(x, x)) != x:
                up[x] = up[y]
                x = up[x]
            return x

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                a, b = root(a), root(b)
                up[max(a, b)] = min(a, b)
        found = [(x, root(x)) for x in list(up)]
        found = [(x, y) for x, y in found if x != y]
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    return edges.mapInArrow(stars, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id in ``edges`` (a, b): the smallest id that it reaches.

    The edges of a partition (about ``PART``) are contracted to stars first, which is all
    where one partition holds them.  Then alternating large-star and small-star steps:
    each links the neighbours of a node to the smallest of them.  The edge list never
    grows, and a step is one grouping with map-side combining plus one join.  Ends when a
    round changes nothing.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b"))
    parts = max(1, -(-edges.count() // PART))
    edges = cut_lineage(contracted(edges.coalesce(1) if parts == 1 else edges.repartition(parts)))
    mark = None if parts > 1 else "done"
    while mark != "done":
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = (both.join(low, "a").where(F.col("b") > F.col("a"))
                 .select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").coalesce(parts).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select("a", "b", "low")
        small = (small.select("a", F.col("low").alias("b"))
                 .unionByName(small.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))).coalesce(parts).distinct())
        edges = cut_lineage(small.coalesce(parts))
        row = edges.agg(F.count("*").alias("n"), F.sum(F.col("b").cast("decimal(38,0)")).alias("s"),
                        F.countDistinct("a").alias("d")).first()
        if row["n"] == row["d"] and mark == (row["n"], row["s"]):
            break
        mark = (row["n"], row["s"])
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct()
