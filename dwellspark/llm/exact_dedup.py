"""Exact dedup: groups of equal texts, one row of each stays.

Rows are grouped by a 128-bit content hash.  Inside a hash group the texts
themselves are the grouping key, so their bytes are compared and a collision
cannot join two different texts.  Both groupings combine on the map side: of
a large group of copies each task sends one row on.

Defined results: a null text equals an empty one.  Of equal texts the row with
the extreme ``doc_id`` stays (a null ``doc_id`` loses to any other); of rows
that agree in ``doc_id`` and text one stays.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwellspark.llm.common import cut_lineage, whole_text


def content_hash(text: Column) -> Column:
    """128 bits as binary."""
    return F.unhex(F.md5(text))


def exact_groups(docs: DataFrame, *, text: Callable[[Column], Column] = lambda c: c,
                 digest: Callable[[Column], Column] = content_hash, keep: str = "max") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, content_hash.

    ``text`` normalises a text before it is compared; ``digest`` hashes it;
    ``keep`` is "min" or "max": which doc_id of a group stays.
    """
    best = F.max if keep == "max" else F.min
    norm = docs.select("doc_id", text(whole_text("text")).alias("t"))
    norm = norm.withColumn("h", digest(F.col("t")))
    texts = norm.groupBy("h", "t").agg(best("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    per_text = texts.select("h", "keep_id", "group_size", F.unhex(F.sha2(F.col("t"), 256)).alias("sha"))
    by_hash = cut_lineage(per_text.groupBy("h").agg(
        F.count("*").alias("n_texts"), F.first("keep_id").alias("keep_id"),
        F.first("group_size").alias("group_size"), F.first("sha").alias("sha")))
    shared = by_hash.where("n_texts > 1").select("h")
    every = norm.select("doc_id", "h").join(by_hash.where("n_texts = 1").drop("n_texts"), "h")
    if not shared.isEmpty():  # different texts under one hash: there the text itself is the join key
        clash = (norm.join(shared, "h", "left_semi").join(texts.join(shared, "h", "left_semi"), ["h", "t"])
                 .select("h", "doc_id", "keep_id", "group_size", F.unhex(F.sha2(F.col("t"), 256)).alias("sha")))
        every = every.unionByName(clash)
    # numbered by (doc_id, text), not by hash, so that adaptive execution can split the join above
    # at the hash of a large group; only rows that agree in both meet in one task
    copy = F.row_number().over(Window.partitionBy("doc_id", "sha").orderBy(F.lit(1)))
    return every.select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (copy == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"), F.col("h").alias("content_hash"))


def drop_copies(docs: DataFrame, **options) -> DataFrame:
    """The documents that stay, with all their columns."""
    stays = exact_groups(docs, **options).where("kept").select("doc_id", "text_sha256")
    norm = options.get("text", lambda c: c)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.col("doc_id").alias("k"), F.sha2(norm(whole_text("text")), 256).alias("s"))
    cond = F.col("k").eqNullSafe(F.col("doc_id")) & (F.col("s") == F.col("text_sha256"))
    joined = whole.join(stays, cond, "left_semi")
    nth = F.row_number().over(Window.partitionBy("k", "s").orderBy(F.lit(1)))
    return joined.withColumn("nth", nth).where("nth = 1").select("row.*")
