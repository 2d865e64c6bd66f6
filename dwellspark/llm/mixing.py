"""Mixing sources to target weights by Sainte-Lague apportionment (DataFrame functions only).

1. Sizes: words per document, summed per source.
2. Targets: sources in code point order (null last) weigh ``weights``, repeating,
   and share all sizes; a target stops at ``most`` times its source's size and the
   excess is shared again by weight.  Sorted by cap over weight the capped sources
   come first, so running sums give the result of the repeated sharing directly.
3. Equal blocks of ``block`` words go to sources by highest quotients
   target / (2k + 1).  Every source's seats lie within a few of target / block, so
   only those quotients are listed and ranked.
4. Each source's blocks go to its shards (documents dealt by a seeded hash) by the
   same rule, at most ``most`` times the words that a shard holds.
5. In a shard the source's documents stand on a ring in seeded order.  A seeded
   start and the quota give the blocks that are taken: whole rounds, and one arc.

No step lists blocks one by one; a window holds the documents of one source in one
shard (about ``shard_words`` words), the sources, or the shards of a source.

Defined results: a null text has size 0; an empty table gives no rows; sources of
size 0 have target 0; rows that agree in doc_id are ordered by size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwellspark.llm.common import cut_lineage, whole_text, word_count

def source_targets(sizes: DataFrame, weights: tuple[float, ...], most: float) -> DataFrame:
    """source, source_size, weight, target: one row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", w).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    here_on = fill.rowsBetween(0, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(Window.partitionBy()).cast("double")
              - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(here_on))
    per = per.withColumn("level", level).withColumn("open", F.col("cap") / F.col("weight") > F.col("level"))
    # the level of the first source that stays below its cap holds for all that follow
    first = F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(
        fill.rowsBetween(Window.unboundedPreceding, 0))
    return per.select("source", "source_size", "weight",
                      F.coalesce(F.least(first * F.col("weight"), F.col("cap")), F.col("cap")).alias("target"))


def apportion(parties: DataFrame, key: list[str], group: list[str], strength: str, seats: str, cap: str,
              block: int) -> DataFrame:
    """Sainte-Lague: ``parties`` plus ``quota``, of ``seats`` in each group by highest quotients.

    Seats whose quotient is surely among the highest are given at once, those
    that surely are not are not listed; the few between are ranked.  A party
    takes ``cap`` seats at most.
    """
    w = Window.partitionBy(*group)
    total = F.sum(strength).over(w).cast("double")
    fair = F.when(total > 0, F.col(seats) * F.col(strength) / total).otherwise(F.lit(0.0))
    slack = F.ceil(F.count("*").over(w) * F.when(total > 0, F.col(strength) / total).otherwise(F.lit(0.0))) + 2
    near = parties.withColumn("fair", fair).withColumn("slack", slack)
    near = near.withColumn("sure", F.greatest(F.lit(0), F.least(F.col(cap), F.floor(F.col("fair")) - F.col("slack"))).cast("long"))
    near = near.withColumn("limit", F.least(F.col(cap), F.ceil(F.col("fair")) + F.col("slack")).cast("long"))
    left = near.withColumn("left", F.col(seats) - F.sum("sure").over(w))
    some = left.where(F.col("limit") > F.col("sure")).select(
        *key, "left", strength, F.explode(F.sequence("sure", F.col("limit") - 1)).alias("k"))
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(
        (F.col(strength) / (2 * F.col("k") + 1)).desc(), *[F.col(c).asc_nulls_last() for c in key]))
    won = (some.withColumn("rank", rank).where(F.col("rank") <= F.col("left"))
           .groupBy(*key).agg(F.count("*").alias("extra")))
    same = None
    for c in key:
        part = F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
        same = part if same is None else same & part
    return (near.alias("a").join(won.alias("b"), same, "left")
            .select(*[F.col(f"a.{c}") for c in parties.columns],
                    (F.col("a.sure") + F.coalesce(F.col("b.extra"), F.lit(0))).alias("quota")))


def overlap(lo: Column, hi: Column, from_: Column, to: Column) -> Column:
    return F.greatest(F.lit(0), F.least(hi, to) - F.greatest(lo, from_))


def mix(docs: DataFrame, *, weights: tuple[float, ...] = (5.0, 2.0, 1.0), most: int = 3, block: int = 8,
        shard_words: int = 1_000_000, seed: int = 17) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, rounds, copies.

    ``taken`` counts the words that the mix takes of the document with repeats,
    at most ``most`` times its size; ``rounds`` are its whole takes, and
    ``copies`` the whole documents that come nearest to ``taken`` on average
    (a document is taken once more if its middle word is).
    """
    text = whole_text("text")
    sizes = cut_lineage(docs.select("doc_id", "source", word_count(text).alias("size"),
                                    F.xxhash64(text).alias("tie")))
    total = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
    shards = max(1, -(-total // shard_words))
    targets = source_targets(sizes, weights, most)
    targets = targets.withColumn("blocks", F.lit(int(round(total / block))).cast("long")).withColumn(
        "cap", F.floor(F.col("source_size") * most / block).cast("long"))
    by_source = cut_lineage(apportion(targets, ["source"], [], "target", "blocks", "cap", block))
    dealt = sizes.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(shards)))
    cells = dealt.groupBy("source", "shard").agg(F.sum("size").alias("words"))
    cells = cells.withColumn("cap", F.floor(F.col("words") * most / block).cast("long"))
    cells = (cells.alias("c").join(by_source.select("source", "source_size", "target", "quota").alias("s"),
                                   F.col("c.source").eqNullSafe(F.col("s.source")))
             .select("c.source", "c.shard", "c.words", "c.cap", "s.source_size", "s.target",
                     F.col("s.quota").alias("seats")))
    cells = apportion(cells, ["source", "shard"], ["source"], "words", "seats", "cap", block)
    cells = cells.select(
        "source", "shard", "words", "source_size", "target", (F.col("quota") * block).alias("take"),
        F.pmod(F.xxhash64(F.lit(seed), "source", "shard"), F.greatest("words", F.lit(1))).alias("from"))
    run = Window.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(seed + 1), "doc_id"), "doc_id", "size", "tie")
    placed = dealt.withColumn("end", F.sum("size").over(run.rowsBetween(Window.unboundedPreceding, 0)))
    out = (placed.alias("d").join(cells.alias("c"), F.col("d.source").eqNullSafe(F.col("c.source"))
                                  & (F.col("d.shard") == F.col("c.shard")))
           .select("d.doc_id", "d.source", "d.size", "d.tie", "d.end", "c.words", "c.source_size", "c.target",
                   "c.take", "c.from"))
    lo, hi, n = F.col("end") - F.col("size"), F.col("end"), F.greatest("words", F.lit(1))
    rounds = F.floor(F.col("take") / n).cast("long")
    arc_to = F.col("from") + F.col("take") - rounds * n
    arc = overlap(lo, hi, F.col("from"), arc_to) + overlap(lo, hi, F.col("from") - n, arc_to - n)
    mid = lo + F.floor(F.col("size") / 2)
    in_arc = (((mid >= F.col("from")) & (mid < arc_to)) | (mid < arc_to - n)) & (F.col("size") > 0)
    return out.select("doc_id", "source", "size", "source_size", "target",
                      (rounds * F.col("size") + arc).cast("long").alias("taken"), rounds.alias("rounds"),
                      (rounds + in_arc.cast("long")).alias("copies"), F.col("tie").alias("text_hash"))
