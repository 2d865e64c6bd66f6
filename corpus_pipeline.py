"""A training corpus in five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns the rows that go on; ``run``
writes a stage's result to the shared folder and reads it back as the next one's
documents.  All stages but the last return the columns of ``documents``.

Defined results: null texts are empty ones, and copies of each other; the
near-duplicate stage leaves rows without a doc_id alone; of repeated rows (equal id and
text) one stays; an empty table gives no rows; columns beyond those of ``documents``
are carried up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellspark.llm import exact_dedup, jaccard, mixing, packing, site_quality
from dwellspark.llm.common import cut_lineage, table, whole_text, written
from dwellspark.llm.queries import byte_bpe


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the site-aware classifier accepts."""
    return site_quality.keep_accepted(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the largest doc_id) of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id) of each component of linked documents.

    Documents without words, or without a doc_id, stay.
    """
    members, _ = jaccard.jaccard_join(docs)
    gone = cut_lineage(members.where("doc_id IS NOT NULL AND doc_id <> component_id").select("doc_id").distinct())
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("k"))
    return jaccard.with_small(rows, gone.withColumnRenamed("doc_id", "k"), "k", "left_anti").select("row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: none to three times."""
    taken = mixing.mix(docs).where("copies > 0").groupBy("doc_id", "text_hash").agg(F.max("copies").cast("int").alias("copies"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("k"),
                       F.xxhash64(whole_text("text")).alias("s"))
    same = F.col("k").eqNullSafe(F.col("doc_id")) & (F.col("s") == F.col("text_hash"))
    return rows.join(taken, same).select("row", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 2048."""
    pieces = packing.token_pieces(docs, tokenizer_path=byte_bpe())
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"stage-{k}")
    return docs
