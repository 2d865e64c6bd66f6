"""The registered queries of the subpackage, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellspark.llm import alignment, exact_dedup, html_main, huffman, jaccard, merkle, mixing, mixture_packing, packing, site_quality, transcripts, url_filter, weak_rules
from dwellspark.llm.common import finished, scratch_path, table, written


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_bpe() -> str:
    return vocabulary("byte_bpe_50k.json")


URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict", "mined")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source")


def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    def run() -> DataFrame:
        folder = scratch_path(spark, "ids")
        huffman.write_ids(table(spark, sf_dir, "documents"), folder, tokenizer_path=byte_bpe())
        return huffman.read_ids(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    return finished(spark, run)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = site_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                                   sites=site_quality.page_sites(table(spark, sf_dir, "pages")))
    return judged.select("doc_id", "host", "path", "evidence", "host_rate", "path_rate", "quality", F.col("accepted").alias("kept"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = weak_rules.judge(table(spark, sf_dir, "documents"))
    failed = weak_rules.base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         failed.alias("base_failed"), (~failed & F.col("accepted")).alias("kept"), F.round("quality", 6).alias("quality"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), tokenizer_path=byte_bpe())
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, _ = jaccard.jaccard_join(table(spark, sf_dir, "documents"))
    return members.select("doc_id", "n_shingles", "component_id")


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcripts.parse(transcripts.raw_transcripts(table(spark, sf_dir, "conversations")))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    def run() -> DataFrame:
        rows = alignment.align(table(spark, sf_dir, "documents"), path_a=byte_bpe(), path_b=vocabulary("piece_bpe_32k.model"))
        shown = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
        rows = written(rows.withColumn("groups_sha256", shown).drop("groups"), "alignment")
        return alignment.scored(rows, "groups_sha256 string")
    return finished(spark, run)


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finished(spark, lambda: merkle.verify(merkle.manifest(table(spark, sf_dir, "documents"))))


def op13_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    def run() -> DataFrame:
        tokens = mixture_packing.token_rows(table(spark, sf_dir, "documents"), tokenizer_path=vocabulary("word_bpe_49k.json"),
                                            end_id=2, id_bytes=2)
        return mixture_packing.pack(tokens, id_bytes=2).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                                                   "sequence_id", "offset", "source")
    return finished(spark, run)


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_mixing": op2_mixing,
    "op3_token_ids": op3_token_ids,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_quality_rules": op5_quality_rules,
    "op6_packing": op6_packing,
    "op7_html_text": op7_html_text,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_chat_format": op10_chat_format,
    "op11_alignment": op11_alignment,
    "op12_merkle": op12_merkle,
    "op13_mixture_packing": op13_mixture_packing,
}

SQL = {
    "op8_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               coalesce(doc_id = max(doc_id) OVER w, doc_id IS NULL AND max(doc_id) OVER w IS NULL)
               AND row_number() OVER (PARTITION BY coalesce(text, ''), doc_id) = 1 AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op12_merkle": merkle.oracle_sql(),
}
