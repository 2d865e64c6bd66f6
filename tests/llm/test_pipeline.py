"""The pipeline's stages on a small table, against what each should leave."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from dwellspark.llm import jaccard
from dwellspark.llm.common import table, written

SF = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    quality, exact, near, mix, pack = (f for _, f in corpus_pipeline.STAGES)
    good = written(quality(spark, docs, SF), "t1")
    labels = table(spark, SF, "labels")
    clean = docs.join(labels.where("quality = 1"), "doc_id", "left_semi")
    assert good.columns == columns and clean.join(good, "doc_id", "left_anti").count() <= 1
    once = written(exact(spark, good, SF), "t2")
    assert once.columns == columns and once.count() == good.select("text").distinct().count()
    assert once.join(good.groupBy("text").agg(F.max("doc_id").alias("doc_id")), "doc_id", "left_anti").count() == 0
    far = written(near(spark, once, SF), "t3")
    members, links = jaccard.jaccard_join(once)
    assert far.columns == columns and far.count() == members.select("component_id").distinct().count()
    assert jaccard.jaccard_join(far)[1].count() == 0
    mixed = written(mix(spark, far, SF), "t4")
    assert mixed.columns == columns and mixed.groupBy("doc_id").count().where("count > 3").count() == 0
    words = lambda d: d.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0]
    assert 0.8 * words(far) < words(mixed) < 1.2 * words(far)
    packed = pack(spark, mixed, SF)
    assert packed.where("piece = 0").count() == mixed.count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0
    whole = corpus_pipeline.run(spark, SF)
    order = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, whole.select(order).collect())) == sorted(map(tuple, packed.select(order).collect()))


@pytest.mark.parametrize("k", range(5))
def test_stages_on_odd_tables(spark, tmp_path, k):
    spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = [(1, "a few words of text", "en", "s", 19, "u"), (2, None, None, None, None, None), (3, "", "en", "s", 0, None), (None, "x", "en", "s", 1, "u"),
            (1, "a few words of text", "en", "s", 19, "u"), (4, "A FEW words of text", "de", "t", 19, "u"), (5, "word " * 40_000, "en", "s", 200_000, "u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string")
    stage = corpus_pipeline.STAGES[k][1]
    for some in (docs, docs.limit(0)):
        out = stage(spark, some, str(tmp_path))
        assert k == 4 or out.columns == docs.columns
        assert out.count() <= 3 * 60 and (some is docs or out.count() == 0)
