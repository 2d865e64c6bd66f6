"""Quality rules against brute force, and both classifiers on held-out labels."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dwellspark.llm import site_quality, weak_rules
from dwellspark.llm.common import table

SF = "/root/testdata/sf0.01"


def brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    count = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if count[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def odd_documents():
    return [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, "one"), (5, " a b a b a b "), (6, "x\nx\n\n x\nx"), (7, "é#ü|%%\n" * 3),
            (8, "w " * 9_000), (9, "a b c d " * 3000 + "tail"), (9, "a b"), (9, "a b"), (None, "x"), (10, "    word"), (11, "a b c a b")]


def test_counts_equal_brute_force(spark):
    rows = odd_documents()
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n_words int")
    got = weak_rules.text_counts(docs).collect()
    assert sorted(tuple(r[1:6]) for r in got) == sorted(brute(t) for _, t in rows)
    assert weak_rules.judge(docs).count() == len(rows)
    assert weak_rules.judge(docs.limit(0)).count() == 0


@pytest.fixture(scope="module")
def labelled(spark):
    return table(spark, SF, "documents"), table(spark, SF, "labels")


def shares(judged, labels, column):
    got = judged.join(labels.select("doc_id", F.col("quality").alias("label")), "doc_id").select("label", column).collect()
    good, bad = [r[1] for r in got if r[0] == 1], [not r[1] for r in got if r[0] == 0]
    return sum(good) / len(good), sum(bad) / len(bad)


def test_rules_on_labels(labelled):
    docs, labels = labelled
    judged = weak_rules.judge(docs)
    long_enough = judged.where("n_words >= 50")
    good, bad = shares(long_enough, labels, "accepted")
    assert good > 0.99 and bad > 0.9


def test_em_finds_bad_documents_without_labels(spark):
    votes = [(-1, -1, 0)] * 30 + [(-1, 0, 0)] * 20 + [(0, -1, 0)] * 20 + [(0, 0, 1)] * 900 + [(0, 0, 0)] * 10
    df = spark.createDataFrame(votes, "a int, b int, prose int")
    share, model = weak_rules.estimate(df, ["a", "b", "prose"], 30)
    assert 0.05 < share < 0.12 and model["a"]["bad"][-1] > 0.4 > 0.02 > model["a"]["good"][-1]


def test_classifier_on_held_out_labels(labelled):
    docs, labels = labelled
    judged = site_quality.classify(docs, labels.where("doc_id % 2 = 0"))
    good, bad = shares(judged, labels.where("doc_id % 2 = 1"), "accepted")
    assert good > 0.99 and bad > 0.9
    kept = site_quality.keep_accepted(docs, labels)
    assert kept.columns == docs.columns and kept.count() == site_quality.classify(docs, labels).where("accepted").count()


def test_sparse_sites_are_shrunk(spark):
    """Equal evidence is judged by the site's record; a single document's site stays near the top rate."""
    rows = [(i, "bad" if i < 300 else "good" if i < 600 else f"one{i}", "!!!! ### " * 30 if i < 290 or i % 50 == 0 else "plain words of a text here " * 12) for i in range(620)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("lang", F.lit(None).cast("string"))
    labels = spark.createDataFrame([(i, 0 if rows[i][2][0] == "!" else 1, 0) for i in range(620)], "doc_id long, quality int, toxic int")
    rate = {r["host"]: r["host_rate"] for r in site_quality.classify(docs, labels).collect()}
    assert rate["bad"] < 0.2 < 0.8 < rate["good"] and 0.25 < rate["one601"] < 0.95


def test_posteriors_equal_plain_code(spark, labelled):
    """Rates and qualities recomputed from the evidence alone, hosts and paths of pages where there are some."""
    docs, labels = labelled
    sites = site_quality.page_sites(table(spark, SF, "pages"))
    got = site_quality.classify(docs, labels, sites=sites).collect()
    url = {r["doc_id"]: (r["site_host"], r["site_path"]) for r in sites.collect()}
    own = {r["doc_id"]: (r["source"], r["lang"]) for r in docs.collect()}
    assert len(got) == len(own) and url and all((r["host"], r["path"]) == url.get(r["doc_id"], own[r["doc_id"]]) for r in got)
    known = {r["doc_id"]: r["quality"] for r in labels.where("quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality")).collect()}
    known = [q for d, q in known.items() if d in own]
    prior = sum(known) / len(known)
    good, n = Counter(), Counter()
    for r in got:
        p = 1 / (1 + math.exp(-(r["evidence"] + math.log(prior / (1 - prior)))))
        for group in ((), (r["host"],), (r["host"], r["path"])):
            good[group] += p
            n[group] += 1
    top = (good[()] + prior) / (n[()] + 1)

    def pseudo(groups, parent):
        d = sum(n[g] * (good[g] / n[g] - parent(g)) ** 2 for g in groups)
        v = sum(parent(g) * (1 - parent(g)) for g in groups)
        nv = sum(n[g] * parent(g) * (1 - parent(g)) for g in groups)
        inside = (d - v) / max(nv - v, 1e-9)
        return 1e6 if inside <= 1e-6 else max(1 / inside - 1, 1.0)

    m = pseudo([g for g in n if len(g) == 1], lambda g: top)
    host = {g[0]: (good[g] + m * top) / (n[g] + m) for g in n if len(g) == 1}
    m = pseudo([g for g in n if len(g) == 2], lambda g: host[g[0]])
    for r in got:
        g = (r["host"], r["path"])
        rate = (good[g] + m * host[g[0]]) / (n[g] + m)
        rate = min(max(rate, 1e-6), 1 - 1e-6)
        quality = 1 / (1 + math.exp(-(r["evidence"] + math.log(rate / (1 - rate)))))
        assert r["host_rate"] == pytest.approx(host[g[0]], rel=1e-6) and r["quality"] == pytest.approx(quality, rel=1e-5)


def test_sites_of_pages(spark):
    urls = ["http://B.org/en/7", "http://a.org/x/y/7?q#f", "https://a.org/8/", "nothing", None, "http:///en/9", "http://a.org/en/", "http://c.org/10.html"]
    got = site_quality.page_sites(spark.createDataFrame([(u, 1) for u in urls], "url string, doc_id int"))
    assert sorted(map(tuple, got.collect())) == [(7, "b.org", "/en/"), (8, "a.org", "/"), (10, "c.org", "/")]
    docs = spark.createDataFrame([(7, "a", "s", "en"), (7, "a", "t", None), (None, "b", None, "en"), (8, None, "s", "en")], "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(7, 1, 0), (8, 0, 0)], "doc_id long, quality int, toxic int")
    assert site_quality.classify(docs, labels, sites=got).count() == 4
    assert site_quality.keep_accepted(docs, labels, sites=got).columns == docs.columns


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(None, 0, 0), (1, None, None)]])
def test_odd_documents_and_few_labels(spark, labels):
    rows = [(*r, None if r[0] == 4 else "s", 1.0) for r in odd_documents()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, quality double").withColumn("lang", F.lit("en"))
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = site_quality.classify(docs, marks)
    assert got.count() == len(rows) and got.where("not accepted").count() == 0
    assert site_quality.keep_accepted(docs, marks).columns == docs.columns
    assert site_quality.classify(docs.limit(0), marks).count() == 0
