"""URL verdicts: given rules, mined rules against brute force, odd urls."""

from itertools import combinations

import pytest
from pyspark.sql import functions as F

from dwellspark.llm import url_filter
from dwellspark.llm.queries import URL_RULES
from dwellspark.llm.url_filter import judge, mine, tokens

LABELS = "doc_id long, quality int, toxic int"


def site(spark):
    """Urls of documents 0..399: those under spam.*/win/ are bad, and a few others."""
    urls, labels = [], []
    for i in range(400):
        host = ["spam.example.org", "good.example.org", "shop.example.com", "news.example.net"][i % 4]
        part = ["win", "blog"][i // 4 % 2]
        bad = host.startswith("spam") and part == "win" or i % 37 == 0
        urls.append((i, f"https://{host}/en/{part}/{i}{['', '/', '.html', '?page=2&ref=x'][i % 5 % 4]}", "clash"))
        labels.append((i, 0 if bad else 1, 0))
    return (spark.createDataFrame(urls, "page_id long, url string, verdict string"), spark.createDataFrame(labels, LABELS), labels)


def test_mined_rules_equal_brute_force(spark):
    pages, labels, marks = site(spark)
    bad = {d: q == 0 for d, q, _ in marks}
    rows = [(set(r["t"]), bad[r["page_id"]]) for r in pages.select("page_id", tokens(F.col("url")).alias("t")).collect()]
    everywhere = set.intersection(*(t for t, _ in rows))
    sure = {}
    for t, b in rows:
        for k in (1, 2, 3, 4):
            for some in combinations(sorted(t - everywhere), k) if b else ():
                sure.setdefault(some, None)
    for some in sure:
        held = [b for t, b in rows if set(some) <= t]
        sure[some] = (len(held), sum(held))
    sure = {s: v for s, v in sure.items() if v[1] >= 20 and v[1] / v[0] >= 0.8}
    want = {s for s in sure if not any(set(o) < set(s) for o in sure)}
    got = mine(pages.select("url"), labels, least_urls=20, confidence=0.8).collect()
    assert {tuple(r["items"]) for r in got} == want and want
    assert all((r["n"], r["n_bad"]) == sure[tuple(r["items"])] for r in got)


def test_sure_tokens_and_implied_labels_stay_out_of_larger_sets(spark, monkeypatch):
    """Sets that the larger levels count: none with a token that is sure by itself, none of a host and its labels."""
    counted = []
    real = url_filter.by_rarest
    monkeypatch.setattr(url_filter, "by_rarest", lambda sets, counts: counted.extend(r["items"] for r in sets.collect()) or real(sets, counts))
    rows = [(d, f"https://www.{h}.example.org/{p}/x/{d}", good) for d, h, p, good in
            [(d, "bad", "a", 0) for d in range(30)] + [(d, "half", "win" if d % 2 else "b", (d + 1) % 2) for d in range(30, 130)]
            + [(d, "good", "win", 1) for d in range(130, 400)]]
    labels = spark.createDataFrame([(d, good, 0) for d, _, good in rows], LABELS)
    got = {tuple(r["items"]) for r in mine(spark.createDataFrame([(u,) for _, u, _ in rows], "url string"), labels).collect()}
    assert got == {("at:www.bad.example.org",), ("host:bad",), ("path:a",), ("at:www.half.example.org", "path:win"), ("host:half", "path:win")}
    assert counted and len(counted) == len({tuple(c) for c in counted})
    for some in counted:
        assert not {"at:www.bad.example.org", "host:bad", "path:a"} & set(some)
        assert not (any(x.startswith("at:") for x in some) and any(x.startswith("host:") for x in some))


def test_support_is_the_same_at_every_size(spark):
    """25 bad urls of one host give a rule among 500 labelled urls and among 15,000."""
    for n in (500, 15_000):
        ids = spark.range(n).withColumnRenamed("id", "doc_id")
        host = F.when(F.col("doc_id") < 25, "spam.example.org").otherwise("good.example.org")
        urls = ids.select(F.concat(F.lit("https://"), host, F.lit("/en/"), F.col("doc_id")).alias("url"))
        labels = ids.select("doc_id", F.when(F.col("doc_id") < 25, 0).otherwise(1).alias("quality"), F.lit(0).alias("toxic"))
        got = mine(urls, labels).collect()
        assert {(*r["items"], r["n"], r["n_bad"]) for r in got} == {("at:spam.example.org", 25, 25), ("host:spam", 25, 25)}


def test_a_rule_is_not_below_the_base_rate(spark):
    """Three of four urls are bad: a host with two bad ones of three gives no rule, one with nine of ten does."""
    rows = [(d, host, d % of == 0) for d, host, of in
            [(d, "less.example.org", 3) for d in range(300)] + [(d, "more.example.net", 10) for d in range(300, 500)]]
    urls = spark.createDataFrame([(f"https://{h}/en/{d}",) for d, h, _ in rows], "url string")
    labels = spark.createDataFrame([(d, int(good), 0) for d, _, good in rows], LABELS)
    got = mine(urls, labels).collect()
    assert {r["items"][0] for r in got} == {"at:more.example.net", "host:more", "host:net"}


def test_verdicts(spark):
    pages, labels, _ = site(spark)
    odd = [(1000, None), (1001, "no scheme"), (1002, "http://WWW.Example.COM/en/1"), (1003, "http://example.com/en/1"), (1004, "http://a.example.com/en/x?y=/z"),
           (1005, "http://x.net/es/1#frag"), (1006, "http://x.net?es/"), (1007, "http://com/"), (1008, "http://xcom/en/"), (1009, "http://example.com"),
           (1010, "http://É.net/fr/"), (1010, "http://É.net/fr/"), (None, "http://a.b/" + "p/" * 20_000), (1011, "")]
    every = pages.unionByName(spark.createDataFrame([(*o, "") for o in odd], pages.schema))
    got = judge(every, labels, URL_RULES, confidence=0.8).collect()
    assert len(got) == 400 + len(odd)
    at = {r["page_id"]: r for r in got if r["page_id"] is None or r["page_id"] >= 1000}
    want = {1000: ("", "", None, "allow"), 1001: ("", "", None, "allow"), 1002: ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
            1003: ("example.com", "/en/1", "example.com/en/", "block"), 1004: ("a.example.com", "/en/x", "example.com/en/", "block"),
            1005: ("x.net", "/es/1", "net/es/", "block"), 1006: ("x.net", "", None, "allow"), 1007: ("com", "/", "com/", "allow"),
            1008: ("xcom", "/en/", None, "allow"), 1009: ("example.com", "", None, "allow"), 1010: ("É.net", "/fr/", "net/fr/", "block"),
            1011: ("", "", None, "allow")}
    for k, v in want.items():
        assert (at[k]["host"], at[k]["path"], at[k]["rule"], at[k]["verdict"]) == v, k
    assert at[None]["verdict"] == "allow"
    blocked = {r["page_id"] for r in got if r["mined"]}
    assert blocked == {i for i in range(400) if i % 4 == 0 and i // 4 % 2 == 0}


@pytest.mark.parametrize("rows", [[], [(1, 1, 0)], [(None, 0, 1), (3, None, None)]])
def test_without_usable_labels(spark, rows):
    pages = spark.createDataFrame([(3, "http://a.org/3")], "page_id long, url string")
    labels = spark.createDataFrame(rows, LABELS)
    assert judge(pages, labels, URL_RULES).first()["verdict"] == "allow"
    assert judge(pages.limit(0), labels, URL_RULES).count() == 0
