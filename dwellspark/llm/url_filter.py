"""URL filters: mined association rules beside a list of given rules (DataFrame functions only).

Given rules (action, host, path) fit their host and its subdomains where the url's
path starts with theirs; the longest one that fits decides.  For all other urls the
verdict is mined: a url's tokens (host labels, host, path segments, query names,
ending) that occur together in the urls of bad documents are found by Spark's
FP-growth; an itemset becomes a rule if enough bad urls hold it (support, a count that
is the same at every size), if the share of bad ones among its labelled urls is large
enough and not below that of all labelled urls (confidence), and if no smaller rule
already says as much.  So mining goes by levels: single tokens first, and those that
are sure by themselves are in no larger set; the rest is mined in two kinds of
baskets, one with the whole host and one with its labels, for a host implies its
labels, and a set of both says no more than the host.
A rule is looked up by its rarest token only: the index lists the rules under that
token, and a url that has the token is checked for the others.

Labels: ``labels`` (doc_id, quality, toxic); a url's document is the number in its
last path segment.  Bad means quality 0 or toxic 1.  Numbers are no tokens, for
they name documents.

Defined results: a null url, or one without "://", has an empty host and path, no
tokens and no rule, and is allowed; without labels there are no mined rules; equal
urls get equal verdicts; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellspark.llm.common import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
Rule = tuple[str, str, str]


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def given_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(rule, action) of the longest rule that fits, else null."""
    found = F.lit(None).cast("struct<rule:string,action:string>")
    for action, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(action).alias("action"))).otherwise(found)
    return found


def tokens(url: Column) -> Column:
    """The distinct tokens of a url; none without a host."""
    host, path = host_of(url), path_of(url)
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("host:"), x))
    parts = F.transform(F.regexp_extract_all(path, F.lit(r"([^/.]+)"), F.lit(1)), lambda x: F.concat(F.lit("path:"), F.translate(x, UPPER, LOWER)))
    named = F.filter(parts, lambda x: ~F.rlike(x, F.lit(r"^path:\d+$")))
    asked = F.transform(F.regexp_extract_all(query, F.lit(r"([^&=]+)=?[^&]*"), F.lit(1)), lambda x: F.concat(F.lit("query:"), x))
    end = F.regexp_extract(path, r"(\.[A-Za-z]+|/)$", 1)
    every = F.concat(F.array(F.concat(F.lit("at:"), host)), labels, named, asked, F.array(F.concat(F.lit("end:"), end)))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(every))


def document_of(url: Column) -> Column:
    return F.regexp_extract(path_of(url), r"/(\d{1,18})(?:/|\.[A-Za-z]+)?$", 1).try_cast("bigint")


def labelled_urls(urls: DataFrame, labels: DataFrame) -> DataFrame:
    """items (the url's tokens), bad: a row per labelled url."""
    bad = ((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).cast("int")
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(bad).alias("bad"))
    return urls.withColumn("doc_id", document_of(F.col("url"))).join(known, "doc_id").select(tokens(F.col("url")).alias("items"), "bad")


def by_rarest(sets: DataFrame, counts: DataFrame) -> DataFrame:
    """``sets`` (rule, items) plus ``anchor``, the rarest item (then the first by name)."""
    each = sets.select("rule", "items", F.explode("items").alias("token")).join(counts, "token", "left")
    return each.groupBy("rule").agg(F.first("items").alias("items"),
                                    F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("anchor"))


def holders(rules: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` (with items) x the rules (rule, items, anchor) that they hold, by the index of anchors."""
    index = rules.select(F.col("anchor").alias("token"), "rule", F.col("items").alias("needed"))
    seen = rows.withColumn("token", F.explode("items"))
    return seen.join(index, "token").where(F.size(F.array_except("needed", "items")) == 0).drop("token", "needed")


def mine(urls: DataFrame, labels: DataFrame, *, least_urls: int = 20, confidence: float = 0.6) -> DataFrame:
    """rule, items, anchor, n, n_bad, confidence: the pruned rules "these tokens: bad"."""
    rows = cut_lineage(labelled_urls(urls, labels))
    totals = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
    none = rows.sparkSession.createDataFrame([], "rule string, items array<string>, anchor string, n bigint, n_bad bigint, confidence double")
    if not totals["bad"] or totals["bad"] < least_urls:
        return none
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # level one: single tokens; one that all urls hold adds nothing to a set
    bar = max(confidence, totals["bad"] / totals["n"])
    counts = cut_lineage(rows.select(F.explode("items").alias("token"), "bad").groupBy("token").agg(
        F.count("*").alias("n"), F.sum("bad").alias("n_bad")))
    often = counts.where((F.col("n_bad") >= least_urls) & (F.col("n") < totals["n"])).withColumn("confidence", F.col("n_bad") / F.col("n"))
    single = often.where(F.col("confidence") >= bar).select(
        F.col("token").alias("rule"), F.array("token").alias("items"), F.col("token").alias("anchor"), "n", "n_bad", "confidence")
    open_ = rows.where("bad = 1").withColumn("url_no", F.monotonically_increasing_id()).select("url_no", F.explode("items").alias("token"))
    open_ = open_.join(often.where(F.col("confidence") < bar).select("token"), "token").groupBy("url_no").agg(F.collect_set("token").alias("items"))
    open_ = cut_lineage(open_.select("items"))  # as many tokens as a url has
    # larger sets of enough bad urls
    at_host, label = (lambda x: F.startswith(x, F.lit("at:"))), (lambda x: F.startswith(x, F.lit("host:")))
    sets = rows.sparkSession.createDataFrame([], "items array<string>, n_bad bigint")
    for baskets, wanted in ((open_.where(F.exists("items", at_host)).select(F.filter("items", lambda x: ~label(x)).alias("items")), F.exists("items", at_host)),
                            (open_.select(F.filter("items", lambda x: ~at_host(x)).alias("items")), F.lit(True))):
        baskets = baskets.where(F.size("items") > 1)
        some = baskets.count()
        if some < least_urls:
            continue
        share = max(0.0, least_urls - 0.5) / some  # half a url less: the product with the count must not round up
        model = FPGrowth(itemsCol="items", minSupport=share, minConfidence=0.0, numPartitions=parts).fit(baskets)
        found = model.freqItemsets.where((F.col("freq") >= least_urls) & (F.size("items") > 1)).where(wanted)
        sets = sets.unionByName(found.select(F.sort_array("items").alias("items"), F.col("freq").alias("n_bad")))
    sets = cut_lineage(sets.select(F.array_join("items", " ").alias("rule"), "items", "n_bad"))
    anchored = cut_lineage(by_rarest(sets, counts))
    held = holders(anchored, rows).groupBy("rule").agg(F.count("*").alias("n"))
    sure = (anchored.join(held, "rule").join(sets.select("rule", "n_bad"), "rule")
            .withColumn("confidence", F.col("n_bad") / F.col("n")).where(F.col("confidence") >= bar))
    sure = cut_lineage(sure.select("rule", "items", "anchor", "n", "n_bad", "confidence"))
    # a rule that holds a smaller one is not needed: whatever it blocks is blocked
    inner = holders(sure.select("rule", "items", "anchor"), sure.select(F.col("rule").alias("outer"), "items"))
    implied = inner.where("rule <> outer").select(F.col("outer").alias("rule")).distinct()
    return cut_lineage(sure.join(implied, "rule", "left_anti").unionByName(single))


def judge(pages: DataFrame, labels: DataFrame, rules: Sequence[Rule], *, least_urls: int = 20,
          confidence: float = 0.6) -> DataFrame:
    """page_id, url, host, path, rule, verdict, mined (the mined rule that blocks, if one decides)."""
    urls = cut_lineage(pages.where("url IS NOT NULL").select("url").distinct())
    mined = mine(urls, labels, least_urls=least_urls, confidence=confidence)
    hit = holders(mined.select("rule", "items", "anchor"), urls.select("url", tokens(F.col("url")).alias("items")))
    hit = hit.groupBy("url").agg(F.min("rule").alias("mined"))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path")).join(hit, "url", "left")
    rows = rows.withColumn("given", given_rule(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce("given.action", F.when(F.col("mined").isNotNull(), "block").otherwise("allow"))
    return rows.select("page_id", "url", "host", "path", F.col("given.rule").alias("rule"), verdict.alias("verdict"),
                       F.when(F.col("given").isNull(), F.col("mined")).alias("mined"))
